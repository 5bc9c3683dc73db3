"""Runs of repeating words in texts, found as maximal pairs.

A pair of places of one text is maximal if the words from there on agree over some
length L and neither the words before nor those after do. If the places are p words
apart and L is at least (k - 1) p, the words from the first place on have period p over
L + p words, at least k times, and no neighbour extends that: such pairs are exactly the
runs, so nothing needs to be extended afterwards. A pair at a multiple of a period
describes a run again; the smallest period stays.

Suffixes of a batch of texts are sorted by rank doubling in numpy. Words are numbered
apart in every text, so that equal ranks never join two texts, and only suffixes that
are not yet unique are sorted on. Their longest common prefixes follow from the ranks of
all rounds. An LCP-interval tree, walked from its leaves, then holds the places below a
node by the word to their left: two children of a node give its maximal pairs between
lists of different words. Pairs further apart than L allows are never formed: lists are
sorted, and a search finds the places within reach. Nothing moves between tasks.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.frames import pieces, strings

#: A run has at least this many words and repeats its period at least this often.
LEAST_WORDS = 24
LEAST_TIMES = 3
#: Bytes of text whose suffixes are sorted together; a longer text is sorted alone.
BATCH_BYTES = 4_000_000


class _Ranks:
    """Ranks of suffixes by their first 1, 2, 4, ... symbols, as far as they are shared.

    ``levels`` holds (symbols, places, ranks) of the suffixes that share their first
    symbols with another one; a place that is not there is unique at that length.
    """

    def __init__(self, symbols: np.ndarray):
        size = len(symbols)
        counts = np.bincount(symbols)
        rank = np.empty(size + 1, dtype=np.int64)
        rank[:size] = (np.cumsum(counts) - counts)[symbols]
        rank[size] = -1
        places, length = np.flatnonzero(counts[symbols] > 1), 1
        self.levels = []
        while len(places):
            self.levels.append((length, places, rank[places]))
            old = rank[places]
            order = np.argsort(old * (size + 1) + rank[np.minimum(places + length, size)] + 1,
                               kind="stable")
            old, held = old[order], places[order]
            then = rank[np.minimum(held + length, size)]
            fresh = np.ones(len(held), dtype=bool)
            fresh[1:] = (old[1:] != old[:-1]) | (then[1:] != then[:-1])
            group = np.ones(len(held), dtype=bool)
            group[1:] = old[1:] != old[:-1]
            at = np.arange(len(held))
            first = np.maximum.accumulate(np.where(fresh, at, 0))
            rank[held] = old + first - np.maximum.accumulate(np.where(group, at, 0))
            shared = ~fresh | np.append(~fresh[1:], False)
            places, length = np.sort(held[shared]), 2 * length
        self.rank = rank

    def sharing(self, symbols: int) -> np.ndarray:
        """Places that share their first ``symbols`` symbols, a power of two."""
        for length, places, _ in self.levels:
            if length == symbols:
                return places
        return np.empty(0, dtype=np.int64)

    def common(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of suffixes at pairs of places."""
        one, two, total = one.copy(), two.copy(), np.zeros(len(one), dtype=np.int64)
        for length, places, ranks in reversed(self.levels):
            a = np.minimum(np.searchsorted(places, one), len(places) - 1)
            b = np.minimum(np.searchsorted(places, two), len(places) - 1)
            same = (places[a] == one) & (places[b] == two) & (ranks[a] == ranks[b])
            for held in (one, two, total):
                held[same] += length
        return total


class _Node:
    """The places below a node of the tree, in order, and by the word to their left."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, left: int):
        self.places, self.classes = [place], {left: [place]}


def _join(one: _Node, two: _Node, common: int, left: list[int], words: int, times: int,
          found: dict) -> _Node:
    """Two children of a node of depth ``common`` as one; their runs go to ``found``.

    The smaller child is put into the larger, so a place moves a logarithmic number of
    times. Around each of its places, the others are looked up by left word or by
    distance, whichever are fewer.
    """
    if len(one.places) < len(two.places):
        one, two = two, one
    reach, least = common // (times - 1), words - common
    for left_word, places in two.classes.items():
        for place in places:
            low = bisect_left(one.places, place - reach)
            high = bisect_right(one.places, place + reach)
            if high - low <= len(one.classes):
                others = [p for p in one.places[low:high] if left[p] != left_word]
            else:
                others = []
                for word, held in one.classes.items():
                    if word != left_word:
                        others += held[bisect_left(held, place - reach):
                                       bisect_right(held, place + reach)]
            for other in others:
                start, period = min(place, other), abs(place - other)
                if period >= least:
                    at = (start, common + period)
                    found[at] = min(period, found.get(at, period))
    for left_word, places in two.classes.items():
        held = one.classes.get(left_word)
        if held is None:
            one.classes[left_word] = places
        else:
            for place in places:
                insort(held, place)
        for place in places:
            insort(one.places, place)
    return one


def runs(symbols: np.ndarray, starts: np.ndarray, words: int = LEAST_WORDS,
         times: int = LEAST_TIMES) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period.

    ``symbols`` are the words of texts one after the other, ``starts`` the texts' first
    places. No symbol occurs in two texts.
    """
    shortest = -(-words * (times - 1) // times)   # the common prefix of any run's pair
    ranks = _Ranks(symbols)
    places = ranks.sharing(1 << (shortest.bit_length() - 1))
    if not len(places):
        return np.empty((0, 3), dtype=np.int64)
    places = places[np.argsort(ranks.rank[places])]
    common = ranks.common(places[:-1], places[1:])
    before = np.append(-1, symbols[:-1])
    before[starts[starts < len(before)]] = -1
    kept = np.append(common >= shortest, False)
    kept |= np.append(False, common >= shortest)
    left = dict(zip(places[kept].tolist(), before[places[kept]].tolist()))
    found: dict[tuple[int, int], int] = {}
    stack: list[tuple[_Node, int]] = []
    for place, depth in zip(places[kept].tolist(), np.append(common, 0)[kept].tolist()):
        node = _Node(place, left[place])
        while stack and stack[-1][1] >= depth:
            other, shared = stack.pop()
            node = _join(other, node, shared, left, words, times, found)
        if depth >= shortest:
            stack.append((node, depth))
    rows = sorted((start, period, length) for (start, length), period in found.items())
    return np.array([(s, n, p) for s, p, n in rows], dtype=np.int64).reshape(-1, 3)


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    """The words of all texts as numbers that differ between texts."""
    numbers, first = [], 0
    for words in texts:
        seen: dict[bytes, int] = {}
        numbers.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words),
                                   np.int64, len(words)) + first)
        first += len(seen)
    return np.concatenate(numbers) if numbers else np.empty(0, dtype=np.int64)


def _collapsed(words: list[bytes], found: list[list[int]]) -> bytes:
    """The words outside runs and those of the first period of every run."""
    if not found:
        return b" ".join(words)
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    return b" ".join([w for w, n in zip(words, np.cumsum(dropped).tolist()) if not n])


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id",
                  words: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """``key``, ``n_words``, ``runs`` and ``collapsed`` of every whole text.

    A run is a stretch of at least ``words`` words with smallest period q that spans at
    least ``times`` periods and that no neighbouring word extends; ``runs`` lists (start,
    length, period) by start, then period. ``collapsed`` is the text without the words of
    runs after their first q, joined by one space. Words are parted by the bytes 9-13 and
    32. A null or empty text has no words and no runs; repeated rows give repeated
    results, a null key stays null; other columns play no part; an empty table gives no
    rows. A very long text is worked on whole, in memory in proportion to its words.
    """
    schema = pa.schema([
        ("key", pa.int64()), ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                     ("period", pa.int64())]))),
        ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", BATCH_BYTES):
                texts = [t.encode("utf-8", "surrogatepass").split()
                         for t in strings(part, "text")]
                sizes = np.array([len(t) for t in texts], dtype=np.int64)
                starts = np.cumsum(sizes) - sizes
                rows = runs(_numbered(texts), starts[sizes > 0], words, times)
                owner = np.searchsorted(starts + sizes, rows[:, 0], side="right")
                rows[:, 0] -= starts[owner]
                bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
                held = rows.tolist()
                listed = pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()),
                    pa.StructArray.from_arrays(list(map(pa.array, rows.T.copy())),
                                               ["start", "length", "period"]))
                collapsed = [_collapsed(t, held[a:b]) for t, a, b in
                             zip(texts, bounds.tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(sizes), listed,
                     pa.array(collapsed, pa.binary()).cast(pa.string())], schema=schema)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(
        run, "key long, n_words long, "
             "runs array<struct<start:long,length:long,period:long>>, collapsed string"
    ).withColumnRenamed("key", key)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document, by a checksum of its id, repeats itself.

    h is crc32 of the decimal id and g = h div 10. Where h mod 10 is 0, the text has n > 0
    words, and a = g mod n, word i from a on becomes word a + (i - a) mod p, with
    p = 1 + (n - a) div (3 + g mod 8). Other texts, and rows without an id, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(
            F.get(words, (a + (i - a) % p).cast("int")))), " ")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # bound to a variable, the words are taken from the text once
    planted = F.get(F.transform(F.array(words), repeated), 0)
    return docs.select("doc_id", F.when(
        (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), planted)
        .otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """Per document the number of its runs, the one that repeats most, and digests.

    The run with the greatest length / period counts, of equal ones that with the
    smallest start, then period; without runs its four columns are null. What nulls,
    repeated rows and empty tables give is as in ``periodic_runs``.
    """
    found = periodic_runs(with_planted_runs(docs))
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)),
        lambda held, r: F.when(r["length"] * held["period"] > held["length"] * r["period"], r)
        .otherwise(held))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"),
        F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "runs",
                        best.alias("best"), "collapsed").select(
        "doc_id", "n_runs", F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long")
        .alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
