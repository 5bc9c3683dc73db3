"""Passages of benchmark items in documents, found with a generalised suffix automaton.

The automaton of the normalised items knows every run of words that occurs in an item.
Documents stream through it word by word; its state and the length matched so far give
the longest run of words up to each place that some item contains. A match of ``window``
words or more hits its words, and so does a whole item of fewer words. States remember
which items contain their words, so a document learns the items that it repeats.

The automaton lies in the memory of each worker, hence its bound: items are cut into
overlapping pieces that keep every window, and pieces are dealt into blocks of about
``BLOCK_WORDS`` words. Each block's pieces are broadcast, and the documents pass through
the blocks one after the other, without a shuffle; with more than one block each pass is
written, so that a lost executor costs one pass at most. Every document meets every block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.bpe import STEP_BYTES
from cartpulse.llm.frames import pieces, written

WINDOW = 10
#: Words of items in one automaton, about; it takes some 600 bytes a word.
BLOCK_WORDS = 200_000
#: Words of an item in one piece; the next piece starts with the last window - 1 of them.
PIECE_WORDS = 10_000

#: Bytes of words: a-z, 0-9 and all beyond ASCII; A-Z count as a-z, the rest parts words.
_BYTES = bytes(b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57
               else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def normalised(text: str) -> list[bytes]:
    """The words of a text, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


class Automaton:
    """Suffix automaton of several items, given as (item, words).

    Items of fewer than ``window`` words count as a whole.
    """

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.codes: dict[bytes, int] = {}
        self.length, self.link = [0], [-1]
        self.then: list[dict[int, int]] = [{}]
        read = []
        for item, words in items:
            codes = [self.codes.setdefault(w, len(self.codes)) for w in words]
            read.append((item, codes))
            last = 0
            for code in codes:
                last = self._longer(last, code)
        self._remember(read)

    def _state(self, length: int, link: int, then: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.then.append(then)
        return len(self.length) - 1

    def _split(self, before: int, code: int, after: int) -> int:
        """``after`` without the runs longer than those that ``before`` and ``code`` give."""
        length = self.length[before] + 1
        if self.length[after] == length:
            return after
        clone = self._state(length, self.link[after], dict(self.then[after]))
        self.link[after] = clone
        while before >= 0 and self.then[before].get(code) == after:
            self.then[before][code] = clone
            before = self.link[before]
        return clone

    def _longer(self, last: int, code: int) -> int:
        after = self.then[last].get(code)
        if after is not None:
            return self._split(last, code, after)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and code not in self.then[last]:
            self.then[last][code] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, code, self.then[last][code])
        return new

    def _remember(self, items: list[tuple[object, list[int]]]) -> None:
        """Which items contain the windows that end in a state.

        ``gram`` is the state of a run's last ``window`` words, ``holders`` its items.
        ``whole`` are the short items of a state, by size; ``near`` is the nearest state
        along the links, itself included, that has any.
        """
        states = len(self.length)
        self.gram = [-1] * states
        self.holders: dict[int, set] = {}
        self.whole: dict[int, dict[int, set]] = {}
        order = np.argsort(np.array(self.length), kind="stable").tolist()
        for v in order:
            if self.length[v] >= self.window:
                up = self.link[v]
                self.gram[v] = v if self.length[up] < self.window else self.gram[up]
        for item, codes in items:
            state = 0
            for at, code in enumerate(codes, 1):
                state = self.then[state][code]
                if at >= self.window:
                    self.holders.setdefault(self.gram[state], set()).add(item)
            if 0 < len(codes) < self.window:
                self.whole.setdefault(state, {}).setdefault(len(codes), set()).add(item)
        self.near = [-1] * states
        for v in order:
            self.near[v] = v if v in self.whole else -1 if v == 0 else self.near[self.link[v]]
        self.least = min([self.window, *(n for sizes in self.whole.values() for n in sizes)])

    def matches(self, words: list[bytes]) -> tuple[list[list[int]], set, int]:
        """Hit stretches [first, end) of the words, the items found, the longest match."""
        then, link, length = self.then, self.link, self.length
        near, window, least = self.near, self.window, self.least
        spans: list[list[int]] = []
        grams, shorts = set(), set()
        state = matched = longest = 0
        for at, code in enumerate(map(self.codes.get, words)):
            if code is None:
                state = matched = 0
                continue
            after = then[state].get(code)
            if after is None:
                while state >= 0 and code not in then[state]:
                    state = link[state]
                # every known word leaves the root
                matched = length[state]
                after = then[state][code]
            state = after
            matched += 1
            if matched < least:
                continue
            hit = 0
            if matched >= window:
                hit = window
                grams.add(self.gram[state])
                longest = max(longest, matched)
            short = near[state]
            while short >= 0:
                for size in self.whole[short]:
                    if size <= matched:
                        shorts.add((short, size))
                        hit = max(hit, size)
                        longest = max(longest, size)
                up = link[short]
                short = near[up] if up >= 0 else -1
            if hit:
                first = at + 1 - hit
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append([first, at + 1])
        items = set().union(*(self.holders[g] for g in grams),
                            *(self.whole[v][n] for v, n in shorts))
        return spans, items, longest


_automata: dict[str, Automaton] = {}


def _automaton(name: str, shared, window: int) -> Automaton:
    """The automaton of a broadcast block, built once per worker; one is kept at a time."""
    if name not in _automata:
        _automata.clear()
        _automata[name] = Automaton(shared.value, window)
    return _automata[name]


def _merged(one: list[list[int]], two: list[list[int]]) -> list[list[int]]:
    if not one or not two:
        return one or two
    spans: list[list[int]] = []
    for first, end in sorted(one + two):
        if spans and spans[-1][1] >= first:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([first, end])
    return spans


def _blocks(items: DataFrame, text: str, key: str, window: int,
            block_words: int) -> tuple[DataFrame, int]:
    """(item, words, n, block): the items in overlapping pieces, and the number of blocks."""
    step = max(PIECE_WORDS, 2 * window) - window + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", STEP_BYTES):
                rows = []
                for item, text_ in zip(part.column("item").to_pylist(),
                                       part.column("text").to_pylist()):
                    words = normalised(text_ or "")
                    for at in range(0, max(1, len(words) - window + 1), step) if words else ():
                        some = words[at:at + step + window - 1]
                        rows.append((item, b" ".join(some), len(some)))
                held = list(zip(*rows)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held[0], pa.string()), pa.array(held[1], pa.binary()),
                     pa.array(held[2], pa.int64())], ["item", "words", "n"])

    cut_up = written(items.select(F.col(key).cast("string").alias("item"),
                                  F.col(text).alias("text"))
                     .mapInArrow(cut, "item string, words binary, n long"), "benchmark-pieces")
    total = cut_up.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    return cut_up.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks))), blocks


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text",
            key: str = "doc_id", item_text: str = "text", item_key: str = "item_id",
            block_words: int = BLOCK_WORDS) -> DataFrame:
    """``key``, ``text``, ``n_words``, ``spans``, ``items`` and ``longest`` of every document.

    ``spans`` are the hit stretches of words, [first, end), in order and apart; ``items``
    the ids, as strings in order, of items with a window in the document; ``longest`` the
    longest match that hits. Texts of documents and items are taken as ``normalised``
    words. A null or empty text has no words. An item without words has no window; one
    without an id hits, but is not listed; of repeated ids all texts count and the id is
    listed once. Repeated documents give repeated results, a null key stays null; other
    columns play no part. Without documents there are no rows, without items no hits.
    """
    blocks, count = _blocks(items, item_text, item_key, window, block_words)
    spark = docs.sparkSession
    schema = pa.schema([
        ("key", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()),
        ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string())),
        ("longest", pa.int64())])

    def through(name: str, shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(name, shared, window)
            for batch in batches:
                for part in pieces(batch, "text", STEP_BYTES):
                    rows = []
                    for text_, spans, held, longest in zip(*(part.column(c).to_pylist() for c in (
                            "text", "spans", "items", "longest"))):
                        words = normalised(text_ or "")
                        hit, found, length = automaton.matches(words)
                        found.discard(None)
                        rows.append((len(words), _merged(spans, hit),
                                     sorted(found.union(held)), max(longest, length)))
                    columns = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("key"), part.column("text"),
                         *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[2:]))],
                        schema=schema)
        return run

    held = docs.select(
        F.col(key).cast("long").alias("key"), F.col(text).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<array<bigint>>").alias("spans"),
        F.array().cast("array<string>").alias("items"), F.lit(0).cast("long").alias("longest"))
    for block in range(count):
        # one block at a time, of a bounded number of words
        rows = blocks.where(F.col("block") == block).select("item", "words").collect()
        shared = spark.sparkContext.broadcast(
            [(r["item"], bytes(r["words"]).split()) for r in rows])
        held = held.mapInArrow(through(uuid.uuid4().hex, shared), held.schema)
        if count > 1:
            held = written(held, "benchmark-matches")
    return held.withColumnRenamed("key", key).withColumnRenamed("text", text)


def _hit_words(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"),
                       lambda n, s: n + F.get(s, F.lit(1)) - F.get(s, F.lit(0)))


def _without(text: str, spans: list[list[int]]) -> str:
    """The text without the given stretches of words and the space around their ends."""
    data = text.encode("utf-8", "surrogatepass")
    word = np.frombuffer(data.translate(_BYTES), np.uint8) != 32
    edges = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    kept, at = [], 0
    for first, end in spans:
        kept.append(data[at:begins[first]].rstrip())
        at = ends[end - 1]
    kept.append(data[at:].lstrip())
    return b" ".join(k for k in kept if k).decode("utf-8", "surrogatepass")


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                   coverage: float = 0.5, text: str = "text", key: str = "doc_id",
                   **options) -> DataFrame:
    """``key`` and ``text`` of the documents without the passages of ``items``.

    Matches of ``window`` words or more (whole items, if shorter) are cut out of the text.
    A document of which they cover over ``coverage`` of the words goes as a whole. Texts
    without a match stay as they are; a null text stays null. Other cases are as in
    ``matches``, whose ``options`` are taken.
    """
    found = matches(docs, items, window, text, key, **options)
    left = found.where(_hit_words() <= F.lit(coverage) * F.col("n_words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if not s else _without(t, s) for t, s in
                     zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             [key, text])

    rows = left.select(key, text, "spans")
    return rows.mapInArrow(run, rows.drop("spans").schema)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document its words, hit words, items found, their digest, and whether any is hit.

    Nulls, repeated rows and empty tables are as in ``matches``.
    """
    n_hit = _hit_words()
    return matches(docs, items).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))
