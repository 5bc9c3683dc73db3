"""Byte-pair encoding and decoding in rounds over many words at once.

All symbols of many words lie in one flat array. In each round the ranks of
neighbouring pairs come from a binary search over the sorted pair keys, every word
takes its lowest rank, and all places of that pair are merged from left to right.
Words without a known pair leave the round. This gives the ids of the public
library, as a merge only ever makes pairs of higher rank than its own.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartpulse.llm.frames import pieces, strings
from cartpulse.llm.pretokens import Pretokens, split, spread

NO_RANK = np.int32(2**31 - 1)
#: Bytes of text that one step of a task takes at a time; longer texts go alone.
STEP_BYTES = 8_000_000
# Latin letters without combining marks: composed already, lower case as ever.
_SETTLED = re.compile("[\x00-\u024f]*")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Encoded(NamedTuple):
    """Ids of many texts: text i has ids[bounds[i]:bounds[i + 1]]."""

    ids: np.ndarray
    bounds: np.ndarray


class Vocabulary:
    """A byte-level vocabulary read from a tokenizer file."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        ids: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.style = "words" if end else "bytes"
        self.specials = {t["content"]: t["id"] for t in told["added_tokens"] if t["special"]}
        # at one place the smaller string counts
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials)))) \
            if self.specials else None
        self.normalizer = Tokenizer.from_file(file).normalizer
        self.size = max([*ids.values(), *self.specials.values()]) + 1
        self.single = np.array([ids[c] for c in letters], dtype=np.int32)
        self.final = np.array([ids[c + end] for c in letters], dtype=np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([ids[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], dtype=np.int32)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        byte_of = {c: b for b, c in enumerate(letters)}
        shown = [b""] * self.size
        for token, number in ids.items():
            word = token[:-len(end)] if end and token.endswith(end) else token
            shown[number] = bytes(byte_of[c] for c in word) + (b" " if word != token else b"")
        for token, number in self.specials.items():
            shown[number] = token.encode()
        self.width = np.array([len(s) for s in shown], dtype=np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.width)[:-1]])
        self.shown = np.frombuffer(b"".join(shown), np.uint8)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def merge(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Encoded:
        """The ids of the words ``data[starts[i]:starts[i] + lengths[i]]``, all non-empty."""
        n = len(starts)
        if not n:
            return Encoded(np.zeros(0, np.int32), np.zeros(1, np.int64))
        flat = data[spread(starts, lengths)]
        symbols = self.single[flat]
        heads = np.cumsum(lengths) - lengths
        symbols[heads + lengths - 1] = self.final[flat[heads + lengths - 1]]
        rank = np.append(self.rank(symbols[:-1], symbols[1:]), NO_RANK)
        rank[heads + lengths - 1] = NO_RANK
        words, sizes = np.arange(n), lengths.copy()
        done = []
        while len(words):
            heads = np.cumsum(sizes) - sizes
            low = np.minimum.reduceat(rank, heads)
            live = low != NO_RANK
            if not live.all():
                stay = np.repeat(live, sizes)
                done.append((words[~live], sizes[~live], symbols[~stay]))
                words, sizes, low = words[live], sizes[live], low[live]
                symbols, rank = symbols[stay], rank[stay]
                if not len(words):
                    break
            hit = np.flatnonzero(rank == np.repeat(low, sizes))
            # a pair of equal symbols can overlap itself: take every second of a run
            order = np.arange(len(hit))
            apart = np.ones(len(hit), dtype=bool)
            apart[1:] = hit[1:] != hit[:-1] + 1
            hit = hit[(order - np.maximum.accumulate(np.where(apart, order, 0))) % 2 == 0]
            symbols[hit] = self.made[rank[hit]]
            ends_word = rank[hit + 1] if len(hit) else hit
            rank[hit] = ends_word
            gone = np.zeros(len(symbols), dtype=bool)
            gone[hit + 1] = True
            owner = np.repeat(np.arange(len(words)), sizes)
            last = np.zeros(len(symbols), dtype=bool)
            last[np.cumsum(sizes) - 1] = True
            sizes = sizes - np.bincount(owner[hit], minlength=len(words))
            moved = hit - np.arange(len(hit))
            stay = ~gone
            symbols, rank = symbols[stay], rank[stay]
            tails = np.cumsum(sizes) - 1
            touched = np.unique(np.concatenate([moved, moved[moved > 0] - 1]))
            touched = touched[touched < len(symbols) - 1]
            rank[touched] = self.rank(symbols[touched], symbols[touched + 1])
            rank[tails] = NO_RANK
        words = np.concatenate([d[0] for d in done])
        sizes = np.concatenate([d[1] for d in done])
        symbols = np.concatenate([d[2] for d in done])
        counts = np.empty(n, dtype=np.int64)
        counts[words] = sizes
        bounds = np.concatenate([[0], np.cumsum(counts)])
        ids = np.empty(len(symbols), dtype=np.int32)
        ids[spread(bounds[words], sizes)] = symbols
        return Encoded(ids, bounds)

    def parts(self, texts: list[str]) -> tuple[list[str], list[int], list[int]]:
        """Stretches between special strings, the text of each, and the special id
        after each (-1: none)."""
        plain, owner, after = [], [], []
        for number, text in enumerate(texts):
            at = 0
            for found in self.special.finditer(text) if self.special else ():
                plain.append(text[at:found.start()])
                owner.append(number)
                after.append(self.specials[found[0]])
                at = found.end()
            plain.append(text[at:])
            owner.append(number)
            after.append(-1)
        return plain, owner, after

    def ready(self, text: str) -> str:
        """``text`` as the file's normalizer leaves it, white space aside."""
        if self.style == "bytes" or not text:
            return text
        if _SETTLED.fullmatch(text):
            return text.lower()
        return self.normalizer.normalize_str(text)

    def pretokens(self, texts: list[str]) -> Pretokens:
        return split([self.ready(t) for t in texts], self.style)

    def encode(self, texts: list[str]) -> Encoded:
        """The ids of whole texts, special strings inside them recognised."""
        plain, owner, after = self.parts(texts)
        found = self.pretokens(plain)
        words = self.merge(found.data, found.starts, found.lengths)
        sizes = np.diff(words.bounds)
        per = sizes[found.codes]
        ids = words.ids[spread(words.bounds[:-1][found.codes], per)]
        bounds = np.concatenate([[0], np.cumsum(per)])[found.bounds]
        if len(plain) > len(texts):
            special = np.array(after)
            marked = special >= 0
            ids = np.insert(ids, bounds[1:][marked], special[marked])
            bounds = bounds + np.concatenate([[0], np.cumsum(marked)])
            last = np.append(np.flatnonzero(np.diff(owner)), len(owner) - 1)
            bounds = np.concatenate([[0], bounds[1:][last]])
        return Encoded(ids, bounds)

    def decode(self, encoded: Encoded) -> list[str]:
        """The texts of ids; bytes that are no UTF-8 read as U+FFFD."""
        width = self.width[encoded.ids]
        raw = self.shown[spread(self.places[encoded.ids], width)].tobytes()
        bounds = np.concatenate([[0], np.cumsum(width)])[encoded.bounds].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]


@functools.cache
def vocabulary(file: str) -> Vocabulary:
    return Vocabulary(file)


def encode_decode(docs: DataFrame, file: str, text: str = "text",
                  key: str = "doc_id") -> DataFrame:
    """Ids of every text and the text that they decode to.

    Returns ``key``, ``n_tokens``, ``ids`` (binary: little-endian unsigned 32-bit)
    and ``decoded``. A null text counts as empty and gives no ids; repeated rows give
    repeated results; other columns play no part; an empty table gives no rows.
    Each text is encoded whole. Rows do not move between tasks.
    """
    out = pa.schema([("key", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()),
                     ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(file)
        for batch in batches:
            for part in pieces(batch, "text", STEP_BYTES):
                encoded = known.encode(strings(part, "text"))
                raw = encoded.ids.astype("<u4").tobytes()
                bounds = encoded.bounds.tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").cast(pa.int64()), pa.array(np.diff(encoded.bounds)),
                     pa.array([raw[4 * a:4 * b] for a, b in zip(bounds, bounds[1:])],
                              pa.binary()),
                     pa.array(known.decode(encoded), pa.string())], schema=out)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    made = rows.mapInArrow(run, "key long, n_tokens long, ids binary, decoded string")
    return made.withColumnRenamed("key", key)


def encode(docs: DataFrame, file: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``encode_decode`` without the decoded text."""
    return encode_decode(docs, file, text, key).drop("decoded")


def decode(encoded: DataFrame, file: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """``key`` and ``decoded``, the text of the binary ``ids`` (null: empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(file)
        for batch in batches:
            for part in pieces(batch, "ids", STEP_BYTES):
                held = [v or b"" for v in part.column("ids").to_pylist()]
                bounds = np.cumsum([0, *map(len, held)]) // 4
                texts = known.decode(Encoded(np.frombuffer(b"".join(held), "<u4"), bounds))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(texts, pa.string())], ["key", "decoded"])

    rows = encoded.select(F.col(key).cast("long").alias("key"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, "key long, decoded string").withColumnRenamed("key", key)


def roundtrip_digests(docs: DataFrame, file: str) -> DataFrame:
    """Per document, the number of ids and digests of the ids and of the decoded text."""
    return encode_decode(docs, file).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
