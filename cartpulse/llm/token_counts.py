"""Token counts from the frequencies of pre-tokens, without ids of the documents.

Documents are taken in blocks. A block keeps its distinct pre-tokens once and, for
every document, how often it has each of them. Over the whole table each distinct
pre-token is sent to one task, which counts its pieces once; the answers go back to
the blocks that asked, are joined to the frequencies there and summed. Both ways
the rows are one per block and distinct pre-token, so they grow with the blocks,
and the most frequent pre-token has one row per block like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.bpe import Vocabulary, vocabulary
from cartpulse.llm.frames import pieces, strings, written
from cartpulse.llm.pretokens import distinct_slices

#: Bytes of text in a block, where a task has as many.
BLOCK_BYTES = 32_000_000
#: Bytes of text that are split into pre-tokens at a time; longer texts go alone.
STEP_BYTES = 4_000_000

_ROWS = ("kind string, block long, doc_id long, n_bytes long, special long, "
         "slots binary, counts binary, word binary, slot int")


def _packed(numbers: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Each stretch of numbers as bytes: all lowest bytes first, which compress well."""
    numbers = numbers.astype("<u4")
    return [numbers[a:b].view(np.uint8).reshape(-1, 4).T.tobytes()
            for a, b in zip(bounds.tolist(), bounds[1:].tolist())]


def _unpacked(raw: pa.Scalar) -> np.ndarray:
    planes = np.frombuffer(raw.as_buffer(), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class _Block:
    """Documents that share one numbering of their pre-tokens, in order of appearance."""

    def __init__(self, number: int, known: Vocabulary):
        self.number, self.known = number, known
        self.slots: dict[bytes, int] = {}
        self.n_bytes = 0

    def add(self, batch: pa.RecordBatch, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """A row for each document, and one for each pre-token that is new to the block."""
        texts = strings(batch, "text")
        plain, owner, after = self.known.parts(texts)
        found = self.known.pretokens(plain)
        data = found.data.tobytes()
        before = len(self.slots)
        new: list[bytes] = []
        number = np.empty(len(found.starts), dtype=np.int64)
        for i, (a, n) in enumerate(zip(found.starts.tolist(), found.lengths.tolist())):
            word = data[a:a + n]
            slot = self.slots.get(word)
            if slot is None:
                slot = self.slots[word] = before + len(new)
                new.append(word)
            number[i] = slot
        holder = np.repeat(np.array(owner, dtype=np.int64), np.diff(found.bounds))
        pairs = np.sort((holder << 32) | number[found.codes])
        at = np.flatnonzero(np.diff(pairs, prepend=-1))
        times = np.diff(np.append(at, len(pairs)))
        pairs = pairs[at]
        bounds = np.searchsorted(pairs >> 32, np.arange(len(texts) + 1))
        slots = pairs & 0xFFFFFFFF
        gaps = np.diff(slots, prepend=0)
        heads = bounds[:-1][np.diff(bounds) > 0]
        gaps[heads] = slots[heads]   # gaps within a document
        special = np.bincount(np.array(owner)[np.array(after) >= 0], minlength=len(texts))
        n_bytes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
        self.n_bytes += sum(n_bytes)
        yield self._rows("document", len(texts), schema, {
            "doc_id": batch.column("key").cast(pa.int64()),
            "n_bytes": pa.array(n_bytes, pa.int64()), "special": pa.array(special, pa.int64()),
            "slots": pa.array(_packed(gaps, bounds), pa.binary()),
            "counts": pa.array(_packed(times, bounds), pa.binary())})
        yield self._rows("word", len(new), schema, {
            "word": pa.array(new, pa.binary()),
            "slot": pa.array(np.arange(before, before + len(new), dtype=np.int32))})

    def _rows(self, kind: str, size: int, schema: pa.Schema, columns: dict) -> pa.RecordBatch:
        columns |= {"kind": pa.array([kind] * size, pa.string()),
                    "block": pa.array([self.number] * size, pa.int64())}
        return pa.RecordBatch.from_arrays(
            [columns.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)


def frequencies(docs: DataFrame, file: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of two kinds: per document its pre-token frequencies by slot, and per
    block and slot the pre-token itself. A block lies within one task."""
    schema = pa.schema([
        ("kind", pa.string()), ("block", pa.int64()), ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()), ("special", pa.int64()), ("slots", pa.binary()),
        ("counts", pa.binary()), ("word", pa.binary()), ("slot", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = _Block(number, vocabulary(file))
        for batch in batches:
            for part in pieces(batch, "text", STEP_BYTES):
                if block.n_bytes >= block_bytes:
                    number += 1
                    block = _Block(number, block.known)
                yield from block.add(part, schema)

    return docs.mapInArrow(run, _ROWS)


def piece_counts(words: DataFrame, file: str) -> DataFrame:
    """(block, slot, n): the pieces of each row's word, counted once per distinct word.

    Equal words meet in one partition, in a row; only a word that goes on from one
    Arrow batch to the next is counted again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(file)
        for batch in batches:
            held = batch.column("word").to_pylist()
            lengths = np.fromiter(map(len, held), np.int64, len(held))
            data = b"".join(held)
            starts = np.cumsum(lengths) - lengths
            codes, first = distinct_slices(data + bytes(8), starts, lengths)
            merged = known.merge(np.frombuffer(data, np.uint8), starts[first], lengths[first])
            n = np.diff(merged.bounds)[codes].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("slot"), pa.array(n)],
                ["block", "slot", "n"])

    return (words.repartition("word").sortWithinPartitions("word")
            .mapInArrow(run, "block long, slot int, n int"))


def _sums(documents: pa.Table, answers: pa.Table) -> pa.Table:
    slots = answers.column("slot").to_numpy()
    pieces_of = np.zeros(len(slots), dtype=np.int64)
    pieces_of[slots] = answers.column("n").to_numpy()
    totals = []
    for gaps, times in zip(documents.column("slots"), documents.column("counts")):
        totals.append(int(pieces_of[np.cumsum(_unpacked(gaps))] @ _unpacked(times)))
    totals = pa.array(totals, pa.int64())
    return pa.table({"doc_id": documents.column("doc_id"), "n_bytes": documents.column("n_bytes"),
                     "n_tokens": pc.add(totals, documents.column("special"))})


def token_counts(docs: DataFrame, file: str, text: str = "text", key: str = "doc_id",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every whole text.

    A null text counts as empty: 0 bytes, 0 tokens. Special strings inside texts
    count as one token each. Repeated rows give repeated results; other columns play
    no part; an empty table gives no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    held = written(frequencies(rows, file, block_bytes), "token-counts", "kind")
    documents = held.where("kind = 'document'").select(
        "block", "doc_id", "n_bytes", "special", "slots", "counts")
    words = held.where("kind = 'word'").select("word", "block", "slot")
    counted = documents.groupBy("block").cogroup(
        piece_counts(words, file).groupBy("block")).applyInArrow(
            _sums, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumnRenamed("doc_id", key)


def token_budget(docs: DataFrame, file: str, limit: int = 2048) -> DataFrame:
    """``token_counts`` and whether a document has more than ``limit`` tokens."""
    return token_counts(docs, file).withColumn("over_limit", F.col("n_tokens") > limit)
