"""Packing of documents into fixed windows, with a bounded number of open windows.

Each task takes its documents in order. Full windows are cut off a long document;
what remains goes into the fullest open window that still has room. When none has,
a new window is opened, and if that makes too many, the fullest one is emitted. Every
task ends with at most ``open_windows`` windows that are not full. These leftovers are
then merged in rounds: in every round many small groups of leftovers are packed by the
same rule, until one group is left, so no task ever holds more than one group.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.bpe import STEP_BYTES, vocabulary
from cartpulse.llm.frames import pieces, strings, written

WINDOW = 4096
OPEN_WINDOWS = 64
#: Leftover windows that one task merges in a round.
GROUP = 16_384


class OpenWindows:
    """A fixed number of open windows, kept in order of their fill."""

    def __init__(self, window: int, most: int):
        self.window, self.most = window, most
        self.fills: list[tuple[int, int]] = []  # (fill, window number), ascending
        self.opened = 0

    def place(self, size: int) -> tuple[int, int]:
        """The window and the offset in it of the next ``size`` tokens."""
        at = bisect.bisect_right(self.fills, (self.window - size, self.opened)) - 1
        if at >= 0:
            fill, number = self.fills.pop(at)
        else:
            fill, number = 0, self.opened
            self.opened += 1
        if fill + size < self.window:
            bisect.insort(self.fills, (fill + size, number))
            if len(self.fills) > self.most:
                self.fills.pop()  # the fullest is emitted
        return number, fill


PLACED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "window_id long, offset long, fill long, leftover boolean")


def _place(docs: DataFrame, file: str, end_id: int, window: int, most: int) -> DataFrame:
    """Pieces with the window each lies in; leftover windows are marked by a row of
    their own, which has a fill and no document."""
    schema = pa.schema([(n, pa.bool_() if t == "boolean" else pa.int64())
                        for n, t in (c.split() for c in PLACED.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        known, windows = vocabulary(file), OpenWindows(window, most)
        for batch in batches:
            for part in pieces(batch, "text", STEP_BYTES):
                encoded = known.encode(strings(part, "text"))
                rows = []
                keys = part.column("key").to_pylist()
                bounds = encoded.bounds.tolist()
                for key, a, b in zip(keys, bounds, bounds[1:]):
                    ids = np.append(encoded.ids[a:b], end_id).astype("<u4")
                    for start in range(0, len(ids), window):
                        cut = ids[start:start + window]
                        number, offset = windows.place(len(cut))
                        rows.append((key, start, len(cut), zlib.crc32(cut.tobytes()), len(ids),
                                     base + number, offset, None, False))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        rest = [(None, None, None, None, None, base + number, None, fill, True)
                for fill, number in windows.fills]
        if rest:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rest), schema)], schema=schema)

    return docs.mapInArrow(run, PLACED)


def _merge_group(window: int, most: int, last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """The leftovers of one group packed anew; each takes the id of the first in it."""
        rows = rows.sort_values(["fill", "window_id"], ascending=[False, True],
                                ignore_index=True)
        windows = OpenWindows(window, len(rows) if last else most)
        placed = [windows.place(fill) for fill in rows["fill"]]
        number = np.array([p[0] for p in placed])
        first = rows["window_id"].to_numpy()[np.unique(number, return_index=True)[1]]
        still = np.isin(number, [n for _, n in windows.fills])
        total = np.bincount(number, rows["fill"]).astype(np.int64)
        return pd.DataFrame({
            "window_id": rows["window_id"], "into": first[number],
            "shift": [p[1] for p in placed], "open": still, "total": total[number]})
    return run


def _merged(leftovers: DataFrame, window: int, most: int, group: int) -> DataFrame:
    """(window_id, into, shift): where each leftover window finally lies."""
    moves = leftovers.select("window_id", F.col("window_id").alias("into"),
                             F.lit(0).cast("long").alias("shift"))
    heads = leftovers.select("window_id", "fill")
    count = heads.count()
    while True:
        groups = -(-count // group)
        dealt = heads.withColumn("bin", F.pmod(F.xxhash64("window_id"), F.lit(max(groups, 1))))
        step = written(dealt.groupBy("bin").applyInPandas(
            _merge_group(window, most, groups <= 1),
            "window_id long, into long, shift long, open boolean, total long"), "packing-merge")
        after = step.select(F.col("window_id").alias("into"), F.col("into").alias("next"),
                            F.col("shift").alias("more"))
        moves = written(moves.join(after, "into", "left").select(
            "window_id", F.coalesce("next", "into").alias("into"),
            (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")), "packing-moves")
        if groups <= 1:
            return moves
        heads = written(step.where("open").groupBy("into").agg(F.max("total").alias("fill"))
                        .select(F.col("into").alias("window_id"), "fill"), "packing-open")
        left = heads.count()
        if left > count // 2:  # the windows are nearly full: larger groups gain nothing
            return moves
        count = left


def pack(docs: DataFrame, file: str, end_id: int = 2, window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, group: int = GROUP, text: str = "text",
         key: str = "doc_id") -> DataFrame:
    """Pieces of all documents and the place of each in a sequence of ``window`` tokens.

    A document is its ids and then ``end_id``, so a null or empty text is one token.
    Only documents longer than a window are cut, into whole windows and a rest. Returns
    ``key``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and
    ``offset``. Repeated rows are packed each; other columns play no part; an empty
    table gives no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    placed = written(_place(rows, file, end_id, window, open_windows), "packing", "leftover")
    leftovers = placed.where("leftover").select("window_id", "fill")
    moves = _merged(leftovers, window, open_windows, group)
    return (placed.where("not leftover").join(moves, "window_id", "left").select(
        F.col("doc_id").alias(key), "start", "length", "ids_crc32", "doc_tokens",
        F.coalesce("into", "window_id").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")))
