"""Near-duplicates among vectors through a pivot-permutation index.

A vector is described by the pivots nearest to it, and stands in the inverted list of each
of them. Pivots lie apart from one another, by more than twice the angle of a link, so that
a group of copies, however large, does not get pivots of its own to be torn apart by. Two
vectors of one label are candidates if they share at least ``SHARED`` of their ``PREFIX``
nearest pivots; they are compared in the list of the first pivot they share, and only
there. A list that many vectors stand in is cut into slots that meet in pairs, so no list
is too long for a task. A meeting returns counts and a spanning forest, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.components import components
from cartpulse.llm.frames import written
from cartpulse.llm.vectors import directions, matrix, units

THRESHOLD = 0.98
#: Nearest pivots of a vector, and how many of them candidates share. Of pairs at the
#: threshold under one in 20,000 share fewer (8 and 64 dimensions, 64 to 450 pivots).
PREFIX = 8
SHARED = 2
#: Pivots, at most, and the rows that they are taken from, by the smallest hashes.
PIVOTS = 256
SAMPLE = 2048
#: Fewer pivots tell nothing apart: then all vectors of a label are one list.
LEAST_PIVOTS = 4 * PREFIX
#: Vectors of a slot, on average at most.
PART = 4096
_ROWS_AT_ONCE = 256
#: Cosines nearer to the threshold than this are summed anew, in one order for both sides.
_CLOSE = 1e-9


def _pivots(vectors: DataFrame, threshold: float, most: int = PIVOTS) -> dict[int, np.ndarray]:
    """Unit pivots by vector length, for the 16 most frequent lengths: rows spread over all
    by a hash, of which those near an earlier one are left out."""
    apart = np.cos(2.2 * np.arccos(np.clip(threshold, -1, 1)))
    found: dict[int, np.ndarray] = {}
    sizes = [r.size for r in vectors.groupBy(F.size("embedding").alias("size")).count()
             .orderBy(F.desc("count"), "size").limit(16).collect()]
    for size in sizes:
        rows = vectors.where(F.size("embedding") == size).select("embedding").orderBy(
            F.xxhash64("key"), "key").limit(SAMPLE).collect()
        kept = np.empty((0, size))
        for row in units(np.array([r.embedding for r in rows])):
            if len(kept) < most and not (kept @ row > apart).any():
                kept = np.vstack([kept, row])
        if len(kept) >= LEAST_PIVOTS:
            found[size] = kept
    return found


def described(rows: np.ndarray, pivots: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivots of each row in order of nearness, and the same as bits."""
    if pivots is None:
        # two pivots that everything shares
        nearest = np.tile(np.arange(SHARED), (len(rows), 1))
    else:
        angle = -(rows @ pivots.T)
        nearest = np.argpartition(angle, PREFIX, axis=1)[:, :PREFIX]
        nearest = np.take_along_axis(nearest, np.argsort(
            np.take_along_axis(angle, nearest, axis=1), axis=1), axis=1)
    bits = np.zeros((len(rows), PIVOTS), dtype=np.uint8)
    np.put_along_axis(bits, nearest, 1, axis=1)
    return nearest, np.packbits(bits, axis=1, bitorder="little")


def _place(known: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                some = batch.filter(pa.array(sizes == size))
                rows = units(matrix(some.column("embedding")))
                nearest, bits = described(rows, known.get(int(size)))
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(c) for c in ("label", "size", "node", "copies")),
                     pa.array([r.tobytes() for r in rows], pa.binary()),
                     pa.array(nearest.tolist(), pa.list_(pa.int32())),
                     pa.array([r.tobytes() for r in bits], pa.binary())],
                    ["label", "size", "node", "copies", "vector", "nearest", "bits"])
    return run


def _side(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    vectors, bits = (b"".join(rows.column(c).to_pylist()) for c in ("vector", "bits"))
    return (rows.column("node").to_numpy(), rows.column("copies").to_numpy().astype(np.float64),
            np.frombuffer(vectors).reshape(len(rows), -1),
            np.frombuffer(bits, "<u8").reshape(len(rows), -1))


def _sharing(one: np.ndarray, two: np.ndarray, pivot: int) -> np.ndarray:
    """Which pairs of rows of a pivot's list share that pivot first, and enough others."""
    low = np.zeros((len(one), len(two)), dtype=np.uint64)
    count = np.zeros(low.shape, dtype=np.uint8)
    for word in range(one.shape[1]):
        # where few rows have a bit of this word, most of the work is zero
        shared = one[:, word, None] & two[:, word]
        count += np.bitwise_count(shared)
        begin = pivot - 64 * word
        if begin > 0:
            low |= shared & np.uint64((1 << min(begin, 64)) - 1)
    return (low == 0) & (count >= SHARED)


def compared(pivot: int, left: tuple, right: tuple | None,
             threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, links, other) of the rows of a meeting that link: how many rows each links
    with there, and the first node of its group. Without ``right``, a slot meets itself."""
    alone = right is None
    one, times, ours, bits = left
    two, theirs_times, theirs, their_bits = left if alone else right
    nodes = one if alone else np.concatenate([one, two])
    behind = 0 if alone else len(one)
    parent, links = np.arange(len(nodes)), np.zeros(len(nodes))
    for at in range(0, len(one), _ROWS_AT_ONCE):
        over = min(at + _ROWS_AT_ONCE, len(one))
        hits = _sharing(bits[at:over], their_bits, pivot)
        if alone:
            hits[np.arange(over - at), np.arange(at, over)] = False
        if not hits.any():
            continue
        part = ours[at:over]
        near = part @ theirs.T
        close = hits & (np.abs(near - threshold) < _CLOSE)
        hits &= near >= threshold
        a, b = np.nonzero(close)
        hits[a, b] = np.einsum("ij,ij->i", part[a], theirs[b]) >= threshold
        if not hits.any():
            continue
        links[at:over] += hits @ theirs_times
        if not alone:
            links[behind:] += times[at:over] @ hits
        a, b = np.nonzero(hits & (parent[at:over, None] != parent[behind:]))
        a, b = a + at, b + behind
        while True:
            low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
            open_ = low != high
            if not open_.any():
                break
            a, b = a[open_], b[open_]
            np.minimum.at(parent, high[open_], low[open_])
            while not np.array_equal(further := parent[parent], parent):
                parent = further
    found = np.flatnonzero(links)
    return nodes[found], links[found].astype(np.int64), nodes[parent[found]]


def _meet(threshold: float):
    """Rows sorted by meeting and side; one meeting is held at a time."""
    def answer(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        side = table.column("side").to_numpy()
        cut = int(np.searchsorted(side, 2))
        left = _side(table.slice(0, cut))
        pivot, one, two = (table.column(c)[0].as_py() for c in ("pivot", "one", "two"))
        found = compared(pivot, left, None if one == two else _side(table.slice(cut)), threshold)
        return pa.RecordBatch.from_arrays(list(map(pa.array, found)), ["node", "links", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meeting, held = None, []
        for batch in batches:
            ids = batch.column("meeting").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and ids[a] != meeting:
                    yield answer(held)
                    held = []
                meeting = ids[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield answer(held)
    return run


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD, part: int = PART,
                    key: str = "vec_id", vector: str = "embedding",
                    label: str = "label") -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Rows link if their labels are equal and not null, their vectors have one length and
    their cosine is at least ``threshold``. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing. ``n_links`` counts linked rows with
    another key; ``component_id`` is the smallest key reached. A row without a key has
    neither and is kept. Repeated rows give repeated results and count once as partners;
    other columns play no part; an empty table gives no rows.
    """
    everything = written(table.select(
        F.col(key).cast("long").alias("key"), F.col(vector).alias("embedding"),
        F.col(label).cast("string").alias("label")), "pivots-rows")
    rows = directions(everything, "key", "embedding", "label").where("label is not null").distinct()
    rows = written(rows, "pivots-vectors")
    # equal vectors are one node, named by the smallest key
    nodes = written(rows.groupBy("label", "embedding").agg(
        F.min("key").alias("node"), F.count("*").alias("copies")), "pivots-nodes")
    known = _pivots(rows, threshold)
    of_list = ["label", "size", "pivot"]
    placed = written(
        nodes.select("label", F.size("embedding").alias("size"), "node", "copies", "embedding")
        .mapInArrow(_place(known), "label string, size int, node long, copies long, "
                    "vector binary, nearest array<int>, bits binary"), "pivots-placed")
    lists = placed.select("*", F.explode("nearest").alias("pivot")).drop("nearest")
    slots = written(lists.groupBy(*of_list).agg(F.ceil(F.count("*") / part).alias("slots")),
                    "pivots-lists")
    dealt = lists.join(slots, of_list).withColumn(
        "slot", F.pmod(F.xxhash64("node"), F.col("slots")))
    # a slot meets itself and every other one of its list
    meetings = dealt.withColumn("with", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("slots") - 1))).select(
        *of_list, F.least("slot", "with").alias("one"), F.greatest("slot", "with").alias("two"),
        F.when(F.col("slot") <= F.col("with"), 1).otherwise(2).alias("side"),
        "node", "copies", "vector", "bits")
    keys = [*of_list, "one", "two"]
    # the number only tells a meeting from its neighbours in the sort
    numbered = (meetings.repartition(*keys).sortWithinPartitions(*keys, "side")
                .withColumn("meeting", F.xxhash64(*keys)))
    found = written(numbered.select("meeting", "pivot", "one", "two", "side", "node", "copies",
                                    "vector", "bits")
                    .mapInArrow(_meet(threshold), "node long, links long, other long"),
                    "pivots-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    by_node = written(nodes.select("label", "embedding", "node", "copies")
                      .join(counts, "node", "left")
                      .join(groups.withColumnRenamed("component", "group"), "node", "left")
                      .select("label", "embedding",
                              (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                              F.coalesce("group", "node").alias("group")), "pivots-named")
    # an invalid vector or a null label finds no node
    ours = everything.withColumn("cast", F.col("embedding").cast("array<double>"))
    joined = ours.join(by_node.withColumnRenamed("embedding", "cast"), ["label", "cast"], "left")
    is_row = F.col("key").isNotNull()
    group = F.when(is_row, F.coalesce("group", "key"))
    return joined.select(
        F.col("key").alias(key), F.when(is_row, F.coalesce("links", F.lit(0))).alias("n_links"),
        group.alias("component_id"), (~is_row | (group == F.col("key"))).alias("kept"))
