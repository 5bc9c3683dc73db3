"""Approximate nearest neighbours by cosine: an NN-descent graph and greedy search.

Equal vectors are one node. A first graph comes from leaves of random hyperplanes, in
which all vectors are compared. Then, round by round, every node sends itself to all its
neighbours in either direction, and the neighbours that meet at a node are compared with
each other: neighbours of neighbours. Pairs nearer than a node's worst neighbour
replace it, until a round changes few neighbours. Vectors travel as a centre near them and
8-bit numbers for the way from there, so that near but different ones stay apart.

A query starts from its own node and expands the nearest nodes found so far, some at a
time, until the nearest ones have all been expanded. What it ends with is scored anew from
the original vectors in double precision.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartpulse.llm.frames import written
from cartpulse.llm.vectors import directions, matrix, units, whole_runs

NEIGHBOURS = 36
TREES = 8
LEAF = 800
#: Neighbours that a leaf proposes for each of its nodes.
PROPOSED = 16
#: Rounds end when at most this share of all neighbours is new.
SETTLED = 0.01
#: Neighbours that meet at a node at a time; those of a hub meet in several groups.
MEETING = 256
#: Nodes that a query keeps, all of them scored anew in the end, and how many of them, the
#: nearest, it expands.
BEAM = 128
EXPANDED = 64
#: Directions that codes start from, and the bytes of a code before its numbers.
CENTRES = 256
HEAD = 6
_LIST = "node long, ids array<long>, sims array<float>"


def _centres(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Some directions by vector length, for the 16 most frequent lengths, spread over all
    rows by a hash."""
    sizes = [r.size for r in vectors.groupBy(F.size("embedding").alias("size")).count()
             .orderBy(F.desc("count"), "size").limit(16).collect()]
    return {size: units(np.array([r.embedding for r in vectors.where(
        F.size("embedding") == size).select("embedding").orderBy(
        F.xxhash64("key"), "key").limit(CENTRES).collect()])) for size in sizes}


def coded(rows: np.ndarray, centres: np.ndarray | None) -> np.ndarray:
    """Directions as bytes: the nearest centre, and the way from there in 8-bit numbers
    that are stretched to the full range, so that near vectors stay apart."""
    rows = units(rows.astype(np.float64))
    if centres is None:
        centres = np.zeros((1, rows.shape[1]))
    near = (rows @ centres.T).argmax(axis=1)
    rest = rows - centres[near]
    scale = np.abs(rest).max(axis=1).astype(np.float32)
    steps = np.rint(rest * (127 / np.maximum(scale, 1e-30))[:, None]).astype(np.int8)
    return np.hstack([near.astype("<u2")[:, None].view(np.uint8),
                      scale.astype("<f4")[:, None].view(np.uint8), steps.view(np.uint8)])


def _rows(column: pa.Array | pa.ChunkedArray, centres: dict[int, np.ndarray]) -> np.ndarray:
    held = column.to_pylist()
    codes = np.frombuffer(b"".join(held), np.uint8).reshape(len(held), -1)
    size = codes.shape[1] - HEAD
    near = codes[:, :2].copy().view("<u2")[:, 0]
    scale = codes[:, 2:HEAD].copy().view("<f4")
    base = centres[size] if size in centres else np.zeros((1, size))
    rows = (base[near] + codes[:, HEAD:].view(np.int8) * (scale / 127.0)).astype(np.float32)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, id, sim) of all entries of rows of lists."""
    ids = table.column("ids").combine_chunks()
    sims = table.column("sims").combine_chunks()
    sizes = np.diff(ids.offsets.to_numpy())
    return (np.repeat(table.column("node").to_numpy(), sizes),
            ids.flatten().to_numpy(), sims.flatten().to_numpy())


def nearest_lists(node: np.ndarray, ids: np.ndarray, sims: np.ndarray,
                  most: int) -> pa.RecordBatch:
    """One row per node with its ``most`` nearest different ids, nearest first."""
    order = np.lexsort((ids, -sims, node))
    node, ids, sims = node[order], ids[order], sims[order]
    fresh = np.ones(len(node), dtype=bool)
    fresh[1:] = (node[1:] != node[:-1]) | (ids[1:] != ids[:-1])
    node, ids, sims = node[fresh], ids[fresh], sims[fresh]
    heads = np.flatnonzero(np.diff(node, prepend=node[0] - 1 if len(node) else 0) != 0)
    sizes = np.diff(np.append(heads, len(node)))
    near = np.arange(len(node)) - np.repeat(heads, sizes) < most
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.minimum(sizes, most))]), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(node[heads]), pa.ListArray.from_arrays(offsets, pa.array(ids[near])),
         pa.ListArray.from_arrays(offsets, pa.array(sims[near].astype(np.float32)))],
        ["node", "ids", "sims"])


def _merged(lists: DataFrame, most: int) -> DataFrame:
    """All lists of a node as one, of its ``most`` nearest ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for table in whole_runs(batches, "node", 200_000):
            flat = _flat(table)
            if held is not None and held.column("node")[-1].as_py() == flat[0][0]:
                # the lists of a hub come in parts
                before = _flat(pa.Table.from_batches([held]))
                flat = tuple(map(np.concatenate, zip(before, flat)))
            elif held is not None:
                yield held
            held = nearest_lists(*flat, most)
        if held is not None:
            yield held

    return lists.repartition("node").sortWithinPartitions("node").mapInArrow(run, _LIST)


def _leaf_lists(proposed: int, centres: dict[int, np.ndarray]):
    def run(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        rows = _rows(table.column("code"), centres)
        near = rows @ rows.T
        np.fill_diagonal(near, -2)
        k = min(proposed, len(nodes) - 1)
        if k < 1:
            return pa.table({"node": pa.array([], pa.int64()),
                             "ids": pa.array([], pa.list_(pa.int64())),
                             "sims": pa.array([], pa.list_(pa.float32()))})
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        return pa.Table.from_batches([nearest_lists(
            np.repeat(nodes, k), nodes[best].ravel(),
            np.take_along_axis(near, best, axis=1).ravel(), k)])
    return run


def _first_graph(coded_nodes: DataFrame, count: int, neighbours: int, trees: int,
                 leaf: int, proposed: int, centres: dict[int, np.ndarray]) -> DataFrame:
    depth = max(0, int(np.ceil(np.log2(max(count, 1) / (0.6 * leaf)))))

    def fall(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            lengths = np.array([len(c) - HEAD for c in batch.column("code").to_pylist()])
            for size in np.unique(lengths):   # vectors of different lengths never meet
                part = batch.filter(pa.array(lengths == size))
                rows = _rows(part.column("code"), centres)
                for tree in range(trees):
                    planes = np.random.default_rng([tree, int(size)]).standard_normal(
                        (size, depth)).astype(np.float32)
                    bits = (rows @ planes > 0) @ (1 << np.arange(depth, dtype=np.int64)) \
                        if depth else np.zeros(len(rows), dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), int(size) * trees + tree)), pa.array(bits),
                         part.column("node"), part.column("code")],
                        ["tree", "leaf", "node", "code"])

    fallen = written(coded_nodes.select("node", "code").mapInArrow(
        fall, "tree long, leaf long, node long, code binary"), "nn-leaves")
    sizes = written(fallen.groupBy("tree", "leaf").agg(
        F.ceil(F.count("*") / leaf).alias("parts")), "nn-sizes")
    dealt = fallen.join(sizes, ["tree", "leaf"]).withColumn(
        "part", F.pmod(F.xxhash64("node", "tree"), F.col("parts")))
    lists = dealt.groupBy("tree", "leaf", "part").applyInArrow(
        _leaf_lists(proposed, centres), _LIST)
    return written(_merged(lists, neighbours), "nn-graph")


def _adjacent(graph: DataFrame) -> DataFrame:
    """(node, other): every neighbourship in both directions, once."""
    ahead = graph.select("node", F.explode("ids").alias("other"))
    return ahead.union(ahead.select("other", "node")).distinct()


def _meetings(neighbours: int, centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, "at", MEETING * 64):
            at = table.column("at").to_numpy()
            nodes, worst = table.column("node").to_numpy(), table.column("worst").to_numpy()
            rows = _rows(table.column("code"), centres)
            heads = np.append(np.flatnonzero(np.diff(at, prepend=at[0] - 1)), len(at))
            found = []
            for head, over in zip(heads[:-1].tolist(), heads[1:].tolist()):
                for a in range(head, over, MEETING):
                    b = min(a + MEETING, over)
                    near = rows[a:b] @ rows[a:b].T
                    np.fill_diagonal(near, -2)
                    one, two = np.nonzero(near > worst[a:b, None])
                    found.append((nodes[a:b][one], nodes[a:b][two], near[one, two]))
            flat = [np.concatenate(c) for c in zip(*found)]
            if len(flat[0]):
                yield nearest_lists(*flat, neighbours)
    return run


def neighbour_graph(nodes: DataFrame, centres: dict[int, np.ndarray],
                    neighbours: int = NEIGHBOURS, trees: int = TREES,
                    leaf: int = LEAF, rounds: int | None = None,
                    proposed: int = PROPOSED) -> DataFrame:
    """(node, ids, sims): the nearest nodes found of each of ``nodes`` (node, code).

    Without a number of ``rounds`` there are as many as it takes until at most ``SETTLED``
    of all neighbours are new in one.
    """
    count = nodes.count()
    graph = _first_graph(nodes, count, neighbours, trees, leaf, proposed, centres)
    for done in itertools.count():
        if done == rounds:
            return graph
        worst = F.when(F.size("sims") < neighbours, F.lit(-2.0)).otherwise(
            F.element_at("sims", -1)).cast("float")
        state = graph.select("node", worst.alias("worst")).join(
            nodes.select("node", "code"), "node")
        # a node goes to all its neighbours with its code and its worst similarity
        visits = _adjacent(graph).join(state, "node").select(
            F.col("other").alias("at"), "node", "code", "worst")
        lists = visits.repartition("at").sortWithinPartitions("at").mapInArrow(
            _meetings(neighbours, centres), _LIST)
        before = graph
        graph = written(_merged(graph.unionByName(lists), neighbours), "nn-graph")
        if rounds is None:
            new = graph.join(before.select("node", F.col("ids").alias("old")), "node").agg(
                F.sum(F.size(F.array_except("ids", "old"))).alias("new"),
                F.sum(F.size("ids")).alias("all")).first()
            if not new["new"] or new["new"] <= SETTLED * new["all"]:
                return graph


def _scores(most: int, centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                one = _rows(batch.column("query"), centres)
                two = _rows(batch.column("code"), centres)
                yield nearest_lists(batch.column("node").to_numpy(),
                                    batch.column("other").to_numpy(),
                                    (one * two).sum(axis=1), most)
    return run


def search(starts: DataFrame, graph: DataFrame, nodes: DataFrame,
           centres: dict[int, np.ndarray], expanded: int = EXPANDED, beam: int = BEAM) -> DataFrame:
    """(node, ids, sims): for every node of ``starts`` the nearest ``beam`` nodes that a
    greedy search from it has met; it ends when the nearest ``expanded`` of them have all
    been expanded. ``nodes`` holds (node, code)."""
    around = written(_adjacent(graph).groupBy("node", F.pmod("other", F.lit(8)).alias("share"))
                     .agg(F.collect_list("other").alias("others")), "nn-around")
    codes = nodes.select("node", "code")
    asked = starts.join(codes, "node").select("node", F.col("code").alias("query"))
    frontier = asked.select("node", F.col("node").alias("through"))
    seen = asked.select("node", F.col("node").alias("other"))
    best = done = None
    while True:
        met = (frontier.join(around.select(F.col("node").alias("through"), "others"), "through")
               .select("node", F.explode("others").alias("other")).distinct())
        new = written(met.join(seen, ["node", "other"], "left_anti"), "nn-met")
        scored = new.join(codes.withColumnRenamed("node", "other"), "other") \
            .join(asked, "node").select("node", "other", "query", "code").mapInArrow(
                _scores(beam, centres), _LIST)
        best = written(_merged(scored if best is None else best.unionByName(scored), beam),
                       "nn-best")
        seen = seen.unionByName(new)
        done = frontier if done is None else done.unionByName(frontier)
        nearest_ = best.select("node", F.explode(F.slice("ids", 1, expanded)).alias("through"))
        frontier = written(nearest_.join(done, ["node", "through"], "left_anti"), "nn-frontier")
        if frontier.isEmpty():
            return best


def _cosine(a: str, b: str):
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    x, y = F.col(a), F.col(b)
    return dot(x, y) / (F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))


def nearest(table: DataFrame, queries, k: int = 5, key: str = "vec_id",
            vector: str = "embedding", **graph_options) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest rows found of every query.

    ``queries`` is a condition on ``key``; every other row is a candidate. Only vectors
    of a query's length are near it. Vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do rows without a key; repeated rows count
    once; other columns play no part; an empty table gives no rows. Ties go to the
    smaller key.
    """
    rows = written(directions(table, key, vector).distinct(), "nn-vectors")
    centres = _centres(rows)
    alike = Window.partitionBy("embedding").orderBy("key")
    members = rows.withColumn("place", F.row_number().over(alike)).where(F.col("place") <= k + 1)
    groups = members.groupBy("embedding").agg(F.sort_array(F.collect_list("key")).alias("members"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("embedding")
            sizes = np.diff(held.offsets.to_numpy())
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                made = coded(matrix(part.column("embedding")), centres.get(int(size)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([r.tobytes() for r in made], pa.binary())],
                    [*part.schema.names, "code"])

    nodes = written(groups.select(F.element_at("members", 1).alias("node"), "embedding", "members")
                    .mapInArrow(code, "node long, embedding array<double>, members array<long>, "
                                      "code binary"), "nn-nodes")
    asked = written(rows.where(queries(F.col("key"))).join(
        nodes.select("node", "embedding"), "embedding").select("key", "node"), "nn-asked")
    starts = asked.select("node").distinct()
    graph = neighbour_graph(nodes, centres, **graph_options)
    found = search(starts, graph, nodes, centres)
    near = found.select("node", F.explode("ids").alias("other")) \
        .union(starts.select("node", F.col("node").alias("other")))
    vectors = nodes.select("node", "embedding", "members")
    exact = (near.join(vectors.drop("members").withColumnRenamed("embedding", "one"), "node")
             .join(vectors.withColumnRenamed("node", "other"), "other")
             .select("node", F.explode("members").alias("vec_id"),
                     _cosine("one", "embedding").alias("score")))
    by_node = Window.partitionBy("node").orderBy(F.desc("score"), "vec_id")
    lists = written(exact.withColumn("place", F.row_number().over(by_node))
                    .where(F.col("place") <= k + 1).drop("place"), "nn-lists")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.withColumnRenamed("key", "query_id").join(lists, "node")
            .where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
