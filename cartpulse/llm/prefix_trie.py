"""Trie of conversations: every distinct beginning, with counts over its subtree.

Conversations are laid out in blocks of ``BLOCK`` turn columns. One ROLLUP over the turn
columns aggregates the prefixes of all lengths together, and grouping_id tells the length
of each. A longer conversation continues in further rows, keyed by the node in which its
block before ended, so one aggregation serves conversations of every length.

Sums over subtrees are sums over conversations too. A conversation is the first (the
smallest id) in all nodes of its path below some depth r and in none above. Then

* a leaf counts once if only the first of its conversations counts, and
* (n - 1) times the bytes of a node's last text, summed over a subtree, is the sum over its
  conversations of the bytes of their turns from the subtree's top to depth r.

The first ROLLUP gives n and the first of every node, hence r; the second one adds up.
Aggregation combines before every shuffle, so a beginning that a third of all
conversations share costs one row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.frames import written

#: Turn columns of a block.
BLOCK = 4
#: Bytes of a list of ids that are moved as one row.
CHUNK = 1_000_000
_DIGEST = 16
_ROOT = bytes(_DIGEST)


def _digest(data: Column) -> Column:
    return F.unhex(F.substring(F.sha2(data, 256), 1, 2 * _DIGEST))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn): the turns of each conversation, in order, from place 0.

    ``turn`` holds the id, a digest of role and text, and the bytes of the text. Turns
    are ordered by number, null first, equal ones by id. Rows without a conv_id are no
    conversation's.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")).cast("binary") for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("number"),
        _digest(F.concat(F.octet_length(role).cast("string").cast("binary"),
                         F.lit(b":"), role, text)).alias("id"),
        F.octet_length(text).cast("long").alias("bytes"))
    return rows.selectExpr(
        "conv_id", "row_number() over (partition by conv_id order by number nulls first, id) - 1L"
                   " as place", "id", "bytes")


def with_borrowed_beginnings(placed: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """(conv_id, part, place, id, bytes): turns of conversations that begin like another.

    Conversation c takes the first h turns of conversation c - c mod ``group``, as far as
    there are any, and goes on with its own after the first h; h is crc32 of its decimal
    id, mod ``most``. Every conversation also has one row without a turn, in part 2.
    """
    base = F.col("conv_id") - F.col("conv_id") % group
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    held = written(placed, "trie-turns")
    all_ = held.where("place = 0").select("conv_id", base.alias("base"), h.alias("h"))
    heads = held.where((F.col("conv_id") % group == 0) & (F.col("place") < most)).select(
        F.col("conv_id").alias("base"), "place", "id", "bytes")
    lent = all_.join(heads, "base").where("place < h").select(
        "conv_id", F.lit(0).alias("part"), "place", "id", "bytes")
    own = held.where(F.col("place") >= h).select(
        "conv_id", F.lit(1).alias("part"), "place", "id", "bytes")
    return lent.union(own).union(whole(held).where("part = 2"))


def whole(placed: DataFrame) -> DataFrame:
    """(conv_id, part, place, id, bytes): the turns as they are, and a row without one for
    every conversation."""
    rows = placed.select("conv_id", F.lit(1).alias("part"), "place", "id", "bytes")
    ends = placed.where("place = 0").select(
        "conv_id", F.lit(2), F.lit(0).cast("long"), F.lit(None).cast("binary"),
        F.lit(0).cast("long"))
    return rows.union(ends)


_TURNS = [f"t{i}" for i in range(1, BLOCK + 1)]
_TURN = pa.struct([("id", pa.binary()), ("bytes", pa.int64())])
_BLOCKS = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("prior", pa.binary()),
    ("before", pa.int64()), ("size", pa.int64()), ("last", pa.bool_()),
    *((t, _TURN) for t in _TURNS)])


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, part and place as blocks; holds one block at a time."""
    conv, block, prior, before, held = None, 0, _ROOT, 0, []

    def row(last: bool) -> list:
        return [conv, block, prior, before, len(held), last,
                *({"id": i, "bytes": n} for i, n in held), *[None] * (BLOCK - len(held))]

    for batch in batches:
        rows = []
        for its, part, id_, size in zip(*(batch.column(c).to_pylist()
                                          for c in ("conv_id", "part", "id", "bytes"))):
            if its != conv:
                conv, block, prior, before, held = its, 0, _ROOT, 0, []
            if part == 2:               # the conversation's end
                rows.append(row(True))
                continue
            if len(held) == BLOCK:
                rows.append(row(False))
                prior = hashlib.sha256(b"".join([prior, *(i for i, _ in held)])).digest()[:_DIGEST]
                block, before, held = block + 1, before + sum(n for _, n in held), []
            held.append((id_, size))
        columns = zip(*rows) if rows else [[]] * len(_BLOCKS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _BLOCKS)], schema=_BLOCKS)


def blocks(parts: DataFrame) -> DataFrame:
    """Conversations in rows of at most ``BLOCK`` turns; the last one of each is marked."""
    turn = "struct<id:binary,bytes:long>"
    return (parts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
            .mapInArrow(_in_blocks, "conv_id long, block long, prior binary, before long, "
                        "size long, last boolean, " + ", ".join(f"{t} {turn}" for t in _TURNS)))


def _node(level: int) -> Column:
    """The id of the node after the first turns of a block."""
    if level == 0:
        return F.when(F.col("block") == 0, _digest(F.col("prior"))).otherwise(F.col("prior"))
    return _digest(F.concat("prior", *(F.col(f"{t}.id") for t in _TURNS[:level])))


def _by_level(level: Column, values: list[Column]) -> Column:
    """The value of a row's level; only that one is computed."""
    chosen = F.when(level == 0, values[0])
    for n, value in enumerate(values[1:], 1):
        chosen = chosen.when(level == n, value)
    return chosen


def _nodes(held: DataFrame, sums: str) -> DataFrame:
    """The nodes of all conversations in ``held`` blocks, with the aggregates ``sums``."""
    names = ", ".join(_TURNS)
    rolled = held.sparkSession.sql(
        f"select block, prior, before, {names}, {BLOCK} - bit_count(grouping_id()) as level, "
        f"{sums} from {{held}} group by block, prior, before, rollup({names})", held=held)
    # a group without its last turn is a conversation that has ended before
    level = F.col("level")
    there = _by_level(level, [F.col("block") == 0, *(F.col(t).isNotNull() for t in _TURNS)])
    sizes = [F.coalesce(F.col(f"{t}.bytes"), F.lit(0)) for t in _TURNS]
    above = [F.col("before"), *(sum(sizes[:n], F.col("before")) for n in range(BLOCK))]
    return rolled.where(there).select(
        "*", (F.col("block") * BLOCK + level).alias("depth"),
        _by_level(level, [_node(n) for n in range(BLOCK + 1)]).alias("node"),
        _by_level(level, [F.lit(None).cast("binary"), *(_node(n) for n in range(BLOCK))])
        .alias("parent"),
        _by_level(level, [F.lit(0).cast("long"), *sizes]).alias("bytes"),
        _by_level(level, above).alias("above")).drop("block", "prior", "before", "level", *_TURNS)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) as rows (node, first, ids) of comma-joined ids."""
    node, first, held, size = None, None, [], 0
    for batch in batches:
        rows = []
        for its, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if held and (its != node or size >= CHUNK):
                rows.append((node, first, ",".join(held)))
                held, size = [], 0
            if not held:
                node, first = its, conv
            held.append(str(conv))
            size += len(held[-1]) + 1
        yield _chunks(rows)
    if held:
        yield _chunks([(node, first, ",".join(held))])


def _chunks(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()),
         pa.array(columns[2], pa.string())], ["node", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by node and first id as (node, digest) of all ids, read as a stream."""
    node, sha = None, None
    for batch in batches:
        rows = []
        for its, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if its != node:
                if sha:
                    rows.append((node, sha.hexdigest()))
                node, sha = its, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        yield _digests(rows)
    if sha:
        yield _digests([(node, sha.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())],
        ["node", "ends_sha256"])


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): the SHA-256 of the ids (conv_id) of every node, in order.

    The ids of a node are sorted and joined wherever they lie, in chunks; only these chunks
    meet, and are hashed one after the other without being held together.
    """
    chunks = (ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
              .mapInArrow(_listed, "node binary, first long, ids string"))
    return (chunks.repartition("node").sortWithinPartitions("node", "first")
            .mapInArrow(_hashed, "node binary, ends_sha256 string"))


def prefix_trie(parts: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations given as in ``whole``.

    A node is a distinct sequence of first turns, the root that of none. Its row has
    ``conv_id`` (its smallest conversation), ``depth``, ``parent_conv_id`` (null at the
    root), ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` (over its subtree,
    itself included), ``ends_sha256`` (of the ids of conversations that end in it) and
    ``last_bytes``. Repeated turns are turns; null roles and texts are empty; equal
    conversations share all nodes. Without conversations there is no node.
    """
    held = written(blocks(parts), "trie-blocks")
    ends = written(held.where("last").select(
        "conv_id",
        _by_level(F.col("size"), [_node(n) for n in range(BLOCK + 1)]).alias("node"),
        (F.col("before") + sum((F.coalesce(F.col(f"{t}.bytes"), F.lit(0)) for t in _TURNS),
                               F.lit(0))).alias("total")), "trie-ends")
    first = written(_nodes(held, "min(conv_id) as conv_id, count(*) as n_convs")
                    .select("node", "conv_id", "n_convs", "bytes"), "trie-first")
    own = first.groupBy("conv_id").agg(F.sum("bytes").alias("own"))
    ending = ends.groupBy("node").agg(F.count("*").alias("n_ends"))
    leaves = first.join(ending, "node").where("n_convs = n_ends").select(
        "conv_id", F.lit(1).cast("long").alias("leaf"))
    shared = ends.join(own, "conv_id", "left").join(leaves, "conv_id", "left").select(
        "conv_id", (F.col("total") - F.coalesce("own", F.lit(0))).alias("shared"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"))
    nodes = written(_nodes(
        held.join(shared, "conv_id"),
        "min(conv_id) as conv_id, count(*) as n_convs, sum(leaf) as n_leaves, "
        "sum(shared) as shared, min_by(shared, conv_id) as firsts"), "trie-nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(children, "node", "left").join(ends_digests(ends), "node", "left")
            .join(above, "parent", "left").select(
                "conv_id", "depth", "parent_conv_id", "n_convs",
                F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves",
                (F.col("shared") - F.col("firsts") - (F.col("n_convs") - 1) * F.col("above"))
                .alias("saved_tokens"),
                F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
                F.col("bytes").alias("last_bytes")))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations after their beginnings were borrowed from others."""
    return prefix_trie(with_borrowed_beginnings(turns(conversations))).drop("last_bytes")
