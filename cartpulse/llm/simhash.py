"""Near-duplicates by SimHash, every pair of fingerprints compared exactly.

Equal fingerprints are compared once. The distinct ones are dealt into tiles of one
population count each. Two fingerprints that differ in at most r bits have population
counts that differ by r at most, so only such pairs of tiles meet; within a pair all
differences are taken with numpy. A pair of tiles returns a spanning forest of its
links, never the links themselves, so a large group of copies adds one row per
fingerprint and tile pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.bpe import STEP_BYTES
from cartpulse.llm.components import components
from cartpulse.llm.frames import pieces, strings, written

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints in a tile, on average at most.
TILE = 8192
_ROWS_AT_ONCE = 16


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 bits that are set in over half of the shingles' hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # A-Z; 9-13 and 32
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = [0, *(ends[:-shingle] + 1).tolist()]
    hashes = np.array([digest(joined[a:b], seed)
                       for a, b in zip(begins, ends[shingle - 1:].tolist())], dtype=np.uint64)
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (votes * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id",
                 shingle: int = SHINGLE) -> DataFrame:
    """(``key``, bits): the fingerprint of every text as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", STEP_BYTES):
                bits = np.array([fingerprint(t, shingle) for t in strings(part, "text")],
                                dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(bits.view(np.int64))], ["key", "bits"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "key long, bits long").withColumnRenamed("key", key)


def linked(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """For each number of left and then right, the first number of the group that
    links of at most ``radius`` bits between the two sides join it to."""
    parent = np.arange(len(left) + len(right))
    for at in range(0, len(left), _ROWS_AT_ONCE):
        near = np.bitwise_count(left[at:at + _ROWS_AT_ONCE, None] ^ right) <= radius
        if not near.any():
            continue
        a, b = np.nonzero(near)
        a, b = a + at, b + len(left)
        while True:
            low = np.minimum(parent[a], parent[b])
            high = np.maximum(parent[a], parent[b])
            open_ = low != high
            if not open_.any():
                break
            a, b = a[open_], b[open_]
            np.minimum.at(parent, high[open_], low[open_])
            while not np.array_equal(further := parent[parent], parent):
                parent = further
    return parent


def _forest(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(batch.column("left"), batch.column("right")):
                left = one.values.to_numpy(zero_copy_only=False)
                right = two.values.to_numpy(zero_copy_only=False)
                first = linked(left.view(np.uint64), right.view(np.uint64), radius)
                both = np.concatenate([left, right])
                moved = np.flatnonzero(first != np.arange(len(both)))
                a, b = both[moved], both[first[moved]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[a != b]), pa.array(b[a != b])], schema=schema)
    return run


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): edges between numbers of ``distinct`` (bits) that connect exactly what
    all pairs of at most ``radius`` differing bits connect."""
    counted = distinct.select("bits", F.bit_count("bits").alias("ones"))
    # at most 65 rows
    tiles = {r.ones: -(-r["count"] // tile) for r in counted.groupBy("ones").count().collect()}
    if not tiles:
        return distinct.select(F.col("bits").alias("a"), F.col("bits").alias("b"))
    spans = F.array(*[F.lit(tiles.get(n, 0)) for n in range(65 + radius)])
    dealt = written(
        counted.withColumn("slot", F.pmod(F.xxhash64("bits"), F.get(spans, F.col("ones"))))
        .groupBy("ones", "slot").agg(F.collect_list("bits").alias("held")), "simhash-tiles")
    partners = (dealt.select("ones", "slot")
                .withColumn("ones2", F.explode(F.sequence(F.col("ones"), F.col("ones") + radius)))
                .where(F.get(spans, F.col("ones2")) > 0)
                .withColumn("slot2", F.explode(F.sequence(
                    F.lit(0).cast("long"), F.get(spans, F.col("ones2")).cast("long") - 1)))
                .where("ones2 > ones or slot2 >= slot"))
    other = dealt.select(F.col("ones").alias("ones2"), F.col("slot").alias("slot2"),
                         F.col("held").alias("right"))
    met = (partners.join(other, ["ones2", "slot2"])
           .join(dealt.withColumnRenamed("held", "left"), ["ones", "slot"])
           .select("left", "right", "ones", "slot", "ones2", "slot2")
           .repartition("ones", "slot", "ones2", "slot2").select("left", "right"))
    return met.mapInArrow(_forest(radius), "a long, b long")


def _placed(held: DataFrame, radius: int) -> DataFrame:
    """(bits, least, component): each fingerprint of ``held`` (key, bits) with its smallest
    key and the smallest fingerprint that it is linked to."""
    distinct = written(held.where("key is not null").groupBy("bits")
                       .agg(F.min("key").alias("least")), "simhash-distinct")
    found = components(links(distinct, radius))
    placed = distinct.join(found.withColumnRenamed("node", "bits"), "bits", "left").select(
        "bits", "least", F.coalesce("component", "bits").alias("component"))
    return written(placed, "simhash-placed")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE,
                    text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` of every document.

    ``component_id`` is the smallest key that links of at most ``radius`` differing
    bits reach. A text that is null or has no word has fingerprint 0 and links like
    any other. A row without a key has no component and gives none its name; repeated
    rows give repeated results; other columns play no part; an empty table gives no rows.
    """
    held = written(fingerprints(docs, text, key, shingle).withColumnRenamed(key, "key"),
                   "simhash")
    placed = _placed(held, radius)
    named = written(placed.groupBy("component").agg(F.min("least").alias("component_id")),
                    "simhash-named")
    classes = written(placed.join(named, "component").select("bits", "component_id"),
                      "simhash-classes")
    return held.join(classes, "bits", "left").select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"),
        F.when(F.col("key").isNotNull(), F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE,
                text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents without near-duplicates: of each component the smallest key stays,
    once, with all its columns. Rows without a key stay. A key with different texts counts
    by their fingerprints; of two in one component the smaller fingerprint stays, and of
    texts with one fingerprint the smallest text."""
    def bits(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t or "", shingle) for t in texts.to_pylist()],
                                 dtype=np.uint64).view(np.int64))

    named = docs.withColumn("_bits", F.arrow_udf(bits, "long")(F.col(text)))
    held = written(named.select(F.col(key).cast("long").alias("key"),
                                F.col("_bits").alias("bits")), "simhash")
    best = _placed(held, radius).groupBy("component").agg(
        F.min(F.struct("least", "bits")).alias("best"))
    first = written(best.select(F.col("best.least").alias(key),
                                F.col("best.bits").alias("_bits")), "simhash-first")
    rows = named.join(first, [key, "_bits"], "left_semi")
    texts = rows.groupBy(key, "_bits").agg(F.min(text).alias("_text"))
    kept = (rows.join(texts, [key, "_bits"]).where(F.col(text).eqNullSafe(F.col("_text")))
            .dropDuplicates([key, "_bits"]))
    return kept.select(*docs.columns).unionByName(docs.where(F.col(key).isNull()))
