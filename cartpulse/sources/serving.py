"""Serving tables, the append-only changelog behind them, and upserts.

All are plain Parquet folders: a changelog has one partition per micro-batch, an upserted
table one per key bucket, and a write replaces whole partitions. Transactions between
several writers and readers are the matter of a table format on the cluster.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartpulse.schemas import SERVING_TABLES

BATCH_ID = "batch_id"

BUCKET = "key_bucket"


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _laid_out(df: DataFrame, name: str) -> DataFrame:
    """Rows hashed by the distribution columns and sorted for min/max pruning.
    Rebalancing splits a hot key over several files instead of one long task."""
    schema, distribution, sort = SERVING_TABLES[name]
    return (_conform(df, schema).hint("rebalance", *[F.col(c) for c in distribution])
            .sortWithinPartitions(*sort))


def write_serving(df: DataFrame, name: str, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` as the serving table ``name`` (declared columns only) to ``path``."""
    _laid_out(df, name).write.mode(mode).parquet(path)


def save_serving_table(df: DataFrame, name: str, table: str, buckets: int,
                       path: str | None = None) -> None:
    """The same as a catalog table, bucketed so that joins on its keys need no shuffle."""
    _, distribution, sort = SERVING_TABLES[name]
    writer = (_laid_out(df, name).write.mode("overwrite")
              .bucketBy(buckets, *distribution).sortBy(*sort))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def read_serving(spark: SparkSession, name: str, path: str) -> DataFrame:
    return spark.read.schema(SERVING_TABLES[name][0]).parquet(path)


# --- changelog: every version of every row ----------------------------------

def _partitions(spark: SparkSession, path: str, schema: T.StructType | None,
                partition: T.StructField) -> DataFrame:
    """The rows below ``path`` with their partition; with a schema, none before the first
    write, and no file is opened to infer one."""
    if schema is None:
        rows = spark.read.parquet(path)
        return rows.withColumn(partition.name, F.col(partition.name).cast(partition.dataType))
    full = T.StructType([*[f for f in schema if f.name != partition.name], partition])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], full)


def append_changelog(df: DataFrame, path: str, batch_id: int) -> None:
    """Add one micro-batch of row versions. A replayed batch replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH_ID}={batch_id}")


def read_changelog(spark: SparkSession, path: str,
                   schema: T.StructType | None = None) -> DataFrame:
    """Every version of every row, with its ``batch_id``. ``schema`` is that of the rows
    appended; with it a changelog without any batch reads as empty."""
    return _partitions(spark, path, schema, T.StructField(BATCH_ID, T.LongType()))


def fold_changelog(spark: SparkSession, path: str, keys: list[str], target: str, through: int,
                   earlier: str | None = None) -> None:
    """Write the current row of each key as of batch ``through`` to ``target``.

    ``earlier`` is a fold to start from; only batches after it are opened. Rows keep the
    batch they come from, so a fold and later batches are versions of the same kind.
    """
    versions = _versions(spark, path, earlier).where(F.col(BATCH_ID) <= through)
    folded = latest_version(versions.withColumn("_version", F.col(BATCH_ID)), keys, "_version")
    folded.hint("rebalance").write.mode("overwrite").parquet(target)


def _versions(spark: SparkSession, path: str, folded: str | None) -> DataFrame:
    changelog = read_changelog(spark, path)
    if folded is None:
        return changelog
    before = spark.read.parquet(folded)
    # a condition on the folder name: folded batches are not opened
    through = before.agg(F.coalesce(F.max(BATCH_ID), F.lit(-1))).scalar()
    return changelog.where(F.col(BATCH_ID) > through).unionByName(before)


def read_latest(spark: SparkSession, path: str, keys: list[str],
                folded: str | None = None) -> DataFrame:
    """The current row of each key, from a fold and the batches after it."""
    return latest_version(_versions(spark, path, folded), keys)


def latest_version(changelog: DataFrame, keys: list[str], version: str = BATCH_ID) -> DataFrame:
    """The current row of each key. Versions are combined before the shuffle,
    so a key with very many versions costs one row per task."""
    values = [c for c in changelog.columns if c not in keys and c != version]
    newest = F.max_by(F.struct(*values), F.col(version)).alias("newest")
    return changelog.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def changelog_skew(changelog: DataFrame, keys: list[str]) -> DataFrame:
    """How many row versions the changelog holds per current row."""
    versions = changelog.groupBy(*keys).agg(F.count("*").alias("versions"))
    return versions.agg(
        F.sum("versions").alias("changelog_rows"),
        F.count("*").alias("distinct_keys"),
        F.max("versions").alias("max_versions"),
        F.try_divide(F.sum("versions").cast("double"), F.count("*")).alias("rows_per_key"),
    )


# --- upsert: keep only the current row ---------------------------------------

def read_current(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of a table kept by `upsert`; with a ``schema``, none before the first."""
    return _partitions(spark, path, schema, T.StructField(BUCKET, T.IntegerType())).drop(BUCKET)


def upsert(updates: DataFrame, path: str, keys: list[str], buckets: int = 64) -> None:
    """Replace the rows of ``keys`` found in ``updates`` and keep all others.

    Rows lie in partitions by a hash of their key. Those that ``updates`` touches are
    written anew by a dynamic partition overwrite, the others stay as they are.
    ``updates`` holds one row per key (see `latest_version`); of several, one is kept.
    ``buckets`` stays the same for the life of a table, which has one writer at a time.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)
    field = T.StructField(BUCKET, T.IntegerType())
    current = _partitions(updates.sparkSession, path, updates.schema, field)
    # a set of at most ``buckets`` numbers, and a condition on folder names
    touched = updates.agg(F.collect_set(bucket)).scalar()
    kept = current.where(F.array_contains(touched, F.col(BUCKET))).drop(BUCKET)
    both = kept.withColumn("_incoming", F.lit(0)).unionByName(
        updates.withColumn("_incoming", F.lit(1)))
    merged = latest_version(both, keys, version="_incoming").select(*updates.columns, bucket)
    merged.hint("rebalance", BUCKET).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
