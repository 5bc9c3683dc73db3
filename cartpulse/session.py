"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # The inputs carry wall-clock timestamps without a zone.
    "spark.sql.session.timeZone": "UTC",
    # Let measured sizes pick join strategies, split hot partitions and merge small ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Skip the call-site lookup on every column expression while plans are built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Distinct-visitor state is large and long-lived: keep it off the JVM heap
    # and upload only what changed in each micro-batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_base: str | None = None


def build_session(app: str = "cartpulse", master: str | None = None, **settings) -> SparkSession:
    """A session with this library's defaults. The master, sizes and partition
    counts stay with ``spark-submit`` unless they are given here."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session beside ``spark`` for stateful streams, with this library's settings.

    The number of state partitions is fixed for the life of a checkpoint and does
    not adapt, so it never follows from the cores of the moment: choose it for the size
    the stream may reach. Without one, ``spark.sql.shuffle.partitions`` counts.
    """
    session = spark.newSession()
    for key, value in SETTINGS.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    partitions = state_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", partitions)
    return session


def shared_base(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may go without one, and then gets a temporary folder.
    """
    global _local_base
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="cartpulse-")
    return _local_base


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, never used by an earlier run."""
    return f"{shared_base(spark)}/cartpulse/{label}-{uuid.uuid4().hex}"
