"""Small helpers shared by the operators: tables, Arrow batches, written steps."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

import cartpulse
from cartpulse.session import work_dir

_shipped: dict[Path, str] = {}


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per Spark application, so that
    tasks can import it wherever the driver was started."""
    context = spark.sparkContext
    package = Path(cartpulse.__file__).parent
    if _shipped.get(package) == context.applicationId:
        return
    archive = Path(tempfile.mkdtemp(prefix="run-")) / "cartpulse_tasks.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped[package] = context.applicationId


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """``df`` written below the shared folder and read again.

    Cuts the lineage, so that later steps survive lost executors without doing the
    work again, and gives the planner the true size of the step.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose ``column`` holds about ``max_bytes`` at most.

    A single longer value makes a slice of its own; no value is cut.
    """
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin, held = 0, 0
    for at, length in enumerate(lengths):
        if held and held + length > max_bytes:
            yield batch.slice(begin, at - begin)
            begin, held = at, 0
        held += length
    if begin < len(batch):
        yield batch.slice(begin)


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column as Python strings; null reads as empty."""
    return [v or "" for v in batch.column(column).to_pylist()]


def free_name(name: str, df: DataFrame) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
