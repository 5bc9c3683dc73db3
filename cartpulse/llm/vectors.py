"""Small helpers for columns of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_direction(vector: Column) -> Column:
    """True for a vector without null or non-finite components that is not all zero."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ok & F.exists(vector, lambda x: x != 0), F.lit(False))


def directions(table: DataFrame, key: str, vector: str, *more: str) -> DataFrame:
    """Rows whose ``vector`` is a direction, as (key, embedding: array<double>, more)."""
    rows = table.select(F.col(key).cast("long").alias("key"),
                        F.col(vector).cast("array<double>").alias("embedding"), *more)
    return rows.where(F.col("key").isNotNull() & is_direction(F.col("embedding")))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column with lists of one length as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def units(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest component first, so that no
    square over- or underflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def whole_runs(batches: Iterator[pa.RecordBatch], key: str, most: int) -> Iterator[pa.Table]:
    """Rows sorted by ``key`` in tables that hold whole runs of equal keys, except that
    a run of over ``most`` rows comes in parts."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut or (held and held[-1].column(key)[-1].as_py() != keys[0]):
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = [batch.slice(cut)]
        else:
            held.append(batch)
        if sum(map(len, held)) > most:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)
