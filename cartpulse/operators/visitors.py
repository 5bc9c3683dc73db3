"""Unique visitors over time without counting anyone twice, from mergeable sketches.

Distinct counts of hours cannot be added up: a user seen in two hours would count twice.
A sketch per campaign and hour can be merged to any set of hours and campaigns instead,
so one small stored table answers days, months and channels without the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.operators.rollups import hour
from cartpulse.schemas import CAMPAIGN_KEYS

#: Two to this power are the buckets of a sketch.
LG_BUCKETS = 12
#: Three standard deviations of an estimate, 1.04 / sqrt(buckets) each.
ERROR = 3 * 1.04 / 2 ** (LG_BUCKETS / 2)


def visitor() -> Column:
    return F.when(F.col("event_type") == "impression", F.col("user_id"))


def hourly_sketches(events: DataFrame, keys: list[str] = CAMPAIGN_KEYS) -> DataFrame:
    """``visitors``, a sketch of the users with an impression, per key and hour. An hour
    without a user has none. Sketches are built before the shuffle, so a hot hour ships
    one sketch of a few kilobytes per task."""
    return events.groupBy(*keys, hour()).agg(
        F.hll_sketch_agg(visitor(), LG_BUCKETS).alias("visitors"))


def merged(sketches: DataFrame, by: list[str | Column]) -> DataFrame:
    """The sketches of all rows with equal ``by`` as one."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("visitors").alias("visitors"))


def unique_visitors(sketches: DataFrame, by: list[str | Column]) -> DataFrame:
    """Estimated number of different visitors over all hours of each ``by``."""
    merged_ = merged(sketches, by)
    return merged_.withColumn(
        "unique_visitors", F.coalesce(F.hll_sketch_estimate("visitors"), F.lit(0).cast("long"))
    ).drop("visitors")


def checked(estimates: DataFrame, events: DataFrame, by: list[str | Column],
            names: list[str]) -> DataFrame:
    """``estimates`` beside the exact counts of ``events``: both, and whether the estimate
    lies within the stated error."""
    exact = events.groupBy(*by).agg(F.count_distinct(visitor()).alias("exact_visitors"))
    same = [F.col(f"e.{n}").eqNullSafe(F.col(f"x.{n}")) for n in names]
    off = F.abs(F.col("unique_visitors") - F.col("exact_visitors"))
    return estimates.alias("e").join(exact.alias("x"), same).select(
        *[f"e.{n}" for n in names], "unique_visitors", "exact_visitors",
        (off <= F.greatest(F.lit(1.0), F.col("exact_visitors") * ERROR)).alias("within_error"))
