"""Rollups kept current by recomputing the days a micro-batch touches.

The stream itself has no state: a batch is decoded once and stored as Parquet by
day, the hours of its days are computed again from all stored events, and the
rollup is taken from the small table of hours. Late events are exact however
late, and nothing has to be kept for days that no longer change. It suits large
batches; for batches that are small against a day, `cartpulse.streaming.rollups`
reads less.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartpulse.operators import rollups
from cartpulse.schemas import CAMPAIGN_KEYS, FUNNEL_KEYS
from cartpulse.sources.serving import BATCH_ID, append_changelog
from cartpulse.streaming.rollups import each_batch

ROLLUPS = {
    "marketing": (rollups.campaign_hourly, rollups.campaign_performance, CAMPAIGN_KEYS),
    "cart": (rollups.cart_hourly, rollups.cart_funnel, FUNNEL_KEYS),
}

# Events without a time, or with one outside these days, are filed under one day; it only
# names their folder, so that broken clocks cannot make folders without end.
NO_DAY, FIRST_DAY, LAST_DAY = "1900-01-01", "2000-01-01", "2099-12-31"


def _by_day(df: DataFrame, time: str) -> DataFrame:
    day, other = F.col(time).cast("date"), F.lit(NO_DAY).cast("date")
    usual = day.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date"))
    return df.withColumn("day", F.when(usual, day).otherwise(other))


def start_by_day(events: DataFrame, kind: str, base: str, checkpoint: str,
                 every: str | None = None) -> StreamingQuery:
    """Keeps ``base``/events, ``base``/hours and ``base``/changelog current.

    A replayed batch replaces its stored events, its days' hours and its changelog
    partition, so it changes nothing.
    """
    hourly, rollup, keys = ROLLUPS[kind]
    stored, hours_path, changelog = f"{base}/events", f"{base}/hours", f"{base}/changelog"
    columns = T.StructType([*events.schema, T.StructField(BATCH_ID, T.LongType()),
                            T.StructField("day", T.DateType())])

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _by_day(batch, "event_time").withColumn(BATCH_ID, F.lit(batch_id).cast("long")) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("day", BATCH_ID).parquet(stored)
        history = spark.read.schema(columns).parquet(stored).where(F.col(BATCH_ID) <= batch_id)
        arrived = history.where(F.col(BATCH_ID) == batch_id)
        # A filter on the folder column: the folders of all other days are not read.
        # The set holds calendar days, at most 366 a year.
        arrived_days = arrived.agg(F.collect_set("day")).scalar()
        hours = hourly(history.where(F.array_contains(arrived_days, F.col("day"))))
        _by_day(hours, "hour").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("day").parquet(hours_path)
        touched = arrived.select(*keys).distinct().alias("t")
        current = rollup(spark.read.schema(hours.schema).parquet(hours_path)).alias("r")
        changed = current.join(
            touched, [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys], "left_semi")
        append_changelog(changed, changelog, batch_id)

    return each_batch(events.writeStream, process, checkpoint, every)
