"""The library's functions joined into whole flows over an ``events`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartpulse.operators import rollups
from cartpulse.session import streaming_session, work_dir
from cartpulse.sources import event_table, events, serving

Start = Callable[[DataFrame, str, str], StreamingQuery]


def marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_table.marketing_events(event_table.events_table(spark, sf_dir))


def cart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_table.cart_events(event_table.events_table(spark, sf_dir))


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.campaign_performance_from_events(marketing(spark, sf_dir))


def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.cart_funnel_from_events(cart(spark, sf_dir))


def campaign_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_table.campaign_snapshots(marketing(spark, sf_dir))


def cart_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_table.cart_snapshots(cart(spark, sf_dir))


def served(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to and read back as a serving table. Views that use a rollup
    more than once start here, so the events behind it are read once."""
    path = work_dir(spark, name)
    serving.write_serving(df, name, path)
    return serving.read_serving(spark, name, path)


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back, for an intermediate used several times."""
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


Days = list[str] | list[Column]


def delivery_days(spark: SparkSession, sf_dir: str, count: int) -> Days:
    """The days at which the events' own time is cut into ``count`` spans of about equal
    length: the first days of all deliveries but the first."""
    day = F.col("ts").cast("date")
    days = event_table.events_table(spark, sf_dir).agg(
        F.min(day).alias("first"), (F.datediff(F.max(day), F.min(day)) + 1).alias("days"))
    return [days.select(F.date_add("first", F.floor(F.col("days") * n / count).cast("int")))
            .scalar() for n in range(1, count)]


def split_by_time(df: DataFrame, column: str, days: Days) -> list[DataFrame]:
    """``df`` cut into consecutive deliveries that start at the given days."""
    starts = [(F.lit(day) if isinstance(day, str) else day).cast("timestamp_ntz") for day in days]
    time = F.col(column)
    first = df.where(time.isNull() | (time < starts[0]))
    rest = [df.where(time >= start) if i + 1 == len(starts)
            else df.where((time >= start) & (time < starts[i + 1]))
            for i, start in enumerate(starts)]
    return [first, *rest]


def streamed(spark: SparkSession, label: str, read: Callable[..., DataFrame], kind: str,
             deliveries: list[DataFrame], start: Start, changelog: str = "") -> DataFrame:
    """Publish each delivery as JSON messages and let the stream catch up after
    each, resuming from its checkpoint. Returns the changelog it wrote, which may
    lie in a subfolder of the stream's output."""
    base = work_dir(spark, label)
    topic, out, checkpoint = f"{base}/topic", f"{base}/out", f"{base}/checkpoint"
    session = streaming_session(spark)
    for delivery in deliveries:
        events.publish(delivery, topic)
        query = start(read(session, kind, topic, streaming=True), out, checkpoint)
        query.awaitTermination()
    return serving.read_changelog(spark, f"{out}/{changelog}" if changelog else out)


def changelog_by_day(spark: SparkSession, label: str, events_of_kind: DataFrame, days: Days,
                     hourly: Callable[[DataFrame], DataFrame],
                     rollup: Callable[[DataFrame], DataFrame], keys: list[str]) -> str:
    """The path of the changelog of a rollup after each delivery cut at ``days``: a batch
    appends a new version of exactly the keys it has events of.

    Only the delivered events are read; their hours are added to the stored ones.
    Deliveries do not share an hour, so an hour's distinct counts stay whole.
    """
    path, hours_path = work_dir(spark, f"{label}-changelog"), work_dir(spark, f"{label}-hours")
    for batch_id, delivery in enumerate(split_by_time(events_of_kind, "event_time", days)):
        serving.append_changelog(hourly(delivery), hours_path, batch_id)
        hours = serving.read_changelog(spark, hours_path)
        touched = hours.groupBy(*keys).agg(F.max(serving.BATCH_ID).alias("newest")).where(
            F.col("newest") == batch_id)
        changed = rollup(hours).alias("r").join(
            touched.alias("t"), [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys],
            "left_semi")
        serving.append_changelog(changed, path, batch_id)
    return path
