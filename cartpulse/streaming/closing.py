"""Ends of streams, and rollups that are published once their time is over."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartpulse import schemas
from cartpulse.functions import kpis
from cartpulse.operators.visitors import LG_BUCKETS, visitor
from cartpulse.schemas import CAMPAIGN_KEYS
from cartpulse.sources.serving import append_changelog
from cartpulse.streaming.rollups import KINDS, counted, each_batch

CLOSING = "closing"


def closing_events(events: DataFrame, kind: str, hours: int) -> DataFrame:
    """One event per stage, ``hours`` after the last of ``events``, to publish at the end of
    a feed. They move the watermark on, so that everything before them settles.

    They follow nothing, carry no amount and belong to no campaign or segment. What a
    stream says of their own hour stays open. Real events after them count as late.
    """
    stages = {"marketing": schemas.MARKETING_STAGES, "cart": schemas.CART_STAGES}[kind]
    last = events.agg(F.max("event_time").alias("last")).where("last is not null")
    names = F.explode(F.array(*[F.lit(s) for s in stages])).alias("event_type")
    marks = last.select(names, (F.col("last") + F.make_dt_interval(F.lit(0), F.lit(hours)))
                        .alias("event_time"))
    own = {
        "event_type": F.col("event_type"), "event_time": F.col("event_time"),
        "event_id": F.concat_ws("-", F.lit(CLOSING), "event_type", F.expr("uuid()")),
        "user_id": F.lit(CLOSING), "session_id": F.lit(CLOSING),
        "click_id": F.lit(CLOSING), "impression_id": F.lit(CLOSING),
    }
    return marks.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                          for f in schemas.EVENTS[kind]])


def start_closed_days(events: DataFrame, out: str, checkpoint: str, watermark: str = "30 minutes",
                      every: str | None = None) -> StreamingQuery:
    """Campaign days, each written once, when the watermark has passed their end.

    Two windows follow one another: events make hours, and closed hours make days, so a
    day's state is one row per campaign and no stored hour is read again. Visitors are
    estimated from one sketch per hour, merged to one per day. Events later than the
    watermark's hour, and events without a time, are not counted. Days are UTC days of the
    events' own clock.
    """
    kind = KINDS["marketing"]
    timed = events.withColumn("event_time", kpis.utc_instant(F.col("event_time")))
    shares = counted(timed.withWatermark("event_time", watermark), kind, "event_time", visitor())
    sums = [*kind.counters, *kind.amounts]
    hours = shares.groupBy(*CAMPAIGN_KEYS, F.window("event_time", "1 hour")).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.hll_sketch_agg("unique_visitors", LG_BUCKETS).alias("visitors"))
    days = hours.groupBy(*CAMPAIGN_KEYS, F.window(F.window_time("window"), "1 day").alias("day")).agg(
        *[F.sum(c).alias(c) for c in sums], F.count("*").alias("hours"),
        F.hll_sketch_estimate(F.hll_union_agg("visitors")).alias("unique_visitors"))
    rows = days.withColumn("day", kpis.utc_wall_clock(F.col("day.start")).cast("date"))

    def append(batch: DataFrame, batch_id: int) -> None:
        append_changelog(batch.hint("rebalance"), out, batch_id)

    return each_batch(rows.writeStream.outputMode("append"), append, checkpoint, every)
