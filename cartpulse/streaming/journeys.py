"""Attribution of purchases while events arrive: a batch meets what is still open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartpulse.sources.serving import append_changelog
from cartpulse.streaming.rollups import each_batch

_ROW = "at timestamp_ntz, link string, campaign string, revenue double, done boolean"
_OPEN = f"kind string, id string, serial string, event struct<{_ROW}>, latest timestamp_ntz"
#: Rows that only move the watermark on; each batch keeps one.
_OTHER = "other"


def _minutes(count: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(count))


def _arrived(batch: DataFrame, batch_id: int) -> DataFrame:
    """The events of a batch that can have partners; all others only tell the time."""
    kind, at = F.col("event_type"), F.col("event_time")
    id_, link = F.col("event_id"), F.when(F.col("event_type") == "purchase", F.col("click_id"))
    useful = (kind.isin("impression", "click") & id_.isNotNull()) | (
        (kind == "purchase") & link.isNotNull())
    useful = F.coalesce(useful, F.lit(False))
    nameless = useful & id_.isNull()
    event = F.struct(
        at.alias("at"), F.coalesce(link, F.when(kind == "click", F.col("impression_id")))
        .alias("link"), F.col("campaign_id").alias("campaign"),
        F.when(kind == "purchase", F.col("revenue")).cast("double").alias("revenue"),
        F.lit(False).alias("done"))
    return batch.where(at.isNotNull()).select(
        F.when(useful, kind).otherwise(F.lit(_OTHER)).alias("kind"),
        F.when(useful, id_).alias("id"),
        F.when(nameless, F.concat_ws("-", F.lit(batch_id), F.monotonically_increasing_id()))
        .alias("serial"), F.when(useful, event).alias("event"), at.alias("latest"))


def start_attribution(events: DataFrame, out: str, checkpoint: str, watermark: str = "30 minutes",
                      click_minutes: int = 30, purchase_minutes: int = 30,
                      every: str | None = None) -> StreamingQuery:
    """The rows of `cartpulse.operators.journeys.attribution`, each written once.

    A purchase with its click and impression is written as soon as all three are there;
    one whose click has no matching impression, when the watermark has passed the time in
    which that could come. No event is held for longer than the bounds and the
    watermark. An event later than the watermark finds no partner, as does one without a
    time. Copies of an event within the watermark count once.

    What is open lies as a plain table in the checkpoint, and a batch is joined with it as
    a table: the source is decoded once, joins adapt to their sizes and split a hot id. A
    batch reads what the one before left and writes its own, so a replay changes nothing.
    """
    delay = F.expr(f"INTERVAL {watermark}")

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def kept(rows: DataFrame, name: str) -> DataFrame:
            # two places in turn: a replay finds what the batch before left
            path = f"{checkpoint}/attribution/{name}-{batch_id % 2}"
            rows.write.mode("overwrite").parquet(path)
            return spark.read.schema(rows.schema).parquet(path)

        rows = _arrived(batch, batch_id).withColumn("age", F.lit(1))
        if batch_id:
            before = spark.read.schema(_OPEN).parquet(
                f"{checkpoint}/attribution/open-{(batch_id - 1) % 2}")
            mark = before.agg(F.max("latest") - delay).scalar()
            rows = rows.where(F.coalesce(F.col("latest") > mark, F.lit(True))).unionByName(
                before.withColumn("age", F.lit(0)))
        # of copies the one that was there before counts, or else the earliest
        held = kept(rows.groupBy("kind", "id", "serial").agg(
            F.min(F.struct("age", "event")).alias("first"), F.max("latest").alias("latest"))
            .select("kind", "id", "serial", "first.event", "latest"), "held")
        passed = held.agg(F.max("latest") - delay).scalar()

        def stage(name: str, **columns: str) -> DataFrame:
            return held.where((F.col("kind") == name) & ~F.col("event.done")).select(
                *[F.col(source).alias(alias) for alias, source in columns.items()])

        impressions = stage("impression", impression_id="id", seen_at="event.at",
                            impression_campaign="event.campaign")
        clicks = stage("click", click_id="id", clicked_at="event.at",
                       clicked_impression="event.link", click_campaign="event.campaign")
        purchases = stage("purchase", purchase_id="id", serial="serial", bought_at="event.at",
                          via="event.link", revenue="event.revenue")
        bought = purchases.join(clicks, (F.col("via") == F.col("click_id")) & F.col(
            "bought_at").between(F.col("clicked_at"),
                                 F.col("clicked_at") + _minutes(purchase_minutes)))
        shown = bought.join(impressions, (F.col("clicked_impression") == F.col(
            "impression_id")) & F.col("clicked_at").between(
                F.col("seen_at"), F.col("seen_at") + _minutes(click_minutes)), "left")
        settled = kept(shown.where(F.col("seen_at").isNotNull()
                                   | (F.col("clicked_at") <= passed)), "settled")
        append_changelog(settled.select(
            "purchase_id", "click_id", "impression_id", "click_campaign", "impression_campaign",
            "seen_at", "clicked_at", "bought_at", "revenue").hint("rebalance"), out, batch_id)

        longer = (F.when(F.col("kind") == "impression", _minutes(click_minutes + purchase_minutes))
                  .when(F.col("kind") == "click", _minutes(purchase_minutes))
                  .otherwise(_minutes(0)))
        needed = held.where((F.col("kind") == _OTHER) | (
            F.col("latest") + F.greatest(longer, delay) > passed))
        told = settled.select(F.col("purchase_id").alias("told"), F.col("serial").alias("number"),
                              F.lit(True).alias("now"))
        is_told = (F.col("kind") == "purchase") & F.col("id").eqNullSafe(F.col("told")) & F.col(
            "serial").eqNullSafe(F.col("number"))
        kept(needed.join(told, is_told, "left").withColumn("event", F.col("event").withField(
            "done", F.col("event.done") | F.coalesce("now", F.lit(False)))).select(
                "kind", "id", "serial", "event", "latest"), "open")

    return each_batch(events.writeStream, process, checkpoint, every)
