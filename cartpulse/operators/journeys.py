"""Links between events: attribution of purchases and depth of sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.schemas import CART_STAGES


def attribution(events: DataFrame, click_minutes: int = 30,
                purchase_minutes: int = 30) -> DataFrame:
    """Every purchase that follows a click in time, with the impression of that click.

    Copies of an event with an id count once; a purchase without an id is one of its
    own. The time bounds are checked on the matched pair. A click without a matching
    impression keeps its purchase.

    Both joins have one row per id on their right side. Where very many rows refer to one
    id, or to none, the left side's partition is large, and adaptive execution splits it.
    """
    def once(stage: str, **columns: str) -> DataFrame:
        id_name, *others = columns
        rows = events.where((F.col("event_type") == stage) & F.col("event_id").isNotNull())
        values = F.struct(*[F.col(columns[name]).alias(name) for name in others])
        return rows.groupBy(F.col("event_id").alias(id_name)).agg(
            F.min(values).alias("event")).select(id_name, "event.*")

    impressions = once("impression", impression_id="event_id", seen_at="event_time",
                       impression_campaign="campaign_id")
    clicks = once("click", click_id="event_id", clicked_at="event_time",
                  clicked_impression="impression_id", click_campaign="campaign_id")
    purchases = once("purchase", purchase_id="event_id", bought_at="event_time",
                     click_id="click_id", revenue="revenue")
    nameless = events.where((F.col("event_type") == "purchase") & F.col("event_id").isNull())
    purchases = purchases.unionByName(nameless.select(
        F.col("event_id").alias("purchase_id"), F.col("event_time").alias("bought_at"),
        "click_id", "revenue"))

    def within(later: str, earlier: str, minutes: int):
        limit = F.col(earlier) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
        return F.col(later).between(F.col(earlier), limit)

    def same(link: str, target: str):
        # With the hash as a second key, the reduced events are dealt anew, so that both
        # sides come straight from a shuffle, which is what adaptive execution can split.
        return (F.col(link) == F.col(target)) & (F.xxhash64(link) == F.xxhash64(target))

    bought = purchases.withColumnRenamed("click_id", "via").join(
        clicks, same("via", "click_id")).where(
        within("bought_at", "clicked_at", purchase_minutes)).drop("via")
    shown = bought.join(
        impressions, same("clicked_impression", "impression_id"), "left")
    seen = F.coalesce(within("clicked_at", "seen_at", click_minutes), F.lit(False))
    return shown.select(
        "purchase_id", "click_id", F.when(seen, F.col("impression_id")).alias("impression_id"),
        "click_campaign", F.when(seen, F.col("impression_campaign")).alias("impression_campaign"),
        F.when(seen, F.col("seen_at")).alias("seen_at"), "clicked_at", "bought_at", "revenue")


def session_depth(events: DataFrame) -> DataFrame:
    """The furthest funnel stage each session reached and its number of events."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in CART_STAGES]),
                                       F.col("event_type")), F.lit(0))
    sessions = events.groupBy("session_id").agg(
        F.max(rank).cast("int").alias("depth"), F.count("*").alias("events"))
    stage = F.when(F.col("depth") > 0, F.element_at(
        F.array(*[F.lit(s) for s in CART_STAGES]), F.greatest(F.col("depth"), F.lit(1))))
    return sessions.select("session_id", "depth", stage.alias("furthest_stage"), "events")
