"""Hourly metrics, campaign and funnel rollups, and rollups over those."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.functions import kpis
from cartpulse.schemas import (
    CAMPAIGN_KEYS, CART_STAGES, DEVICE_SOURCE_KEYS, FUNNEL_KEYS, MARKETING_STAGES,
)

CART_COUNTERS = ["page_views", "product_views", "add_to_carts", "checkout_starts", "purchases"]
MARKETING_COUNTERS = ["impressions", "clicks", "purchases"]


def _stage(name: str) -> Column:
    return F.col("event_type") == name


def hour() -> Column:
    return kpis.hour_of(F.col("event_time")).alias("hour")


def _counts(stages: list[str], names: list[str]) -> list[Column]:
    return [F.count_if(_stage(stage)).alias(name) for stage, name in zip(stages, names)]


def _amount(stage: str, column: str, name: str) -> Column:
    return F.sum(kpis.value_when(_stage(stage), F.col(column))).alias(name)


def _marketing_amounts() -> list[Column]:
    return [
        _amount("impression", "cost", "impression_cost"),
        _amount("click", "cost", "click_cost"),
        _amount("purchase", "revenue", "revenue"),
    ]


# --- marketing ----------------------------------------------------------------

def campaign_hourly(events: DataFrame) -> DataFrame:
    """Counts, distinct impression users, costs and revenue per campaign and hour.

    Events of any other type still open a group, with zero counts. The users
    are deduplicated map-side and over (group, user), so one hot campaign hour
    is spread over all tasks.
    """
    return events.groupBy(*CAMPAIGN_KEYS, hour()).agg(
        *_counts(MARKETING_STAGES, MARKETING_COUNTERS),
        F.count_distinct(F.when(_stage("impression"), F.col("user_id"))).alias("unique_visitors"),
        *_marketing_amounts(),
    )


def with_campaign_kpis(totals: DataFrame) -> DataFrame:
    """Campaign totals -> the serving columns with all marketing KPIs."""
    spend, revenue = F.col("spend_to_date"), F.col("revenue")
    impressions, clicks, purchases = (F.col(c) for c in MARKETING_COUNTERS)
    return totals.withColumn(
        "spend_to_date", kpis.spend_to_date(F.col("impression_cost"), F.col("click_cost"))
    ).select(
        *CAMPAIGN_KEYS, "start_date", "last_updated", "spend_to_date", "impressions", "clicks",
        "unique_visitors", "purchases", "revenue",
        kpis.ctr(clicks, impressions).alias("ctr"),
        kpis.cpc(F.col("click_cost"), clicks).alias("cpc"),
        kpis.cost_per_acquisition(spend, purchases).alias("cost_per_acquisition"),
        kpis.roas(revenue, spend).alias("roas"),
        kpis.roi(revenue, spend).alias("roi"),
        kpis.conversion_rate(purchases, clicks).alias("conversion_rate"),
    )


def campaign_performance(hourly: DataFrame) -> DataFrame:
    """Hourly metrics rolled up to one row per campaign. ``unique_visitors`` sums
    the hourly distinct counts: a user seen in two hours counts twice."""
    totals = hourly.groupBy(*CAMPAIGN_KEYS).agg(
        F.min("hour").alias("start_date"),
        F.max("hour").alias("last_updated"),
        *[F.sum(c).alias(c) for c in [
            *MARKETING_COUNTERS, "unique_visitors", "impression_cost", "click_cost", "revenue"]],
    )
    return with_campaign_kpis(totals)


def campaign_performance_from_events(events: DataFrame) -> DataFrame:
    """The same rows straight from events: one level and one shuffle less.

    A sum of hourly distinct users is the number of distinct (hour, user) pairs.
    """
    visit = F.when(_stage("impression") & F.col("user_id").isNotNull(),
                   F.struct("hour", "user_id"))
    totals = events.withColumn("hour", hour()).groupBy(*CAMPAIGN_KEYS).agg(
        F.min("hour").alias("start_date"),
        F.max("hour").alias("last_updated"),
        *_counts(MARKETING_STAGES, MARKETING_COUNTERS),
        F.count_distinct(visit).alias("unique_visitors"),
        *_marketing_amounts(),
    )
    return with_campaign_kpis(totals)


def channel_aggregates(performance: DataFrame) -> DataFrame:
    """Spend, revenue, purchases, ROAS and mean conversion rate per channel."""
    totals = performance.groupBy("channel").agg(
        F.sum("spend_to_date").alias("total_spend"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("purchases").alias("total_purchases"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
    )
    return totals.withColumn(
        "channel_roas", kpis.channel_roas(F.col("total_revenue"), F.col("total_spend")))


# --- cart funnel ---------------------------------------------------------------

def cart_hourly(events: DataFrame) -> DataFrame:
    """Stage counts, distinct page-view sessions and revenue per segment and hour."""
    return events.groupBy(hour(), *FUNNEL_KEYS).agg(
        *_counts(CART_STAGES, CART_COUNTERS),
        F.count_distinct(F.when(_stage("page_view"), F.col("session_id")))
        .alias("unique_sessions"),
        _amount("purchase", "revenue", "revenue"),
    )


def with_funnel_kpis(totals: DataFrame) -> DataFrame:
    """Segment totals -> the serving columns with all stage rates."""
    views, products, carts, checkouts, purchases = (F.col(f"total_{c}") for c in CART_COUNTERS)
    return totals.select(
        *FUNNEL_KEYS, "start_date", "last_updated", views, products, carts, checkouts, purchases,
        "total_revenue",
        kpis.page_to_product_rate(products, views).alias("page_to_product_rate"),
        kpis.view_to_cart_rate(carts, products).alias("view_to_cart_rate"),
        kpis.cart_to_checkout_rate(checkouts, carts).alias("cart_to_checkout_rate"),
        kpis.checkout_to_purchase_rate(purchases, checkouts).alias("checkout_to_purchase_rate"),
        kpis.cart_to_purchase_rate(purchases, carts).alias("cart_to_purchase_rate"),
        kpis.average_order_value(F.col("total_revenue"), purchases).alias("average_order_value"),
    )


def cart_funnel(hourly: DataFrame) -> DataFrame:
    """Hourly metrics rolled up to one row per device, source and category."""
    totals = hourly.groupBy(*FUNNEL_KEYS).agg(
        F.min("hour").alias("start_date"),
        F.max("hour").alias("last_updated"),
        *[F.sum(c).alias(f"total_{c}") for c in [*CART_COUNTERS, "revenue"]],
    )
    return with_funnel_kpis(totals)


def cart_funnel_from_events(events: DataFrame) -> DataFrame:
    """The same rows straight from events. No distinct count is involved, so
    each task ships one row per segment; this form also runs in a stream."""
    totals = events.withColumn("hour", hour()).groupBy(*FUNNEL_KEYS).agg(
        F.min("hour").alias("start_date"),
        F.max("hour").alias("last_updated"),
        *_counts(CART_STAGES, [f"total_{c}" for c in CART_COUNTERS]),
        _amount("purchase", "revenue", "total_revenue"),
    )
    return with_funnel_kpis(totals)


def _segment_metrics(funnel: DataFrame, keys: list[str], rate: str, order_value: str) -> DataFrame:
    totals = funnel.groupBy(*keys).agg(
        F.sum("total_page_views").alias("page_views"),
        F.sum("total_add_to_carts").alias("add_to_carts"),
        F.sum("total_purchases").alias("purchases"),
        F.sum("total_revenue").alias("revenue"),
        F.avg("cart_to_purchase_rate").alias(rate),
    )
    return totals.withColumn(
        order_value, kpis.average_order_value(F.col("revenue"), F.col("purchases")))


def device_metrics(funnel: DataFrame) -> DataFrame:
    """Totals per device; the rate is the plain mean of its segments' rates."""
    return _segment_metrics(funnel, ["device_type"], "avg_cart_to_purchase_rate",
                            "avg_order_value")


def device_source_metrics(funnel: DataFrame) -> DataFrame:
    """Totals per device and traffic source, as `device_metrics`."""
    return _segment_metrics(funnel, DEVICE_SOURCE_KEYS, "cart_to_purchase_rate",
                            "average_order_value")


def device_opportunity(metrics: DataFrame, device: str = "Mobile",
                       target: float = 0.45) -> DataFrame:
    """What a device would earn if ``target`` of its carts were bought."""
    totals = metrics.where(F.col("device_type") == device).agg(
        F.sum("add_to_carts").alias("current_add_to_carts"),
        F.sum("purchases").alias("current_purchases"),
        F.avg("avg_cart_to_purchase_rate").alias("current_cart_to_purchase_rate"),
        F.sum("revenue").alias("current_revenue"),
    )
    carts, revenue = F.col("current_add_to_carts"), F.col("current_revenue")
    return totals.select(
        F.lit(device).alias("device_type"),
        *totals.columns,
        carts.alias("potential_add_to_carts"),
        (carts * F.lit(target)).alias("potential_purchases"),
        (carts * F.lit(target) * kpis.average_order_value(revenue, F.col("current_purchases")))
        .alias("potential_revenue"),
    ).withColumn("revenue_increase", F.col("potential_revenue") - revenue)


# --- snapshots -----------------------------------------------------------------

def campaign_snapshot_latest(snapshots: DataFrame) -> DataFrame:
    """Highest value of every counter per campaign, with ROAS and ROI.

    This is the latest state as long as all counters only grow; see
    `snapshot_latest_row` for counters that may shrink.
    """
    newest = snapshots.groupBy(*CAMPAIGN_KEYS).agg(
        F.max("snapshot_time").alias("last_updated"),
        *[F.max(c).alias(c) for c in ["spend_to_date", *MARKETING_COUNTERS, "revenue"]],
    )
    return with_snapshot_roi(newest)


def with_snapshot_roi(newest: DataFrame) -> DataFrame:
    spend, revenue = F.col("spend_to_date"), F.col("revenue")
    return newest.withColumn("roas", kpis.roas(revenue, spend)).withColumn(
        "roi", kpis.roi(revenue, spend))


def cart_snapshot_latest(snapshots: DataFrame) -> DataFrame:
    """Highest value of every counter per device and source, with the purchase rate."""
    newest = snapshots.groupBy(*DEVICE_SOURCE_KEYS).agg(
        F.max("snapshot_time").alias("last_updated"),
        *[F.max(c).alias(c) for c in ["page_views", "add_to_carts", "purchases", "revenue"]],
    )
    return with_snapshot_rate(newest)


def with_snapshot_rate(newest: DataFrame) -> DataFrame:
    return newest.withColumn(
        "cart_to_purchase_rate",
        kpis.cart_to_purchase_rate(F.col("purchases"), F.col("add_to_carts")))


def snapshot_latest_row(snapshots: DataFrame, keys: list[str]) -> DataFrame:
    """The row with the highest ``snapshot_time`` per key, never mixing snapshots."""
    counters = [c for c in snapshots.columns if c not in keys and c != "snapshot_time"]
    newest = snapshots.groupBy(*keys).agg(
        F.max("snapshot_time").alias("last_updated"),
        F.max_by(F.struct(*counters), F.col("snapshot_time")).alias("newest"),
    ).select(*keys, "last_updated", "newest.*")
    return with_snapshot_roi(newest) if "spend_to_date" in counters else with_snapshot_rate(newest)
