"""Insight views and dashboard boards over the serving tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.functions import advice, kpis
from cartpulse.operators.rollups import channel_aggregates, device_source_metrics
from cartpulse.schemas import CAMPAIGN_KEYS, DEFAULT_BUDGET, DEVICE_SOURCE_KEYS


def with_budget(performance: DataFrame, budgets: DataFrame | None = None) -> DataFrame:
    """Adds ``budget``: one constant, or the campaign's own (constant where missing).
    ``budgets`` has one row per campaign_id."""
    default = F.lit(DEFAULT_BUDGET)
    if budgets is None:
        return performance.withColumn("budget", default)
    known = budgets.select("campaign_id", "budget")
    return performance.join(known, "campaign_id", "left").withColumn(
        "budget", F.coalesce("budget", default.cast("double")))


def campaign_insights(performance: DataFrame, budgets: DataFrame | None = None) -> DataFrame:
    """Campaigns with budget use, their channel's totals and a budget recommendation.

    A campaign without a channel has no totals and is left out. The join carries
    no hint: its strategy follows the measured size of the channel totals.
    """
    campaigns = with_budget(performance, budgets)
    spend, revenue, roi = F.col("spend_to_date"), F.col("revenue"), F.col("roi")
    return campaigns.join(channel_aggregates(performance), "channel").select(
        *CAMPAIGN_KEYS,
        spend.alias("spend"),
        "budget",
        kpis.budget_utilization(spend, F.col("budget")).alias("budget_utilization"),
        "purchases", "revenue", "roas", "roi", "conversion_rate",
        F.col("total_spend").alias("channel_total_spend"),
        F.col("total_revenue").alias("channel_total_revenue"),
        "channel_roas",
        advice.budget_recommendation(roi).alias("budget_recommendation"),
        advice.potential_impact(roi, revenue, spend).alias("potential_impact"),
    )


def hourly_recommendations(hourly: DataFrame) -> DataFrame:
    """The recommendation that each single hour of a campaign would lead to."""
    spend = kpis.spend_to_date(F.col("impression_cost"), F.col("click_cost"))
    revenue = F.col("revenue")
    roi = kpis.roi(revenue, spend)
    return hourly.select(
        *CAMPAIGN_KEYS, "hour", spend.alias("spend"), "revenue", roi.alias("roi"),
        advice.budget_recommendation(roi).alias("budget_recommendation"),
        advice.potential_impact(roi, revenue, spend).alias("potential_impact"),
    )


def cart_conversion_insights(funnel: DataFrame) -> DataFrame:
    """Device and source metrics with a recommendation and the revenue it could add."""
    device, source = F.col("device_type"), F.col("traffic_source")
    rate, order_value = F.col("cart_to_purchase_rate"), F.col("average_order_value")
    return device_source_metrics(funnel).orderBy(
        "device_type", F.desc("average_order_value"), "traffic_source").select(
        *DEVICE_SOURCE_KEYS, "page_views", "add_to_carts", "purchases",
        F.round(rate, 2).alias("cart_to_purchase_rate"),
        F.round(order_value, 2).alias("average_order_value"),
        advice.cart_recommendation(device, source).alias("recommendation"),
        advice.potential_revenue_increase(device, rate, F.col("add_to_carts"), order_value)
        .alias("potential_revenue_increase"),
    )


# --- boards ---------------------------------------------------------------------

def campaign_board(performance: DataFrame) -> DataFrame:
    """Rounded campaign KPIs, best ROI first."""
    return performance.select(
        "campaign_name", "channel",
        F.round("spend_to_date", 2).alias("spend"),
        F.round("revenue", 2).alias("revenue"),
        F.round("roas", 2).alias("roas"),
        F.round("roi", 1).alias("roi"),
        F.round("conversion_rate", 2).alias("conversion_rate"),
        "impressions", "clicks", "purchases",
    ).orderBy(F.desc("roi"), "campaign_name", "channel")


def funnel_board(funnel: DataFrame) -> DataFrame:
    """Funnel per device and source, highest order value first."""
    order_value = kpis.average_order_value(F.sum("total_revenue"), F.sum("total_purchases"))
    return funnel.groupBy(*DEVICE_SOURCE_KEYS).agg(
        F.sum("total_product_views").alias("product_views"),
        F.sum("total_add_to_carts").alias("add_to_carts"),
        F.sum("total_purchases").alias("purchases"),
        F.round(F.avg("view_to_cart_rate"), 2).alias("view_to_cart_rate"),
        F.round(F.avg("cart_to_purchase_rate"), 2).alias("cart_to_purchase_rate"),
        F.round(order_value, 2).alias("average_order_value"),
    ).orderBy(F.desc("average_order_value"), *DEVICE_SOURCE_KEYS)


def campaign_snapshot_board(latest: DataFrame) -> DataFrame:
    return latest.select(
        "campaign_name", "channel", "spend_to_date", "revenue", "roas", "roi",
        "impressions", "clicks", "purchases",
    ).orderBy(F.desc("roi"), "campaign_name", "channel")


def cart_snapshot_board(latest: DataFrame) -> DataFrame:
    return latest.select(
        *DEVICE_SOURCE_KEYS, "page_views", "add_to_carts", "purchases", "revenue",
        "cart_to_purchase_rate",
    ).orderBy(F.desc("revenue"), *DEVICE_SOURCE_KEYS)


def sample_events(events: DataFrame, n: int = 3, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` events for a look at the data."""
    return (events.orderBy(*order_by) if order_by else events).limit(n)


def board_diff(before: DataFrame, after: DataFrame, keys: list[str],
               measures: list[str]) -> DataFrame:
    """Every key of either board with each measure before, after and its change."""
    same_key = reduce(
        lambda a, b: a & b, [F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys])
    marked = [df.withColumn("_present", F.lit(True)).alias(name)
              for df, name in ((before, "b"), (after, "a"))]
    joined = marked[0].join(marked[1], same_key, "full")
    status = (F.when(F.col("b._present").isNull(), "new")
              .when(F.col("a._present").isNull(), "gone").otherwise("kept"))
    columns = [F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys] + [status.alias("status")]
    for m in measures:
        columns += [F.col(f"b.{m}").alias(f"{m}_before"), F.col(f"a.{m}").alias(f"{m}_after"),
                    (F.col(f"a.{m}") - F.col(f"b.{m}")).alias(f"{m}_change")]
    return joined.select(*columns)
