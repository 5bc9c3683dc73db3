"""Business questions over campaign and funnel rollups.

Means and totals over all rows are one-row scalar subqueries rather than
windows without a partition, so no step pulls a whole table into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.functions import advice, kpis
from cartpulse.operators.insights import with_budget
from cartpulse.schemas import CAMPAIGN_KEYS, FUNNEL_KEYS


def _overall(df: DataFrame, **aggregates: Column) -> Column:
    """Aggregates over all rows of ``df`` as one struct column."""
    return df.agg(F.struct(*[c.alias(name) for name, c in aggregates.items()])).scalar()


# --- campaigns --------------------------------------------------------------------

def top_campaigns(performance: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` campaigns of highest ROI and how their conversion compares to the mean."""
    mean = performance.agg(F.avg("conversion_rate")).scalar()
    return performance.select(
        *CAMPAIGN_KEYS, "spend_to_date", "revenue", "purchases", "roas", "roi", "conversion_rate",
        mean.alias("mean_conversion_rate"),
    ).orderBy(F.desc_nulls_last("roi"), *CAMPAIGN_KEYS).limit(k)


def budget_reallocation(performance: DataFrame, budgets: DataFrame | None = None) -> DataFrame:
    """Each campaign's unspent budget raised or cut by its ROI band.

    An overspent campaign has nothing left to move. ``unallocated`` is what all
    cuts free beyond all raises, the same on every row.
    """
    remaining = F.greatest(F.col("budget") - F.col("spend_to_date"), F.lit(0.0))
    plan = with_budget(performance, budgets).select(
        *CAMPAIGN_KEYS, "roi", "budget", F.col("spend_to_date").alias("spend"),
        remaining.alias("remaining"),
        (remaining * (1 + advice.budget_change(F.col("roi")))).alias("new_allocation"),
    ).withColumn("change", F.col("new_allocation") - F.col("remaining"))
    return plan.withColumn("unallocated", -plan.agg(F.sum("change")).scalar())


def budget_shift_impact(performance: DataFrame, source: str, target: str,
                        share: float) -> DataFrame:
    """Revenue gained by moving ``share`` of one campaign's spend to another at its ROI."""
    def total(column, campaign):
        return F.sum(F.when(F.col("campaign_id") == campaign, F.col(column)))

    totals = performance.where(F.col("campaign_id").isin(source, target)).agg(
        total("spend_to_date", source).alias("source_spend"),
        kpis.roi(total("revenue", target), total("spend_to_date", target)).alias("target_roi"),
    )
    moved = F.col("source_spend") * F.lit(share)
    return totals.select(
        F.lit(source).alias("source_campaign"), F.lit(target).alias("target_campaign"),
        "source_spend", "target_roi", moved.alias("moved_spend"),
        (moved * F.col("target_roi") / 100.0).alias("additional_revenue"),
    )


def peer_gap(performance: DataFrame) -> DataFrame:
    """ROAS against the mean of all campaigns, acquisition cost against the mean of the others."""
    cost = F.col("cost_per_acquisition")
    peers = _overall(performance, mean_roas=F.avg("roas"), cost_sum=F.sum(cost),
                     cost_count=F.count(cost))
    others = kpis.safe_div(F.col("peers.cost_sum") - cost, F.col("peers.cost_count") - 1)
    return performance.withColumn("peers", peers).select(
        *CAMPAIGN_KEYS, "roas",
        F.col("peers.mean_roas").alias("mean_roas"),
        ((kpis.safe_div(F.col("roas"), F.col("peers.mean_roas")) - 1) * 100.0)
        .alias("roas_gap_percent"),
        "cost_per_acquisition",
        others.alias("others_cost_per_acquisition"),
        ((kpis.safe_div(cost, others) - 1) * 100.0).alias("cost_gap_percent"),
    )


# --- cart funnel --------------------------------------------------------------------

def _funnel_totals(funnel: DataFrame, keys: list[str]) -> DataFrame:
    """Totals per segment with ratio-of-sums rates."""
    totals = funnel.groupBy(*keys).agg(
        F.sum("total_product_views").alias("product_views"),
        F.sum("total_add_to_carts").alias("add_to_carts"),
        F.sum("total_purchases").alias("purchases"),
        F.sum("total_revenue").alias("revenue"),
    )
    carts, purchases = F.col("add_to_carts"), F.col("purchases")
    return totals.withColumns({
        "view_to_cart_rate": kpis.view_to_cart_rate(carts, F.col("product_views")),
        "cart_to_purchase_rate": kpis.cart_to_purchase_rate(purchases, carts),
        "abandonment_rate": kpis.percent(carts - purchases, carts),
        "average_order_value": kpis.average_order_value(F.col("revenue"), purchases),
    })


def _abandoned() -> Column:
    return F.col("add_to_carts") - F.col("purchases")


def cart_abandonment(funnel: DataFrame) -> DataFrame:
    """Abandoned carts per device and the revenue they stand for, largest loss first."""
    return _funnel_totals(funnel, ["device_type"]).select(
        "device_type", "add_to_carts", "purchases",
        _abandoned().alias("abandoned_carts"), "abandonment_rate", "average_order_value",
        (_abandoned() * F.col("average_order_value")).alias("revenue_at_risk"),
    ).orderBy(F.desc("revenue_at_risk"))


def growth_segments(funnel: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` segments with the most revenue left in abandoned carts.

    The score is this library's choice: abandoned carts times order value.
    """
    return _funnel_totals(funnel, FUNNEL_KEYS).select(
        *FUNNEL_KEYS, "revenue", "cart_to_purchase_rate", "average_order_value",
        "add_to_carts", "purchases",
        (_abandoned() * F.col("average_order_value")).alias("headroom"),
    ).orderBy(F.desc_nulls_last("headroom"), *FUNNEL_KEYS).limit(k)


def source_effectiveness(funnel: DataFrame) -> DataFrame:
    """Purchase rate and order value per traffic source, with each one's rank by rate
    and the extremes marked. The ranking reads one number per traffic source."""
    totals = _funnel_totals(funnel, ["traffic_source"])
    rate, value = F.col("cart_to_purchase_rate"), F.col("average_order_value")
    extremes = _overall(totals, best=F.max(rate), worst=F.min(rate), value=F.max(value),
                        rates=F.collect_list(rate))
    better = F.when(rate.isNull(), F.size("extremes.rates")).otherwise(
        F.size(F.filter("extremes.rates", lambda other: other > rate)))
    return totals.withColumn("extremes", extremes).select(
        "traffic_source", "add_to_carts", "purchases", "cart_to_purchase_rate",
        "average_order_value", (better + 1).cast("long").alias("rate_rank"),
        (rate == F.col("extremes.best")).alias("is_highest_converting"),
        (rate == F.col("extremes.worst")).alias("is_lowest_converting"),
        (value == F.col("extremes.value")).alias("is_highest_order_value"),
    ).orderBy("rate_rank", "traffic_source")


def category_insights(funnel: DataFrame) -> DataFrame:
    """Abandonment, stage rates and order value per product category."""
    return _funnel_totals(funnel, ["product_category"]).select(
        "product_category", "add_to_carts", "purchases", "abandonment_rate",
        "view_to_cart_rate", "cart_to_purchase_rate", "average_order_value",
    ).orderBy(F.desc("abandonment_rate"), "product_category")


def device_gap(funnel: DataFrame, baseline: str = "Desktop") -> DataFrame:
    """Purchase rate of every device against a baseline device."""
    totals = _funnel_totals(funnel, ["device_type"])
    rate = F.col("cart_to_purchase_rate")
    reference = totals.where(F.col("device_type") == baseline).agg(F.max(rate)).scalar()
    return totals.select(
        "device_type", "cart_to_purchase_rate", "abandonment_rate",
        reference.alias("baseline_rate"),
    ).withColumn("rate_gap", rate - F.col("baseline_rate"))


# --- revenue over time ------------------------------------------------------------------

def daily_revenue(events: DataFrame) -> DataFrame:
    return events.groupBy(F.col("event_time").cast("date").alias("day")).agg(
        F.sum(kpis.value_when(F.col("event_type") == "purchase", F.col("revenue")))
        .alias("revenue"))


def revenue_forecast(daily: DataFrame, target: float, days_left: int) -> DataFrame:
    """Where revenue ends up at the current daily rate, and the rate the target needs.
    The rate is the mean over all calendar days from the first to the last one."""
    totals = daily.agg(
        F.sum("revenue").alias("revenue"),
        (F.datediff(F.max("day"), F.min("day")) + 1).alias("days"),
    ).withColumn("run_rate", kpis.safe_div(F.col("revenue"), F.col("days")))
    goal, left = F.lit(float(target)), F.lit(days_left)
    required = (goal - F.col("revenue")) / left
    projected = F.col("revenue") + F.col("run_rate") * left
    return totals.select(
        "revenue", goal.alias("target"), kpis.percent(F.col("revenue"), goal).alias("reached_percent"),
        left.alias("days_left"), "run_rate",
        projected.alias("projected_revenue"),
        (goal - projected).alias("shortfall"),
        required.alias("required_run_rate"),
        ((kpis.safe_div(required, F.col("run_rate")) - 1) * 100.0).alias("run_rate_gap_percent"),
    )


def rate_anomalies(hourly: DataFrame, by: list[str], k: float = 2.0,
                   trailing_hours: int = 24) -> DataFrame:
    """Checkout-to-purchase rate per hour against the hour before and the trailing hours.

    The score is the distance to the trailing mean in standard deviations; ``k``
    or more is an anomaly. Frames are ranges of calendar time, so an hour without
    events counts as missing instead of shifting the frame. Each window holds one
    row per hour of a segment. Values are cut to 6 digits before dividing, which
    keeps a spread of rounding noise at zero.
    """
    rates = hourly.groupBy(*by, "hour").agg(
        F.sum("checkout_starts").alias("checkout_starts"), F.sum("purchases").alias("purchases"),
    ).withColumn("rate", kpis.checkout_to_purchase_rate(
        F.col("purchases"), F.col("checkout_starts")))

    keys = ", ".join("`" + name.replace("`", "``") + "`" for name in by)

    def over(function: str, first: int, last: int) -> Column:
        return F.expr(
            f"{function}(rate) OVER (PARTITION BY {keys} ORDER BY hour RANGE BETWEEN "
            f"INTERVAL '{first}' HOUR PRECEDING AND INTERVAL '{last}' HOUR PRECEDING)")

    scored = rates.withColumns({
        "previous_rate": over("max", 1, 1),
        "trailing_mean": over("avg", trailing_hours, 1),
        "trailing_stddev": over("stddev_samp", trailing_hours, 1),
    })
    return scored_rates(scored, by, k)


def scored_rates(rates: DataFrame, by: list[str], k: float) -> DataFrame:
    """Change and score of rates that stand beside ``previous_rate``, ``trailing_mean`` and
    ``trailing_stddev``."""
    distance = F.round(F.col("rate") - F.col("trailing_mean"), 6)
    spread = F.round("trailing_stddev", 6)
    score = F.round(kpis.safe_div(distance, spread), 6)
    change = (kpis.safe_div(F.col("rate"), F.col("previous_rate")) - 1) * 100.0
    return rates.select(
        *by, "hour", "checkout_starts", "purchases", "rate", "previous_rate",
        change.alias("change_percent"),
        F.round("trailing_mean", 6).alias("trailing_mean"), spread.alias("trailing_stddev"),
        score.alias("score"),
        F.coalesce(F.abs(score) >= k, F.lit(False)).alias("is_anomaly"),
    )


# --- visitors ---------------------------------------------------------------------------

def _had(stage: str) -> Column:
    """Whether any event of the group is of ``stage``."""
    return F.max(F.coalesce(F.col("event_type") == stage, F.lit(False)))


def return_rate(events: DataFrame, hours: int = 48) -> DataFrame:
    """Share of known users with an abandoned cart who come back within ``hours`` (>= 1).

    An abandoned cart is a session with an add_to_cart and no purchase; coming
    back is any event of the user after the session's last one.

    A user's rows are first reduced to one per hour (first and last event, first
    abandonment): the earliest abandonment of an hour decides for that hour, as
    any later one is itself an event that follows it. So the window over a user
    is bounded by the calendar, however many events the user has.
    """
    visits = events.where(F.col("user_id").isNotNull()).groupBy(
        "user_id", "session_id", kpis.hour_of(F.col("event_time")).alias("hour")).agg(
        F.min("event_time").alias("first_at"),
        F.max("event_time").alias("last_at"),
        _had("add_to_cart").alias("carted"), _had("purchase").alias("bought"),
    )
    session = "PARTITION BY user_id, session_id"
    ended = visits.select(
        "user_id", "hour", "first_at", "last_at",
        F.expr(f"""CASE WHEN max(carted) OVER ({session}) AND NOT max(bought) OVER ({session})
                         AND last_at = max(last_at) OVER ({session}) THEN last_at END""")
        .alias("left_at"),
    )
    active = ended.groupBy("user_id", "hour").agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"),
        F.min("left_at").alias("left_at"))
    following = F.expr("lead(first_at) OVER (PARTITION BY user_id ORDER BY hour)")
    deadline = F.col("left_at") + F.make_dt_interval(F.lit(0), F.lit(hours))
    back = (F.col("left_at") < F.col("last_at")) | (F.col("next_at") <= deadline)
    users = active.withColumn("next_at", following).groupBy("user_id").agg(
        F.max(F.col("left_at").isNotNull()).alias("abandoned"),
        F.max(F.coalesce(back, F.lit(False))).alias("returned"),
    )
    return users.agg(
        F.count_if("abandoned").alias("users_with_abandoned_cart"),
        F.count_if(F.col("abandoned") & F.col("returned")).alias("returning_users"),
    ).withColumn("return_rate", kpis.percent(
        F.col("returning_users"), F.col("users_with_abandoned_cart")))


def views_vs_conversion(events: DataFrame, threshold: int = 3, unit: str = "user_id") -> DataFrame:
    """Share of buyers among users (or sessions) with at least ``threshold`` distinct
    products viewed, and among all others."""
    kind = F.col("event_type")
    users = events.where(F.col(unit).isNotNull()).groupBy(unit).agg(
        F.count_distinct(F.when(kind == "product_view", F.col("product_id"))).alias("products"),
        _had("purchase").alias("bought"),
    )
    many = F.when(F.col("products") >= threshold, f"{threshold}+").otherwise(f"under {threshold}")
    return users.groupBy(many.alias("products_viewed")).agg(
        F.count("*").alias("visitors"), F.count_if("bought").alias("buyers"),
    ).withColumn("conversion_rate", kpis.percent(F.col("buyers"), F.col("visitors")))


def first_visit_abandonment(events: DataFrame) -> DataFrame:
    """Cart abandonment in the first session of known users and in all later ones."""
    sessions = events.where(F.col("user_id").isNotNull()).groupBy("user_id", "session_id").agg(
        F.min("event_time").alias("started_at"),
        _had("add_to_cart").cast("int").alias("carts"), _had("purchase").alias("bought"),
    ).withColumn("abandoned", F.when(F.col("bought"), 0).otherwise(F.col("carts")))
    users = sessions.groupBy("user_id").agg(
        F.min(F.struct("started_at", "session_id", "carts", "abandoned")).alias("first"),
        F.sum("carts").alias("carts"), F.sum("abandoned").alias("abandoned"),
        F.count("*").alias("sessions"),
    )
    totals = users.agg(
        F.count("*").alias("users"), F.sum("sessions").alias("sessions"),
        F.sum("first.carts").alias("first_carts"),
        F.sum("first.abandoned").alias("first_abandoned"),
        F.sum("carts").alias("carts"), F.sum("abandoned").alias("abandoned"),
    )

    def row(visit: str, sessions: Column, carts: Column, abandoned: Column) -> Column:
        return F.struct(F.lit(visit).alias("visit"), sessions.alias("sessions"),
                        carts.alias("carts"), abandoned.alias("abandoned"))

    first = [F.col("users"), F.col("first_carts"), F.col("first_abandoned")]
    everything = [F.col("sessions"), F.col("carts"), F.col("abandoned")]
    rows = F.array(row("first", *first),
                   row("returning", *[a - f for a, f in zip(everything, first)]))
    return totals.select(F.inline(rows)).withColumn(
        "abandonment_rate", kpis.percent(F.col("abandoned"), F.col("carts")))
