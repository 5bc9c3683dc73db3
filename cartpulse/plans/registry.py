"""Every registered query: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.operators import decisions, insights, journeys, quality, rollups, visitors
from cartpulse.plans import flows
from cartpulse.schemas import (
    CAMPAIGN_KEYS, CART_STAGES, DEVICE_SOURCE_KEYS, FUNNEL_KEYS, MARKETING_EVENTS,
    MARKETING_STAGES,
)
from cartpulse.session import streaming_session, work_dir
from cartpulse.sources import event_table, events, serving
from cartpulse.streaming import abandonment, anomalies, audit, closing, days, quarantine, views
from cartpulse.streaming import journeys as streaming_journeys
from cartpulse.streaming import rollups as streaming

Query = Callable[[SparkSession, str], DataFrame]

# Deliveries of the changelog queries; other queries that need several have two.
DELIVERIES = 3
# Covers the events' own disorder (a follow-up up to 16 minutes after the events around it).
WATERMARK = "20 minutes"


def _two_deliveries(source, spark, sf_dir, column: str = "event_time") -> list[DataFrame]:
    return flows.split_by_time(
        source(spark, sf_dir), column, flows.delivery_days(spark, sf_dir, 2))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means depend on the order of addition in their last digits; compare 6 decimals."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- rollups ------------------------------------------------------------------------

def campaign_hourly(spark, sf_dir):
    return rollups.campaign_hourly(flows.marketing(spark, sf_dir))


def campaign_performance(spark, sf_dir):
    return rollups.campaign_performance(campaign_hourly(spark, sf_dir))


def cart_hourly(spark, sf_dir):
    return rollups.cart_hourly(flows.cart(spark, sf_dir))


def cart_funnel(spark, sf_dir):
    return rollups.cart_funnel(cart_hourly(spark, sf_dir))


def channel_aggregates(spark, sf_dir):
    return _rounded(rollups.channel_aggregates(flows.performance(spark, sf_dir)),
                    "avg_conversion_rate")


def device_metrics(spark, sf_dir):
    return _rounded(rollups.device_metrics(flows.funnel(spark, sf_dir)),
                    "avg_cart_to_purchase_rate")


def device_source_metrics(spark, sf_dir):
    return _rounded(rollups.device_source_metrics(flows.funnel(spark, sf_dir)),
                    "cart_to_purchase_rate")


def mobile_opportunity(spark, sf_dir):
    metrics = rollups.device_metrics(flows.funnel(spark, sf_dir))
    return _rounded(rollups.device_opportunity(metrics), "current_cart_to_purchase_rate")


def campaign_snapshot_latest(spark, sf_dir):
    return rollups.campaign_snapshot_latest(flows.campaign_snapshots(spark, sf_dir))


def cart_snapshot_latest(spark, sf_dir):
    return rollups.cart_snapshot_latest(flows.cart_snapshots(spark, sf_dir))


def campaign_snapshot_latest_row(spark, sf_dir):
    return rollups.snapshot_latest_row(flows.campaign_snapshots(spark, sf_dir), CAMPAIGN_KEYS)


def _refunded_snapshots(spark, sf_dir):
    return event_table.campaign_snapshots(event_table.with_refunds(flows.marketing(spark, sf_dir)))


def refunded_snapshot_latest(spark, sf_dir):
    """Highest counters where some shrink: not the latest state."""
    return rollups.campaign_snapshot_latest(_refunded_snapshots(spark, sf_dir))


def refunded_snapshot_latest_row(spark, sf_dir):
    return rollups.snapshot_latest_row(_refunded_snapshots(spark, sf_dir), CAMPAIGN_KEYS)


def cart_snapshot_latest_row(spark, sf_dir):
    return rollups.snapshot_latest_row(flows.cart_snapshots(spark, sf_dir), DEVICE_SOURCE_KEYS)


# --- views and boards ------------------------------------------------------------------

def _served_performance(spark, sf_dir):
    return flows.served(spark, flows.performance(spark, sf_dir), "campaign_performance")


def _served_funnel(spark, sf_dir):
    return flows.served(spark, flows.funnel(spark, sf_dir), "cart_conversion_funnel")


def campaign_insights(spark, sf_dir):
    return insights.campaign_insights(_served_performance(spark, sf_dir))


def campaign_insights_budgets(spark, sf_dir):
    return insights.campaign_insights(
        _served_performance(spark, sf_dir), event_table.budgets(spark))


def hourly_recommendations(spark, sf_dir):
    return insights.hourly_recommendations(campaign_hourly(spark, sf_dir))


def cart_conversion_insights(spark, sf_dir):
    return insights.cart_conversion_insights(flows.funnel(spark, sf_dir))


def campaign_board(spark, sf_dir):
    return insights.campaign_board(flows.performance(spark, sf_dir))


def funnel_board(spark, sf_dir):
    return insights.funnel_board(flows.funnel(spark, sf_dir))


def campaign_snapshot_board(spark, sf_dir):
    return insights.campaign_snapshot_board(campaign_snapshot_latest(spark, sf_dir))


def cart_snapshot_board(spark, sf_dir):
    return insights.cart_snapshot_board(cart_snapshot_latest(spark, sf_dir))


def sample_events(spark, sf_dir):
    return insights.sample_events(flows.marketing(spark, sf_dir), 3, ["event_time", "event_id"])


def board_diff(spark, sf_dir):
    marketing = flows.marketing(spark, sf_dir)
    first, _ = _two_deliveries(flows.marketing, spark, sf_dir)
    before, after = (rollups.campaign_performance_from_events(e) for e in (first, marketing))
    return insights.board_diff(before, after, CAMPAIGN_KEYS,
                               ["spend_to_date", "revenue", "roi", "impressions", "purchases"])


def campaign_unique_visitors(spark, sf_dir):
    """Visitors per campaign over all time, from hourly sketches that are stored once, beside
    the exact number and the sum of the hours that counts them again."""
    marketing = flows.marketing(spark, sf_dir)
    sketches = flows.stored(spark, visitors.hourly_sketches(marketing), "visitor-sketches")
    near = visitors.checked(visitors.unique_visitors(sketches, CAMPAIGN_KEYS), marketing,
                            CAMPAIGN_KEYS, CAMPAIGN_KEYS)
    summed = flows.performance(spark, sf_dir).select(
        *CAMPAIGN_KEYS, F.col("unique_visitors").alias("summed_over_hours"))
    return near.drop("unique_visitors").alias("n").join(
        summed.alias("s"), [F.col(f"n.{k}").eqNullSafe(F.col(f"s.{k}")) for k in CAMPAIGN_KEYS]
    ).select("n.*", "summed_over_hours")


def channel_daily_visitors(spark, sf_dir):
    """The same sketches merged to channels and days."""
    marketing = flows.marketing(spark, sf_dir)
    sketches = flows.stored(spark, visitors.hourly_sketches(marketing), "visitor-sketches")
    days_ = visitors.unique_visitors(sketches, ["channel", F.col("hour").cast("date").alias("day")])
    return visitors.checked(
        days_, marketing, ["channel", F.col("event_time").cast("date").alias("day")],
        ["channel", "day"]).drop("unique_visitors")


# --- checks ------------------------------------------------------------------------------

def stage_counts(spark, sf_dir):
    """Each stage feeds the next one: events -> stored hours -> serving table, and events ->
    snapshots -> serving table. Rows are counted as they pass, not read again."""
    flow = quality.Counted()
    marketing = flow.through("marketing_events", flows.marketing(spark, sf_dir))
    cart = flow.through("cart_events", flows.cart(spark, sf_dir))
    campaign_hours = flows.stored(spark, flow.through(
        "campaign_hourly_metrics", rollups.campaign_hourly(marketing)), "campaign-hours")
    cart_hours = flows.stored(spark, flow.through(
        "cart_hourly_metrics", rollups.cart_hourly(cart)), "cart-hours")
    snapshots = flow.through("campaign_snapshots", flows.campaign_snapshots(spark, sf_dir))
    cart_snapshots = flow.through("cart_snapshots", flows.cart_snapshots(spark, sf_dir))
    for name, rows in (
            ("campaign_performance", rollups.campaign_performance(campaign_hours)),
            ("cart_conversion_funnel", rollups.cart_funnel(cart_hours))):
        flows.served(spark, flow.through(name, rows), name)
    flows.served(spark, rollups.campaign_snapshot_latest(snapshots), "marketing_campaigns")
    flows.served(spark, rollups.cart_snapshot_latest(cart_snapshots), "cart_analytics")
    return flow.counts(spark)


def campaign_conservation(spark, sf_dir):
    return quality.conservation(
        flows.marketing(spark, sf_dir), campaign_hourly(spark, sf_dir),
        MARKETING_STAGES, rollups.MARKETING_COUNTERS)


def cart_conservation(spark, sf_dir):
    return quality.conservation(
        flows.cart(spark, sf_dir), cart_hourly(spark, sf_dir), CART_STAGES, rollups.CART_COUNTERS)


# --- streams -----------------------------------------------------------------------------

def _late_first(source, spark, sf_dir, column: str = "event_time") -> list[DataFrame]:
    """Deliveries in the wrong order: all events of the second one arrive late."""
    return list(reversed(_two_deliveries(source, spark, sf_dir, column)))


def stream_campaign_performance(spark, sf_dir):
    changelog = flows.streamed(
        spark, "stream-campaigns", events.read_events, "marketing",
        _late_first(flows.marketing, spark, sf_dir),
        lambda stream, out, checkpoint: streaming.start_campaign_performance(
            stream, out, checkpoint, in_tables=True))
    return serving.latest_version(changelog, CAMPAIGN_KEYS)


def stream_resent_events(spark, sf_dir):
    """The first delivery arrives twice; copies count once."""
    first, second = _two_deliveries(flows.marketing, spark, sf_dir)
    changelog = flows.streamed(
        spark, "stream-resent", events.read_events, "marketing", [first, second, first],
        lambda stream, out, checkpoint: streaming.start_campaign_performance(
            stream, out, checkpoint, dedup="event_id", in_tables=True))
    return serving.latest_version(changelog, CAMPAIGN_KEYS)


def stream_estimated_visitors(spark, sf_dir):
    """Estimated visitors against exact ones; three standard deviations are 15 %."""
    changelog = flows.streamed(
        spark, "stream-estimated", events.read_events, "marketing",
        _two_deliveries(flows.marketing, spark, sf_dir),
        lambda stream, out, checkpoint: streaming.start_campaign_performance(
            stream, out, checkpoint, exact_visitors=False))
    found = serving.latest_version(changelog, CAMPAIGN_KEYS).alias("e")
    exact = flows.performance(spark, sf_dir).alias("x")
    off = F.abs(F.col("e.unique_visitors") - F.col("x.unique_visitors"))
    return found.join(exact, [F.col(f"e.{k}").eqNullSafe(F.col(f"x.{k}")) for k in CAMPAIGN_KEYS]
                      ).select(*[f"e.{k}" for k in CAMPAIGN_KEYS], "e.impressions", "e.revenue",
                               (off <= 0.15 * F.col("x.unique_visitors")).alias("within_error"))


def stream_cart_funnel(spark, sf_dir):
    changelog = flows.streamed(
        spark, "stream-funnel", events.read_events, "cart",
        _late_first(flows.cart, spark, sf_dir), streaming.start_cart_funnel)
    return serving.latest_version(changelog, FUNNEL_KEYS)


def _stream_by_day(kind, keys, source, spark, sf_dir):
    changelog = flows.streamed(
        spark, f"stream-{kind}-days", events.read_events, kind,
        _late_first(source, spark, sf_dir),
        lambda stream, out, checkpoint: days.start_by_day(stream, kind, out, checkpoint),
        "changelog")
    return serving.latest_version(changelog, keys)


def _stream_hourly(kind, keys, source, spark, sf_dir):
    changelog = flows.streamed(
        spark, f"stream-{kind}-hours", events.read_events, kind,
        _late_first(source, spark, sf_dir),
        lambda stream, out, checkpoint: streaming.start_hourly(stream, kind, out, checkpoint))
    return serving.latest_version(changelog, [*keys, "hour"])


def stream_hourly_watermarked(spark, sf_dir):
    deliveries = _two_deliveries(flows.marketing, spark, sf_dir)
    return flows.streamed(
        spark, "stream-closed-hours", events.read_events, "marketing", deliveries,
        lambda stream, out, checkpoint: streaming.start_hourly(
            stream, "marketing", out, checkpoint, watermark=WATERMARK)).drop(serving.BATCH_ID)


def _until_closed(source, kind, hours, spark, sf_dir) -> list[DataFrame]:
    """Two deliveries and the events that close the feed, so many hours after its last."""
    return [*_two_deliveries(source, spark, sf_dir),
            closing.closing_events(source(spark, sf_dir), kind, hours)]


def stream_attribution(spark, sf_dir):
    """Every purchase with its links; the closing events settle those at the end."""
    return flows.streamed(
        spark, "stream-attribution", events.read_events, "marketing",
        _until_closed(flows.marketing, "marketing", 4, spark, sf_dir),
        streaming_journeys.start_attribution).drop(serving.BATCH_ID)


def _near_exact(days: DataFrame, marketing: DataFrame) -> DataFrame:
    """Days with the exact number of visitors and whether the estimate is near it."""
    day = F.col("event_time").cast("date").alias("day")
    by = [*CAMPAIGN_KEYS, "day"]
    near = visitors.checked(days, marketing, [*CAMPAIGN_KEYS, day], by)
    rows = days.drop("unique_visitors").alias("d").join(
        near.drop("unique_visitors").alias("n"),
        [F.col(f"d.{k}").eqNullSafe(F.col(f"n.{k}")) for k in by])
    return rows.select("d.*", "exact_visitors", "within_error")


def stream_closed_days(spark, sf_dir):
    days_ = flows.streamed(
        spark, "stream-closed-days", events.read_events, "marketing",
        _until_closed(flows.marketing, "marketing", 48, spark, sf_dir),
        closing.start_closed_days).drop(serving.BATCH_ID)
    return _near_exact(days_, flows.marketing(spark, sf_dir))


def stream_rate_anomalies(spark, sf_dir):
    return _rounded(flows.streamed(
        spark, "stream-anomalies", events.read_events, "cart",
        _until_closed(flows.cart, "cart", 4, spark, sf_dir),
        lambda stream, out, checkpoint: anomalies.start_rate_anomalies(
            stream, ["device_type"], out, checkpoint)).drop(serving.BATCH_ID), "change_percent")


def _short_lived(spark, sf_dir):
    return event_table.with_short_lived_users(flows.cart(spark, sf_dir), 2)


def return_rate_short_lived(spark, sf_dir):
    return decisions.return_rate(_short_lived(spark, sf_dir))


def stream_return_rate(spark, sf_dir):
    carts = flows.streamed(
        spark, "stream-carts", events.read_events, "cart",
        _until_closed(_short_lived, "cart", 60, spark, sf_dir), abandonment.start_abandoned_carts)
    return abandonment.return_rate(carts)


def stream_campaign_insights(spark, sf_dir):
    """The live view after the budgets have changed between two batches."""
    base = work_dir(spark, "live-insights")
    budgets, topic, out = f"{base}/budgets", f"{base}/topic", f"{base}/out"
    session = streaming_session(spark)
    first = event_table.budgets(spark).withColumn("budget", F.lit(1.0))
    for table, delivery in zip((first, event_table.budgets(spark)),
                               _two_deliveries(flows.marketing, spark, sf_dir)):
        table.write.mode("overwrite").parquet(budgets)
        events.publish(delivery, topic)
        views.start_campaign_insights(
            events.read_events(session, "marketing", topic, streaming=True),
            lambda s: s.read.parquet(budgets), out, f"{base}/checkpoint").awaitTermination()
    return views.read_view(spark, out)


def stream_unique_visitors(spark, sf_dir):
    changelog = flows.streamed(
        spark, "stream-visitors", events.read_events, "marketing",
        _late_first(flows.marketing, spark, sf_dir), streaming.start_visitor_sketches)
    sketches = serving.latest_version(changelog, [*CAMPAIGN_KEYS, "hour"])
    return visitors.checked(
        visitors.unique_visitors(sketches, CAMPAIGN_KEYS), flows.marketing(spark, sf_dir),
        CAMPAIGN_KEYS, CAMPAIGN_KEYS).drop("unique_visitors")


def stream_state_audit(spark, sf_dir):
    """State and published totals of the funnel stream after a restart between deliveries."""
    base = work_dir(spark, "stream-audit")
    topic, out, checkpoint = f"{base}/topic", f"{base}/out", f"{base}/checkpoint"
    session = streaming_session(spark)
    for delivery in _late_first(flows.cart, spark, sf_dir):
        events.publish(delivery, topic)
        streaming.start_cart_funnel(
            events.read_events(session, "cart", topic, streaming=True), out,
            checkpoint).awaitTermination()
    return audit.compared(session, checkpoint, out, FUNNEL_KEYS, {
        2: "total_page_views", 6: "total_purchases", 7: "total_revenue"})


def _stream_snapshots(kind, keys, source, spark, sf_dir):
    changelog = flows.streamed(
        spark, f"stream-{kind}-snapshots", events.read_snapshots, kind,
        _late_first(source, spark, sf_dir, "snapshot_time"),
        lambda stream, out, checkpoint: streaming.start_snapshot_latest(
            stream, kind, out, checkpoint))
    return serving.latest_version(changelog, keys)


# --- changelog and round trips --------------------------------------------------------------

def _campaign_changelog_path(spark, sf_dir):
    return flows.changelog_by_day(
        spark, "campaign", flows.marketing(spark, sf_dir),
        flows.delivery_days(spark, sf_dir, DELIVERIES),
        rollups.campaign_hourly, rollups.campaign_performance, CAMPAIGN_KEYS)


def _campaign_changelog(spark, sf_dir):
    return serving.read_changelog(spark, _campaign_changelog_path(spark, sf_dir))


def _funnel_changelog_path(spark, sf_dir):
    return flows.changelog_by_day(
        spark, "funnel", flows.cart(spark, sf_dir),
        flows.delivery_days(spark, sf_dir, DELIVERIES),
        rollups.cart_hourly, rollups.cart_funnel, FUNNEL_KEYS)


def _funnel_changelog(spark, sf_dir):
    return serving.read_changelog(spark, _funnel_changelog_path(spark, sf_dir))


def changelog_compacted(spark, sf_dir):
    """Current campaigns from the first two batches, folded, and the newest batch."""
    path, fold = _campaign_changelog_path(spark, sf_dir), work_dir(spark, "campaign-fold")
    serving.fold_changelog(spark, path, CAMPAIGN_KEYS, fold, through=1)
    return serving.read_latest(spark, path, CAMPAIGN_KEYS, fold)


def changelog_compacted_twice(spark, sf_dir):
    """Current segments after a second fold that starts from the first one."""
    path = _funnel_changelog_path(spark, sf_dir)
    first, second = (work_dir(spark, "funnel-fold") for _ in range(2))
    serving.fold_changelog(spark, path, FUNNEL_KEYS, first, through=0)
    serving.fold_changelog(spark, path, FUNNEL_KEYS, second, through=DELIVERIES - 1, earlier=first)
    return serving.read_latest(spark, path, FUNNEL_KEYS, second)


def changelog_overcount(spark, sf_dir):
    """Channel totals over all row versions beside those over current rows."""
    changelog = _campaign_changelog(spark, sf_dir)
    current = serving.latest_version(changelog, CAMPAIGN_KEYS)
    over, true = (rollups.channel_aggregates(df).select(
        "channel", "total_spend", "total_revenue", "total_purchases") for df in (changelog, current))
    return over.alias("o").join(true.alias("t"), "channel").select(
        "channel",
        *[F.col(f"o.{c}").alias(f"{c}_over_changelog") for c in over.columns if c != "channel"],
        *[F.col(f"t.{c}").alias(c) for c in true.columns if c != "channel"])


def changelog_skew(spark, sf_dir):
    return serving.changelog_skew(_campaign_changelog(spark, sf_dir), CAMPAIGN_KEYS)


# Boards and views as they look when they read every version of every row.

def campaign_board_over_changelog(spark, sf_dir):
    return insights.campaign_board(_campaign_changelog(spark, sf_dir))


def campaign_insights_over_changelog(spark, sf_dir):
    return insights.campaign_insights(_campaign_changelog(spark, sf_dir))


def funnel_board_over_changelog(spark, sf_dir):
    return insights.funnel_board(_funnel_changelog(spark, sf_dir))


def cart_insights_over_changelog(spark, sf_dir):
    return insights.cart_conversion_insights(_funnel_changelog(spark, sf_dir))


def publish_roundtrip(spark, sf_dir):
    topic = work_dir(spark, "topic")
    events.publish(flows.cart(spark, sf_dir), topic)
    return events.read_events(spark, "cart", topic)


def _damaged_topic(spark, sf_dir):
    """Published messages of which some are cut off and some carry text for a number."""
    marketing = flows.marketing(spark, sf_dir)
    tablet = F.col("device_type").eqNullSafe("Tablet")
    click = F.col("event_type").eqNullSafe("click")
    cut = F.expr("left(value, length(value) - 1)").alias("value")
    topic = work_dir(spark, "damaged-topic")
    events.publish(marketing.where(~tablet & ~click), topic)
    events.publish(marketing.where(~tablet & click).withColumn("cost", F.lit("unknown")), topic)
    events.publish_lines(events.to_lines(marketing.where(tablet)).select(cut), topic)
    return topic


def _damage(line):
    return F.when(line.endswith("}"), "unconvertible").otherwise("malformed")


def parse_json_quarantine(spark, sf_dir):
    lines = events.read_lines(spark, _damaged_topic(spark, sf_dir))
    parsed = events.parse_json(lines, MARKETING_EVENTS)
    corrupt = F.col(events.CORRUPT)
    kind = F.when(corrupt.isNull(), "good").otherwise(_damage(corrupt))
    return parsed.groupBy(kind.alias("line")).agg(
        F.count("*").alias("lines"), F.count("campaign_id").alias("with_campaign"))


def stream_quarantine(spark, sf_dir):
    topic, out = _damaged_topic(spark, sf_dir), work_dir(spark, "stream-quarantine")
    lines = events.read_lines(streaming_session(spark), topic, streaming=True)
    quarantine.start_quarantine(
        lines, MARKETING_EVENTS, f"{out}/lines", f"{out}/checkpoint").awaitTermination()
    return spark.read.text(f"{out}/lines").groupBy(_damage(F.col("value")).alias("line")).agg(
        F.count("*").alias("lines"))


def serving_roundtrip(spark, sf_dir):
    """The four serving tables, written and read back, as one list of measures."""
    tables = {
        "campaign_performance": (flows.performance, "campaign_id", "revenue", "roi"),
        "cart_conversion_funnel": (flows.funnel, "product_category", "total_revenue",
                                   "cart_to_purchase_rate"),
        "marketing_campaigns": (campaign_snapshot_latest, "campaign_id", "revenue", "roi"),
        "cart_analytics": (cart_snapshot_latest, "traffic_source", "revenue",
                           "cart_to_purchase_rate"),
    }
    rows = None
    for name, (source, label, revenue, ratio) in tables.items():
        part = flows.served(spark, source(spark, sf_dir), name).select(
            F.lit(name).alias("table_name"), F.col(label).alias("label"),
            F.col("last_updated"), F.col(revenue).alias("revenue"), F.col(ratio).alias("ratio"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def bucketed_join(spark, sf_dir):
    """Spend by events and by snapshots, from two tables bucketed by campaign, without a
    shuffle of either."""
    tables = {"campaign_performance": flows.performance(spark, sf_dir),
              "marketing_campaigns": campaign_snapshot_latest(spark, sf_dir)}
    saved = []
    for name, rows in tables.items():
        path = work_dir(spark, f"bucketed-{name}")
        table = f"{name}_{path[-32:]}"
        serving.save_serving_table(rows, name, table, 8, path)
        saved.append(spark.table(table))
    by_events, by_snapshots = saved[0].alias("e"), saved[1].alias("s")
    return by_events.join(by_snapshots, "campaign_id").select(
        "campaign_id", F.col("e.spend_to_date").alias("spend_by_events"),
        F.col("s.spend_to_date").alias("spend_by_snapshots"), "e.roi",
        (F.col("e.spend_to_date") == F.col("s.spend_to_date")).alias("agree"))


def upsert_roundtrip(spark, sf_dir):
    """Funnel rows of the first delivery; then those of mobile segments are brought up to
    date, and all others stay as they were."""
    path = work_dir(spark, "funnel-current")
    cart = flows.cart(spark, sf_dir)
    first, _ = _two_deliveries(flows.cart, spark, sf_dir)
    mobile = cart.where(F.col("device_type") == "Mobile")
    serving.upsert(rollups.cart_funnel_from_events(first), path, FUNNEL_KEYS, buckets=16)
    serving.upsert(rollups.cart_funnel_from_events(mobile), path, FUNNEL_KEYS, buckets=16)
    return serving.read_current(spark, path)


# --- business questions ------------------------------------------------------------------------

def top_campaigns(spark, sf_dir):
    return _rounded(decisions.top_campaigns(_served_performance(spark, sf_dir)),
                    "mean_conversion_rate")


def budget_reallocation(spark, sf_dir):
    return _rounded(
        decisions.budget_reallocation(_served_performance(spark, sf_dir),
                                      event_table.budgets(spark)),
        "remaining", "new_allocation", "change", "unallocated")


def budget_shift_impact(spark, sf_dir):
    return decisions.budget_shift_impact(
        flows.performance(spark, sf_dir), "CAMP-002", "CAMP-005", 0.3)


def peer_gap(spark, sf_dir):
    return _rounded(
        decisions.peer_gap(_served_performance(spark, sf_dir)),
        "mean_roas", "roas_gap_percent", "others_cost_per_acquisition", "cost_gap_percent")


def cart_abandonment(spark, sf_dir):
    return decisions.cart_abandonment(flows.funnel(spark, sf_dir))


def growth_segments(spark, sf_dir):
    return decisions.growth_segments(flows.funnel(spark, sf_dir))


def revenue_forecast(spark, sf_dir):
    return _rounded(
        decisions.revenue_forecast(decisions.daily_revenue(flows.cart(spark, sf_dir)),
                                   5_000_000, 32),
        "reached_percent", "run_rate", "projected_revenue", "shortfall", "required_run_rate",
        "run_rate_gap_percent")


def rate_anomalies(spark, sf_dir):
    return _rounded(decisions.rate_anomalies(cart_hourly(spark, sf_dir), ["device_type"]),
                    "change_percent")


def source_effectiveness(spark, sf_dir):
    return decisions.source_effectiveness(_served_funnel(spark, sf_dir))


def category_insights(spark, sf_dir):
    return decisions.category_insights(flows.funnel(spark, sf_dir))


def device_gap(spark, sf_dir):
    return _rounded(decisions.device_gap(_served_funnel(spark, sf_dir)), "rate_gap")


def return_rate(spark, sf_dir):
    return decisions.return_rate(flows.cart(spark, sf_dir))


def views_vs_conversion(spark, sf_dir):
    return decisions.views_vs_conversion(flows.cart(spark, sf_dir))


def session_views_vs_conversion(spark, sf_dir):
    return decisions.views_vs_conversion(flows.cart(spark, sf_dir), 2, "session_id")


def first_visit_abandonment(spark, sf_dir):
    return decisions.first_visit_abandonment(flows.cart(spark, sf_dir))


# --- journeys ------------------------------------------------------------------------------------

def attribution(spark, sf_dir):
    return journeys.attribution(flows.marketing(spark, sf_dir))


def session_depth(spark, sf_dir):
    return journeys.session_depth(flows.cart(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "campaign_hourly": campaign_hourly,
    "campaign_performance": campaign_performance,
    "campaign_performance_one_level": flows.performance,
    "channel_aggregates": channel_aggregates,
    "campaign_unique_visitors": campaign_unique_visitors,
    "channel_daily_visitors": channel_daily_visitors,
    "cart_hourly": cart_hourly,
    "cart_funnel": cart_funnel,
    "cart_funnel_one_level": flows.funnel,
    "device_metrics": device_metrics,
    "device_source_metrics": device_source_metrics,
    "mobile_opportunity": mobile_opportunity,
    "campaign_snapshot_latest": campaign_snapshot_latest,
    "cart_snapshot_latest": cart_snapshot_latest,
    "campaign_snapshot_latest_row": campaign_snapshot_latest_row,
    "refunded_snapshot_latest": refunded_snapshot_latest,
    "refunded_snapshot_latest_row": refunded_snapshot_latest_row,
    "cart_snapshot_latest_row": cart_snapshot_latest_row,
    "campaign_insights": campaign_insights,
    "hourly_recommendations": hourly_recommendations,
    "campaign_insights_budgets": campaign_insights_budgets,
    "cart_conversion_insights": cart_conversion_insights,
    "campaign_board": campaign_board,
    "funnel_board": funnel_board,
    "campaign_snapshot_board": campaign_snapshot_board,
    "cart_snapshot_board": cart_snapshot_board,
    "sample_events": sample_events,
    "board_diff": board_diff,
    "stage_counts": stage_counts,
    "campaign_conservation": campaign_conservation,
    "cart_conservation": cart_conservation,
    "stream_campaign_performance": stream_campaign_performance,
    "stream_cart_funnel": stream_cart_funnel,
    "stream_resent_events": stream_resent_events,
    "stream_estimated_visitors": stream_estimated_visitors,
    "stream_quarantine": stream_quarantine,
    "stream_campaign_by_day": partial(
        _stream_by_day, "marketing", CAMPAIGN_KEYS, flows.marketing),
    "stream_cart_by_day": partial(_stream_by_day, "cart", FUNNEL_KEYS, flows.cart),
    "stream_campaign_hourly": partial(
        _stream_hourly, "marketing", CAMPAIGN_KEYS, flows.marketing),
    "stream_cart_hourly": partial(_stream_hourly, "cart", FUNNEL_KEYS, flows.cart),
    "stream_hourly_watermarked": stream_hourly_watermarked,
    "stream_attribution": stream_attribution,
    "stream_closed_days": stream_closed_days,
    "stream_rate_anomalies": stream_rate_anomalies,
    "stream_return_rate": stream_return_rate,
    "stream_campaign_insights": stream_campaign_insights,
    "stream_unique_visitors": stream_unique_visitors,
    "stream_state_audit": stream_state_audit,
    "stream_campaign_snapshot_latest": partial(
        _stream_snapshots, "campaign", CAMPAIGN_KEYS, flows.campaign_snapshots),
    "stream_cart_snapshot_latest": partial(
        _stream_snapshots, "cart", DEVICE_SOURCE_KEYS, flows.cart_snapshots),
    "changelog_overcount": changelog_overcount,
    "changelog_skew": changelog_skew,
    "changelog_compacted": changelog_compacted,
    "changelog_compacted_twice": changelog_compacted_twice,
    "campaign_board_over_changelog": campaign_board_over_changelog,
    "campaign_insights_over_changelog": campaign_insights_over_changelog,
    "funnel_board_over_changelog": funnel_board_over_changelog,
    "cart_insights_over_changelog": cart_insights_over_changelog,
    "publish_roundtrip": publish_roundtrip,
    "parse_json_quarantine": parse_json_quarantine,
    "serving_roundtrip": serving_roundtrip,
    "upsert_roundtrip": upsert_roundtrip,
    "bucketed_join": bucketed_join,
    "top_campaigns": top_campaigns,
    "budget_reallocation": budget_reallocation,
    "budget_shift_impact": budget_shift_impact,
    "peer_gap": peer_gap,
    "cart_abandonment": cart_abandonment,
    "growth_segments": growth_segments,
    "revenue_forecast": revenue_forecast,
    "rate_anomalies": rate_anomalies,
    "source_effectiveness": source_effectiveness,
    "category_insights": category_insights,
    "device_gap": device_gap,
    "return_rate": return_rate,
    "return_rate_short_lived": return_rate_short_lived,
    "views_vs_conversion": views_vs_conversion,
    "session_views_vs_conversion": session_views_vs_conversion,
    "first_visit_abandonment": first_visit_abandonment,
    "attribution": attribution,
    "session_depth": session_depth,
}
