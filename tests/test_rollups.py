import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from cartpulse import schemas
from cartpulse.operators import quality, rollups
from cartpulse.operators.insights import campaign_insights

T0 = datetime(2024, 1, 1, 10, 15)
KEY = ("C1", "Name", "Email")


def marketing(spark, rows):
    """(event_type, time, user, cost, revenue[, (id, name, channel)]) -> events."""
    full = []
    for i, (kind, time, user, cost, revenue, *key) in enumerate(rows):
        campaign, name, channel = key[0] if key else KEY
        full.append((kind, str(i), time, campaign, name, channel, user, "Mobile", None, None, None,
                     cost, revenue))
    return spark.createDataFrame(full, schemas.MARKETING_EVENTS)


def cart(spark, rows):
    """(event_type, time, session, revenue[, (device, source, category)]) -> events."""
    full = []
    for i, (kind, time, session, revenue, *key) in enumerate(rows):
        device, source, category = key[0] if key else ("Mobile", "Email", "Toys")
        full.append((kind, str(i), time, session, None, device, source, None, category, 1.0, 1,
                     None, None, None, revenue))
    return spark.createDataFrame(full, schemas.CART_EVENTS)


def both_forms(events):
    two = rollups.campaign_performance(rollups.campaign_hourly(events)).collect()
    one = rollups.campaign_performance_from_events(events).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))
    return one


def test_impressions_only(spark):
    row, = both_forms(marketing(spark, [("impression", T0, "u", 2.0, None)] * 2))
    assert (row.impressions, row.clicks, row.purchases) == (2, 0, 0)
    assert (row.ctr, row.cpc, row.cost_per_acquisition, row.conversion_rate) == (0.0, None, None, None)
    assert (row.roas, row.roi) == (0.0, -100.0)


def test_purchase_only(spark):
    events = marketing(spark, [("purchase", T0, "u", None, 10.0)])
    row, = both_forms(events)
    assert (row.spend_to_date, row.cost_per_acquisition) == (0.0, 0.0)
    assert {row.roas, row.roi, row.ctr, row.cpc, row.conversion_rate} == {None}
    insight = campaign_insights(rollups.campaign_performance_from_events(events)).first()
    assert insight.budget_recommendation == "Decrease budget by 40%"
    assert insight.potential_impact == -4.0 and insight.channel_roas is None


def test_unknown_type_still_opens_a_group(spark):
    row, = both_forms(marketing(spark, [("signup", T0, "u", 5.0, 5.0), (None, T0, "u", 1.0, 1.0)]))
    assert (row.impressions, row.clicks, row.purchases, row.unique_visitors) == (0, 0, 0, 0)
    assert (row.spend_to_date, row.revenue, row.roas) == (0.0, 0.0, None)


def test_missing_cost(spark):
    row, = both_forms(marketing(spark, [("impression", T0, "u", None, None)]))
    assert row.impressions == 1 and row.spend_to_date is None and row.roas is None


def test_visitors(spark):
    later = T0 + timedelta(hours=1)
    row, = both_forms(marketing(spark, [
        ("impression", T0, "u", 1.0, None), ("impression", T0, "u", 1.0, None),
        ("impression", later, "u", 1.0, None), ("impression", T0, None, 1.0, None),
        ("click", T0, "v", 1.0, None)]))
    assert row.unique_visitors == 2
    assert (row.start_date, row.last_updated) == (datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 11))


def test_null_time_and_keys_are_groups(spark):
    rows = both_forms(marketing(spark, [
        ("impression", None, "u", 1.0, None, (None, None, None)),
        ("impression", T0, "u", 1.0, None, (None, None, None)),
        ("impression", T0, "w", 1.0, None, ("C1", "Other name", "Email"))]))
    assert sorted((r.campaign_id or "", r.impressions, r.unique_visitors) for r in rows) == [
        ("", 2, 2), ("C1", 1, 1)]


def test_cart_edges(spark):
    events = cart(spark, [("page_view", T0, "s", None), ("page_view", T0, "s", None),
                          ("purchase", T0, "s", 7.0), ("unknown", T0, "s", 3.0)])
    hourly = rollups.cart_hourly(events).first()
    assert (hourly.page_views, hourly.unique_sessions, hourly.revenue) == (2, 1, 7.0)
    two = rollups.cart_funnel(rollups.cart_hourly(events)).first()
    assert two == rollups.cart_funnel_from_events(events).first()
    assert (two.page_to_product_rate, two.view_to_cart_rate) == (0.0, None)
    assert (two.cart_to_purchase_rate, two.average_order_value) == (None, 7.0)


def test_mean_rate_skips_null(spark):
    rows = [("add_to_cart", T0, "s", None, ("Mobile", "Email", "Toys"))] * 10
    rows += [("purchase", T0, "s", 4.0, ("Mobile", "Email", "Toys")),
             ("purchase", T0, "s", 6.0, ("Mobile", "Email", "Beauty"))]
    funnel = rollups.cart_funnel_from_events(cart(spark, rows))
    device = rollups.device_metrics(funnel).first()
    assert (device.avg_cart_to_purchase_rate, device.avg_order_value) == (10.0, 5.0)
    chance = rollups.device_opportunity(rollups.device_metrics(funnel)).first()
    assert chance.potential_purchases == 4.5 and chance.revenue_increase == 4.5 * 5.0 - 10.0


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_campaign_against_brute_force(spark, seed):
    """One campaign, one hour and one user hold a third of all rows each."""
    rng = random.Random(seed)
    rows = []
    for _ in range(3000):
        campaign = "HOT" if rng.random() < 0.4 else f"C{rng.randrange(30)}"
        hour = 0 if rng.random() < 0.4 else rng.randrange(48)
        user = "bot" if rng.random() < 0.4 else f"u{rng.randrange(200)}"
        kind = rng.choice(["impression", "click", "purchase", "other"])
        rows.append((kind, T0 + timedelta(hours=hour, seconds=rng.randrange(2000)), user,
                     rng.randrange(64) / 64, rng.randrange(640) / 64, (campaign, campaign, "Email")))
    expected = defaultdict(lambda: [0, 0, 0, set(), 0.0, 0.0])
    for kind, time, user, cost, revenue, key in rows:
        e = expected[key[0]]
        if kind == "impression":
            e[0], e[4] = e[0] + 1, e[4] + cost
            e[3].add((time.replace(minute=0, second=0), user))
        elif kind == "click":
            e[1], e[4] = e[1] + 1, e[4] + cost
        elif kind == "purchase":
            e[2], e[5] = e[2] + 1, e[5] + revenue
    events = marketing(spark, rows).repartition(7)
    got = {r.campaign_id: [r.impressions, r.clicks, r.purchases, r.unique_visitors,
                           r.spend_to_date, r.revenue] for r in both_forms(events)}
    assert got == {k: [*e[:3], len(e[3]), *e[4:]] for k, e in expected.items()}
    check = quality.conservation(
        events, rollups.campaign_hourly(events), schemas.MARKETING_STAGES,
        rollups.MARKETING_COUNTERS).first()
    assert check.conserved and check.events == 3000 and check.known_events < 3000


def test_snapshots_mix_only_in_the_per_column_form(spark):
    rows = [("C1", "N", "Email", T0, 100.0, 10, 5, 2, 50.0),
            ("C1", "N", "Email", T0 + timedelta(days=1), 80.0, 20, 6, 3, 400.0)]
    snapshots = spark.createDataFrame(rows, schemas.CAMPAIGN_SNAPSHOTS)
    mixed = rollups.campaign_snapshot_latest(snapshots).first()
    whole = rollups.snapshot_latest_row(snapshots, schemas.CAMPAIGN_KEYS).first()
    assert (mixed.spend_to_date, mixed.revenue, mixed.roas) == (100.0, 400.0, 4.0)
    assert (whole.spend_to_date, whole.revenue, whole.roas) == (80.0, 400.0, 5.0)
    assert mixed.last_updated == whole.last_updated == T0 + timedelta(days=1)


def test_stage_counts(spark):
    counts = quality.stage_counts({"a": spark.range(3), "b": spark.range(0)}).collect()
    assert {r["stage"]: r["rows"] for r in counts} == {"a": 3, "b": 0}


@pytest.mark.parametrize("table,rollup", [
    ("campaign_performance", lambda s: rollups.campaign_performance_from_events(marketing(s, []))),
    ("campaign_performance", lambda s: rollups.campaign_performance(
        rollups.campaign_hourly(marketing(s, [])))),
    ("cart_conversion_funnel", lambda s: rollups.cart_funnel_from_events(cart(s, []))),
    ("cart_conversion_funnel", lambda s: rollups.cart_funnel(rollups.cart_hourly(cart(s, [])))),
    ("marketing_campaigns", lambda s: rollups.campaign_snapshot_latest(
        s.createDataFrame([], schemas.CAMPAIGN_SNAPSHOTS))),
    ("cart_analytics", lambda s: rollups.cart_snapshot_latest(
        s.createDataFrame([], schemas.CART_SNAPSHOTS)))])
def test_rollups_have_the_serving_columns(spark, table, rollup):
    declared = [(f.name, f.dataType) for f in schemas.SERVING_TABLES[table][0]]
    df = rollup(spark)
    assert [(f.name, f.dataType) for f in df.schema] == declared
    assert df.count() == 0
