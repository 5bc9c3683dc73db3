"""Answers that follow the stream: one pass, closed time, views, alerts, returns, audits."""

import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cartpulse import schemas
from cartpulse.operators import decisions, insights, quality, rollups, visitors
from cartpulse.plans import flows
from cartpulse.session import streaming_session
from cartpulse.sources import event_table, events, serving
from cartpulse.streaming import abandonment, anomalies, audit, closing, views
from cartpulse.streaming import rollups as streaming

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)
HOUR = timedelta(hours=1)


class Feed:
    """Deliveries of hand-made events to one stream that resumes after each."""

    def __init__(self, spark, kind, start):
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        self.spark, self.kind, self.start = spark, kind, start
        self.topic, self.out, self.checkpoint = (f"{base}/{n}" for n in ("topic", "out", "ckpt"))
        self.session, self.all = streaming_session(spark), None

    def deliver(self, rows):
        df = rows if not isinstance(rows, list) else events_of(self.spark, self.kind, rows)
        events.publish(df, self.topic)
        if isinstance(rows, list):
            self.all = df if self.all is None else self.all.unionByName(df)
        stream = events.read_events(self.session, self.kind, self.topic, streaming=True)
        query = self.start(stream, self.out, self.checkpoint)
        query.awaitTermination()
        return query

    def close(self, hours):
        self.deliver(closing.closing_events(self.all, self.kind, hours))

    def rows(self):
        return serving.read_changelog(self.spark, self.out)


def events_of(spark, kind, rows):
    schema = schemas.EVENTS[kind]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    rows = [sorted(map(str, df.select(*columns).collect())) for df in (a, b)]
    assert rows[0] == rows[1]


# --- one pass over the events ----------------------------------------------------------------

def seen(user, at, stage="impression", campaign="CAMP-001"):
    return {"event_type": stage, "event_time": at, "user_id": user, "campaign_id": campaign,
            "campaign_name": "a", "channel": "Email", "event_id": f"{user}-{at}", "cost": 0.5}


def test_exact_visitors_take_one_pass_over_one_source(spark):
    feed = Feed(spark, "marketing", streaming.start_campaign_performance)
    query = feed.deliver(flows.marketing(spark, SF))
    assert [len(p["sources"]) for p in query.recentProgress] == [1] * len(query.recentProgress)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1000
    plan = query._jsq.explainInternal(False)
    assert plan.count("Scan ") == 1
    same(serving.latest_version(feed.rows(), schemas.CAMPAIGN_KEYS), flows.performance(spark, SF))


def test_visitors_of_closed_hours_are_forgotten(spark):
    def remembered():
        state = spark.read.format("statestore").option("operatorId", 1).option(
            "stateVarName", "seen").load(feed.checkpoint)
        return state.count()

    feed = Feed(spark, "marketing", lambda *args: streaming.start_campaign_performance(
        *args, forget="10 minutes"))
    feed.deliver([seen("u", T0), seen("u", T0 + HOUR / 2), seen("v", T0), seen("u", T0 + HOUR)])
    assert remembered() == 3
    feed.deliver([seen("w", T0 + 9 * HOUR)])
    assert remembered() == 1
    feed.deliver([seen("u", T0 + 9 * HOUR), seen("late", T0)])
    current = serving.latest_version(feed.rows(), schemas.CAMPAIGN_KEYS).first()
    assert (current.unique_visitors, current.impressions) == (5, 6)
    assert current.start_date == T0 and current.last_updated == T0 + 9 * HOUR


def test_one_visitor_with_most_events_reaches_the_state_once_a_batch(spark):
    rows = [seen("hot", T0 + timedelta(seconds=i % 3600)) for i in range(5000)]
    rows += [seen(f"u{i}", T0) for i in range(50)] + [seen(None, T0), seen("x", None)]
    feed = Feed(spark, "marketing", streaming.start_campaign_performance)
    query = feed.deliver(rows)
    met = [o for p in query.recentProgress for o in p["stateOperators"]
           if o["operatorName"].startswith("transformWithState")]
    assert met and sum(o["numRowsUpdated"] for o in met) == 52
    same(serving.latest_version(feed.rows(), schemas.CAMPAIGN_KEYS),
         rollups.campaign_performance_from_events(feed.all))


# --- mergeable sketches ------------------------------------------------------------------------

def test_merged_sketches_count_a_visitor_once(spark):
    rows = spark.range(400_000).selectExpr(
        "'impression' as event_type", "concat('u', id % 60000) as user_id",
        "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 96 as int)) "
        "as event_time", "'c' as campaign_id", "'n' as campaign_name", "'Email' as channel")
    rows = rows.unionByName(rows.limit(3).withColumn("user_id", F.lit(None).cast("string")))
    sketches = visitors.hourly_sketches(rows)
    got = visitors.unique_visitors(sketches, ["channel"]).first().unique_visitors
    assert abs(got - 60_000) <= 60_000 * visitors.ERROR
    days = visitors.unique_visitors(sketches, [F.col("hour").cast("date").alias("day")]).collect()
    # a day meets a quarter of the users, again and again
    assert len(days) == 4 and all(abs(d.unique_visitors - 15_000) <= 15_000 * visitors.ERROR
                                  for d in days)
    near = visitors.checked(visitors.unique_visitors(sketches, ["channel"]), rows, ["channel"],
                            ["channel"]).first()
    assert near.exact_visitors == 60_000 and near.within_error
    nobody = visitors.hourly_sketches(rows.where("user_id is null"))
    assert visitors.unique_visitors(nobody, ["channel"]).first().unique_visitors == 0


# --- closed days -----------------------------------------------------------------------------------

def test_days_are_written_once_when_they_close(spark):
    feed = Feed(spark, "marketing", closing.start_closed_days)
    feed.deliver([seen("u", T0 + HOUR), seen("u", T0 + 5 * HOUR), seen("v", T0 + 23 * HOUR),
                  seen("w", None)])
    feed.deliver([seen("w", T0 + 23.5 * HOUR, "click"), seen("u", T0 + 25 * HOUR)])
    first = feed.rows().collect()
    assert not first or [r.day for r in first] == [T0.date()]
    feed.close(48)
    got = {r.day: r for r in feed.rows().collect()}
    assert set(got) == {T0.date(), (T0 + 24 * HOUR).date()}
    day = got[T0.date()]
    assert (day.impressions, day.clicks, day.hours, day.unique_visitors) == (3, 1, 3, 2)
    assert (day.impression_cost, day.click_cost, day.revenue) == (1.5, 0.5, 0.0)


# --- live view -----------------------------------------------------------------------------------

def test_view_follows_events_and_budgets(spark):
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    feed = Feed(spark, "marketing", lambda stream, out, checkpoint: views.start_campaign_insights(
        stream, lambda s: s.read.parquet(f"{base}/budgets"), out, checkpoint))

    def budget(value):
        spark.createDataFrame([("CAMP-001", value)], "campaign_id string, budget double") \
            .write.mode("overwrite").parquet(f"{base}/budgets")

    budget(10.0)
    feed.deliver([seen("u", T0), seen("v", T0, campaign="CAMP-002")])
    shown = {r.campaign_id: r.budget for r in views.read_view(spark, feed.out).collect()}
    assert shown == {"CAMP-001": 10.0, "CAMP-002": float(schemas.DEFAULT_BUDGET)}
    budget(99.0)
    feed.deliver([seen("w", T0 + HOUR, campaign="CAMP-002")])     # the other campaign changes
    same(views.read_view(spark, feed.out), insights.campaign_insights(
        rollups.campaign_performance_from_events(feed.all),
        spark.read.parquet(f"{base}/budgets")))
    assert {r.campaign_id: r.budget for r in views.read_view(spark, feed.out).collect()}[
        "CAMP-001"] == 99.0


# --- alerts --------------------------------------------------------------------------------------

def step(stage, at, user="u", session="s", device="Mobile"):
    return {"event_type": stage, "event_time": at, "user_id": user, "session_id": session,
            "device_type": device, "event_id": f"{stage}{at}{user}{session}"}


def test_alerts_equal_batch_with_quiet_hours(spark):
    rows = []
    for h in [*range(30), 33, 34, 70, 71, 72]:
        at = T0 + h * HOUR
        rows += [step("checkout_start", at + timedelta(minutes=m)) for m in range(10)]
        rows += [step("purchase", at + timedelta(minutes=m)) for m in range(1 if h == 29 else
                                                                            6 + h % 3)]
        if h % 2:
            rows += [step("checkout_start", at, device=None), step("page_view", at, device="TV")]
    feed = Feed(spark, "cart", lambda *args: anomalies.start_rate_anomalies(
        args[0], ["device_type"], *args[1:]))
    cut = len(rows) // 2
    feed.deliver(rows[:cut])
    feed.deliver(rows[cut:])
    feed.close(4)
    wanted = decisions.rate_anomalies(rollups.cart_hourly(feed.all), ["device_type"])
    rounded = [df.withColumns({c: F.round(c, 5) for c in ("change_percent", "score")})
               for df in (feed.rows().drop("batch_id"), wanted)]
    same(*rounded)
    assert wanted.where("is_anomaly").count() > 0


# --- returns ----------------------------------------------------------------------------------------

def test_abandoned_carts_are_told_when_they_are_certain(spark):
    rows = [
        # comes back after 47 hours; after 49 hours; never
        step("add_to_cart", T0, "a", "a1"), step("page_view", T0 + 47 * HOUR, "a", "a2"),
        step("add_to_cart", T0, "b", "b1"), step("page_view", T0 + 49 * HOUR, "b", "b2"),
        step("add_to_cart", T0 + HOUR, "c", "c1"),
        # bought after all; back within the hour; the session itself goes on; a tie
        step("add_to_cart", T0, "d", "d1"), step("purchase", T0 + 2 * HOUR, "d", "d1"),
        step("add_to_cart", T0, "e", "e1"), step("page_view", T0 + HOUR / 4, "e", "e2"),
        step("add_to_cart", T0, "f", "f1"), step("page_view", T0 + 3 * HOUR, "f", "f1"),
        step("add_to_cart", T0, "g", "g1"), step("add_to_cart", T0, "g", "g2"),
        # on the very deadline; nobody; no time
        step("add_to_cart", T0, "h", "h1"), step("page_view", T0 + 48 * HOUR, "h", "h2"),
        step("add_to_cart", T0, None, "n1"), step("add_to_cart", None, "o", "o1"),
    ]
    feed = Feed(spark, "cart", abandonment.start_abandoned_carts)
    feed.deliver([r for r in rows if r["event_time"] is None or r["event_time"] < T0 + HOUR / 2])
    feed.deliver([r for r in rows if r["event_time"] and r["event_time"] >= T0 + HOUR / 2])
    assert not [r for r in feed.rows().collect() if r.user_id in ("c", "f")]
    feed.close(60)
    got = {r.session_id: r.returned for r in feed.rows().collect()}
    assert got == {"a1": True, "b1": False, "c1": False, "e1": True, "f1": False, "g1": False,
                   "g2": False, "h1": True}
    same(abandonment.return_rate(feed.rows()), decisions.return_rate(
        feed.all.where("event_time is not null")))


def test_carts_over_batches_are_plain_tables(spark):
    feed = Feed(spark, "cart", abandonment.start_abandoned_carts)
    batches = [
        [step("add_to_cart", T0, "a", "a1"), step("add_to_cart", T0, "b", "b1"),
         step("add_to_cart", T0 + HOUR, "c", None)],
        [step("page_view", T0 + 40 * HOUR, "a", "a2")],
        # a1 and b1 are over; the one goes on, which is late for no one else
        [step("page_view", T0 + 50 * HOUR, "b", "b2")],
        [step("add_to_cart", T0 + 51 * HOUR, "a", "a1"), step("add_to_cart", T0, "late", "l1")],
    ]
    for rows in batches:
        query = feed.deliver(rows)
        assert [p["stateOperators"] for p in query.recentProgress if p["numInputRows"]] == [[]]
    feed.close(60)
    got = [(r.user_id, r.session_id, r.returned) for r in feed.rows().collect()]
    assert sorted(got, key=str) == sorted([
        ("a", "a1", True), ("b", "b1", False), ("c", None, False), ("a", "a1", False)], key=str)


def test_some_short_lived_users_return_and_some_do_not(spark):
    cart = event_table.with_short_lived_users(flows.cart(spark, SF), 2)
    rate = decisions.return_rate(cart).first()
    assert 0 < rate.returning_users < rate.users_with_abandoned_cart


# --- counts and audits ----------------------------------------------------------------------------

def test_stages_are_counted_while_they_pass(spark):
    flow = quality.Counted()
    rows = flow.through("rows", spark.range(100))
    kept = flow.through("kept", rows.where("id % 4 = 0"))
    assert flow.through("rows", rows) is rows
    flows.stored(spark, kept, "kept")
    assert {r.stage: r.rows for r in flow.counts(spark).collect()} == {"rows": 100, "kept": 25}


def test_audit_finds_what_state_and_changelog_do_not_share(spark):
    feed = Feed(spark, "cart", streaming.start_cart_funnel)
    feed.deliver(flows.cart(spark, SF))
    names = {2: "total_page_views", 6: "total_purchases", 7: "total_revenue"}

    def disagreeing():
        rows = audit.compared(spark, feed.checkpoint, feed.out, schemas.FUNNEL_KEYS, names)
        return rows.where("not agree").collect()

    assert disagreeing() == []
    row = feed.rows().drop("batch_id").limit(1)
    serving.append_changelog(row.withColumn("total_purchases", F.col("total_purchases") + 1),
                             feed.out, 7)
    serving.append_changelog(row.withColumn("device_type", F.lit("Watch")), feed.out, 8)
    found = disagreeing()
    assert len(found) == 2 and {r.state_total_purchases is None for r in found} == {True, False}


def test_closing_events_of_nothing(spark):
    none = flows.marketing(spark, SF).limit(0)
    assert closing.closing_events(none, "marketing", 4).count() == 0


# --- rows that bite ----------------------------------------------------------------------------------

def test_refunds_make_the_highest_counters_differ_from_the_latest(spark):
    snapshots = event_table.campaign_snapshots(event_table.with_refunds(flows.marketing(spark, SF)))
    highest = {r.campaign_id: r.revenue for r in rollups.campaign_snapshot_latest(snapshots).collect()}
    latest = {r.campaign_id: r.revenue for r in rollups.snapshot_latest_row(
        snapshots, schemas.CAMPAIGN_KEYS).collect()}
    assert all(highest[c] >= latest[c] for c in latest)
    assert any(highest[c] > latest[c] for c in latest)


def test_bucketed_tables_join_without_a_shuffle(spark):
    from cartpulse.plans.registry import QUERIES
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.enabled", "false")
    joined = QUERIES["bucketed_join"](session, SF)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.where("agree").count() == 5
