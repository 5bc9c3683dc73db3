import glob
import os
import random
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cartpulse import schemas
from cartpulse.operators import journeys, rollups
from cartpulse.plans import flows
from cartpulse.session import streaming_session
from cartpulse.sources import events, serving
from cartpulse.streaming import days, quarantine
from cartpulse.streaming import journeys as streaming_journeys
from cartpulse.streaming import rollups as streaming

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


class Run:
    """A topic folder, a changelog and a checkpoint of one streaming query."""

    def __init__(self):
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        self.topic, self.out, self.checkpoint = (f"{base}/{n}" for n in ("topic", "out", "ckpt"))

    def publish(self, df):
        events.publish(df, self.topic)

    def catch_up(self, spark, start, kind="marketing", read=events.read_events, files=None):
        stream = read(spark, kind, self.topic, streaming=True, max_files_per_trigger=files)
        query = start(stream, self.out, self.checkpoint)
        streaming.run_available(query)
        return query

    def latest(self, spark, keys):
        return serving.latest_version(serving.read_changelog(spark, self.out), keys)


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    rows = [sorted(map(str, df.select(*columns).collect())) for df in (a, b)]
    assert rows[0] == rows[1]


def test_campaigns_equal_batch_over_shuffled_files(spark):
    source = flows.marketing(spark, SF)
    run = Run()
    run.publish(source.repartition(4))
    query = run.catch_up(spark, streaming.start_campaign_performance, files=1)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    same(run.latest(spark, schemas.CAMPAIGN_KEYS), flows.performance(spark, SF))
    changelog = serving.read_changelog(spark, run.out)
    assert changelog.count() > 5 and changelog.select("batch_id").distinct().count() == 4
    over = changelog.agg(F.sum("revenue")).first()[0]
    assert over > run.latest(spark, schemas.CAMPAIGN_KEYS).agg(F.sum("revenue")).first()[0]


def test_only_touched_campaigns_get_a_new_version(spark):
    source = flows.marketing(spark, SF)
    run = Run()
    run.publish(source)
    run.catch_up(spark, streaming.start_campaign_performance)
    run.publish(source.where("campaign_id = 'CAMP-003'").limit(1))
    run.catch_up(spark, streaming.start_campaign_performance)
    newest = serving.read_changelog(spark, run.out).where("batch_id = 1").collect()
    assert [r.campaign_id for r in newest] == ["CAMP-003"]


def test_funnel_resumes_and_accepts_late_events(spark):
    source = flows.cart(spark, SF)
    parts = flows.split_by_time(source, "event_time", ["2024-01-11", "2024-01-21"])
    run = Run()
    for part in reversed(parts):
        run.publish(part)
        run.catch_up(spark, streaming.start_cart_funnel, "cart")
    same(run.latest(spark, schemas.FUNNEL_KEYS), flows.funnel(spark, SF))


def test_replayed_batch_replaces_itself(spark):
    run = Run()
    run.publish(flows.cart(spark, SF))
    run.catch_up(spark, streaming.start_cart_funnel, "cart")
    before = serving.read_changelog(spark, run.out)
    rows = before.drop("batch_id").toPandas()
    serving.append_changelog(spark.createDataFrame(rows), run.out, 0)
    after = serving.read_changelog(spark, run.out)
    assert after.count() == len(rows)


@pytest.mark.parametrize("kind,source,batch,keys", [
    ("marketing", flows.marketing, rollups.campaign_hourly, schemas.CAMPAIGN_KEYS),
    ("cart", flows.cart, rollups.cart_hourly, schemas.FUNNEL_KEYS)])
def test_hours_equal_batch(spark, kind, source, batch, keys):
    run = Run()
    run.publish(source(spark, SF).repartition(3))
    run.catch_up(spark, lambda s, out, ckpt: streaming.start_hourly(s, kind, out, ckpt), kind,
                 files=1)
    same(run.latest(spark, [*keys, "hour"]), batch(source(spark, SF)))


def test_open_hours_find_first_sightings_without_calls_per_visitor(spark):
    source = flows.marketing(spark, SF)
    run = Run()
    for part in (source.where("event_time < '2024-01-12'"), source, source.limit(50)):
        run.publish(part)
        query = run.catch_up(spark, lambda *args: streaming.start_hourly(
            args[0], "marketing", *args[1:]))
        assert [(len(p["sources"]), p["stateOperators"]) for p in query.recentProgress
                if p["numInputRows"]] == [(1, [])]
    twice = source.unionByName(source.where("event_time < '2024-01-12'")).unionByName(
        source.limit(50))
    same(run.latest(spark, [*schemas.CAMPAIGN_KEYS, "hour"]), rollups.campaign_hourly(twice))


def test_campaigns_in_tables_without_calls_per_visitor(spark, monkeypatch):
    """A late, a repeated and a lost batch; only campaigns of a batch get a new version."""
    source = flows.marketing(spark, SF)
    parts = [source.where("event_time >= '2024-01-12'"), source,
             source.where("campaign_id = 'CAMP-003'").limit(7)]
    run = Run()

    def start(stream, out, checkpoint):
        return streaming.start_campaign_performance(stream, out, checkpoint, in_tables=True)

    def dying(batch, path, batch_id):
        serving.append_changelog(batch, path, batch_id)
        if batch_id == 1:
            raise Lost
    for number, part in enumerate(parts):
        run.publish(part)
        if number == 1:
            with monkeypatch.context() as patch:
                patch.setattr(streaming, "append_changelog", dying)
                with pytest.raises(StreamingQueryException):
                    run.catch_up(spark, start)
        query = run.catch_up(spark, start)
        assert [(len(p["sources"]), p["stateOperators"]) for p in query.recentProgress
                if p["numInputRows"]] == [(1, [])]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    same(run.latest(spark, schemas.CAMPAIGN_KEYS), rollups.campaign_performance_from_events(every))
    newest = serving.read_changelog(spark, run.out).where("batch_id = 2").collect()
    assert [r.campaign_id for r in newest] == ["CAMP-003"]
    with pytest.raises(ValueError):
        streaming.start_campaign_performance(source, run.out, run.checkpoint, in_tables=True,
                                             forget="1 hour")


def test_edge_rows_in_tables_equal_batch(spark):
    rows = [("1", "impression", T0, None), ("2", "impression", T0, "u"), ("3", "other", T0, "u"),
            ("4", None, T0, "u"), ("5", "impression", None, "u"), ("6", "impression", None, "u"),
            ("7", "purchase", T0 + timedelta(days=40), "v")]
    run = Run()
    for part in (rows[:3], rows[3:], rows[:0], rows[5:6]):
        run.publish(marketing(spark, part))
        run.catch_up(spark, lambda *args: streaming.start_campaign_performance(
            *args, in_tables=True))
    same(run.latest(spark, schemas.CAMPAIGN_KEYS),
         rollups.campaign_performance_from_events(marketing(spark, rows + rows[5:6])))


def marketing(spark, rows):
    full = [(kind, number, time, "C", "N", "Email", user, "Mobile", None, None, None, 1.0, 2.0)
            for number, kind, time, user in rows]
    return spark.createDataFrame(full, schemas.MARKETING_EVENTS)


def test_edge_rows_equal_batch(spark):
    rows = [("1", "impression", T0, None), ("2", "impression", T0, "u"), ("3", "other", T0, "u"),
            ("4", None, T0, "u"), ("5", "impression", None, "u"), ("6", "impression", None, "u"),
            ("7", "purchase", T0 + timedelta(days=40), "v")]
    run = Run()
    for part in (rows[:3], rows[3:]):
        run.publish(marketing(spark, part))
        run.catch_up(spark, streaming.start_campaign_performance)
    same(run.latest(spark, schemas.CAMPAIGN_KEYS),
         rollups.campaign_performance_from_events(marketing(spark, rows)))


def test_hot_user_and_hour_against_batch(spark):
    rng = random.Random(5)
    rows = [(str(i), rng.choice(["impression", "click"]),
             T0 + timedelta(hours=0 if rng.random() < 0.4 else rng.randrange(9)),
             "bot" if rng.random() < 0.4 else f"u{rng.randrange(40)}") for i in range(600)]
    run = Run()
    run.publish(marketing(spark, rows).repartition(3))
    run.catch_up(spark, streaming.start_campaign_performance, files=1)
    same(run.latest(spark, schemas.CAMPAIGN_KEYS),
         rollups.campaign_performance(rollups.campaign_hourly(marketing(spark, rows))))


def test_estimated_visitors_read_the_input_once(spark):
    run = Run()
    run.publish(flows.marketing(spark, SF).repartition(2))
    query = run.catch_up(spark, lambda stream, out, checkpoint: streaming.start_campaign_performance(
        stream, out, checkpoint, exact_visitors=False), files=1)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1000
    exact = {r.campaign_id: r for r in flows.performance(spark, SF).collect()}
    for row in run.latest(spark, schemas.CAMPAIGN_KEYS).collect():
        assert row.unique_visitors == pytest.approx(exact[row.campaign_id].unique_visitors, rel=0.2)
        assert row.asDict() | {"unique_visitors": 0} == (
            exact[row.campaign_id].asDict() | {"unique_visitors": 0})


def test_dedup_drops_resent_events(spark):
    rows = [(str(i), "impression", T0, f"u{i}") for i in range(5)]
    run = Run()

    def start(stream, out, checkpoint):
        return streaming.start_campaign_performance(stream, out, checkpoint, dedup="event_id")
    for _ in range(2):
        run.publish(marketing(spark, rows))
        run.catch_up(spark, start)
    row = run.latest(spark, schemas.CAMPAIGN_KEYS).first()
    assert (row.impressions, row.unique_visitors, row.spend_to_date) == (5, 5, 5.0)


def test_dedup_keeps_every_event_without_an_id(spark):
    rows = [("1", "impression", T0, "u")] + [(None, "impression", T0, f"u{i}") for i in range(4)]
    run = Run()
    run.publish(marketing(spark, rows * 3).repartition(4))
    run.catch_up(spark, lambda stream, out, checkpoint: streaming.start_campaign_performance(
        stream, out, checkpoint, dedup="event_id"))
    row = run.latest(spark, schemas.CAMPAIGN_KEYS).first()
    assert (row.impressions, row.unique_visitors) == (1 + 4 * 3, 5)


def test_dedup_with_a_watermark(spark):
    rows = [("1", "impression", T0, "u"), (None, "click", T0, "u"), (None, "click", T0, "u"),
            ("2", "click", T0 + timedelta(hours=3), "u")]
    run = Run()
    run.publish(marketing(spark, rows + rows[:1] * 5).repartition(3))
    run.catch_up(spark, lambda stream, out, checkpoint: streaming.start_hourly(
        stream, "marketing", out, checkpoint, watermark="20 minutes", dedup="event_id"))
    row, = serving.read_changelog(spark, run.out).collect()
    assert (row.hour, row.impressions, row.clicks, row.unique_visitors) == (T0, 1, 2, 1)


def test_changelog_files_are_merged(spark):
    run = Run()
    run.publish(flows.cart(spark, SF))
    session = streaming_session(spark, 16)
    stream = events.read_events(session, "cart", run.topic, streaming=True)
    streaming.run_available(streaming.start_hourly(stream, "cart", run.out, run.checkpoint))
    assert serving.read_changelog(spark, run.out).count() > 500
    written = os.listdir(f"{run.out}/batch_id=0")
    assert len([name for name in written if name.endswith(".parquet")]) == 1


@pytest.fixture(params=["UTC", "Asia/Kolkata", "America/New_York"])
def zone(request, spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("exact", [True, False])
def test_watermark_closes_hours_and_drops_later_events(spark, exact, zone):
    def at(hours, minutes=0):
        return T0 + timedelta(hours=hours, minutes=minutes)

    def start(stream, out, checkpoint):
        return streaming.start_hourly(stream, "marketing", out, checkpoint, "20 minutes",
                                      exact_visitors=exact)
    run = Run()
    run.publish(marketing(spark, [("1", "impression", at(0, 5), "u"),
                                  ("2", "impression", at(1, 10), "u")]))
    run.catch_up(spark, start)                       # watermark 00:50: nothing closed
    run.publish(marketing(spark, [("3", "impression", at(0, 55), "u"),   # late, in time
                                  ("4", "click", at(2, 30), "v")]))
    run.catch_up(spark, start)                       # watermark 02:10: hours 0 and 1 closed
    run.publish(marketing(spark, [("5", "impression", at(0, 59), "w"),   # too late
                                  ("6", "click", at(5), "v")]))
    run.catch_up(spark, start)
    got = {r.hour: (r.impressions, r.clicks, r.unique_visitors, r.batch_id is not None)
           for r in serving.read_changelog(spark, run.out).collect()}
    assert got == {at(0): (2, 0, 1, True), at(1): (1, 0, 1, True), at(2): (0, 1, 0, True)}
    assert serving.read_changelog(spark, run.out).count() == 3


@pytest.mark.parametrize("kind,source,batch,keys", [
    ("campaign", flows.campaign_snapshots, rollups.campaign_snapshot_latest, schemas.CAMPAIGN_KEYS),
    ("cart", flows.cart_snapshots, rollups.cart_snapshot_latest, schemas.DEVICE_SOURCE_KEYS)])
def test_snapshots_equal_batch(spark, kind, source, batch, keys):
    run = Run()
    run.publish(source(spark, SF).repartition(2))
    run.catch_up(spark, lambda s, out, ckpt: streaming.start_snapshot_latest(s, kind, out, ckpt),
                 kind, read=events.read_snapshots, files=1)
    same(run.latest(spark, keys), batch(source(spark, SF)))


def test_live_trigger_keeps_running(spark):
    run = Run()
    rows = [(str(i), "impression", T0, f"u{i}") for i in range(3)]
    run.publish(marketing(spark, rows))
    stream = events.read_events(spark, "marketing", run.topic, streaming=True)
    query = streaming.start_campaign_performance(stream, run.out, run.checkpoint, every="1 second")
    try:
        query.processAllAvailable()
        assert run.latest(spark, schemas.CAMPAIGN_KEYS).first().impressions == 3
        run.publish(marketing(spark, [("9", "impression", T0, "u0")]))
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    row = run.latest(spark, schemas.CAMPAIGN_KEYS).first()
    assert (row.impressions, row.unique_visitors) == (4, 3)


class Lost(Exception):
    pass


@pytest.mark.parametrize("after_writing", [False, True])
def test_batch_lost_midway_is_replayed(spark, monkeypatch, after_writing):
    """The second batch dies before or after its output is written; the restart is exact."""
    run = Run()
    run.publish(flows.marketing(spark, SF).repartition(3))

    def dying(batch, path, batch_id):
        if batch_id == 1 and not after_writing:
            raise Lost
        serving.append_changelog(batch, path, batch_id)
        if batch_id == 1:
            raise Lost
    with monkeypatch.context() as patch:
        patch.setattr(streaming, "append_changelog", dying)
        with pytest.raises(StreamingQueryException):
            run.catch_up(spark, streaming.start_campaign_performance, files=1)
    run.catch_up(spark, streaming.start_campaign_performance, files=1)
    same(run.latest(spark, schemas.CAMPAIGN_KEYS), flows.performance(spark, SF))
    changelog = serving.read_changelog(spark, run.out)
    assert changelog.select("batch_id").distinct().count() == 3


def test_attribution_equals_batch(spark):
    """With and without an impression, out of its time, a copy, no click, no id, no time."""
    at = T0.replace(microsecond=5)
    minute = timedelta(minutes=1)
    names = ("event_id", "event_type", "event_time", "impression_id", "click_id", "revenue")
    rows = [
        ("i1", "impression", at, None, None, None), ("c1", "click", at + minute, "i1", None, None),
        ("p1", "purchase", at + 2 * minute, None, "c1", 5.0),
        ("p1", "purchase", at + 2 * minute, None, "c1", 5.0),
        (None, "purchase", at + 2 * minute, None, "c1", 7.0),
        ("c2", "click", at + minute, "i9", None, None),
        ("p2", "purchase", at + 3 * minute, None, "c2", 1.0),
        ("p3", "purchase", at + 90 * minute, None, "c2", 1.0),
        ("c4", "click", at + minute, None, None, None),
        ("p4", "purchase", at + 31 * minute, None, "c4", 1.0),
        ("p5", "purchase", at, None, None, 1.0), ("p6", "purchase", None, None, "c1", 1.0),
    ]
    schema = schemas.MARKETING_EVENTS
    full = spark.createDataFrame(
        [tuple(dict(zip(names, r)).get(f.name) for f in schema) for r in rows], schema)
    run = Run()
    run.publish(full)
    run.catch_up(spark, streaming_journeys.start_attribution)
    later = spark.createDataFrame([tuple(
        {"event_id": "z", "event_type": "impression", "event_time": at + 600 * minute}.get(f.name)
        for f in schema)], schema)
    run.publish(later)   # moves the watermark past all that was open
    run.catch_up(spark, streaming_journeys.start_attribution)
    got = serving.read_changelog(spark, run.out).drop("batch_id")
    assert got.count() == 4
    same(got, journeys.attribution(full))


def test_attribution_over_batches_decodes_the_source_once(spark):
    """Impressions, clicks and copies that arrive in later batches, and events too late."""
    minute, fields = timedelta(minutes=1), schemas.MARKETING_EVENTS

    def event(name, kind, minutes, link=None):
        known = {"event_id": name, "event_type": kind, "event_time": T0 + minutes * minute,
                 "impression_id": link if kind == "click" else None,
                 "click_id": link if kind == "purchase" else None,
                 "revenue": 2.0 if kind == "purchase" else None}
        return tuple(known.get(f.name) for f in fields)

    batches = [
        [event("p1", "purchase", 9, "c1"), event("c2", "click", 8, "i2"),
         event("p2", "purchase", 9, "c2"), event("p3", "purchase", 9, "c3"),
         event(None, "purchase", 9, "c2"), event(None, "purchase", 9, "c2")],
        [event("c1", "click", 7, "i1"), event("i1", "impression", 6), event("c3", "click", 5, "i3")],
        [event("p1", "purchase", 9, "c1"), event("i2", "impression", 1)],
        [event("z", "impression", 100)], [event("i3", "impression", 4)],
    ]
    run, written = Run(), []
    for rows in batches:
        run.publish(spark.createDataFrame(rows, fields))
        query = run.catch_up(spark, streaming_journeys.start_attribution)
        assert [(len(p["sources"]), p["stateOperators"]) for p in query.recentProgress
                if p["numInputRows"]] == [(1, [])]
        rows = serving.read_changelog(spark, run.out).collect()
        written.append(sorted((str(r.purchase_id), str(r.impression_id)) for r in rows))
    pair = [("p1", "i1")]
    late = [("None", "i2"), ("None", "i2"), ("p1", "i1"), ("p2", "i2")]
    assert written == [[], pair, late, [*late, ("p3", "None")], [*late, ("p3", "None")]]


def test_quarantine_keeps_lines_unchanged(spark):
    run = Run()
    run.publish(marketing(spark, [("1", "impression", T0, "u")]))
    bad = ['{"event_type": "impr', '{"event_type": "click", "cost": "dear"}']
    events.publish_lines(spark.createDataFrame([(b,) for b in bad], "value string"), run.topic)
    lines = events.read_lines(spark, run.topic, streaming=True)
    streaming.run_available(quarantine.start_quarantine(
        lines, schemas.MARKETING_EVENTS, run.out, run.checkpoint))
    assert sorted(r.value for r in spark.read.text(run.out).collect()) == sorted(bad)


def test_bad_lines_do_not_stop_the_stream(spark):
    run = Run()
    run.publish(marketing(spark, [("1", "impression", T0, "u")]))
    spark.createDataFrame([('{"event_type": "impr',)], "value string").write.mode("append").text(
        run.topic)
    run.catch_up(spark, streaming.start_campaign_performance)
    assert run.latest(spark, schemas.CAMPAIGN_KEYS).first().impressions == 1


@pytest.mark.parametrize("kind,source,batch,keys", [
    ("marketing", flows.marketing, flows.performance, schemas.CAMPAIGN_KEYS),
    ("cart", flows.cart, flows.funnel, schemas.FUNNEL_KEYS)])
def test_days_equal_batch(spark, kind, source, batch, keys):
    run = Run()
    run.publish(source(spark, SF).repartition(3))
    run.catch_up(spark, lambda s, out, ckpt: days.start_by_day(s, kind, out, ckpt), kind, files=1)
    changelog = serving.read_changelog(spark, run.out + "/changelog")
    assert changelog.select("batch_id").distinct().count() == 3
    same(serving.latest_version(changelog, keys), batch(spark, SF))


def test_days_with_edge_rows_and_a_lost_checkpoint(spark):
    """Without its checkpoint the stream replays batch 0, which replaces itself."""
    rows = [("1", "impression", T0, None), ("2", "impression", T0, "u"), ("3", None, T0, "u"),
            ("4", "impression", None, "u"), ("5", "impression", None, "u"),
            ("6", "purchase", T0 + timedelta(days=40), "v")]
    run = Run()
    run.publish(marketing(spark, rows))
    expected = rollups.campaign_performance_from_events(marketing(spark, rows))
    for checkpoint in ("/first", "/second"):
        run.catch_up(spark, lambda s, out, ckpt: days.start_by_day(
            s, "marketing", out, ckpt + checkpoint))
        changelog = serving.read_changelog(spark, run.out + "/changelog")
        assert changelog.count() == 1
        same(serving.latest_version(changelog, schemas.CAMPAIGN_KEYS), expected)


def test_days_of_broken_clocks_share_a_folder(spark):
    rows = [(str(i), "impression", T0 + timedelta(days=365 * i), "u") for i in range(0, 400, 40)]
    run = Run()
    run.publish(marketing(spark, rows))
    run.catch_up(spark, lambda s, out, ckpt: days.start_by_day(s, "marketing", out, ckpt))
    assert len(glob.glob(f"{run.out}/events/day=*/batch_id=0")) == 3   # 2024, 2063 and one for the rest
    same(serving.latest_version(serving.read_changelog(spark, run.out + "/changelog"),
                                schemas.CAMPAIGN_KEYS),
         rollups.campaign_performance_from_events(marketing(spark, rows)))


def test_days_read_only_the_touched_days(spark):
    run = Run()
    run.publish(flows.cart(spark, SF))
    run.catch_up(spark, lambda s, out, ckpt: days.start_by_day(s, "cart", out, ckpt), "cart")
    untouched = f"{run.out}/events/day=2024-01-05/batch_id=0"
    for name in os.listdir(untouched):  # unreadable files fail any job that opens them
        if name.endswith(".parquet"):
            with open(os.path.join(untouched, name), "wb") as file:
                file.write(b"damaged")
            crc = os.path.join(untouched, f".{name}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    late = flows.cart(spark, SF).where("event_time >= '2024-01-09' AND event_time < '2024-01-10'")
    run.publish(late)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # pruning must not hang on it
    try:
        run.catch_up(spark, lambda s, out, ckpt: days.start_by_day(s, "cart", out, ckpt), "cart")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    changelog = serving.read_changelog(spark, run.out + "/changelog")
    assert changelog.where("batch_id = 1").count() == late.select(*schemas.FUNNEL_KEYS).distinct().count()
