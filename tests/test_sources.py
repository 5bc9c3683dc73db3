import json
import os
import tempfile
from datetime import datetime

import pytest

from cartpulse import schemas
from cartpulse.session import shared_base, work_dir
from cartpulse.sources import event_table, events, serving


def fresh():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


GOOD = {"event_type": "click", "event_id": "e1", "timestamp": "2025-06-11T13:33:13.639600",
        "campaign_id": "C1", "cost": 1.5}


def test_missing_extra_and_plain_timestamp(spark):
    rows = events.good_rows(events.parse_json(lines(
        spark, json.dumps(GOOD), json.dumps({**GOOD, "unheard": [1], "timestamp": "2025-06-11T13:33:13"})),
        schemas.MARKETING_EVENTS)).collect()
    assert [r.event_time for r in rows] == [
        datetime(2025, 6, 11, 13, 33, 13, 639600), datetime(2025, 6, 11, 13, 33, 13)]
    assert rows[0].revenue is None and rows[0].cost == 1.5


@pytest.mark.parametrize("bad", [
    '{"event_type": "cli', "no json", "[1, 2]", "7", "null", json.dumps([GOOD]),
    json.dumps({**GOOD, "cost": "dear"}), json.dumps({**GOOD, "timestamp": "yesterday"})])
def test_bad_lines_are_kept_apart(spark, bad):
    parsed = events.parse_json(lines(spark, json.dumps(GOOD), bad, "", "  "),
                               schemas.MARKETING_EVENTS)
    assert [r.event_id for r in events.good_rows(parsed).collect()] == ["e1"]
    assert [r[0] for r in events.corrupt_rows(parsed).collect()] == [bad]


def test_bad_lines_do_not_depend_on_the_columns_read(spark):
    parsed = events.parse_json(lines(spark, json.dumps(GOOD), json.dumps({**GOOD, "cost": "dear"})),
                               schemas.MARKETING_EVENTS)
    assert events.good_rows(parsed).count() == 1
    assert events.good_rows(parsed).select("event_id").distinct().count() == 1


def test_each_line_is_decoded_once(spark):
    parsed = events.good_rows(events.parse_json(lines(spark, json.dumps(GOOD)),
                                                schemas.MARKETING_EVENTS))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_publish_keeps_every_value(spark):
    row = ("purchase", "e", datetime(2024, 1, 1, 0, 0, 0, 1), "s", None, "Mobile", "Email", "p",
           'quote " and \n line', 0.1, 3, "c", "k", "b", 0.30000000000000004)
    df = spark.createDataFrame([row], schemas.CART_EVENTS)
    target = fresh() + "/topic"
    events.publish(df, target)
    events.publish(df, target)
    assert events.read_events(spark, "cart", target).collect() == df.collect() * 2


def test_topic_options():
    topic = events.Topic("broker:9092", "cart-events", max_offsets_per_trigger=1000,
                         min_partitions=64)
    assert topic.read_options(streaming=True) == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "cart-events",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "1000", "minPartitions": "64"}
    assert "maxOffsetsPerTrigger" not in topic.read_options(streaming=False)
    assert topic.write_options() == {
        "kafka.bootstrap.servers": "broker:9092", "topic": "cart-events"}
    secured = events.Topic("b:1", "t", options={"kafka.security.protocol": "SSL"})
    assert secured.write_options()["kafka.security.protocol"] == "SSL"
    assert secured.read_options(False)["kafka.security.protocol"] == "SSL"


SNAPSHOT = [("Mobile", "Email", datetime(2024, 1, 1), 10, 5, 2, 20.0, 40.0),
            ("Desktop", "Email", datetime(2024, 1, 1), 10, 5, 2, 20.0, 40.0)]


def test_serving_table_has_the_declared_columns(spark):
    df = spark.createDataFrame(SNAPSHOT, schemas.CART_ANALYTICS).selectExpr("*", "1 AS extra")
    path = fresh() + "/t"
    serving.write_serving(df, "cart_analytics", path)
    back = serving.read_serving(spark, "cart_analytics", path)
    assert back.schema == schemas.CART_ANALYTICS and back.count() == 2


def test_serving_table_splits_a_hot_key(spark):
    """Rebalancing may cut one key's rows into several files; none is lost."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        hot = spark.range(60000).selectExpr(
            "'Mobile' AS device_type", "'Email' AS traffic_source",
            "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS last_updated", "id AS page_views",
            "id * 7919 AS add_to_carts", "id * 104729 AS purchases", "rand(1) AS revenue",
            "rand(2) AS cart_to_purchase_rate").repartition(8)
        path = fresh() + "/t"
        serving.write_serving(hot, "cart_analytics", path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) > 1
    assert serving.read_serving(spark, "cart_analytics", path).count() == 60000


def test_bucketed_table_joins_without_a_shuffle(spark):
    df = spark.createDataFrame(SNAPSHOT, schemas.CART_ANALYTICS)
    serving.save_serving_table(df, "cart_analytics", "cart_analytics_test", 4, fresh() + "/t")
    table = spark.table("cart_analytics_test")
    assert table.count() == 2
    keys = ["device_type", "traffic_source"]
    plan = table.groupBy(*keys).count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("props,expected", [
    ('{"k": 87}', 87), ('{"k":0}', 0), (' {"k": 5}', 5), ('{"a": {"k": 1}, "k": 12}', 12),
    ('{"k": "34"}', 34), ('{"k": 007}', None), ('{"j": 1}', None), ("no json", None), (None, None)])
def test_k_of_any_object(spark, props, expected):
    df = spark.createDataFrame([(props,)], "props string")
    assert df.select(event_table._k()).first()[0] == expected


def test_working_folders(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_base(spark) == configured
    assert work_dir(spark, "x").startswith(configured) and work_dir(spark, "x") != work_dir(spark, "x")


class Settings:
    """A session as far as `shared_base` looks at it."""

    def __init__(self, **settings):
        self.conf = {name.replace("_", "."): value for name, value in settings.items()}


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError):
        shared_base(Settings(spark_master="yarn"))
    with pytest.raises(ValueError):
        shared_base(Settings(spark_master="local-cluster[3,2,1024]"))
    assert shared_base(Settings(spark_master="yarn", spark_checkpoint_dir="hdfs:///c/")) == "hdfs:///c"
    assert shared_base(Settings(spark_master="local[2]")).startswith(tempfile.gettempdir())


def test_blank_and_missing_messages_are_counted(spark):
    good = '{"event_type": "click", "event_id": "1"}'
    lines = spark.createDataFrame([(good,), ("",), ("  ",), (None,)], "value string")
    parsed = events.parse_json(lines, schemas.MARKETING_EVENTS)
    assert events.good_rows(parsed).count() == 1
    assert events.corrupt_rows(parsed).count() == 0
    assert sorted("none" if r[0] is None else r[0] for r in events.blank_rows(lines).collect()) == [
        "", "  ", "none"]
