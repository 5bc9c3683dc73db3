"""What the physical plans must and must not contain."""

import os
import re

import pytest

import cartpulse
from cartpulse.operators import rollups
from cartpulse.plans import flows
from cartpulse.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
# Streams and round trips return a plain read of what they wrote.
LAZY = [name for name in QUERIES if not name.startswith(("stream_", "changelog_"))
        and not name.endswith(("_roundtrip", "_over_changelog"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_python_or_whole_table_window(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert unwanted not in text
    for spec in re.findall(r"windowspecdefinition\(([^)]*)", text):
        assert "ASC" not in spec.split(",")[0] and "DESC" not in spec.split(",")[0]
    if "Window" in text:  # a window without keys is fed by a single partition
        assert not re.search(r"Window.*\n(.*Sort.*\n)?.*Exchange SinglePartition", text)


@pytest.mark.parametrize("name", LAZY)
def test_no_join_needs_a_broadcast(spark, name):
    """With broadcasts switched off every join shuffles both sides by its keys."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text


def test_nothing_is_collected_or_hinted_in_the_library():
    for folder, subfolders, files in os.walk(os.path.dirname(cartpulse.__file__)):
        if "llm" in subfolders:
            subfolders.remove("llm")  # fits models on bounded samples; tested in tests/llm
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as source:
                    text = source.read()
                for call in (".collect(", ".toPandas(", ".localCheckpoint(", "broadcast(",
                             ".crossJoin(", ".rdd", "pandas_udf", ".cache(", ".persist("):
                    assert call not in text, (name, call)


def scanned(df):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))


def test_scans_read_only_the_columns_in_use(spark):
    marketing = flows.marketing(spark, SF)
    assert scanned(marketing.groupBy("event_type").count()) == ["event_type:string"]
    assert scanned(marketing.select("cost")) == ["event_type:string,value:double"]
    assert scanned(flows.cart(spark, SF).select("session_id")) == ["ts:timestamp_ntz,user_id:bigint"]


def test_time_filters_reach_the_scan(spark):
    first, second = flows.split_by_time(flows.marketing(spark, SF), "event_time", ["2024-01-16"])
    assert "GreaterThanOrEqual(ts,2024-01-16T00:00)" in plan(second)
    assert "LessThan(ts,2024-01-16T00:00)" in plan(first)


@pytest.mark.parametrize("rollup,shuffles", [
    (lambda s: flows.performance(s, SF), 2),   # distinct users, then campaigns
    (lambda s: flows.funnel(s, SF), 1),
    (lambda s: rollups.campaign_hourly(flows.marketing(s, SF)), 2),
    (lambda s: rollups.campaign_performance(rollups.campaign_hourly(flows.marketing(s, SF))), 3)])
def test_shuffles(spark, rollup, shuffles):
    text = plan(rollup(spark))
    assert text.count("Exchange hashpartitioning") == shuffles
    assert text.count("FileScan") == 1 and "partial_count" in text


def test_insights_read_events_once(spark):
    """Views over a rollup scan the serving table, not the events behind it."""
    text = plan(QUERIES["campaign_insights"](spark, SF))
    assert "events.parquet" not in text and "campaign_performance" in text
