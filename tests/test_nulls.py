"""Every query against its SQL on a table with NULLs and negative numbers mixed in."""

import tempfile

import pytest

from cartpulse.plans.oracles import ORACLES
from cartpulse.plans.registry import QUERIES
from oracle_check import connect, differences

BATCH = [name for name in QUERIES if not name.startswith("stream_")]
STREAMS = ["stream_campaign_performance", "stream_cart_hourly", "stream_quarantine"]


@pytest.fixture(scope="module")
def holes(spark):
    """The events with every eleventh or so value of each column gone, and some
    negative ``k``."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    columns = {c: f"CASE WHEN pmod(xxhash64(event_id, '{c}'), 11) = 0 THEN NULL ELSE {c} END"
               for c in ("user_id", "event_type", "value", "props")}
    holed = events.selectExpr("event_id", "ts", *[f"{e} AS {c}" for c, e in columns.items()])
    negative = "regexp_replace(props, '([0-9]+)', '-$1')"
    holed.selectExpr(
        "event_id", "ts", "user_id", "event_type", "value",
        f"CASE WHEN event_id % 13 = 0 THEN {negative} ELSE props END AS props",
    ).coalesce(1).write.parquet(f"{folder}/events.parquet")
    con = connect("/root/testdata/sf0.001")
    con.execute("DROP VIEW events")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    return folder, con


@pytest.mark.parametrize("name", BATCH + STREAMS)
def test_query_with_holes(spark, holes, name):
    folder, con = holes
    assert differences(QUERIES[name](spark, folder), con, ORACLES[name]) == []
