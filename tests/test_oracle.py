"""Every registered query against its SQL, value by value."""

import pytest

import __spark_entry__ as entry_points
from cartpulse.plans.oracles import ORACLES
from cartpulse.plans.registry import QUERIES
from oracle_check import connect, differences


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def tables(request):
    sf_dir = f"/root/testdata/{request.param}"
    return sf_dir, connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, tables, name):
    sf_dir, con = tables
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    board = entry_points.entry(spark)
    rois = [r.roi for r in board.collect()]
    assert len(rois) == 5 and rois == sorted(rois, reverse=True)
