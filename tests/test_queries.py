"""Every query with a SQL twin, compared value by value; every plan, checked for bad joins."""

import pytest

import __spark_entry__ as contract
from catalog import registered
from verify import differences

ORACLES = contract.oracle_sql()
FITS = [n for n in contract.queries() if n not in ORACLES]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, sf, name):
    result = contract.queries()[name](spark, sf)
    plan = result._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    problem, _ = differences(result, con, ORACLES[name])
    assert problem is None, problem


def test_every_query_has_sql():
    assert [n for n in FITS if n in registered()] == []


def test_entry_returns_the_hourly_report(spark):
    df = contract.entry(spark)
    assert df.columns == ["pickup_hour", "avg_fare", "avg_distance", "trip_count"]
    assert 0 < df.count() <= 24
