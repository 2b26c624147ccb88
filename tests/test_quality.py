from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farebox.operators import quality
from farebox.operators.features import with_duration
from farebox.operators.profile import null_profile, totals

START = datetime(2023, 1, 2, 10, 0, 0)
SCHEMA = (
    "case string, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count int, "
    "trip_distance double, fare_amount double, tip_amount double, total_amount double"
)


def row(case, minutes=10.0, passengers=1, miles=2.0, fare=10.0, tip=1.0, total=12.0, pickup=START, dropoff="set"):
    end = pickup and pickup + timedelta(minutes=minutes) if dropoff == "set" else dropoff
    return (case, pickup, end, passengers, miles, fare, tip, total)


CASES = [
    row("good"),
    row("fare 0", fare=0.0),
    row("fare 2.49", fare=2.49),
    row("fare 2.5", fare=2.5),
    row("fare 500", fare=500.0),
    row("fare 500.01", fare=500.01),
    row("fare null", fare=None),
    row("miles -1", miles=-1.0),
    row("miles 0", miles=0.0),
    row("miles 100", miles=100.0),
    row("miles 100.01", miles=100.01),
    row("minutes 0", minutes=0.0),
    row("minutes 1", minutes=1.0),
    row("minutes 180", minutes=180.0),
    row("minutes 181", minutes=181.0),
    row("passengers null", passengers=None),
    row("passengers 0", passengers=0),
    row("passengers 6", passengers=6),
    row("passengers 7", passengers=7),
    row("no pickup", pickup=None),
    row("no dropoff", dropoff=None),
    row("total 0", total=0.0),
    row("tip -1", tip=-1.0),
]


@pytest.fixture(scope="module")
def cases(spark):
    return with_duration(spark.createDataFrame(CASES, SCHEMA)).cache()


def names(df):
    return {r["case"] for r in df.select("case").collect()}


ALL = {c[0] for c in CASES}


def test_bounds_keeps_closed_bounds(cases):
    dropped = {
        "fare 0", "fare 2.49", "fare 500.01", "fare null", "miles -1", "miles 100.01", "minutes 0",
        "passengers null", "passengers 0", "passengers 7", "no pickup", "no dropoff", "total 0", "tip -1",
    }
    assert names(quality.apply_rules(cases, quality.bounds_rules())) == ALL - dropped


def test_impute_fills_missing_passengers(cases):
    kept = quality.apply_rules(cases, quality.impute_rules())
    dropped = {
        "fare 0", "fare 500.01", "fare null", "miles -1", "miles 0", "miles 100.01", "minutes 0", "minutes 181",
        "passengers 0", "passengers 7", "no pickup", "no dropoff", "total 0",
    }
    assert names(kept) == ALL - dropped
    filled = kept.filter(F.col("case") == "passengers null").first()
    assert filled["passenger_count"] == 1
    assert dict(kept.dtypes)["passenger_count"] == "int"


def test_strict_uses_open_bounds_and_ignores_the_total(cases):
    dropped = {
        "fare 0", "fare 500", "fare 500.01", "fare null", "miles -1", "miles 0", "miles 100", "miles 100.01",
        "minutes 0", "minutes 1", "minutes 180", "minutes 181", "passengers null", "passengers 0", "passengers 7",
        "no pickup", "no dropoff",
    }
    assert names(quality.apply_rules(cases, quality.strict_rules())) == ALL - dropped


@pytest.mark.parametrize("preset", [quality.bounds_rules, quality.impute_rules, quality.strict_rules])
def test_quarantine_splits_the_whole_input(cases, preset):
    good, rejects = quality.quarantine(cases, preset())
    assert names(good) | names(rejects) == ALL
    assert not names(good) & names(rejects)
    assert rejects.filter("reject_reason IS NULL").count() == 0
    before, after, removed, _ = quality.removal_report(cases, preset()).first()
    assert (before, after, removed) == (len(CASES), len(names(good)), len(names(rejects)))


def test_first_broken_rule_is_the_reason(spark):
    bad = with_duration(spark.createDataFrame([row("x", fare=0.0, miles=0.0, total=0.0)], SCHEMA))
    assert quality.tag_rejects(bad, quality.impute_rules()).first()["reject_reason"] == "fare"
    counts = quality.violation_counts(bad, quality.impute_rules()).first().asDict()
    assert counts == {"fare": 1, "distance": 1, "total": 1, "duration": 0, "passengers": 0}


def test_residual_faults_do_not_count_nulls_as_values(cases):
    found = quality.violation_counts(cases, quality.residual_faults()).first()
    assert (found["invalid_fare"], found["invalid_distance"]) == (1, 2)
    assert (found["invalid_passengers"], found["null_passengers"]) == (1, 1)


def test_thresholds_are_arguments(cases):
    kept = quality.apply_rules(cases, quality.bounds_rules({"min_fare": 0.0, "max_passengers": 7}))
    assert {"fare 0", "fare 2.49", "passengers 7"} <= names(kept)


def test_null_profile_orders_by_share(cases):
    rows = null_profile(cases, only_nulls=True).collect()
    assert rows[0]["percent"] == max(r["percent"] for r in rows)
    assert {r["column"]: r["nulls"] for r in rows}["passenger_count"] == 1


def test_empty_table_reports(spark):
    empty = with_duration(spark.createDataFrame([], SCHEMA))
    assert quality.removal_report(empty, quality.impute_rules()).first()["removal_pct"] is None
    assert totals(empty).first()["records"] == 0
