from datetime import datetime

import pytest
from pyspark.sql import functions as F

from farebox.functions import trip
from farebox.operators import features


def test_hour_windows_at_their_edges(spark):
    hours = [4, 5, 6, 7, 8, 9, 10, 15, 16, 17, 18, 19, 21, 22, 23]
    df = spark.createDataFrame([(datetime(2023, 1, 2, h, 59, 59),) for h in hours], "ts timestamp_ntz")
    wide = {r["pickup_hour"]: r for r in features.time_features(df, "ts").collect()}
    assert {h for h in hours if wide[h]["is_rush_hour"]} == {7, 8, 9, 16, 17, 18}
    assert {h for h in hours if wide[h]["is_late_night"]} == {4, 22, 23}
    narrow = features.time_features(df, "ts", rush=trip.RUSH_NARROW).filter("is_rush_hour = 1")
    assert {r["pickup_hour"] for r in narrow.collect()} == {7, 8, 17, 18}


def test_weekend_is_saturday_and_sunday(spark):
    days = [datetime(2023, 1, d, 12) for d in (6, 7, 8, 9)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    rows = features.time_features(df, "ts").orderBy("ts").collect()
    assert [r["pickup_day_of_week"] for r in rows] == [6, 7, 1, 2]
    assert [r["is_weekend"] for r in rows] == [0, 1, 1, 0]


def test_time_features_of_a_missing_time(spark):
    got = features.time_features(spark.createDataFrame([(None,)], "ts timestamp_ntz"), "ts").first()
    assert got["pickup_hour"] is None
    assert (got["is_weekend"], got["is_rush_hour"], got["is_late_night"]) == (0, 0, 0)


@pytest.mark.parametrize(
    ("pu", "do", "expected"),
    [
        (1, 100, (1, 0, 1, 1, 1, 0)),
        (100, 101, (0, 0, 0, 1, 0, 1)),
        (132, 137, (1, 0, 1, 0, 0, 0)),
        (138, 1, (1, 1, 1, 0, 1, 1)),
        (None, 132, (0, 1, 1, 0, 0, 0)),
        (None, None, (0, 0, 0, 0, 0, 0)),
    ],
)
def test_location_flags(spark, pu, do, expected):
    df = spark.createDataFrame([(pu, do)], "PULocationID int, DOLocationID int")
    got = features.location_features(df).select(
        "is_airport_pickup", "is_airport_dropoff", "is_airport_trip",
        "is_manhattan_pickup", "is_manhattan_dropoff", "is_cross_borough",
    ).first()
    assert tuple(got) == expected


def test_guarded_ratios(spark):
    t0 = datetime(2023, 1, 1, 0, 0, 0)
    rows = [
        (t0, t0, 1.0, 10.0, 2.0),  # no time
        (t0, datetime(2023, 1, 1, 0, 30), 0.0, 0.0, 2.0),  # no distance, no fare
        (t0, datetime(2023, 1, 1, 0, 30), 10.0, 20.0, 5.0),
        (t0, datetime(2023, 1, 1, 0, 6), 10.0, 20.0, 5.0),  # 100 mph
    ]
    df = spark.createDataFrame(
        rows,
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, trip_distance double, "
        "fare_amount double, tip_amount double",
    )
    out = features.trip_features(df, max_mph=None).collect()
    assert [r["speed_mph"] for r in out] == pytest.approx([0.0, 0.0, 20.0, 100.0])
    assert [r["fare_per_mile"] for r in out] == pytest.approx([10.0, 0.0, 2.0, 2.0])
    assert [r["tip_percentage"] for r in out] == pytest.approx([20.0, 0.0, 25.0, 25.0])
    assert features.trip_features(df).count() == 3


def test_clamped_speed(spark):
    df = spark.createDataFrame(
        [(1.0, 0.0), (1.0, None), (None, 10.0), (50.0, 10.0), (5.0, 10.0)],
        "trip_distance double, trip_duration_minutes double",
    )
    got = [r["avg_speed_mph"] for r in features.clamped_speed(df).collect()]
    assert got == pytest.approx([0.0, 0.0, 0.0, 100.0, 30.0])


def test_payment_flags(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "payment_type int")
    rows = features.payment_flags(df).collect()
    assert [(r["is_credit_card"], r["is_cash"]) for r in rows] == [(1, 0), (0, 1), (0, 0), (0, 0)]


def test_window_that_does_not_wrap(spark):
    df = spark.range(24).select(trip.in_hours(F.col("id"), 2, 5).alias("x"))
    assert df.filter("x").count() == 3
