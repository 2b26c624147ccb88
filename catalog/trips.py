"""A trip-shaped view over the ``events`` table, for Spark and as SQL text.

``trip_id`` is the unique row id. Fares, tips and distances are whole cents and whole 1/350
miles underneath, so means over them can be summed exactly (``PER_UNIT``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.operators.features import model_features, with_duration
from farebox.operators.quality import apply_rules, impute_rules

PER_UNIT = {"fare_amount": 100, "label": 100, "tip_amount": 100, "total_amount": 100, "trip_distance": 350}

# The view's columns, in the expressions both engines share.
_SHARED = """
  event_id AS trip_id,
  CAST(1 + event_id % 2 AS INT) AS VendorID,
  ts AS tpep_pickup_datetime,
  {dropoff} AS tpep_dropoff_datetime,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id % 8 AS INT) END AS passenger_count,
  CAST(CAST(floor(value * 100e0 + 0.5e0) AS BIGINT) + (event_id * 7919) % 4000 - 1000 AS DOUBLE) / 350e0
    AS trip_distance,
  CAST(1 + event_id % 6 AS INT) AS RatecodeID,
  CASE WHEN event_id % 50 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  CAST(1 + (event_id * 31) % 265 AS INT) AS PULocationID,
  CAST(1 + (event_id * 17 + user_id) % 265 AS INT) AS DOLocationID,
  CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
    WHEN 'error' THEN 4 ELSE 5 END AS payment_type,
  CAST({fare_c} AS DOUBLE) / 100e0 AS fare_amount,
  CAST({tip_c} AS DOUBLE) / 100e0 AS tip_amount,
  CAST({fare_c} + {tip_c} + 350 AS DOUBLE) / 100e0 AS total_amount
"""
_FARE_C = (
    "(CAST(floor(value * 100e0 + 0.5e0) AS BIGINT) + (event_id % 40) * 300 - 500"
    " + CASE WHEN event_id % 211 = 0 THEN 60000 ELSE 0 END)"
)
_TIP_C = "(CASE WHEN event_type = 'purchase' THEN (event_id % 13) * 50 - 50 ELSE 0 END)"
_SECONDS = "(event_id * 37) % 11500 - 100"


def _columns(dropoff: str) -> str:
    return _SHARED.format(dropoff=dropoff, fare_c=_FARE_C, tip_c=_TIP_C)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw trips."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn(
        "_dropoff", F.expr(f"timestampadd(SECOND, {_SECONDS}, ts)")
    )
    return spark.sql(f"SELECT {_columns('_dropoff')} FROM {{events}}", events=events)


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips cleaned by the imputing rules, with their duration."""
    return apply_rules(with_duration(trips(spark, sf_dir)), impute_rules())


def featured_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trips with every model feature and the target named ``label``."""
    return model_features(silver_trips(spark, sf_dir)).withColumnRenamed("fare_amount", "label")


def scored_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Featured trips with two fixed-formula predictions, which need no fit."""
    return featured_trips(spark, sf_dir).withColumns(
        {
            "prediction": F.lit(46.0) + F.lit(3.35) * F.col("trip_distance"),
            "prediction_flat": F.lit(90.0),
        }
    )


TRIPS_SQL = f"trips AS (SELECT {_columns(f'ts + to_seconds({_SECONDS})')} FROM events)"

# floor(epoch()) is a whole number of seconds, as unix_timestamp gives
SECONDS_SQL = (
    "(CAST(floor(epoch(tpep_dropoff_datetime)) AS BIGINT)"
    " - CAST(floor(epoch(tpep_pickup_datetime)) AS BIGINT))"
)

TIMED_SQL = f"""{TRIPS_SQL},
timed AS (SELECT *, CAST({SECONDS_SQL} AS DOUBLE) / 60e0 AS trip_duration_minutes FROM trips)"""

SILVER_SQL = f"""{TIMED_SQL},
silver AS (
  SELECT * REPLACE (coalesce(passenger_count, 1) AS passenger_count) FROM timed
  WHERE fare_amount > 0 AND fare_amount <= 500 AND trip_distance > 0 AND trip_distance <= 100
    AND total_amount > 0 AND trip_duration_minutes BETWEEN 1 AND 180
    AND coalesce(passenger_count, 1) > 0 AND coalesce(passenger_count, 1) <= 6
)"""

FEATURED_SQL = f"""{SILVER_SQL},
parts AS (
  SELECT *,
    CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INT) AS pickup_day_of_week,
    CAST(month(tpep_pickup_datetime) AS INT) AS pickup_month,
    CAST(year(tpep_pickup_datetime) AS INT) AS pickup_year
  FROM silver
),
featured AS (
  SELECT * EXCLUDE (fare_amount), fare_amount AS label,
    CASE WHEN pickup_day_of_week IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN pickup_hour BETWEEN 7 AND 9 OR pickup_hour BETWEEN 16 AND 18 THEN 1 ELSE 0 END AS is_rush_hour,
    CASE WHEN pickup_hour >= 22 OR pickup_hour < 5 THEN 1 ELSE 0 END AS is_late_night,
    CASE WHEN PULocationID IN (132, 138, 1) THEN 1 ELSE 0 END AS is_airport_pickup,
    CASE WHEN DOLocationID IN (132, 138, 1) THEN 1 ELSE 0 END AS is_airport_dropoff,
    CASE WHEN PULocationID IN (132, 138, 1) OR DOLocationID IN (132, 138, 1) THEN 1 ELSE 0 END AS is_airport_trip,
    least(trip_distance / (trip_duration_minutes / 60e0), 100e0) AS avg_speed_mph,
    CASE WHEN payment_type = 1 THEN 1 ELSE 0 END AS is_credit_card,
    CASE WHEN payment_type = 2 THEN 1 ELSE 0 END AS is_cash
  FROM parts
)"""

SCORED_SQL = f"""{FEATURED_SQL},
scored AS (
  SELECT *, 46e0 + 3.35e0 * trip_distance AS prediction, 90e0 AS prediction_flat FROM featured
)"""


def mean_sql(expr: str, per_unit: int) -> str:
    """The order-independent mean, as ``farebox.functions.numeric.mean`` computes it."""
    whole = f"CAST(floor(({expr}) * {per_unit}e0 + 0.5e0) AS BIGINT)"
    return f"CAST(sum({whole}) AS DOUBLE) / CAST(count({expr}) AS DOUBLE) / {per_unit}e0"


def uniform_sql(ids: str, purpose: str = "split", seed: int = 42) -> str:
    """The md5 draw of ``farebox.functions.hashing.uniform``."""
    key = f"md5('{seed}|{purpose}|' || CAST({ids} AS VARCHAR))"
    return f"(CAST(CAST(('0x' || substr({key}, 1, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496e0)"
