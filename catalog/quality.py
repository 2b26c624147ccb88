"""Cleaning rules, quarantine and removal counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.trips import SECONDS_SQL, SILVER_SQL, TIMED_SQL, silver_trips, trips
from farebox.operators import quality
from farebox.operators.features import trip_features, with_duration
from farebox.operators.profile import median_of, null_profile, totals
from farebox.sources.readers import read_trips
from farebox.sources.scratch import scratch_path
from farebox.sources.writers import write_layer

_COLS = ("trip_id", "passenger_count", "trip_distance", "fare_amount")


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_duration(trips(spark, sf_dir))


def silver_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_rules(trips(spark, sf_dir), quality.bounds_rules()).select(*_COLS)


_BOUNDS = """fare_amount BETWEEN 2.5 AND 500 AND trip_distance BETWEEN 0 AND 100 AND passenger_count BETWEEN 1 AND 6
  AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime > tpep_pickup_datetime
  AND total_amount > 0 AND tip_amount >= 0"""
_SELECT = f"SELECT {', '.join(_COLS)}"


def silver_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_trips(spark, sf_dir).select(*_COLS)


def silver_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_rules(_timed(spark, sf_dir), quality.strict_rules()).select(*_COLS)


_STRICT = """fare_amount > 0 AND fare_amount < 500 AND trip_distance > 0 AND trip_distance < 100
  AND trip_duration_minutes > 1 AND trip_duration_minutes < 180 AND passenger_count > 0 AND passenger_count <= 6"""


def speed_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_features(trips(spark, sf_dir), max_mph=80.0).select("trip_id", "trip_duration_seconds", "speed_mph")


_SPEED = "CASE WHEN secs > 0 THEN trip_distance / secs * 3600e0 ELSE 0e0 END"
SPEED_SQL = f"""WITH {TIMED_SQL}, s AS (SELECT *, {SECONDS_SQL} AS secs FROM timed)
SELECT trip_id, secs AS trip_duration_seconds, {_SPEED} AS speed_mph FROM s WHERE {_SPEED} <= 80"""


def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected trips with the first rule they break."""
    _, rejects = quality.quarantine(_timed(spark, sf_dir), quality.impute_rules())
    return rejects.select("trip_id", "reject_reason")


QUARANTINE_SQL = f"""WITH {TIMED_SQL}, tagged AS (
  SELECT trip_id, CASE
    WHEN NOT coalesce(fare_amount > 0 AND fare_amount <= 500, false) THEN 'fare'
    WHEN NOT coalesce(trip_distance > 0 AND trip_distance <= 100, false) THEN 'distance'
    WHEN NOT coalesce(total_amount > 0, false) THEN 'total'
    WHEN NOT coalesce(trip_duration_minutes BETWEEN 1 AND 180, false) THEN 'duration'
    WHEN NOT (passenger_count IS NULL OR (passenger_count > 0 AND passenger_count <= 6)) THEN 'passengers'
  END AS reject_reason FROM timed)
SELECT * FROM tagged WHERE reject_reason IS NOT NULL"""


def quarantine_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows and rejects separated by one write, partitioned by reason, and read back."""
    path = scratch_path(spark, "quarantine")
    tagged = quality.tag_rejects(_timed(spark, sf_dir), quality.impute_rules())
    write_layer(tagged.select("trip_id", "fare_amount", "reject_reason"), path, ("reject_reason",))
    stored = read_trips(spark, path)
    return stored.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"), F.max("fare_amount").alias("top_fare"))


def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many raw trips break each rule (one trip may break several)."""
    return quality.violation_counts(_timed(spark, sf_dir), quality.impute_rules())


QUARANTINE_LAYER_SQL = QUARANTINE_SQL.replace(
    "SELECT * FROM tagged WHERE reject_reason IS NOT NULL",
    "SELECT reject_reason, count(*) AS rows, max(fare_amount) AS top_fare FROM tagged GROUP BY reject_reason",
).replace("SELECT trip_id, CASE", "SELECT fare_amount, CASE")

VIOLATIONS_SQL = f"""WITH {TIMED_SQL} SELECT
  count(*) FILTER (WHERE NOT (fare_amount > 0 AND fare_amount <= 500)) AS fare,
  count(*) FILTER (WHERE NOT (trip_distance > 0 AND trip_distance <= 100)) AS distance,
  count(*) FILTER (WHERE NOT (total_amount > 0)) AS total,
  count(*) FILTER (WHERE NOT (trip_duration_minutes BETWEEN 1 AND 180)) AS duration,
  count(*) FILTER (WHERE NOT (passenger_count IS NULL OR (passenger_count > 0 AND passenger_count <= 6))) AS passengers
FROM timed"""


def clean_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults left after cleaning: all zero."""
    return quality.violation_counts(silver_trips(spark, sf_dir), quality.residual_faults())


CLEAN_SQL = f"""WITH {SILVER_SQL} SELECT count(*) FILTER (WHERE fare_amount <= 0) AS invalid_fare,
  count(*) FILTER (WHERE trip_distance <= 0) AS invalid_distance, count(*) FILTER (WHERE passenger_count <= 0) AS invalid_passengers,
  count(*) FILTER (WHERE passenger_count IS NULL) AS null_passengers FROM silver"""


def removal_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.removal_report(_timed(spark, sf_dir), quality.impute_rules())


REMOVAL_SQL = f"""WITH {SILVER_SQL}, c AS (
  SELECT (SELECT count(*) FROM timed) AS b, (SELECT count(*) FROM silver) AS a)
SELECT b AS records_before, a AS records_after, b - a AS records_removed,
  CAST(b - a AS DOUBLE) / CAST(b AS DOUBLE) * 100e0 AS removal_pct FROM c"""


def median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing passenger counts filled with the true median of the present ones."""
    rows = trips(spark, sf_dir).select("trip_id", "passenger_count")
    return quality.impute(rows, {"passenger_count": int(median_of(rows, "passenger_count"))})


MEDIAN_SQL = f"""WITH {TIMED_SQL}
SELECT trip_id, coalesce(passenger_count,
  CAST(floor((SELECT quantile_cont(passenger_count, 0.5) FROM timed)) AS INT)) AS passenger_count FROM timed"""

_NULL_COLS = ("VendorID", "fare_amount", "trip_distance", "passenger_count", "total_amount")


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(trips(spark, sf_dir), _NULL_COLS).select("column", "nulls")


NULL_COUNTS_SQL = f"WITH {TIMED_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM timed" for c in _NULL_COLS
)


def null_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns with missing values and how much of them is missing."""
    return null_profile(trips(spark, sf_dir), only_nulls=True)


NULL_PERCENT_SQL = f"""WITH {TIMED_SQL} SELECT 'passenger_count' AS "column", count(*) - count(passenger_count) AS nulls,
  CAST(count(*) - count(passenger_count) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100e0 AS percent FROM timed"""


def step_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts after each cleaning step, from one pass."""
    conditions, so_far = {}, F.lit(True)
    for rule in quality.impute_rules().rules:
        so_far = so_far & ~rule.broken
        conditions[f"after_{rule.name}"] = so_far
    return totals(_timed(spark, sf_dir), **conditions)


_STEPS = {
    "fare": "fare_amount > 0 AND fare_amount <= 500",
    "distance": "trip_distance > 0 AND trip_distance <= 100",
    "total": "total_amount > 0",
    "duration": "trip_duration_minutes BETWEEN 1 AND 180",
    "passengers": "(passenger_count IS NULL OR (passenger_count > 0 AND passenger_count <= 6))",
}
STEPS_SQL = f"WITH {TIMED_SQL} SELECT count(*) AS records, " + ", ".join(
    f"count(*) FILTER (WHERE {' AND '.join(list(_STEPS.values())[: i + 1])}) AS after_{name}" for i, name in enumerate(_STEPS)
) + " FROM timed"

QUERIES = {
    "silver_bounds": (silver_bounds, f"WITH {TIMED_SQL} {_SELECT} FROM timed WHERE {_BOUNDS}"),
    "silver_impute": (silver_impute, f"WITH {SILVER_SQL} {_SELECT} FROM silver"),
    "silver_strict": (silver_strict, f"WITH {TIMED_SQL} {_SELECT} FROM timed WHERE {_STRICT}"),
    "speed_cap": (speed_cap, SPEED_SQL),
    "quarantine_reasons": (quarantine_reasons, QUARANTINE_SQL),
    "quarantine_layer": (quarantine_layer, QUARANTINE_LAYER_SQL),
    "rule_violations": (rule_violations, VIOLATIONS_SQL),
    "clean_check": (clean_check, CLEAN_SQL),
    "removal_report": (removal_report, REMOVAL_SQL),
    "median_impute": (median_impute, MEDIAN_SQL),
    "null_counts": (null_counts, NULL_COUNTS_SQL),
    "null_percent": (null_percent, NULL_PERCENT_SQL),
    "step_totals": (step_totals, STEPS_SQL),
}
