"""Counts, summaries and distributions over whole tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.trips import PER_UNIT, SILVER_SQL, TRIPS_SQL, mean_sql, silver_trips, trips
from farebox.operators import comoments, profile


def passenger_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(trips(spark, sf_dir), "passenger_count")


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by return flag and status."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return profile.value_counts(items, "l_returnflag", "l_linestatus")


def _with_rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


_SUMMARY = ("fare_amount", "trip_distance", "passenger_count", "total_amount")
_UNITS = {**PER_UNIT, "passenger_count": 1, "l_extendedprice": 100, "l_quantity": 1, "l_discount": 100}


def _summary_sql(table: str, cols: tuple[str, ...], units: Mapping[str, int], prefix: str) -> str:
    return prefix + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, {mean_sql(c, units[c])} AS mean,
  round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75 FROM {table}"""
        for c in cols
    )


def column_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips: count, mean, stddev, min, exact quartiles and max of four columns."""
    table = profile.column_summary(trips(spark, sf_dir), _SUMMARY, per_unit=_UNITS)
    return _with_rounded(table, "stddev", "q25", "q50", "q75")


_SILVER_SUMMARY = ("fare_amount", "trip_distance", "passenger_count", "trip_duration_minutes")


def silver_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after cleaning, with the duration."""
    units = {**_UNITS, "trip_duration_minutes": 60}
    table = profile.column_summary(silver_trips(spark, sf_dir), _SILVER_SUMMARY, per_unit=units)
    return _with_rounded(table, "stddev", "q25", "q50", "q75")


_ITEMS = ("l_extendedprice", "l_quantity", "l_discount")


def lineitem_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger line-item table, so that the quantiles take narrowing passes."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    table = profile.column_summary(items, _ITEMS, per_unit=_UNITS)
    return _with_rounded(table, "stddev", "q25", "q50", "q75")


def min_max_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_summary(
        trips(spark, sf_dir), ("fare_amount", "trip_distance"), stats=("min", "max", "mean"), quartiles=None,
        per_unit=_UNITS,
    )


MIN_MAX_SQL = f"WITH {TRIPS_SQL} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", min({c}) AS min, max({c}) AS max, {mean_sql(c, _UNITS[c])} AS mean FROM trips"""
    for c in ("fare_amount", "trip_distance")
)


def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box plot of the fares under 100."""
    table = profile.box_stats(trips(spark, sf_dir), "fare_amount", F.col("fare_amount") < 100)
    return _with_rounded(table, "q1", "median", "q3")


BOX_SQL = f"""WITH {TRIPS_SQL}, d AS (SELECT fare_amount AS v FROM trips WHERE fare_amount < 100),
q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3 FROM d),
f AS (SELECT *, q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM q)
SELECT count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
  min(v) FILTER (v >= lo) AS whisker_low, max(v) FILTER (v <= hi) AS whisker_high,
  count(*) FILTER (WHERE v < lo) AS outliers_low, count(*) FILTER (WHERE v > hi) AS outliers_high FROM d, f"""


def _histogram(col: str, lo: float, hi: float):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return profile.histogram(trips(spark, sf_dir), col, lo, hi, 50)

    return query


def _bin_sql(col: str, lo: float, hi: float, bins: int) -> str:
    width = (hi - lo) / bins
    return f"""CASE WHEN {col} < {lo}e0 THEN -1 WHEN {col} > {hi}e0 THEN {bins}
  ELSE least(CAST(floor(({col} - {lo}e0) / {width}e0) AS INT), {bins - 1}) END"""


def _histogram_sql(col: str, lo: float, hi: float) -> str:
    width = (hi - lo) / 50
    return f"""WITH {TRIPS_SQL}, h AS (SELECT {_bin_sql(col, lo, hi, 50)} AS bin, count(*) AS n FROM trips GROUP BY 1),
b AS (SELECT CAST(range AS INT) AS bin FROM range(-1, 51))
SELECT b.bin, CASE WHEN b.bin >= 0 THEN {lo}e0 + b.bin * {width}e0 END AS bin_lo,
  CASE WHEN b.bin < 50 THEN {lo}e0 + (b.bin + 1) * {width}e0 END AS bin_hi, coalesce(n, 0) AS count
FROM b LEFT JOIN h ON b.bin = h.bin"""


def density_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.density_2d(trips(spark, sf_dir), "trip_distance", "fare_amount")


DENSITY_SQL = f"""WITH {TRIPS_SQL} SELECT {_bin_sql('trip_distance', 0.0, 20.0, 50)} AS x_bin,
  {_bin_sql('fare_amount', 0.0, 100.0, 50)} AS y_bin, count(*) AS count FROM trips GROUP BY 1, 2"""

_CORR = ("fare_amount", "trip_distance", "passenger_count", "total_amount", "tip_amount")


def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_rounded(profile.correlations(trips(spark, sf_dir), _CORR), "r")


CORR_SQL = f"WITH {TRIPS_SQL} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM trips" for a in _CORR for b in _CORR
)


def month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items per ship year and month."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.year("l_shipdate").alias("data_year"), F.month("l_shipdate").alias("data_month")
    )
    return profile.value_counts(items, "data_year", "data_month")


MONTH_SQL = """SELECT CAST(year(l_shipdate) AS INT) AS data_year, CAST(month(l_shipdate) AS INT) AS data_month,
  count(*) AS count FROM lineitem GROUP BY 1, 2"""

_WIDE = 40


def _wide_column(i: int) -> str:
    """The i-th of many derived columns, null for a seventeenth of the rows, others in each column."""
    value = f"(CAST(l_quantity AS BIGINT) * {i + 1} + l_partkey * {7 * i % 11} + l_linenumber * {i * i % 13}) % {10 + i}"
    return f"CAST(CASE WHEN (l_suppkey + {i}) % 17 <> 0 THEN {value} END AS DOUBLE) AS w{i}"


def correlation_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlations of forty columns with nulls, from blocked co-moments."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*map(_wide_column, range(_WIDE)))
    return _with_rounded(comoments.wide_correlations(items, items.columns), "r")


_HALF = [(i, j) for i in range(_WIDE) for j in range(i, _WIDE)]
WIDE_SQL = f"""WITH w AS (SELECT {', '.join(map(_wide_column, range(_WIDE)))} FROM lineitem),
m AS (SELECT {', '.join(f"round(corr(w{i}, w{j}), 6) AS r{k}, regr_count(w{i}, w{j}) AS n{k}" for k, (i, j) in enumerate(_HALF))} FROM w),
h AS (SELECT unnest([{', '.join(f"{{'i': {i}, 'j': {j}, 'n': n{k}, 'r': r{k}}}" for k, (i, j) in enumerate(_HALF))}]) AS s FROM m)
SELECT 'w' || s.i AS a, 'w' || s.j AS b, s.n::BIGINT AS n, s.r AS r FROM h
UNION ALL SELECT 'w' || s.j, 'w' || s.i, s.n::BIGINT, s.r FROM h WHERE s.i <> s.j"""

QUERIES = {
    "correlation_wide": (correlation_wide, WIDE_SQL),
    "passenger_counts": (
        passenger_counts,
        f"WITH {TRIPS_SQL} SELECT passenger_count, count(*) AS count FROM trips GROUP BY passenger_count",
    ),
    "value_counts": (
        value_counts,
        "SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY l_returnflag, l_linestatus",
    ),
    "month_counts": (month_counts, MONTH_SQL),
    "column_summary": (column_summary, _summary_sql("trips", _SUMMARY, _UNITS, f"WITH {TRIPS_SQL} ")),
    "silver_summary": (
        silver_summary,
        _summary_sql("silver", _SILVER_SUMMARY, {**_UNITS, "trip_duration_minutes": 60}, f"WITH {SILVER_SQL} "),
    ),
    "lineitem_summary": (lineitem_summary, _summary_sql("lineitem", _ITEMS, _UNITS, "")),
    "min_max_mean": (min_max_mean, MIN_MAX_SQL),
    "box_stats": (box_stats, BOX_SQL),
    "histogram_fare": (_histogram("fare_amount", 0.0, 100.0), _histogram_sql("fare_amount", 0.0, 100.0)),
    "histogram_distance": (_histogram("trip_distance", 0.0, 20.0), _histogram_sql("trip_distance", 0.0, 20.0)),
    "density_2d": (density_2d, DENSITY_SQL),
    "correlation_matrix": (correlation_matrix, CORR_SQL),
}
