"""Derived columns and group statistics joined back."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.trips import (
    FEATURED_SQL,
    PER_UNIT,
    SECONDS_SQL,
    TIMED_SQL,
    TRIPS_SQL,
    featured_trips,
    mean_sql,
    silver_trips,
    trips,
    uniform_sql,
)
from farebox.functions import trip
from farebox.operators import features, moments, out_of_fold
from farebox.operators.group_stats import (
    GroupTable,
    apply_group_stats,
    default_specs,
    fit_group_stats,
    group_stats,
    lookup_join,
)
from farebox.operators.membership import with_membership
from farebox.operators.sampling import hash_split
from farebox.sources.scratch import scratch_path


def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.time_features(trips(spark, sf_dir)).select(
        "trip_id", "pickup_hour", "pickup_day_of_week", "pickup_month", "pickup_year",
        "is_weekend", "is_rush_hour", "is_late_night",
    )


_PARTS = """trip_id, CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour,
  CAST(dayofweek(tpep_pickup_datetime) + 1 AS INT) AS pickup_day_of_week,
  CAST(month(tpep_pickup_datetime) AS INT) AS pickup_month, CAST(year(tpep_pickup_datetime) AS INT) AS pickup_year"""


def _time_sql(rush: str) -> str:
    return f"""WITH {TRIPS_SQL}, parts AS (SELECT {_PARTS} FROM trips)
SELECT *, CASE WHEN pickup_day_of_week IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN {rush} THEN 1 ELSE 0 END AS is_rush_hour,
  CASE WHEN pickup_hour >= 22 OR pickup_hour < 5 THEN 1 ELSE 0 END AS is_late_night FROM parts"""


def time_features_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the shorter rush-hour windows."""
    return features.time_features(trips(spark, sf_dir), rush=trip.RUSH_NARROW).select(
        "trip_id", "pickup_hour", "pickup_day_of_week", "pickup_month", "pickup_year",
        "is_weekend", "is_rush_hour", "is_late_night",
    )


def trip_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.trip_features(trips(spark, sf_dir), max_mph=None).select(
        "trip_id", "trip_duration_seconds", "trip_duration_minutes", "speed_mph", "fare_per_mile", "tip_percentage"
    )


_SPEED = "CASE WHEN secs > 0 THEN trip_distance / secs * 3600e0 ELSE 0e0 END"
_PER_MILE = "CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance ELSE 0e0 END"
_TIP_PCT = "CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100e0 ELSE 0e0 END"
_SECS = f"s AS (SELECT *, {SECONDS_SQL} AS secs FROM timed)"
TRIP_SQL = f"""WITH {TIMED_SQL}, {_SECS} SELECT trip_id, secs AS trip_duration_seconds, trip_duration_minutes,
  {_SPEED} AS speed_mph, {_PER_MILE} AS fare_per_mile, {_TIP_PCT} AS tip_percentage FROM s"""


def speed_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = trip.duration_seconds("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return trips(spark, sf_dir).select("trip_id", trip.speed_mph(F.col("trip_distance"), seconds).alias("speed_mph"))


def speed_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.clamped_speed(features.with_duration(trips(spark, sf_dir)))
    return rows.select("trip_id", "avg_speed_mph")


CLAMPED_SQL = f"""WITH {TIMED_SQL} SELECT trip_id, least(CASE WHEN trip_duration_minutes = 0 THEN 0e0
  ELSE trip_distance / (trip_duration_minutes / 60e0) END, 100e0) AS avg_speed_mph FROM timed"""


def location_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.location_features(trips(spark, sf_dir)).select(
        "trip_id", "is_airport_pickup", "is_airport_dropoff", "is_airport_trip",
        "is_manhattan_pickup", "is_manhattan_dropoff", "is_cross_borough",
    )


def _location_sql(zones: str) -> str:
    return f"""WITH {TRIPS_SQL}, f AS (SELECT trip_id,
  CASE WHEN PULocationID IN {zones} THEN 1 ELSE 0 END AS is_airport_pickup,
  CASE WHEN DOLocationID IN {zones} THEN 1 ELSE 0 END AS is_airport_dropoff,
  CASE WHEN PULocationID BETWEEN 1 AND 100 THEN 1 ELSE 0 END AS is_manhattan_pickup,
  CASE WHEN DOLocationID BETWEEN 1 AND 100 THEN 1 ELSE 0 END AS is_manhattan_dropoff FROM trips)
SELECT *, greatest(is_airport_pickup, is_airport_dropoff) AS is_airport_trip,
  CASE WHEN is_manhattan_pickup <> is_manhattan_dropoff THEN 1 ELSE 0 END AS is_cross_borough FROM f"""


def airport_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The location flags with the longer airport zone list."""
    return features.location_features(trips(spark, sf_dir), airports=trip.AIRPORTS_ALL).select(
        "trip_id", "is_airport_pickup", "is_airport_dropoff", "is_airport_trip",
        "is_manhattan_pickup", "is_manhattan_dropoff", "is_cross_borough",
    )


def payment_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.payment_flags(trips(spark, sf_dir)).select("trip_id", "is_credit_card", "is_cash")


PAYMENT_SQL = f"""WITH {TRIPS_SQL} SELECT trip_id, CASE WHEN payment_type = 1 THEN 1 ELSE 0 END AS is_credit_card,
  CASE WHEN payment_type = 2 THEN 1 ELSE 0 END AS is_cash FROM trips"""


def fare_per_mile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.trip_features(silver_trips(spark, sf_dir), max_mph=None)
    return rows.select("trip_id", "fare_per_mile")


PER_MILE_SQL = f"WITH {FEATURED_SQL} SELECT trip_id, label / trip_distance AS fare_per_mile FROM featured"


def tip_percentage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.tip_percentage(trips(spark, sf_dir)).select("trip_id", "tip_percentage")


def model_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model input of the cleaned trips, as plain columns."""
    return featured_trips(spark, sf_dir).select(
        "trip_id", "pickup_hour", "pickup_day_of_week", "is_rush_hour", "is_weekend", "is_late_night",
        "is_airport_pickup", "is_airport_dropoff", "is_airport_trip", "avg_speed_mph", "is_credit_card", "is_cash",
    )


MODEL_SQL = f"""WITH {FEATURED_SQL} SELECT trip_id, pickup_hour, pickup_day_of_week, is_rush_hour, is_weekend,
  is_late_night, is_airport_pickup, is_airport_dropoff, is_airport_trip, avg_speed_mph, is_credit_card, is_cash
FROM featured"""


# ---- group statistics -------------------------------------------------------------------

# tip percentages are no whole units; ten-thousandths are fine enough to compare exactly
_UNITS = {**PER_UNIT, "tip_percentage": 10_000}


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.tip_percentage(features.time_features(trips(spark, sf_dir)))
    # a missing passenger count also hides the payment type, so one group key has nulls
    payment = F.when(F.col("passenger_count").isNotNull(), F.col("payment_type"))
    return df.withColumn("payment_type", payment)


BASE_SQL = f"""{TRIPS_SQL}, base AS (
  SELECT * REPLACE (CASE WHEN passenger_count IS NOT NULL THEN payment_type END AS payment_type),
    CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour, {_TIP_PCT} AS tip_percentage FROM trips)"""


def _stats_sql(key: str, table: str = "base") -> str:
    return {
        "VendorID": f"""SELECT VendorID, {mean_sql('fare_amount', 100)} AS vendor_avg_fare,
  {mean_sql('trip_distance', 350)} AS vendor_avg_distance, {mean_sql('tip_amount', 100)} AS vendor_avg_tip
  FROM {table} GROUP BY VendorID""",
        "pickup_hour": f"""SELECT pickup_hour, {mean_sql('fare_amount', 100)} AS hour_avg_fare,
  {mean_sql('trip_distance', 350)} AS hour_avg_distance, count(*) AS hour_trip_count
  FROM {table} GROUP BY pickup_hour""",
        "payment_type": f"""SELECT payment_type, {mean_sql('tip_percentage', 10000)} AS payment_avg_tip_pct
  FROM {table} GROUP BY payment_type""",
    }[key]


def _stats(key: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return group_stats(_base(spark, sf_dir), key, default_specs(_UNITS)[key])

    return query


_JOINED = """SELECT t.trip_id, v.* EXCLUDE (VendorID), h.* EXCLUDE (pickup_hour), p.* EXCLUDE (payment_type)
FROM {rows} t LEFT JOIN v ON t.VendorID = v.VendorID LEFT JOIN h ON t.pickup_hour = h.pickup_hour
LEFT JOIN p ON t.payment_type = p.payment_type"""
_STATS_OUT = (
    "trip_id", "vendor_avg_fare", "vendor_avg_distance", "vendor_avg_tip",
    "hour_avg_fare", "hour_avg_distance", "hour_trip_count", "payment_avg_tip_pct",
)


def _with_stats(table: str) -> str:
    return f"""v AS ({_stats_sql('VendorID', table)}), h AS ({_stats_sql('pickup_hour', table)}),
p AS ({_stats_sql('payment_type', table)})"""


def aggregated_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three statistics fitted on the whole table and joined back onto it."""
    df = _base(spark, sf_dir)
    return apply_group_stats(df, fit_group_stats(df, default_specs(_UNITS))).select(*_STATS_OUT)


AGGREGATED_SQL = f"WITH {BASE_SQL}, {_with_stats('base')} " + _JOINED.format(rows="base")


def train_only_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics fitted on the training split, joined onto the test split."""
    train, test = hash_split(_base(spark, sf_dir), "trip_id", method="md5")
    return apply_group_stats(test, fit_group_stats(train, default_specs(_UNITS))).select(*_STATS_OUT)


TRAIN_ONLY_SQL = f"""WITH {BASE_SQL},
train AS (SELECT * FROM base WHERE {uniform_sql('trip_id')} < 0.8e0),
test AS (SELECT * FROM base WHERE {uniform_sql('trip_id')} >= 0.8e0),
{_with_stats('train')} """ + _JOINED.format(rows="test")


_FOLDS = 5


def _averages() -> dict:
    return {
        key: [replace(a, per_unit=_UNITS[a.col]) if isinstance(a, out_of_fold.Average) else a for a in listed]
        for key, listed in out_of_fold.DEFAULT_AVERAGES.items()
    }


def out_of_fold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics for training rows from the other folds, and for test rows from all of them."""
    train, test = hash_split(_base(spark, sf_dir), "trip_id", method="md5")
    fitted = out_of_fold.fit_out_of_fold(train, _averages(), "trip_id", _FOLDS, method="md5")
    trained = fitted.training_features(train).select(*_STATS_OUT, F.lit("train").alias("side"))
    return trained.unionByName(fitted.features(test).select(*_STATS_OUT, F.lit("test").alias("side")))


def out_of_fold_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per pickup zone, joined by shuffle with hot cells spread."""
    specs = {"PULocationID": [out_of_fold.Average("fare_amount", "zone_avg_fare", 100), out_of_fold.Rows("zone_trips")]}
    df = _base(spark, sf_dir)
    fitted = out_of_fold.fit_out_of_fold(df, specs, "trip_id", _FOLDS, method="md5")
    joined = fitted.training_features(df, broadcast_bytes=0, hot_share=0.0008, salt_cols=["trip_id"])
    return joined.select("trip_id", "zone_avg_fare", "zone_trips")


def _rest_sql(key: str, table: str, columns: dict[str, tuple[str, int] | None]) -> str:
    """The rows of ``table`` with statistics of their key over the other folds; ``columns``: out -> (column, unit) or None."""
    parts = []
    for out, spec in columns.items():
        if spec is None:
            parts.append(f"(count(*) OVER k - count(*) OVER f) AS {out}")
            continue
        whole = f"CAST(floor({spec[0]} * {spec[1]}e0 + 0.5e0) AS BIGINT)"
        total, n = f"(sum({whole}) OVER k - coalesce(sum({whole}) OVER f, 0))", f"(count({spec[0]}) OVER k - count({spec[0]}) OVER f)"
        parts.append(f"CASE WHEN {n} > 0 THEN CAST({total} AS DOUBLE) / CAST({n} AS DOUBLE) / {spec[1]}e0 END AS {out}")
    return f"""SELECT trip_id, {', '.join(parts)} FROM {table} WHERE {key} IS NOT NULL
  WINDOW k AS (PARTITION BY {key}), f AS (PARTITION BY {key}, fold)"""


_VENDOR = {"vendor_avg_fare": ("fare_amount", 100), "vendor_avg_distance": ("trip_distance", 350), "vendor_avg_tip": ("tip_amount", 100)}
_HOUR = {"hour_avg_fare": ("fare_amount", 100), "hour_avg_distance": ("trip_distance", 350), "hour_trip_count": None}
_FOLDED_SQL = f"SELECT *, CAST(floor({uniform_sql('trip_id', 'fold')} * {_FOLDS}e0) AS INT) AS fold FROM base"
OUT_OF_FOLD_SQL = f"""WITH {BASE_SQL}, train AS (SELECT * FROM ({_FOLDED_SQL}) WHERE {uniform_sql('trip_id')} < 0.8e0),
test AS (SELECT * FROM base WHERE {uniform_sql('trip_id')} >= 0.8e0), {_with_stats('train')},
tv AS ({_rest_sql('VendorID', 'train', _VENDOR)}), th AS ({_rest_sql('pickup_hour', 'train', _HOUR)}),
tp AS ({_rest_sql('payment_type', 'train', {'payment_avg_tip_pct': ('tip_percentage', 10000)})})
SELECT trip_id, tv.* EXCLUDE (trip_id), th.* EXCLUDE (trip_id), tp.* EXCLUDE (trip_id), 'train' AS side
FROM train LEFT JOIN tv USING (trip_id) LEFT JOIN th USING (trip_id) LEFT JOIN tp USING (trip_id)
UNION ALL SELECT *, 'test' FROM ({_JOINED.format(rows="test")})"""
OUT_OF_FOLD_ZONES_SQL = f"""WITH {BASE_SQL}, every AS ({_FOLDED_SQL})
{_rest_sql('PULocationID', 'every', {'zone_avg_fare': ('fare_amount', 100), 'zone_trips': None})}"""


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone statistics joined without broadcasting the table: the way taken by many-valued keys."""
    df = _base(spark, sf_dir)
    specs = {"DOLocationID": [F.count(F.lit(1)).alias("zone_trips"), F.max("fare_amount").alias("zone_top_fare")]}
    table: GroupTable = fit_group_stats(df, specs)["DOLocationID"]
    joined = lookup_join(df, table, broadcast_bytes=0, hot_share=0.004, salt_cols=["trip_id"])
    return joined.select("trip_id", "zone_trips", "zone_top_fare")


ZONE_SQL = f"""WITH {BASE_SQL}, z AS (SELECT DOLocationID, count(*) AS zone_trips, max(fare_amount) AS zone_top_fare
  FROM base GROUP BY DOLocationID)
SELECT trip_id, zone_trips, zone_top_fare FROM base JOIN z USING (DOLocationID)"""

_STORED = {"fare_amount": 100, "trip_distance": 350, "tip_amount": 100, "trip_duration_minutes": None}


def _month_store(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(months of moments, the trips): stored in two parts, one month first with half of its rows, then replaced."""
    rows = features.with_duration(_base(spark, sf_dir)).withColumns(
        {"data_year": F.year("tpep_pickup_datetime"), "data_month": F.month("tpep_pickup_datetime")}
    )
    path, keys = scratch_path(spark, "moments"), ["VendorID", "pickup_hour", "payment_type"]
    odd = F.col("data_month") % 2 == 1
    moments.update_store(rows.filter(odd & (F.col("trip_id") % 2 == 0)), path, _STORED, keys)
    moments.update_store(rows.filter(~odd), path, _STORED, keys)
    moments.update_store(rows.filter(odd), path, _STORED, keys)
    return moments.read_store(spark, path), rows


def month_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation of each column, merged from the stored months."""
    store, _ = _month_store(spark, sf_dir)
    every = moments.merged(store.filter(F.col("key") == moments.EVERY), _STORED)
    return every.select("column", "rows", "n", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


MONTH_SCALER_SQL = f"WITH {TIMED_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS rows, count({c}) AS n, round(avg({c}), 9) AS mean, round(stddev_samp({c}), 9) AS std FROM timed"
    for c in _STORED
)


def month_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages per vendor, hour and payment type from the stored months, joined onto all trips."""
    store, rows = _month_store(spark, sf_dir)
    wanted = {
        "VendorID": ("int", {"fare_amount": "vendor_avg_fare", "trip_distance": "vendor_avg_distance", "tip_amount": "vendor_avg_tip"}),
        "pickup_hour": ("int", {"fare_amount": "hour_avg_fare", "trip_distance": "hour_avg_distance"}),
        "payment_type": ("int", {"tip_amount": "payment_avg_tip"}),
    }
    for key, (kind, out) in wanted.items():
        rows = lookup_join(rows, moments.group_table(store, _STORED, key, kind, out))
    return rows.select("trip_id", *[o for _, out in wanted.values() for o in out.values()])


MONTH_GROUP_SQL = f"""WITH {BASE_SQL}, v AS ({_stats_sql('VendorID')}), h AS ({_stats_sql('pickup_hour')}),
p AS (SELECT payment_type, {mean_sql('tip_amount', 100)} AS payment_avg_tip FROM base GROUP BY payment_type)
SELECT trip_id, vendor_avg_fare, vendor_avg_distance, vendor_avg_tip, hour_avg_fare, hour_avg_distance, payment_avg_tip
FROM base LEFT JOIN v USING (VendorID) LEFT JOIN h USING (pickup_hour) LEFT JOIN p USING (payment_type)"""

def part_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose part, supplier and order are in lists of some, many and very many values; one list holds a null."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "part", "supplier", "orders")}
    key = F.when(F.col("l_linenumber") != 3, F.col("l_orderkey")).alias("order_key")
    items = tables["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", key)
    large = tables["orders"].filter(F.col("o_orderkey") % 3 == 0)
    rich = tables["supplier"].filter(F.col("s_suppkey") % 2 == 0)
    with_null = large.select(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey")).alias("o_orderkey"))
    rows = with_membership(items, "l_suppkey", rich, "s_suppkey", "of_supplier")
    rows = with_membership(rows, "l_partkey", tables["part"].filter(F.col("p_partkey") % 4 != 0), "p_partkey", "of_part", literals=10)
    how = {"literals": 10, "broadcast_bytes": 0, "salt_cols": ["l_orderkey", "l_linenumber"]}
    rows = with_membership(rows, "order_key", large, "o_orderkey", "of_order", **how)
    rows = with_membership(rows, "order_key", with_null, "o_orderkey", "of_order_or_null", **how)
    return rows.select("l_orderkey", "l_linenumber", "of_supplier", "of_part", "of_order", "of_order_or_null")


MEMBERSHIP_SQL = """WITH i AS (SELECT *, CASE WHEN l_linenumber <> 3 THEN l_orderkey END AS order_key FROM lineitem)
SELECT l_orderkey, l_linenumber, l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0) AS of_supplier,
  l_partkey IN (SELECT p_partkey FROM part WHERE p_partkey % 4 <> 0) AS of_part,
  order_key IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0) AS of_order,
  order_key IN (SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END FROM orders WHERE o_orderkey % 3 = 0) AS of_order_or_null
FROM i"""

QUERIES = {
    "part_membership": (part_membership, MEMBERSHIP_SQL),
    "time_features": (
        time_features,
        _time_sql("pickup_hour BETWEEN 7 AND 9 OR pickup_hour BETWEEN 16 AND 18"),
    ),
    "time_features_narrow": (time_features_narrow, _time_sql("pickup_hour IN (7, 8, 17, 18)")),
    "trip_features": (trip_features, TRIP_SQL),
    "speed_guarded": (speed_guarded, f"WITH {TIMED_SQL}, {_SECS} SELECT trip_id, {_SPEED} AS speed_mph FROM s"),
    "speed_clamped": (speed_clamped, CLAMPED_SQL),
    "location_features": (location_features, _location_sql("(132, 138, 1)")),
    "airport_flags": (airport_flags, _location_sql("(1, 132, 137, 138)")),
    "payment_flags": (payment_flags, PAYMENT_SQL),
    "fare_per_mile": (fare_per_mile, PER_MILE_SQL),
    "tip_percentage": (
        tip_percentage,
        f"WITH {TRIPS_SQL} SELECT trip_id, {_TIP_PCT} AS tip_percentage FROM trips",
    ),
    "model_features": (model_features, MODEL_SQL),
    "vendor_stats": (_stats("VendorID"), f"WITH {BASE_SQL} {_stats_sql('VendorID')}"),
    "hour_stats": (_stats("pickup_hour"), f"WITH {BASE_SQL} {_stats_sql('pickup_hour')}"),
    "payment_stats": (_stats("payment_type"), f"WITH {BASE_SQL} {_stats_sql('payment_type')}"),
    "aggregated_features": (aggregated_features, AGGREGATED_SQL),
    "train_only_features": (train_only_features, TRAIN_ONLY_SQL),
    "out_of_fold_features": (out_of_fold_features, OUT_OF_FOLD_SQL),
    "out_of_fold_zones": (out_of_fold_zones, OUT_OF_FOLD_ZONES_SQL),
    "month_scaler": (month_scaler, MONTH_SCALER_SQL),
    "month_group_stats": (month_group_stats, MONTH_GROUP_SQL),
    "zone_lookup": (zone_lookup, ZONE_SQL),
}
