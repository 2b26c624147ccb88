"""Scans, sinks, casts and lineage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.trips import FEATURED_SQL, TIMED_SQL, TRIPS_SQL, featured_trips, trips
from farebox.operators.columns import (
    add_bronze_lineage,
    add_silver_lineage,
    gold_projection,
    narrow_ids,
    preview,
    rename,
    select_final,
    widen_integers,
)
from farebox.operators.features import with_duration
from farebox.operators.profile import value_counts
from farebox.operators.quality import apply_rules, impute_rules
from farebox.schema import trip_schema
from farebox.sources.readers import (
    align_types,
    read_trip_csv,
    read_trip_files,
    read_trip_lines,
    read_trips,
    union_aligned,
)
from farebox.sources.scratch import scratch_path
from farebox.sources.writers import write_csv, write_json, write_layer

AT = datetime(2024, 3, 1, 12, 0, 0)
HEADER = ",".join(f.name for f in trip_schema().fields)


def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips projected onto the raw schema: per column its type and how many rows fill it."""
    aligned = align_types(trips(spark, sf_dir), trip_schema())
    types = {f.name: f.dataType.simpleString() for f in aligned.schema.fields}
    counted = aligned.agg(*[F.count(c).alias(c) for c in aligned.columns])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("position"), F.lit(c).alias("name"), F.lit(t).alias("type"),
                             F.col(c).alias("filled"))
                    for i, (c, t) in enumerate(types.items())
                ]
            )
        )
    )


_ABSENT = {"extra", "mta_tax", "tolls_amount", "improvement_surcharge", "congestion_surcharge"}
SCHEMA_SQL = f"WITH {TRIPS_SQL} " + " UNION ALL ".join(
    f"SELECT {i} AS position, '{f.name}' AS name, '{f.dataType.simpleString()}' AS type, "
    + f"count({'NULL' if f.name in _ABSENT else f.name}) AS filled FROM trips"
    for i, f in enumerate(trip_schema().fields)
)


def _text(name: str) -> str:
    """A raw field as text, the same in both engines."""
    if name in _ABSENT:
        return "''"
    if name in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        return f"substr(CAST({name} AS STRING), 1, 19)"
    if name in ("trip_distance", "fare_amount", "tip_amount", "total_amount"):
        # whole hundredths keep the text short
        return f"CAST(CAST(floor({name} * 100e0 + 0.5e0) AS BIGINT) AS STRING)"
    return f"coalesce(CAST({name} AS STRING), '')"


def _line(fields: list[str]) -> str:
    return " || ',' || ".join(fields)


_FIELDS = {f.name: _text(f.name) for f in trip_schema().fields}
_FIELDS["VendorID"] = f"CASE WHEN trip_id % 83 = 0 THEN '' ELSE {_FIELDS['VendorID']} END"
_FIELDS["fare_amount"] = f"CASE WHEN trip_id % 79 = 0 THEN 'n/a' ELSE {_FIELDS['fare_amount']} END"
# Every kind of line a raw file may hold: repeated header, too few and too many fields, an
# empty required field, a fare that is no number.
SHORT_EXPR = _line(list(_FIELDS.values())[:-1])
LINE_EXPR = f"""CASE
  WHEN trip_id % 101 = 0 THEN '{HEADER}'
  WHEN trip_id % 97 = 0 THEN short
  WHEN trip_id % 89 = 0 THEN short || ',,'
  ELSE short || ',' END"""


def _trip_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = scratch_path(spark, "lines")
    lines = trips(spark, sf_dir).select("trip_id", F.expr(SHORT_EXPR).alias("short"))
    lines.select(F.expr(LINE_EXPR).alias("value")).write.text(path)
    return read_trip_lines(spark, path, header=HEADER)


_KEPT = ("VendorID", "passenger_count", "trip_distance", "PULocationID", "fare_amount", "total_amount")


def csv_validating_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written from the trips, read back typed; malformed lines are left out."""
    good, _ = _trip_lines(spark, sf_dir)
    return good.select(*_KEPT, F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("pickup"))


CSV_GOOD_SQL = f"""WITH {TRIPS_SQL}
SELECT VendorID, passenger_count, floor(trip_distance * 100e0 + 0.5e0) AS trip_distance, PULocationID,
  floor(fare_amount * 100e0 + 0.5e0) AS fare_amount, floor(total_amount * 100e0 + 0.5e0) AS total_amount,
  strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup
FROM trips
WHERE trip_id % 101 <> 0 AND trip_id % 97 <> 0 AND trip_id % 89 <> 0 AND trip_id % 83 <> 0 AND trip_id % 79 <> 0"""


def csv_headerless_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fields as lines without any header, each line twice: none is taken for a header."""
    path = scratch_path(spark, "lines")
    lines = trips(spark, sf_dir).select("trip_id", F.expr(SHORT_EXPR).alias("short"))
    lines = lines.select("trip_id", F.concat("short", F.lit(",")).alias("value"))
    lines.unionByName(lines).orderBy("trip_id").select("value").write.text(path)
    good, rejects = read_trip_lines(spark, path)
    rejected = rejects.agg(F.count(F.lit(1)).alias("rejected")).scalar()
    return good.agg(F.count(F.lit(1)).alias("good")).select("good", rejected.alias("rejected"))


HEADERLESS_SQL = f"""WITH {TRIPS_SQL} SELECT 2 * count(*) FILTER (WHERE trip_id % 83 <> 0 AND trip_id % 79 <> 0) AS good,
  2 * count(*) FILTER (WHERE trip_id % 83 = 0 OR trip_id % 79 = 0) AS rejected FROM trips"""


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected lines of the same files, whole, with the reason."""
    return _trip_lines(spark, sf_dir)[1]


CSV_REJECT_SQL = f"""WITH {TRIPS_SQL}, l AS (SELECT trip_id, {SHORT_EXPR} AS short FROM trips)
SELECT {LINE_EXPR} AS value,
  CASE WHEN trip_id % 97 = 0 OR trip_id % 89 = 0 THEN 'field_count'
       WHEN trip_id % 83 = 0 THEN 'empty_required' ELSE 'bad_value' END AS reject_reason
FROM l
WHERE trip_id % 101 <> 0
  AND (trip_id % 97 = 0 OR trip_id % 89 = 0 OR trip_id % 83 = 0 OR trip_id % 79 = 0)"""


def csv_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips written as CSV with a header and read back with their schema."""
    cols = ["trip_id", "VendorID", "passenger_count", "trip_distance", "store_and_fwd_flag", "fare_amount"]
    rows = trips(spark, sf_dir).select(*cols)
    path = scratch_path(spark, "csv")
    write_csv(rows, path)
    return read_trip_csv(spark, path, rows.schema)


CSV_HEADER_SQL = f"""WITH {TRIPS_SQL}
SELECT trip_id, VendorID, passenger_count, trip_distance, store_and_fwd_flag, fare_amount FROM trips"""


def json_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested per-zone report written as JSON and read back."""
    report = trips(spark, sf_dir).groupBy("PULocationID").agg(
        F.struct(
            F.count(F.lit(1)).alias("trips"), F.min("fare_amount").alias("low"), F.max("fare_amount").alias("high")
        ).alias("stats")
    )
    path = scratch_path(spark, "json")
    write_json(report, path)
    return spark.read.schema(report.schema).json(path).select("PULocationID", "stats.*")


JSON_SQL = f"""WITH {TRIPS_SQL}
SELECT PULocationID, count(*) AS trips, min(fare_amount) AS low, max(fare_amount) AS high
FROM trips GROUP BY PULocationID"""


def _monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").withColumns(
        {"data_year": F.year("o_orderdate"), "data_month": F.month("o_orderdate")}
    )


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as a layer partitioned by year and month, read back and counted per month."""
    path = scratch_path(spark, "layer")
    write_layer(_monthly_orders(spark, sf_dir), path, rebalance=True)
    return value_counts(read_trips(spark, path), "data_year", "data_month")


LAYER_SQL = """SELECT CAST(year(o_orderdate) AS INT) AS data_year, CAST(month(o_orderdate) AS INT) AS data_month,
  count(*) AS count FROM orders GROUP BY 1, 2"""


def layer_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months of the same layer; the others are pruned by partition."""
    path = scratch_path(spark, "layer")
    write_layer(_monthly_orders(spark, sf_dir), path, rebalance=True)
    picked = read_trips(spark, path, months=[(1996, 2), (1997, 11)])
    return picked.groupBy("data_year", "data_month", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("top_price")
    )


LAYER_MONTHS_SQL = """SELECT CAST(year(o_orderdate) AS INT) AS data_year, CAST(month(o_orderdate) AS INT) AS data_month,
  o_orderstatus, count(*) AS orders, max(o_totalprice) AS top_price
FROM orders
WHERE (year(o_orderdate) = 1996 AND month(o_orderdate) = 2) OR (year(o_orderdate) = 1997 AND month(o_orderdate) = 11)
GROUP BY 1, 2, 3"""


def month_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer whose year 1996 is loaded again with doubled prices; the other months stay."""
    path = scratch_path(spark, "reload")
    orders = _monthly_orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "data_year", "data_month")
    write_layer(orders, path, rebalance=True)
    again = orders.filter(F.col("data_year") == 1996).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_layer(again, path, rebalance=True, replace_months_only=True)
    return read_trips(spark, path).select("o_orderkey", "o_totalprice", "data_year", "data_month")


RELOAD_SQL = """SELECT o_orderkey,
  CASE WHEN year(o_orderdate) = 1996 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
  CAST(year(o_orderdate) AS INT) AS data_year, CAST(month(o_orderdate) AS INT) AS data_month
FROM orders"""

_MONTH_COLS = ("trip_id", "VendorID", "passenger_count", "PULocationID", "fare_amount")


def union_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files with int32, int64 and double ids in different column orders, read as one."""
    base = trips(spark, sf_dir).select(*_MONTH_COLS, "tpep_pickup_datetime")
    day = F.dayofmonth("tpep_pickup_datetime")
    wide = {c: F.col(c).cast("bigint") for c in ("VendorID", "PULocationID")}
    parts = {
        "a": base.filter(day <= 10).select(*_MONTH_COLS),
        "b": base.filter((day > 10) & (day <= 20)).withColumns(wide).select(*reversed(_MONTH_COLS)),
        "c": base.filter(day > 20)
        .withColumn("passenger_count", F.col("passenger_count").cast("double"))
        .select(*_MONTH_COLS),
    }
    root = scratch_path(spark, "months")
    for name, part in parts.items():
        part.write.parquet(f"{root}/{name}")
    return read_trip_files(spark, [f"{root}/{name}" for name in parts])


UNION_SQL = f"""WITH {TRIPS_SQL}
SELECT trip_id, CAST(VendorID AS BIGINT) AS VendorID, CAST(passenger_count AS BIGINT) AS passenger_count,
  CAST(PULocationID AS BIGINT) AS PULocationID, fare_amount FROM trips"""


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and line items under common names; columns one side lacks are null."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status")
    )
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_extendedprice").alias("amount"), F.col("l_linenumber").alias("line"), F.col("l_orderkey").alias("id")
    )
    both = union_aligned(orders, items, allow_missing=True)
    return both.groupBy("status", "line").agg(
        F.count(F.lit(1)).alias("rows"), F.min("amount").alias("low"), F.max("id").alias("last_id")
    )


UNION_NAME_SQL = """WITH both_tables AS (
  SELECT o_orderkey AS id, o_totalprice AS amount, o_orderstatus AS status, CAST(NULL AS INT) AS line FROM orders
  UNION ALL
  SELECT l_orderkey, l_extendedprice, NULL, l_linenumber FROM lineitem)
SELECT status, line, count(*) AS rows, min(amount) AS low, max(id) AS last_id FROM both_tables GROUP BY status, line"""


def widen_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = widen_integers(trips(spark, sf_dir).select("trip_id", "VendorID", "passenger_count", "payment_type"))
    assert all(isinstance(f.dataType, T.LongType) for f in df.schema.fields)
    return df


WIDEN_SQL = f"""WITH {TRIPS_SQL} SELECT trip_id, CAST(VendorID AS BIGINT) AS VendorID,
  CAST(passenger_count AS BIGINT) AS passenger_count, CAST(payment_type AS BIGINT) AS payment_type FROM trips"""


def narrow_ids_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids stored as long and double, one of them out of range, narrowed to int."""
    wide = trips(spark, sf_dir).select(
        "trip_id",
        F.col("VendorID").cast("bigint").alias("VendorID"),
        F.col("passenger_count").cast("double").alias("passenger_count"),
        (F.col("PULocationID") * F.when(F.col("trip_id") % 500 == 0, F.lit(10**10)).otherwise(F.lit(1))).alias(
            "PULocationID"
        ),
    )
    return narrow_ids(wide, ("VendorID", "passenger_count", "PULocationID"))


NARROW_SQL = f"""WITH {TRIPS_SQL} SELECT trip_id, VendorID, passenger_count,
  CASE WHEN trip_id % 500 = 0 THEN NULL ELSE PULocationID END AS PULocationID FROM trips"""


def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_bronze_lineage(trips(spark, sf_dir), F.lit("2024-03-01 12:00:00").cast("timestamp_ntz"), "unit-month")
    return rows.select("trip_id", "ingestion_timestamp", "source_file", "data_year", "data_month")


BRONZE_SQL = f"""WITH {TRIPS_SQL} SELECT trip_id, TIMESTAMP '2024-03-01 12:00:00' AS ingestion_timestamp,
  'unit-month' AS source_file, CAST(year(tpep_pickup_datetime) AS INT) AS data_year,
  CAST(month(tpep_pickup_datetime) AS INT) AS data_month FROM trips"""


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source file, from each row's own file path."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    stamped = add_bronze_lineage(events, AT, ts="ts")
    name = F.element_at(F.split("source_file", "/"), -1).alias("file")
    return stamped.groupBy(name, "data_year", "data_month").agg(F.count(F.lit(1)).alias("rows"))


SOURCE_SQL = """SELECT 'events.parquet' AS file, CAST(year(ts) AS INT) AS data_year, CAST(month(ts) AS INT) AS data_month,
  count(*) AS rows FROM events GROUP BY 2, 3"""


def silver_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = apply_rules(with_duration(trips(spark, sf_dir)), impute_rules())
    stamped = add_silver_lineage(cleaned, F.lit("2024-03-02 00:00:00").cast("timestamp_ntz"))
    return stamped.select("trip_id", "trip_duration_minutes", "silver_timestamp", "data_quality_flag")


SILVER_LINEAGE_SQL = f"""WITH {TIMED_SQL}
SELECT trip_id, trip_duration_minutes, TIMESTAMP '2024-03-02 00:00:00' AS silver_timestamp,
  'clean' AS data_quality_flag
FROM timed
WHERE fare_amount > 0 AND fare_amount <= 500 AND trip_distance > 0 AND trip_distance <= 100 AND total_amount > 0
  AND trip_duration_minutes BETWEEN 1 AND 180
  AND coalesce(passenger_count, 1) > 0 AND coalesce(passenger_count, 1) <= 6"""


def gold_projection_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold columns; a plain number stands in for the vector so that SQL can compare it."""
    rows = featured_trips(spark, sf_dir).withColumns(
        {
            "features": F.col("trip_distance") * 2,
            "data_year": F.year("tpep_pickup_datetime"),
            "data_month": F.month("tpep_pickup_datetime"),
        }
    )
    return gold_projection(rows)


GOLD_SQL = f"""WITH {FEATURED_SQL}
SELECT trip_distance * 2 AS features, label, trip_distance, passenger_count, pickup_hour, is_rush_hour, is_weekend,
  is_airport_trip, pickup_year AS data_year, pickup_month AS data_month, VendorID, tpep_pickup_datetime FROM featured"""


def final_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = featured_trips(spark, sf_dir).withColumn("features", F.col("trip_distance") * 2)
    return rename(select_final(rows, ("trip_id", "trip_distance"), target="label"), {"label": "fare_amount"})


FINAL_SQL = f"""WITH {FEATURED_SQL}
SELECT trip_id, trip_distance, trip_distance * 2 AS features, label AS fare_amount, passenger_count, is_rush_hour,
  is_weekend, pickup_hour FROM featured"""


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(featured_trips(spark, sf_dir), ["trip_id", "trip_distance", "label"], ["trip_id"], 10)


PREVIEW_SQL = f"WITH {FEATURED_SQL} SELECT trip_id, trip_distance, label FROM featured ORDER BY trip_id LIMIT 10"

QUERIES = {
    "schema_check": (schema_check, SCHEMA_SQL),
    "csv_validating_scan": (csv_validating_scan, CSV_GOOD_SQL),
    "csv_headerless_scan": (csv_headerless_scan, HEADERLESS_SQL),
    "csv_rejects": (csv_rejects, CSV_REJECT_SQL),
    "csv_header_scan": (csv_header_scan, CSV_HEADER_SQL),
    "json_report": (json_report, JSON_SQL),
    "layer_counts": (layer_counts, LAYER_SQL),
    "layer_months": (layer_months, LAYER_MONTHS_SQL),
    "month_reload": (month_reload, RELOAD_SQL),
    "union_monthly": (union_monthly, UNION_SQL),
    "union_by_name": (union_by_name, UNION_NAME_SQL),
    "widen_ints": (widen_ints, WIDEN_SQL),
    "narrow_ids": (narrow_ids_query, NARROW_SQL),
    "bronze_lineage": (bronze_lineage, BRONZE_SQL),
    "source_files": (source_files, SOURCE_SQL),
    "silver_lineage": (silver_lineage, SILVER_LINEAGE_SQL),
    "gold_projection": (gold_projection_query, GOLD_SQL),
    "final_selection": (final_selection, FINAL_SQL),
    "preview_rows": (preview_rows, PREVIEW_SQL),
}
