"""Column contracts of the trip tables, layer by layer."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw trip columns and their types, in file order.
RAW_COLUMNS = (
    ("VendorID", "int"),
    ("tpep_pickup_datetime", "timestamp"),
    ("tpep_dropoff_datetime", "timestamp"),
    ("passenger_count", "int"),
    ("trip_distance", "double"),
    ("RatecodeID", "int"),
    ("store_and_fwd_flag", "string"),
    ("PULocationID", "int"),
    ("DOLocationID", "int"),
    ("payment_type", "int"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
)

# The id-like columns that months store as int, long or double.
ID_COLS = (
    "VendorID",
    "passenger_count",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
    "payment_type",
)

PARTITION_COLS = ("data_year", "data_month")

BRONZE_LINEAGE_COLS = ("ingestion_timestamp", "source_file", "data_year", "data_month")

SILVER_EXTRA_COLS = ("trip_duration_minutes", "silver_timestamp", "data_quality_flag")

# The model's inputs, in vector-slot order.
FEATURES_13 = (
    "trip_distance",
    "passenger_count",
    "pickup_hour",
    "pickup_day_of_week",
    "pickup_month",
    "is_rush_hour",
    "is_weekend",
    "is_airport_trip",
    "avg_speed_mph",
    "is_credit_card",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
)

# Columns of the gold table, in order.
GOLD_COLS = (
    "features",
    "label",
    "trip_distance",
    "passenger_count",
    "pickup_hour",
    "is_rush_hour",
    "is_weekend",
    "is_airport_trip",
    "data_year",
    "data_month",
    "VendorID",
    "tpep_pickup_datetime",
)

# Columns kept beside the vector for later analysis.
ANALYSIS_COLS = (
    "trip_distance",
    "passenger_count",
    "is_rush_hour",
    "is_weekend",
    "pickup_hour",
)

# Columns of the prediction export, before renaming.
EXPORT_COLS = (
    "label",
    "prediction",
    "trip_distance",
    "passenger_count",
    "pickup_hour",
    "is_rush_hour",
    "is_weekend",
    "is_airport_trip",
    "VendorID",
)


def trip_schema(widen: bool = False) -> T.StructType:
    """The raw trip schema, every field nullable.

    ``widen`` declares the integer fields as long, which lets one Parquet scan read months
    that store them as int32 together with months that store them as int64.
    """
    types = {
        "int": T.LongType() if widen else T.IntegerType(),
        "double": T.DoubleType(),
        "string": T.StringType(),
        "timestamp": T.TimestampType(),
    }
    return T.StructType([T.StructField(name, types[kind], True) for name, kind in RAW_COLUMNS])
