from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.operators.columns import (
    add_bronze_lineage,
    narrow_ids,
    preview,
    rename,
    select_final,
    widen_integers,
)
from farebox.schema import RAW_COLUMNS, trip_schema
from farebox.sources import model_store, readers, writers
from farebox.sources.scratch import cut_lineage, scratch_path, shared_dir

HEADER = ",".join(name for name, _ in RAW_COLUMNS)
GOOD = "1,2023-01-01 00:10:00,2023-01-01 00:20:00,2,1.5,1,N,132,10,1,9.5,0,0.5,1,0,0.3,11.3,2.5"


def test_schema_has_18_nullable_fields():
    schema = trip_schema()
    assert len(schema) == 18 and all(f.nullable for f in schema)
    wide = {f.name: f.dataType for f in trip_schema(widen=True)}
    assert wide["VendorID"] == T.LongType() and wide["fare_amount"] == T.DoubleType()


LINES = [
    (HEADER, None),
    (GOOD, "good"),
    (HEADER, None),  # repeated in the middle
    (GOOD.rsplit(",", 1)[0], "field_count"),
    (GOOD + ",", "field_count"),
    ("", "field_count"),
    ("," + GOOD.split(",", 1)[1], "empty_required"),
    (GOOD.replace("2023-01-01 00:10:00", ""), "empty_required"),
    (GOOD.replace("2023-01-01 00:20:00", ""), "empty_required"),
    (GOOD.replace("9.5", "abc"), "bad_value"),
    (GOOD.replace("2023-01-01 00:10:00", "soon"), "bad_value"),
    (GOOD.replace(",N,", ',"N,'), "good"),  # quotes mean nothing
    ("1,2023-01-01 00:10:00,2023-01-01 00:20:00" + "," * 15, "good"),  # only the required fields
]


@pytest.mark.parametrize("header", [True, HEADER])
def test_validating_scan(spark, tmp_path, header):
    (tmp_path / "a.csv").write_text("\n".join(line for line, _ in LINES) + "\n")
    good, rejects = readers.read_trip_lines(spark, str(tmp_path / "*.csv"), header=header)
    assert good.schema == trip_schema()
    assert good.count() == sum(kind == "good" for _, kind in LINES)
    expected = sorted((line, kind) for line, kind in LINES if kind not in (None, "good"))
    assert sorted((r["value"], r["reject_reason"]) for r in rejects.collect()) == expected
    first = good.filter("fare_amount IS NOT NULL AND store_and_fwd_flag = 'N'").first()
    assert (first["VendorID"], first["fare_amount"], first["congestion_surcharge"]) == (1, 9.5, 2.5)
    assert first["tpep_pickup_datetime"] == datetime(2023, 1, 1, 0, 10)
    assert good.filter("fare_amount IS NULL").count() == 1


def test_each_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\n" + GOOD + "\n")
    good, _ = readers.read_trip_lines(spark, str(tmp_path))
    plan = good.filter("fare_amount > 3")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1


def test_without_a_header_no_line_is_dropped(spark, tmp_path):
    (tmp_path / "a.csv").write_text((GOOD + "\n") * 3)
    good, rejects = readers.read_trip_lines(spark, str(tmp_path))
    assert good.count() == 3 and rejects.count() == 0


def test_header_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\n" + GOOD + "\n")
    df = readers.read_trip_csv(spark, str(tmp_path))
    assert df.schema == trip_schema() and df.first()["tip_amount"] == 1.0


@pytest.fixture(scope="module")
def months(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("months"))
    frames = {
        "a": spark.createDataFrame([(1, 2, 5.0)], "VendorID int, passenger_count int, fare_amount double"),
        "b": spark.createDataFrame([(7.0, 2, 4)], "fare_amount double, passenger_count long, VendorID long"),
        "c": spark.createDataFrame([(2, 3.0, 9.0, 1.5)], "VendorID long, passenger_count double, fare_amount double, airport_fee double"),
    }
    for name, df in frames.items():
        df.write.parquet(f"{root}/{name}")
    return [f"{root}/{name}" for name in frames]


def test_months_of_different_types_are_one_table(spark, months):
    df = readers.read_trip_files(spark, months)
    assert dict(df.dtypes) == {
        "VendorID": "bigint", "passenger_count": "bigint", "fare_amount": "double", "airport_fee": "double",
    }
    got = sorted((r["VendorID"], r["passenger_count"], r["fare_amount"], r["airport_fee"]) for r in df.collect())
    assert got == [(1, 2, 5.0, None), (2, 3, 9.0, 1.5), (4, 2, 7.0, None)]


def test_months_against_a_schema(spark, months):
    df = readers.read_trip_files(spark, months, trip_schema(widen=True))
    assert df.schema == trip_schema(widen=True) and df.count() == 3


def test_equal_months_share_a_scan(spark, months):
    df = readers.read_trip_files(spark, [months[0], months[0], months[1]])
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert df.count() == 3


def test_wide_schema_reads_int_and_long_files_together(spark, months):
    schema = T.StructType([T.StructField("VendorID", T.LongType()), T.StructField("fare_amount", T.DoubleType())])
    assert readers.read_trips(spark, months[:2], schema).agg(F.sum("VendorID")).first()[0] == 5


def test_union_aligned(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, id long")
    both = readers.union_aligned(a, b)
    assert dict(both.dtypes)["id"] == "bigint" and {r["s"] for r in both.collect()} == {"x", "y"}
    with pytest.raises(ValueError):
        readers.union_aligned()
    with pytest.raises(Exception):
        readers.union_aligned(a, b.drop("s"))
    assert readers.union_aligned(a, b.drop("s"), allow_missing=True).count() == 2


def test_layer_prunes_months_and_replaces_single_ones(spark, tmp_path):
    path = str(tmp_path / "layer")
    df = spark.range(300).select("id", F.lit(2023).alias("data_year"), (F.col("id") % 3 + 1).cast("int").alias("data_month"))
    writers.write_layer(df, path, rebalance=True)
    february = readers.read_trips(spark, path, months=[(2023, 2)])
    plan = february._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [(" in plan
    assert february.count() == 100
    writers.write_layer(df.filter("data_month = 2").limit(10), path, replace_months_only=True)
    assert readers.read_trips(spark, path).count() == 210


def test_csv_and_json_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "a"), (2, None, "b")], "k int, v double, s string")
    writers.write_csv(df, str(tmp_path / "csv"))
    back = readers.read_trip_csv(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
    nested = df.select("k", F.struct("v", "s").alias("n"))
    writers.write_json(nested, str(tmp_path / "json"))
    assert spark.read.schema(nested.schema).json(str(tmp_path / "json")).filter("k = 1").first()["n"]["v"] == 2.5


def test_casts(spark):
    df = spark.createDataFrame([(1, 2.0, 10**12, "x")], "a int, b double, c long, d string")
    assert [t for _, t in widen_integers(df).dtypes] == ["bigint", "double", "bigint", "string"]
    row = narrow_ids(df, ("b", "c")).first()
    assert (row["b"], row["c"]) == (2, None)


def test_lineage_takes_the_path_from_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(datetime(2023, 2, 3),)], "tpep_pickup_datetime timestamp_ntz").write.parquet(path)
    at = datetime(2024, 1, 1)
    row = add_bronze_lineage(spark.read.parquet(path), at).first()
    assert path in row["source_file"] and row["source_file"].endswith(".parquet")
    assert (row["data_year"], row["data_month"], row["ingestion_timestamp"]) == (2023, 2, at)
    assert add_bronze_lineage(spark.read.parquet(path), source="x").first()["source_file"] == "x"


def test_projections(spark):
    df = spark.range(5).select("id", F.lit(1.0).alias("features"), F.lit(2.0).alias("fare_amount"),
                               F.lit(3).alias("pickup_hour"), F.col("id").alias("trip_distance"))
    assert select_final(df, ("id", "trip_distance")).columns == ["id", "trip_distance", "features", "fare_amount", "pickup_hour"]
    assert rename(df, {"fare_amount": "label"}).columns[2] == "label"
    assert [r["id"] for r in preview(df, ["id"], ["id"], 2).collect()] == [0, 1]
    assert preview(df, n=3).count() == 3


def test_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert cut_lineage(spark.range(7)).count() == 7


def test_unknown_or_missing_models(spark, tmp_path):
    with pytest.raises(ValueError):
        model_store.load_model(str(tmp_path), "svm")
    with pytest.raises(FileNotFoundError, match="tried"):
        model_store.load_first_model([str(tmp_path / "a"), str(tmp_path / "b")], "rf")
