"""Merged months equal one scan, and a new month reads no other."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from farebox.ml.prep import CategoryFeatures
from farebox.operators import moments
from farebox.operators.group_stats import lookup_join

SCHEMA = "id long, data_year int, data_month int, k string, x double, cents double"
VALUES = {"x": None, "cents": 100}


def drawn(n=800, seed=1, months=5):
    rng = random.Random(seed)
    return [(i, 2024 + i % 2, 1 + rng.randrange(months), rng.choice(["a", "b", "", None]),
             None if i % 13 == 0 else 1e7 + rng.gauss(0, 1), rng.randrange(90_000) / 100) for i in range(n)]


@pytest.fixture()
def store(spark, tmp_path):
    path, rows = str(tmp_path / "store"), drawn()
    df = spark.createDataFrame(rows, SCHEMA)
    for part in (df.filter("data_month <= 2"), df.filter("data_month = 3 AND id < 100"), df.filter("data_month > 3"), df.filter("data_month = 3")):
        moments.update_store(part, path, VALUES, ["k"])
    return rows, moments.read_store(spark, path), path


def test_merged_months_equal_one_scan(spark, store):
    rows, table, _ = store
    got = {(r.key, r.key_value, r.column): r for r in moments.merged(table, VALUES).collect()}
    assert len(got) == 2 * (1 + 4)
    for key, value in [("", None), ("k", "a"), ("k", ""), ("k", None)]:
        here = [r for r in rows if key == "" or r[3] == value]
        for at, column in ((4, "x"), (5, "cents")):
            values, r = [v[at] for v in here if v[at] is not None], got[key, value, column]
            assert (r["rows"], r.n) == (len(here), len(values))
            assert r["mean"] == pytest.approx(statistics.fmean(values), rel=1e-12)
            assert r["std"] == pytest.approx(statistics.stdev(values), rel=1e-7)
    cents = [round(r[5] * 100) for r in rows]
    assert got["", None, "cents"]["mean"] == sum(cents) / len(cents) / 100


def test_months_merge_the_same_in_any_cut(spark, store, tmp_path):
    rows, table, _ = store
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    moments.update_store(df, str(tmp_path / "once"), VALUES, ["k"])
    once = moments.merged(moments.read_store(spark, str(tmp_path / "once")), VALUES).filter("column = 'cents'")
    apart = moments.merged(table, VALUES).filter("column = 'cents'")
    pick = ["key", "key_value", "rows", "n", "mean"]
    assert once.select(pick).exceptAll(apart.select(pick)).count() == 0 and once.count() == apart.count()


def test_a_new_month_touches_no_other(spark, store):
    _, table, path = store
    before = {r.f: r.t for r in table.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("t")).collect()}
    new = spark.createDataFrame([(9000, 2030, 1, "a", 5.0, 1.0), (9001, 2030, 1, "z", None, 3.0)], SCHEMA)
    moments.update_store(new, path, VALUES, ["k"])
    again = moments.read_store(spark, path)
    after = {r.f: r.t for r in again.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("t")).collect()}
    assert before.items() < after.items()
    assert moments.merged(again, VALUES).filter("key_value = 'z' AND column = 'x'").first().n == 0


def test_scaler_and_group_averages_come_from_the_store(spark, store):
    rows, table, path = store
    df = spark.createDataFrame(rows, SCHEMA)
    scaler = moments.scaler_moments(table, VALUES)
    vectors = CategoryFeatures(("cents",), {"cents": scaler["cents"]}, {}).transform(df)
    values = [r.features[0] for r in vectors.collect()]
    assert statistics.fmean(values) == pytest.approx(0, abs=1e-9) and statistics.stdev(values) == pytest.approx(1)
    joined = lookup_join(df, moments.group_table(table, VALUES, "k", "string", {"cents": "avg_cents"}))
    want = df.groupBy("k").agg(F.avg("cents").alias("w"))
    assert joined.filter("k IS NULL AND avg_cents IS NOT NULL").count() == 0
    assert joined.join(want, "k").filter("abs(avg_cents - w) > 1e-9 OR avg_cents IS NULL").count() == 0
    one = moments.merged(table.filter("data_month = 3"), VALUES).filter("key = '' AND column = 'cents'").first()
    assert one.n == sum(r[2] == 3 for r in rows)


def test_a_store_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert moments.merged(moments.month_moments(empty, VALUES, ["k"]), VALUES).collect() == []
