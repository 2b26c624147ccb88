import pytest
from pyspark.sql import functions as F

from farebox.operators.group_stats import aggregated_features, fit_group_stats, lookup_join


@pytest.fixture(scope="module")
def train(spark):
    rows = [(1, 10.0)] * 500 + [(2, 4.0), (2, 6.0), (3, 7.0), (None, 100.0), (None, 200.0)]
    return spark.createDataFrame(rows, "key int, x double").repartition(3)


def specs():
    return {"key": [F.avg("x").alias("avg_x"), F.count(F.lit(1)).alias("n")]}


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_null_and_unseen_keys_get_null_statistics(spark, train, broadcast_bytes):
    table = fit_group_stats(train, specs())["key"]
    assert table.groups == 4 and table.trained_rows == 505
    assert 0 < table.size_bytes < 1_000
    probe = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (9, "d"), (None, "e")], "key int, tag string")
    joined = lookup_join(probe, table, broadcast_bytes)
    assert joined.columns == ["key", "tag", "avg_x", "n"]
    got = {r["tag"]: (r["avg_x"], r["n"]) for r in joined.collect()}
    assert got == {"a": (10.0, 500), "b": (5.0, 2), "c": (7.0, 1), "d": (None, None), "e": (None, None)}


def test_both_join_ways_give_the_same_rows(train):
    table = fit_group_stats(train, specs())["key"]
    small = lookup_join(train, table).exceptAll(lookup_join(train, table, broadcast_bytes=0))
    large = lookup_join(train, table, broadcast_bytes=0).exceptAll(lookup_join(train, table))
    assert small.count() == large.count() == 0
    assert lookup_join(train, table, broadcast_bytes=0).count() == train.count()


def test_hot_and_null_rows_are_spread_over_tasks(spark):
    df = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id").cast("int")).alias("key"),
        F.col("id").cast("double").alias("x"),
    )
    table = fit_group_stats(df, specs())["key"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(df, table, broadcast_bytes=0)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 40_000
    assert max(sizes) < 1.3 * 40_000 / len(sizes) and len(sizes) == 4


def test_statistics_of_several_keys_in_one_scan(spark):
    rows = [(1, 7, 1, 10.0, 2.0, 1.0, 10.0), (2, 7, 2, 20.0, 4.0, 0.0, 0.0), (2, 8, 1, 30.0, 6.0, 3.0, 10.0)]
    df = spark.createDataFrame(
        rows,
        "VendorID int, pickup_hour int, payment_type int, fare_amount double, trip_distance double, "
        "tip_amount double, tip_percentage double",
    )
    got = {(r["VendorID"], r["pickup_hour"]): r for r in aggregated_features(df).collect()}
    assert got[(2, 8)]["vendor_avg_fare"] == 25.0
    assert got[(1, 7)]["hour_avg_fare"] == 15.0 and got[(1, 7)]["hour_trip_count"] == 2
    assert got[(2, 7)]["payment_avg_tip_pct"] == 0.0 and got[(1, 7)]["payment_avg_tip_pct"] == 10.0


def test_text_statistics_count_with_their_bytes(spark):
    df = spark.range(400).select((F.col("id") % 200).alias("key"), F.repeat(F.lit("x"), 4000).alias("text"))
    table = fit_group_stats(df, {"key": [F.max("text").alias("longest"), F.collect_set("text").alias("all")]})["key"]
    assert table.size_bytes > 2 * 200 * 4000
    plan = lookup_join(df, table, broadcast_bytes=1_000_000)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan  # the few hot keys
    small = lookup_join(df, table, broadcast_bytes=10_000_000)
    assert small.exceptAll(lookup_join(df, table, broadcast_bytes=0)).count() == 0


def test_a_key_that_is_hot_in_the_joined_table_alone_is_spread(spark):
    train = spark.range(2_000).select((F.col("id") % 500).cast("int").alias("key"), F.col("id").cast("double").alias("x"))
    table = fit_group_stats(train, specs())["key"]
    df = spark.range(40_000).select(F.when(F.col("id") % 10 > 0, -1).otherwise(F.col("id").cast("int")).alias("key"), "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["count"] for r in lookup_join(df, table, broadcast_bytes=0).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 40_000 and max(sizes) < 1.5 * 40_000 / len(sizes)


def test_long_statistics_of_hot_keys_are_not_broadcast(spark, monkeypatch):
    from farebox.operators import group_stats

    df = spark.range(400).selectExpr("id", "if(id % 3 = 0, 0, id) AS k")
    table = fit_group_stats(df, {"k": [F.max(F.repeat(F.lit("x"), 500)).alias("text")]})["k"]
    want = sorted(tuple(r) for r in lookup_join(df, table).collect())
    assert sorted(tuple(r) for r in lookup_join(df, table, broadcast_bytes=0).collect()) == want
    monkeypatch.setattr(group_stats, "BROADCAST_BYTES", 100)
    joined = lookup_join(df, table, broadcast_bytes=0)
    assert joined.columns == ["k", "id", "text"] and sorted(tuple(r) for r in joined.collect()) == want
    assert "_hot" not in joined._jdf.queryExecution().toString()
