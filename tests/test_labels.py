"""Label tables, places in an order and sparse category vectors."""

import random
from collections import Counter

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from farebox.ml.prep import fit_category_features
from farebox.operators.labels import fit_labels, index_labels
from farebox.operators.ranking import with_rank


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_places_are_those_of_a_sort(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.randrange(50) if rng.random() < 0.9 else None, i) for i in range(900)]
    df = spark.createDataFrame(rows, "v int, id long").repartition(7)
    got = {r.id: r.place for r in with_rank(df, [F.col("v").desc_nulls_last(), "id"], "place", partitions).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert got == {i: at for at, (_, i) in enumerate(order)}


def test_places_of_no_rows_and_of_odd_column_names(spark):
    df = spark.createDataFrame([(2, "a")], "`a b` int, `c.d` string")
    assert with_rank(df, [F.col("`a b`")]).columns == ["a b", "c.d", "rank"]
    assert with_rank(df.limit(0), [F.col("`a b`")]).collect() == []


def drawn(n=3000, seed=3):
    rng = random.Random(seed)
    labels = [f"w{rng.randrange(700)}" if rng.random() > 1 / 3 else "hot" for _ in range(n)]
    return [(i, None if i % 50 == 0 else label, i % 7, float(i % 11)) for i, label in enumerate(labels)]


SCHEMA = "id long, label string, k int, x double"


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 25])
def test_index_equals_that_of_mllib(spark, broadcast_bytes):
    df = spark.createDataFrame(drawn(), SCHEMA).repartition(5)
    train = df.filter("id < 2000")
    labels = fit_labels(train, ["label", "k"])
    for col, known in labels.items():
        got = index_labels(df, known, "n", broadcast_bytes, salt_cols=["id"])
        want = StringIndexer(inputCol=col, outputCol="m", handleInvalid="keep", stringOrderType="frequencyDesc").fit(train)
        assert got.columns == [*df.columns, "n"]
        assert want.transform(got).filter("n <> m").count() == 0 and got.count() == 3000
    assert labels["k"].count == 7


def test_a_hot_label_is_spread_and_no_label_is_listed(spark):
    df = spark.createDataFrame(drawn(), SCHEMA)
    joined = index_labels(df, fit_labels(df, ["label"])["label"], "n", broadcast_bytes=0, salt_cols=["id"])
    sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 2 * 3000 / len(sizes) + 300
    assert "w1" not in str(joined.schema.json())


def test_sparse_vectors_hold_each_label_in_its_slot(spark):
    rows = drawn()
    df = spark.createDataFrame(rows, SCHEMA)
    fitted = fit_category_features(df.filter("id < 1000"), ["label", "k"], ["x"])
    seen = Counter(r[1] for r in rows[:1000] if r[1] is not None)
    order = sorted(seen, key=lambda c: (-seen[c], c))
    out = fitted.transform(df)
    assert out.columns == [*df.columns, "features"] and fitted.size == 1 + len(order) + 1 + 7 + 1
    mean, std = fitted.moments["x"]
    for r in out.collect():
        scaled, slots = r.features.toArray()[0], r.features.indices.tolist()
        assert scaled == pytest.approx((r.x - mean) / std) and slots[0] == 0 and r.features.size == fitted.size
        assert slots[1] == 1 + (order.index(r.label) if r.label in seen else len(order))
        assert slots[2] >= 2 + len(order) and r.features.values[1:].tolist() == [1.0, 1.0]
    model = LinearRegression(labelCol="k", solver="l-bfgs", maxIter=2).fit(out)
    assert model.numFeatures == fitted.size


def test_constants_nulls_and_existing_columns(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 1.0, 2.0)], "c string, x double, y double")
    assert [r.features.toArray().tolist() for r in fit_category_features(df, ["c"], ["x"]).transform(df).orderBy("c").collect()] == [
        [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]]
    with pytest.raises(Exception, match="null in y"):
        fit_category_features(df, [], ["y"]).transform(df).collect()
    with pytest.raises(ValueError, match="exists"):
        index_labels(df, fit_labels(df, ["c"])["c"], "x")
    empty = fit_labels(df.limit(0), ["c"])["c"]
    assert empty.count == 0 and {r.n for r in index_labels(df, empty, "n").collect()} == {0.0}
