"""Out-of-fold statistics: nothing of a row's own fold is in its features."""

import random

import pytest
from pyspark.sql import functions as F

from farebox.operators.out_of_fold import Average, Rows, fit_out_of_fold
from farebox.operators.sampling import with_fold

SCHEMA = "id long, k string, label double"
SPECS = {"k": [Average("label", "avg", 100), Average("label", "plain"), Rows("n")]}


def drawn(n=600, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(["a", "b", "c", "rare", None]) if i else "alone", None if i % 17 == 0 and i else rng.randrange(9000) / 100) for i in range(n)]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 25])
def test_features_come_from_the_other_folds(spark, broadcast_bytes):
    rows = drawn()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    fold = {r.id: r.f for r in with_fold(df, "id", 4, 42, "f").collect()}
    fitted = fit_out_of_fold(df, SPECS, "id", 4)
    out = fitted.training_features(df, broadcast_bytes, salt_cols=["id"])
    assert sorted(out.columns) == sorted([*df.columns, "avg", "plain", "n"]) and out.count() == len(rows)
    for r in out.collect():
        others = [(i, x) for i, k, x in rows if k == r.k and k is not None and fold[i] != fold[r.id]]
        labels = [x for _, x in others if x is not None]
        assert r.avg == (pytest.approx(sum(labels) / len(labels)) if labels else None)
        assert r.plain == (pytest.approx(sum(labels) / len(labels)) if labels else None)
        assert r.n == (len(others) if r.k is not None else None)
    new = spark.createDataFrame([(9001, "a", 1.0), (9002, "unseen", 1.0), (9003, None, 1.0)], SCHEMA)
    got = {r.id: r for r in fitted.features(new, broadcast_bytes).collect()}
    every = [x for _, k, x in rows if k == "a" and x is not None]
    assert got[9001].avg == pytest.approx(sum(every) / len(every)) and got[9001].n == sum(k == "a" for _, k, _ in rows)
    assert got[9002].avg is None and got[9003].n is None


def test_a_rows_own_label_never_enters_its_features(spark):
    rows = drawn(300, 2)
    before = {r.id: r.avg for r in _features(spark, rows)}
    for victim in (5, 120, 233):
        moved = [(i, k, 1e6 if i == victim else x) for i, k, x in rows]
        after = {r.id: r.avg for r in _features(spark, moved)}
        assert after[victim] == before[victim]
        assert rows[victim][1] is None or sum(after[i] != before[i] for i in after) > 10


def _features(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return fit_out_of_fold(df, SPECS, "id", 5).training_features(df).collect()


def test_one_scan_fits_all_keys(spark):
    df = spark.createDataFrame(drawn(100), SCHEMA).withColumn("j", F.col("id") % 3)
    fitted = fit_out_of_fold(df, SPECS | {"j": [Average("label", "javg", 100)]}, "id", 3)
    assert fitted.own.keys() == fitted.all.keys() == {"k", "j"}
    out = fitted.training_features(df)
    assert out.where("javg IS NULL").count() == 0 and out.count() == 100
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert fit_out_of_fold(df, SPECS, "id").training_features(df).collect() == []
