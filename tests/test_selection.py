"""Large selections without a sorting task, and membership in tables of any size."""

import math
import random

import pytest
from pyspark.sql import functions as F

from farebox.operators import membership, sampling, selection
from farebox.operators.membership import with_membership
from farebox.operators.reports import top_k
from farebox.operators.selection import first_n


def drawn(seed, n=1500):
    rng = random.Random(seed)
    kinds = (lambda: None, lambda: math.nan, lambda: 7.0, lambda: rng.gauss(0, 1), lambda: float(rng.randrange(5)), lambda: -math.inf)
    weights = (2, 1, 4, 8, 3, 1) if seed % 2 else (0, 0, 30, 1, 0, 0)
    return [(i, rng.choices(kinds, weights)[0]()) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("desc", [False, True])
def test_the_same_rows_as_a_sort(spark, monkeypatch, seed, desc):
    df = spark.createDataFrame(drawn(seed), "id long, v double").repartition(6).cache()
    order = [F.col("v").desc() if desc else F.col("v").asc(), "id"]
    ids = [r.id for r in df.orderBy(*order).collect()]
    monkeypatch.setattr(selection, "SORT_ROWS", 0)
    for n in (1, 40, 320, 760, 1499, 1500, 4000):
        assert sorted(r.id for r in first_n(df, "v", n, desc, ["id"], 5).collect()) == sorted(ids[:n])


def test_no_rows_and_no_limit(spark, monkeypatch):
    monkeypatch.setattr(selection, "SORT_ROWS", -1)
    df = spark.createDataFrame([(1, 2.0)], "id long, v double")
    assert first_n(df, "v", 0).collect() == [] and first_n(df.limit(0), "v", 5).collect() == []
    assert first_n(df, F.col("v") * 2, 5, ties=["id"]).columns == ["id", "v"]


def test_only_rows_around_the_cut_are_ranked(spark, monkeypatch):
    seen, ranked = [], selection.with_rank
    monkeypatch.setattr(selection, "SORT_ROWS", 0)
    monkeypatch.setattr(selection, "with_rank", lambda df, *a: (seen.append(df.count()), ranked(df, *a))[1])
    df = spark.range(60_000).select("id", F.xxhash64("id").cast("double").alias("v"))
    out = first_n(df, "v", 20_000, ties=["id"])
    assert out.count() == 20_000 and seen[0] < 600
    assert out.agg(F.max("v")).first()[0] == df.orderBy("v").limit(20_000).agg(F.max("v")).first()[0]


def test_large_samples_and_tops_use_it(spark, monkeypatch):
    df = spark.range(3000).select("id", (F.col("id") * 37 % 1000).alias("v"))
    small = sorted(r.id for r in sampling.sample_n(df, "id", 1000).collect())
    top = sorted(r.id for r in top_k(df, "v", 1000, tie="id").collect())
    for module in (sampling, selection):
        monkeypatch.setattr(module, "SORT_ROWS", 10)
    monkeypatch.setattr("farebox.operators.reports.SORT_ROWS", 10)
    assert sorted(r.id for r in sampling.sample_n(df, "id", 1000).collect()) == small and len(small) == 1000
    assert sorted(r.id for r in top_k(df, "v", 1000, tie="id").collect()) == top
    plan = sampling.sample_n(df, "id", 1000)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan


@pytest.mark.parametrize("literals, broadcast_bytes", [(10_000, 1 << 25), (0, 1 << 25), (0, 0)])
@pytest.mark.parametrize("null_in_table", [False, True])
def test_membership_is_that_of_isin(spark, literals, broadcast_bytes, null_in_table):
    rng = random.Random(3)
    rows = [(i, None if i % 40 == 0 else ("hot" if i % 3 == 0 else f"k{rng.randrange(900)}")) for i in range(3000)]
    listed = [f"k{i}" for i in range(0, 900, 2)] + ["hot", "hot", "k2"] + ([None] if null_in_table else [])
    df = spark.createDataFrame(rows, "id long, k string").repartition(4)
    table = spark.createDataFrame([(v,) for v in listed], "z string")
    out = with_membership(df, "k", table, "z", "found", literals, broadcast_bytes, ["id"])
    assert out.columns == ["id", "k", "found"]
    want = {r.id: r.w for r in df.select("id", F.col("k").isin(listed).alias("w")).collect()}
    assert {r.id: r.found for r in out.collect()} == want


def test_membership_of_a_large_table_moves_few_rows(spark):
    df = spark.range(40_000).select("id", (F.col("id") * 7919 % 100_003).alias("k"))
    table = spark.range(0, 100_003, 50).select(F.col("id").alias("z"))
    asked, joined = [], membership.lookup_join
    membership.lookup_join = lambda rows, *a, **k: (asked.append(rows.count()), joined(rows, *a, **k))[1]
    try:
        out = with_membership(df, "k", table, "z", "found", 0, 0, ["id"])
    finally:
        membership.lookup_join = joined
    hits = out.filter("found").count()
    assert hits == df.filter("k % 50 = 0").count() and hits <= asked[0] < 6 * hits
    assert out.count() == 40_000


def test_membership_in_nothing(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "id long, k long")
    table = spark.createDataFrame([], "z int")
    for literals in (10, -1):
        got = {r.id: r.f for r in with_membership(df, "k", table, "z", "f", literals).collect()}
        assert got == {1: False, 2: None}
