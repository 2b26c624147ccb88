"""Wide correlations against one expression per pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.operators import comoments
from farebox.operators.comoments import wide_correlations
from farebox.sources.scratch import cut_lineage


@pytest.mark.parametrize("columns, block", [(7, 3), (10, 64), (1, 2)])
def test_equals_corr(spark, columns, block):
    rng = np.random.default_rng(columns)
    data = rng.standard_normal((400, columns)) + 1e6
    data[:, -1] = data[:, 0] * -2 + 5
    rows = [[None if rng.random() < 0.2 else float(x) for x in row] for row in data]
    rows[3] = [float("nan")] * columns
    names = [f"c {i}" for i in range(columns)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(5)
    got = {(r.a, r.b): r for r in wide_correlations(df, names, 2, block).collect()}
    assert len(got) == columns**2
    clean = df.select(*[F.nanvl(F.col(f"`{n}`"), F.lit(None)).alias(n) for n in names])
    for a in names:
        for b in names:
            both = clean.filter(F.col(f"`{a}`").isNotNull() & F.col(f"`{b}`").isNotNull())
            if a <= b:
                want = both.agg(F.count(F.lit(1)).alias("n"), F.corr(f"`{a}`", f"`{b}`").alias("r")).first()
                assert got[a, b].n == want.n and got[a, b].r == pytest.approx(want.r, abs=1e-7) and got[b, a].r == got[a, b].r


def test_two_hundred_columns_in_one_pass(spark):
    rng = np.random.default_rng(0)
    mixed = rng.standard_normal((300, 200)) @ rng.standard_normal((200, 200))
    df = spark.createDataFrame(mixed.tolist(), ", ".join(f"c{i} double" for i in range(200))).repartition(6)
    got = np.zeros((200, 200))
    for r in wide_correlations(df, df.columns).collect():
        got[int(r.a[1:]), int(r.b[1:])] = r.r
    assert np.abs(got - np.corrcoef(mixed.T)).max() < 1e-9


def test_states_do_not_grow_with_rows(spark):
    sizes = []
    for rows in (100, 5000):
        df = spark.range(rows).select(*[(F.col("id") * (i + 1) % 97).cast("double").alias(f"c{i}") for i in range(5)]).coalesce(1)
        state = df.mapInArrow(comoments._gathered(5, [0.0] * 5), comoments._STATE)
        sizes.append(state.agg(F.sum(F.octet_length("state"))).first()[0])
    assert sizes[0] == sizes[1] == 6 * 5 * 5 * 8


def test_constants_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (1.0, 3.0, None), (1.0, 4.0, 5.0)], "a double, b double, c double")
    got = {(r.a, r.b): (r.n, r.r) for r in wide_correlations(df, ["a", "b", "c"]).collect()}
    assert got["b", "b"] == (3, 1.0) and got["a", "b"] == (3, None) and got["b", "c"] == (1, None) and got["a", "c"] == (1, None)
    empty = wide_correlations(df.limit(0), ["a", "b"]).collect()
    assert {(r.n, r.r) for r in empty} <= {(0, None)}


def test_many_computed_columns_run_as_compiled_methods(spark, monkeypatch):
    """Whole-stage code over HotSpot's limit of a compiled method is off while the sums are made, and only then."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    before, seen = spark.conf.get(limit), []

    def written(df):
        seen.append(int(spark.conf.get(limit)))
        return cut_lineage(df)

    monkeypatch.setattr(comoments, "cut_lineage", written, raising=False)
    wide = spark.range(50).selectExpr(*[f"CAST((id * {i + 3}) % 7 AS DOUBLE) AS c{i}" for i in range(30)])
    assert comoments.wide_correlations(wide, wide.columns).count() == 900
    assert seen == [8000] and spark.conf.get(limit) == before
