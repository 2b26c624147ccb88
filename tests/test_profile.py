import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.operators import profile, quantiles, reports

RNG = np.random.default_rng(7)
SHAPES = {
    "normal": RNG.normal(0.0, 1.0, 5_000),
    "hot value": np.where(RNG.random(5_000) < 0.4, 12.5, RNG.uniform(0, 100, 5_000)),
    "outliers": np.concatenate([RNG.uniform(0, 1, 4_990), 10.0 ** np.arange(3, 13)]),
    "constant": np.full(100, 3.25),
    "two": np.array([1.0, 2.0]),
    "one": np.array([4.0]),
    "negative cents": -np.round(RNG.exponential(20.0, 3_000), 2),
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("list_rows", [0, 25, 20_000])
def test_exact_quantiles_whatever_the_passes(spark, monkeypatch, shape, list_rows):
    monkeypatch.setattr(quantiles, "LIST_ROWS", list_rows)
    monkeypatch.setattr(quantiles, "ACCURACY", 16 if list_rows == 25 else 10_000)
    values = SHAPES[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(3)
    probabilities = [0.0, 0.025, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = quantiles.exact_quantiles(df, ["x"], probabilities)["x"]
    assert got == pytest.approx(np.quantile(values, probabilities).tolist(), rel=1e-12)


def test_quantiles_of_several_columns_and_of_none(spark):
    df = spark.range(101).select(F.col("id").alias("a"), (F.col("id") * 2.0).alias("b"), F.lit(None).cast("int").alias("c"))
    got = quantiles.exact_quantiles(df, ["a", "b", "c"], [0.25, 0.5])
    assert got == {"a": [25.0, 50.0], "b": [50.0, 100.0], "c": [None, None]}


def test_quantiles_at_the_ends_of_double(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "LIST_ROWS", 0)
    values = [-1.7e308, -1.0, 0.0, 5e-324, 1e-323, 2.0, 1.7e308]
    df = spark.createDataFrame([(v,) for v in values] + [(float("nan"),)], "x double")
    got = quantiles.exact_quantiles(df, ["x"], [i / 6 for i in range(7)])["x"]
    assert got == values
    with pytest.raises(ValueError):
        quantiles.exact_quantiles(spark.createDataFrame([(float("inf"),)], "x double"), ["x"], [0.5])


def test_rank_outside_the_column(spark):
    with pytest.raises(IndexError):
        quantiles.order_statistics(spark.range(3).select(F.col("id").cast("double").alias("x")), {"x": [3]})


@pytest.mark.parametrize("quartiles", ["exact", "approx", None])
def test_summary(spark, quartiles):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    got = profile.column_summary(df, ["x"], quartiles=quartiles).first().asDict()
    assert (got["count"], got["mean"], got["stddev"], got["min"], got["max"]) == (3, 2.0, 1.0, 1.0, 3.0)
    if quartiles:
        assert got["q50"] == 2.0
    else:
        assert "q50" not in got


def test_summary_refuses_unknown_statistics(spark):
    with pytest.raises(ValueError):
        profile.column_summary(spark.range(1), ["id"], stats=("mode",))


def test_box(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 9, 50]], "x double")
    got = profile.box_stats(df, "x")
    row = got.first()
    assert (row["q1"], row["median"], row["q3"]) == (3.25, 5.5, 7.75)
    assert (row["whisker_low"], row["whisker_high"], row["outliers_high"]) == (1.0, 9.0, 1)
    assert profile.box_stats(df, "x", F.col("x") < 5).first()["n"] == 4


def test_histogram_counts_every_row(spark):
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 0.5, 9.99, 10.0, 11.0, None]], "x double")
    rows = {r["bin"]: r["count"] for r in profile.histogram(df, "x", 0, 10, 10).collect()}
    assert len(rows) == 12 and sum(rows.values()) == 6
    assert (rows[-1], rows[0], rows[9], rows[10]) == (1, 2, 2, 1)
    with pytest.raises(ValueError):
        profile.histogram(df, "x", 5, 5)


def test_correlations_leave_out_pairs_with_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5), (None, 9.0)], "a double, b double")
    got = {(r["a"], r["b"]): r["r"] for r in profile.correlations(df, ["a", "b"]).collect()}
    assert got[("a", "a")] == pytest.approx(1.0)
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1])


def test_density_counts_every_pair(spark):
    df = spark.range(100).select((F.col("id") / 4).alias("x"), F.col("id").cast("double").alias("y"))
    assert profile.density_2d(df, "x", "y").agg(F.sum("count")).first()[0] == 100


def test_top_and_best(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 1.0), ("c", 1.0), ("d", None)], "name string, rmse double")
    assert reports.best_row(df, "rmse", "name").first()["name"] == "b"
    assert reports.best_row(df, "rmse", "name", largest=True).first()["name"] == "a"
    assert [r["name"] for r in reports.top_k(df.na.drop(), "rmse", 2, tie="name").collect()] == ["a", "b"]


def test_exact_means_do_not_depend_on_the_partitioning(spark):
    df = spark.range(10_000).select((F.col("id") % 7).alias("k"), (F.col("id") * 0.01).alias("fare"))
    unit = {"fare": 100}
    first = reports.segment_report(df.repartition(3), "k", "fare", None, unit).collect()
    second = reports.segment_report(df.repartition(11), "k", "fare", None, unit).collect()
    assert first == second
    plain = {r["k"]: r["avg_fare"] for r in reports.segment_report(df, "k", "fare", None).collect()}
    assert all(r["avg_fare"] == pytest.approx(plain[r["k"]]) for r in first)


def test_a_summary_takes_its_statistics_in_the_quantiles_own_passes(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def read(x):
        seen.add(1)
        return float(x % 7)

    df = spark.range(300).select(read("id").alias("x"))
    row = profile.column_summary(df, ["x"]).first()
    assert (row["count"], row["min"], row["max"], row["q50"]) == (300, 0.0, 6.0, 3.0)
    assert seen.value == 2 * 300  # sketch and list; more rows than a list holds take one pass more
    assert profile.column_summary(df, ["x"], stats=()).columns == ["column", "q25", "q50", "q75"]
