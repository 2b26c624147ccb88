import json

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from farebox.functions.numeric import mean
from farebox.operators import evaluate
from farebox.sources.writers import write_json


@pytest.fixture(scope="module")
def preds(spark):
    rows = [(i, float(i % 50), float(i % 50) * 0.9 + (i % 3), i % 2) for i in range(500)]
    return spark.createDataFrame(rows, "rid int, label double, prediction double, seg int").cache()


@pytest.mark.parametrize("per_unit", [None, 10**6])
def test_metrics_agree_with_mllib(preds, per_unit):
    got = evaluate.regression_metrics(preds, per_unit=per_unit).first()
    for name in evaluate.METRICS:
        assert got[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(preds), rel=1e-6)


def test_missing_predictions_do_not_count(spark, preds):
    more = preds.unionByName(spark.createDataFrame([(-1, 9.0, None, 0)], preds.schema))
    assert evaluate.regression_metrics(more).first() == pytest.approx(evaluate.regression_metrics(preds).first())


def test_perfect_fit_and_constant_label(spark):
    perfect = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "label double, prediction double")
    assert tuple(evaluate.regression_metrics(perfect).first()) == (0.0, 0.0, 1.0, 0.0)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "label double, prediction double")
    row = evaluate.regression_metrics(flat).first()
    assert row["rmse"] == 1.0 and row["r2"] is None
    empty = evaluate.regression_metrics(flat.filter("label > 5")).first()
    assert empty["rmse"] is None


def test_compare_orders_by_rmse(preds):
    df = preds.withColumn("mean", F.lit(24.5))
    rows = evaluate.compare(df, "label", {"mean": "mean", "model": "prediction"}).collect()
    assert [r["model_name"] for r in rows] == ["model", "mean"]
    assert rows[1]["r2"] == pytest.approx(0.0, abs=1e-12)


def test_residuals_with_label_zero(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0), (-10.0, 5.0)], "label double, prediction double")
    rows = evaluate.with_residuals(df).collect()
    assert [r["residual"] for r in rows] == [-5.0, 5.0, -15.0]
    assert [r["percent_error"] for r in rows] == [0.0, 50.0, 150.0]
    assert evaluate.mape(df).first()["mape"] == pytest.approx(200.0 / 3)
    stats = evaluate.residual_stats(evaluate.with_residuals(df)).first()
    assert stats["mean_residual"] == pytest.approx(-5.0) and stats["mean_percent_error"] == pytest.approx(200.0 / 3)


def test_largest_label_has_its_own_bin(spark):
    df = spark.createDataFrame([(float(v), 1.0) for v in range(11)], "label double, prediction double")
    bins = {r["fare_bin"]: r["count"] for r in evaluate.error_by_range(df).collect()}
    assert bins == {i: 1 for i in range(11)}
    clamped = {r["fare_bin"]: r["count"] for r in evaluate.error_by_range(df, clamp=True).collect()}
    assert clamped == {**{i: 1 for i in range(9)}, 9: 2}


def test_equal_labels_are_one_bin(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0), (None, 1.0)], "label double, prediction double")
    rows = {r["fare_bin"]: r["count"] for r in evaluate.error_by_range(df).collect()}
    assert rows == {0: 2, None: 1}


def test_segments(preds):
    rows = evaluate.error_by_segment(preds, "seg").collect()
    assert sum(r["count"] for r in rows) == 500
    for r in rows:
        part = preds.filter(F.col("seg") == r["seg"])
        assert r["rmse"] == pytest.approx(RegressionEvaluator(metricName="rmse").evaluate(part))
        assert r["mae"] == pytest.approx(RegressionEvaluator(metricName="mae").evaluate(part))


def test_sample_and_export(preds):
    sample = evaluate.prediction_sample(preds, "rid", 40)
    assert sample.columns == ["label", "prediction", "residual", "abs_residual", "percent_error"]
    assert sample.count() == 40
    export = evaluate.prediction_export(preds, "rid", 0.2, cols=("label", "prediction", "seg"))
    assert export.columns == ["Actual_Fare", "Predicted_Fare", "seg"] and 50 < export.count() < 150


def test_report_is_one_nested_row(spark, preds, tmp_path):
    tops = spark.createDataFrame([(f"f{i}", float(i)) for i in range(12)], "feature string, importance double")
    report = evaluate.evaluation_report(preds, "m", importances=tops)
    write_json(report, str(tmp_path / "report"))
    (part,) = (tmp_path / "report").glob("*.json")
    got = json.loads(part.read_text())
    assert got["model_name"] == "m" and set(got["metrics"]) == set(evaluate.METRICS)
    assert set(got["residual_statistics"]) == {
        "mean_residual", "std_residual", "mean_abs_residual", "mean_percent_error",
    }
    assert [t["feature"] for t in got["top_features"]] == [f"f{i}" for i in range(11, 1, -1)]
    assert "top_features" not in evaluate.evaluation_report(preds, "m").columns


def test_means_in_whole_parts_do_not_overflow(spark):
    df = spark.range(300).select(F.lit(9.0e12).alias("label"), F.lit(0.0).alias("prediction"))
    got = df.agg(mean("label", 1_000_000).alias("m")).first()["m"]
    assert got == 9.0e12  # 300 values of 9e18 parts


def test_rows_without_a_label_do_not_count_as_errors(spark):
    df = spark.createDataFrame([(None, 5.0), (10.0, 5.0), (0.0, 1.0), (4.0, None)], "label double, prediction double")
    assert evaluate.mape(df).first()["mape"] == 25.0
    errors = [r["percent_error"] for r in evaluate.with_residuals(df).collect()]
    assert errors == [None, 50.0, 0.0, None]


def test_ranges_score_each_row_once(spark):
    scored = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def model(x):
        scored.add(1)
        return x + 1.0

    df = spark.range(500).select(F.col("id").cast("double").alias("label"), model(F.col("id").cast("double")).alias("prediction"))
    table = evaluate.error_by_range(df, bins=4)
    assert sum(r["count"] for r in table.collect()) == 500 and scored.value == 500
    assert [r["avg_abs_error"] for r in table.collect()] == [1.0] * 5
