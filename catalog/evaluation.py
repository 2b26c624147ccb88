"""Metrics, residuals and exports on fixed-formula predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.trips import SCORED_SQL, mean_sql, scored_trips, uniform_sql
from farebox.operators import evaluate
from farebox.operators.sampling import hash_split

# predictions are no whole cents; millionths are fine enough to compare exactly
MICRO = 1_000_000
MODELS = {"line": "prediction", "flat": "prediction_flat"}


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _metrics_sql(prediction: str, name: str | None = None, table: str = "scored") -> str:
    err = f"(label - {prediction})"
    lead = f"'{name}' AS model_name, " if name else ""
    return f"""SELECT {lead}round(sqrt(avg({err} * {err})), 6) AS rmse, {mean_sql(f'abs({err})', MICRO)} AS mae,
  round(1e0 - sum({err} * {err}) / (var_pop(label) * count(*)), 6) AS r2, round(avg({err} * {err}), 6) AS mse
  FROM {table}"""


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = evaluate.regression_metrics(scored_trips(spark, sf_dir), per_unit=MICRO)
    return _rounded(table, "rmse", "r2", "mse")


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both models measured in one pass."""
    return _rounded(evaluate.compare(scored_trips(spark, sf_dir), "label", MODELS, per_unit=MICRO), "rmse", "r2", "mse")


COMPARE_SQL = f"WITH {SCORED_SQL} " + " UNION ALL ".join(_metrics_sql(c, n) for n, c in MODELS.items())


def test_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics on the test side of the split."""
    _, test = hash_split(scored_trips(spark, sf_dir), "trip_id", method="md5")
    return _rounded(evaluate.regression_metrics(test, per_unit=MICRO), "rmse", "r2", "mse")


TEST_SQL = f"""WITH {SCORED_SQL}, test AS (SELECT * FROM scored WHERE {uniform_sql('trip_id')} >= 0.8e0)
{_metrics_sql('prediction', table='test')}"""


def residual_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.with_residuals(scored_trips(spark, sf_dir)).select(
        "trip_id", "residual", "abs_residual", "percent_error"
    )


_RESIDUALS = """label - prediction AS residual, abs(label - prediction) AS abs_residual,
  CASE WHEN label <> 0 THEN abs(label - prediction) / abs(label) * 100e0 ELSE 0e0 END AS percent_error"""
RESIDUAL_SQL = f"WITH {SCORED_SQL} SELECT trip_id, {_RESIDUALS} FROM scored"


def residual_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluate.with_residuals(scored_trips(spark, sf_dir))
    return _rounded(evaluate.residual_stats(rows, per_unit=MICRO), "std_residual")


STATS_SQL = f"""WITH {SCORED_SQL}, r AS (SELECT {_RESIDUALS} FROM scored)
SELECT {mean_sql('residual', MICRO)} AS mean_residual, round(stddev_samp(residual), 6) AS std_residual,
  {mean_sql('abs_residual', MICRO)} AS mean_abs_residual, {mean_sql('percent_error', MICRO)} AS mean_percent_error
FROM r"""


def mape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.mape(scored_trips(spark, sf_dir), per_unit=MICRO)


MAPE_SQL = f"""WITH {SCORED_SQL}, a AS (
  SELECT CASE WHEN label <> 0 THEN abs((label - prediction) / label) * 100e0 ELSE 0e0 END AS ape FROM scored)
SELECT {mean_sql('ape', MICRO)} AS mape FROM a"""


def _some_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_trips(spark, sf_dir).withColumn("label", F.expr("CASE WHEN trip_id % 17 = 0 THEN NULL ELSE label END"))


def mape_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentage errors where some rows have no label: those rows do not count."""
    rows = _some_unlabelled(spark, sf_dir)
    stats = evaluate.residual_stats(evaluate.with_residuals(rows), per_unit=MICRO)
    names = ("mean_residual", "mean_abs_residual", "mean_percent_error")
    return evaluate.mape(rows, per_unit=MICRO).select("mape", *[stats.select(n).scalar().alias(n) for n in names])


UNLABELLED_SQL = f"""WITH {SCORED_SQL}, r AS (SELECT {_RESIDUALS} FROM scored WHERE trip_id % 17 <> 0)
SELECT {mean_sql('percent_error', MICRO)} AS mape, {mean_sql('residual', MICRO)} AS mean_residual,
  {mean_sql('abs_residual', MICRO)} AS mean_abs_residual, {mean_sql('percent_error', MICRO)} AS mean_percent_error FROM r"""


def _range_sql(clamp: bool) -> str:
    number = "CAST(floor((label - lo) / width) AS BIGINT)"
    if clamp:
        number = f"least({number}, 9)"
    return f"""WITH {SCORED_SQL}, e AS (SELECT min(label) AS lo, (max(label) - min(label)) / 10e0 AS width FROM scored)
SELECT {number} AS fare_bin, count(*) AS count, {mean_sql('label', MICRO)} AS avg_actual,
  {mean_sql('prediction', MICRO)} AS avg_predicted, {mean_sql('abs(label - prediction)', MICRO)} AS avg_abs_error
FROM scored, e GROUP BY 1"""


def error_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.error_by_range(scored_trips(spark, sf_dir), per_unit=MICRO)


def error_by_range_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.error_by_range(scored_trips(spark, sf_dir), clamp=True, per_unit=MICRO)


def _segment(key: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return evaluate.error_by_segment(scored_trips(spark, sf_dir), key, per_unit=MICRO)

    return query


def _segment_sql(key: str) -> str:
    mse = mean_sql("(label - prediction) * (label - prediction)", MICRO)
    return f"""WITH {SCORED_SQL} SELECT {key}, count(*) AS count, {mean_sql('label', MICRO)} AS avg_actual,
  {mean_sql('prediction', MICRO)} AS avg_predicted, {mean_sql('abs(label - prediction)', MICRO)} AS mae,
  {mse} AS mse, sqrt({mse}) AS rmse FROM scored GROUP BY {key}"""


def prediction_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.prediction_sample(scored_trips(spark, sf_dir), "trip_id", 1000, method="md5")


SAMPLE_SQL = f"""WITH {SCORED_SQL}, picked AS (
  SELECT * FROM scored ORDER BY {uniform_sql('trip_id', 'sample')}, trip_id LIMIT 1000)
SELECT label, prediction, {_RESIDUALS} FROM picked"""


def prediction_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundredth of the test rows under export names."""
    _, test = hash_split(scored_trips(spark, sf_dir), "trip_id", method="md5")
    return evaluate.prediction_export(test, "trip_id", 0.01, method="md5")


EXPORT_SQL = f"""WITH {SCORED_SQL} SELECT label AS "Actual_Fare", prediction AS "Predicted_Fare", trip_distance,
  passenger_count, pickup_hour, is_rush_hour, is_weekend, is_airport_trip, VendorID FROM scored
WHERE {uniform_sql('trip_id')} >= 0.8e0 AND {uniform_sql('trip_id', 'sample')} < 0.01e0"""


def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested evaluation report, flattened for comparison."""
    report = evaluate.evaluation_report(scored_trips(spark, sf_dir), "line")
    flat = report.select("model_name", "metrics.*", "residual_statistics.*")
    return _rounded(flat, *[c for c in flat.columns if c != "model_name"])


REPORT_SQL = f"""WITH {SCORED_SQL}, r AS (SELECT label, {_RESIDUALS} FROM scored)
SELECT 'line' AS model_name, round(sqrt(avg(residual * residual)), 6) AS rmse, round(avg(abs_residual), 6) AS mae,
  round(1e0 - sum(residual * residual) / (var_pop(label) * count(*)), 6) AS r2,
  round(avg(residual * residual), 6) AS mse, round(avg(residual), 6) AS mean_residual,
  round(stddev_samp(residual), 6) AS std_residual, round(avg(abs_residual), 6) AS mean_abs_residual,
  round(avg(percent_error), 6) AS mean_percent_error FROM r"""

QUERIES = {
    "regression_metrics": (regression_metrics, f"WITH {SCORED_SQL} {_metrics_sql('prediction')}"),
    "model_comparison": (model_comparison, COMPARE_SQL),
    "test_metrics": (test_metrics, TEST_SQL),
    "residual_columns": (residual_columns, RESIDUAL_SQL),
    "residual_stats": (residual_stats, STATS_SQL),
    "mape": (mape, MAPE_SQL),
    "mape_unlabelled": (mape_unlabelled, UNLABELLED_SQL),
    "error_by_range": (error_by_range, _range_sql(clamp=False)),
    "error_by_range_clamped": (error_by_range_clamped, _range_sql(clamp=True)),
    "error_by_segment": (_segment("is_rush_hour"), _segment_sql("is_rush_hour")),
    "error_by_zone": (_segment("PULocationID"), _segment_sql("PULocationID")),
    "prediction_sample": (prediction_sample, SAMPLE_SQL),
    "prediction_export": (prediction_export, EXPORT_SQL),
    "report_json": (report_json, REPORT_SQL),
}
