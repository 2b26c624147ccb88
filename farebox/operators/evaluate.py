"""Regression metrics, residual analysis, reports and exports of scored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions.numeric import mean
from farebox.operators.columns import rename
from farebox.operators.reports import top_k
from farebox.operators.sampling import hash_sample, sample_n
from farebox.schema import EXPORT_COLS
from farebox.sources.scratch import cut_lineage

METRICS = ("rmse", "mae", "r2", "mse")

# Names of the exported label and prediction.
EXPORT_NAMES = {"label": "Actual_Fare", "prediction": "Predicted_Fare"}


def _metric_struct(label: str, prediction: str, per_unit: int | None) -> Column:
    """Error moments of one prediction column; rows without label or prediction do not count."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - p
    actual = F.when(error.isNotNull(), y)
    return F.struct(
        F.count(error).alias("n"),
        F.sum(error * error).alias("sse"),
        mean(F.abs(error), per_unit).alias("mae"),
        F.var_pop(actual).alias("var"),
    )


def _finished(moments: Column) -> list[Column]:
    mse = F.try_divide(moments["sse"], moments["n"].cast("double"))
    total = moments["var"] * moments["n"]
    return [
        F.sqrt(mse).alias("rmse"),
        moments["mae"].alias("mae"),
        (F.lit(1.0) - F.try_divide(moments["sse"], total)).alias("r2"),
        mse.alias("mse"),
    ]


def compare(
    df: DataFrame, label: str, predictions: Mapping[str, str], per_unit: int | None = None
) -> DataFrame:
    """rmse, mae, r2 and mse of several prediction columns, best rmse first.

    ``predictions`` maps a model name to its column. All models are measured in one pass over
    the rows; only the single row of sums is turned into one row per model.
    """
    moments = df.agg(
        *[_metric_struct(label, col, per_unit).alias(f"_m{i}") for i, col in enumerate(predictions.values())]
    )
    structs = [
        F.struct(F.lit(name).alias("model_name"), *_finished(F.col(f"_m{i}")))
        for i, name in enumerate(predictions)
    ]
    return moments.select(F.inline(F.array(*structs))).orderBy("rmse", "model_name")


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", per_unit: int | None = None
) -> DataFrame:
    """One row: rmse, mae, r2, mse, from one aggregation."""
    return compare(df, label, {"": prediction}, per_unit).drop("model_name")


def with_residuals(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Add residual, abs_residual and percent_error (0.0 where the label is 0).

    All three are null where the label or the prediction is.
    """
    residual = F.col(label) - F.col(prediction)
    return df.withColumns(
        {
            "residual": residual,
            "abs_residual": F.abs(residual),
            "percent_error": _percent(F.col(label), F.col(prediction)),
        }
    )


def _percent(y: Column, p: Column) -> Column:
    """Absolute error in percent of the label; 0.0 for a label of 0, null without label or prediction."""
    return F.when((y == 0) & p.isNotNull(), F.lit(0.0)).when(y.isNotNull(), F.abs(y - p) / F.abs(y) * F.lit(100.0))


def residual_stats(df: DataFrame, per_unit: int | None = None) -> DataFrame:
    """Mean and spread of the columns ``with_residuals`` adds, as one row."""
    return df.agg(
        mean("residual", per_unit).alias("mean_residual"),
        F.stddev("residual").alias("std_residual"),
        mean("abs_residual", per_unit).alias("mean_abs_residual"),
        mean("percent_error", per_unit).alias("mean_percent_error"),
    )


def mape(
    df: DataFrame, label: str = "label", prediction: str = "prediction", per_unit: int | None = None
) -> DataFrame:
    """Mean absolute percentage error as one row; a label of 0 counts as no error.

    Rows without label or prediction do not count, as in the other metrics.
    """
    return df.agg(mean(_percent(F.col(label), F.col(prediction)), per_unit).alias("mape"))


def error_by_range(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    bins: int = 10,
    clamp: bool = False,
    per_unit: int | None = None,
) -> DataFrame:
    """Error per equal-width label range, ordered.

    The largest label falls into a bin of its own, number ``bins``; ``clamp`` counts it in the
    last regular bin. When all labels are equal there is one bin, 0. The extent of the labels must be
    known before the bins, so labels and predictions are written once, two numbers a row, and read
    from there; what makes the predictions runs once.
    """
    df = cut_lineage(df.select(F.col(label).alias("_y"), F.col(prediction).alias("_p")))
    y, p = F.col("_y"), F.col("_p")
    low, high = F.min(y).cast("double"), F.max(y).cast("double")
    extent = df.agg(F.struct(low.alias("lo"), ((high - low) / F.lit(float(bins))).alias("width")).alias("e")).scalar()
    number = F.when(
        extent["width"] > 0, F.floor((y.cast("double") - extent["lo"]) / extent["width"])
    ).when(y.isNotNull(), F.lit(0).cast("bigint"))
    if clamp:
        number = F.when(number.isNotNull(), F.least(number, F.lit(bins - 1).cast("bigint")))
    return (
        df.select(number.alias("fare_bin"), y, p)
        .groupBy("fare_bin")
        .agg(
            F.count(F.lit(1)).alias("count"),
            mean("_y", per_unit).alias("avg_actual"),
            mean("_p", per_unit).alias("avg_predicted"),
            mean(F.abs(F.col("_y") - F.col("_p")), per_unit).alias("avg_abs_error"),
        )
        .orderBy("fare_bin")
    )


def error_by_segment(
    df: DataFrame,
    key: str,
    label: str = "label",
    prediction: str = "prediction",
    per_unit: int | None = None,
) -> DataFrame:
    """Count, average label and prediction, mae, mse and rmse per value of ``key``."""
    error = F.col(label) - F.col(prediction)
    mse = mean(error * error, per_unit)
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("count"),
        mean(label, per_unit).alias("avg_actual"),
        mean(prediction, per_unit).alias("avg_predicted"),
        mean(F.abs(error), per_unit).alias("mae"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
    )


def prediction_sample(
    df: DataFrame,
    id_col: str | Sequence[str],
    n: int = 1000,
    label: str = "label",
    prediction: str = "prediction",
    seed: int = 42,
    method: str = "xxhash64",
) -> DataFrame:
    """n scored rows with their residual columns, chosen by id hash."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    chosen = sample_n(df.select(*ids, label, prediction), ids, n, seed, method)
    return with_residuals(chosen, label, prediction).select(
        label, prediction, "residual", "abs_residual", "percent_error"
    )


def prediction_export(
    df: DataFrame,
    id_col: str | Sequence[str],
    fraction: float = 0.01,
    cols: Sequence[str] = EXPORT_COLS,
    seed: int = 42,
    method: str = "xxhash64",
) -> DataFrame:
    """A hash sample of scored rows under export names.

    Pass only test rows for honest errors; keep a ``split`` column in ``cols`` to export both.
    """
    return rename(hash_sample(df, id_col, fraction, seed, method).select(*cols), EXPORT_NAMES)


def evaluation_report(
    df: DataFrame,
    model_name: str,
    label: str = "label",
    prediction: str = "prediction",
    importances: DataFrame | None = None,
    top: int = 10,
) -> DataFrame:
    """One nested row: model_name, metrics, residual_statistics and, for trees, top_features.

    Metrics and residual statistics come from one pass over the scored rows.
    """
    scored = with_residuals(df.select(label, prediction), label, prediction)
    sums = scored.agg(
        _metric_struct(label, prediction, None).alias("_m"),
        F.struct(
            F.avg("residual").alias("mean_residual"),
            F.stddev("residual").alias("std_residual"),
            F.avg("abs_residual").alias("mean_abs_residual"),
            F.avg("percent_error").alias("mean_percent_error"),
        ).alias("residual_statistics"),
    )
    report = sums.select(
        F.lit(model_name).alias("model_name"),
        F.struct(*_finished(F.col("_m"))).alias("metrics"),
        "residual_statistics",
    )
    if importances is None:
        return report
    # an array of at most ``top`` structs, ordered by importance
    leaders = top_k(importances, "importance", top, tie="feature").agg(
        F.reverse(F.sort_array(F.collect_list(F.struct("importance", "feature")))).alias("top")
    )
    return report.withColumn("top_features", leaders.scalar())
