"""Model plans over a gold table: fit and compare, and tune, check and export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.ml import Model
from pyspark.sql import DataFrame

from farebox.ml import models, stability, tuning
from farebox.operators import bootstrap, evaluate
from farebox.operators.reports import segment_report
from farebox.operators.sampling import hash_split
from farebox.operators.scaling import persisted, spread
from farebox.schema import EXPORT_COLS
from farebox.sources.model_store import save_model
from farebox.sources.writers import write_csv


#: Partitions that a plan deals its rows to, for each core.
TASKS_PER_CORE = 3


def _dealt(rows: DataFrame, ids: Sequence[str]) -> DataFrame:
    """The rows spread evenly over all cores, by id and in its order, which repeats on every run.

    A month of a layer is few files of one row group each, and so few tasks, however long fits and
    resamples work on its rows.
    """
    partitions = TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism
    return spread(rows, partitions, *ids).sortWithinPartitions(*ids)


class Trained(NamedTuple):
    models: dict[str, Model]
    comparison: DataFrame


def train_compare_save(
    gold: DataFrame,
    out: str,
    id_col: str | Sequence[str],
    settings: Mapping[str, Mapping[str, object]] | None = None,
    method: str = "xxhash64",
) -> Trained:
    """Fit regressors on the training side of the hash split of ``gold``, measure all of them on the test
    side in one pass, and save models and comparison.

    ``settings`` maps kinds to their parameters (default: all five, ``models.LIGHT``). Models go to
    ``out``/models/<kind>, the comparison as CSV to ``out``/model_comparison.
    """
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    train, test = (_dealt(side.select(*ids, "features", "label"), ids) for side in hash_split(gold, ids, method=method))
    with persisted(train.select("features", "label")) as rows:
        fitted = {k: models.fit(k, rows, **p).model for k, p in (settings or models.LIGHT).items()}
    for kind, model in fitted.items():
        save_model(model, f"{out}/models/{kind}")
    write_csv(models.compare_models(fitted, test).coalesce(1), f"{out}/model_comparison")
    stored = gold.sparkSession.read.csv(
        f"{out}/model_comparison", header=True, schema="model_name string, rmse double, mae double, r2 double, mse double"
    )
    return Trained(fitted, stored)


class Checked(NamedTuple):
    model: Model
    tuning: DataFrame
    stability: DataFrame
    interval: DataFrame


def tune_check_export(
    gold: DataFrame,
    out: str,
    id_col: str | Sequence[str],
    kind: str = "rf",
    grid: Mapping[str, Sequence] | None = None,
    replicates: int = 1000,
    fraction: float = 0.01,
    export_cols: Sequence[str] = EXPORT_COLS,
    reports: Sequence[str] = ("pickup_hour", "pickup_day_of_week", "is_airport_trip", "payment_type"),
    method: str = "xxhash64",
) -> Checked:
    """Tune on the training side, then check and export the best model on the test side.

    Below ``out``: the model, and as CSV ``tuning_results``, ``stability``, ``bootstrap``, a hash sample of the
    test predictions in ``predictions`` (those of ``export_cols`` that the table has), and a segment
    report of the whole table per column of ``reports`` that it has, in ``report_<column>``.
    """
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    train, test = hash_split(gold, ids, method=method)
    train, test = _dealt(train.select(*ids, "features", "label"), ids), _dealt(test, ids)
    estimator = models.make_regressor(kind)
    best, table = tuning.tune(estimator, grid or tuning.SMALL_GRIDS[kind], train, id_col=id_col, split_method=method)
    save_model(best, f"{out}/models/{kind}-tuned")
    with persisted(evaluate.with_residuals(best.transform(test))) as scored:
        moved = stability.stability(best, test, id_col)
        interval = bootstrap.bootstrap_rmse(scored.select(*ids, "residual"), "residual", ids, replicates, method=method)
        export = evaluate.prediction_export(scored, id_col, fraction, [c for c in export_cols if c in scored.columns], method=method)
        results = {"tuning_results": table, "stability": moved, "bootstrap": interval, "predictions": export}
        for column in reports:
            if column in gold.columns:
                results[f"report_{column}"] = segment_report(gold, column, fare="label")
        for name, rows in results.items():
            write_csv(rows, f"{out}/{name}")
    read = gold.sparkSession.read
    stored = [read.csv(f"{out}/{n}", header=True, schema=results[n].schema) for n in ("tuning_results", "stability", "bootstrap")]
    return Checked(best, *stored)
