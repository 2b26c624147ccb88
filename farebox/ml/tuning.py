"""Parameter grids, cross-validation and train/validation tuning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions.hashing import drawn
from farebox.operators.sampling import with_fold
from farebox.operators.scaling import persisted

# Default search grids.
DEFAULT_GRIDS: dict[str, dict[str, list]] = {
    "lr": {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]},
    "dt": {"maxDepth": [5, 10, 15], "maxBins": [32, 64], "minInstancesPerNode": [1, 5]},
    "rf": {"numTrees": [20, 50, 100], "maxDepth": [5, 10, 15], "maxBins": [32, 64]},
    "gbt": {"maxIter": [20, 50, 100], "maxDepth": [3, 5, 7], "stepSize": [0.01, 0.1, 0.3]},
    "glr": {"regParam": [0.0, 0.01, 0.1]},
}

# The smaller grids for train/validation tuning.
SMALL_GRIDS: dict[str, dict[str, list]] = {
    "rf": {"numTrees": [10, 20], "maxDepth": [5, 10]},
    "gbt": {"maxIter": [10, 20], "maxDepth": [3, 5]},
}


def param_grid(estimator: Estimator, values: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the listed values, as MLlib parameter maps."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), list(options))
    return builder.build()


def tune(
    estimator: Estimator,
    grid: Mapping[str, Sequence],
    train: DataFrame,
    method: str = "tvs",
    folds: int = 3,
    ratio: float = 0.8,
    parallelism: int = 4,
    seed: int = 42,
    id_col: str | Sequence[str] | None = None,
    metric: str = "rmse",
    split_method: str = "xxhash64",
) -> tuple[Model, DataFrame]:
    """Search a grid; returns the best model refitted on all of ``train`` and a metric table.

    ``method`` is "tvs" (one train/validation split) or "cv" (cross-validation). With ``id_col``
    the split or the folds are hashed from the row id and so are the same on every cluster and
    whatever the partitions; then boosted trees are also fitted once for all values of ``maxIter``, and
    measured after each (``prefix_metrics``). The rows stay persisted while the candidates are fitted,
    ``parallelism`` at a time. The table has one row per parameter combination, best first.
    """
    if method not in ("cv", "tvs"):
        raise ValueError(f"method must be 'cv' or 'tvs', got {method!r}")
    maps = param_grid(estimator, grid)
    evaluator = RegressionEvaluator(
        labelCol=estimator.getOrDefault("labelCol"), predictionCol="prediction", metricName=metric
    )
    common = {
        "estimator": estimator,
        "estimatorParamMaps": maps,
        "evaluator": evaluator,
        "parallelism": parallelism,
        "seed": seed,
    }
    needed = [estimator.getOrDefault("featuresCol"), estimator.getOrDefault("labelCol")]
    larger = evaluator.isLargerBetter()
    if id_col is not None and (method == "tvs" or isinstance(estimator, GBTRegressor)):
        ids = [id_col] if isinstance(id_col, str) else list(id_col)
        metrics = [0.0] * len(maps)
        sides = _hashed_sides(train.select(*dict.fromkeys([*ids, *needed])), ids, needed, method, folds, ratio, seed, split_method)
        for fitting, validation in sides:
            with persisted(fitting) as rows, persisted(validation) as held:
                for i, value in _measured(estimator, maps, rows, held, evaluator, parallelism).items():
                    metrics[i] += value / len(sides)
        best = maps[metrics.index(max(metrics) if larger else min(metrics))]
        with persisted(train.select(*needed)) as rows:
            return estimator.fit(rows, best), _table(train, maps, metrics, metric, larger)
    if method == "cv":
        if id_col is None:
            search, rows = CrossValidator(numFolds=folds, **common), train.select(*needed)
        else:
            rows = with_fold(train, id_col, folds, seed, out="fold").select(*needed, "fold")
            search = CrossValidator(numFolds=folds, foldCol="fold", **common)
    else:
        search, rows = TrainValidationSplit(trainRatio=ratio, **common), train.select(*needed)
    with persisted(rows):
        found = search.fit(rows)
    metrics = found.avgMetrics if method == "cv" else found.validationMetrics
    return found.bestModel, _table(train, maps, metrics, metric, larger)


def _hashed_sides(
    rows: DataFrame, ids: Sequence[str], needed: Sequence[str], method: str, folds: int, ratio: float, seed: int, split_method: str
) -> list[tuple[DataFrame, DataFrame]]:
    """(fitting, validation) rows of the split, or of every fold."""
    if method == "tvs":
        # a draw of its own: the split that made the rows may use the same seed and ids
        fits = drawn(ids, ratio, seed, split_method, "validation")
        return [(rows.filter(fits).select(*needed), rows.filter(~fits).select(*needed))]
    folded = with_fold(rows, ids, folds, seed, out="_fold")
    return [(folded.filter(F.col("_fold") != k).select(*needed), folded.filter(F.col("_fold") == k).select(*needed)) for k in range(folds)]


def _measured(
    estimator: Estimator, maps: Sequence[dict], rows: DataFrame, held: DataFrame, evaluator: RegressionEvaluator, parallelism: int
) -> dict[int, float]:
    """The metric of every combination, by its place. Combinations that differ in nothing but the rounds of
    boosting share one fit of the most rounds (``prefix_metrics``)."""
    rounds = estimator.maxIter if isinstance(estimator, GBTRegressor) and evaluator.getMetricName() in PREFIX_METRICS else None
    shared: dict[tuple, list[int]] = {}
    for i, m in enumerate(maps):
        alone = (i,) if rounds not in m else ()
        shared.setdefault((*alone, *sorted((p.name, str(v)) for p, v in m.items() if p != rounds)), []).append(i)

    def measure(places: list[int]) -> dict[int, float]:
        most = max((maps[i] for i in places), key=lambda m: m.get(rounds, 0))
        model = estimator.fit(rows, most)
        if len(places) == 1:
            return {places[0]: evaluator.evaluate(model.transform(held))}
        found = prefix_metrics(model, held, [maps[i][rounds] for i in places], evaluator.getMetricName())
        return {i: found[maps[i][rounds]] for i in places}

    with ThreadPoolExecutor(parallelism) as pool:
        return {i: v for part in pool.map(measure, shared.values()) for i, v in part.items()}


PREFIX_METRICS = ("rmse", "mse", "mae", "r2")


def prefix_metrics(model: GBTRegressionModel, rows: DataFrame, rounds: Sequence[int], metric: str = "rmse") -> dict[int, float]:
    """The metric that a boosted model had after each number of ``rounds``, in one pass over the rows.

    Boosting adds trees one after the other and never changes one, so the first k trees are the
    model that a fit of k rounds with the same seed gives.
    """
    if metric not in PREFIX_METRICS:
        raise ValueError(f"metric must be one of {PREFIX_METRICS}, got {metric!r}")
    # losses per round; the model's own weights make them those of its predictions
    loss = model.evaluateEachIteration(rows, "absolute" if metric == "mae" else "squared")
    if metric == "r2":
        label = model.getOrDefault("labelCol")
        spread = rows.agg(F.var_pop(F.col(label).cast("double"))).first()[0]
        return {k: 1 - loss[k - 1] / spread if spread else float("nan") for k in rounds}
    return {k: loss[k - 1] ** 0.5 if metric == "rmse" else loss[k - 1] for k in rounds}


def _table(train: DataFrame, maps: Sequence[dict], metrics: Sequence[float], metric: str, larger: bool) -> DataFrame:
    """One row per parameter combination, best first."""
    table = train.sparkSession.createDataFrame(
        [
            (", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)), float(value))
            for m, value in zip(maps, metrics)
        ],
        f"params string, {metric} double",
    )
    return table.orderBy(F.col(metric).desc() if larger else F.col(metric).asc(), "params")
