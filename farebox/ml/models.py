"""Regressors by kind, scoring, importances and the sample-size comparison."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.ml import Estimator, Model
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.operators.evaluate import compare
from farebox.operators.sampling import hash_sample
from farebox.operators.scaling import persisted

ESTIMATORS = {
    "lr": LinearRegression,
    "dt": DecisionTreeRegressor,
    "rf": RandomForestRegressor,
    "gbt": GBTRegressor,
    "glr": GeneralizedLinearRegression,
}

# Default settings of each kind.
DEFAULTS: dict[str, dict[str, object]] = {
    "lr": {"maxIter": 100, "regParam": 0.0, "elasticNetParam": 0.0},
    "dt": {"maxDepth": 10, "maxBins": 32, "minInstancesPerNode": 1, "seed": 42},
    "rf": {
        "numTrees": 50,
        "maxDepth": 10,
        "maxBins": 32,
        "minInstancesPerNode": 1,
        "subsamplingRate": 1.0,
        "seed": 42,
        # same trees; rows remember their node instead of walking every tree at every level,
        # which saves a third of the fit (boosted trees are shallow and only pay for it)
        "cacheNodeIds": True,
    },
    "gbt": {
        "maxIter": 50,
        "maxDepth": 5,
        "maxBins": 32,
        "minInstancesPerNode": 1,
        "stepSize": 0.1,
        "subsamplingRate": 1.0,
        "seed": 42,
    },
    "glr": {"family": "gaussian", "link": "identity", "maxIter": 100, "regParam": 0.0},
}

# The lighter settings used for interactive comparison of the five kinds.
LIGHT: dict[str, dict[str, object]] = {
    "lr": {"maxIter": 10, "regParam": 0.1},
    "dt": {"maxDepth": 10, "minInstancesPerNode": 20, "seed": 42},
    "rf": {"numTrees": 20, "maxDepth": 10, "minInstancesPerNode": 20, "seed": 42},
    "gbt": {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "seed": 42},
    "glr": {"maxIter": 10},
}


class Fitted(NamedTuple):
    model: Model
    seconds: float


def make_regressor(kind: str, features: str = "features", label: str = "label", **params: object) -> Estimator:
    """An unfitted regressor: lr, dt, rf, gbt or glr, with the kind's defaults under ``params``."""
    if kind not in ESTIMATORS:
        raise ValueError(f"unknown model kind {kind!r}, expected one of {sorted(ESTIMATORS)}")
    return ESTIMATORS[kind](featuresCol=features, labelCol=label, **{**DEFAULTS[kind], **params})


def fit(
    kind: str, train: DataFrame, features: str = "features", label: str = "label", **params: object
) -> Fitted:
    """Fit one regressor; returns the model and the seconds the fit took."""
    estimator = make_regressor(kind, features, label, **params)
    narrow = train.select(features, label)
    start = time.monotonic()
    model = estimator.fit(narrow)
    return Fitted(model, time.monotonic() - start)


def score(models: Mapping[str, Model], df: DataFrame) -> DataFrame:
    """One prediction column per model, named ``prediction_<name>``, on the same rows.

    All predictions of a row are columns of that row, so nothing has to be paired up later.
    """
    for name, model in models.items():
        copy = model.copy()
        copy.setPredictionCol(f"prediction_{name}")
        df = copy.transform(df)
    return df


def compare_models(models: Mapping[str, Model], test: DataFrame, label: str = "label") -> DataFrame:
    """rmse, mae, r2 and mse of every model, measured in one pass over the test rows."""
    return compare(score(models, test), label, {name: f"prediction_{name}" for name in models})


def evaluate_model(model: Model, df: DataFrame, label: str = "label") -> DataFrame:
    """rmse, mae, r2 and mse of one model, as one row."""
    return compare_models({"model": model}, df, label).drop("model_name")


def importances(df: DataFrame, model: Model, names: Sequence[str]) -> DataFrame:
    """(feature, importance) of a tree model, highest first; empty for linear models."""
    rows: list[tuple[str, float]] = []
    if hasattr(model, "featureImportances"):
        weights = model.featureImportances.toArray()
        if len(weights) != len(names):
            raise ValueError(f"{len(names)} names for {len(weights)} vector slots")
        rows = [(n, float(w)) for n, w in zip(names, weights)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature")


def sample_vs_full(
    train: DataFrame,
    test: DataFrame,
    id_col: str | Sequence[str],
    fraction: float = 0.05,
    kind: str = "rf",
    label: str = "label",
    seed: int = 42,
    method: str = "xxhash64",
    **params: object,
) -> DataFrame:
    """Test metrics of the same regressor fitted on a hash sample and on all training rows, with how many
    rows each was fitted on (``trained_rows``)."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    with persisted(train.select(*dict.fromkeys([*ids, "features", label]))) as rows:
        sides = {"sample": hash_sample(rows, ids, fraction, seed, method), "full": rows}
        fitted = {name: fit(kind, side, label=label, **params).model for name, side in sides.items()}
        sizes = F.create_map(*[F.lit(x) for name, side in sides.items() for x in (name, side.count())])
    return compare_models(fitted, test, label).withColumn("trained_rows", sizes[F.col("model_name")].cast("long"))
