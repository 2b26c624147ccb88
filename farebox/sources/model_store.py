"""Saving and loading fitted regressors."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import Model, PipelineModel
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    GBTRegressionModel,
    GeneralizedLinearRegressionModel,
    LinearRegressionModel,
    RandomForestRegressionModel,
)

MODEL_CLASSES = {
    "lr": LinearRegressionModel,
    "dt": DecisionTreeRegressionModel,
    "rf": RandomForestRegressionModel,
    "gbt": GBTRegressionModel,
    "glr": GeneralizedLinearRegressionModel,
    "features": PipelineModel,
}


def save_model(model: Model, path: str, overwrite: bool = True) -> None:
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(path: str, kind: str) -> Model:
    """Load a saved model by kind: lr, dt, rf, gbt, glr or a feature-stage model."""
    if kind not in MODEL_CLASSES:
        raise ValueError(f"unknown model kind {kind!r}, expected one of {sorted(MODEL_CLASSES)}")
    return MODEL_CLASSES[kind].load(path)


def load_first_model(paths: Sequence[str], kind: str) -> Model:
    """Load from the first path that holds a readable model, e.g. tuned before baseline."""
    failures = []
    for path in paths:
        try:
            return load_model(path, kind)
        except (Py4JJavaError, AnalysisException) as error:
            failures.append(f"{path}: {str(error).splitlines()[0]}")
    raise FileNotFoundError(f"no {kind} model found; tried " + "; ".join(failures))
