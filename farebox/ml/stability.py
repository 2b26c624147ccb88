"""How far predictions move when the features are disturbed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions.hashing import gaussian
from farebox.operators.sampling import hash_sample


def perturb(
    df: DataFrame,
    id_col: str | Sequence[str],
    vec: str = "features",
    out: str = "features_perturbed",
    sd: float = 0.01,
    seed: int = 42,
) -> DataFrame:
    """Add normal noise to every slot of a vector column.

    The noise is hashed from the row id and slot, so a retried task disturbs a row the same
    way; it is a native expression, with no Python worker involved.
    """
    noisy = F.transform(
        vector_to_array(vec), lambda x, i: x + F.lit(float(sd)) * gaussian(id_col, i, seed)
    )
    return df.withColumn(out, array_to_vector(noisy))


def stability(
    model: Model,
    df: DataFrame,
    id_col: str | Sequence[str],
    sd: float = 0.01,
    threshold: float = 0.10,
    fraction: float | None = None,
    seed: int = 42,
    vec: str = "features",
) -> DataFrame:
    """One row: rows tested, mean absolute change of the prediction, STABLE or UNSTABLE.

    Both predictions are columns of the same row. ``fraction`` tests a hash sample. Without rows
    change and verdict are null.
    """
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    rows = df.select(*ids, vec)
    if fraction is not None:
        rows = hash_sample(rows, ids, fraction, seed)
    rows = perturb(rows, ids, vec, "_perturbed", sd, seed)
    plain, moved = model.copy(), model.copy()
    plain.setFeaturesCol(vec).setPredictionCol("_before")
    moved.setFeaturesCol("_perturbed").setPredictionCol("_after")
    both = moved.transform(plain.transform(rows))
    change = both.agg(
        F.count(F.lit(1)).alias("records"),
        F.avg(F.abs(F.col("_before") - F.col("_after"))).alias("mean_change"),
    )
    verdict = F.when(F.col("mean_change") < threshold, "STABLE").when(F.col("records") > 0, "UNSTABLE")
    return change.select("records", "mean_change", verdict.alias("verdict"))
