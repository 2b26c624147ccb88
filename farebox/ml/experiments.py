"""Scaling experiments: data size and partition count."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.ml.models import evaluate_model, fit
from farebox.operators.reports import best_row
from farebox.operators.sampling import hash_sample, hash_split
from farebox.operators.scaling import persisted

# The default sweeps.
FRACTIONS = (0.1, 0.25, 0.5, 0.75, 1.0)
PARTITION_COUNTS = (50, 100, 200)


def learning_curve(
    train: DataFrame,
    test: DataFrame,
    id_col: str | Sequence[str],
    fractions: Sequence[float] = FRACTIONS,
    kind: str = "rf",
    label: str = "label",
    seed: int = 42,
    timed: bool = False,
    method: str = "xxhash64",
    **params: object,
) -> DataFrame:
    """Test rmse of one regressor fitted on growing, nested hash samples of the training rows.

    Columns fraction, records, rmse; ``timed`` adds training_time, prediction_time and
    throughput, which differ from run to run. Both sides are persisted across the fits.
    """
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    results = []
    with persisted(train.select(*ids, "features", label)) as rows, persisted(
        test.select("features", label)
    ) as held:
        held_rows = held.count()
        for fraction in fractions:
            part = hash_sample(rows, ids, fraction, seed, method)
            records = part.count()
            model, seconds = fit(kind, part, label=label, **params)
            start = time.monotonic()
            rmse = evaluate_model(model, held, label).first()["rmse"]
            scoring = time.monotonic() - start
            results.append((float(fraction), records, rmse, seconds, scoring, held_rows / max(scoring, 1e-9)))
    table = train.sparkSession.createDataFrame(
        results,
        "fraction double, records bigint, rmse double, training_time double, "
        "prediction_time double, throughput double",
    )
    return table if timed else table.select("fraction", "records", "rmse")


def partition_sweep(
    df: DataFrame,
    id_col: str | Sequence[str],
    counts: Sequence[int] = PARTITION_COUNTS,
    kind: str = "rf",
    label: str = "label",
    seed: int = 42,
    method: str = "xxhash64",
    **params: object,
) -> DataFrame:
    """Seconds to fit on the training split of ``df`` cut into different partition counts.

    The split is by id hash, so every count trains on the same rows.
    """
    train, _ = hash_split(df, id_col, seed=seed, method=method)
    results = []
    for count in counts:
        with persisted(train.select("features", label).repartition(count)) as rows:
            records = rows.count()
            results.append((count, records, fit(kind, rows, label=label, **params).seconds))
    return df.sparkSession.createDataFrame(
        results, "partitions int, records bigint, training_time double"
    )


def scaling_outcome(sweep: DataFrame, curve: DataFrame) -> DataFrame:
    """What a sweep and a learning curve say, as one row.

    From the sweep: best_partitions (the fewest of those that took the least time), its time, and gain_pct, the time
    it saves against the slowest. From the curve: time_per_records_r2 (how near the fit's time is to a
    straight line over the rows), growth (the time of the largest fit as a multiple of the smallest's, per
    multiple of their rows) and the mean throughput of scoring.
    """
    best = best_row(sweep, "training_time", "partitions")
    slowest = sweep.agg(F.max("training_time")).scalar()
    y, x = F.col("training_time"), F.col("records").cast("double")
    line = curve.agg(
        F.regr_r2(y, x).alias("time_per_records_r2"),
        (F.max_by(y, x) / F.min_by(y, x) / (F.max(x) / F.min(x))).alias("growth"), F.avg("throughput").alias("throughput"),
    )
    return best.select(
        F.col("partitions").alias("best_partitions"), F.col("training_time").alias("best_time"),
        ((slowest - F.col("training_time")) / slowest * F.lit(100.0)).alias("gain_pct"),
        *[line.select(c).scalar().alias(c) for c in line.columns],
    )
