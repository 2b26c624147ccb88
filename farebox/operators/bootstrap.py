"""Confidence interval of the RMSE by a distributed Poisson bootstrap."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions.hashing import drawn, hash_word, lanes_per_hash, poisson_count, poisson_weight, uniform


def bootstrap_replicates(
    df: DataFrame,
    residual: str,
    id_col: str | Sequence[str],
    n: int = 1000,
    seed: int = 42,
    fraction: float | None = None,
    method: str = "xxhash64",
) -> DataFrame:
    """RMSE of each of n resamples: columns replicate, resample_size, rmse.

    Instead of drawing rows with replacement, every row joins replicate b with a Poisson(1)
    number of copies hashed from (seed, b, row id). One hash word serves several replicates,
    so a row expands to n/lanes blocks; each task folds its blocks into per-replicate sums
    before the shuffle, which then carries n pairs of numbers per task whatever the table's
    size. A resample's size varies around the table's, so its RMSE divides by its own size.
    ``fraction`` bootstraps a hash sample of the residuals.
    """
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    lanes = lanes_per_hash(method)
    blocks = -(-n // lanes)
    rows = df.filter(F.col(residual).isNotNull())
    if fraction is not None:
        rows = rows.filter(drawn(ids, fraction, seed, method))
    rows = rows.select(*ids, (F.col(residual) * F.col(residual)).alias("_sq"))
    words = rows.select(
        "_sq", *ids, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block")
    ).select("_sq", "_block", hash_word(ids, seed, F.col("_block"), method).alias("_word"))
    weights = [poisson_weight(F.col("_word"), lane, method) for lane in range(lanes)]
    weighted = words.select("_sq", "_block", *[w.alias(f"_w{i}") for i, w in enumerate(weights)])
    sums = weighted.groupBy("_block").agg(
        *[F.sum(f"_w{i}").alias(f"_n{i}") for i in range(lanes)],
        *[F.sum(F.col(f"_w{i}") * F.col("_sq")).alias(f"_s{i}") for i in range(lanes)],
    )
    lane_rows = F.array(
        *[
            F.struct(
                (F.col("_block") * lanes + i).alias("replicate"),
                F.col(f"_n{i}").alias("resample_size"),
                F.sqrt(F.try_divide(F.col(f"_s{i}"), F.col(f"_n{i}").cast("double"))).alias("rmse"),
            )
            for i in range(lanes)
        ]
    )
    return sums.select(F.inline(lane_rows)).filter(F.col("replicate") < n)


def bootstrap_rmse(
    df: DataFrame,
    residual: str,
    id_col: str | Sequence[str],
    n: int = 1000,
    ci: float = 0.95,
    seed: int = 42,
    fraction: float | None = None,
    method: str = "xxhash64",
) -> DataFrame:
    """One row: replicates, mean RMSE and the ends of the central ``ci`` interval."""
    tail = (1.0 - ci) / 2.0
    replicates = bootstrap_replicates(df, residual, id_col, n, seed, fraction, method)
    # n replicate rows at most, so the exact percentile fits one buffer
    return replicates.agg(
        F.count("rmse").alias("replicates"),
        F.avg("rmse").alias("rmse_mean"),
        F.percentile("rmse", F.lit(tail)).alias("ci_lower"),
        F.percentile("rmse", F.lit(1.0 - tail)).alias("ci_upper"),
    )


def little_replicates(
    df: DataFrame,
    residual: str,
    id_col: str | Sequence[str],
    blocks: int = 20,
    replicates: int = 100,
    gamma: float = 0.7,
    seed: int = 42,
    method: str = "xxhash64",
) -> DataFrame:
    """RMSE of each resample of each little block: block, block_rows, replicate, resample_size, rmse.

    A bag of little bootstraps: ``blocks`` disjoint blocks of about n ** ``gamma`` of the n rows (n / ``blocks`` at
    most), chosen by a hash of the id. Each replicate resamples a block to the size of the whole table,
    by Poisson(n / block size) copies of each of its rows, hashed too. Beside the two scans that count
    and choose, the work is blocks * n ** gamma * replicates draws, so it grows slower than the rows.
    """
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    rows = df.filter(F.col(residual).isNotNull())
    n = rows.count()
    size = max(1.0, min(n / blocks, float(math.ceil(n**gamma)))) if n else 1.0
    block = F.floor(uniform(ids, seed, method, "block") * F.lit(n / size)).cast("int")
    chosen = rows.select(*ids, block.alias("block"), (F.col(residual) * F.col(residual)).alias("_sq")).filter(F.col("block") < blocks)
    copies = chosen.select("block", "_sq", *ids, F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))
    weight = poisson_count(ids, F.col("replicate"), max(1.0, n / size), seed, method)
    sums = copies.select("block", "replicate", "_sq", weight.alias("_w")).groupBy("block", "replicate").agg(
        F.count(F.lit(1)).alias("block_rows"), F.sum("_w").alias("resample_size"), F.sum(F.col("_w") * F.col("_sq")).alias("_s")
    )
    return sums.select(
        "block", "block_rows", "replicate", "resample_size", F.sqrt(F.try_divide(F.col("_s"), F.col("resample_size").cast("double"))).alias("rmse")
    )


def little_bootstrap_rmse(
    df: DataFrame,
    residual: str,
    id_col: str | Sequence[str],
    blocks: int = 20,
    replicates: int = 100,
    gamma: float = 0.7,
    ci: float = 0.95,
    seed: int = 42,
    method: str = "xxhash64",
) -> DataFrame:
    """One row: blocks, rows in blocks, replicates, and the mean RMSE and ends of the central ``ci`` interval, each the
    average of the blocks' own."""
    tail = (1.0 - ci) / 2.0
    # ``replicates`` rows a block
    each = little_replicates(df, residual, id_col, blocks, replicates, gamma, seed, method).groupBy("block").agg(
        F.max("block_rows").alias("rows"), F.count("rmse").alias("replicates"), F.avg("rmse").alias("mean"),
        F.percentile("rmse", F.lit(tail)).alias("low"), F.percentile("rmse", F.lit(1.0 - tail)).alias("high"),
    )
    return each.agg(
        F.count(F.lit(1)).alias("blocks"), F.sum("rows").alias("block_rows"), F.sum("replicates").alias("replicates"),
        F.avg("mean").alias("rmse_mean"), F.avg("low").alias("ci_lower"), F.avg("high").alias("ci_upper"),
    )
