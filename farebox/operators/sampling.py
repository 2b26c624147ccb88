"""Splits, samples and folds that depend on row ids, not on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions.hashing import drawn, uniform
from farebox.operators.ranking import with_rank
from farebox.operators.selection import SORT_ROWS

STEPS_PER_HALVING = 16


def with_uniform(
    df: DataFrame, id_col: str | Sequence[str], seed: int = 42, out: str = "u", method: str = "xxhash64"
) -> DataFrame:
    return df.withColumn(out, uniform(id_col, seed, method))


def with_split(
    df: DataFrame,
    id_col: str | Sequence[str],
    ratio: float = 0.8,
    seed: int = 42,
    out: str = "split",
    method: str = "xxhash64",
) -> DataFrame:
    """Label every row 'train' or 'test'."""
    is_train = drawn(id_col, ratio, seed, method, "split")
    return df.withColumn(out, F.when(is_train, "train").otherwise("test"))


def hash_split(
    df: DataFrame, id_col: str | Sequence[str], ratio: float = 0.8, seed: int = 42, method: str = "xxhash64"
) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, together the whole input, and the same rows on every cluster."""
    is_train = drawn(id_col, ratio, seed, method, "split")
    return df.filter(is_train), df.filter(~is_train)


def hash_sample(
    df: DataFrame, id_col: str | Sequence[str], fraction: float, seed: int = 42, method: str = "xxhash64"
) -> DataFrame:
    """Bernoulli sample; with the same seed a smaller fraction is a subset of a larger one.

    To sample a sample again, use another seed.
    """
    return df.filter(drawn(id_col, fraction, seed, method))


def with_fold(
    df: DataFrame,
    id_col: str | Sequence[str],
    k: int = 3,
    seed: int = 42,
    out: str = "fold",
    method: str = "xxhash64",
) -> DataFrame:
    """Add a fold number 0..k-1."""
    return df.withColumn(out, F.floor(uniform(id_col, seed, method, "fold") * F.lit(float(k))).cast("int"))


def _level(draw: Column) -> Column:
    """How often the draw has been halved, in sixteenths: a coarse, decreasing rank of draws."""
    floor = F.lit(2.0**-53)
    return F.floor(-F.log2(F.greatest(draw, floor)) * F.lit(float(STEPS_PER_HALVING))).cast("int")


def sample_n(
    df: DataFrame, id_col: str | Sequence[str], n: int, seed: int = 42, method: str = "xxhash64"
) -> DataFrame:
    """Exactly n rows (or all, if fewer): those with the smallest draws, ties by id.

    A plain ``orderBy(draw).limit(n)`` sends n rows of every task to one place. Counting the
    rows per level of the draw first (under 900 groups, reading only the ids) tells which
    levels can hold the n smallest draws. Up to ``SORT_ROWS`` rows, the final ordering sees little more
    than n rows. A larger sample takes whole levels as they are, without an order, and only rows of the
    level at the cut, a twenty-fourth of what comes before it, are ranked, by ranges.
    """
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    draw = uniform(ids, seed, method, "sample")
    counts = (
        df.groupBy(_level(draw).alias("level")).agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.col("level").desc()).collect()
    )
    kept, cut = 0, 0
    for row in counts:
        cut, kept = row["level"], kept + row["rows"]
        if kept >= n:
            break
    if n <= SORT_ROWS:
        near = df.filter(_level(draw) >= F.lit(cut))
        return near.withColumn("_draw", draw).orderBy("_draw", *ids).limit(n).drop("_draw")
    above = sum(row["rows"] for row in counts if row["level"] > cut)
    edge = df.filter(_level(draw) == F.lit(cut)).withColumn("_draw", draw)
    ranked = with_rank(edge, ["_draw", *ids], "_rank")
    last = ranked.filter(F.col("_rank") < n - above).drop("_draw", "_rank")
    return df.filter(_level(draw) > F.lit(cut)).unionByName(last)
