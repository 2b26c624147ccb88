"""Counts, nulls, summaries and distribution data of whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions.numeric import mean
from farebox.operators.quantiles import exact_quantiles, quantiles_and

QUARTILES = (0.25, 0.5, 0.75)


def _rows(structs: Sequence[Column]) -> Column:
    """Turn the single row of a global aggregation into one row per struct."""
    return F.inline(F.array(*structs))


def totals(df: DataFrame, **conditions: Column) -> DataFrame:
    """Row count, and the count of rows fulfilling each named condition, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("records"), *[F.count_if(c).alias(n) for n, c in conditions.items()]
    )


def value_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(*keys)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, only_nulls: bool = False) -> DataFrame:
    """Null count and percentage per column, highest first; all columns unless ``cols`` is given."""
    cols = list(cols or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)],
    )
    out = counted.select(
        _rows(
            [
                F.struct(
                    F.lit(c).alias("column"),
                    F.col(f"_null_{i}").alias("nulls"),
                    (F.try_divide(F.col(f"_null_{i}"), F.col("_n")) * F.lit(100.0)).alias("percent"),
                )
                for i, c in enumerate(cols)
            ]
        )
    )
    if only_nulls:
        out = out.filter(F.col("nulls") > 0)
    return out.orderBy(F.col("percent").desc(), "column")


# Statistics of column_summary beyond the quartiles.
MOMENTS = ("count", "mean", "stddev", "min", "max")


def column_summary(
    df: DataFrame,
    cols: Sequence[str],
    stats: Sequence[str] = MOMENTS,
    quartiles: str | None = "exact",
    per_unit: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row per column with typed statistics.

    ``quartiles="exact"`` finds q25, q50 and q75 by the range-narrowing passes of
    ``operators.quantiles``, the first of which also takes the other statistics; ``"approx"`` sketches
    them in one single pass; ``None`` leaves them out.
    """
    unit = dict(per_unit or {})
    makers = {
        "count": lambda c: F.count(c),
        "mean": lambda c: mean(c, unit.get(c)),
        "stddev": lambda c: F.stddev(c),
        "min": lambda c: F.min(F.col(c).cast("double")),
        "max": lambda c: F.max(F.col(c).cast("double")),
    }
    unknown = set(stats) - set(makers)
    if unknown:
        raise ValueError(f"unknown statistics {sorted(unknown)}")
    aggregates = [makers[s](c).alias(f"_{s}_{i}") for i, c in enumerate(cols) for s in stats]
    if quartiles == "approx":
        aggregates += [
            F.percentile_approx(F.col(c).cast("double"), list(QUARTILES)).alias(f"_q_{i}")
            for i, c in enumerate(cols)
        ]
    exact: dict[str, list[float | None]] = {}
    if quartiles == "exact":
        names = [f"_{s}_{i}" for i in range(len(cols)) for s in stats]
        types = df.limit(0).agg(*aggregates).schema if aggregates else None
        exact, row = quantiles_and(df, cols, QUARTILES, aggregates)
        # what is left is one row of numbers
        df = df.sparkSession.createDataFrame([tuple(row[n] for n in names)], types) if names else df.sparkSession.range(1)
        aggregates = [F.first(n).alias(n) for n in names]

    def quartile(i: int, c: str, j: int) -> Column:
        return F.get(f"_q_{i}", F.lit(j)) if quartiles == "approx" else F.lit(exact[c][j]).cast("double")

    structs = []
    for i, c in enumerate(cols):
        fields = [F.lit(c).alias("column"), *[F.col(f"_{s}_{i}").alias(s) for s in stats]]
        if quartiles is not None:
            fields += [quartile(i, c, j).alias(f"q{int(100 * p)}") for j, p in enumerate(QUARTILES)]
        structs.append(F.struct(*fields))
    return (df.agg(*aggregates) if aggregates else df.limit(1)).select(_rows(structs))


def median_of(df: DataFrame, col: str) -> float | None:
    return exact_quantiles(df, [col], [0.5])[col][0]


def box_stats(df: DataFrame, col: str, where: Column | None = None, whisker: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (last values within ``whisker`` IQR of the box) and outlier counts."""
    data = (df if where is None else df.filter(where)).select(F.col(col).cast("double").alias("_v"))
    q1, q2, q3 = (F.lit(q).cast("double") for q in exact_quantiles(data, ["_v"], QUARTILES)["_v"])
    low_fence, high_fence = q1 - F.lit(whisker) * (q3 - q1), q3 + F.lit(whisker) * (q3 - q1)
    v = F.col("_v")
    return data.agg(
        F.count(v).alias("n"),
        F.min(F.when(v >= low_fence, v)).alias("whisker_low"),
        F.max(F.when(v <= high_fence, v)).alias("whisker_high"),
        F.count_if(v < low_fence).alias("outliers_low"),
        F.count_if(v > high_fence).alias("outliers_high"),
    ).select("n", q1.alias("q1"), q2.alias("median"), q3.alias("q3"),
             "whisker_low", "whisker_high", "outliers_low", "outliers_high")


def _bin(col: str, lo: float, hi: float, bins: int) -> Column:
    """Bin number 0..bins-1 with the top edge inside the last bin; -1 below, ``bins`` above."""
    x = F.col(col).cast("double")
    inner = F.floor((x - F.lit(lo)) / F.lit((hi - lo) / bins)).cast("int")
    return (
        F.when(x < F.lit(lo), -1)
        .when(x > F.lit(hi), bins)
        .when(x.isNotNull(), F.least(inner, F.lit(bins - 1)))
    )


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int = 50) -> DataFrame:
    """Row count of every bin between lo and hi, empty ones too.

    Rows outside the view are counted in bins -1 and ``bins`` rather than dropped; nulls are
    left out.
    """
    lo, hi = float(lo), float(hi)
    if bins < 1 or not lo < hi:
        raise ValueError("histogram needs lo < hi and at least one bin")
    width = (hi - lo) / bins
    counts = (
        df.filter(F.col(col).isNotNull())
        .groupBy(_bin(col, lo, hi, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    every = df.sparkSession.range(-1, bins + 1, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    # both sides hold at most bins + 2 rows
    return (
        every.join(F.broadcast(counts), "bin", "left")
        .select(
            "bin",
            F.when(F.col("bin") >= 0, F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
            F.when(F.col("bin") < bins, F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
            F.coalesce("_n", F.lit(0).cast("bigint")).alias("count"),
        )
        .orderBy("bin")
    )


def density_2d(
    df: DataFrame,
    x: str,
    y: str,
    x_bins: tuple[float, float, int] = (0.0, 20.0, 50),
    y_bins: tuple[float, float, int] = (0.0, 100.0, 50),
) -> DataFrame:
    """Row count per occupied (x, y) cell; each axis is (lo, hi, bins), edges as in ``histogram``."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return (
        both.groupBy(_bin(x, *x_bins).alias("x_bin"), _bin(y, *y_bins).alias("y_bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("x_bin", "y_bin")
    )


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows where both are present.

    One aggregation computes all pairs from the full data; the matrix comes back in long form
    (a, b, r) with both triangles and the diagonal.
    """
    pairs = list(combinations_with_replacement(cols, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    structs = []
    for i, (a, b) in enumerate(pairs):
        for left, right in dict.fromkeys([(a, b), (b, a)]):
            structs.append(
                F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"), F.col(f"_r{i}").alias("r"))
            )
    return wide.select(_rows(structs)).orderBy("a", "b")
