"""The first n rows of an order for any n: sure rows are taken as they are, only those around the cut are ranked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.operators.quantiles import ACCURACY
from farebox.operators.ranking import with_rank

SORT_ROWS = 10_000  # up to so many rows a plain sort with a limit ends in one small task


def first_n(df: DataFrame, by: str | Column, n: int, desc: bool = False, ties: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """n rows (or all, if fewer): those with the smallest (``desc``: largest) ``by``, ties by the columns ``ties``.

    ``by`` is a number; nulls come first, in descending order last, and NaN is the largest number, as in a
    sort. A sketch of ``by`` brackets the n-th value in one pass. Rows before the bracket are taken
    without being moved; only those inside it, a few ten-thousandths of the table and what ties there, are
    ranked by ranges (``with_rank``). ``ties`` should tell rows apart. The result has no order. ``df`` is read
    five times, so pass a written table.
    """
    value = (F.col(by) if isinstance(by, str) else by).cast("double")
    order = value.desc() if desc else value.asc()
    if n <= SORT_ROWS:
        return df.orderBy(order, *ties).limit(n)
    # a number that grows in the order wanted, nulls and NaN at its ends
    sketched = F.when(value.isNull() | F.isnan(value), None).otherwise(-value if desc else value)
    place = F.when(value.isNull(), 2 if desc else -2).when(F.isnan(value), -1 if desc else 1).otherwise(0)
    counted = df.agg(*[F.count_if(place == k).alias(f"n{k + 2}") for k in range(-2, 3)]).first()
    before = 0
    parts: list[DataFrame] = []
    for k in range(-2, 3):
        rows, size, wanted = df.where(place == k), counted[f"n{k + 2}"], n - before
        if size == 0 or wanted <= 0:
            continue
        before += size
        if size <= wanted:
            parts.append(rows)
            continue
        if k == 0:
            near = [min(1.0, max(0.0, wanted / size + side * 2 / ACCURACY)) for side in (-1, 1)]
            low, high = rows.agg(F.percentile_approx(sketched, near, ACCURACY).alias("q")).first()["q"]
            sure = rows.where(sketched < F.lit(low))
            parts.append(sure)
            wanted -= sure.count()
            rows = rows.where((sketched >= F.lit(low)) & (sketched <= F.lit(high)))
        ranked = with_rank(rows, [order, *ties], "_first_n", partitions)
        parts.append(ranked.where(F.col("_first_n") < wanted).drop("_first_n"))
    if not parts:
        return df.limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
