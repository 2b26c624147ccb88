"""Segment reports, orderings and top-k."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions.numeric import mean
from farebox.operators.selection import SORT_ROWS, first_n


def segment_report(
    df: DataFrame,
    key: str,
    fare: str = "label",
    distance: str | None = "trip_distance",
    per_unit: Mapping[str, int] | None = None,
) -> DataFrame:
    """Average fare, average distance and trip count per key value, ordered by key.

    ``distance=None`` leaves the distance out. ``per_unit`` asks for order-independent means
    (see ``functions.numeric.mean``) of the columns it names.
    """
    unit = dict(per_unit or {})
    aggregates: list[Column] = [mean(fare, unit.get(fare)).alias("avg_fare")]
    if distance is not None:
        aggregates.append(mean(distance, unit.get(distance)).alias("avg_distance"))
    aggregates.append(F.count(F.lit(1)).alias("trip_count"))
    return df.groupBy(key).agg(*aggregates).orderBy(key)


def top_k(df: DataFrame, by: str, k: int, desc: bool = True, tie: str | None = None) -> DataFrame:
    """The k first rows of a result table; ``tie`` makes equal values come out the same way.

    Up to ``selection.SORT_ROWS`` rows come in order. More are those of ``first_n``, by a number, without one.
    """
    ties = [tie] if tie is not None else []
    if k > SORT_ROWS:
        return first_n(df, by, k, desc, ties)
    return df.orderBy(F.col(by).desc() if desc else F.col(by).asc(), *ties).limit(k)


def best_row(df: DataFrame, metric: str, tie: str, largest: bool = False) -> DataFrame:
    """The row with the smallest (or largest) metric, found by one aggregation without a sort."""
    row = F.struct(*[F.col(c) for c in df.columns])
    if largest:
        rank = F.struct(-F.col(metric), F.col(tie))
    else:
        rank = F.struct(F.col(metric), F.col(tie))
    return df.filter(F.col(metric).isNotNull()).agg(F.min_by(row, rank).alias("_row")).select("_row.*")
