"""Means, rounding and guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def whole_units(value: str | Column, per_unit: int) -> Column:
    """The value as a whole number of 1/per_unit parts, halves rounded up."""
    return F.floor(as_column(value) * F.lit(float(per_unit)) + F.lit(0.5)).cast("bigint")


def mean(value: str | Column, per_unit: int | None = None) -> Column:
    """Average of the non-null values.

    Double addition depends on the order in which partial sums arrive, so the last digits of
    ``avg`` differ from run to run on a cluster. With ``per_unit`` the values are summed as
    whole 1/per_unit parts (100 for money in cents): the result is then the same whichever way
    the rows are partitioned. The parts are summed as decimals of 38 digits, so only a single
    value can be too large (value x per_unit above 9.2e18, which raises), not their sum.
    """
    if per_unit is None:
        return F.avg(as_column(value))
    total = F.sum(whole_units(value, per_unit).cast("decimal(28,0)")).cast("double")
    return F.try_divide(total, F.count(as_column(value)).cast("double")) / F.lit(float(per_unit))


def ratio_or_zero(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """numerator / denominator * scale where the denominator is positive, else 0.0."""
    ratio = numerator / denominator
    if scale != 1.0:
        ratio = ratio * F.lit(scale)
    return F.when(denominator > 0, ratio).otherwise(F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.when(condition, 1).otherwise(0)
