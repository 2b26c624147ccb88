"""Trip-domain column expressions and their parameter presets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.functions.numeric import as_column, ratio_or_zero

# Hour windows [start, end), zone ids, weekday numbers (1 = Sunday), codes.
RUSH_WIDE = ((7, 10), (16, 19))
RUSH_NARROW = ((7, 9), (17, 19))
LATE_NIGHT = (22, 5)
WEEKEND = (1, 7)
AIRPORTS = (132, 138, 1)
AIRPORTS_ALL = (1, 132, 137, 138)
MANHATTAN = (1, 100)
CREDIT_CARD = 1
CASH = 2


def in_hours(hour: Column, start: int, end: int) -> Column:
    """start <= hour < end; a window whose start is past its end wraps over midnight."""
    if start <= end:
        return (hour >= start) & (hour < end)
    return (hour >= start) | (hour < end)


def in_any_window(hour: Column, windows: Sequence[tuple[int, int]]) -> Column:
    condition = F.lit(False)
    for start, end in windows:
        condition = condition | in_hours(hour, start, end)
    return condition


def duration_seconds(pickup: str | Column, dropoff: str | Column) -> Column:
    """Whole seconds between two timestamps, with or without a time zone."""
    return F.unix_timestamp(as_column(dropoff)) - F.unix_timestamp(as_column(pickup))


def duration_minutes(pickup: str | Column, dropoff: str | Column) -> Column:
    return duration_seconds(pickup, dropoff) / F.lit(60.0)


def speed_mph(distance: Column, seconds: Column) -> Column:
    """Miles per hour; 0.0 where the trip took no time."""
    return ratio_or_zero(distance, seconds, 3600.0)


def clamped_speed_mph(distance: Column, minutes: Column, cap: float = 100.0) -> Column:
    """Miles per hour with no-time trips at 0 and everything above ``cap`` at ``cap``."""
    speed = F.try_divide(distance, minutes / F.lit(60.0))
    return F.least(F.coalesce(speed, F.lit(0.0)), F.lit(float(cap)))
