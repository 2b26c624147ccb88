"""Derived trip columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions import trip
from farebox.functions.numeric import flag, ratio_or_zero
from farebox.operators.quality import apply_rules, speed_rule


def time_features(
    df: DataFrame,
    ts: str = "tpep_pickup_datetime",
    rush: Sequence[tuple[int, int]] = trip.RUSH_WIDE,
    late: tuple[int, int] = trip.LATE_NIGHT,
    weekend: Sequence[int] = trip.WEEKEND,
    day_name: str = "pickup_day_of_week",
) -> DataFrame:
    """Hour, weekday (1 = Sunday), month, year, and weekend, rush-hour and late-night flags."""
    hour, day = F.hour(ts), F.dayofweek(ts)
    return df.withColumns(
        {
            "pickup_hour": hour,
            day_name: day,
            "pickup_month": F.month(ts),
            "pickup_year": F.year(ts),
            "is_weekend": flag(day.isin(*weekend)),
            "is_rush_hour": flag(trip.in_any_window(hour, rush)),
            "is_late_night": flag(trip.in_hours(hour, *late)),
        }
    )


def with_duration(
    df: DataFrame,
    pickup: str = "tpep_pickup_datetime",
    dropoff: str = "tpep_dropoff_datetime",
    out: str = "trip_duration_minutes",
) -> DataFrame:
    return df.withColumn(out, trip.duration_minutes(pickup, dropoff))


def trip_features(
    df: DataFrame,
    pickup: str = "tpep_pickup_datetime",
    dropoff: str = "tpep_dropoff_datetime",
    distance: str = "trip_distance",
    fare: str = "fare_amount",
    tip: str = "tip_amount",
    max_mph: float | None = 80.0,
) -> DataFrame:
    """Duration, speed, fare per mile and tip percentage; rows above ``max_mph`` are dropped.

    Fare per mile and tip percentage are computed from the fare and so are for analysis, not
    for models that predict it. ``max_mph=None`` keeps every row.
    """
    seconds = trip.duration_seconds(pickup, dropoff)
    out = df.withColumns(
        {
            "trip_duration_seconds": seconds,
            "trip_duration_minutes": seconds / F.lit(60.0),
            "speed_mph": trip.speed_mph(F.col(distance), seconds),
            "fare_per_mile": ratio_or_zero(F.col(fare), F.col(distance)),
            "tip_percentage": ratio_or_zero(F.col(tip), F.col(fare), 100.0),
        }
    )
    return out if max_mph is None else apply_rules(out, speed_rule(max_mph))


def clamped_speed(
    df: DataFrame,
    distance: str = "trip_distance",
    minutes: str = "trip_duration_minutes",
    cap: float = 100.0,
    out: str = "avg_speed_mph",
) -> DataFrame:
    return df.withColumn(out, trip.clamped_speed_mph(F.col(distance), F.col(minutes), cap))


def location_features(
    df: DataFrame,
    pu: str = "PULocationID",
    do: str = "DOLocationID",
    airports: Sequence[int] = trip.AIRPORTS,
    manhattan: tuple[int, int] = trip.MANHATTAN,
) -> DataFrame:
    """Airport and Manhattan flags of both ends, any-airport flag and cross-borough flag."""
    from_airport, to_airport = F.col(pu).isin(*airports), F.col(do).isin(*airports)
    from_island, to_island = flag(F.col(pu).between(*manhattan)), flag(F.col(do).between(*manhattan))
    return df.withColumns(
        {
            "is_airport_pickup": flag(from_airport),
            "is_airport_dropoff": flag(to_airport),
            "is_airport_trip": flag(from_airport | to_airport),
            "is_manhattan_pickup": from_island,
            "is_manhattan_dropoff": to_island,
            "is_cross_borough": flag(from_island != to_island),
        }
    )


def payment_flags(df: DataFrame, col: str = "payment_type") -> DataFrame:
    return df.withColumns(
        {
            "is_credit_card": flag(F.col(col) == trip.CREDIT_CARD),
            "is_cash": flag(F.col(col) == trip.CASH),
        }
    )


def tip_percentage(
    df: DataFrame, tip: str = "tip_amount", fare: str = "fare_amount", out: str = "tip_percentage"
) -> DataFrame:
    return df.withColumn(out, ratio_or_zero(F.col(tip), F.col(fare), 100.0))


def model_features(df: DataFrame) -> DataFrame:
    """Every column the default feature vector needs; expects ``trip_duration_minutes``."""
    for step in (time_features, location_features, clamped_speed, payment_flags):
        df = df.transform(step)
    return df
