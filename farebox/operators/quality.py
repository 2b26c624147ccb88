"""Declared data-quality rules: cleaning, quarantine and counting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Default thresholds.
THRESHOLDS = {
    "min_fare": 2.5,
    "max_fare": 500.0,
    "min_distance": 0.0,
    "max_distance": 100.0,
    "min_passengers": 1,
    "max_passengers": 6,
    "min_minutes": 1,
    "max_minutes": 180,
    "max_speed_mph": 80.0,
}


@dataclass(frozen=True)
class Rule:
    """A named condition that a good row fulfils; a null outcome counts as broken."""

    name: str
    predicate: Column

    @property
    def broken(self) -> Column:
        return ~F.coalesce(self.predicate, F.lit(False))


@dataclass(frozen=True)
class RuleSet:
    """Rules in order, and constants to fill into nulls of the rows that pass."""

    rules: Sequence[Rule]
    fill: Mapping[str, object] = field(default_factory=dict)


def _limits(thresholds: Mapping[str, float] | None) -> dict[str, float]:
    return {**THRESHOLDS, **(thresholds or {})}


def bounds_rules(thresholds: Mapping[str, float] | None = None) -> RuleSet:
    """Closed bounds on fare, distance and passengers; times present and in order."""
    t = _limits(thresholds)
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return RuleSet(
        [
            Rule("fare", F.col("fare_amount").between(t["min_fare"], t["max_fare"])),
            Rule("distance", F.col("trip_distance").between(t["min_distance"], t["max_distance"])),
            Rule("passengers", F.col("passenger_count").between(t["min_passengers"], t["max_passengers"])),
            Rule("pickup_time", pickup.isNotNull()),
            Rule("dropoff_time", dropoff.isNotNull()),
            Rule("time_order", dropoff > pickup),
            Rule("total", F.col("total_amount") > 0),
            Rule("tip", F.col("tip_amount") >= 0),
        ]
    )


def impute_rules(thresholds: Mapping[str, float] | None = None, passengers: int = 1) -> RuleSet:
    """Half-open bounds with a duration window; missing passengers pass and are filled in.

    Needs ``trip_duration_minutes``. The passenger rule is stated on the raw column so that
    the scan can still skip row groups with it.
    """
    t = _limits(thresholds)
    p = F.col("passenger_count")
    return RuleSet(
        [
            Rule("fare", (F.col("fare_amount") > 0) & (F.col("fare_amount") <= t["max_fare"])),
            Rule("distance", (F.col("trip_distance") > 0) & (F.col("trip_distance") <= t["max_distance"])),
            Rule("total", F.col("total_amount") > 0),
            Rule("duration", F.col("trip_duration_minutes").between(t["min_minutes"], t["max_minutes"])),
            Rule("passengers", p.isNull() | ((p > 0) & (p <= t["max_passengers"]))),
        ],
        fill={"passenger_count": passengers},
    )


def strict_rules(thresholds: Mapping[str, float] | None = None) -> RuleSet:
    """Open bounds on fare, distance and duration; passengers must be present.

    Needs ``trip_duration_minutes``.
    """
    t = _limits(thresholds)
    fare, miles = F.col("fare_amount"), F.col("trip_distance")
    minutes, p = F.col("trip_duration_minutes"), F.col("passenger_count")
    return RuleSet(
        [
            Rule("fare", (fare > 0) & (fare < t["max_fare"])),
            Rule("distance", (miles > 0) & (miles < t["max_distance"])),
            Rule("duration", (minutes > t["min_minutes"]) & (minutes < t["max_minutes"])),
            Rule("passengers", p.isNotNull() & (p > 0) & (p <= t["max_passengers"])),
        ]
    )


def speed_rule(max_mph: float = THRESHOLDS["max_speed_mph"], col: str = "speed_mph") -> RuleSet:
    return RuleSet([Rule("speed", F.col(col) <= max_mph)])


def complete_rules(cols: Sequence[str]) -> RuleSet:
    """Every column present and no NaN, one rule each, named ``null_<column>``."""
    return RuleSet([Rule(f"null_{c}", F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))) for c in cols])


def residual_faults() -> list[Rule]:
    """The four conditions that must hold in every cleaned row."""
    return [
        Rule("invalid_fare", ~(F.col("fare_amount") <= 0) | F.col("fare_amount").isNull()),
        Rule("invalid_distance", ~(F.col("trip_distance") <= 0) | F.col("trip_distance").isNull()),
        Rule("invalid_passengers", ~(F.col("passenger_count") <= 0) | F.col("passenger_count").isNull()),
        Rule("null_passengers", F.col("passenger_count").isNotNull()),
    ]


def impute(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Fill nulls with a constant per column, keeping each column's type."""
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in constants.items()}
    )


def apply_rules(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Keep the rows that fulfil every rule, then fill the declared nulls."""
    good = reduce(lambda d, rule: d.filter(rule.predicate), rules.rules, df)
    return impute(good, rules.fill) if rules.fill else good


def tag_rejects(df: DataFrame, rules: RuleSet, out: str = "reject_reason") -> DataFrame:
    """Add the name of the first broken rule, null for good rows.

    Writing the tagged table partitioned by this column separates good rows and rejects in one
    pass over the input.
    """
    first_broken = F.coalesce(*[F.when(rule.broken, F.lit(rule.name)) for rule in rules.rules])
    return df.withColumn(out, first_broken)


def judged(df: DataFrame, rules: RuleSet, out: str = "reject_reason") -> DataFrame:
    """All rows with the first rule they break, null for good ones, and the declared nulls of good ones filled."""
    tagged, types = tag_rejects(df, rules, out), dict(df.dtypes)
    good = F.col(out).isNull()
    return tagged.withColumns({
        c: F.when(good, F.coalesce(F.col(c), F.lit(v).cast(types[c]))).otherwise(F.col(c)) for c, v in rules.fill.items()
    }) if rules.fill else tagged


def reason_counts(rules: RuleSet, out: str = "reject_reason") -> list[Column]:
    """Aggregates over judged rows: ``records``, and how many each rule was the first to reject."""
    return [F.count(F.lit(1)).alias("records"), *[F.count_if(F.col(out) == r.name).alias(r.name) for r in rules.rules]]


def removals(spark: SparkSession, counts: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """The removal report of each step from its observed ``reason_counts``, without reading a row:
    step, records_before, records_after, records_removed, removal_pct, reasons (those that removed any)."""
    rows = []
    for step, seen in counts.items():
        before = seen["records"]
        reasons = {k: v for k, v in seen.items() if k != "records" and v}
        removed = sum(reasons.values())
        rows.append((step, before, before - removed, removed, removed / before * 100.0 if before else None, reasons))
    return spark.createDataFrame(
        rows, "step string, records_before long, records_after long, records_removed long, removal_pct double, reasons map<string,long>"
    )


def quarantine(df: DataFrame, rules: RuleSet) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with ``reject_reason``); together they are the whole input."""
    rejects = tag_rejects(df, rules).filter(F.col("reject_reason").isNotNull())
    return apply_rules(df, rules), rejects


def violation_counts(df: DataFrame, rules: RuleSet | Sequence[Rule]) -> DataFrame:
    """One row with the number of rows breaking each rule, counted in one pass."""
    listed = rules.rules if isinstance(rules, RuleSet) else rules
    return df.agg(*[F.count_if(rule.broken).alias(rule.name) for rule in listed])


def removal_report(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Rows before and after cleaning, removed rows and their percentage, in one pass."""
    passes = ~reduce(Column.__or__, [rule.broken for rule in rules.rules], F.lit(False))
    counts = df.agg(
        F.count(F.lit(1)).alias("records_before"), F.count_if(passes).alias("records_after")
    )
    removed = F.col("records_before") - F.col("records_after")
    return counts.select(
        "records_before",
        "records_after",
        removed.alias("records_removed"),
        (F.try_divide(removed, F.col("records_before")) * F.lit(100.0)).alias("removal_pct"),
    )
