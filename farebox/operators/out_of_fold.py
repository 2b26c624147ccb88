"""Group averages for the rows they were made from, without a row's own part in them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.functions.numeric import whole_units
from farebox.operators.group_stats import BROADCAST_BYTES, ROW_OVERHEAD, ROWS, GroupTable, lookup_join
from farebox.operators.sampling import with_fold
from farebox.sources.scratch import cut_lineage

_FOLD, _CELL = "_fold", "_cell"


@dataclass(frozen=True)
class Average:
    """The mean of ``col`` as ``out``; with ``per_unit`` exact, as by ``functions.numeric.mean``."""

    col: str
    out: str
    per_unit: int | None = None

    @property
    def total(self) -> Column:
        if self.per_unit is None:
            return F.sum(F.col(self.col).cast("double"))
        return F.sum(whole_units(self.col, self.per_unit).cast("decimal(28,0)"))

    def of(self, total: Column, count: Column) -> Column:
        return F.try_divide(total.cast("double"), count.cast("double")) / F.lit(float(self.per_unit or 1))


@dataclass(frozen=True)
class Rows:
    """The number of rows as ``out``."""

    out: str


#: Vendor, hour and payment-type averages of fare, distance and tip, and trips per hour.
DEFAULT_AVERAGES: dict[str, tuple[Average | Rows, ...]] = {
    "VendorID": (
        Average("fare_amount", "vendor_avg_fare"), Average("trip_distance", "vendor_avg_distance"), Average("tip_amount", "vendor_avg_tip"),
    ),
    "pickup_hour": (
        Average("fare_amount", "hour_avg_fare"), Average("trip_distance", "hour_avg_distance"), Rows("hour_trip_count"),
    ),
    "payment_type": (Average("tip_percentage", "payment_avg_tip_pct"),),
}


@dataclass(frozen=True)
class OutOfFold:
    """Statistics of every key by fold. ``own``: for training rows, by key and the row's fold, made of the
    other folds; ``all``: for any other rows, by key, made of all folds."""

    own: dict[str, GroupTable]
    all: dict[str, GroupTable]
    id_col: str | Sequence[str]
    folds: int
    seed: int
    method: str

    def training_features(self, train: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, **join: object) -> DataFrame:
        """Left join onto the rows that were fitted; a null key, or one known from the row's own fold
        alone, gets null averages and a count of 0 or null."""
        rows = with_fold(train, self.id_col, self.folds, self.seed, _FOLD, self.method)
        for key, table in self.own.items():
            cell = F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("key"), F.col(_FOLD).alias("fold")))
            rows = lookup_join(rows.withColumn(_CELL, cell), table, broadcast_bytes, **join).drop(_CELL)
        return rows.drop(_FOLD)

    def features(self, df: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, **join: object) -> DataFrame:
        """Left join of the statistics of all folds, for rows that were not fitted."""
        for table in self.all.values():
            df = lookup_join(df, table, broadcast_bytes, **join)
        return df


def fit_out_of_fold(
    train: DataFrame,
    specs: Mapping[str, Sequence[Average | Rows]] | None = None,
    id_col: str | Sequence[str] = "trip_id",
    folds: int = 5,
    seed: int = 42,
    method: str = "xxhash64",
) -> OutOfFold:
    """Statistics of each key over the folds that a row is not in, in one aggregation by key and fold.

    An average over all rows holds the row's own label, which a model then finds again in its own
    input. Sums and counts can be taken apart: what the row's fold adds is subtracted from the total of
    its key. Folds hash the row id, so a row is in the same one when it is joined.
    """
    specs = dict(specs or DEFAULT_AVERAGES)
    keys = list(specs)
    averages = {a.out: a for key in keys for a in specs[key] if isinstance(a, Average)}
    folded = with_fold(train, id_col, folds, seed, _FOLD, method)
    cells = cut_lineage(
        folded.groupingSets([[k, _FOLD] for k in keys], *keys, _FOLD).agg(
            F.grouping_id().alias("_set"), F.count(F.lit(1)).alias(ROWS),
            *[a.total.alias(f"_sum_{o}") for o, a in averages.items()], *[F.count(a.col).alias(f"_n_{o}") for o, a in averages.items()],
        )
    )
    own, whole = {}, {}
    for i, key in enumerate(keys):
        # grouping_id has one bit per column, the fold's last; the bits of the grouped ones are 0
        grouped = ((1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i))) << 1
        mine = cells.where((F.col("_set") == grouped) & F.col(key).isNotNull())
        measured = [a for a in specs[key] if isinstance(a, Average)]
        sums = [c for a in measured for c in (f"_sum_{a.out}", f"_n_{a.out}")]
        by_key = Window.partitionBy(key)  # as many rows as folds

        def stats(total: Mapping[str, Column]) -> list[Column]:
            return [
                a.of(total[f"_sum_{a.out}"], total[f"_n_{a.out}"]).alias(a.out) if isinstance(a, Average) else total[ROWS].alias(a.out)
                for a in specs[key]
            ]

        totals = mine.groupBy(key).agg(*[F.sum(c).alias(c) for c in (*sums, ROWS)])
        whole[key] = _table(key, totals.select(key, *stats({c: F.col(c) for c in (*sums, ROWS)}), ROWS))
        rest = {c: F.sum(c).over(by_key) - F.coalesce(F.col(c), F.lit(0)) for c in (*sums, ROWS)}
        cell = F.struct(F.col(key).alias("key"), F.col(_FOLD).alias("fold")).alias(_CELL)
        own[key] = _table(_CELL, mine.select(cell, *stats(rest), ROWS))
    return OutOfFold(own, whole, id_col, folds, seed, method)


def _table(key: str, stats: DataFrame) -> GroupTable:
    stored = cut_lineage(stats)
    value = F.octet_length(F.to_json(F.struct(key))) + 8 * (len(stats.columns) - 2)
    seen = stored.agg(F.count(F.lit(1)).alias("groups"), F.sum(value).alias("bytes"), F.sum(ROWS).alias("rows")).first()
    return GroupTable(key, stored, seen.groups, (seen["bytes"] or 0) + seen.groups * ROW_OVERHEAD, seen["rows"] or 0)
