"""Counts, sums and squared deviations per month and key, kept so that months can be merged without being read again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farebox.functions.numeric import whole_units
from farebox.operators.group_stats import ROW_OVERHEAD, ROWS, GroupTable
from farebox.schema import PARTITION_COLS
from farebox.sources.scratch import cut_lineage
from farebox.sources.writers import write_layer

#: The key name of the rows that stand for a whole month.
EVERY = ""
Values = Mapping[str, int | None]


def month_moments(df: DataFrame, values: Values, keys: Sequence[str] = (), months: Sequence[str] = PARTITION_COLS) -> DataFrame:
    """One row per month, key value and column: the months, key, key_value, column, rows, n, units, mean, m2.

    ``values`` maps columns to their units per 1 (100 for money in cents) or None. n counts non-null
    values, ``units`` is their exact sum in such units (null without), ``m2`` the sum of squared differences
    from ``mean``. All keys, and the months as a whole (key "", no value), come from one scan (grouping sets).
    Key values are kept as text; a null one stays null.
    """
    sets = [[*months], *([*months, k] for k in keys)]
    aggregates: list[Column] = [F.count(F.lit(1)).alias(ROWS)]
    for i, (col, per_unit) in enumerate(values.items()):
        value = F.col(col).cast("double")
        units = F.sum(whole_units(col, per_unit).cast("decimal(28,0)")) if per_unit else F.lit(None)
        aggregates += [
            F.count(value).alias(f"_n{i}"), units.cast("decimal(38,0)").alias(f"_u{i}"), F.avg(value).alias(f"_a{i}"),
            (F.var_pop(value) * F.count(value)).alias(f"_v{i}"),
        ]
    grouped = df.groupingSets(sets, *months, *keys).agg(F.grouping_id().alias("_set"), *aggregates)
    every = (1 << len(keys)) - 1  # grouping_id has a bit per column, the months' (always 0) first
    name, value = F.when(F.col("_set") == every, EVERY), F.lit(None).cast("string")
    for i, key in enumerate(keys):
        grouped_here = F.col("_set") == every - (1 << (len(keys) - 1 - i))
        name, value = name.when(grouped_here, key), F.when(grouped_here, F.col(key).cast("string")).otherwise(value)
    parts = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("n"), F.col(f"_u{i}").alias("units"),
                 F.col(f"_a{i}").alias("mean"), F.col(f"_v{i}").alias("m2")) for i, c in enumerate(values)
    ])
    return grouped.select(*months, name.alias("key"), value.alias("key_value"), F.col(ROWS).alias("rows"), F.inline(parts))


def update_store(
    df: DataFrame, path: str, values: Values, keys: Sequence[str] = (), months: Sequence[str] = PARTITION_COLS
) -> None:
    """Put the months that ``df`` holds into the store at ``path``; those already there are replaced.

    ``df`` must hold these months whole. Other months are neither read nor written.
    """
    write_layer(month_moments(df, values, keys, months), path, months, rebalance=True, replace_months_only=True)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Every month of a store; filter by month to merge some of them."""
    return spark.read.parquet(path)


def merged(store: DataFrame, values: Values) -> DataFrame:
    """One row per key, key value and column over all months of ``store``: rows, n, mean, std (of a sample).

    The mean of a column with units is exact, so it is the same however months were cut. Deviations
    are put together from those of the months and the distances of their means, which loses no digits to
    differences of large squares.
    """
    group = ["key", "key_value", "column"]
    together = Window.partitionBy(*group)  # one row per month
    whole = store.withColumns({
        "total": F.sum("n").over(together), "middle": F.try_divide(F.sum(F.col("n") * F.col("mean")).over(together), F.sum("n").over(together))
    })
    apart = F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("middle"), 2)
    per_unit = F.create_map(*[F.lit(x) for c, u in values.items() for x in (c, float(u or 0))])[F.col("column")]
    sums = whole.groupBy(*group).agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum("units").alias("units"), F.first("middle").alias("middle"), F.sum(apart).alias("m2")
    )
    exact = F.try_divide(F.col("units").cast("double"), F.col("n").cast("double")) / per_unit
    return sums.select(
        *group, "rows", "n", F.when(per_unit > 0, exact).otherwise(F.col("middle")).alias("mean"),
        F.sqrt(F.try_divide("m2", (F.col("n") - 1).cast("double"))).alias("std"),
    )


def scaler_moments(store: DataFrame, values: Values) -> dict[str, tuple[float, float]]:
    """Mean and deviation of every column over all months, as ``CategoryFeatures`` takes them."""
    rows = merged(store.where(F.col("key") == EVERY), values).collect()  # one per column
    return {r["column"]: (r["mean"] or 0.0, r["std"] or 0.0) for r in rows}


def group_table(store: DataFrame, values: Values, key: str, key_type: str, out: Mapping[str, str]) -> GroupTable:
    """Averages of ``key`` over all months, ready for ``lookup_join``; ``out`` names the average of each column."""
    rows = merged(store.where((F.col("key") == key) & F.col("column").isin(*out)), values)
    one = rows.groupBy(F.col("key_value").cast(key_type).alias(key)).agg(
        *[F.max(F.when(F.col("column") == c, F.col("mean"))).alias(o) for c, o in out.items()], F.max("rows").alias(ROWS)
    )
    stored = cut_lineage(one)
    width = F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) + 8 * len(out)
    seen = stored.agg(F.count(F.lit(1)).alias("groups"), F.sum(width).alias("bytes"), F.sum(ROWS).alias("rows")).first()
    return GroupTable(key, stored, seen.groups, (seen["bytes"] or 0) + seen.groups * ROW_OVERHEAD, seen["rows"] or 0)
