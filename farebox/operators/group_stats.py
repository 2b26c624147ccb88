"""Per-group averages fitted on one table and joined onto another."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions.numeric import mean
from farebox.sources.scratch import cut_lineage

ROWS = "_rows"
BROADCAST_BYTES = 32 << 20
ROW_OVERHEAD = 64  # bytes of a hashed row beside its values
HOT_SHARE = 1 / 64
HOT_SALTS = 1024


def default_specs(per_unit: Mapping[str, int] | None = None) -> dict[str, list[Column]]:
    """Vendor, hour and payment-type averages of fare, distance and tip."""
    unit = dict(per_unit or {})

    def avg(col: str, out: str) -> Column:
        return mean(col, unit.get(col)).alias(out)

    return {
        "VendorID": [
            avg("fare_amount", "vendor_avg_fare"),
            avg("trip_distance", "vendor_avg_distance"),
            avg("tip_amount", "vendor_avg_tip"),
        ],
        "pickup_hour": [
            avg("fare_amount", "hour_avg_fare"),
            avg("trip_distance", "hour_avg_distance"),
            F.count(F.lit(1)).alias("hour_trip_count"),
        ],
        "payment_type": [avg("tip_percentage", "payment_avg_tip_pct")],
    }


@dataclass(frozen=True)
class GroupTable:
    """The statistics of one key: one row per key value, and how large that is."""

    key: str
    stats: DataFrame
    groups: int
    size_bytes: int
    trained_rows: int


def group_stats(df: DataFrame, key: str, aggregates: Sequence[Column]) -> DataFrame:
    """One row per key value; map-side partial aggregation keeps hot keys cheap."""
    return df.groupBy(key).agg(*aggregates)


def fit_group_stats(
    train: DataFrame, specs: Mapping[str, Sequence[Column]] | None = None
) -> dict[str, GroupTable]:
    """Compute the statistics of every key in one scan of ``train`` and materialise them.

    Fit on the training side only: averages of the target over test rows would leak it.
    The result is written to the shared checkpoint folder, so its size is known before any
    join and applying it never rescans ``train``.
    """
    specs = dict(specs or default_specs())
    keys = list(specs)
    everything = [a for aggregates in specs.values() for a in aggregates]
    fitted = cut_lineage(
        train.groupingSets([[k] for k in keys], *keys).agg(
            F.grouping_id().alias("_set"), F.count(F.lit(1)).alias(ROWS), *everything
        )
    )
    measured = reduce(Column.__add__, [_value_bytes(f) for f in fitted.schema.fields if f.name not in ("_set", ROWS)])
    sizes = {
        r["_set"]: r
        for r in fitted.groupBy("_set")
        .agg(
            F.count(F.lit(1)).alias("groups"),
            F.sum(measured).alias("value_bytes"),
            F.sum(ROWS).alias("trained"),
        )
        .collect()  # one row per key column
    }
    tables = {}
    for i, key in enumerate(keys):
        # grouping_id has one bit per key, first key highest; the bit of the grouped key is 0
        set_id = (1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i))
        names = train.groupBy(key).agg(*specs[key]).columns
        size = sizes.get(set_id)
        groups = size["groups"] if size else 0
        tables[key] = GroupTable(
            key=key,
            stats=fitted.filter(F.col("_set") == set_id).select(*names, ROWS),
            groups=groups,
            size_bytes=(size["value_bytes"] if size else 0) + groups * ROW_OVERHEAD,
            trained_rows=size["trained"] if size else 0,
        )
    return tables


def _value_bytes(field: T.StructField) -> Column:
    """Bytes of a value: 8 for a fixed-width one, else the length of its text."""
    value = F.col(field.name)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(value)))
    else:
        size = F.lit(16 if isinstance(field.dataType, T.DecimalType) else 8)
    return F.coalesce(size, F.lit(0)) + 8


def _salt(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(HOT_SALTS))


def lookup_join(
    df: DataFrame,
    table: GroupTable,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
    salt_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Left join of a statistics table onto ``df``; a null or unseen key gets null statistics.

    A table of at most ``broadcast_bytes`` is broadcast. A larger one is joined by shuffle,
    except for the keys that hold more than ``hot_share`` of the rows of either side: there are
    fewer than 2/hot_share of them, so those few are broadcast, and the rows that carry them (or a
    null) are spread over salts instead of meeting in one task. Finding those of ``df`` takes a
    count of its key column, written to the checkpoint folder. The salt hashes ``salt_cols`` (a row
    id is enough; by default every column, which then are all read).
    """
    key = table.key
    names = [c for c in table.stats.columns if c not in (key, ROWS)]
    if table.size_bytes <= broadcast_bytes:
        return df.join(F.broadcast(table.stats.drop(ROWS)), key, "left")

    counts = cut_lineage(df.groupBy(key).agg(F.count(F.lit(1)).alias(ROWS)))
    rows = counts.agg(F.sum(ROWS)).first()[0] or 0
    trained_hot = table.stats.filter(F.col(ROWS) > F.lit(hot_share * table.trained_rows)).select(key)
    own_hot = counts.filter(F.col(ROWS) > F.lit(hot_share * rows)).select(key)
    hot_keys = F.broadcast(trained_hot.union(own_hot).filter(F.col(key).isNotNull()).distinct())
    held = hot_keys.join(table.stats.drop(ROWS), key, "left")
    width = reduce(Column.__add__, [_value_bytes(f) for f in table.stats.schema.fields if f.name in names], F.lit(0))
    if (held.agg(F.sum(width)).first()[0] or 0) > max(broadcast_bytes, BROADCAST_BYTES):
        # few keys, but of long texts or arrays: a plain join, whose large keys adaptive execution splits
        return df.join(table.stats.drop(ROWS), key, "left").select(key, *[c for c in df.columns if c != key], *names)
    hot = held.select(key, *[F.col(n).alias(f"_hot_{n}") for n in names], F.lit(True).alias("_hot"))
    cold = table.stats.filter(F.col(key).isNotNull()).join(hot_keys, key, "left_anti").select(
        F.col(key).alias("_key"),
        _salt(key).alias("_key_salt"),
        *[F.col(n).alias(f"_cold_{n}") for n in names],
    )
    columns = df.columns
    # a cold row's salt follows from its key, so it meets its statistics; a constant would not
    # do, because the optimizer takes a constant out of the shuffle keys
    salted = df.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(key).isNull(), _salt(*(salt_cols or columns))).otherwise(_salt(key))
    )
    match = (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_key_salt"))
    merged = [F.coalesce(F.col(f"_hot_{n}"), F.col(f"_cold_{n}")).alias(n) for n in names]
    rest = [c for c in columns if c != key]
    return salted.join(cold, match, "left").select(key, *rest, *merged)


def apply_group_stats(
    df: DataFrame, tables: Mapping[str, GroupTable], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    for table in tables.values():
        df = lookup_join(df, table, broadcast_bytes)
    return df


def aggregated_features(df: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """Fit the default statistics (on ``train``, or on ``df`` itself) and join them onto ``df``."""
    return apply_group_stats(df, fit_group_stats(df if train is None else train))
