"""Casts, lineage columns and projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.schema import ANALYSIS_COLS, GOLD_COLS, ID_COLS


def widen_integers(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cast integer columns (all of them, or ``cols`` of any type) to long, keeping their order."""
    def widened(field: T.StructField) -> Column:
        hit = isinstance(field.dataType, T.IntegerType) if cols is None else field.name in cols
        return F.col(field.name).cast("bigint") if hit else F.col(field.name)

    return df.select(*[widened(f).alias(f.name) for f in df.schema.fields])


def narrow_ids(df: DataFrame, cols: Sequence[str] = ID_COLS) -> DataFrame:
    """Cast id columns to int; values that do not fit become null instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast("int") for c in cols})


def add_bronze_lineage(
    df: DataFrame,
    ingested_at: datetime | Column | None = None,
    source: str | Column | None = None,
    ts: str = "tpep_pickup_datetime",
) -> DataFrame:
    """Stamp ingestion time, source, and the pickup's year and month.

    ``ingested_at`` is one value for the whole batch (default: the query's start time).
    ``source`` is a fixed label or a column; without it each row carries the path of the file it
    came from, which needs ``df`` to sit directly on a file scan.
    """
    if ingested_at is None:
        ingested_at = F.current_timestamp()
    elif not isinstance(ingested_at, Column):
        ingested_at = F.lit(ingested_at)
    if source is None:
        source = F.col("_metadata.file_path")
    elif not isinstance(source, Column):
        source = F.lit(source)
    return df.withColumns(
        {
            "ingestion_timestamp": ingested_at,
            "source_file": source,
            "data_year": F.year(ts),
            "data_month": F.month(ts),
        }
    )


def add_silver_lineage(
    df: DataFrame, cleaned_at: datetime | Column | None = None, flag: str | Column = "clean"
) -> DataFrame:
    if cleaned_at is None:
        cleaned_at = F.current_timestamp()
    elif not isinstance(cleaned_at, Column):
        cleaned_at = F.lit(cleaned_at)
    return df.withColumns({"silver_timestamp": cleaned_at, "data_quality_flag": flag if isinstance(flag, Column) else F.lit(flag)})


def gold_projection(df: DataFrame, with_pickup_time: bool = True) -> DataFrame:
    """The gold columns, in order; without the pickup time there are eleven of them."""
    return df.select(*[c for c in GOLD_COLS if with_pickup_time or c != "tpep_pickup_datetime"])


def select_final(
    df: DataFrame,
    id_cols: Sequence[str] = (),
    target: str = "fare_amount",
    extra: Sequence[str] = ANALYSIS_COLS,
) -> DataFrame:
    """Ids, ``features``, the target, then those of ``extra`` that exist and are not yet chosen."""
    chosen = [*id_cols, "features", target]
    chosen += [c for c in extra if c in df.columns and c not in chosen]
    return df.select(*chosen)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def preview(
    df: DataFrame, cols: Sequence[str] | None = None, order_by: Sequence[str] = (), n: int = 10
) -> DataFrame:
    """The first ``n`` rows of some columns; with ``order_by`` always the same ones."""
    if order_by:
        df = df.orderBy(*order_by)
    out = df.select(*cols) if cols else df
    return out.limit(n)


def slot_names(df: DataFrame, vector_col: str) -> list[str]:
    """Names of a vector column's slots, one per slot, from the column's ML attributes."""
    meta = df.schema[vector_col].metadata.get("ml_attr", {})
    slots = [a for group in meta.get("attrs", {}).values() for a in group]
    if slots:
        return [a.get("name", f"{vector_col}_{a['idx']}") for a in sorted(slots, key=lambda a: a["idx"])]
    return [f"{vector_col}_{i}" for i in range(meta.get("num_attrs", 0))]
