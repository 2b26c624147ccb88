"""Layer, result and report sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation

from farebox.schema import PARTITION_COLS


def write_layer(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = PARTITION_COLS,
    mode: str = "overwrite",
    rebalance: bool = False,
    replace_months_only: bool = False,
    metrics: Sequence[Column] = (),
) -> dict[str, object]:
    """Write Parquet partitioned by ``partition_cols``.

    Monthly inputs already arrive grouped by month, so nothing is shuffled by default. For
    mixed inputs ``rebalance`` asks adaptive execution to gather each month into files of the
    advisory size, splitting a month that holds too many rows for one task.
    ``replace_months_only`` overwrites just the partitions present in ``df``. ``metrics`` are aggregates
    over the written rows, returned by name; they are taken in the writing tasks themselves,
    behind the rebalancing shuffle, where each partition counts once however often it was tried.
    """
    overwrite = "dynamic" if replace_months_only else "static"
    gathered = df.hint("rebalance", *partition_cols) if rebalance else df
    seen = Observation()
    if metrics:
        gathered = gathered.observe(seen, *metrics)
    gathered.write.option("partitionOverwriteMode", overwrite).parquet(path, mode, list(partition_cols) or None)
    return dict(seen.get) if metrics else {}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a result table as CSV with a header, one part file per task."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a report table as JSON lines; nested structs and arrays stay nested."""
    df.write.mode(mode).json(path)
