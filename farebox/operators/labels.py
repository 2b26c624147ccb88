"""Indexes of categories as distributed tables, for columns of any number of labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.operators.group_stats import BROADCAST_BYTES, HOT_SHARE, ROWS, GroupTable, fit_group_stats, lookup_join
from farebox.operators.ranking import with_rank
from farebox.sources.scratch import cut_lineage

_INDEX = "_label_index"


@dataclass(frozen=True)
class Labels:
    """The labels of one column, most frequent first: a written table, and how many there are."""

    col: str
    table: GroupTable
    count: int


def fit_labels(train: DataFrame, cols: Sequence[str]) -> dict[str, Labels]:
    """Number the non-null values of each column by descending frequency, ties in ascending order.

    All columns are counted in one scan, combined map-side; the distinct labels are ranked by range
    partitions and written. No list of labels is ever on the driver, only their number.
    """
    if not cols:
        return {}
    counted = fit_group_stats(train.select(*cols), {c: [F.count(F.lit(1)).alias(f"_n_{i}")] for i, c in enumerate(cols)})
    out = {}
    for col, table in counted.items():
        known = table.stats.where(F.col(col).isNotNull()).select(col, ROWS)
        ranked = cut_lineage(with_rank(known, [F.col(ROWS).desc(), F.col(col)], _INDEX))
        out[col] = Labels(col, replace(table, stats=ranked.select(col, _INDEX, ROWS)), ranked.count())
    return out


def index_labels(
    df: DataFrame, labels: Labels, out: str, broadcast_bytes: int = BROADCAST_BYTES, hot_share: float = HOT_SHARE,
    salt_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Add each row's label number as a double; nulls and labels not fitted get the number after the last.

    A small table is broadcast, a larger one joined by shuffle with hot labels and nulls spread
    (``lookup_join``).
    """
    if out in df.columns:
        raise ValueError(f"column {out} exists")
    joined = lookup_join(df, labels.table, broadcast_bytes, hot_share, salt_cols)
    number = F.coalesce(F.col(_INDEX), F.lit(labels.count)).cast("double")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], number.alias(out))


def label_slots(labels: Mapping[str, Labels], first: int = 0) -> dict[str, int]:
    """The first one-hot slot of each column if slots start at ``first``; each has one more for the unknown."""
    starts = {}
    for col, known in labels.items():
        starts[col] = first
        first += known.count + 1
    return starts | {"": first}
