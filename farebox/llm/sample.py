"""The first rows by a hash, without sending that many from every task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by_hash(ids: DataFrame, col: str, wanted: int, total: int, seed: int) -> DataFrame:
    """The ``wanted`` smallest of the distinct ``col`` values of ``ids`` by hash, about ``total`` in all.

    Hashes above twice the share that is wanted are left out first, so that the sort sees about
    twice ``wanted`` values and not that many of each task. The share has room for chance; if it
    should still hold too few, fewer are returned.
    """
    draw = F.xxhash64(F.col(col), F.lit(seed))
    share = min(1.0, 2.0 * (wanted + 50) / max(1, total))
    cut = int(-(1 << 63) + share * ((1 << 64) - 1))
    near = ids.where(F.col(col).isNotNull() & (draw <= F.lit(min(cut, (1 << 63) - 1)))).select(col).distinct()
    return near.orderBy(draw, col).limit(wanted)
