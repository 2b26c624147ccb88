"""Places in a total order, by range partitions instead of one sorting task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.sources.scratch import cut_lineage

_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id counts a partition's rows in these


def with_rank(df: DataFrame, order: Sequence[str | Column], out: str = "rank", partitions: int | None = None) -> DataFrame:
    """Add the place, from 0, of each row in ``order``; of rows that tie entirely any may come first.

    ``row_number`` over all rows would send them to one task. Here ranges of the order are
    sorted apart and written; one count per range, all that the driver sees, tells where each begins.
    The order should tell rows apart: rows that tie in all of it share a range, however many.
    """
    wanted = [F.col(c) if isinstance(c, str) else c for c in order]
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = df.repartitionByRange(parts, *wanted).sortWithinPartitions(*wanted)
    placed = cut_lineage(sorted_.withColumns({
        "_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(_ROW_BITS)
    }))
    sizes = {r["_range"]: r["count"] for r in placed.groupBy("_range").count().collect()}
    starts, before = [], 0
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    begins = df.sparkSession.createDataFrame(starts, "_range int, _before long")
    ranked = placed.join(F.broadcast(begins), "_range")
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_place")).alias(out))
