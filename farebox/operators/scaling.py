"""Partition profiles and scoped persistence."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.sources.scratch import cut_lineage


def spread(df: DataFrame, partitions: int, *cols: str) -> DataFrame:
    """Deal rows to ``partitions``, hashed by ``cols`` or evenly without them: a full shuffle.

    For small tables in front of work that costs far more CPU than its rows cost bytes
    (resampling, tree fits). Whether a table is small is the caller's to know; nothing is read to
    find out.
    """
    return df.repartition(partitions, *cols)


def partition_sizes(df: DataFrame) -> DataFrame:
    """One row per partition, empty ones included: pid, rows.

    ``df`` runs once: a partition id a row is written, in the partitions of ``df``, empty ones included.
    They are counted from there, combined map-side.
    """
    placed = cut_lineage(df.select(F.spark_partition_id().alias("pid")))
    counts = placed.groupBy("pid").agg(F.count(F.lit(1)).alias("rows"))
    # a checkpoint knows its partitions, so this runs nothing
    numbers = df.sparkSession.range(placed.rdd.getNumPartitions()).select(F.col("id").cast("int").alias("pid"))
    return numbers.join(counts, "pid", "left").select("pid", F.coalesce("rows", F.lit(0)).alias("rows"))


def partition_profile(df: DataFrame) -> DataFrame:
    """One row: partitions, rows, and average, least, most and spread of rows per partition."""
    return partition_sizes(df).agg(
        F.count("rows").alias("partitions"),
        F.sum("rows").alias("records"),
        F.avg("rows").alias("avg_size"),
        F.min("rows").alias("min_size"),
        F.max("rows").alias("max_size"),
        F.stddev("rows").alias("stddev_size"),
    )


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist ``df`` for the length of a with-block, e.g. around iterative fits."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def storage_report(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Fill the cache, count through it, and report the level it was held at, as one row."""
    with persisted(df, level) as held:
        records, cached, at = held.count(), held.is_cached, held.storageLevel
    return df.sparkSession.createDataFrame(
        [(records, cached, at.useMemory, at.useDisk, at.replication)],
        "records bigint, is_cached boolean, use_memory boolean, use_disk boolean, replication int",
    )
