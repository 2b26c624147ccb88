"""Session settings that the operators on texts need."""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH_BYTES = 8 << 20
_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB from now on in this session, unless it asks for smaller ones.

    A batch of texts exists in the JVM, in Arrow and in Python at once, and for each core; the default of
    64 MB is most of a small executor's memory beside the heap.
    """
    now = (spark.conf.get(_SETTING) or "").lower().removesuffix("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(_SETTING, str(BATCH_BYTES))
