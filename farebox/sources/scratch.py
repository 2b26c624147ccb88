"""A folder every executor can reach, for checkpoints and written intermediates."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_given: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one disk, may fall back to a new
    temporary folder; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="farebox-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder. ``clear_scratch`` deletes what is written there."""
    path = f"{shared_dir(spark).rstrip('/')}/farebox-{label}-{uuid.uuid4().hex}"
    _given.append(path)
    return path


def is_scratch(path: str) -> bool:
    """Whether ``path`` was given by ``scratch_path`` and not dropped since."""
    return path in _given


def clear_scratch(spark: SparkSession) -> None:
    """Delete what was written to all paths given so far; results that still read them end with it."""
    while _given:
        drop_scratch(spark, _given[-1])


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete what was written to paths of ``scratch_path``, once nothing reads them any more."""
    for name in paths:
        if name not in _given:
            raise ValueError(f"not a scratch path of this session: {name}")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _given.remove(name)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so lost executors never recompute its inputs."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
