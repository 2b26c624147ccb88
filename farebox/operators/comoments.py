"""Correlations of many columns from blocked co-moment matrices."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.sources.scratch import cut_lineage

BLOCK = 64  # columns of a block
ROWS = 4096  # rows that are multiplied at a time
CENTRE_ROWS = 1000
_STATE = "part long, block int, state binary"
_HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
COMPILED_BYTES = 8000  # bytecode of the largest method that HotSpot compiles


def _blocks(columns: int, width: int) -> list[tuple[int, int]]:
    """Pairs of column blocks, the second not before the first, in the order of their numbers."""
    starts = range(0, columns, width)
    return [(i, j) for i in starts for j in starts if j >= i]


def _moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(6, columns of x, columns of y): for each pair, over rows where both are present, n and the sums of x, y, xx, yy, xy."""
    here, there = (~np.isnan(a) for a in (x, y))
    u, v = np.where(here, x, 0.0), np.where(there, y, 0.0)
    a, b = here.astype(float), there.astype(float)
    if x is y:  # the sums of x are those of y turned round
        sums, squares = u.T @ a, (u * u).T @ a
        return np.stack([a.T @ a, sums, sums.T, squares, squares.T, u.T @ u])
    return np.stack([a.T @ b, u.T @ b, a.T @ v, (u * u).T @ b, a.T @ (v * v), u.T @ v])


def _gathered(columns: int, centre: Sequence[float], width: int = BLOCK):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _blocks(columns, width)
        state = [np.zeros((6, min(width, columns - i), min(width, columns - j))) for i, j in pairs]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                # a null becomes a NaN
                matrix = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns]) - np.array(centre)
                blocks = {i: matrix[:, i : i + width] for i in range(0, columns, width)}
                for total, (i, j) in zip(state, pairs):
                    total += _moments(blocks[i], blocks[j])
        yield _batch([(TaskContext.get().partitionId(), k, s) for k, s in enumerate(state)])

    return run


def _batch(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    part, block, state = zip(*rows) if rows else ((), (), ())
    columns = [pa.array(part, pa.int64()), pa.array(block, pa.int32()), pa.array([s.tobytes() for s in state], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["part", "block", "state"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, block) -> one row each, their states added; one state is held."""
    key, total = None, np.zeros(0)
    for batch in batches:
        for part, block, state in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            values = np.frombuffer(state.as_buffer(), dtype=float)
            if (part, block) == key:
                total = total + values
                continue
            if key is not None:
                yield _batch([(*key, total)])
            key, total = (part, block), values.copy()
    if key is not None:
        yield _batch([(*key, total)])


def _correlated(names: Sequence[str], width: int):
    """Whole states -> (a, b, n, r): both triangles and the diagonal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _blocks(len(names), width)
        for batch in batches:
            for block, state in zip(batch.column(1).to_pylist(), batch.column(2)):
                i, j = pairs[block]
                shape = 6, min(width, len(names) - i), min(width, len(names) - j)
                n, x, y, xx, yy, xy = np.frombuffer(state.as_buffer(), dtype=float).reshape(shape)
                with np.errstate(divide="ignore", invalid="ignore"):
                    r = (xy - x * y / n) / np.sqrt(np.maximum(xx - x * x / n, 0) * np.maximum(yy - y * y / n, 0))
                r = np.clip(r, -1, 1)
                one, other = np.meshgrid(range(i, i + shape[1]), range(j, j + shape[2]), indexing="ij")
                sides = [(one, other)] if i == j else [(one, other), (other, one)]
                for a, b in sides:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[k] for k in a.ravel()]), pa.array([names[k] for k in b.ravel()]),
                         pa.array(n.ravel().astype(np.int64)), pa.array(r.ravel(), mask=~np.isfinite(r.ravel()))],
                        ["a", "b", "n", "r"],
                    )

    return run


@contextmanager
def _compiled(spark: SparkSession) -> Iterator[None]:
    """What runs in the with-block splits generated methods that HotSpot would not compile.

    Dozens of computed columns make one method of whole-stage code that the JVM would interpret, row by row.
    """
    before = spark.conf.get(_HUGE_METHOD)
    spark.conf.set(_HUGE_METHOD, str(min(int(before), COMPILED_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(_HUGE_METHOD, before)


def wide_correlations(df: DataFrame, cols: Sequence[str], groups: int = 64, block: int = BLOCK) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows where both are present: a, b, n, r.

    For tens to thousands of columns, where one ``corr`` expression for each pair no longer makes a plan. Each
    task multiplies blocks of ``block`` columns and keeps sums for pairs of blocks, whatever its rows; sums of
    tasks are added in two steps, first within ``groups`` groups of tasks, and every pair of blocks
    is finished in a task of its own. Nulls and NaN are left out pair by pair. Values are taken from the
    means of some first rows, which keeps large offsets from costing digits. r is null if it is not defined. The
    sums of the groups are written, which runs ``df`` once.
    """
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    means = values.limit(CENTRE_ROWS).agg(*[F.avg(F.nanvl(f"x{i}", F.lit(None))) for i in range(len(cols))]).first()
    state = values.mapInArrow(_gathered(len(cols), [m or 0.0 for m in means], block), _STATE)
    near = state.withColumn("part", F.pmod("part", F.lit(groups))).repartition("part", "block").sortWithinPartitions("part", "block")
    with _compiled(df.sparkSession):
        some = cut_lineage(near.mapInArrow(_summed, _STATE).withColumn("part", F.lit(0).cast("long")))
    whole = some.repartition("block").sortWithinPartitions("block").mapInArrow(_summed, _STATE)
    return whole.mapInArrow(_correlated(list(cols), block), "a string, b string, n long, r double")
