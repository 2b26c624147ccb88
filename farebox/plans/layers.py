"""Bronze, silver and gold tables as lazy plans, and the jobs that write them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.ml.prep import feature_pipeline, to_gold
from farebox.operators.columns import add_bronze_lineage, add_silver_lineage, gold_projection, narrow_ids
from farebox.operators.features import model_features, with_duration
from farebox.operators.quality import (
    RuleSet,
    apply_rules,
    complete_rules,
    impute_rules,
    judged,
    quarantine,
    reason_counts,
    removals,
)
from farebox.operators.sampling import hash_split
from farebox.schema import FEATURES_13, PARTITION_COLS
from farebox.sources.readers import read_trip_files
from farebox.sources.writers import write_layer

REASON = "reject_reason"


def bronze(
    raw: DataFrame, ingested_at: datetime | Column | None = None, source: str | Column | None = None
) -> DataFrame:
    return add_bronze_lineage(narrow_ids(raw), ingested_at, source)


def silver(
    bronze_rows: DataFrame, rules: RuleSet | None = None, cleaned_at: datetime | Column | None = None
) -> DataFrame:
    cleaned = apply_rules(with_duration(bronze_rows), rules or impute_rules())
    return add_silver_lineage(cleaned, cleaned_at)


class Gold(NamedTuple):
    rows: DataFrame
    features: PipelineModel
    rejects: DataFrame


def gold(
    silver_rows: DataFrame, id_col: str | Sequence[str], ratio: float = 0.8, seed: int = 42, method: str = "xxhash64"
) -> Gold:
    """Features for all rows that have every input, with the scaler fitted on the training side of
    the hash split, and the others as rejects with their reason.

    The id columns stay in front of the gold columns so that later steps can repeat the split.
    """
    complete, rejects = quarantine(model_features(silver_rows), complete_rules(FEATURES_13))
    return Gold(*_scaled(complete, id_col, ratio, seed, method), rejects)


def _scaled(
    complete: DataFrame, id_col: str | Sequence[str], ratio: float, seed: int, method: str
) -> tuple[DataFrame, PipelineModel]:
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    train, _ = hash_split(complete, ids, ratio, seed, method)
    fitted = feature_pipeline().fit(train)
    ready = to_gold(fitted.transform(complete))
    columns = gold_projection(ready).columns
    return ready.select(*[c for c in ids if c not in columns], *columns), fitted


class Split(NamedTuple):
    """A judged table as it was stored: good rows, rejects with their reason, and the counts of the write."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def write_split(df: DataFrame, rules: RuleSet, path: str) -> Split:
    """Judge and write ``df`` once: partitioned by reject reason first and then by month.

    Good rows are in the partition without a reason, so reading either side opens only its own
    files. Rows are counted by reason in the tasks that write them.
    """
    counts = write_layer(df, path, (REASON, *PARTITION_COLS), rebalance=True, metrics=reason_counts(rules, REASON))
    stored = df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
    return Split(stored.where(F.col(REASON).isNull()).drop(REASON), stored.where(F.col(REASON).isNotNull()), counts)


class Layers(NamedTuple):
    """The stored gold and silver tables, the fitted features, what each step set aside, and its counts."""

    rows: DataFrame
    features: PipelineModel
    silver: DataFrame
    silver_rejects: DataFrame
    gold_rejects: DataFrame
    removals: DataFrame


def run_layers(
    spark: SparkSession,
    raw_paths: Sequence[str],
    out: str,
    id_col: str | Sequence[str],
    source: str | None = None,
    at: datetime | None = None,
    rules: RuleSet | None = None,
    method: str = "xxhash64",
) -> Layers:
    """Read raw months, write all layers below ``out`` and return the stored tables.

    Every layer is judged and scanned once: ``silver`` and ``gold_inputs`` hold good rows and rejects, divided by
    the partition ``reject_reason`` (``write_split``), and their counts make up ``removals``. Good and
    rejected silver rows together are the rows of ``bronze``, ``gold`` and the gold rejects those of good silver; a
    reject carries the first rule it breaks. ``source`` labels the whole batch; without it every row
    keeps the path of its raw file. Each layer is gathered by month and read back from its files, so a
    lost executor repeats work of one layer only; the scaler reads ``gold_inputs``.
    """
    cleaning, inputs = rules or impute_rules(), complete_rules(FEATURES_13)

    def stored(df: DataFrame, name: str) -> DataFrame:
        write_layer(df, f"{out}/{name}", rebalance=True)
        return spark.read.schema(df.schema).parquet(f"{out}/{name}")

    raw = read_trip_files(spark, raw_paths, source_col="source_file")
    bronze_rows = stored(bronze(raw, at, source or F.col("source_file")), "bronze")
    flag = F.when(F.col(REASON).isNull(), "clean").otherwise("rejected")
    cleaned = add_silver_lineage(judged(with_duration(bronze_rows), cleaning, REASON), at, flag)
    silver_split = write_split(cleaned, cleaning, f"{out}/silver")
    ready = write_split(judged(model_features(silver_split.rows), inputs, REASON), inputs, f"{out}/gold_inputs")
    rows, fitted = _scaled(ready.rows, id_col, 0.8, 42, method)
    report = removals(spark, {"silver": silver_split.counts, "gold": ready.counts})
    return Layers(stored(rows, "gold"), fitted, silver_split.rows, silver_split.rejects, ready.rejects, report)
