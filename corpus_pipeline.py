"""The corpus pipeline over ``documents``: each stage's rows are written and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm.bitmap import part_by_ids
from farebox.llm.decontaminate import without_contaminated
from farebox.llm.near_dedup import near_duplicates
from farebox.llm.packing import pack
from farebox.llm.quality import without_low_quality
from farebox.llm.substring_dedup import without_repeats
from farebox.sources.scratch import cut_lineage, scratch_path

#: No SQL twin: the classifier's decisions cannot be written as SQL. Tests compare with brute force.
ORACLE_SQL = None


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier scores below 0.5 go."""
    return without_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, that of the smallest doc_id.

    Of rows that repeat a doc_id one stays; rows with a null doc_id all do.
    """
    judged = near_duplicates(docs).where("doc_id IS NOT NULL").groupBy("doc_id")
    touched = judged.agg(F.bool_or("kept").alias("kept"), F.count("*").alias("rows")).where("NOT kept OR rows > 1")
    touched = cut_lineage(touched.select("doc_id", "kept"))
    maybe, others = part_by_ids(docs, "doc_id", touched, "doc_id")
    # names of their own for all columns, whatever those of the rows are
    key, names = "c" + str(docs.columns.index("doc_id")), [f"c{i}" for i in range(len(docs.columns))]
    joined = maybe.toDF(*names).join(touched, F.col(key) == F.col("doc_id"), "left")
    single = joined.where("kept IS NULL").select(names)
    repeated = joined.where("kept").dropDuplicates([key]).select(names)
    return others.unionByName(single.unionByName(repeated).toDF(*docs.columns))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur more than once are cut from the texts; n_chars follows. Rows stay."""
    return without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed into sequences."""
    return pack(docs)


STAGES = [
    ("quality", reject_low_quality),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontaminate", drop_contaminated),
    ("pack", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; the last stage's result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
