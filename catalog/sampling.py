"""Hash splits, samples, folds and the bootstrap."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.trips import FEATURED_SQL, SCORED_SQL, TRIPS_SQL, scored_trips, trips, uniform_sql
from farebox.functions.hashing import poisson_cuts
from farebox.operators import bootstrap, sampling
from farebox.operators.evaluate import with_residuals
from farebox.operators.reports import top_k
from farebox.operators.scaling import spread


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip with the side it falls on."""
    train, test = sampling.hash_split(trips(spark, sf_dir).select("trip_id"), "trip_id", method="md5")
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


SPLIT_SQL = f"""SELECT event_id AS trip_id, CASE WHEN {uniform_sql('event_id')} < 0.8e0 THEN 'train' ELSE 'test' END
  AS split FROM events"""


def split_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split sizes of the line items, which need several columns to tell rows apart."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    labelled = sampling.with_split(items, ITEM_ID, method="md5")
    return labelled.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


ITEM_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LABELS_SQL = f"""SELECT CASE WHEN {uniform_sql("concat_ws('|', " + ', '.join(ITEM_ID) + ')')} < 0.8e0
  THEN 'train' ELSE 'test' END AS split, count(*) AS rows FROM lineitem GROUP BY 1"""


def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hash_sample(trips(spark, sf_dir), "trip_id", 0.1, method="md5").select(
        "trip_id", "fare_amount", "trip_distance"
    )


SAMPLE_SQL = f"""WITH {TRIPS_SQL} SELECT trip_id, fare_amount, trip_distance FROM trips
WHERE {uniform_sql('trip_id', 'sample')} < 0.1e0"""


def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_n(trips(spark, sf_dir), "trip_id", 500, method="md5").select("trip_id", "fare_amount")


SAMPLE_N_SQL = f"""WITH {TRIPS_SQL} SELECT trip_id, fare_amount FROM trips
ORDER BY {uniform_sql('trip_id', 'sample')}, trip_id LIMIT 500"""


def fold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.with_fold(trips(spark, sf_dir).select("trip_id"), "trip_id", 3, method="md5")


FOLD_SQL = f"SELECT event_id AS trip_id, CAST(floor({uniform_sql('event_id', 'fold')} * 3e0) AS INT) AS fold FROM events"


def uniform_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.with_uniform(trips(spark, sf_dir).select("trip_id"), "trip_id", seed=7, method="md5")


REPLICATES = 1000
_LANES = 8


def _weight_sql(lane: int) -> str:
    draw = f"substr(word, {4 * lane + 1}, 4)"
    return " + ".join(f"CAST({draw} >= '{cut:04x}' AS INT)" for cut in poisson_cuts())


def _bootstrap_sql(where: str = "") -> str:
    return f"""WITH {SCORED_SQL},
words AS (SELECT (label - prediction) * (label - prediction) AS sq, block,
  md5('42|bootstrap|' || CAST(block AS VARCHAR) || '|' || CAST(trip_id AS VARCHAR)) AS word
  FROM scored, (SELECT range AS block FROM range({REPLICATES // _LANES})) b {where}),
w AS (SELECT sq, block, {', '.join(f'{_weight_sql(i)} AS w{i}' for i in range(_LANES))} FROM words),
s AS (SELECT block, {', '.join(f'sum(w{i}) AS n{i}, sum(w{i} * sq) AS s{i}' for i in range(_LANES))}
  FROM w GROUP BY block),
r AS ({' UNION ALL '.join(f'SELECT block * {_LANES} + {i} AS replicate, n{i} AS n, sqrt(s{i} / n{i}) AS rmse FROM s' for i in range(_LANES))})
"""


def _residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_residuals(scored_trips(spark, sf_dir)).select("trip_id", "residual")
    return spread(rows, spark.sparkContext.defaultParallelism, "trip_id")


def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """95 % interval of the rmse over all scored trips from 1,000 resamples."""
    rows = _residuals(spark, sf_dir)
    table = bootstrap.bootstrap_rmse(rows, "residual", "trip_id", REPLICATES, method="md5")
    return table.select("replicates", *[F.round(c, 6).alias(c) for c in ("rmse_mean", "ci_lower", "ci_upper")])


_CI = """SELECT count(rmse) AS replicates, round(avg(rmse), 6) AS rmse_mean,
  round(quantile_cont(rmse, 0.025), 6) AS ci_lower, round(quantile_cont(rmse, 0.975), 6) AS ci_upper FROM r"""
CI_SQL = _bootstrap_sql() + _CI


def bootstrap_replicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size and rmse of every resample."""
    rows = _residuals(spark, sf_dir)
    table = bootstrap.bootstrap_replicates(rows, "residual", "trip_id", REPLICATES, method="md5")
    return table.select("replicate", "resample_size", F.round("rmse", 6).alias("rmse"))


REPLICATES_SQL = _bootstrap_sql() + """SELECT CAST(replicate AS INT) AS replicate, CAST(n AS BIGINT) AS resample_size,
  round(rmse, 6) AS rmse FROM r"""


def bootstrap_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interval from a tenth of the residuals."""
    rows = _residuals(spark, sf_dir)
    table = bootstrap.bootstrap_rmse(rows, "residual", "trip_id", REPLICATES, fraction=0.1, method="md5")
    return table.select("replicates", *[F.round(c, 6).alias(c) for c in ("rmse_mean", "ci_lower", "ci_upper")])


SAMPLED_SQL = _bootstrap_sql(f"WHERE {uniform_sql('trip_id', 'sample')} < 0.1e0") + _CI


def bootstrap_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interval over all scored trips with the fast hash, which SQL engines do not share: its order."""
    table = bootstrap.bootstrap_rmse(_residuals(spark, sf_dir), "residual", "trip_id", REPLICATES)
    inside = F.col("rmse_mean").between(F.col("ci_lower"), F.col("ci_upper"))
    return table.select("replicates", inside.alias("mean_inside"), (F.col("ci_upper") > F.col("ci_lower")).alias("wide"))


FAST_SQL = f"SELECT {REPLICATES}::BIGINT AS replicates, true AS mean_inside, true AS wide"


def bootstrap_little(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bag of little bootstraps: its blocks, and whether its interval is near that of all rows."""
    rows = _residuals(spark, sf_dir)
    every = bootstrap.bootstrap_rmse(rows, "residual", "trip_id", REPLICATES, method="md5").first()
    little = bootstrap.little_bootstrap_rmse(rows, "residual", "trip_id", method="md5")
    width = every["ci_upper"] - every["ci_lower"]
    near = (F.abs(F.col("ci_lower") - every["ci_lower"]) < width / 2) & (F.abs(F.col("ci_upper") - every["ci_upper"]) < width / 2)
    return little.select("blocks", "block_rows", "replicates", near.alias("near"))


LITTLE_SQL = f"""WITH {FEATURED_SQL}, n AS (SELECT count(*) AS n, least(count(*) / 20e0, ceil(pow(count(*), 0.7e0))) AS b FROM featured)
SELECT 20::BIGINT AS blocks, count(*) AS block_rows, 2000::BIGINT AS replicates, true AS near
FROM featured, n WHERE floor({uniform_sql('trip_id', 'block')} * (n / b)) < 20"""


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    keys = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return items.select(F.concat_ws("-", *keys).alias("item"), "l_extendedprice")


_ITEMS_SQL = """items AS (SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS item, l_extendedprice FROM lineitem)"""


def sample_third(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly a third of all line items, too many for one sorting task."""
    items = _items(spark, sf_dir)
    return sampling.sample_n(items, "item", items.count() // 3, method="md5")


SAMPLE_THIRD_SQL = f"""WITH {_ITEMS_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY {uniform_sql('item', 'sample')}, item) AS place FROM items)
SELECT item, l_extendedprice FROM r WHERE place <= (SELECT count(*) // 3 FROM items)"""


def top_third(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third of all line items with the highest prices."""
    items = _items(spark, sf_dir)
    return top_k(items, "l_extendedprice", items.count() // 3, tie="item")


TOP_THIRD_SQL = f"""WITH {_ITEMS_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY l_extendedprice DESC, item) AS place FROM items)
SELECT item, l_extendedprice FROM r WHERE place <= (SELECT count(*) // 3 FROM items)"""

QUERIES = {
    "bootstrap_little": (bootstrap_little, LITTLE_SQL),
    "sample_third": (sample_third, SAMPLE_THIRD_SQL),
    "top_third": (top_third, TOP_THIRD_SQL),
    "hash_split": (hash_split, SPLIT_SQL),
    "split_labels": (split_labels, LABELS_SQL),
    "hash_sample": (hash_sample, SAMPLE_SQL),
    "sample_n": (sample_n, SAMPLE_N_SQL),
    "fold_assign": (fold_assign, FOLD_SQL),
    "uniform_draws": (
        uniform_draws, f"SELECT event_id AS trip_id, {uniform_sql('event_id', 'uniform', 7)} AS u FROM events"
    ),
    "bootstrap_ci": (bootstrap_ci, CI_SQL),
    "bootstrap_replicates": (bootstrap_replicates, REPLICATES_SQL),
    "bootstrap_sampled": (bootstrap_sampled, SAMPLED_SQL),
    "bootstrap_fast": (bootstrap_fast, FAST_SQL),
}
