import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.functions import hashing
from farebox.functions.hashing import poisson_cuts, uniform
from farebox.operators import bootstrap, sampling

METHODS = ["xxhash64", "md5"]


@pytest.fixture(scope="module")
def ids(spark):
    return spark.range(20_000).withColumnRenamed("id", "rid")


def keys(df):
    return {r[0] for r in df.select("rid").collect()}


@pytest.mark.parametrize("method", METHODS)
def test_split_is_whole_disjoint_and_partition_free(ids, method):
    train, test = sampling.hash_split(ids, "rid", method=method)
    a, b = keys(train), keys(test)
    assert not a & b and len(a) + len(b) == 20_000
    assert abs(len(a) / 20_000 - 0.8) < 0.02
    again, _ = sampling.hash_split(ids.repartition(7), "rid", method=method)
    assert keys(again) == a
    labelled = sampling.with_split(ids, "rid", method=method)
    assert keys(labelled.filter("split = 'train'")) == a


@pytest.mark.parametrize("method", METHODS)
def test_null_ids_stay_in_the_split(spark, method):
    df = spark.createDataFrame([(None,), (1,)], "rid long")
    train, test = sampling.hash_split(df, "rid", method=method)
    assert train.count() + test.count() == 2


@pytest.mark.parametrize("method", METHODS)
def test_samples_nest_and_draws_match_the_threshold(ids, method):
    small, large = (keys(sampling.hash_sample(ids, "rid", f, method=method)) for f in (0.1, 0.3))
    assert small < large and abs(len(small) / 20_000 - 0.1) < 0.01
    by_draw = ids.withColumn("u", uniform("rid", 42, method, "sample")).filter("u < 0.1")
    assert keys(by_draw) == small
    assert sampling.hash_sample(ids, "rid", 1.0, method=method).count() == 20_000
    assert sampling.hash_sample(ids, "rid", 0.0, method=method).count() == 0


@pytest.mark.parametrize("method", METHODS)
def test_purposes_draw_independently(ids, method):
    """A sample and the folds of one side of a split see fresh draws under the same seed."""
    _, test = sampling.hash_split(ids, "rid", method=method)
    n = test.count()
    assert abs(sampling.hash_sample(test, "rid", 0.25, method=method).count() / n - 0.25) < 0.04
    folds = sampling.with_fold(test, "rid", 4, method=method).groupBy("fold").count().collect()
    assert {r["fold"] for r in folds} == {0, 1, 2, 3}
    assert all(abs(r["count"] / n - 0.25) < 0.04 for r in folds)


@pytest.mark.parametrize("n", [0, 1, 50, 333, 20_000, 30_000])
def test_sample_n_is_exact(ids, n):
    picked = keys(sampling.sample_n(ids, "rid", n))
    assert len(picked) == min(n, 20_000)
    ranked = ids.withColumn("u", uniform("rid", 42, purpose="sample")).orderBy("u", "rid").limit(n)
    assert picked == keys(ranked)


def test_sample_n_of_nothing(ids):
    assert sampling.sample_n(ids.filter("rid < 0"), "rid", 10).count() == 0


def test_unknown_method_is_refused(ids):
    with pytest.raises(ValueError):
        sampling.hash_sample(ids, "rid", 0.5, method="crc")


def test_uniform_is_uniform(ids):
    stats = sampling.with_uniform(ids, "rid").agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert stats[0] == pytest.approx(0.5, abs=0.01)
    assert 0.0 <= stats[1] and stats[2] < 1.0


def test_poisson_cuts_are_the_cumulative_probabilities():
    expected = [0.36788, 0.73576, 0.91970, 0.98101, 0.99634]
    assert [c / 65536 for c in poisson_cuts()[:5]] == pytest.approx(expected, abs=1e-4)


@pytest.mark.parametrize("method", METHODS)
def test_bootstrap_agrees_with_resampling(spark, method):
    rng = np.random.default_rng(1)
    errors = rng.normal(0.0, 3.0, 2_000)
    df = spark.createDataFrame([(i, float(e)) for i, e in enumerate(errors)], "rid long, residual double")
    got = bootstrap.bootstrap_rmse(df, "residual", "rid", 400, method=method).first()
    draws = [np.sqrt(np.mean(rng.choice(errors, errors.size) ** 2)) for _ in range(2_000)]
    assert got["replicates"] == 400
    assert got["rmse_mean"] == pytest.approx(np.mean(draws), rel=0.01)
    assert got["ci_lower"] == pytest.approx(np.percentile(draws, 2.5), rel=0.02)
    assert got["ci_upper"] == pytest.approx(np.percentile(draws, 97.5), rel=0.02)
    again = bootstrap.bootstrap_rmse(df.repartition(5), "residual", "rid", 400, method=method).first()
    assert again["ci_lower"] == pytest.approx(got["ci_lower"], rel=1e-12)


def test_bootstrap_sizes_and_odd_replicate_count(spark):
    df = spark.range(5_000).select(F.col("id").alias("rid"), F.lit(2.0).alias("residual"))
    rows = bootstrap.bootstrap_replicates(df, "residual", "rid", 101).collect()
    assert sorted(r["replicate"] for r in rows) == list(range(101))
    assert all(r["rmse"] == pytest.approx(2.0) for r in rows)
    sizes = [r["resample_size"] for r in rows]
    assert np.mean(sizes) == pytest.approx(5_000, rel=0.01)
    assert np.std(sizes) == pytest.approx(np.sqrt(5_000), rel=0.3)


def test_poisson_counts_have_their_mean_variance_and_skewness(spark):
    for mean in (1.0, 12.5, 40.0, 41.0, 700.0):
        draws = spark.range(40_000).select(hashing.poisson_count("id", F.lit(3), mean).alias("k"))
        row = draws.agg(F.avg("k").alias("m"), F.var_samp("k").alias("v"), F.skewness("k").alias("s"), F.min("k").alias("low")).first()
        assert abs(row.m - mean) < 5 * (mean / 40_000) ** 0.5 and abs(row.v / mean - 1) < 0.05
        assert abs(row.s - mean**-0.5) < 0.06 and row.low >= 0


def test_little_bootstraps_agree_with_the_whole_one(spark):
    rows = spark.range(30_000).select("id", hashing.gaussian("id", F.lit(1), 5).alias("residual"))
    whole = bootstrap.bootstrap_rmse(rows, "residual", "id", 400).first()
    little = bootstrap.little_bootstrap_rmse(rows, "residual", "id").first()
    width = whole.ci_upper - whole.ci_lower
    assert abs(little.ci_lower - whole.ci_lower) < width / 3 and abs(little.ci_upper - whole.ci_upper) < width / 3
    assert little.blocks == 20 and little.replicates == 2000
    assert 0.8 * 20 * 30_000**0.7 < little.block_rows < 1.2 * 20 * 30_000**0.7


def test_little_bootstraps_draw_ever_fewer_rows_and_the_same_ones(spark):
    shares = []
    for n in (2_000, 50_000):
        rows = spark.range(n).select("id", F.lit(1.0).alias("residual"))
        found = bootstrap.little_replicates(rows, "residual", "id", replicates=3)
        sizes = {r.block: r.block_rows for r in found.collect()}
        assert sizes == {r.block: r.block_rows for r in bootstrap.little_replicates(rows.repartition(7), "residual", "id", replicates=3).collect()}
        resample = found.agg(F.avg("resample_size")).first()[0]
        assert abs(resample / n - 1) < 0.15 and found.filter("rmse <> 1").count() == 0
        shares.append(sum(sizes.values()) / n)
    assert shares[1] < shares[0]
    assert bootstrap.little_bootstrap_rmse(rows.limit(0), "residual", "id").first().blocks == 0
