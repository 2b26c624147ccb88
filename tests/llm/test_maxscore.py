"""Top-k inner products against brute force."""

import math

import numpy as np
import pytest

from farebox.llm import maxscore
from farebox.llm.maxscore import Postings, top_k


def brute(rows, k, every=100, scale=1024):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x * scale) for x in v)]
    out = []
    for query, v in {(i, tuple(v)) for i, v in usable if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != query)
        out += [(query, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard, block", [(4096, 1024), (30, 2)])
def test_matches_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(maxscore, "SHARD", shard)
    monkeypatch.setattr(maxscore, "QUERY_BLOCK", block)
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(12).round(2).tolist()) for i in range(420)]
    rows += [(1000 + i, rows[100][1]) for i in range(20)]  # ties
    rows += [(2000, None), (2001, [1.0, None]), (2100, [math.inf] * 12), (2101, [math.nan] * 12), (None, [1.0] * 12),
             (2200, []), (2201, [3.0, -2.0]), (2300, [0.0] * 12), (2401, [20000.0] + [0.5] * 11), (2402, [-3e9] + [0.0] * 11),
             (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "0 AS rank", "1 AS score")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in top_k(df).collect())
    assert got == brute(rows, 10)


def test_large_components_are_exact(spark):
    near = [(0, [1.0, 0.0]), (1, [20000.0, 1.0]), (2, [1.0, 1.0]), (3, [0.5, 0.0])]
    far = [(100, [2e6, 1.0, 0.5]), (200, [1.0, -1e12, 0.0]), (4, [2e6, -1.0, 0.25]), (5, [-1e5, 7.0, 1.0]), (6, [3e4, 3e4, 2.0**43])]
    far += [(10 + i, [float(i), 0.001 * i, 1.0]) for i in range(30)]
    for rows in (near, far):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in top_k(df).collect())
        assert got == brute(rows, 10)
    assert brute(near, 10)[0][2] == 1


def test_a_score_beyond_a_long_is_refused_where_it_is_among_the_best(spark):
    rows = [(0, [1e12, 1.0]), (1, [1e12, 0.0]), (2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="(?i)int|overflow"):
        top_k(df).collect()
    low = [(0, [-1e12, 1.0]), *[(i, [1.0, i / 2]) for i in range(1, 12)], (50, [1e12, 0.0])]  # the worst by far
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in top_k(spark.createDataFrame(low, df.schema)).collect())
    assert got == brute(low, 10)


def test_fewer_candidates_than_k_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (100, [-1.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in top_k(df).collect())
    assert got == [(0, 1, 1, 2 * 1024**2), (0, 2, 100, -(1024**2)), (100, 1, 0, -(1024**2)), (100, 2, 1, -2 * 1024**2)]
    assert top_k(df.limit(0)).collect() == []


def test_a_shard_is_pruned_without_losing_a_row():
    rng = np.random.default_rng(4)
    matrix = (rng.standard_normal((800, 20)) * (rng.random((800, 20)) < 0.2) * 500).astype(np.int64)
    postings = Postings(np.arange(800), matrix)
    for query in (rng.standard_normal((40, 20)) * 300).astype(np.int64):
        ids, scores = postings.top(query, -1, 10)
        every = matrix @ query
        order = np.lexsort((np.arange(800), -every))[:10]
        assert ids.tolist() == order.tolist() and scores.tolist() == every[order].tolist()
