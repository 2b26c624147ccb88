"""Vector codes against plain nested loops, and the search against all distances."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from farebox.llm import code_compression as cc
from farebox.llm.code_compression import integers, nearest, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) if abs(x) < 1e300 else int(x) * 256 for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    raw = {id(k): v for k, (_, v, _) in zip(kept, [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])])}
    width = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    order = sorted(kept, key=lambda k: (k[0] is None, k[0] or 0, raw[id(k)]))
    dim = width // parts
    cut = lambda v: [(v + [0] * width)[:width][p * dim : (p + 1) * dim] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in order[:entries]] for p in range(parts)]

    def code(v):
        found = [min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book)) for x, book in zip(cut(v), books)]
        return [i for _, i in found], sum(d for d, _ in found)

    for _ in range(rounds):
        members = {}
        for _, v, _ in kept:
            for p, i in enumerate(code(v)[0]):
                members.setdefault((p, i), []).append(cut(v)[p])
        for (p, i), xs in members.items():
            books[p][i] = [sum(column) // len(xs) for column in zip(*xs)]
    sha = hashlib.sha256(",".join(str(y) for book in books for e in book for y in e).encode()).hexdigest()
    coded = [(i, *code(v), label) for i, v, label in kept]
    return sorted(((i, "".join(f"{c:02x}" for c in codes), error, sum(e for _, _, e, m in coded if m == label), sha)
                   for i, codes, error, label in coded), key=repr)


def built(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS error", "'x' AS code", "2 AS _rows").repartition(4)
    got = vector_codes(df, **how)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def drawn(n, dim, seed=1, labels=4):
    rng = np.random.default_rng(seed)
    return [(int(i), (rng.standard_normal(dim) * rng.choice([0.1, 1])).round(3).tolist(), int(rng.integers(labels)))
            for i in rng.permutation(5 * n)[:n]]


@pytest.mark.parametrize("n, dim", [(300, 32), (70, 16), (40, 64)])
def test_matches_nested_loops(spark, n, dim):
    rows = drawn(n, dim)
    assert built(spark, rows) == brute(rows)


def test_nulls_ties_repeats_widths_and_large_components(spark):
    rows = drawn(120, 32)
    rows += [rows[3], rows[3], (rows[4][0], rows[5][1], 9)]  # a row repeated, an id with two vectors
    rows += [(9000 + i, rows[7][1], 1) for i in range(60)]  # copies
    rows += [(9100, None, 1), (9101, [1.0, None] * 16, 1), (9102, [math.nan] * 32, 1), (9103, [math.inf] * 32, 2), (9104, [], 3)]
    rows += [(None, rows[8][1], 1), (9105, rows[9][1], None), (9106, rows[10][1], None), (9107, rows[11][1][:31], 1)]
    rows += [(-1, [1e30] + [0.0] * 31, 2), (-2, [-1e300] + [0.5] * 31, 2), (-3, [3e9] + [0.5] * 31, 2)]
    want = brute(rows)
    assert built(spark, rows) == want and len(want) == len(rows) - 4


def test_an_error_beyond_a_long_is_refused(spark):
    rows = [(i, [0.0] * 16, 0) for i in range(64)] + [(100, [1e30] + [0.0] * 15, 0), (101, [2e30] + [0.0] * 15, 0)]
    with pytest.raises(Exception, match="(?i)int.*(large|long|C)"):
        built(spark, rows)


def test_few_or_no_vectors(spark):
    rows = drawn(3, 20)
    assert built(spark, rows) == brute(rows)
    assert built(spark, rows, entries=2, rounds=1, parts=4) == brute(rows, 4, 2, 1)
    assert built(spark, [(1, None, 1)]) == [] and built(spark, [(1, [], 1), (2, [], None)]) == brute([(1, [], 1), (2, [], None)])
    assert vector_codes(spark.createDataFrame([], SCHEMA)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(-9, 9), min_size=3, max_size=3), min_size=1, max_size=20),
       st.lists(st.lists(st.integers(-12, 12), min_size=3, max_size=3), min_size=1, max_size=12), st.sampled_from([1, 10**12, 10**30]))
def test_search_finds_the_first_of_the_nearest(entries, rows, unit):
    kind = np.int64 if unit < 10**18 else object
    part, book = (np.array([[x * unit for x in v] for v in side], dtype=kind) for side in (rows, entries))
    code, distance, looked = nearest(part, book)
    every = [[sum((a - b) ** 2 for a, b in zip(x, e)) for e in book.tolist()] for x in part.tolist()]
    assert code.tolist() == [d.index(min(d)) for d in every] and distance.tolist() == [min(d) for d in every]
    assert looked <= len(rows) * len(entries)


def test_search_leaves_most_entries_out():
    rng = np.random.default_rng(3)
    part, book = (rng.standard_normal((n, 4)) * 256 + rng.standard_normal((n, 1)) * 500 for n in (2000, 64))
    code, _, looked = nearest(part.astype(np.int64), book.astype(np.int64))
    assert looked < 0.4 * 2000 * 64 and len(set(code.tolist())) > 20


def test_integers_are_floors():
    import pyarrow as pa

    values = [[-0.001, 0.5, 1 / 256], [1e300], [], [2.0**54 + 4]]
    got = integers(pa.array(values, pa.list_(pa.float64())), 3).tolist()
    assert got == [[-1, 128, 1], [int(1e300) * 256, 0, 0], [0, 0, 0], [(2**54 + 4) * 256, 0, 0]]
    assert integers(pa.array([[0.25], [0.5]], pa.list_(pa.float32())).slice(1), 1).tolist() == [[128]]
    assert cc.integers(pa.array([[0.25]], pa.list_(pa.float32())), 1).dtype == np.int64
