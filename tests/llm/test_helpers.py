"""Components, bounded sampling and byte helpers."""

import random

import numpy as np
import pyarrow as pa

from farebox.llm import bitmap
from farebox.llm.bitmap import part_by_ids
from farebox.llm.bytes import prefix_hash, space_table, span_hash, text_chunks, words_of
from farebox.llm.components import components
from farebox.llm.sample import first_by_hash


def test_components_of_chains_hubs_and_loops(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(7, 7), (9, 8), (8, 9)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    root = {v: v for link in links for v in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    alone = {a for a, b in links if a == b} - {v for a, b in links if a != b for v in (a, b)}
    assert got == {v: r for v, r in root.items() if v not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_first_by_hash_is_the_head_of_the_whole_order(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "k")
    ids = ids.unionByName(ids.limit(50)).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k"))
    want = [r.k for r in ids.where("k IS NOT NULL").distinct().orderBy("k").selectExpr("k", "xxhash64(k, 5) AS h").orderBy("h", "k").limit(100).collect()]
    assert sorted(r.k for r in first_by_hash(ids, "k", 100, 20_000, 5).collect()) == sorted(want)
    assert first_by_hash(ids, "k", 30_000, 20_000, 5).count() == 20_000
    assert first_by_hash(ids.limit(0), "k", 10, 0, 5).count() == 0


def test_chunks_hold_every_byte_once():
    texts = ["é" * 50, "", None, "x" * 500, "ab", "c" * 90]
    column = pa.chunked_array([pa.array(texts[:2]), pa.array(texts[2:])])
    chunks = list(text_chunks(column, 120))
    assert [(c.lo, c.hi) for c in chunks][-1][1] == 6
    joined = [c.data[a:b].tobytes() for c in chunks for a, b in zip(c.offsets[:-1], c.offsets[1:])]
    assert joined == [(t or "").encode() for t in texts]
    assert list(text_chunks(pa.array([], pa.string()))) == []
    sliced = list(text_chunks(pa.array(texts).slice(3, 2)))
    assert sliced[0].data.tobytes() == b"x" * 500 + b"ab"


def test_equal_spans_hash_alike_wherever_they_stand():
    rng = np.random.default_rng(1)
    piece = rng.integers(0, 256, 40).astype(np.uint8)
    data = np.concatenate([rng.integers(0, 256, 100).astype(np.uint8), piece, piece, np.zeros(9, dtype=np.uint8)])
    prefix = prefix_hash(data, 3)
    start = np.array([100, 140, 101, 100, 180, 181])
    end = np.array([140, 180, 140, 139, 184, 184])
    found = span_hash(prefix, start, end).tolist()
    assert found[0] == found[1] and len(set(found)) == 5


def test_words_end_with_their_text():
    chunk = next(text_chunks(pa.array(["one two", "two", "", " Three x\x0b", "one"])))
    words = words_of(chunk, space_table())
    assert words.row.tolist() == [0, 0, 1, 3, 4]
    assert words.hash[1] == words.hash[2] and words.hash[0] == words.hash[4] and words.hash[0] != words.hash[1]


def test_parting_by_ids_loses_no_row_and_misses_no_id(spark):
    rows = spark.range(5000).selectExpr("IF(id = 9, NULL, id) AS k", "id", "'t' AS canonical")
    rows = rows.unionByName(rows.where("id < 40"))
    ids = spark.range(0, 5000, 10).withColumnRenamed("id", "v")
    maybe, rest = part_by_ids(rows, "k", ids, "v")
    assert maybe.columns == rest.columns == rows.columns
    inside, outside = maybe.collect(), rest.collect()
    assert len(inside) + len(outside) == 5040
    assert not any(r.k is not None and r.k % 10 == 0 for r in outside)
    assert sum(r.k is None or r.k % 10 > 0 for r in inside) < 0.1 * len(outside)
    maybe, rest = part_by_ids(rows, "k", ids.limit(0), "v")
    assert maybe.count() == 0 and rest.count() == 5040


def test_a_full_filter_only_passes_more(spark, monkeypatch):
    monkeypatch.setattr(bitmap, "MAX_WORDS", 1)
    ids = spark.range(0, 5000, 10).withColumnRenamed("id", "v")
    maybe, rest = part_by_ids(spark.range(5000), "id", ids, "v")
    assert maybe.count() + rest.count() == 5000 and rest.where("id % 10 = 0").count() == 0
