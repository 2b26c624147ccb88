"""Code lengths against a plain coder, exact counts, and accuracy on texts that were held out."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from farebox.llm import language_id as li
from farebox.llm.bytes import text_chunks
from farebox.llm.language_id import Trees, languages_of, train

SCHEMA = "doc_id long, text string, lang string, source string"


def drawn(seed, n=60):
    rng = random.Random(seed)
    letters = {"xx": "aab c", "yy": "abcd", "zz": "éa c"}
    return [(i, "".join(rng.choice(letters[lang]) for _ in range(rng.randint(0, 60))), lang, "s")
            for i, lang in ((i, rng.choice(list(letters))) for i in range(n))]


def counts(rows, order):
    """(lang, bytes) -> occurrences, over what may be learnt from."""
    out = Counter()
    for doc, text, lang, _ in rows:
        if text is not None and lang is not None and (doc is None or zlib.crc32(str(doc).encode()) % 4 != 2):
            data = bytes(order) + text.encode()
            for i in range(order, len(data)):
                out.update((lang, data[i - m : i + 1]) for m in range(order + 1))
    return out


def plain_bits(seen, lang, before, symbol, order):
    """Code length of a byte by escapes with exclusion; ``seen``: (lang, bytes) -> n of the kept grams."""
    excluded, bits = set(), 0.0
    for m in range(order, -1, -1):
        context = before[len(before) - m :]
        here = {s: seen.get((lang, context + bytes([s])), 0) for s in range(256)}
        if not any(here.values()):
            continue
        offered = {s: n for s, n in here.items() if n and s not in excluded}
        whole = sum(offered.values()) + len(offered)
        if symbol in offered:
            return bits + math.log2(whole / offered[symbol])
        if offered:
            bits += math.log2(whole / len(offered))
        excluded |= offered.keys()
    return bits + math.log2(256 - len(excluded))


@pytest.fixture(scope="module")
def learnt(spark):
    rows = drawn(1)
    return rows, train(spark.createDataFrame(rows, SCHEMA).repartition(3), order=3, nodes=40), train(
        spark.createDataFrame(rows, SCHEMA).repartition(6), order=3)


def kept(stats):
    return {(lang, int(g).to_bytes(int(m), "big")): int(n)
            for m, g, row in zip(stats.length, stats.gram, stats.count) for lang, n in zip(stats.langs, row) if n}


def test_counts_cover_every_byte_that_may_be_learnt(learnt):
    rows, _, stats = learnt
    assert kept(stats) == dict(counts(rows, 3)) and stats.langs == ["xx", "yy", "zz"]


def test_a_bounded_tree_holds_the_most_frequent_grams_and_their_parts(learnt):
    _, few, stats = learnt
    small, whole = kept(few), kept(stats)
    assert 10 < len({g for _, g in small}) <= 40
    assert all(whole[k] == n for k, n in small.items())
    grams = {g for _, g in small}
    assert all(g[1:] in grams and (g[:-1] in grams or not any(g[:-1])) for g in grams if len(g) > 1)


@pytest.mark.parametrize("which", [1, 2])
def test_code_lengths_equal_those_of_a_plain_coder(learnt, monkeypatch, which):
    stats = learnt[which]
    trees, seen = Trees(stats), kept(stats)
    texts = [t for _, t, _, _ in drawn(2, 25)] + ["", None, "zqé \x00\x00a", "ab" * 150]
    monkeypatch.setattr(li, "CHUNK_BYTES", 37)
    got = np.concatenate([trees.code_lengths(c) for c in text_chunks(pa.array(texts), 200)])
    for text, row in zip(texts, got):
        data = bytes(3) + (text or "").encode()
        want = [sum(plain_bits(seen, lang, data[i - 3 : i], data[i], 3) for i in range(3, len(data))) for lang in stats.langs]
        assert row.tolist() == pytest.approx(want, rel=1e-5, abs=1e-5)


def test_probabilities_of_all_bytes_add_up_to_one(learnt):
    stats = learnt[2]
    seen = kept(stats)
    for before in (b"\0\0\0", b"ab ", b"\xa9a ", b"zzz"):
        for lang in stats.langs:
            assert sum(2 ** -plain_bits(seen, lang, before, s, 3) for s in range(256)) == pytest.approx(1)


def test_held_out_languages_are_found(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    rows = languages_of(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    out = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert len(out) > 150 and sum(out) >= 0.98 * len(out)


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark):
    rows = drawn(3)
    other = [(i, t, "yy" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, "t") for i, t, lang, _ in rows]
    found = []
    for kind in (rows, other, rows[::-1]):
        df = spark.createDataFrame(kind, SCHEMA).selectExpr("*", "'q' AS lang_pred", "1 AS score", "2 AS n", "3 AS gram")
        found.append(sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in languages_of(df.repartition(4)).collect()))
    assert found[0] == found[1] == found[2]


def test_nulls_empty_and_odd_texts(spark):
    rows = drawn(4) + [(1001, None, "xx", "s"), (1002, "", "yy", "s"), (1003, "123 -- \n", "xx", "s"), (None, "dddd", None, None),
                       (1004, "abcd" * 100_000, "yy", "s"), (1005, "漢字", None, "s"), (1005, "漢字", None, "s")]
    got = {}
    for r in languages_of(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert all((got[i][0].lang_pred, got[i][0].score) == ("und", 0.0) for i in (1001, 1002, 1003))
    assert (got[None][0].lang_pred, got[None][0].held_out) == ("yy", False)
    assert got[1004][0].lang_pred == "yy" and len(got[1005]) == 2 and got[1005][0] == got[1005][1]
    assert got[1005][0].lang_pred in ("xx", "yy", "zz")


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "text", None, "s"), (2, None, "xx", "s")], SCHEMA)
    assert [(r.lang_pred, r.score) for r in languages_of(df).collect()] == [("und", 0.0)] * 2
    assert languages_of(df.limit(0)).collect() == []
    only = spark.createDataFrame([(1, "", "xx", "s"), (3, "b", None, "s")], SCHEMA)
    assert {r.lang_pred for r in languages_of(only).collect()} == {"und"}


def test_only_the_most_frequent_languages_are_learnt(spark):
    rows = drawn(6, 80)
    totals = Counter()
    for (lang, gram), n in counts(rows, 0).items():
        totals[lang] += n
    stats = train(spark.createDataFrame(rows, SCHEMA), order=2, languages=2)
    assert stats.langs == sorted(lang for lang, _ in totals.most_common(2))
