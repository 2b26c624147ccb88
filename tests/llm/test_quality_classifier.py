"""Quality scores: held-out accuracy, exact voting, and odd input."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from farebox.llm.bytes import text_chunks
from farebox.llm.quality import NEIGHBOURS, Model, _latent, counts, fit, held_out, holders, quality_scores, train, vote, without_low_quality


@pytest.fixture(scope="module")
def tables(spark):
    base = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    rows = quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 80
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_held_out_rows_follow_the_crc_and_their_labels_are_not_learnt(spark, tables):
    docs, labels = tables
    first = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in first.items())
    turned = labels.withColumn("quality", (1 - labels.quality) * held_out().cast("int") + labels.quality * (~held_out()).cast("int"))
    again = {r.doc_id: r.score for r in quality_scores(docs, turned).collect()}
    assert all(again[i] == r.score for i, r in first.items())


def test_vote_equals_a_loop_over_all_voters():
    rng = np.random.default_rng(2)
    raw = rng.poisson(0.05, (60, 1024)).astype(np.float32)
    label = (np.arange(60) % 3 > 0).astype(np.int64)
    model = fit(raw, label, {0: 40, 1: 400})
    probe = rng.poisson(0.05, (7, 1024)).astype(np.float32)
    for row, score in zip(_latent(probe, model.idf, model.basis), vote(model, probe)):
        near = sorted(((float(row @ v), i) for i, v in enumerate(model.voters)), reverse=True)[:NEIGHBOURS]
        weight = [max(c, 0) ** 8 * model.weight[i] for c, i in near]
        assert score == pytest.approx(sum(w * label[i] for w, (_, i) in zip(weight, near)) / sum(weight), rel=1e-3)


def test_nulls_empty_texts_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 3), (None, "some words", 3), (2, "", 3)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(None, 1), (5, None), (6, 7)], "doc_id long, quality int")
    got = quality_scores(docs, labels).collect()
    assert len(got) == 4 and {r.score for r in got} == {0.5}
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert quality_scores(docs.limit(0), labels).collect() == []
    kept = without_low_quality(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 4


def test_the_sample_is_bounded(tables):
    docs, labels = tables
    rows = quality_scores(docs, labels, sample=40).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.85


def test_model_size_follows_from_the_parameters():
    model = fit(np.zeros((0, 1024), dtype=np.float32), np.zeros(0, dtype=np.int64), {})
    assert isinstance(model, Model) and model.prior == 0.5
    assert vote(model, np.zeros((2, 1024), dtype=np.float32)).tolist() == [0.5, 0.5]


def test_document_frequencies_cover_all_documents(spark, tables):
    docs, labels = tables
    texts = [r.text for r in docs.select("text").collect()]
    (chunk,) = text_chunks(pa.array(texts), 1 << 30)
    want = (counts(chunk) > 0).sum(axis=0)
    for parts in (1, 6):
        rows, held = holders(docs.repartition(parts))
        assert rows == len(texts) and (held == want).all()
    few = train(docs, labels, sample=40).idf
    assert np.allclose(few, np.log((1 + len(texts)) / (1 + want)) + 1)
    rows, held = holders(spark.createDataFrame([(None,), ("",)], "text string"))
    assert rows == 2 and not held.any() and holders(docs.limit(0))[0] == 0
