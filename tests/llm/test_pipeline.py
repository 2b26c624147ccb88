"""The corpus pipeline: each stage against its brute-force meaning, and the whole run."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from test_near_dedup import brute as components
from test_substring_dedup import brute as repeats

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_keep_the_columns_of_documents(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_quality_keeps_good_documents(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = stages[1].select("doc_id").collect()
    kept = {r.doc_id for r in kept}
    rows = labels.collect()
    assert sum(r.doc_id in kept for r in rows if r.quality == 1) >= 0.97 * sum(r.quality == 1 for r in rows)
    assert sum(r.doc_id in kept for r in rows if r.quality == 0) <= 0.2 * sum(r.quality == 0 for r in rows)


def test_one_document_of_each_group_stays(stages):
    want = {c for _, c in components([(r.doc_id, r.text) for r in stages[1].collect()]).values()}
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(want)


def test_repeated_passages_go(stages):
    before = stages[2].orderBy("doc_id").collect()
    after = {r.doc_id: r for r in stages[3].collect()}
    assert after.keys() == {r.doc_id for r in before}
    for row, spans in zip(before, repeats([r.text for r in before], 200)):
        data, gone = row.text.encode(), sum(e - s for s, e in spans)
        left = after[row.doc_id]
        assert left.n_chars == len(left.text)
        assert len(data) - gone <= len(left.text.encode()) <= len(data) - gone + 6 * len(spans)
        if not spans:
            assert left.text == row.text


def test_packed_pieces_cover_what_is_left(stages):
    assert {r.doc_id for r in stages[5].collect()} == {r.doc_id for r in stages[4].collect()}
    assert {r.doc_id for r in stages[4].collect()} <= {r.doc_id for r in stages[3].collect()}


def test_run_applies_all_stages(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SF).select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages[5].select(columns).collect()))


def test_rows_that_repeat_an_id_and_rows_without_one(spark):
    text = "a b c d e f g h i j"
    rows = [(1, text, "x"), (1, text, "x"), (2, text, "y"), (3, "other words", "z"), (None, "n", "u"), (None, "n", "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rows string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.rows) for r in got.collect()) == [(0, "u"), (0, "u"), (1, "x"), (3, "z")]


def test_columns_of_any_name_pass_through_all_stages(spark, tmp_path):
    odd = ["repeats", "__kept", "__set", "__word", "__uid", "Text2", "kept", "word", "bits", "c0", "uid", "score", "a.b"]
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in odd])
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, plain = (_stored(spark, stage(spark, d, str(tmp_path)), tmp_path / f"{name}{i}") for i, d in enumerate((docs, plain)))
        assert docs.columns == [*plain.columns, *odd]
        rows = docs.collect()
        assert sorted((r.doc_id, r.text, r.n_chars) for r in rows) == sorted((r.doc_id, r.text, r.n_chars) for r in plain.collect())
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in odd)
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, str(tmp_path)).count() == last(spark, plain, str(tmp_path)).count()


def _stored(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_registered(spark):
    names = contract.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


def test_no_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
