"""Repeated strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from farebox.llm import substring_dedup
from farebox.llm.bytes import text_chunks
from farebox.llm.phrases import phrases
from farebox.llm.substring_dedup import repeat_digests, with_repeats, without_repeats


def brute(texts, length):
    """Maximal spans covered by strings that occur more than once, per text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        covered = np.zeros(len(d) + 2, dtype=int)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                covered[i + 1] += 1
                covered[i + length + 1] -= 1
        edge = np.diff((np.cumsum(covered) > 0).astype(int))
        out.append(list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())))
    return out


def corpus(seed, alphabet, size=14):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 160))) for _ in range(5)]
    texts = [None, "", "x"]
    for _ in range(size):
        text = ""
        for _ in range(rng.randint(0, 4)):
            part = rng.choice(base)
            at = rng.randint(0, len(part))
            text += part[at : rng.randint(at, len(part))] + rng.choice(["", rng.choice(alphabet)])
        texts.append(text)
    return texts


def spans(df):
    return {r.doc_id: [(s.start, s.end) for s in r.repeats] for r in df.collect()}


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefghijklmnop", "aé\x00漢"])
@pytest.mark.parametrize("hot", [2048, 3, 0])
def test_matches_brute_force(spark, monkeypatch, alphabet, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    texts = corpus(len(alphabet) + hot, alphabet)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert spans(with_repeats(df, length=24)) == dict(enumerate(brute(texts, 24)))


def test_a_passage_in_many_surroundings_is_divided(spark, monkeypatch):
    """Parts shrink until they fit, and phrases are passed on, not the strings they hold."""
    monkeypatch.setattr(substring_dedup, "HOT", 20)
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passage, tail = word(150), word(60)
    texts = [word(rng.randint(30, 90)) + passage + (tail if i % 3 == 0 else word(60)) + word(rng.randint(0, 40)) for i in range(160)]
    texts += [texts[5], texts[6][:170]]
    sizes, halves = [], substring_dedup._halves
    monkeypatch.setattr(substring_dedup, "_halves", lambda rows, length: (out := halves(rows, length), sizes.append((rows.count(), out.count())))[0])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert spans(with_repeats(df, length=100)) == dict(enumerate(brute(texts, 100)))
    assert sizes and all(after <= 2 * before for before, after in sizes) and len(sizes) <= 7
    assert max(after for _, after in sizes) < 160 * 10


def test_every_string_start_has_one_phrase_whatever_the_chunks(monkeypatch):
    from farebox.llm import phrases as module

    texts = [t.encode() for t in corpus(9, "abc", 30) if t] + [b"ab" * 700]
    monkeypatch.setattr(module, "PIECE_BYTES", 300)
    for length in (24, 200):
        for chunk in text_chunks(pa.array(texts, pa.binary()), 900):
            starts = [[] for _ in range(chunk.hi - chunk.lo)]
            for found in phrases(chunk, length):
                for row, first, last, trigger in zip(found.row, found.first, found.last, found.trigger):
                    assert first <= last <= trigger
                    starts[row] += range(first, last + 1)
            for text, own in zip(texts[chunk.lo : chunk.hi], starts):
                assert sorted(own) == list(range(max(0, len(text) - length + 1)))


def test_digests_of_what_is_left(spark):
    shared = "".join(random.Random(4).choice("abcdefgh ") for _ in range(260))
    texts = ["start " + shared + " end", shared, "alone " * 3, None, shared[:199], "q" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {}
    for i, (text, found) in enumerate(zip(texts, brute(texts, 200))):
        data = (text or "").encode()
        kept = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in found)], [*(s for s, _ in found), len(data)]))
        want[i] = (len(data), len(data) - len(kept), len(found), hashlib.sha256(kept).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in repeat_digests(df).collect()} == want
    assert want[0][1] == 260 and want[5][1] == 500


def test_cut_texts_keep_whole_characters_and_all_columns(spark):
    shared = "é漢" * 60  # 300 bytes
    rows = [(1, "x", "A" + shared + "B", 1), (2, "y", "漢" + shared, 2), (3, "z", None, 3), (None, "u", "", 4)]
    df = spark.createDataFrame(rows, "doc_id long, uid string, text string, repeats int")
    got = without_repeats(df)
    assert got.columns == df.columns and {(r.uid, r.repeats) for r in got.collect()} == {(r[1], r[3]) for r in rows}
    left = {r.uid: r.text for r in got.collect()}
    assert left["x"] == "AB" and left["z"] is None and left["u"] == "" and shared not in left["y"]


def test_repeated_rows_and_no_rows(spark):
    text = "".join(random.Random(8).choice("abcdefgh ") for _ in range(230))
    df = spark.createDataFrame([(1, text), (1, text), (2, text + "!")], "doc_id long, text string")
    assert sorted(r.n_removed for r in repeat_digests(df).collect()) == [230, 230, 230]
    assert with_repeats(df.limit(0)).collect() == []
