"""Near duplicates against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from farebox.llm import near_dedup
from farebox.llm.near_dedup import near_duplicates
from farebox.llm.superminhash import signatures

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """doc_id -> (n_shingles, component) by comparing every pair."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    return {i: (len(sets[i]), root[i]) for i in ids}


def corpus(seed, families=12, members=9):
    """Families of texts that drift away from each other step by step, with copies and short texts."""
    rng = random.Random(seed)
    texts = []
    for _ in range(families):
        words = [rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(rng.randint(3, 160))]
        for _ in range(members):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(9999)}"
    texts += [texts[0]] * 5 + ["", "  \n", "one two", "ONE two", "one two three four", None, "é É x y z", "\x00 a b c d e"]
    rng.shuffle(texts)
    return [(i * 7 + 3, t) for i, t in enumerate(texts)]


def check(spark, rows):
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force_on_drifting_families(spark, seed):
    check(spark, corpus(seed))


def test_large_buckets_are_split_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SPLIT", 4)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 3000)
    check(spark, corpus(3, families=4, members=30))


def test_repeated_ids_null_ids_and_clashing_columns(spark):
    text = "a b c d e f g h i j"
    rows = [(1, text, 5, "x"), (1, "other words here", 5, "y"), (2, text, 5, "z"), (None, text, 5, "w"), (2, text, 5, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int, id string")
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert got == [(0, None, True), (1, 1, True), (1, 1, True), (2, 1, False), (2, 1, False)]


def test_no_rows(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_signature_estimates_similarity_with_less_variance_than_minhash():
    rng, slots, found = np.random.default_rng(5), 64, []
    for _ in range(300):
        x = rng.integers(0, 2**63, 100).astype(np.uint64)
        sig = signatures(np.concatenate([x[:80], x[20:]]), np.array([0, 80, 160]), slots)
        found.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(found) - 0.6) < 0.01
    assert np.std(found) < 0.95 * np.sqrt(0.6 * 0.4 / slots)


def test_signature_does_not_depend_on_the_pieces(monkeypatch):
    from farebox.llm import superminhash

    values = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    bounds = np.array([0, 0, 3, 260, 500])
    whole = signatures(values, bounds, 32)
    monkeypatch.setattr(superminhash, "ELEMENTS", 100)
    assert (signatures(values, bounds, 32) == whole).all()
