"""Benchmark matches against brute force over all windows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from farebox.llm import decontaminate
from farebox.llm.decontaminate import _candidates, build_index, contaminated, fingerprints, without_contaminated


def words_of(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(words):
    return [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def brute(docs, items):
    """(doc, item) -> best similarity of 0.75 or more over all windows of the item's size."""
    sets = {i: Counter(shingles(words_of(t))) for i, t in items if words_of(t)}
    seen = Counter(s for c in sets.values() for s in c)
    weight = lambda s: math.log(1 + len(sets) / seen.get(s, 1))
    out = {}
    for doc, text in docs:
        words = words_of(text)
        for item, item_text in items:
            size = min(len(words_of(item_text)), len(words))
            if not size or size < 5 < len(words):  # a short item matches no part of a longer text
                continue
            for at in range(len(words) - size + 1):
                window, own = Counter(shingles(words[at : at + size])), sets[item]
                keys = window.keys() | own.keys()
                part = sum(weight(s) * min(window[s], own[s]) for s in keys)
                whole = sum(weight(s) * max(window[s], own[s]) for s in keys)
                if part / whole >= 0.75 and part / whole > out.get((doc, item), (0,))[0]:
                    out[doc, item] = (part / whole, at)
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("bcdfgh") + rng.choice("aeiou") + str(rng.randrange(300))
    items = [(i, " ".join(word() for _ in range(rng.randint(8, 45)))) for i in range(12)]
    items += [(20, "three short words"), (21, ""), (22, None), (0, items[0][1]), (23, items[3][1] + " and more here")]
    docs = []
    for i in range(30):
        body = [word() for _ in range(rng.randint(0, 80))]
        if i % 2:
            leak = rng.choice(items[:12])[1].split()
            if i % 3 == 0:
                leak = leak[1:]
            if i % 5 == 0 and len(leak) > 30:
                leak[rng.choice([0, 1, -1])] = "changed"
            text = " ".join(leak)
            body[len(body) // 2 : len(body) // 2] = (text.upper() if i % 7 == 0 else text.replace(" ", ", ")).split()
        docs.append((i, " ".join(body)))
    return docs + [(40, "Three SHORT words"), (41, "and three short words more than that"), (42, None), (43, "")], items


def brute_plain(docs, items):
    """(doc, item) pairs with a window of the item's size whose plain shingle similarity is 0.75 or more."""
    out = set()
    for doc, text in docs:
        words = words_of(text)
        for item, item_text in items:
            own, size = Counter(shingles(words_of(item_text))), min(len(words_of(item_text)), len(words))
            for at in range(len(words) - size + 1 if size >= 5 else 0):
                window = Counter(shingles(words[at : at + size]))
                if 100 * sum((window & own).values()) >= 75 * sum((window | own).values()):
                    out.add((doc, item))
    return out


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize("block_words", [2_000_000, 60])
def test_matches_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    docs, items = corpus(5)
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in contaminated(*frames(spark, docs, items)).collect()}
    want = brute(docs, dict(items).items())
    assert got.keys() == want.keys() and len(want) >= 14
    for key, (score, start) in want.items():
        assert got[key][0] == pytest.approx(score) and got[key][1] == start


def test_stage_drops_only_documents_with_a_match(spark):
    docs, items = corpus(6)
    df, bench = frames(spark, docs, items)
    df = df.selectExpr("doc_id", "text", "'x' AS item_id", "1.5 AS similarity")
    bad = {d for d, _ in brute(docs, dict(items).items())}
    kept = without_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in bad)


def test_empty_sides(spark):
    docs, items = frames(spark, [(1, "a b c d e f")], [(1, "a b c d e f")])
    assert contaminated(docs.limit(0), items).collect() == []
    assert contaminated(docs, items.limit(0)).collect() == []
    assert contaminated(docs, items.selectExpr("item_id", "'' AS text")).collect() == []


def test_blocks_find_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**63, 400).astype(np.uint64)
    items = [(i, hashes[i * 20 : i * 20 + 20].tobytes(), hashes[i * 20 : i * 20 + 16].tobytes()) for i in range(20)]
    index = build_index(items, 20, {int(s): 1 for s in hashes})
    sized = index.sizes[20]
    near = np.repeat(sized.prints, 30, axis=0)
    for row in near:
        for bit in rng.choice(64, rng.integers(0, decontaminate.RADIUS + 1), replace=False):
            row[bit // 8] ^= np.uint8(1 << (bit % 8))
    found = set(map(tuple, _candidates(sized, near).tolist()))
    assert all((w, w // 30) in found for w in range(len(near)))
    far = lambda w, i: int(np.unpackbits(near[w] ^ sized.prints[i]).sum())
    assert found == {(w, i) for w in range(len(near)) for i in range(20) if far(w, i) <= decontaminate.RADIUS}


def test_fingerprint_is_the_majority_of_each_bit():
    hashes = np.array([0b1011, 0b1000, 0b0010], dtype=np.uint64)
    assert np.flatnonzero(np.unpackbits(fingerprints(hashes, np.array([0]), 3)[0])).tolist() == [4, 6]


def repeated_and_templated(seed):
    """Items that stand under 1, 5 and 30 ids, and items of one template; every item leaks with a changed word."""
    rng = random.Random(seed)
    word = lambda: rng.choice("bcdfgh") + rng.choice("aeiou") + str(rng.randrange(5000))
    items = []
    for copies in (1, 5, 30):
        text = " ".join(word() for _ in range(60))
        items += [(len(items) + i, text.upper() if i % 2 else text) for i in range(copies)]
    template = [word() for _ in range(80)]
    items += [(100 + i, " ".join(template + [word() for _ in range(6)])) for i in range(20)]
    docs = []
    for i, (_, text) in enumerate(items[::3]):
        leak = text.split()
        leak[len(leak) // 2] = "changed"
        docs.append((i, " ".join([word() for _ in range(i)] + leak + [word() for _ in range(5)])))
    return docs, items


def test_edited_leaks_of_repeated_and_templated_items(spark):
    docs, items = repeated_and_templated(9)
    df, bench = frames(spark, docs, items)
    rows = contaminated(df, bench, unweighted=True).collect()
    got, want = {(r.doc_id, r.item_id) for r in rows}, brute_plain(docs, items)
    assert {d for d, _ in want} == {d for d, _ in docs}  # every document is a leak by plain similarity
    assert got >= want
    assert all(r.similarity >= 0.75 or (r.doc_id, r.item_id) in want and r.plain >= 0.75 for r in rows)
    assert without_contaminated(df, bench).collect() == []


def test_weights_count_distinct_item_texts(spark):
    docs, items = corpus(5)
    best = lambda rows: {(r.doc_id, r.item_id): r.similarity for r in rows}
    once = best(contaminated(*frames(spark, docs, items)).collect())
    more = best(contaminated(*frames(spark, docs, items + [(50 + i, items[3][1].upper()) for i in range(9)])).collect())
    assert once and {k: s for k, s in more.items() if k[1] < 50} == once


def barely_similar(seed, n):
    """Items of Zipf words, and for each a copy with as long a run of replaced words as leaves 0.75."""
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.2)) % 100_000}"
    docs, items = [], []
    while len(items) < n:
        item = [word() for _ in range(rng.randint(60, 200))]
        own, best = Counter(shingles(item)), None
        at = rng.randrange(5, len(item) // 2)
        for run in range(1, len(item) // 3):
            leak = item[:at] + [f"x{rng.randrange(10**6)}" for _ in range(run)] + item[at + run :]
            window = Counter(shingles(leak))
            if 100 * sum((window & own).values()) < 75 * sum((window | own).values()):
                break
            best = leak
        if best:
            docs.append((len(items), " ".join([word() for _ in range(7)] + best + [word() for _ in range(9)])))
            items.append((len(items), " ".join(item)))
    return docs, items


def test_leaks_near_the_threshold_are_found_whatever_their_fingerprints(spark):
    docs, items = barely_similar(2, 400)
    got = {(r.doc_id, r.item_id) for r in contaminated(*frames(spark, docs, items), unweighted=True).collect()}
    assert {(i, i) for i, _ in items} <= got


def found_in_driver(docs, items, monkeypatch, *without):
    """(doc, item) that ``document_matches`` finds with some of its candidate searches turned off."""
    column = lambda rows: pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], ["id", "text"])
    listed = [r for b in decontaminate._item_hashes([column(items)]) for r in b.to_pylist()]
    seen = Counter(s & (2**64 - 1) for r in listed for s in r["distinct"])
    index = build_index([(r["item_id"], r["words"], r["shingles"]) for r in listed], len(items), seen)
    for name in without:
        monkeypatch.setattr(decontaminate, name, lambda *a: np.zeros((0, 2), dtype=np.int64))

    class Shared:
        value = index

    return {(r["doc_id"], r["item_id"]) for b in decontaminate._matches(Shared, True)([column(docs)]) for r in b.to_pylist()}


def test_the_multi_index_finds_nearly_all_by_itself(monkeypatch):
    """Of 600 copies as far from their items as counts at all, shared shingles add less than one in a hundred."""
    docs, items = barely_similar(7, 600)
    own = {(i, i) for i, _ in items}
    with monkeypatch.context() as m:
        by_prints = found_in_driver(docs, items, m, "_sharing")
    with monkeypatch.context() as m:
        by_shingles = found_in_driver(docs, items, m, "_candidates")
    assert len(own & by_prints) >= 0.99 * len(own) and own <= by_prints | by_shingles
    print("only by shared shingles:", len(own - by_prints), "of", len(own))


def test_blocks_of_the_benchmark_are_freed_one_after_the_other(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 60)
    held, most, broadcast = [], [], type(spark.sparkContext).broadcast

    def counted(self, value):
        made = broadcast(self, value)
        held.append(made)
        most.append(len(held))
        destroy = made.destroy
        made.destroy = lambda *a: (held.remove(made), destroy(*a))
        return made

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", counted)
    docs, items = corpus(5)
    assert contaminated(*frames(spark, docs, items)).count() > 10
    assert len(most) > 3 and max(most) == 1 and not held
