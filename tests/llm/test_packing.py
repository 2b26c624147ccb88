"""Packing: ids, pieces, gapless sequences, and how few of them."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from farebox.llm import packing
from farebox.llm.packing import CAPACITY, Packing, _encoding, crossover, evolve, pack

TEXTS = ["", None, "Hello world, it's 2024!", "  many   spaces\n\n\t tabs ", "é漢字 👩‍👩‍👧 ñ", "<|endoftext|> x", "a" * 3000,
         "a<|endoftext|><|endoftext|>b <|endoftext| > <|endoftext|>\n", " <|endoftext|> ", "x" * 50 + "<|endoftext|>",
         " \x85\x1c mixed \xa0 space", "I'LL we'Ll don’t ſ Ⅷ ½"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_are_those_of_the_tokenizers_library(tokenizer):
    rng = random.Random(1)
    odd = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), 10, 32, 9])) for _ in range(80))
           for _ in range(300)]
    parts = ["<|endoftext|>", "<|", "endoftext", "|>", " ", "word", "é", "\n", "'s"]
    odd += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    encoding = _encoding("byte_bpe_50k.tiktoken")
    for text in [t or "" for t in TEXTS] + odd:
        assert encoding.encode_to_numpy(text, allowed_special="all").tolist() == ids(tokenizer, text)[:-1]
    assert ids(tokenizer, "<|endoftext|>") == [50256, 0]


def test_pieces_and_sequences(spark, sf, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(TEXTS)]
    rows.append((20_000, " word" * (2 * CAPACITY + 6)))
    rows.append((20_001, " word" * (CAPACITY - 1)))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS piece", "'s' AS shard")
    got = pack(df).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == {i for i, _ in rows}
    for doc, text in rows:
        whole, pieces = np.array(ids(tokenizer, text), dtype="<u4"), sorted(by_doc[doc], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert [p.length for p in pieces[1:]] == [CAPACITY] * (len(pieces) - 1) and 0 < pieces[0].length <= CAPACITY
        at = 0
        for p in pieces:
            assert p.start == at and p.ids_crc32 == zlib.crc32(whole[at : at + p.length].tobytes())
            at += p.length
        assert at == len(whole)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= CAPACITY
    lower = -(-sum(r.length for r in got) // CAPACITY)
    assert len(by_sequence) <= 1.02 * lower + 1


def test_shards_are_packed_again_together(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 12)
    df = spark.range(120).selectExpr("id AS doc_id", "repeat(' word', cast(300 + id * 7 as int)) AS text")
    got = pack(df).collect()
    assert len(got) == 120 and len({(r.doc_id, r.piece) for r in got}) == 120
    assert len({r.sequence_id for r in got}) <= 1.1 * sum(r.length for r in got) / CAPACITY + 2


def test_repeated_rows_are_documents_of_their_own_and_no_rows_give_none(spark):
    df = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "x")], "doc_id long, text string")
    got = pack(df).collect()
    assert len(got) == 3 and len({(r.sequence_id, r.offset) for r in got}) == 3
    assert pack(df.limit(0)).collect() == []


def solutions(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 1400) for _ in range(300)]
    both = []
    for _ in range(2):
        found = Packing(lengths, CAPACITY)
        found.best_fit(rng.sample(range(300), 300))
        both.append(found)
    return lengths, both, rng


def test_crossover_keeps_every_document_once_and_injects_whole_bins():
    lengths, (a, b), rng = solutions(3)
    child = crossover(a, b, rng)
    assert sorted(i for items in child.bins for i in items) == list(range(300))
    assert all(sum(lengths[i] for i in items) <= CAPACITY for items in child.bins)
    assert sum(set(items) <= set(c) for items in b.bins for c in child.bins) >= len(b.bins) // 4 - 1


def triplets(seed, bins):
    """Lengths that fill ``bins`` sequences exactly, three to each, none of them a simple part of it."""
    rng, out = random.Random(seed), []
    for _ in range(bins):
        a = rng.randint(CAPACITY * 38 // 100, CAPACITY * 49 // 100)
        b = rng.randint(CAPACITY // 4 + 1, (CAPACITY - a) // 2)
        out += [a, b, CAPACITY - a - b]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_triplets_are_packed_below_best_fit_decreasing(seed):
    lengths = triplets(seed, 200)
    plain = Packing(lengths, CAPACITY)
    plain.best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]))
    bins, _ = evolve(lengths, [], seed, CAPACITY)
    again, fitness = evolve(lengths, [bins], seed + 50, CAPACITY)
    assert -fitness[0] <= min(202, len(plain.bins) - 1) and len(set(again)) == -fitness[0]
    sizes = {}
    for item, number in enumerate(again):
        sizes[number] = sizes.get(number, 0) + lengths[item]
    assert max(sizes.values()) <= CAPACITY and sum(sizes.values()) == 200 * CAPACITY


def test_replacement_keeps_items_and_fills_bins():
    lengths, (a, _), rng = solutions(6)
    loose = [i for items in a.bins[-40:] for i in items]
    less = Packing(lengths, CAPACITY)
    for items in a.bins[:-40]:
        less.add_bin(list(items))
    before = sum(less.free)
    left = less.replace(loose, rng)
    assert sorted([*left, *(i for items in less.bins for i in items)]) == list(range(300))
    assert all(f == CAPACITY - sum(lengths[i] for i in items) >= 0 for f, items in zip(less.free, less.bins))
    assert sum(less.free) < before and len(left) > 0
    assert sorted(at for stack in less.by_space.values() for at in stack) == [at for at, f in enumerate(less.free) if f]


def test_evolution_never_loses_to_best_fit_decreasing_and_repeats_itself():
    lengths, (a, _), _ = solutions(4)
    plain = Packing(lengths, CAPACITY)
    plain.best_fit(sorted(range(300), key=lambda i: -lengths[i]))
    bins, fitness = evolve(lengths, [], 7, CAPACITY)
    assert fitness >= plain.fitness() and evolve(lengths, [], 7, CAPACITY) == (bins, fitness)
    assert evolve(lengths, [bins], 8, CAPACITY)[1] >= fitness
