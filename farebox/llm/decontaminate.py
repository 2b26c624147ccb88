"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, shared shingles, exact check."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.bitmap import part_by_ids
from farebox.llm.bytes import Words, shingles_of, text_chunks, words_of
from farebox.llm.session import bound_batches
from farebox.sources.scratch import cut_lineage

SHINGLE = 5
THRESHOLD = 0.75
PERCENT = 75  # of the plain similarity, compared in integers
BLOCKS = 8  # of 8 bits
RADIUS = 15  # a fingerprint within this Hamming distance differs by one bit at most in one of the blocks
PAIRS = 1 << 16  # fingerprints that are compared at a time
BLOCK_WORDS = 2_000_000  # benchmark words that are broadcast at once; a larger benchmark takes more passes


def word_table() -> np.ndarray:
    """Words are runs of ASCII letters and digits and of all bytes beyond ASCII, A-Z as a-z."""
    table = np.zeros(256, dtype=np.uint8)
    for low, high in ((48, 58), (97, 123), (128, 256)):
        table[low:high] = np.arange(low, high)
    table[65:91] = np.arange(97, 123)
    return table


def fingerprints(hashes: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """64-bit SimHash of the words [start, start+size): the majority of each hash bit, as 8 bytes each."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    sums = np.zeros((len(hashes) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    return np.packbits(2 * (sums[start + size] - sums[start]) > size, axis=1)


class Sized(NamedTuple):
    """The benchmark items of one number of words, with their multi-index."""

    ids: np.ndarray
    prints: np.ndarray  # (items, 8) bytes
    orders: list[np.ndarray]  # per block: items by block value
    values: list[np.ndarray]
    shingles: list[tuple[np.ndarray, np.ndarray]]  # distinct hashes and counts
    posted: np.ndarray  # shingles of the items, sorted, once for each item that holds them
    poster: np.ndarray  # the item of each
    count: np.ndarray  # shingles per item
    weight: np.ndarray  # of all of an item's shingles


class Index(NamedTuple):
    sizes: dict[int, Sized]
    known: np.ndarray  # all item shingles, sorted
    weight: np.ndarray  # of each known shingle
    unknown: float  # of any other
    of_shingle: list[np.ndarray]  # sizes of the items that hold a known shingle
    gate: np.ndarray  # by the low bits of a shingle: may be known


def build_index(items: list[tuple[int, bytes]], total: int, seen: dict[int, int]) -> Index:
    """Index (item_id, bytes of its word and shingle hashes). ``total``: distinct item texts; ``seen``: how many
    of them hold a shingle."""
    by_size: dict[int, list] = {}
    for item_id, words, shingles in items:
        words, shingles = np.frombuffer(words, dtype=np.uint64), np.frombuffer(shingles, dtype=np.uint64)
        by_size.setdefault(len(words), []).append((item_id, words, shingles))
    known = np.unique(np.concatenate([s for group in by_size.values() for _, _, s in group]))
    weight = np.array([math.log(1 + total / seen[s]) for s in known.tolist()])
    sizes, holders = {}, {}
    for size, group in by_size.items():
        prints = np.concatenate([fingerprints(w, np.array([0]), size) for _, w, _ in group])
        orders = [np.argsort(prints[:, b], kind="stable") for b in range(BLOCKS)]
        counted = [np.unique(s, return_counts=True) for _, _, s in group]
        posted = np.concatenate([c[0] for c in counted])
        poster = np.repeat(np.arange(len(group)), [len(c[0]) for c in counted])
        order = np.argsort(posted, kind="stable")
        sizes[size] = Sized(
            np.array([g[0] for g in group]), prints, orders, [prints[o, b] for b, o in enumerate(orders)], counted,
            posted[order], poster[order], np.array([n.sum() for _, n in counted]),
            np.array([(weight[np.searchsorted(known, s)] * n).sum() for s, n in counted]),
        )
        for s in np.unique(np.concatenate([c[0] for c in counted])).tolist():
            holders.setdefault(s, []).append(size)
    bits = min(24, max(10, (32 * len(known)).bit_length()))
    gate = np.zeros(1 << bits, dtype=bool)
    gate[(known & np.uint64((1 << bits) - 1)).astype(np.int64)] = True
    return Index(sizes, known, weight, math.log(1 + total), [np.array(holders[s]) for s in known.tolist()], gate)


_NEAR = np.array([0, *(1 << bit for bit in range(8))], dtype=np.uint8)  # what makes a block differ by at most one bit
_ONES = np.array([bin(v).count("1") for v in range(256)], dtype=np.uint8)


def _candidates(sized: Sized, prints: np.ndarray) -> np.ndarray:
    """All (window, item) rows whose fingerprints are within ``RADIUS`` bits of each other.

    If no block differed by less than two bits, both would be 16 bits apart. So each block's index is asked for
    the window's value and the eight values one bit away, and what it gives is kept by its distance.
    """
    found = [np.zeros((0, 2), dtype=np.int64)]
    for b in range(BLOCKS):
        asked = (prints[:, b, None] ^ _NEAR[None, :]).ravel()
        low = np.searchsorted(sized.values[b], asked, side="left")
        count = np.searchsorted(sized.values[b], asked, side="right") - low
        window = np.repeat(np.arange(len(asked)) // len(_NEAR), count)
        place = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        item = sized.orders[b][place]
        for at in range(0, len(window), PAIRS):
            some = slice(at, at + PAIRS)
            far = _ONES[prints[window[some]] ^ sized.prints[item[some]]].sum(axis=1)
            near = far <= RADIUS
            found.append(np.stack([window[some][near], item[some][near]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def _sharing(
    sized: Sized, shingles: np.ndarray, place: np.ndarray, summed: np.ndarray, starts: np.ndarray, held: int
) -> np.ndarray:
    """(window, item) rows whose shared shingles allow a similarity of 0.75: none that has it is left out.

    ``place``: the shingles that an item of the size holds, in order; ``summed``: prefix sums of all
    shingles' weights. Repeats count as often as they stand in the window, so the bounds are not below
    what is shared; the union is what both sides hold less what they share.
    """
    low = np.searchsorted(sized.posted, shingles[place], side="left")
    count = np.searchsorted(sized.posted, shingles[place], side="right") - low
    spot = np.repeat(place, count)
    item = sized.poster[np.arange(len(spot)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)]
    slack = 1e-9 * (1 + sized.weight)
    held_weight = np.bincount(item, summed[spot + 1] - summed[spot], minlength=len(sized.ids))
    able = (100 * np.bincount(item, minlength=len(sized.ids)) >= PERCENT * sized.count) | (
        held_weight >= THRESHOLD * sized.weight - slack)
    order = np.argsort(item, kind="stable")
    bounds = np.searchsorted(item[order], np.arange(len(sized.ids) + 1))
    whole = summed[starts + held] - summed[starts]
    found = [np.zeros((0, 2), dtype=np.int64)]
    for i in np.flatnonzero(able).tolist():
        own = spot[order[bounds[i] : bounds[i + 1]]]
        part = np.concatenate([[0.0], np.cumsum(summed[own + 1] - summed[own])])
        a, b = np.searchsorted(own, starts), np.searchsorted(own, starts + held)
        plain = (100 + PERCENT) * (b - a) >= PERCENT * (held + sized.count[i])
        weighted = (1 + THRESHOLD) * (part[b] - part[a]) >= THRESHOLD * (whole + sized.weight[i]) - 1e-9 * (1 + summed[-1])
        window = np.flatnonzero(plain | weighted)
        found.append(np.stack([window, np.full(len(window), i)], axis=1))
    return np.concatenate(found)


def similarity(index: Index, window: np.ndarray, item: tuple[np.ndarray, np.ndarray]) -> tuple[float, int, int]:
    """Weighted Jaccard of two shingle multisets, and the sizes of their plain intersection and union.

    A shingle weighs ln(1 + item texts / item texts that hold it).
    """
    own, own_count = np.unique(window, return_counts=True)
    every = np.union1d(own, item[0])
    a, b = np.zeros(len(every)), np.zeros(len(every))
    a[np.searchsorted(every, own)] = own_count
    b[np.searchsorted(every, item[0])] = item[1]
    place = np.minimum(np.searchsorted(index.known, every), len(index.known) - 1)
    weight = np.where(index.known[place] == every, index.weight[place], index.unknown)
    both, either = np.minimum(a, b), np.maximum(a, b)
    return float((weight * both).sum() / (weight * either).sum()), int(both.sum()), int(either.sum())


def document_matches(
    index: Index, words: np.ndarray, shingles: np.ndarray, at: np.ndarray, unweighted: bool = False
) -> list[tuple]:
    """Best (item_id, start_word, n_words, hamming, similarity, plain) per item for one document.

    ``at``: the shingles that are known. Windows without any have similarity 0 to every item, so
    only windows that hold one are fingerprinted.
    """
    weight = np.full(len(shingles), index.unknown)
    weight[at] = index.weight[np.searchsorted(index.known, shingles[at])]
    summed = np.concatenate([[0.0], np.cumsum(weight)])
    spots: dict[int, list[int]] = {}
    for p in at.tolist():
        for size in index.of_shingle[int(np.searchsorted(index.known, shingles[p]))].tolist():
            spots.setdefault(size, []).append(p)
    best: dict[int, tuple] = {}
    for size, places in spots.items():
        width = min(size, len(words))
        held = max(1, width - SHINGLE + 1)
        place = np.array(places)
        starts = (place[:, None] - np.arange(held)[None, :]).ravel()
        starts = np.unique(starts[(starts >= 0) & (starts <= len(words) - width)])
        if not len(starts):
            continue
        base = int(starts[0])
        sized = index.sizes[size]
        prints = fingerprints(words[base : int(starts[-1]) + width], starts - base, width)
        sharing = _sharing(sized, shingles, place, summed, starts, held)
        for window, item in np.unique(np.concatenate([_candidates(sized, prints), sharing]), axis=0).tolist():
            start = int(starts[window])
            score, both, either = similarity(index, shingles[start : start + held], sized.shingles[item])
            if score >= THRESHOLD or unweighted and 100 * both >= PERCENT * either:
                far = int(np.unpackbits(prints[window] ^ sized.prints[item]).sum())
                row = (int(sized.ids[item]), start, width, far, score, both / either)
                old = best.get(row[0])
                if old is None or (-row[4], row[1]) < (-old[4], old[1]):
                    best[row[0]] = row
    return sorted(best.values())


def _per_row(words: Words, rows: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(words.row, minlength=rows))])


MATCH = "doc_id long, item_id long, start_word long, n_words long, hamming int, similarity double, plain double"


def _matches(shared, unweighted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        low_bits = np.uint64(len(index.gate) - 1)
        for batch in batches:
            ids, out = batch.column(0), []
            for chunk in text_chunks(batch.column(1)):
                rows = chunk.hi - chunk.lo
                words = words_of(chunk, word_table())
                shingles, bounds = shingles_of(words, rows, SHINGLE)
                maybe = np.flatnonzero(index.gate[(shingles & low_bits).astype(np.int64)])
                place = np.minimum(np.searchsorted(index.known, shingles[maybe]), len(index.known) - 1)
                hits = maybe[index.known[place] == shingles[maybe]]
                spans = _per_row(words, rows)
                row_of = np.searchsorted(bounds, hits, side="right") - 1
                for r in np.unique(row_of).tolist():
                    at = hits[row_of == r] - bounds[r]
                    own = words.hash[spans[r] : spans[r + 1]]
                    found = document_matches(index, own, shingles[bounds[r] : bounds[r + 1]], at, unweighted)
                    out += [(ids[chunk.lo + r].as_py(), *m) for m in found]
            if out:
                kinds = [pa.int64()] * 4 + [pa.int32(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                    ["doc_id", "item_id", "start_word", "n_words", "hamming", "similarity", "plain"],
                )

    return run


def _item_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in text_chunks(batch.column(1)):
            rows = chunk.hi - chunk.lo
            words = words_of(chunk, word_table())
            shingles, bounds = shingles_of(words, rows, SHINGLE)
            spans = _per_row(words, rows)
            columns = [
                batch.column(0).slice(chunk.lo, rows),
                pa.array(np.diff(spans)),
                pa.array([words.hash[a:b].tobytes() for a, b in zip(spans[:-1], spans[1:])], pa.binary()),
                pa.array([shingles[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                pa.array([np.unique(shingles[a:b]).view(np.int64).tolist() for a, b in zip(bounds[:-1], bounds[1:])],
                         pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "n_words", "words", "shingles", "distinct"])


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    unweighted: bool = False,
) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, start_word, n_words,
    hamming, similarity, plain. Documents without a match have no row.

    Every window of a text that has as many words as an item is a candidate for it (a shorter text
    is one window). Windows and items get 64-bit SimHash fingerprints of their words; items of a
    size are indexed by each of 8 blocks of their fingerprint and asked for blocks that differ by one bit at most, so
    every window within a Hamming distance of ``RADIUS`` = 15 is found. That is nearly every window of
    a similarity of 0.75; for the rare one beyond, windows that share enough of an item's
    shingles to be that similar are candidates too. A candidate counts if the weighted Jaccard similarity of its 5-word shingles with the item's
    (``similarity``) is 0.75 or more, weights falling with the number of distinct item texts that hold a
    shingle; with ``unweighted``, it counts as well if the similarity without weights (``plain``) is:
    changed words weigh most, so edited copies of items that share text with others reach 0.75 only
    without weights. The query and the pipeline ask for both. Of several windows, that of the highest
    weighted similarity is given, then the first.

    Null and empty texts and items match nothing. A text or an item of fewer than five words is one
    shingle, so such an item matches only texts that consist of it: inside a longer one so few
    words are no evidence. Items given twice count once. The item index is broadcast in blocks of at most
    about ``BLOCK_WORDS`` words (or one item), one pass over the documents for each, whose matches are written
    before the next block is built; the documents are neither shuffled nor collected.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    items = items.distinct().mapInArrow(
        _item_hashes, "item_id long, n_words long, words binary, shingles binary, distinct array<long>"
    ).where("n_words > 0")
    total, n_words = items.agg(F.countDistinct("words"), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    passes = -(-n_words // BLOCK_WORDS)
    once = items.dropDuplicates(["words"])  # an item that stands under several ids or in another case is one text
    seen = once.select(F.explode("distinct").alias("s")).groupBy("s").agg(F.count("*").alias("n"))
    found = spark.createDataFrame([], MATCH)
    for number in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(passes)) == number)
        rows = [tuple(r) for r in part.select("item_id", "words", "shingles").collect()]
        if not rows:
            continue
        own = part.select(F.explode("distinct").alias("s")).distinct().join(seen, "s")
        counts = {r.s & (2**64 - 1): r.n for r in own.collect()}
        shared = spark.sparkContext.broadcast(build_index(rows, total, counts))
        matches = texts.mapInArrow(_matches(shared, unweighted), MATCH)
        if passes > 1:  # one block is held at a time
            matches = cut_lineage(matches)
            shared.destroy()
        found = found.unionByName(matches)
    return found


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` less the documents in which a benchmark item is found by either similarity; a null doc_id stays."""
    bad = cut_lineage(contaminated(docs, benchmark, unweighted=True).select("doc_id").distinct())
    maybe, clean = part_by_ids(docs, "doc_id", bad, "doc_id")
    names = [f"c{i}" for i in range(len(docs.columns))]
    left = maybe.toDF(*names)
    left = left.join(bad, left[names[docs.columns.index("doc_id")]] == bad["doc_id"], "left_anti")
    return clean.unionByName(left.toDF(*docs.columns))
