"""Language identification by prediction by partial matching: the language whose frozen model codes a text shortest."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.bytes import CHUNK_BYTES, Chunk, text_chunks
from farebox.llm.session import bound_batches
from farebox.sources.scratch import cut_lineage

ORDER = 4  # bytes of the longest context
NODES = 1 << 16  # nodes of the merged context tree; the share of the rarest node follows from it
LANGUAGES = 256  # the most frequent ones are learnt
HELD = 1 << 20  # distinct grams that a counting task holds
UNKNOWN = "und"
_DEAD, _ROOT = 0, 1


def _padded(chunk: Chunk, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's bytes with ``order`` zero bytes before each text, and each byte's place in them."""
    rows = len(chunk.offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(chunk.offsets))
    place = np.arange(len(chunk.data)) + order * (row + 1)
    out = np.zeros(len(chunk.data) + order * rows, dtype=np.uint8)
    out[place] = chunk.data
    return out, place


def _grams(chunk: Chunk, order: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first byte, each byte after its ``order`` predecessors as one number), for slices of a chunk."""
    data, place = _padded(chunk, order)
    for at in range(0, len(place), CHUNK_BYTES):
        here = place[at : at + CHUNK_BYTES]
        gram = np.zeros(len(here), dtype=np.uint64)
        for back in range(order, -1, -1):
            gram = (gram << np.uint64(8)) | data[here - back]
        yield at, gram


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key)
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    return key[first], np.add.reduceat(count, first) if len(key) else count


def _counted(order: int):
    """(lang, text) -> (lang, gram, n): grams of order + 1 bytes, counted in the task as far as they fit."""
    bits = np.uint64(8 * (order + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        key, count = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

        def out() -> pa.RecordBatch:
            known = pa.array(list(names), pa.string())
            lang = known.take(pa.array((key >> bits).astype(np.int64)))
            gram = (key & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
            return pa.RecordBatch.from_arrays([lang, pa.array(gram), pa.array(count)], ["lang", "gram", "n"])

        for batch in batches:
            ids = np.array([names.setdefault(v, len(names)) for v in batch.column(0).to_pylist()], dtype=np.uint64)
            keys, counts = [key], [count]
            for chunk in text_chunks(batch.column(1)):
                lang = np.repeat(ids[chunk.lo : chunk.hi], np.diff(chunk.offsets))
                for at, gram in _grams(chunk, order):
                    found, n = np.unique(gram | (lang[at : at + len(gram)] << bits), return_counts=True)
                    keys.append(found)
                    counts.append(n)
            key, count = _merged(keys, counts)
            if len(key) > HELD:
                yield out()
                names, key, count = {}, key[:0], count[:0]
        yield out()

    return run


class Statistics(NamedTuple):
    """Frozen counts: grams (length, bytes as a number) and how often each language holds them."""

    langs: list[str]
    length: np.ndarray
    gram: np.ndarray
    count: np.ndarray
    order: int


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learnt from: crc32 of the id's text, modulo 4, is 2. A null id: false."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, order: int = ORDER, nodes: int = NODES, languages: int = LANGUAGES) -> Statistics:
    """Count every byte of every text that may be learnt from, after each context of up to ``order`` bytes.

    Tasks count grams of order + 1 bytes; shorter ones are sums over their endings. A gram's share
    is that of the language in which it is most frequent. Grams are kept by share, in levels of an eighth of
    a power of two, as far down as ``nodes`` grams reach; what is kept holds the beginnings and endings
    of every gram, since these are no rarer. Only the kept counts reach the driver: nodes x languages numbers.
    """
    bound_batches(docs.sparkSession)
    texts = docs.where(~held_out()).where("text IS NOT NULL AND lang IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text")
    longest = texts.mapInArrow(_counted(order), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    longest = cut_lineage(longest)
    totals = longest.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "lang").limit(languages).collect()
    if not totals:
        return Statistics([], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros((0, 0), dtype=np.int64), order)
    known = docs.sparkSession.createDataFrame([(r.lang, r.total) for r in totals], "lang string, total long")
    endings = F.explode(F.array(*[
        F.struct(F.lit(m).alias("length"), F.col("gram").bitwiseAND((1 << (8 * m)) - 1).alias("gram")) for m in range(1, order + 2)
    ]))
    grams = (
        longest.join(F.broadcast(known), "lang").select("lang", "total", "n", endings.alias("e"))
        .groupBy("e.length", "e.gram", "lang").agg(F.sum("n").alias("n"), F.first("total").alias("total"))
        .groupBy("length", "gram").agg(F.collect_list(F.struct("lang", "n")).alias("counts"), F.max(F.col("n") / F.col("total")).alias("share"))
        .withColumn("level", F.floor(F.log2("share") * 8))
    )
    grams = cut_lineage(grams)
    room, cut = nodes, None
    for r in grams.groupBy("level").count().orderBy(F.desc("level")).collect():  # fewer than 600 levels
        room -= r["count"]
        if room < 0:
            break
        cut = r.level
    kept = grams.where(F.col("level") >= F.lit(cut)).select("length", "gram", F.explode("counts").alias("c"))
    table = kept.select("length", "gram", "c.lang", "c.n").toArrow()
    langs = sorted(r.lang for r in totals)
    length, gram, n = (table.column(c).to_numpy().astype(np.int64) for c in ("length", "gram", "n"))
    lang = np.searchsorted(np.array(langs, dtype=object), np.array(table.column("lang").to_pylist(), dtype=object))
    # contexts of nothing but the padding are no grams, but lead to some
    key = np.concatenate([(length << 48) | gram, np.arange(1, order + 1) << 48])
    node, place = np.unique(key, return_inverse=True)
    count = np.zeros((len(node), len(langs)), dtype=np.int64)
    np.add.at(count, (place[: len(gram)], lang), n)
    return Statistics(langs, node >> 48, node & ((1 << 48) - 1), count, order)


class Trees:
    """The context trees of all languages, merged: one node for each gram, one count in it for each language.

    A symbol is coded in the longest context that its language knows, with probability n / (T + D), T being
    the occurrences and D the distinct symbols there; with D / (T + D) the coder escapes to the context a byte
    shorter, where symbols of the longer one are excluded from T and D. Symbols seen nowhere share
    what is left evenly. The probabilities of all bytes add up to 1, so bits are exact code lengths.
    """

    def __init__(self, stats: Statistics) -> None:
        self.order, self.langs = stats.order, stats.langs
        size, shape = len(stats.gram) + 2, (len(stats.gram) + 2, len(stats.langs))
        key = (stats.length << 48) | stats.gram  # ascending

        def node_of(length: np.ndarray, gram: np.ndarray) -> np.ndarray:
            return np.where(length > 0, np.searchsorted(key, (length << 48) | gram) + 2, _ROOT)

        here = np.arange(2, size)
        self.before = np.zeros(size, dtype=np.int64)  # the context of a node's last byte
        self.before[2:] = node_of(stats.length - 1, stats.gram >> 8)
        self.shorter = np.zeros(size, dtype=np.int64)  # the node without its first byte
        self.shorter[2:] = node_of(stats.length - 1, stats.gram & ((1 << (8 * (stats.length - 1))) - 1))
        self.depth = np.concatenate([[0, 0], stats.length])
        self.count = np.concatenate([np.zeros((2, shape[1]), dtype=np.int64), stats.count]).astype(np.float64)
        seen = (self.count > 0).astype(np.float64)
        self.total, self.kinds, excluded = np.zeros(shape), np.zeros(shape), np.zeros(shape)
        np.add.at(self.total, self.before[2:], self.count[2:])
        np.add.at(self.kinds, self.before[2:], seen[2:])
        np.add.at(excluded, self.before[2:], self.count[self.shorter[2:]] * seen[2:])
        # what the context one byte shorter offers to a coder that escaped from here
        self.rest_total = self.total[self.shorter] - excluded
        self.rest_kinds = self.kinds[self.shorter] - self.kinds

        inner = int((self.depth <= self.order).sum())
        self.symbols = np.zeros(256, dtype=np.int64)  # bytes that occur in grams, numbered from 1
        last = stats.gram & 255
        self.symbols[np.unique(last)] = np.arange(1, len(np.unique(last)) + 1)
        self.next = np.zeros((inner, int(self.symbols.max(initial=0)) + 1), dtype=np.int32)
        self.next[self.before[2:], self.symbols[last]] = here
        self.cost = np.zeros(shape, dtype=np.float32)
        self.cost[2:] = self._bits(self.before[2:], here)

    def _bits(self, context: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Bits of a symbol after ``context`` (its longest known one). ``node``: the longest known gram that
        ends in the symbol and begins in the context or an ending of it; ``_DEAD`` if there is none."""
        bits = np.zeros((len(context), len(self.langs)))
        done, escaped = np.zeros(bits.shape, dtype=bool), np.zeros(bits.shape, dtype=bool)
        context, node, came = context.copy(), node.copy(), np.zeros(len(context), dtype=np.int64)
        with np.errstate(divide="ignore", invalid="ignore"):
            for _ in range(self.order + 1):
                live = context > _DEAD
                fits = live & (self.depth[node] == self.depth[context] + 1) & (node > _DEAD)
                total = np.where(escaped, self.rest_total[came], self.total[context])
                kinds = np.where(escaped, self.rest_kinds[came], self.kinds[context])
                count = np.where(fits[:, None], self.count[node], 0)
                open_ = live[:, None] & ~done & (self.total[context] > 0)
                found = open_ & (count > 0)
                missed = open_ & ~found & (kinds > 0)
                bits += np.where(found, np.log2(total + kinds) - np.log2(count), 0)
                bits += np.where(missed, np.log2(total + kinds) - np.log2(kinds), 0)
                done |= found
                escaped = np.where(live[:, None], open_ & ~found, escaped)
                came = np.where(live, context, came)
                node = np.where(fits, self.shorter[node], node)
                node[node == _ROOT] = _DEAD
                context = np.where(context > _ROOT, self.shorter[context], _DEAD)
            left = 256 - self.kinds[_ROOT]
            return bits + np.where(done, 0, np.log2(np.maximum(left, 1)))

    def _positions(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each byte: its longest known context, the gram of both (or ``_DEAD``), the longest known gram."""
        symbol = self.symbols[data]
        context = np.full(len(data), _ROOT, dtype=np.int32)
        chain = self.next[_ROOT][symbol]
        gram, longest = chain, chain
        for _ in range(self.order):
            held = np.concatenate([np.zeros(1, dtype=np.int32), chain[:-1]])  # the context of this length
            chain = self.next[held, symbol]
            known = held > _DEAD
            context = np.where(known, held, context)
            gram = np.where(known, chain, gram)
            longest = np.where(chain > _DEAD, chain, longest)
        return context, gram, longest

    def code_lengths(self, chunk: Chunk) -> np.ndarray:
        """Bits of each text of the chunk in each language."""
        rows = len(chunk.offsets) - 1
        out = np.zeros((rows, len(self.langs)))
        if not self.langs:
            return out
        data, place = _padded(chunk, self.order)
        for at in range(0, len(place), CHUNK_BYTES):
            here = place[at : at + CHUNK_BYTES]
            low = here[0] - self.order
            context, gram, longest = (a[here - low] for a in self._positions(data[low : here[-1] + 1]))
            bits = self.cost[gram].astype(np.float64)
            odd = np.flatnonzero(gram == _DEAD)
            pairs, which = np.unique((context[odd].astype(np.int64) << 32) | longest[odd], return_inverse=True)
            bits[odd] = self._bits(pairs >> 32, pairs & 0xFFFFFFFF)[which]
            row = np.searchsorted(chunk.offsets, np.arange(at, at + len(here)), side="right") - 1
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            out[row[first]] += np.add.reduceat(bits, first, axis=0)
        return out


@lru_cache(maxsize=1)
def _trees(shared) -> Trees:
    """Built once in each worker process."""
    return Trees(shared.value)


def _scored(shared):
    """(doc_id, held_out, readable, text) -> (doc_id, held_out, lang_pred, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _trees(shared)
        names = pa.array([*trees.langs, UNKNOWN], pa.string())
        for batch in batches:
            bits = [trees.code_lengths(c) for c in text_chunks(batch.column(3))]
            bits = np.concatenate(bits) if bits else np.zeros((0, len(trees.langs)))
            readable = batch.column(2).to_numpy(zero_copy_only=False) & bool(trees.langs)
            best, score = np.full(len(bits), len(trees.langs)), np.zeros(len(bits))
            if trees.langs:
                best = np.where(readable, bits.argmin(axis=1), best)
                score = np.where(readable, 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), names.take(pa.array(best)), pa.array(score)],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    return run


def languages_of(docs: DataFrame, order: int = ORDER, nodes: int = NODES, languages: int = LANGUAGES) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Learns (``train``) from texts and non-null ``lang`` of the rows that are not held out, and codes every
    whole text with each language's frozen statistics (``Trees``); a text starts in a context of zero bytes.
    lang_pred has the shortest code, ties go to the first name; score is its share of 2**-bits over
    all languages. Only the text enters a prediction. The statistics that workers receive have at most
    ``nodes`` grams for at most ``languages`` languages, the most frequent ones, however large the input.

    A null text, one without a letter (an empty one too) and any text where nothing could be learnt is
    ``und`` with score 0. A null doc_id is not held out. Rows that are repeated count, and are
    predicted, each for itself. No documents: no rows. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, order, nodes, languages))
    readable = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), readable.alias("readable"), "text")
    return rows.mapInArrow(_scored(shared), "doc_id long, held_out boolean, lang_pred string, score double")
