"""Quality scores by nearest-neighbour voting over labelled latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.bytes import Chunk, byte_codes, powers, span_hash, text_chunks, words_of
from farebox.llm.sample import first_by_hash
from farebox.llm.session import bound_batches

SAMPLE = 4096  # labelled documents that are voters, half of each label at most
WORD_SLOTS, SHAPE_SLOTS = 768, 256
LATENT = 64
NEIGHBOURS = 15
SHAPE_SHARE = 0.8  # of a vector's squared length


class Model(NamedTuple):
    """Broadcast to the tasks; its size follows from SAMPLE, the slots and LATENT alone."""

    idf: np.ndarray  # (slots,)
    basis: np.ndarray  # (slots, LATENT)
    voters: np.ndarray  # (sample, LATENT), unit length
    label: np.ndarray  # (sample,) 0 or 1
    weight: np.ndarray  # (sample,) labelled documents each voter stands for
    prior: float


def _spaced() -> np.ndarray:
    """Words split at ASCII white space, case kept."""
    table = np.arange(256, dtype=np.uint8)
    table[[32, *range(9, 14)]] = 0
    table[0] = 255
    return table


def _kinds() -> np.ndarray:
    """Byte -> kind: 1 upper case, 2 lower case or beyond ASCII, 3 digit, others each their own."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91], table[97:123], table[128:256], table[48:58] = 1, 2, 2, 3
    return table


def counts(chunk: Chunk) -> np.ndarray:
    """(rows, slots) hashed counts of a chunk's words and word shapes.

    A word's shape is its sequence of kinds of characters with repeats collapsed. Two more tokens
    tell whether a word repeats the one before it or the one before that.
    """
    rows, slots = chunk.hi - chunk.lo, WORD_SLOTS + SHAPE_SLOTS
    words = words_of(chunk, _spaced(), seed=11)
    if not len(words.hash):
        return np.zeros((rows, slots), dtype=np.float32)
    kind = _kinds()[chunk.data]
    turn = np.ones(len(kind), dtype=bool)
    turn[1:] = kind[1:] != kind[:-1]
    turn[words.start] = True
    before = np.concatenate([[0], np.cumsum(turn)])
    kept = kind[turn]
    prefix = np.zeros(len(kept) + 1, dtype=np.uint64)
    np.cumsum(byte_codes(12)[kept] * powers(len(kept)), out=prefix[1:])
    shape = span_hash(prefix, before[words.start], before[words.end])
    again = np.zeros(len(shape), dtype=np.uint64)
    for back in (2, 1):
        same = np.zeros(len(shape), dtype=bool)
        same[back:] = (words.hash[back:] == words.hash[:-back]) & (words.row[back:] == words.row[:-back])
        again[same] = back
    base = words.row * slots
    word_slot = (words.hash % np.uint64(WORD_SLOTS)).astype(np.int64)
    shape_slot = WORD_SLOTS + 3 + (shape % np.uint64(SHAPE_SLOTS - 3)).astype(np.int64)
    every = np.concatenate([base + word_slot, base + shape_slot, base + WORD_SLOTS + again.astype(np.int64)])
    return np.bincount(every, minlength=rows * slots).reshape(rows, slots).astype(np.float32)


def _weighted(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Term frequencies dampened, times idf; words and shapes each scaled to their share of length 1."""
    out = np.log1p(raw) * idf
    for part, share in ((slice(0, WORD_SLOTS), 1 - SHAPE_SHARE), (slice(WORD_SLOTS, None), SHAPE_SHARE)):
        norm = np.sqrt((out[:, part] ** 2).sum(axis=1, keepdims=True))
        out[:, part] *= np.sqrt(share) / np.maximum(norm, 1e-12)
    return out


def _latent(raw: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    vectors = _weighted(raw, idf) @ basis
    return vectors / np.maximum(np.sqrt((vectors**2).sum(axis=1, keepdims=True)), 1e-12)


def fit(raw: np.ndarray, label: np.ndarray, totals: dict[int, int], held: tuple[int, np.ndarray] | None = None) -> Model:
    """Latent-semantic vectors of the sampled rows. ``totals``: labelled documents of each label; ``held``: the
    number of documents and how many of them hold each slot (without it, of the sampled rows)."""
    slots = WORD_SLOTS + SHAPE_SLOTS
    all_rows = sum(totals.values())
    prior = totals.get(1, 0) / all_rows if all_rows else 0.5
    documents, holders = held or (len(raw), (raw > 0).sum(axis=0))
    idf = np.log((1 + documents) / (1 + holders)).astype(np.float32) + np.float32(1)
    full = _weighted(raw, idf) if len(raw) else np.zeros((0, slots), dtype=np.float32)
    values, vectors = np.linalg.eigh((full.T @ full).astype(np.float64))
    basis = vectors[:, np.argsort(values)[::-1][:LATENT]].astype(np.float32)
    sampled = {c: max(1, int((label == c).sum())) for c in (0, 1)}
    weight = np.array([totals.get(int(c), 0) / sampled[int(c)] for c in label], dtype=np.float32)
    return Model(idf, basis, _latent(raw, idf, basis), label.astype(np.float32), weight, prior)


def vote(model: Model, raw: np.ndarray) -> np.ndarray:
    """Scores: the share of label 1 among the nearest voters, by cosine and by what they stand for.

    Products are exact and in one block per chunk. Without any voter of positive cosine the score
    is the share of label 1 among all labelled documents.
    """
    near = min(NEIGHBOURS, len(model.voters))
    if not near or not len(raw):
        return np.full(len(raw), model.prior)
    cosine = _latent(raw, model.idf, model.basis) @ model.voters.T
    best = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
    weight = np.maximum(np.take_along_axis(cosine, best, axis=1), 0).astype(np.float64) ** 8
    weight *= model.weight[best]
    total = weight.sum(axis=1)
    score = (weight * model.label[best]).sum(axis=1) / np.maximum(total, 1e-300)
    return np.clip(np.where(total > 0, score, model.prior), 0, 1)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt: crc32 of the id's text, modulo 3, is 1. A null id: false."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, label, text) -> (doc_id, label, counts)."""
    for batch in batches:
        for chunk in text_chunks(batch.column(2)):
            rows = [row.tobytes() for row in counts(chunk).astype(np.uint32)]
            at = slice(chunk.lo, chunk.hi)
            yield pa.RecordBatch.from_arrays([batch.column(0)[at], batch.column(1)[at], pa.array(rows, pa.binary())],
                                             ["doc_id", "label", "counts"])


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> one row of a task: its documents, and how many of them hold each slot."""
    total, rows = np.zeros(WORD_SLOTS + SHAPE_SLOTS, dtype=np.int64), 0
    for batch in batches:
        for chunk in text_chunks(batch.column(0)):
            total += (counts(chunk) > 0).sum(axis=0)
            rows += chunk.hi - chunk.lo
    yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([total.tolist()], pa.list_(pa.int64()))], ["documents", "holders"])


def holders(texts: DataFrame) -> tuple[int, np.ndarray]:
    """The number of documents, and for each slot how many hold it: counted over all rows, summed in Spark."""
    tasks = texts.select("text").mapInArrow(_holders, "documents long, holders array<long>")
    each = tasks.select("documents", F.posexplode("holders").alias("slot", "n"))
    sums = each.groupBy("slot").agg(F.sum("documents").alias("documents"), F.sum("n").alias("n")).collect()  # a row a slot
    out = np.zeros(WORD_SLOTS + SHAPE_SLOTS, dtype=np.int64)
    for r in sums:
        out[r.slot] = r.n
    return (sums[0].documents if sums else 0), out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents, half of each label, the first by a hash of the id.

    Only labels 0 and 1 of rows that are not held out count; an id with several labels takes the
    more frequent one (a tie: 1), and one with several texts counts once. Document frequencies are those
    of all rows of ``docs`` (``holders``). The sample's counts and one sum for each slot are all
    that reaches the driver.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
        .where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .where(~held_out())
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    totals = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = [
        first_by_hash(known.where(F.col("label") == c), "doc_id", sample // 2, totals.get(c, 0), seed=8)
        .withColumn("label", F.lit(c)) for c in (0, 1)
    ]
    voters = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most ``sample`` rows of two numbers
    rows = (
        texts.join(voters, "doc_id").select("doc_id", "label", "text")
        .mapInArrow(_raw, "doc_id long, label int, counts binary")
        .groupBy("doc_id").agg(F.first("label").alias("label"), F.min("counts").alias("counts"))
        .collect()
    )
    rows.sort(key=lambda r: r.doc_id)
    raw = np.frombuffer(b"".join(r.counts for r in rows), dtype=np.uint32).reshape(len(rows), WORD_SLOTS + SHAPE_SLOTS)
    return fit(raw.astype(np.float32), np.array([r.label for r in rows], dtype=np.int64), totals, holders(docs))


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [vote(model, counts(chunk)) for chunk in text_chunks(batch.column(batch.num_columns - 1))]
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(score)], [*batch.schema.names[:-1], "score"]
            )

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Whole texts become hashed counts of words and of word shapes, weighted by the idf of all documents and
    projected on the leading singular vectors of a bounded labelled sample. The sample's unit vectors are
    broadcast; each document's exact cosines with all of them are computed block by block and the
    nearest vote for their label, weighted by similarity. Nothing but the text enters the score.

    A null or empty text has no words and scores the share of label 1 among the labelled rows (0.5
    without any labels). A null doc_id is not held out. Repeated rows score alike. No documents: no
    rows. Other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    scored = rows.mapInArrow(_scored(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_low_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` less the rows whose text scores below 0.5; a row's score needs no join back to it."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))
    safe = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    carried = docs.select(*[F.col(f"`{c}`").alias(s) for c, s in safe.items()], F.col("text").alias("scored"))
    schema = carried.drop("scored").schema.add("score", "double")
    kept = carried.mapInArrow(_scored(model), schema).where("score >= 0.5")
    return kept.select(*[F.col(s).alias(c) for c, s in safe.items()])
