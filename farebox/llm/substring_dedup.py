"""Exact removal of repeated byte strings by prefix-free parsing and merged suffix orders."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.bitmap import part_by_ids
from farebox.llm.bytes import row_slices, text_chunks
from farebox.llm.phrases import phrases, repeated_starts, window_of
from farebox.llm.session import bound_batches
from farebox.sources.scratch import cut_lineage, drop_scratch, scratch_path

LENGTH = 200
HOT = 2048  # distinct phrases that are ordered together; a context with more is divided
HOT_SHARE = 1024
ROWS = 8192


def _contexts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column(0)):
                for found in phrases(chunk, length):
                    yield pa.RecordBatch.from_arrays([pa.array(found.context.view(np.int64))], ["context"])

    return run


PHRASE = "context long, whole long, uid long, first int, lead short, spread short"


def _phrases(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid = batch.column(0).to_numpy(zero_copy_only=False)
            for chunk in text_chunks(batch.column(1)):
                for found in phrases(chunk, length):
                    columns = [
                        found.context.view(np.int64),
                        found.whole.view(np.int64),
                        uid[chunk.lo + found.row],
                        found.first.astype(np.int32),
                        (found.trigger - found.first).astype(np.int16),
                        (found.last - found.first).astype(np.int16),
                    ]
                    yield pa.RecordBatch.from_arrays(
                        list(map(pa.array, columns)), ["context", "whole", "uid", "first", "lead", "spread"]
                    )

    return run


ENTRY = "a long, b long, copies long, uid long, trigger int, before binary, after binary, kinds long"


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (uid, text, phrases) -> each phrase with its bytes up to its trigger and from there on."""
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary(), pa.binary(), pa.int64()]
    names = ["a", "b", "copies", "uid", "trigger", "before", "after", "kinds"]
    for batch in chain.from_iterable(map(row_slices, batches)):
        rows: list[tuple] = []
        for uid, text, found in zip(*(c.to_pylist() for c in batch.columns)):
            data = text.encode()
            for p in found:
                trigger = p["first"] + p["lead"]
                before, after = data[p["first"] : trigger], data[trigger : p["end"]]
                rows.append((p["context"], 0, p["copies"], uid, trigger, before, after, p["kinds"]))
        for at in range(0, len(rows), ROWS):
            part = zip(*rows[at : at + ROWS])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, kinds)], names)


def _suffix_runs(length: int):
    """Rows (a, b, copies, uid, trigger, before, after), sorted by a and b -> (uid, start, end) repeated."""

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        a, b, copies, uid, trigger, before, after = zip(*rows)
        groups = np.cumsum((np.diff(np.array(a), prepend=a[0]) != 0) | (np.diff(np.array(b), prepend=b[0]) != 0))
        once = np.array(copies) == 1  # the others are removed whole
        found = repeated_starts(groups, list(before), list(after), np.array(copies), length) & once[:, None]
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, low = np.nonzero(edge == 1)
        _, high = np.nonzero(edge == -1)
        at = np.array(trigger)[row]
        columns = [np.array(uid)[row], (at - high + 1).astype(np.int32), (at - low + length).astype(np.int32)]
        return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["uid", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= ROWS and row[:2] != held[-1][:2]:
                    yield spans(held)
                    held = []
                held.append(row)
        if held:
            yield spans(held)

    return run


def _that_repeat(rows: DataFrame, entries: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose entry (``keys``, copies) occurs more than once.

    Fewer than ``HOT_SHARE`` entries have more than that share of all copies; these are broadcast.
    """
    cut = max(1, (entries.agg(F.sum("copies")).first()[0] or 0) // HOT_SHARE)
    often = F.broadcast(entries.where(F.col("copies") > cut).select(keys))
    held = entries.where((F.col("copies") > 1) & (F.col("copies") <= cut)).select(keys)
    rest = rows.join(often, keys, "left_anti").join(held, keys, "left_semi")
    return rows.join(often, keys, "left_semi").unionByName(rest)


def _halves(rows: DataFrame, length: int) -> DataFrame:
    """Each entry of a part as up to two entries of narrower parts.

    A part holds strings that start ``lo`` to ``hi`` bytes before their trigger, so they share ``lo`` bytes before it and
    length - ``hi`` after it. A half of these offsets shares more, and its strings can only equal others that
    share the same: the shared bytes are its key. e1, e2: hashes of all bytes of a half's strings.
    """
    halves = rows.withColumn("half", F.explode(F.expr(
        "array(named_struct('lo', lo, 'hi', (lo + hi) div 2), named_struct('lo', (lo + hi) div 2 + 1, 'hi', hi))"
    )))
    near, far = f"greatest({length} - octet_length(after), half.lo)", "least(octet_length(before), half.hi)"
    cut = halves.withColumns({"near": F.expr(near).cast("int"), "far": F.expr(far).cast("int")}).where("near <= far").selectExpr(
        "a", "b", "half.lo AS lo", "half.hi AS hi", "near", "far", "copies", "uid", "trigger",
        "CASE WHEN far > 0 THEN substring(before, CAST(-far AS INT)) ELSE X'' END AS before", f"substring(after, 1, {length} - near) AS after",
    )
    shared = "CASE WHEN lo > 0 THEN substring(before, CAST(-lo AS INT)) ELSE X'' END", f"substring(after, 1, CAST({length} - hi AS INT))"
    return cut.selectExpr(
        f"xxhash64(a, lo, {shared[0]}, {shared[1]}) AS a", f"xxhash64({shared[1]}, hi, {shared[0]}, b) AS b", "lo", "hi", "near", "far",
        "copies", "uid", "trigger", "before", "after", "xxhash64(before, after, far) AS e1", "xxhash64(after, near, before) AS e2",
    )


def _ordered_parts(entries: DataFrame, length: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """(parts small enough to order, spans of repeated strings found on the way there).

    Parts of more than ``HOT`` distinct entries are halved (``_halves``) and what has become equal is
    combined, again and again: at the latest after log2(window) rounds a part is one string. Entries and
    not their strings travel; an entry that shares its key with no other goes no further.
    """
    rows = entries.selectExpr("*", "0L AS lo", f"{window_of(length) - 1}L AS hi")
    ready, spans = [], []
    while True:
        ready.append(rows.where(F.col("kinds") <= HOT).select("a", "b", "copies", "uid", "trigger", "before", "after"))
        large = rows.where(F.col("kinds") > HOT)
        if large.isEmpty():
            return ready, spans
        parts = cut_lineage(_halves(large, length))
        key = ["a", "b", "lo", "hi"]
        places = [F.min(F.struct("uid", "trigger")).alias("place"), F.min("before").alias("before"), F.min("after").alias("after")]
        combined = cut_lineage(parts.groupBy(*key, "e1", "e2").agg(F.sum("copies").alias("copies"), *places))
        found = _that_repeat(parts.where("copies = 1"), combined, ["a", "b", "e1", "e2"])
        spans.append(found.selectExpr("uid", "trigger - far AS start", f"trigger - near + {length} AS end"))
        kinds = cut_lineage(combined.groupBy("a", "b").agg(F.count("*").alias("kinds")).where("kinds > 1"))
        rows = combined.join(kinds, ["a", "b"]).selectExpr(
            "a", "b", "copies", "place.uid AS uid", "place.trigger AS trigger", "before", "after", "kinds", "lo", "hi"
        )
        rows = cut_lineage(rows)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        lists = [
            [{"start": a, "end": b} for a, b in merged([(s["start"], s["end"]) for s in spans])]
            for spans in batch.column(1).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, kind)], ["uid", "repeats"])


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with a column ``repeats``: the byte spans [start, end) covered by repeated strings.

    A string of ``length`` UTF-8 bytes is repeated if it starts anywhere else too, in the same
    text or another; matches never cross texts. Spans are maximal, sorted and disjoint; null, empty
    and short texts have none. Rows repeated in full count as further occurrences. A column that is
    called ``repeats`` already is replaced.

    1. Parse: texts become phrases at rolling-hash triggers (``phrases``). The bytes that follow a
       trigger in all strings of its phrase are its context; a context that occurs once in the
       corpus holds no repeated string, which leaves a small part of the parse.
    2. Dictionary: equal phrases with equal surroundings are one entry with a count, combined
       map-side. Entries that occur more than once are repeated whole, without looking inside; this is
       what makes highly repetitive text cheap.
    3. Suffix orders: distinct entries of one context meet in a task, which sorts the ends of its
       dictionary phrases and the suffixes of the parse and merges both orders; neighbours that
       share ``length`` bytes are repeated. Contexts with more than ``HOT`` distinct entries are divided
       by the longer bytes that fewer of their strings share, until each part fits (``_ordered_parts``).
    4. Spans are merged per text and joined to it by a 64-bit hash of id and text. Texts that surely
       have none (``part_by_ids``) are not shuffled.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.drop("repeats")
    uid = F.xxhash64(F.col(id_col), F.col(text_col))
    texts = docs.select(uid.alias("uid"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.where(F.octet_length("text") >= length)
    # aggregates are written before they are joined: only a join of two plain exchanges can be split
    # where a key is hot
    shared = texts.select("text").mapInArrow(_contexts(length), "context long").groupBy("context").count()
    shared = cut_lineage(shared.where("count > 1").select("context"))
    paths = [scratch_path(spark, "phrases"), scratch_path(spark, "strings")]
    found = texts.mapInArrow(_phrases(length), PHRASE)
    found.join(shared, "context", "left_semi").write.parquet(paths[0])
    parse = spark.read.parquet(paths[0])

    firsts = [F.first(c).alias(c) for c in ("uid", "first", "lead", "spread")]
    entries = cut_lineage(parse.groupBy("context", "whole").agg(F.count("*").alias("copies"), *firsts))
    kinds = cut_lineage(entries.groupBy("context").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    open_ = entries.join(kinds, "context").withColumn("end", F.expr(f"first + spread + {length}"))
    asked = open_.groupBy("uid").agg(
        F.collect_list(F.struct("context", "copies", "first", "lead", "end", "kinds")).alias("phrases")
    )
    asked = cut_lineage(asked)
    holders, _ = part_by_ids(texts, "uid", asked.select("uid"), "uid")
    sources = holders.dropDuplicates(["uid"]).join(asked, "uid")
    sources.mapInArrow(_entries, ENTRY).write.parquet(paths[1])

    whole = _that_repeat(parse, entries, ["context", "whole"])
    whole = whole.selectExpr("uid", "first AS start", f"first + spread + {length} AS end")
    ready, counted = _ordered_parts(spark.read.parquet(paths[1]), length)
    ordered = reduce(DataFrame.unionByName, ready).repartition("a", "b").sortWithinPartitions("a", "b")
    edges = ordered.mapInArrow(_suffix_runs(length), "uid long, start int, end int")
    spans = (
        reduce(DataFrame.unionByName, [whole, edges, *counted])
        .groupBy("uid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
        .mapInArrow(_merge, "uid long, repeats array<struct<start:int,end:int>>")
    )
    spans = cut_lineage(spans)
    drop_scratch(spark, *paths)
    empty = F.array().cast("array<struct<start:int,end:int>>").alias("repeats")
    safe = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], uid.alias("uid"))
    maybe, clean = part_by_ids(safe, "uid", spans, "uid")
    names = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    joined = maybe.join(spans, "uid", "left")
    return joined.select(*names, F.coalesce("repeats", empty).alias("repeats")).unionByName(clean.select(*names, empty))


DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chain.from_iterable(map(row_slices, batches)):
        rows = []
        for doc_id, text, repeats in zip(*(c.to_pylist() for c in batch.columns)):
            data, digest, at, removed = (text or "").encode(), hashlib.sha256(), 0, 0
            for span in repeats:
                digest.update(data[at : span["start"]])
                at, removed = span["end"], removed + span["end"] - span["start"]
            digest.update(data[at:])
            rows.append((doc_id, len(data), removed, len(repeats), digest.hexdigest()))
        kinds = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def repeat_digests(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, and the SHA-256 of the bytes outside ``repeats``."""
    return with_repeats(docs).select("doc_id", "text", "repeats").mapInArrow(_digests, DIGEST)


def _kept_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chain.from_iterable(map(row_slices, batches)):
        texts = []
        for text, repeats in zip(batch.column(-2).to_pylist(), batch.column(-1).to_pylist()):
            if repeats:
                data, at, parts = text.encode(), 0, []
                for span in repeats:
                    start, end = span["start"], span["end"]
                    while start < end and data[start] & 0xC0 == 0x80:  # keep a character that is half outside
                        start += 1
                    while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
                        end -= 1
                    parts.append(data[at:start])
                    at = end
                text = b"".join([*parts, data[at:]]).decode()
            texts.append(text)
        columns = [batch.column(i) for i in range(batch.num_columns - 2)] + [pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-2] + ["kept"])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated strings cut from its texts, every occurrence of them; all columns stay as they are.

    A character is removed only if all of its bytes are. Rows stay, if need be with an empty text; a
    null text stays null.
    """
    names = docs.columns
    safe = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    text = f"c{names.index(text_col)}"
    found = with_repeats(safe, f"c{names.index(id_col)}", text, length)
    carried = found.select(*[c for c in safe.columns if c != text], text, "repeats")
    cut = carried.mapInArrow(_kept_text, carried.drop(text, "repeats").schema.add("kept", "string"))
    return cut.select(*[F.col("kept" if f"c{i}" == text else f"c{i}").alias(c) for i, c in enumerate(names)])
