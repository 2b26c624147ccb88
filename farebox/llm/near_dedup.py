"""MinHash near-dedup: SuperMinHash signatures, banding, exact verification, union-find groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.bitmap import part_by_ids
from farebox.llm.bytes import distinct_per_row, mix, shingles_of, space_table, text_chunks, words_of
from farebox.llm.components import components
from farebox.llm.session import bound_batches
from farebox.llm.superminhash import band_keys, estimate, signatures, sketch
from farebox.sources.scratch import cut_lineage, drop_scratch, scratch_path

SHINGLE = 5
PERCENT = 75  # link at 100 * intersection >= 75 * union
BANDS, WIDTH = 40, 5  # a pair at exactly 0.75 shares no bucket with probability 2e-5
MARGIN = 0.15  # 4.9 standard deviations of the sketch estimate at 0.75
BLOCK_BYTES = 8 << 20  # of sets and signatures; two blocks are compared in a task
SPLIT = 8192  # ids of a bucket that are compared as they are
FINE_BANDS, FINE_WIDTH = 50, 4  # a pair at exactly 0.75 shares no key of these with probability 6e-9


def _shingle_sets(column: pa.Array) -> Iterator[tuple]:
    """(chunk, values, bounds) with the distinct shingles of each text of a column."""
    for chunk in text_chunks(column):
        found = shingles_of(words_of(chunk, space_table()), chunk.hi - chunk.lo, SHINGLE)
        yield (chunk, *distinct_per_row(*found))


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _fixed(matrix: np.ndarray) -> pa.Array:
    """Each row of a byte matrix as a binary value."""
    rows, width = matrix.shape
    flat = np.ascontiguousarray(matrix).tobytes()
    return pa.Array.from_buffers(
        pa.binary(), rows, [None, pa.py_buffer((np.arange(rows + 1) * width).astype(np.int32)), pa.py_buffer(flat)]
    )


PROFILE = "id long, n_shingles long, key1 long, key2 long, bands binary"


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, values, bounds in _shingle_sets(batch.column(1)):
            sig = signatures(values, bounds, BANDS * WIDTH)
            columns = [
                batch.column(0).slice(chunk.lo, chunk.hi - chunk.lo),
                pa.array(np.diff(bounds)),
                pa.array(_row_sums(mix(values ^ np.uint64(0x5851F42D4C957F2D)), bounds).view(np.int64)),
                pa.array(_row_sums(mix(values + np.uint64(0x14057B7EF767814F)), bounds).view(np.int64)),
                _fixed(band_keys(sig, BANDS, WIDTH).view(np.uint8)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_shingles", "key1", "key2", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, shingles): the sorted distinct shingle hashes, 8 bytes each."""
    for batch in batches:
        for chunk, values, bounds in _shingle_sets(batch.column(1)):
            flat = values.view(np.uint8)
            sets = [flat[a * 8 : b * 8].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            ids = batch.column(0).slice(chunk.lo, chunk.hi - chunk.lo)
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(bounds)), pa.array(sets, pa.binary())],
                                             ["id", "n", "shingles"])


def _linked(x: bytes, y: bytes) -> bool:
    """Whether two sorted sets of 8-byte hashes are similar enough."""
    x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
    if not len(x) or not len(y) or 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (a, b, sa, sb), the (a, b) whose sets are similar enough."""
    for batch in batches:
        pairs = zip(batch.column(2), batch.column(3))
        mask = pa.array([_linked(x.as_buffer(), y.as_buffer()) for x, y in pairs], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar on their full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b").where(f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)")
    return joined.select("a", "b", "sa", "sb").mapInArrow(_similar, "a long, b long")


def _cell_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, side, band, id, root, shingles), sorted by cell: the links found in each cell. One
    cell, of bounded bytes, is held at a time."""
    held: list = []
    cell = None
    for batch in batches:
        for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if key != cell and held:
                yield from _compare(held)
                held = []
            cell = key
            held.append(row)
    if held:
        yield from _compare(held)


def _compare(rows: list) -> Iterator[pa.RecordBatch]:
    """Links between rows of different roots. Sides 0 and 1 are two blocks of a bucket, compared
    with each other; rows of side 2 are compared among themselves.

    Pairs whose sketches reach the threshold less its margin are verified on their sets, in the
    first bucket they share. A link makes two roots one, so that no second link is looked for. Sets
    are all that is sent; sketches and bands are made of them again.
    """
    side, band, ids, root, sets = zip(*rows)
    side, ids, root, band = np.array(side), np.array(ids), np.array(root), band[0]
    bounds = np.concatenate([[0], np.cumsum([len(s) // 8 for s in sets])])
    sig = signatures(np.frombuffer(b"".join(sets), dtype=np.uint64), bounds, BANDS * WIDTH)
    bands, marks = band_keys(sig, BANDS, WIDTH), sketch(sig)
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    links = []
    for i in left.tolist():
        other = right[(root[right] != root[i]) & ((side[right] != 2) | (ids[right] > ids[i]))]
        if not len(other):
            continue
        likely = estimate((marks[other] == marks[i]).sum(axis=1), marks.shape[1]) >= PERCENT / 100 - MARGIN
        if band > 0:
            likely &= ~(bands[other, :band] == bands[i, :band]).any(axis=1)
        for j in other[likely].tolist():
            if root[i] != root[j] and _linked(sets[i], sets[j]):
                links.append((ids[i], ids[j]))
                root[root == root[j]] = root[i]
    if links:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])


def _mixed_buckets(rows: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """``rows`` (key, band, id, n) of buckets that hold more than one root, with root, size and bytes."""
    named = rows.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = (
        named.groupBy(key)
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"),
             F.sum(8 * F.col("n") + 10 * BANDS * WIDTH).alias("bytes"))
        .where("low < high")
        .select(key, "size", "bytes")
    )
    return named.join(cut_lineage(mixed), key)


def _cells(rows: DataFrame, key: str, sets: DataFrame) -> DataFrame:
    """Rows dealt to cells of two blocks of a bucket, with their sets."""
    dealt = rows.withColumn("blocks", F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int"))
    dealt = dealt.withColumn("block", F.expr("cast(pmod(xxhash64(id, 7), blocks) as int)")).join(sets, "id")
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        F.xxhash64(key, F.least("block", "other"), F.greatest("block", "other")).alias("cell"),
        F.expr("CASE WHEN block = other THEN 2 WHEN block < other THEN 0 ELSE 1 END").alias("side"),
        "band", "id", "root", "shingles",
    )


def _fine_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, shingles) -> (id, keys): bands of fewer slots than those of the buckets."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = part.column(1).to_pylist()
            bounds = np.concatenate([[0], np.cumsum([len(s) // 8 for s in sets])])
            sig = signatures(np.frombuffer(b"".join(sets), dtype=np.uint64), bounds, FINE_BANDS * FINE_WIDTH)
            keys = _fixed(band_keys(sig, FINE_BANDS, FINE_WIDTH).view(np.uint8))
            yield pa.RecordBatch.from_arrays([part.column(0), keys], ["id", "keys"])


def _missed_links(multi: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Links inside buckets between ids that ``roots`` leaves apart.

    Members of a bucket of more than ``SPLIT`` ids are compared where they also share a key of fewer
    slots: a pair over the threshold shares one of ``FINE_BANDS`` but for a chance of 6e-9, which is
    nothing beside that of sharing no bucket.
    """
    mixed = cut_lineage(_mixed_buckets(multi.select("bucket", "band", "id", "n"), roots, "bucket"))
    sets = sets.select("id", "shingles")
    small = _cells(mixed.where(F.col("size") <= SPLIT), "bucket", sets)
    members = cut_lineage(mixed.where(F.col("size") > SPLIT).select(F.col("bucket").alias("one"), "id", "n"))
    holders = sets.join(members.select("id").distinct(), "id", "left_semi")
    fine = holders.mapInArrow(_fine_keys, "id long, keys binary")
    spots = F.sequence(F.lit(0), F.lit(FINE_BANDS - 1))
    key = F.explode(F.transform(spots, lambda i: F.xxhash64(F.substring(F.col("keys"), i * 8 + 1, F.lit(8)), i)))
    split = members.join(cut_lineage(fine.select("id", key.alias("fine"))), "id")
    split = split.select(F.xxhash64("one", "fine").alias("part"), F.lit(-1).alias("band"), "id", "n")
    large = _cells(_mixed_buckets(split, roots, "part"), "part", sets)
    cells = small.unionByName(large).repartition("cell").sortWithinPartitions("cell")
    return cells.mapInArrow(_cell_links, "a long, b long")


def _buckets(classes: DataFrame) -> DataFrame:
    """(id, n, band, bucket): one row for each band of each class."""
    spots = F.sequence(F.lit(0), F.lit(BANDS - 1))
    key = F.transform(spots, lambda i: F.hex(F.substring(F.col("bands"), i * 8 + 1, F.lit(8))))
    each = classes.select("id", F.col("n_shingles").alias("n"), F.posexplode(key).alias("band", "hex"))
    return each.select("id", "n", "band", F.xxhash64("hex").alias("bucket"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Texts are compared by their sets of distinct 5-word shingles (A-Z lower-cased, words split at
    ASCII white space; a text of fewer words is one shingle). Two texts are linked when
    100 * |both| >= 75 * |either|; component_id is the smallest id reachable over links and kept
    marks the row that carries it.

    1. Rows with equal sets become one class, combined map-side, so copies cost nothing further.
    2. SuperMinHash signatures (``superminhash``) are cut into 40 bands of 5; a class gets one
       bucket per band. Each class is paired with the smallest id of each of its buckets and the
       pairs are verified on the full sets: linear in the rows whatever the size of a bucket.
    3. ``components`` groups the verified links. In buckets that still hold more than one group,
       the members of different groups are compared by signature and the likely pairs verified, in
       cells of bounded bytes that give back nothing but links; then the groups are built again. No
       pair is dropped: large buckets are split by keys of fewer slots and into blocks.

    Null or empty texts and texts without words have 0 shingles and link with nothing. Rows that
    share an id count as one document and so as linked. Rows with a null id take no part: their
    component_id is null and they are kept. Empty input gives no rows; other columns, whatever
    their names, are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    paths = [scratch_path(spark, "neardup") for _ in range(3)]
    docs.mapInArrow(_profile, PROFILE).write.parquet(paths[0])
    profile = spark.read.parquet(paths[0])
    (
        profile.where("n_shingles > 0 AND id IS NOT NULL")
        .groupBy("n_shingles", "key1", "key2")
        .agg(F.min("id").alias("id"), F.first("bands").alias("bands"))
        .write.parquet(paths[1])
    )
    classes = spark.read.parquet(paths[1])
    buckets = _buckets(classes)
    hubs = buckets.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("top")).where("hub < top")
    hubs = cut_lineage(hubs.select("bucket", "hub"))  # a join with a written table can be split at hot keys
    multi = cut_lineage(buckets.join(hubs, "bucket").select("bucket", "band", "id", "n", "hub"))

    wanted = cut_lineage(multi.select("id").distinct())
    asked, _ = part_by_ids(docs, "id", wanted, "id")
    asked = asked.join(wanted, "id", "left_semi")
    asked.mapInArrow(_sets, "id long, n long, shingles binary").write.parquet(paths[2])
    sets = spark.read.parquet(paths[2])
    stars = multi.where("id > hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    links = cut_lineage(_verify(stars, sets).distinct())
    roots = components(links).withColumnsRenamed({"node": "id"})
    rest = cut_lineage(_missed_links(multi, roots, sets))
    if not rest.isEmpty():
        roots = components(links.unionByName(rest)).withColumnsRenamed({"node": "id"})

    grouped = classes.join(roots, "id", "left").select(
        "n_shingles", "key1", "key2", F.coalesce("root", "id").alias("component")
    )
    rows = profile.select("id", "n_shingles", "key1", "key2")
    found = rows.where("n_shingles > 0 AND id IS NOT NULL").join(grouped, ["n_shingles", "key1", "key2"])
    alone = rows.where("n_shingles = 0 OR id IS NULL").withColumn("component", F.col("id"))
    result = cut_lineage(
        found.select(alone.columns).unionByName(alone).select(
            F.col("id").alias("doc_id"),
            "n_shingles",
            F.col("component").alias("component_id"),
            F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
        )
    )
    drop_scratch(spark, *paths)
    return result
