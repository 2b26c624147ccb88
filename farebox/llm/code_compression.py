"""Vector codes by product quantisation; nearest entries by equal-average search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.operators.group_stats import fit_group_stats, lookup_join
from farebox.sources.scratch import cut_lineage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
ROWS = 4096  # vectors whose parts are searched at a time
_EXACT = 1 << 62


def integers(vectors: pa.Array, width: int, scale: int = SCALE) -> np.ndarray:
    """A (rows, width) matrix of floor(scale * x); shorter vectors are padded with 0.

    int64 where everything fits it, else Python integers, so any finite component is exact.
    """
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(values) and np.abs(values).max() >= _EXACT / scale:
        whole = np.array([_floor(x, scale) for x in values.tolist()], dtype=object)
    else:
        whole = np.floor(values * scale).astype(np.int64)
    out = np.zeros((len(sizes), width), dtype=whole.dtype)
    out[np.arange(width)[None, :] < sizes[:, None]] = whole
    return out


def _floor(x: float, scale: int) -> int:
    above, below = x.as_integer_ratio()
    return above * scale // below


def _searchable(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as int64 if squared sums of differences fit it, else as Python integers."""
    largest = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    dim = max(1, arrays[0].shape[1])
    return [a.astype(np.int64 if (2 * dim * largest) ** 2 < _EXACT else object) for a in arrays]


def nearest(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, squared distance) of each row, ties to the lower index, and how many
    distances that took.

    Entries stand in the order of their component sums. From its own sum a row goes outward, to the
    closer sum of both sides each time. The squared gap of two sums is at most the squared distance times
    the dimension (Cauchy-Schwarz), so the row is done when the gap squared is larger than its best
    distance times the dimension; where they are equal an entry could still tie, and is looked at.
    """
    part, book = _searchable(part, book)
    rows, dim = part.shape
    order = np.argsort(book.sum(axis=1), kind="stable")
    entries, sums, total = book[order], book.sum(axis=1)[order], part.sum(axis=1)
    high = np.searchsorted(sums, total)
    low = high - 1
    best = np.full(rows, -1, dtype=part.dtype)
    code = np.full(rows, len(book))
    live, looked = np.arange(rows), 0
    while len(live):
        left, right = low[live], high[live]
        more_left, more_right = left >= 0, right < len(sums)
        gap_left = total[live] - sums[np.maximum(left, 0)]
        gap_right = sums[np.minimum(right, len(sums) - 1)] - total[live]
        leftward = more_left & (~more_right | (gap_left <= gap_right))
        gap = np.where(leftward, gap_left, gap_right)
        able = (more_left | more_right) & ((best[live] < 0) | (gap * gap <= best[live] * dim))
        live, leftward = live[able], leftward[able]
        place = np.where(leftward, left[able], right[able])
        distance = ((part[live] - entries[place]) ** 2).sum(axis=1)
        known, index = best[live], order[place]
        better = (known < 0) | (distance < known) | ((distance == known) & (index < code[live]))
        best[live[better]], code[live[better]] = distance[better], index[better]
        low[live] -= leftward
        high[live] += ~leftward
        looked += len(live)
    return code, best, looked


class Books(NamedTuple):
    """``entries``: (parts, entries, dimension) integers; ``width``: components of a padded vector."""

    entries: np.ndarray
    width: int

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def coded(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, squared distances), a column for each part."""
        dim = self.entries.shape[2]
        found = [nearest(matrix[:, p * dim : (p + 1) * dim], book)[:2] for p, book in enumerate(self.entries)]
        return np.column_stack([c for c, _ in found]), np.column_stack([d for _, d in found])


def _blocks(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(0, len(column), ROWS):
        yield at, integers(column[at : at + ROWS], width)


_LIMB = 32


def _sums(shared):
    """Vectors -> what a task adds to each entry: (slot, place, limb, value), place -1 for the count.

    Sums are Python integers and leave in limbs of 32 bits, which Spark adds up without overflow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Books = shared.value
        parts, entries, dim = books.entries.shape
        count = np.zeros(parts * entries, dtype=np.int64)
        total = np.zeros((parts * entries, dim), dtype=object)
        for batch in batches:
            for _, matrix in _blocks(batch.column(0), books.width):
                slots = books.coded(matrix)[0] + np.arange(parts) * entries
                count += np.bincount(slots.ravel(), minlength=len(count))
                added = np.zeros(total.shape, dtype=matrix.dtype)
                np.add.at(added, slots.ravel(), matrix.reshape(slots.size, dim))
                total += added
        rows = [(s, -1, 0, int(n)) for s, n in enumerate(count) if n]
        for s, places in enumerate(total.tolist()):
            for place, value in enumerate(places):
                limb, sign, value = 0, -1 if value < 0 else 1, abs(value)
                while value:
                    rows.append((s, place, limb, sign * (value & ((1 << _LIMB) - 1))))
                    limb, value = limb + 1, value >> _LIMB
        kinds = {"slot": pa.int32(), "place": pa.int32(), "limb": pa.int32(), "value": pa.int64()}
        columns = zip(*rows) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))

    return run


def _refined(rows: DataFrame, books: Books) -> Books:
    """Each used entry becomes the floor of the mean of the parts it is nearest to."""
    shared = rows.sparkSession.sparkContext.broadcast(books)  # parts x entries x dimension numbers
    sums = rows.select("vector").mapInArrow(_sums(shared), "slot int, place int, limb int, value long")
    parts, entries, dim = books.entries.shape
    total: dict[tuple[int, int], int] = {}
    for r in sums.groupBy("slot", "place", "limb").agg(F.sum("value").alias("value")).collect():
        total[r.slot, r.place] = total.get((r.slot, r.place), 0) + (r.value << (_LIMB * r.limb))
    out = books.entries.reshape(parts * entries, dim).astype(object)
    for slot in range(parts * entries):
        count = total.get((slot, -1))
        if count:
            out[slot] = [total.get((slot, place), 0) // count for place in range(dim)]
    return Books(out.reshape(parts, entries, dim), books.width)


CODE = "vec_id long, label string, code string, error long"


def _codes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Books = shared.value
        for batch in batches:
            for at, matrix in _blocks(batch.column(2), books.width):
                codes, distances = books.coded(matrix)
                digits = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
                errors = pa.array([sum(row) for row in distances.tolist()], pa.int64())
                ids, labels = (batch.column(i)[at : at + ROWS] for i in (0, 1))
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(digits, pa.string()), errors],
                                                 ["vec_id", "label", "code", "error"])

    return run


def vector_codes(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256.

    Components become floor(256 * x) and vectors ``parts`` equal parts. Each part position has a codebook
    that starts as that part of the ``entries`` smallest ids; a round assigns every part to its nearest entry
    (``nearest``) and moves the entries to the floor of their means. A task sends on one partial sum
    for each entry, so neither a hot entry nor the number of vectors makes the shuffle larger; only the
    codebooks, whose size the dimension alone decides, pass through the driver. Errors of equal labels
    are summed map-side and joined back by ``lookup_join``, which spreads hot labels.

    Vectors that are null or hold null or non-finite components have no row. Components of any finite
    size are exact; an error beyond a 64-bit integer is refused by an exception. Shorter vectors, and
    widths that ``parts`` does not divide, are padded with zeros. Fewer vectors than ``entries`` make
    smaller codebooks. Rows that repeat an id stand for themselves, in the order of their vectors; a null id
    comes after all others and has a row as well. Null labels count as one label. No usable vector: no rows.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's index is two hex digits")
    spark, vector = vectors.sparkSession, F.col(vector_col)
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    label = F.coalesce(F.concat(F.lit("="), F.col(label_col).cast("string")), F.lit(""))
    rows = vectors.where(F.coalesce(finite, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), vector.cast("array<double>").alias("vector")
    )
    rows = cut_lineage(rows)
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], schema)
    width = -(-longest // parts) * parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).toArrow()
    start = integers(first.column(0).combine_chunks(), width)
    books = Books(start.reshape(len(start), parts, width // parts).transpose(1, 0, 2), width)
    for _ in range(rounds):
        books = _refined(rows, books)
    shared = spark.sparkContext.broadcast(books)
    coded = cut_lineage(rows.select("vec_id", "label", "vector").mapInArrow(_codes(shared), CODE))
    sums = fit_group_stats(coded, {"label": [F.sum("error").alias("label_error")]})["label"]
    joined = lookup_join(coded, sums, salt_cols=["vec_id", "code"])
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _round_sql(i: int) -> str:
    """CTEs a<i> (each part's nearest entry of codebook b<i>) and b<i+1>."""
    return f"""a{i} AS (
  SELECT rid, part, min((d, entry)) AS m FROM (
    SELECT v.rid, v.part, b.entry, (list_inner_product(v.x, v.x) + list_inner_product(b.x, b.x) - 2 * list_inner_product(v.x, b.x))::BIGINT AS d
    FROM v JOIN b{i} b USING (part)) GROUP BY rid, part
), u{i} AS (
  SELECT part, entry, list(mean ORDER BY place) AS x FROM (
    SELECT part, m[2] AS entry, place, floor(sum(x[place]) / count(*)) AS mean
    FROM a{i} JOIN v USING (rid, part), range(1, {{dim}} + 1) r(place) GROUP BY ALL) GROUP BY part, entry
), b{i + 1} AS (SELECT part, entry, coalesce(u{i}.x, b{i}.x) AS x FROM b{i} LEFT JOIN u{i} USING (part, entry))"""


#: For vectors of one length that 16 divides; DuckDB compares row-wise minima of (distance, entry).
SQL = f"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e,
    row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (
  SELECT rid, part, e[part * (len(e) // 16) + 1 : (part + 1) * (len(e) // 16)] AS x FROM k, range(0, 16) r(part)
), b0 AS (SELECT part, rid - 1 AS entry, x FROM v WHERE rid <= 64),
{_round_sql(0)},
{_round_sql(1)},
{_round_sql(2)},
c AS (
  SELECT rid, string_agg(printf('%02x', m[2]), '' ORDER BY part) AS code, sum(m[1])::BIGINT AS error FROM a2 GROUP BY rid
), h AS (
  SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: y::BIGINT), ','), ',' ORDER BY part, entry)) AS sha FROM b2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256
FROM k JOIN c USING (rid), h
""".replace("{dim}", "len(x)")
