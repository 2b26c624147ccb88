"""Vectorised work on the UTF-8 bytes of Arrow text columns: chunks, words, hashes, shingles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18  # arrays of 8 bytes and more for each byte: small chunks keep workers small
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, and 5 mod 8: powers have the full order
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; the input is left as it is."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@lru_cache(maxsize=8)
def byte_codes(seed: int) -> np.ndarray:
    """A random 64-bit code for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed))


_powers: dict[bool, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64, or those of its inverse."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        size = max(n, CHUNK_BYTES + 4096)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[inverse] = have
    return have[:n]


def prefix_hash(data: np.ndarray, seed: int = 0) -> np.ndarray:
    """len(data)+1 prefix sums of a polynomial hash; see ``span_hash``."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(byte_codes(seed)[data] * powers(len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte span [start, end); equal bytes give equal values wherever they stand."""
    raw = (prefix[end] - prefix[start]) * powers(len(prefix), True)[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


class Chunk(NamedTuple):
    """Rows lo..hi of a batch: their bytes, one after the other, and hi-lo+1 offsets."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Consecutive rows with at most ``limit`` bytes together; a longer text is a chunk of its own.

    Nulls count as empty texts. Nothing is cut.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return
    _, offsets, values = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, side="right")) - 1)
        yield Chunk(lo, hi, data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo])
        lo = hi


def row_slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that few of its texts are Python objects at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


class Words(NamedTuple):
    """Words of a chunk in text order: hash, row within the chunk, byte span."""

    hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray


def words_of(chunk: Chunk, table: np.ndarray, seed: int = 0) -> Words:
    """Words are maximal runs of bytes whose ``table`` entry is not 0; equal entries count as equal."""
    mapped = table[chunk.data]
    if len(mapped) == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(np.uint64), none, none, none)
    inside = mapped != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = chunk.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(mapped))]
    first[cuts] = inside[cuts]  # a text's first byte starts a word even if the text before ends in one
    last[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(chunk.offsets, start, side="right") - 1
    return Words(span_hash(prefix_hash(mapped, seed), start, end), row, start, end)


def space_table() -> np.ndarray:
    """Words of [^\\x20\\x09-\\x0D]+ with A-Z taken as a-z; 0 marks the white space."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[[32, *range(9, 14)]] = 0
    table[0] = 255  # byte 0 belongs to words; 255 never occurs in UTF-8
    return table


def shingles_of(words: Words, rows: int, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word shingles, ordered by row, and rows+1 bounds; repeats are kept.

    A row with 1 to n-1 words has one shingle, its whole sequence.
    """
    per_row = np.bincount(words.row, minlength=rows)
    begin = np.concatenate([[0], np.cumsum(per_row)])
    count = np.where(per_row >= n, per_row - n + 1, (per_row > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(count)])
    total = int(bounds[-1])
    row = np.repeat(np.arange(rows), count)
    at = np.arange(total) - bounds[row] + begin[row]
    hashes = np.zeros(total, dtype=np.uint64)
    length = np.minimum(per_row, n)[row]
    padded = np.concatenate([words.hash, np.zeros(n, dtype=np.uint64)])
    for j in range(n):
        factor = np.uint64(pow(0x8CB92BA72F3D8DD7, j + 1, 1 << 64))
        hashes += np.where(j < length, padded[at + j], np.uint64(0)) * factor
    return mix(hashes + length.astype(np.uint64)), bounds


def distinct_per_row(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each row, and new bounds."""
    parts = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    joined = np.concatenate(parts) if parts else values[:0]
    return joined, np.concatenate([[0], np.cumsum(sizes)])
