"""Prefix-free parsing of texts into phrases at rolling-hash triggers, and the order of suffixes.

A trigger is a place whose 8-byte rolling hash is the smallest of a window. Every ``length``-byte
string holds at least one trigger of its own, found from its bytes alone, so equal strings have it
at the same offset. A phrase is the run of string starts that share a trigger. A string starting in
a phrase is the end of that phrase (its bytes before the trigger) followed by what the parse
continues with, and two strings are equal exactly if both parts are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

from farebox.llm.bytes import Chunk, mix, prefix_hash, span_hash

PIECE_BYTES = 1 << 18
_GRAM = 8


class Phrases(NamedTuple):
    """Phrases of a chunk. ``row`` within the chunk, ``first``, ``last`` string start and
    ``trigger`` as byte offsets in the text; ``context``: hash of the bytes after the trigger that
    all strings of the phrase hold; ``whole``: hash of all their bytes."""

    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    trigger: np.ndarray
    context: np.ndarray
    whole: np.ndarray


def window_of(length: int) -> int:
    """Trigger candidates per string: two thirds of its bytes leave a third as context."""
    return max(1, min(2 * length // 3, length - _GRAM + 1))


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _pieces(chunk: Chunk, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, bytes before): one text longer than a piece goes through in overlapping parts."""
    if len(chunk.offsets) > 2 or len(chunk.data) <= 2 * PIECE_BYTES:
        yield chunk.data, chunk.offsets, 0
        return
    for at in range(0, len(chunk.data) - length + 1, PIECE_BYTES):
        part = chunk.data[at : at + PIECE_BYTES + length - 1]
        yield part, np.array([0, len(part)]), at


def phrases(chunk: Chunk, length: int) -> Iterator[Phrases]:
    """All phrases of a chunk's texts. Texts shorter than ``length`` have none."""
    window = window_of(length)
    for data, offsets, before in _pieces(chunk, length):
        sizes = np.maximum(np.diff(offsets) - length + 1, 0)
        total = int(sizes.sum())
        if total == 0:
            continue
        row = np.repeat(np.arange(len(sizes)), sizes)
        start = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + offsets[row]
        padded = np.concatenate([data, np.zeros(_GRAM + window, dtype=np.uint8)])
        grams = np.ndarray((len(data) + window,), dtype="<u8", buffer=padded, strides=(1,))
        places = np.arange(len(grams), dtype=np.uint64)
        ranked = (mix(grams.copy()) & np.uint64(0xFFFFFFFF00000000)) | places  # ties: the leftmost
        trigger = (_sliding_minimum(ranked, window)[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        begins = np.ones(total, dtype=bool)
        begins[1:] = (trigger[1:] != trigger[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(begins)
        end = np.append(at[1:], total) - 1
        first, last, trigger, row = start[at], start[end], trigger[at], row[at]
        prefix = prefix_hash(data)
        context = span_hash(prefix, trigger, trigger + (length - window + 1))
        whole = mix(span_hash(prefix, first, last + length) + (trigger - first).astype(np.uint64))
        base = offsets[row] - before
        yield Phrases(row, first - base, last - base, trigger - base, context, whole)


def _order(groups: np.ndarray, texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of (group, text), and the bytes each shares with the one before it (-1: other group)."""
    rows = len(texts)
    matrix = np.zeros((rows, 8 + width), dtype=np.uint8)
    matrix[:, :8] = groups.astype(">u8").view(np.uint8).reshape(rows, 8)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=rows)
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    matrix[np.repeat(np.arange(rows), sizes), 8 + place] = np.frombuffer(b"".join(texts), dtype=np.uint8)
    order = np.argsort(matrix.view(f"S{8 + width}").ravel(), kind="stable")
    matrix = matrix[order]
    same = matrix[1:] == matrix[:-1]
    shared = np.where(same.all(axis=1), 8 + width, same.argmin(axis=1)) - 8
    return order, np.concatenate([[-1], np.maximum(shared, -1)])


def repeated_starts(
    groups: np.ndarray, before: list[bytes], after: list[bytes], copies: np.ndarray, length: int
) -> np.ndarray:
    """Which strings of which phrases occur more than once among phrases of the same group.

    ``before`` and ``after`` are each phrase's bytes up to and from its trigger. The suffix order of
    the dictionary (ends of phrases, read backwards from the trigger) and that of the parse (what
    follows) are each cut, for every offset, where neighbours share too little; equal places in
    both orders are one run of the corpus order. ``copies``: occurrences a row stands for.
    Result: a (rows, window) matrix; column o is the string starting o bytes before the trigger.
    """
    window, rows = window_of(length), len(before)
    offset = np.arange(window)

    def runs(texts: list[bytes], width: int, needed: np.ndarray) -> np.ndarray:
        order, shared = _order(groups, texts, width)
        out = np.empty((rows, window), dtype=np.int64)
        out[order] = np.cumsum(shared[:, None] < needed[None, :], axis=0)
        return out

    dictionary = runs([b[::-1] for b in before], window, offset)
    parse = runs(after, length, length - offset)
    longest = np.fromiter(map(len, before), dtype=np.int64, count=rows)
    shortest = length - np.fromiter(map(len, after), dtype=np.int64, count=rows)
    real = (offset >= shortest[:, None]) & (offset <= longest[:, None])
    row, column = np.nonzero(real)
    key = (column * (rows + 1) + dictionary[row, column]) * (rows + 1) + parse[row, column]
    _, which = np.unique(key, return_inverse=True)
    found = np.bincount(which, weights=copies[row])[which] > 1
    out = np.zeros((rows, window), dtype=bool)
    out[row[found], column[found]] = True
    return out
