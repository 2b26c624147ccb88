"""SuperMinHash signatures: one random permutation rank per element and slot, with early stopping.

Every element draws, level by level, the next entry of its own random permutation of the slots
(Fisher-Yates) together with a fraction; the slot keeps the smallest level + fraction it sees. The
levels an element contributes to different slots are so correlated that no slot is hit twice, which
lowers the variance below that of plain MinHash. A row stops as soon as all of its slots hold a
value of a level already passed, which for long texts is after one or two levels.
"""

from __future__ import annotations

import numpy as np

from farebox.llm.bytes import mix

ELEMENTS = 1 << 13
_EMPTY = np.uint64((1 << 64) - 1)
_LEVEL = np.uint64(48)


def signatures(values: np.ndarray, bounds: np.ndarray, slots: int) -> np.ndarray:
    """A (rows, slots) matrix of uint64; rows without elements hold the largest value everywhere.

    Work goes through pieces of at most ``ELEMENTS`` elements; as the minimum over pieces is the
    minimum over all, a row of any size needs bounded memory.
    """
    rows = len(bounds) - 1
    out = np.full((rows, slots), _EMPTY, dtype=np.uint64)
    row = np.repeat(np.arange(rows), np.diff(bounds))
    lo = 0
    while lo < len(values):
        hi = min(lo + ELEMENTS, len(values))
        first, last = row[lo], row[hi - 1]
        piece = out[first : last + 1]
        np.minimum(piece, _piece(values[lo:hi], row[lo:hi] - first, last - first + 1, slots), out=piece)
        lo = hi
    return out


def _piece(values: np.ndarray, row: np.ndarray, rows: int, slots: int) -> np.ndarray:
    sig = np.full(rows * slots, _EMPTY, dtype=np.uint64)
    order = np.empty((len(values), slots), dtype=np.int16)
    order[:] = np.arange(slots, dtype=np.int16)
    state, element = values.copy(), np.arange(len(values))
    for level in range(slots):
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        pick = level + (((state & np.uint64(0xFFFF)) * np.uint64(slots - level)) >> np.uint64(16)).astype(np.int64)
        slot = order[element, pick]
        order[element, pick] = order[element, level]
        rank = (np.uint64(level) << _LEVEL) | (state >> np.uint64(16))
        np.minimum.at(sig, row * slots + slot, rank)
        # what a later level brings is larger than every rank of this one
        settled = sig.reshape(rows, slots).max(axis=1) < (np.uint64(level + 1) << _LEVEL)
        active = ~settled[row]
        if not active.any():
            break
        state, element, row = state[active], element[active], row[active]
    return sig.reshape(rows, slots)


def band_keys(sig: np.ndarray, bands: int, width: int) -> np.ndarray:
    """A (rows, bands) matrix of bucket keys, one for each ``width`` consecutive slots."""
    keys = np.zeros((len(sig), bands), dtype=np.uint64)
    for j in range(width):
        keys = mix(keys + sig[:, j : bands * width : width] * np.uint64(2 * j + 0x9E3779B97F4A7C15))
    return mix(keys + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sketch(sig: np.ndarray) -> np.ndarray:
    """One byte per slot: enough to estimate similarity."""
    return (mix(sig.copy()) >> np.uint64(56)).astype(np.uint8)


def estimate(equal: np.ndarray, slots: int) -> np.ndarray:
    """Similarity from the number of equal sketch bytes; two different slots agree once in 256."""
    return (equal / slots - 1 / 256) / (1 - 1 / 256)
