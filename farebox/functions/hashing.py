"""Reproducible randomness from row ids.

``rand``, ``sample`` and ``randomSplit`` depend on how rows fall into partitions, so a retried
task or another cluster size can move a row to the other side of a split. Hashing a stable row
id gives every row the same draw everywhere. ``xxhash64`` is the fast default; ``md5`` costs
about six times as much and is there when another SQL engine has to draw the same rows.

Every use hashes its ``purpose`` along with the seed. Without that, sampling a test split under
the same seed would look at the same draws twice: a split keeps the draws of 0.8 and above as
test rows, and a sample of those that are below 0.1 would be empty.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

METHODS = ("xxhash64", "md5")
MD5_DIGITS = 13  # 52 bits, the most that a double holds exactly
MD5_LANES = 8  # 16-bit draws in one 128-bit digest
XX_LANES = 4  # 16-bit draws in one 64-bit hash
LANE_RANGE = 1 << 16


def _ids(id_cols: str | Sequence[str]) -> list[Column]:
    names = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    return [F.col(name) for name in names]


def _check(method: str) -> None:
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")


def digest(seed: int | str, *parts: Column) -> Column:
    """md5 over the seed and the parts joined with '|'."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def uniform(
    id_cols: str | Sequence[str],
    seed: int = 42,
    method: str = "xxhash64",
    purpose: str = "uniform",
    extra: Sequence[Column] = (),
) -> Column:
    """A double in [0, 1): a function of seed, purpose and row id (and ``extra`` columns)."""
    _check(method)
    parts = [F.lit(purpose), *_ids(id_cols), *extra]
    if method == "md5":
        digits = F.substring(digest(seed, *parts), 1, MD5_DIGITS)
        return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def drawn(
    id_cols: str | Sequence[str],
    fraction: float,
    seed: int = 42,
    method: str = "xxhash64",
    purpose: str = "sample",
) -> Column:
    """True for the rows whose uniform draw is below ``fraction``; never null.

    The hash is compared with the scaled fraction directly, so the md5 form needs no hex parsing.
    """
    _check(method)
    if fraction >= 1.0:
        return F.lit(True)
    if fraction <= 0.0:
        return F.lit(False)
    parts = [F.lit(purpose), *_ids(id_cols)]
    if method == "md5":
        limit = format(math.ceil(fraction * (1 << 52)), f"0{MD5_DIGITS}x")
        return F.substring(digest(seed, *parts), 1, MD5_DIGITS) < F.lit(limit)
    limit = math.ceil(fraction * (1 << 53))
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11) < F.lit(limit)


def poisson_cuts() -> list[int]:
    """Cumulative Poisson(1) probabilities on the 16-bit scale.

    A 16-bit draw has as many copies as there are cuts at or below it.
    """
    cuts, mass, total, k = [], math.exp(-1.0), 0.0, 0
    while True:
        total += mass
        cut = round(total * LANE_RANGE)
        if cut >= LANE_RANGE:
            return cuts
        cuts.append(cut)
        k += 1
        mass /= k


def lanes_per_hash(method: str) -> int:
    _check(method)
    return MD5_LANES if method == "md5" else XX_LANES


def hash_word(id_cols: str | Sequence[str], seed: int, block: Column, method: str) -> Column:
    """The hash from which ``poisson_weight`` reads its lanes."""
    _check(method)
    parts = [F.lit("bootstrap"), block, *_ids(id_cols)]
    return digest(seed, *parts) if method == "md5" else F.xxhash64(F.lit(seed), *parts)


def poisson_weight(word: Column, lane: int, method: str) -> Column:
    """A Poisson(1) count from one 16-bit lane of a hash word."""
    if method == "md5":
        draw = F.substring(word, 4 * lane + 1, 4)
        cuts = [F.lit(format(cut, "04x")) for cut in poisson_cuts()]
    else:
        draw = F.shiftrightunsigned(word, 16 * lane).bitwiseAND(F.lit(LANE_RANGE - 1))
        cuts = [F.lit(cut) for cut in poisson_cuts()]
    # nearly all draws are settled by the first two or three comparisons
    count = F.when(draw < cuts[0], 0)
    for k, cut in enumerate(cuts[1:], start=1):
        count = count.when(draw < cut, k)
    return count.otherwise(len(cuts))


EXACT_MEAN = 40.0


def poisson_count(id_cols: str | Sequence[str], slot: Column, mean: float, seed: int = 42, method: str = "xxhash64") -> Column:
    """A Poisson(``mean``) count per row id and slot.

    Up to a mean of ``EXACT_MEAN`` a uniform draw is compared with the cumulative probabilities. Beyond, it is
    a normal draw with the next term of the Cornish-Fisher expansion, rounded: mean, variance and
    skewness are those of the Poisson distribution.
    """
    if mean <= EXACT_MEAN:
        draw, mass, total, k = uniform(id_cols, seed, method, "copies", (slot,)), math.exp(-mean), 0.0, 0
        cuts: list[float] = []
        while total < 1.0 - 1e-12 and k < 400:
            total += mass
            cuts.append(total)
            k += 1
            mass *= mean / k
        # the number of cuts at or below the draw, halving the list at each comparison
        def count(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            middle = (low + high) // 2
            return F.when(draw < F.lit(cuts[middle]), count(low, middle)).otherwise(count(middle + 1, high))

        return count(0, len(cuts))
    z = gaussian(id_cols, slot, seed)
    return F.greatest(F.lit(0), F.round(F.lit(mean) + F.lit(math.sqrt(mean)) * z + (z * z - 1) / 6)).cast("int")


def gaussian(id_cols: str | Sequence[str], slot: Column, seed: int = 42) -> Column:
    """A standard normal draw per row id and slot (Box-Muller on two hashed uniforms)."""
    u1 = uniform(id_cols, seed, purpose="radius", extra=(slot,))
    u2 = uniform(id_cols, seed, purpose="angle", extra=(slot,))
    radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u1))
    return radius * F.cos(F.lit(2.0 * math.pi) * u2)
