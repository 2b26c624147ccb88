"""Exact quantiles of large numeric columns.

``percentile`` keeps every distinct value of a column in one aggregation buffer, which one task
cannot hold for a large table. Here a one-pass sketch brackets each wanted rank between two values,
one aggregation counts the rows below and inside each bracket, and the values inside are listed:
three passes for tables of up to ``LIST_ROWS`` * ``ACCURACY`` / 8 rows. In a larger table the
inside of a bracket is sketched again, which divides it by thousands, so the passes depend on the
number of rows alone and not on how the values are spread. Every pass reads only the columns asked
for; what is shuffled is one sketch per column and task, or the listed values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

ACCURACY = 10_000  # a sketched rank is off by 1 / ACCURACY of the rows at most
LIST_ROWS = 20_000


@dataclass(frozen=True)
class _Range:
    """Values lo..hi of a column: rows in it, and rows of the column below it."""

    col: str
    lo: float
    hi: float
    rows: int
    below: int

    def holds(self, col: str, rank: int) -> bool:
        return self.col == col and self.below <= rank < self.below + self.rows

    def inside(self) -> Column:
        return F.col(self.col).between(self.lo, self.hi)


def _near(probability: float) -> list[float]:
    """Probabilities between whose sketched values the true one lies."""
    return [min(1.0, max(0.0, probability + side * 2 / ACCURACY)) for side in (-1, 1)]


def _extent(
    df: DataFrame, cols: Sequence[str], probabilities: Sequence[float] = (), also: Sequence[Column] = ()
) -> tuple[dict[_Range, list[float]], Row]:
    """Each column's range, with the sketched values around the given probabilities, in one pass; and the row
    of that pass, which holds the aggregates ``also``."""
    near = sorted({q for p in probabilities for q in _near(p)})
    found = df.agg(
        *[f(F.col(c)).alias(f"{name}_{i}") for i, c in enumerate(cols)
          for name, f in (("n", F.count), ("lo", F.min), ("hi", F.max))],
        *[F.percentile_approx(c, near, ACCURACY).alias(f"q_{i}") for i, c in enumerate(cols) if near],
        *also,
    ).first()
    if any(math.isinf(found[f"{end}_{i}"] or 0.0) for i in range(len(cols)) for end in ("lo", "hi")):
        raise ValueError("quantiles need finite values")
    ranges = {
        _Range(c, found[f"lo_{i}"], found[f"hi_{i}"], found[f"n_{i}"], 0): found[f"q_{i}"] if near else []
        for i, c in enumerate(cols)
        if found[f"n_{i}"]
    }
    return ranges, found


def _tagged(df: DataFrame, ranges: Sequence[_Range]) -> DataFrame:
    """One row (range, v) per value and range that holds it."""
    structs = [
        F.when(r.inside(), F.struct(F.lit(i).alias("range"), F.col(r.col).alias("v"))) for i, r in enumerate(ranges)
    ]
    return df.select(F.inline(F.array(*structs))).filter(F.col("range").isNotNull())


def _sketched(df: DataFrame, holding: Mapping[_Range, Sequence[int]]) -> dict[_Range, list[float]]:
    """For each range, values around its wanted ranks, from a sketch of what the range holds."""
    near = {r: sorted({q for k in ranks for q in _near((k - r.below + 0.5) / r.rows)}) for r, ranks in holding.items()}
    row = df.agg(
        *[F.percentile_approx(F.when(r.inside(), F.col(r.col)), qs, ACCURACY).alias(f"q{i}")
          for i, (r, qs) in enumerate(near.items())]
    ).first()
    return {r: row[f"q{i}"] for i, r in enumerate(near)}


def _cut(df: DataFrame, cuts: Mapping[_Range, Sequence[float]]) -> list[_Range]:
    """Cut each range at values inside it and count the parts, in one pass.

    Every cut value is a part of its own, as are the open gaps between, so a range with more than
    one value always becomes smaller ones and no rank is lost, wherever the cuts are.
    """
    parts: list[tuple[_Range, Column]] = []
    for r, values in cuts.items():
        v, at = F.col(r.col), sorted({r.lo, *values, r.hi})
        for low, high in zip(at, [*at[1:], None]):
            parts.append((r, v == low))
            if high is not None:
                parts.append((r, (v > low) & (v < high)))
    counted = df.agg(
        *[f(F.when(member, F.col(r.col))).alias(f"{name}{i}") for i, (r, member) in enumerate(parts)
          for name, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    ).first()
    out, below = [], {r: r.below for r in cuts}
    for i, (r, _) in enumerate(parts):
        if rows := counted[f"n{i}"]:
            out.append(_Range(r.col, counted[f"lo{i}"], counted[f"hi{i}"], rows, below[r]))
            below[r] += rows
    return out


def _list(df: DataFrame, ranges: Sequence[_Range]) -> list[list[float]]:
    """All values of ranges that hold at most LIST_ROWS rows each, sorted."""
    counts = (
        _tagged(df, ranges)
        .groupBy("range", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # at most len(ranges) * LIST_ROWS rows
    )
    out: list[list[float]] = [[] for _ in ranges]
    for row in sorted(counts, key=lambda r: (r["range"], r["v"])):
        out[row["range"]].extend([row["v"]] * row["n"])
    return out


def order_statistics(
    df: DataFrame, wanted: Mapping[str, Sequence[int]], ranges: Sequence[_Range] | None = None
) -> dict[tuple[str, int], float]:
    """The value at each 0-based rank of the sorted non-null column, by (column, rank)."""
    found: dict[tuple[str, int], float] = {}
    open_ranks = {(c, k) for c, ranks in wanted.items() for k in ranks}
    ranges = list(_extent(df, list(wanted))[0] if ranges is None else ranges)
    while open_ranks:
        holding: dict[_Range, list[tuple[str, int]]] = {}
        for c, k in open_ranks:
            home = next((r for r in ranges if r.holds(c, k)), None)
            if home is None:
                raise IndexError(f"rank {k} is outside column {c!r}")
            holding.setdefault(home, []).append((c, k))
        for r, ranks in holding.items():
            if r.lo == r.hi:
                found.update({ck: r.lo for ck in ranks})
        ready = [r for r in holding if r.lo < r.hi and r.rows <= LIST_ROWS]
        if ready:
            for r, values in zip(ready, _list(df, ready)):
                found.update({(c, k): values[k - r.below] for c, k in holding[r]})
        open_ranks -= found.keys()
        wide = [r for r in holding if r.lo < r.hi and r.rows > LIST_ROWS]
        if wide:
            ranges = _cut(df, _sketched(df, {r: [k for _, k in holding[r]] for r in wide}))
    return found


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between neighbouring values, nulls and NaN left out.

    Runs Spark jobs at once and returns plain numbers; columns are read as double.
    """
    return quantiles_and(df, cols, probabilities)[0]


def quantiles_and(
    df: DataFrame, cols: Sequence[str], probabilities: Sequence[float], also: Sequence[Column] = ()
) -> tuple[dict[str, list[float | None]], Row]:
    """``exact_quantiles``, and a row with other aggregates of ``df``, taken in the first of the same passes."""
    values = {c: f"_quantile_{i}" for i, c in enumerate(cols)}
    inner = df.withColumns({v: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c, v in values.items()})
    found, row = _quantiles(inner, list(values.values()), probabilities, also)
    return {c: found[v] for c, v in values.items()}, row


def _quantiles(
    narrow: DataFrame, cols: Sequence[str], probabilities: Sequence[float], also: Sequence[Column]
) -> tuple[dict[str, list[float | None]], Row]:
    sketched, row = _extent(narrow, cols, probabilities, also)
    extent = list(sketched)
    places: dict[str, list[tuple[int, int, float]]] = {}
    for r in extent:
        for p in probabilities:
            position = p * (r.rows - 1)
            lower = math.floor(position)
            places.setdefault(r.col, []).append((lower, min(lower + 1, r.rows - 1), position - lower))
    wanted = {c: sorted({k for lo, hi, _ in spots for k in (lo, hi)}) for c, spots in places.items()}
    large = {r: cuts for r, cuts in sketched.items() if r.rows > LIST_ROWS and r.lo < r.hi}
    ranges = [r for r in extent if r not in large] + (_cut(narrow, large) if large else [])
    values = order_statistics(narrow, wanted, ranges) if wanted else {}

    def interpolate(c: str, lo: int, hi: int, part: float) -> float:
        a, b = values[(c, lo)], values[(c, hi)]
        return a if part == 0.0 else a + (b - a) * part

    found = {
        c: [interpolate(c, *spot) for spot in places[c]] if c in places else [None] * len(probabilities)
        for c in cols
    }
    return found, row
