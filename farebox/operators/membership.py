"""Whether a value is in a table's column, with the way to find out chosen by the table's size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.operators.group_stats import BROADCAST_BYTES, fit_group_stats, lookup_join

LITERALS = 1000  # values that become part of the plan
WORDS = 1 << 16  # 64-bit words of the filter in front of a shuffle

_FOUND, _WORD, _MASK, _BITS = "_member", "_member_word", "_member_mask", "_member_bits"


def _spot(value: Column, words: int) -> tuple[Column, Column]:
    draw = F.xxhash64(value, F.lit(17))
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(draw, by).bitwiseAND(63).cast("int")) for by in (42, 52)]
    return F.pmod(draw, F.lit(words)), bits[0].bitwiseOR(bits[1])


def with_membership(
    df: DataFrame, col: str, table: DataFrame, table_col: str, out: str,
    literals: int = LITERALS, broadcast_bytes: int = BROADCAST_BYTES, salt_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Add a boolean: is ``col`` among the values of ``table_col``? Null where ``isin`` is null: for a null, and,
    if the table holds one, for every value it does not hold.

    Up to ``literals`` distinct values become a list in the plan. A set of at most ``broadcast_bytes`` is broadcast.
    A larger one is joined by shuffle, hot values and nulls spread (``lookup_join``), but only with the
    rows that pass a broadcast filter of two bits a value and ``WORDS`` words; the others surely are
    not in the table and stay where they are. ``df`` is read twice then: pass a written table.
    """
    values = table.select(F.col(table_col).cast(df.schema[col].dataType).alias(col))
    known = fit_group_stats(values, {col: [F.count(F.lit(1)).alias(_FOUND)]})[col]
    absent = F.lit(None) if known.stats.where(F.col(col).isNull()).limit(1).count() else F.lit(False)
    stats = known.stats.where(F.col(col).isNotNull())
    names = [F.col(f"`{c}`") for c in df.columns]
    if known.groups <= literals:
        listed = [r[0] for r in stats.select(col).collect()]
        hit = F.col(col).isin(listed) if listed else F.lit(False)
        return df.select(*names, F.when(F.col(col).isNull(), None).when(hit, True).otherwise(absent.cast("boolean")).alias(out))
    flag = F.when(F.col(col).isNull(), None).when(F.col(_FOUND).isNotNull(), True).otherwise(absent.cast("boolean")).alias(out)
    if known.size_bytes <= broadcast_bytes:
        return lookup_join(df, known, broadcast_bytes).select(*names, flag)
    words = max(64, min(WORDS, known.groups // 4))
    word, mask = _spot(F.col(col), words)
    bits = stats.select(word.alias(_WORD), mask.alias(_MASK)).groupBy(_WORD).agg(F.bit_or(_MASK).alias(_BITS))
    probed = df.withColumns({_WORD: word, _MASK: mask}).join(F.broadcast(bits), _WORD, "left")
    maybe = F.coalesce(F.col(_MASK).bitwiseAND(F.bitwise_not(F.col(_BITS))) == 0, F.lit(False)) & F.col(col).isNotNull()
    asked = lookup_join(probed.where(maybe).select(*names), known, broadcast_bytes, salt_cols=salt_cols).select(*names, flag)
    passed = F.when(F.col(col).isNull(), None).otherwise(absent.cast("boolean")).alias(out)
    return asked.unionByName(probed.where(~maybe).select(*names, passed))
