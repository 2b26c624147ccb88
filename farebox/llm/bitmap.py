"""Parting rows by a set of ids without shuffling those that are surely not in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_WORDS = 1 << 18  # rows of two numbers; a larger set only leaves more rows to the exact join


def _bits(key: Column, words: int) -> tuple[Column, Column]:
    """(word, mask of two bits in it) of a key."""
    draw = F.xxhash64(key, F.lit(3))
    places = [F.shiftrightunsigned(draw, shift).bitwiseAND(63).cast("int") for shift in (40, 50)]
    one = F.lit(1).cast("long")
    masks = [F.call_function("shiftleft", one, place) for place in places]
    return F.pmod(draw, F.lit(words)), masks[0].bitwiseOR(masks[1])


def part_by_ids(rows: DataFrame, key: str, ids: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` may be one of ``ids``, rows whose key surely is not), with the columns of ``rows``.

    ``ids`` becomes a Bloom filter in words of 64 bits, two bits an id and at most ``MAX_WORDS`` words,
    which is broadcast. About one row in sixty is on the first side for nothing while the words
    last. Both sides together are the input, so an exact join of the first side loses no row. ``ids`` is
    read twice: pass a written table.
    """
    words = max(64, min(MAX_WORDS, ids.count() // 4))
    word, mask = _bits(F.col(col), words)
    filter_ = ids.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))
    word, mask = _bits(F.col(key), words)
    # names of their own for all columns, whatever those of the rows are
    held = rows.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rows.columns)], word.alias("word"), mask.alias("mask"))
    probed = held.join(F.broadcast(filter_), "word", "left")
    maybe = F.coalesce(F.col("mask").bitwiseAND(F.bitwise_not(F.col("bits"))) == 0, F.lit(False))
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(rows.columns)]
    return probed.where(maybe).select(back), probed.where(~maybe).select(back)
