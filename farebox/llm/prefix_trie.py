"""Shared prefixes of conversations: a trie built by ROLLUP over blocks of turn-id columns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.sources.scratch import cut_lineage

WIDTH = 4  # turn-id columns of a block
BASE = 20  # conversations share the first turns of the one at the multiple of this below them
SHARED = 4  # by crc32(conv_id) modulo this many turns
CHUNK = 1024  # consecutive conv_ids that are joined to one text before they are digested
HOT_SHARE = 1024
WORD = r"[^\x20\x09-\x0D]+"


def _xor(parts: list[Column]) -> Column:
    return reduce(Column.bitwiseXOR, parts)


def _marks(depth: Column, turn: Column) -> tuple[Column, Column]:
    """Two 64-bit marks of a turn id at a depth; a prefix is known by the XOR of its turns' marks."""
    return F.xxhash64(depth, turn), F.xxhash64(turn, depth, F.lit(11))


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, id, words): turns counted from 1 by turn number, null first, ties by id.

    The id is 128 bits of the SHA-256 of role and text, so texts go no further than this. Nulls of
    both are empty; rows without a conv_id have no place in a conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.substring(digest, 1, 16).alias("id"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "id", "words")


def with_shared_heads(turns: DataFrame) -> DataFrame:
    """Every conversation with its first h turns taken from the one at the multiple of ``BASE``.

    h is crc32(conv_id) modulo ``SHARED``. The result has the columns of ``turns``, and for each
    conversation one more row, of pos 0 and a null id, that stays where no turn does. ``turns`` is
    read three times: pass a written table.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    found = turns.where("pos = 1").select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % BASE).alias("base"))
    heads = turns.where((F.col("conv_id") % BASE == 0) & (F.col("pos") < SHARED))
    heads = heads.select(F.col("conv_id").alias("base"), "pos", "id", "words")
    shared = found.where("h > 0").join(heads, "base").where("pos <= h").select("conv_id", "pos", "id", "words")
    none = found.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("id"),
                        F.lit(0).cast("long").alias("words"))
    return turns.where(F.col("pos") > h).unionByName(shared).unionByName(none)


def blocks(steps: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per conversation and block of ``width`` turns, a turnless one has one empty block.

    Columns: conv_id, block, prior (the node of the turns before: marks a, b and their words), t1 ..
    t<width> (turn ids with their words, null past the end), total (words of the conversation), ends
    (whether the last turn is in this block). Marks and words run along one window, so a long
    conversation is more rows and no longer row.
    """
    whole = Window.partitionBy("conv_id")
    order = whole.orderBy("pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    counted = steps.select(
        "conv_id", "pos", "words", (F.row_number().over(order) - 1).cast("long").alias("depth"), "id",
        (F.count("*").over(whole) - 1).alias("turns"), F.sum("words").over(whole).alias("total"),
    )
    a, b = (F.when(F.col("id").isNotNull(), m) for m in _marks(F.col("depth"), F.col("id")))
    marked = counted.withColumns({"a": a, "b": b, "step": F.when(F.col("id").isNotNull(), F.struct("id", "words"))})
    prior = F.struct(*[F.coalesce(agg(c).over(before), F.lit(0)).alias(c) for agg, c in ((F.bit_xor, "a"), (F.bit_xor, "b"), (F.sum, "words"))])
    ahead = [F.col("step").alias("t1"), *[F.lead("step", k).over(order).alias(f"t{k + 1}") for k in range(1, width)]]
    last = F.expr(f"greatest((turns - 1) div {width}, 0)")
    rows = marked.select("conv_id", "depth", "turns", F.expr(f"greatest(depth - 1, 0) div {width}").alias("block"), prior.alias("prior"), *ahead, "total")
    starts = rows.where((F.col("depth") % width == 1 % width) & (F.col("depth") > 0) | (F.col("turns") == 0))
    return starts.withColumn("ends", F.col("block") == last).drop("depth", "turns")


def _node(width: int, level: Column) -> Column:
    """The node that the first ``level`` turns of a block end in: depth and marks."""
    depth = F.col("block") * width
    marks = [F.col("prior.a")], [F.col("prior.b")]
    for k in range(1, width + 1):
        for side, mark in zip(marks, _marks(depth + k, F.col(f"t{k}.id"))):
            side.append(F.when(level >= k, mark).otherwise(F.lit(0)))
    return F.struct((depth + level).alias("depth"), _xor(marks[0]).alias("a"), _xor(marks[1]).alias("b"))


def _present(width: int) -> Column:
    return reduce(Column.__add__, [F.col(f"t{k}").isNotNull().cast("long") for k in range(1, width + 1)])


def rolled_up(rows: DataFrame, aggregates: str, width: int = WIDTH) -> DataFrame:
    """All prefixes at once: (node, parent, words, before, ...aggregates) per node of the trie.

    One ROLLUP over the turn-id columns of all blocks; ``grouping_id`` tells how many columns, and so
    how deep, a group is. Groups that only repeat the node before (a rolled-up block, but for the
    root) or stand for a conversation's end are left out. ``words``: those of the node's last turn;
    ``before``: those of the turns above it.
    """
    turns = ", ".join(f"t{k}" for k in range(1, width + 1))
    sql = f"SELECT block, prior, {turns}, grouping_id() AS rolled, {aggregates} FROM {{rows}} GROUP BY block, prior, ROLLUP ({turns})"
    groups = rows.sparkSession.sql(sql, rows=rows)
    level = width - F.bit_count("rolled").cast("long")
    real = groups.withColumn("level", level).where((F.col("level") == _present(width)) & ((F.col("level") > 0) | (F.col("block") == 0)))
    words = [F.coalesce(F.col(f"t{k}.words"), F.lit(0)) for k in range(1, width + 1)]
    own = reduce(Column.__add__, [F.when(F.col("level") == k, w).otherwise(0) for k, w in enumerate(words, 1)])
    above = reduce(Column.__add__, [F.when(F.col("level") > k, w).otherwise(0) for k, w in enumerate(words, 1)])
    parent = F.when((F.col("level") > 0), _node(width, F.col("level") - 1))
    return real.select(
        _node(width, F.col("level")).alias("node"), parent.alias("parent"), own.cast("long").alias("words"),
        (F.col("prior.words") + above).cast("long").alias("before"), *groups.columns[width + 3 :],
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, a, b, ids) sorted by node and chunk -> (d, a, b, ends_sha256); a node's digest is all that is held."""
    node, sha = None, hashlib.sha256()
    for batch in batches:
        done: list[tuple] = []
        for *at, ids in zip(*(batch.column(c).to_pylist() for c in ("d", "a", "b", "ids"))):
            if at == node:
                sha.update(b",")
            else:
                done += [(*node, sha.hexdigest())] if node else []
                node, sha = at, hashlib.sha256()
            sha.update(ids.encode())
        yield _digest_batch(done)
    yield _digest_batch([(*node, sha.hexdigest())] if node else [])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"d": pa.int64(), "a": pa.int64(), "b": pa.int64(), "ends_sha256": pa.string()}
    columns = zip(*rows) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))


def _ends(rows: DataFrame, width: int) -> DataFrame:
    """(node, ends_sha256) of the nodes in which conversations end.

    The ids of a node are first joined in chunks of ``CHUNK`` consecutive numbers, so that the task
    that digests a large node reads a thousandth of its ids as rows, in order, and keeps none.
    """
    ended = rows.where("ends").select("conv_id", _node(width, _present(width)).alias("node"))
    chunks = ended.groupBy("node", F.floor(F.col("conv_id") / CHUNK).alias("chunk")).agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))).alias("ids")
    )
    flat = chunks.select(F.col("node.depth").alias("d"), "node.a", "node.b", "chunk", "ids")
    ordered = flat.repartition("d", "a", "b").sortWithinPartitions("d", "a", "b", "chunk").drop("chunk")
    found = ordered.mapInArrow(_digests, "d long, a long, b long, ends_sha256 string")
    return found.select(F.struct(F.col("d").alias("depth"), "a", "b").alias("node"), "ends_sha256")


def prefix_trie(conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the empty one (the root) included:
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    1. Turns are put in order (``turns_in_order``), conversations rebuilt (``with_shared_heads``) and cut
       into blocks of ``width`` turn-id columns, each keyed by the node that the block before it ends
       in (``blocks``). Conversations of any length take the same number of jobs.
    2. One ROLLUP gives every node with its smallest member. Each node belongs to that member: so the
       leaves and the words of distinct nodes below a node are sums over its members.
    3. A second ROLLUP of the same rows adds those sums up. Both combine map-side: a first turn that a
       third of all conversations share is one row per task.
    4. Children look their parent up; the fewer than 1,024 parents with more than a 1,024th of all
       nodes below them are broadcast, the others joined by shuffle.

    Node keys are 128-bit hashes of (depth, turn id) combined, turn ids 128 bits of SHA-256. Turns
    with a null or repeated number are ordered by that, nulls first, then by id. A null role or text
    is empty, which also equals an empty one. Rows with a null conv_id are left out. Rows that are repeated
    are turns of their own. An empty table has no node and gives no row. Other columns are ignored.
    """
    turns = cut_lineage(turns_in_order(conversations.select("conv_id", "turn", "role", "text")))
    rows = cut_lineage(blocks(with_shared_heads(turns), width))
    nodes = cut_lineage(rolled_up(rows, "min(conv_id) AS conv_id", width))
    fanout = cut_lineage(
        nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    )
    known = nodes.select("node", "parent", "conv_id", "words").join(fanout, "node", "left")
    own = cut_lineage(known.groupBy("conv_id").agg(
        F.sum("words").alias("own"), F.count_if(F.col("n_children").isNull()).alias("leaves")
    ))
    weighted = rows.join(own, "conv_id", "left").fillna(0, ["own", "leaves"])
    sums = rolled_up(
        weighted,
        "min(struct(conv_id, own, total)) AS first, count(*) AS n_convs, sum(leaves) AS n_leaves, sum(own) AS owned, sum(total) AS read",
        width,
    )
    # words below a node read by all members, less those of its distinct nodes
    distinct = F.col("owned") - F.col("first.own") + F.col("first.total") - F.col("before")
    saved = F.col("read") - F.col("n_convs") * F.col("before") - distinct

    large = nodes.count() // HOT_SHARE
    parents = known.where("n_children IS NOT NULL").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    parents = cut_lineage(parents)
    often = F.broadcast(parents.where(F.col("n_children") > max(1, large)).drop("n_children"))
    rare = parents.where(F.col("n_children") <= max(1, large)).drop("n_children")
    below = nodes.select("node", "parent").where("parent IS NOT NULL")
    up = below.join(often, "parent").unionByName(below.join(often, "parent", "left_anti").join(rare, "parent"))
    nothing = hashlib.sha256().hexdigest()
    joined = (
        sums.select("node", F.col("first.conv_id").alias("conv_id"), "n_convs", "n_leaves", saved.alias("saved_tokens"))
        .join(up.select("node", "parent_conv_id"), "node", "left")
        .join(fanout, "node", "left")
        .join(_ends(rows, width), "node", "left")
    )
    return joined.select(
        "conv_id", F.col("node.depth").alias("depth"), "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


_CRC = (
    "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)), "
    "lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
    "lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)))"
)

SQL = f"""
WITH t AS (
  SELECT conv_id, turn, sha256(length(role) || ':' || role || text) AS id, len(regexp_extract_all(text, '{WORD}')) AS words
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), n AS (
  SELECT conv_id, id, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS pos FROM t
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor({_CRC.format(text="conv_id::VARCHAR")}, 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, pos, id, words FROM c JOIN n ON n.conv_id = c.conv_id AND pos > h
  UNION ALL SELECT c.conv_id, pos, id, words FROM c JOIN n ON n.conv_id = base AND pos <= h
), l AS (
  SELECT c.conv_id, list(id ORDER BY pos) FILTER (id IS NOT NULL) AS ids, list(words ORDER BY pos) FILTER (id IS NOT NULL) AS ws
  FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id
), p AS (
  SELECT conv_id, d, ids[d] AS id, coalesce(ws[d], 0) AS w, sha256(coalesce(array_to_string(ids[1:d], ','), '')) AS node,
    sha256(coalesce(array_to_string(ids[1:d - 1], ','), '')) AS parent, d = n AS ends
  FROM (SELECT *, unnest(range(0, n + 1)) AS d FROM (SELECT *, coalesce(len(ids), 0) AS n FROM l))
), v AS (
  SELECT d, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY d, node
), k AS (SELECT d - 1 AS d, parent AS node, count(*) AS n FROM v WHERE d > 0 GROUP BY ALL),
f AS (SELECT v.*, coalesce(n, 0) AS n_children FROM v LEFT JOIN k USING (d, node)),
s AS (
  SELECT p.d, p.node, sum((f.n_convs - 1) * f.w) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM f JOIN p ON p.conv_id = f.conv_id AND p.d <= f.d GROUP BY p.d, p.node
)
SELECT f.conv_id, f.d AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children::BIGINT AS n_children, leaves::BIGINT AS n_leaves,
  saved::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN s USING (d, node) LEFT JOIN v u ON f.d > 0 AND u.d = f.d - 1 AND u.node = f.parent
"""
