"""Exact top-k inner products by MaxScore over sharded, impact-ordered postings."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.code_compression import integers
from farebox.sources.scratch import cut_lineage

SHARD = 4096  # vectors per shard, on average
QUERY_BLOCK = 1024
EXACT = 1 << 62  # larger sums of products are taken in Python integers
STEP = 8  # terms probed between two looks at the bounds


class Postings:
    """One shard of integer vectors as postings.

    A term is a component with a sign; its postings are the rows whose component has that sign, and
    their impact is its absolute value. For a query's term, rows of the same sign gain and those of
    the other sign lose; its bound is the query's weight times the largest impact. Scores are exact: a
    query whose products could leave 64 bits is scored in Python integers.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, lead: int = 16) -> None:
        self.ids, self.matrix, self.wide = ids, matrix, None
        self.columns = np.ascontiguousarray(matrix.T)
        self.largest = np.maximum(self.columns.max(axis=1, initial=0), 0)
        self.smallest = np.minimum(self.columns.min(axis=1, initial=0), 0)
        ranked = np.argsort(self.columns, axis=1, kind="stable")
        self.lead = {-1: ranked[:, :lead], 1: ranked[:, ::-1][:, :lead]}  # the heads of the postings

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows, ties to the smaller id; rows of id ``own`` are passed over."""
        if self.matrix.dtype != object:
            most = sum(abs(q) * max(up, -down) for q, up, down in zip(query.tolist(), self.largest.tolist(), self.smallest.tolist()))
            if query.dtype == object or most >= EXACT:
                self.wide = self.wide or Postings(self.ids, self.matrix.astype(object))
                return self.wide.top(query.astype(object), own, k)
        bound = np.where(query > 0, query * self.largest, query * self.smallest)
        terms = np.argsort(bound, kind="stable")
        allowed = self.ids != own
        least = self._kth_of_leaders(query, terms, allowed, k)
        # non-essential: small terms that even together stay below the k-th score known so far
        essential = terms[np.searchsorted(np.cumsum(bound[terms]), least, side="left") :]
        found = np.full(len(self.ids), least <= 0)  # a row in no posting scores 0 or less
        for d in essential[::-1]:
            if found.all():
                break
            found |= (self.columns[d] > 0 if query[d] > 0 else self.columns[d] < 0).astype(bool)
        rows = np.flatnonzero(found & allowed)
        score, left = np.zeros(len(rows), dtype=self.matrix.dtype), int(bound.sum())
        for at in range(0, len(terms), STEP):  # from the largest term on, while a row can still compete
            part = terms[::-1][at : at + STEP]
            score += query[part] @ self.columns[part][:, rows]
            left -= int(bound[part].sum())
            able = (score + left >= least).astype(bool)
            rows, score = rows[able], score[able]
        if score.dtype == object:
            order = np.array(sorted(range(len(rows)), key=lambda i: (-score[i], self.ids[rows[i]]))[:k], dtype=np.int64)
        else:
            order = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows[order]], score[order]

    def _kth_of_leaders(self, query: np.ndarray, terms: np.ndarray, allowed: np.ndarray, k: int) -> int:
        """The k-th best score among the heads of the postings of the largest terms: a lower bound."""
        heads = [self.lead[1 if query[d] > 0 else -1][d] for d in terms[-24:]]
        rows = np.unique(np.concatenate(heads)) if heads else np.zeros(0, dtype=np.int64)
        rows = rows[allowed[rows]]
        if len(rows) < k:
            return -sum(abs(q) * max(up, -down) for q, up, down in zip(query.tolist(), self.largest.tolist(), self.smallest.tolist())) - 1
        return int(np.sort(self.matrix[rows] @ query)[-k])


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    return integers(pa.array(vectors, pa.list_(pa.float64())), width, 1)


def _cell(k: int):
    """Shard rows and query rows of one cell -> each query's best rows of the shard."""

    def run(shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if shard.empty or queries.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "query_key", "vec_id", "score")})
        width = max(shard.vector.map(len).max(), queries.vector.map(len).max())
        postings = Postings(shard.vec_id.to_numpy(), _matrix(shard.vector, width))
        asked, parts = _matrix(queries.vector, width), []
        for query_id, key, vector in zip(queries.vec_id, queries.query_key, asked):
            ids, scores = postings.top(vector, query_id, k)
            parts.append(pd.DataFrame({"query_id": query_id, "query_key": key, "vec_id": ids, "score": scores}))
        return pd.concat(parts)

    return run


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, vector) with floor(scale * x) of each component, as whole doubles. Null vectors and ids, and
    vectors with null or non-finite components have no row."""

    def whole(x: Column) -> Column:
        value = F.lit(float(scale)) * x.cast("double")
        near = F.abs(value) < 2.0**52  # beyond, a double is whole
        return F.when(near, F.floor(F.when(near, value)).cast("double")).otherwise(value) + F.lit(0.0)

    finite = F.forall(F.col(vector_col), lambda x: F.coalesce(F.abs(x.cast("double") * scale) < float("inf"), F.lit(False)))
    usable = vectors.where(F.col(id_col).isNotNull()).where(F.coalesce(finite, F.lit(False)))
    return usable.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(F.col(vector_col), whole).alias("vector"))


def top_k(
    vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The k largest integer inner products of each query: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but those of the
    query's own id; ties go to the smaller id. Vectors are dealt to shards by id and the queries
    to blocks; each cell of shard and block is a task's work (``Postings.top``), and the k best of
    each shard are merged. A shard and a block of queries are all that a task holds, and the query
    set is neither collected nor broadcast.

    Components become floor(scale * x). Rows with a null id or vector, or with a null or non-finite
    component (or one that scaling makes so), take no part. Components of any other size are exact; a
    score among the k best that a 64-bit integer does not hold is refused by an exception. Shorter vectors count as
    padded with zeros. Candidates that
    repeat an id are rows of their own; a query row that is repeated in full is asked once.
    """
    rows = cut_lineage(scaled(vectors, id_col, vector_col, scale))
    queries = rows.where(F.col("vec_id") % every == 0).distinct()
    queries = cut_lineage(queries.withColumn("query_key", F.xxhash64("vector")))
    shards = max(1, -(-rows.count() // SHARD))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    shard, block = F.pmod(F.xxhash64("vec_id"), F.lit(shards)), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))
    all_shards, all_blocks = (F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))) for n in (shards, blocks))
    left = rows.select("vec_id", "vector", shard.alias("shard"), all_blocks.alias("block"))
    right = queries.select("vec_id", "vector", "query_key", block.alias("block"), all_shards.alias("shard"))
    cells = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
    found = cells.applyInPandas(_cell(k), "query_id long, query_key long, vec_id long, score long")
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
