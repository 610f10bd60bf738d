"""Exact top-k by integer inner product with MaxScore over sharded postings.

A vector's components, scaled and floored, are the weights of terms (the dimensions); a shard holds
one posting list per term. For each query the terms are ordered by the most they can add in this
shard. The longest tail of terms that together stay below the k-th best score found so far is
non-essential: the postings of the other, essential terms are traversed for all vectors, and the
rest are probed term by term only for vectors whose score so far plus the bound of what is left is
still competitive. Bounds come from the extremes of each posting list, so negative weights are fine,
and a tie with the k-th score stays in. Shards' k best are merged by a window per query.

Vectors are dealt over shards and queries over blocks by hash; a task holds one block and one
shard, both of bounded size, whatever the tables hold.

Cases: vectors that are null or hold a null, NaN or infinite component take no part; vectors of
different length count as zero where they end, so an empty one scores 0; repeated rows of an id are
that many candidates, but a query never meets a row of its own id; a query row that is there twice is
answered twice; a row without an id is a candidate, the last among ties, and no query (the largest
64-bit number stands for no id); an empty table, or one without queries, gives no rows; fewer
than k candidates give as many rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockrisk.llm.frames import written

SHARD_VECTORS, BLOCK_QUERIES = 8192, 2048
PROBE_TERMS = 4
WARM_UP = 64
RESULT = "query_id long, asked long, vec_id long, score long"
NO_ID = np.iinfo(np.int64).max


def integer_weights(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(math.inf))
    return vector.isNotNull() & ~F.exists(vector, bad)


class Shard:
    """Posting lists of one shard, term by term, with the extremes of each."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray):
        self.ids, self.terms = ids, np.ascontiguousarray(weights.T)
        self.high = self.terms.max(1) if len(ids) else np.zeros(len(self.terms))
        self.low = self.terms.min(1) if len(ids) else np.zeros(len(self.terms))

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best, ties to smaller ids."""
        bounds = np.maximum(query * self.high, query * self.low)
        order = np.argsort(bounds, kind="stable")  # weakest first
        own = self.ids != query_id
        if own.sum() <= k:
            return self._best(np.where(own)[0], query @ self.terms[:, own] if own.any() else np.zeros(0), k)
        strongest = query[order[-1]] * self.terms[order[-1]]
        strongest = np.where(own, strongest, -np.inf)
        first = np.argpartition(-strongest, min(max(WARM_UP, k), len(own) - 1))[: max(WARM_UP, k)]
        first = first[own[first]]
        threshold = np.sort(query @ self.terms[:, first])[-k] if len(first) >= k else -np.inf
        tails = np.cumsum(bounds[order])
        weak = int(np.argmax(np.append(tails >= threshold, True))) if np.isfinite(threshold) else 0
        essential, others = order[weak:], order[:weak][::-1]
        score = query[essential] @ self.terms[essential]
        alive = np.where(own & (score + bounds[others].sum() >= threshold))[0]
        score = score[alive]
        for at in range(0, len(others), PROBE_TERMS):
            terms = others[at : at + PROBE_TERMS]
            score = score + query[terms] @ self.terms[np.ix_(terms, alive)]
            keep = score + bounds[others[at + PROBE_TERMS :]].sum() >= threshold
            alive, score = alive[keep], score[keep]
        return self._best(alive, score, k)

    def _best(self, rows: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows][order], score[order]


def _matrix(lists: pa.Array, terms: int) -> np.ndarray:
    """Weights as rows of ``terms`` 64-bit integers, zero where a vector has ended."""
    out = np.zeros((len(lists), terms), np.int64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out[np.arange(terms)[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` the k best other rows of ``vectors``."""

    def prepared(table: DataFrame) -> DataFrame:
        vector = F.col(f"`{vector_col}`")
        return table.where(usable(vector)).select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("vec_id"), integer_weights(vector, scale).alias("weights"))

    vectors, queries = prepared(vectors), prepared(queries).where(F.col("vec_id") != NO_ID)
    # stored, so that a query row's number is the same in every shard
    queries = written(queries.withColumn("asked", F.monotonically_increasing_id()), "queries")
    shards, blocks = (max(1, math.ceil(t.count() / size)) for t, size in ((vectors, SHARD_VECTORS), (queries, BLOCK_QUERIES)))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id", "weights"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.select("vec_id", F.lit(-1).cast("long").alias("asked"), "weights", dealt(shards).alias("shard"), every(blocks).alias("block"))
    right = queries.select("vec_id", "asked", "weights", dealt(blocks).alias("block"), every(shards).alias("shard"))

    def search(table: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        table = table.combine_chunks()
        weights = table.column("weights").combine_chunks() if isinstance(table.column("weights"), pa.ChunkedArray) else table.column("weights")
        terms = max(1, int(pc.max(pc.list_value_length(weights)).as_py()))
        matrix, ids = _matrix(weights, terms), table.column("vec_id").to_numpy()
        number = table.column("asked").to_numpy()
        asked = number >= 0
        peak = np.abs(matrix.astype(np.float64)).max(0)
        if float((peak * peak).sum()) < 2.0**52:
            matrix = matrix.astype(np.float64)
        shard, found = Shard(ids[~asked], matrix[~asked]), []
        for query_id, one, query in zip(ids[asked], number[asked], matrix[asked]):
            best, scores = shard.search(query_id, query, k)
            found.append((np.full(len(best), query_id), np.full(len(best), one), best, scores.astype(np.int64)))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "asked", "vec_id", "score"])

    parts = left.unionByName(right).groupBy("shard", "block").applyInArrow(search, RESULT)
    rank = F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id"))
    first = parts.withColumn("rank", rank).where(F.col("rank") <= k)
    return first.select("query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score")
