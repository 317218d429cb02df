"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Vectors are dealt into blocks.  A task holds one block of candidates as one list per
dimension, sorted by that component, and reads the lists of a block of queries
from the better end down.  A query stops as soon as no vector further down can reach
its k-th score; the few best of all blocks are then merged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsieve.llm.common import keyed

BLOCK_ROWS = 8192
QUERY_ROWS = 8192
STEP = 128
# Vectors with a quantised component from here on are searched apart from the others.
LARGE = float(1 << 22)


def usable_vector(embedding: Column) -> Column:
    """The components as doubles; NULL for a vector that takes no part: a NULL or empty
    one, and one with a NULL or non-finite component."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(embedding.isNotNull() & (F.size(embedding) > 0) & ~bad, F.transform(embedding, lambda x: x.cast("double")))


def _integers(x: np.ndarray) -> np.ndarray:
    """floor(256 x) as Python integers of any size."""
    return np.array([[int(c) * 256 if abs(c) >= 2.0**60 else math.floor(256 * c) for c in row] for row in x.tolist()], dtype=object)


def _by_size(x: np.ndarray) -> list[np.ndarray]:
    """Places of vectors with small and with large components, as far as there are any."""
    large = np.abs(x).max(axis=1) * 256 >= LARGE
    return [rows for rows in (np.flatnonzero(~large), np.flatnonzero(large)) if len(rows)]


def threshold_search(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int, lists: np.ndarray,
                     step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best (ids, scores) of one block for one query, and how many scores were computed.

    ``lists``: per dimension the rows by rising component.  A list of a negative
    query component is read from its low end.  The search goes on while a row not
    yet seen could equal the k-th score, since a tie goes to the smaller id.
    """
    n = len(ids)
    used = np.flatnonzero(query)
    seen = np.zeros(n, dtype=bool)
    scores = np.zeros(n, dtype=vectors.dtype)
    if len(used) == 0:  # every score is 0
        seen[:] = True
    depth = 0
    up = used[query[used] < 0]
    down = used[query[used] > 0]
    while not seen.all():
        end = min(n, depth + step)
        rows = np.concatenate((lists[up, depth:end].ravel(), lists[down, n - end : n - depth].ravel()))
        fresh = np.zeros(n, dtype=bool)
        fresh[rows] = True
        fresh &= ~seen
        found = np.flatnonzero(fresh)
        scores[found] = vectors[found] @ query
        seen |= fresh
        depth = end
        # No unseen row has a component beyond the one each list stands at.
        bound = (vectors[lists[up, end - 1], up] * query[up]).sum() + (vectors[lists[down, n - end], down] * query[down]).sum()
        held = seen & (ids != own)
        if held.sum() >= k:
            kth = np.sort(scores[held])[-k] if scores.dtype == object else np.partition(scores[held], -k)[-k]
            if kth > bound:
                break
        step *= 2
    held = np.flatnonzero(seen & (ids != own))
    if scores.dtype == object:
        best = np.array(sorted(held.tolist(), key=lambda i: (-scores[i], ids[i]))[:k], dtype=int)
    else:
        best = held[np.lexsort((ids[held], -scores[held]))[:k]]
    return ids[best], scores[best], int(seen.sum())


def _search_blocks(k: int):
    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": [], "scored": []}
        if len(left) and len(right):
            all_vectors, all_ids = np.stack(left["x"].to_numpy()), left["vec_id"].to_numpy()
            all_queries, all_own = np.stack(right["x"].to_numpy()), right["query_id"].to_numpy()
            for rows in _by_size(all_vectors):
                for asked in _by_size(all_queries):
                    vectors, queries = np.floor(256 * all_vectors[rows]), np.floor(256 * all_queries[asked])
                    # Products of doubles are exact as long as sums stay below 2**53.
                    if not float(np.abs(vectors).max()) * float(np.abs(queries).max()) * vectors.shape[1] < 2.0**53:
                        vectors, queries = _integers(all_vectors[rows]), _integers(all_queries[asked])
                    lists = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
                    for query, own in zip(queries, all_own[asked], strict=True):
                        best, scores, scored = threshold_search(vectors, all_ids[rows], query, own, k, lists)
                        if len(scores) and not -(1 << 63) <= min(scores) <= max(scores) < 1 << 63:
                            raise OverflowError(f"a score of query {own} does not fit a long")
                        out["query_id"].append(np.full(len(best), own))
                        out["vec_id"].append(best)
                        out["score"].append(np.array([int(s) for s in scores], dtype=np.int64))
                        out["scored"].append(np.full(len(best), scored))
        return pd.DataFrame({c: np.concatenate(v) if v else np.empty(0, dtype=np.int64) for c, v in out.items()})

    return search


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """Per query the k best (query_id, rank, vec_id, score) of all vectors but its own.

    Both sides: (vec_id, embedding).  Scores are integer inner products of the
    quantised vectors; ties go to the smaller vec_id.  Vectors of another length
    than the query's are not compared.  Rows without vec_id take no part; a repeated
    (vec_id, vector) row counts once, and of different vectors under one id the best
    score counts.  Components of any size count; a score among the best that does not fit a long
    is an error.  Fewer than k candidates give fewer rows; empty tables give none.
    """

    def usable(rows: DataFrame) -> DataFrame:
        out = keyed(rows, "vec_id", "embedding").select(F.col("vec_id").cast("long"), usable_vector(F.col("embedding")).alias("x"))
        return out.where("vec_id IS NOT NULL AND x IS NOT NULL").withColumn("dim", F.size("x"))

    rows, asked = usable(vectors), usable(queries)
    blocks = max(1, -(-rows.count() // block_rows))
    parts = max(1, -(-asked.count() // query_rows))
    left = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = asked.withColumnRenamed("vec_id", "query_id").withColumn(
        "part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")
    )
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    keys = ["dim", "block", "part"]
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(_search_blocks(k), "query_id long, vec_id long, score long, scored long")
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""
