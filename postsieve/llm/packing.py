"""Packing into length buckets of least padding, and token-budget batches inside them.

Bucket bounds come from dynamic programming over the histogram of all lengths.  The
histogram has a bounded number of bins, and only it reaches the driver; documents
are numbered inside shards of a bucket, so a bucket that holds a third of all
rows is many tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsieve.llm.common import stored, text_or_empty

BUCKETS = 12
TOKEN_BUDGET = 65_536
SHARD_ROWS = 8_192
SHARD_TOKENS = 4_000_000  # so that a shard of long documents fits a task, too


def word_count(text: Column) -> Column:
    """Tokens of the packing: runs of anything but ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^ \t-\r]+")).cast("long")


def length_bin(length: Column) -> Column:
    """The length itself below 1024, beyond rounded up to ten leading bits.

    So every power of two has 512 bins, and a bound exceeds its lengths by at
    most a 512th.
    """
    step = F.expr("shiftleft(1L, CAST(greatest(0, floor(log2(greatest(n_tokens, 1))) - 9) AS INT))")
    return (F.ceil(length / step) * step).cast("long")


def best_bounds(bins: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding in all.

    ``bins``: (upper length, documents, tokens), by length.  Padding of a bucket is
    its bound times its documents less their tokens; ties take fewer buckets.
    """
    if not bins:
        return []
    tops = np.array([b[0] for b in bins], dtype=np.float64)
    docs = np.concatenate(([0.0], np.cumsum([b[1] for b in bins])))
    n = len(bins)
    best = np.concatenate(([0.0], np.full(n, np.inf)))  # padded tokens of the first j bins
    choices: list[np.ndarray] = []
    results: list[float] = []
    for _ in range(min(buckets, n)):
        fresh, choice = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + tops[j - 1] * (docs[j] - docs[:j])
            choice[j] = int(cost.argmin())
            fresh[j] = cost[choice[j]]
        best = fresh
        choices.append(choice)
        results.append(float(best[n]))
    bounds, j = [], n
    for choice in reversed(choices[: int(np.argmin(results)) + 1]):
        bounds.append(int(tops[j - 1]))
        j = int(choice[j])
    return bounds[::-1]


def histogram(lengths: DataFrame) -> list[tuple[int, int, int]]:
    """(upper length, documents, tokens) of every bin of all rows; bounded by the bins."""
    rows = lengths.groupBy(length_bin(F.col("n_tokens")).alias("top")).agg(
        F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens")
    )
    return sorted((int(r["top"]), int(r["docs"]), int(r["tokens"])) for r in rows.collect())


def _assign(rows: DataFrame, names: list[str], buckets: int, budget: int, shard_rows: int) -> DataFrame:
    """``names`` of ``rows`` with their places; needs n_tokens and the order ``_order``."""
    bins = histogram(rows)
    bounds = best_bounds(bins, buckets) or [0]
    sizes, tokens = [0] * len(bounds), [0] * len(bounds)
    for top, count, held in bins:
        bucket = next(k for k, bound in enumerate(bounds) if top <= bound)
        sizes[bucket] += count
        tokens[bucket] += held
    shards = [max(1, -(-n // shard_rows), -(-held // SHARD_TOKENS)) for n, held in zip(sizes, tokens, strict=True)]
    per_batch = [max(1, budget // max(1, bound)) for bound in bounds]

    def of_bucket(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("bucket") + 1)

    bucket = F.lit(0)
    for k, bound in enumerate(bounds[:-1]):
        bucket = F.when(F.col("n_tokens") > bound, k + 1).otherwise(bucket)
    placed = rows.withColumn("bucket", bucket.cast("int")).withColumn(
        "shard", F.pmod(F.col("_order"), of_bucket(shards)).cast("int")
    )
    turn = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("_order", "doc_id")) - 1
    numbered = placed.withColumn("_turn", turn)
    return numbered.select(
        *names,
        "n_tokens",
        "bucket",
        of_bucket(bounds).cast("long").alias("bound"),
        "shard",
        F.floor(F.col("_turn") / of_bucket(per_batch)).cast("long").alias("batch"),
        (F.col("_turn") % of_bucket(per_batch)).cast("long").alias("slot"),
    )


ADDED = ("n_tokens", "bucket", "bound", "shard", "batch", "slot")


def pack(
    docs: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """``docs`` with n_tokens, bucket, bound, shard, batch, slot.

    A batch is (bucket, shard, batch): documents of one bucket whose padded tokens,
    bound times documents, stay within ``budget``; a document longer than the budget
    is a batch by itself.  Each shard of a bucket ends with one batch that may not be
    full.  NULL and empty texts have no tokens and go to the first bucket.  Rows
    are ordered by a hash of id and text, so repeated rows get slots of their own.
    Columns of ``docs`` with one of the six names are replaced.
    """
    names = [c for c in docs.columns if c not in ADDED]
    rows = docs.select(
        *names,
        word_count(text_or_empty()).alias("n_tokens"),
        F.xxhash64("doc_id", text_or_empty()).alias("_order"),
    )
    return _assign(rows, names, buckets, budget, shard_rows)


def packing_report(
    docs: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """As ``pack``, but per document only doc_id and its place; texts are read once and stay behind."""
    narrow = docs.select(
        "doc_id",
        word_count(text_or_empty()).alias("n_tokens"),
        F.xxhash64("doc_id", text_or_empty()).alias("_order"),
    )
    return _assign(stored(narrow), ["doc_id"], buckets, budget, shard_rows)
