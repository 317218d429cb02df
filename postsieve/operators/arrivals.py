"""What arrives, in which order, and what was seen before."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsieve.functions.text import fold, word_pattern
from postsieve.operators.sizing import fits_broadcast

ARRIVAL = ["kw_seq", "page", "pos"]

_SALTS = 32


def anti_seen(candidates: DataFrame, seen: DataFrame, key: str = "external_id") -> DataFrame:
    """Candidates whose id is not in the seen set."""
    return candidates.join(seen.select(key), key, "left_anti")


def seen_among(batch: DataFrame, seen: DataFrame, key: str = "external_id") -> DataFrame:
    """The part of a huge seen set that concerns a small batch.

    If the ids of the batch may be broadcast, the seen set is only scanned and cut
    down to them; otherwise all of it has to be compared.
    """
    ids = batch.select(key).distinct()
    if not fits_broadcast(ids):
        return seen.select(key)
    return seen.select(key).join(F.broadcast(ids), key, "left_semi").distinct()


def anti_seen_batch(batch: DataFrame, seen: DataFrame, key: str = "external_id") -> DataFrame:
    """``anti_seen`` for a small batch: the seen set is not shuffled.

    A small seen set is broadcast as it is, and the batch is read once.
    """
    ids = seen.select(key)
    if fits_broadcast(ids):
        return batch.join(F.broadcast(ids), key, "left_anti")
    return anti_seen(batch, seen_among(batch, seen, key), key)


def first_arrival(
    candidates: DataFrame, key: str = "external_id", order: list[str] | None = None
) -> DataFrame:
    """The first row of each id in arrival order.

    ``row_number() = 1`` is cut down per task before the shuffle, so an id that
    arrives millions of times sends one row per task.
    """
    window = Window.partitionBy(key).orderBy(*(order or ARRIVAL))
    return candidates.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def cap_per_keyword(
    candidates: DataFrame,
    n: int = 1000,
    key: str = "keyword_id",
    order: list[str] | None = None,
) -> DataFrame:
    """At most the first ``n`` candidates of each keyword (pages x page size).

    Two rounds: first within (keyword, salt), then within the keyword, so that
    the task of a very common keyword sees ``salts x n`` rows and not all.
    """
    order = order or ["page", "pos", "external_id"]
    salted = candidates.withColumn(
        "_salt", F.pmod(F.xxhash64(*order), F.lit(_SALTS)).cast("int")
    )
    for partition in ([key, "_salt"], [key]):
        window = Window.partitionBy(*partition).orderBy(*order)
        salted = salted.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n).drop("_rn")
    return salted.drop("_salt")


def union_feeds(feeds: list[DataFrame], key: str = "external_id", order: list[str] | None = None) -> DataFrame:
    """Several feeds read one after the other, each id kept where it came first."""
    tagged = [feed.withColumn("feed_seq", F.lit(i)) for i, feed in enumerate(feeds)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return first_arrival(rows, key, ["feed_seq", *(order or ["pos"])])


def seen_union(*parts: DataFrame, key: str = "external_id") -> DataFrame:
    return reduce(lambda a, b: a.union(b), [p.select(key) for p in parts]).distinct()


def tested_first_seen(
    candidates: DataFrame,
    keywords: DataFrame,
    seen: DataFrame | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Each new post once, with ``is_match``: whether it holds the keyword that
    delivered it first.  A miss of that keyword is final, and has no text.

    Seen ids go first if they may be broadcast, since in the long run they are most of what
    arrives; else after the shuffle by id.  The test runs before that shuffle, where
    candidates of one keyword still sit together and its pattern is compiled once.
    """
    dimension = keywords.select(
        F.col("id").alias("keyword_id"), "language", fold(F.col("keyword")).alias("_keyword")
    ).withColumn("_pattern", word_pattern(F.col("_keyword")))
    if fits_broadcast(dimension):
        dimension = F.broadcast(dimension)
    early = seen is not None and fits_broadcast(seen.select("external_id"))
    if early:
        candidates = candidates.join(F.broadcast(seen.select("external_id")), "external_id", "left_anti")
    text = fold(F.col("text"))
    tested = (
        candidates.drop("language")
        .join(dimension, "keyword_id")
        .withColumn("is_match", F.contains(text, F.col("_keyword")) & F.rlike(text, F.col("_pattern")))
        .withColumn("text", F.when(F.col("is_match"), F.col("text")))
        .drop("_keyword", "_pattern")
    )
    first = first_arrival(tested, order=order)
    return first if seen is None or early else anti_seen(first, seen)


def match_first_seen(
    candidates: DataFrame,
    keywords: DataFrame,
    seen: DataFrame | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Each new post that holds the keyword that delivered it first."""
    return tested_first_seen(candidates, keywords, seen, order).filter("is_match").drop("is_match")
