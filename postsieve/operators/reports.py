"""Counts and views for inspection."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.functions.text import bind, fold, word_pattern
from postsieve.operators.numbering import running_sum
from postsieve.operators.sizing import fits_broadcast


def count_rows(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def head_n(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows; each task keeps its own first ``n``, nothing is sorted whole."""
    return df.orderBy(*order).limit(n)


def filter_word(posts: DataFrame, keyword: str, text_col: str = "content") -> DataFrame:
    """Posts that hold one given keyword as a whole word."""
    word = fold(F.lit(keyword))
    found = bind(
        fold(F.col(text_col)),
        lambda text: F.contains(text, word) & F.rlike(text, word_pattern(word)),
    )
    return posts.filter(found)


def keyword_counts(keywords: DataFrame, candidates: DataFrame, matched: DataFrame) -> DataFrame:
    """Candidates received and posts matched per keyword, zeros included.

    Both sides are counted per keyword before they meet.
    """
    received = candidates.groupBy("keyword_id").agg(F.count("*").alias("received"))
    hits = matched.groupBy("keyword_id").agg(F.count("*").alias("matched"))
    zero: Column = F.lit(0).cast("long")
    return (
        keywords.select(F.col("id").alias("keyword_id"), "keyword")
        .join(received, "keyword_id", "left")
        .join(hits, "keyword_id", "left")
        .select(
            "keyword_id",
            "keyword",
            F.coalesce("received", zero).alias("received"),
            F.coalesce("matched", zero).alias("matched"),
        )
    )


def running_total(counts: DataFrame) -> DataFrame:
    """Matched posts summed over the keyword sequence."""
    return running_sum(counts, ["keyword_id"], "matched", "total")


def posts_by_category(
    posts: DataFrame, bridge: DataFrame, keywords: DataFrame, categories: DataFrame
) -> DataFrame:
    """Posts with the keywords and categories they were found for.

    The two small tables are joined first and, while they fit, broadcast to the
    bridge, where one keyword may have a third of all rows.  Posts are joined by id.
    """
    dimension = keywords.join(
        categories.select(F.col("id").alias("category_id"), "category"), "category_id"
    ).select(F.col("id").alias("keyword_id"), "category", "keyword")
    if fits_broadcast(dimension):
        dimension = F.broadcast(dimension)
    return posts.join(bridge.join(dimension, "keyword_id").hint("merge"), "external_id")
