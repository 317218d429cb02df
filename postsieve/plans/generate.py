"""Keyword generation: raw model answers -> new rows of the keyword table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.operators.keywords import (
    category_get_or_create,
    clean_keywords,
    keyword_build,
    number_keywords,
)
from postsieve.sinks.store import Store


def build_keywords(
    completions: DataFrame, wanted: DataFrame, categories: DataFrame, stored: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """All models in one batch job: ``(categories, new keywords)``.

    ``wanted(input_seq, category)`` are the categories asked for; an answer belongs
    to the category its ``query`` names.
    """
    all_categories = category_get_or_create(categories, wanted)
    accepted = keyword_build(clean_keywords(completions), all_categories, stored)
    return all_categories, number_keywords(accepted, stored)


def store_generated(
    completions: DataFrame, wanted: DataFrame, store: Store, run: int, epoch: int
) -> dict[str, int]:
    """Build from what earlier batches stored and store what is new; returns the rows written.

    Categories first, so that a keyword never lacks its category.  Doing a batch again
    starts from the same tables and replaces its own partitions: the ids are the same.
    """
    categories = store.before("categories", run, epoch).select("id", "category")
    stored = store.before("keywords", run, epoch).select("id", "category_id", "keyword", "language")
    everything, new = build_keywords(completions, wanted, categories, stored)
    created = everything.join(categories, "id", "left_anti")
    return {
        "categories": store.append("categories", created, run, epoch),
        "keywords": store.append("keywords", new, run, epoch),
    }


def keyword_order(keywords: DataFrame) -> DataFrame:
    """Keywords with ``kw_seq``, the order in which they are asked for: by id."""
    return keywords.withColumn("kw_seq", F.col("id"))
