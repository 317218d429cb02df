"""Documents to training batches: language, shared lines, near copies, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``docs``.  ``run`` writes every result to the shared work folder and
reads it as the next stage's input, so that a lost executor costs at most one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from postsieve.llm import jaccard, langid, linededup, packing
from postsieve.llm.common import prepare, stored
from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents in no language."""
    prepare(spark)
    return langid.keep_languages(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that other documents keep; n_chars follows the text."""
    prepare(spark)
    return linededup.dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, and one of all that line dedup left without words."""
    prepare(spark)
    return jaccard.keep_one_per_class(docs, join_wordless=True)


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, with its place in a batch."""
    prepare(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("packing", length_packing),
]

# Language ID and the near-copy classes have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
