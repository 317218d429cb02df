"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from postsieve.llm import (
    alignment,
    bitplanes,
    bpe,
    fingerprint,
    html,
    jaccard,
    langid,
    licenses,
    linededup,
    packing,
    ppm,
    topk,
    whitening,
)
from postsieve.llm.common import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {"op3_line_dedup": linededup.SQL, "op5_threshold_topk": topk.SQL}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.detect_language(table(spark, sf_dir, "documents"))


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(table(spark, sf_dir, "documents"))


@query
def op4_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(table(spark, sf_dir, "documents"))


@query
def op5_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op6_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.token_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_report(table(spark, sf_dir, "documents"))


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op9_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_documents(table(spark, sf_dir, "documents"))


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicate_report(table(spark, sf_dir, "documents"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.alignment_report(table(spark, sf_dir, "documents"), a, b)


@query
def op13_bit_plane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bitplanes.store_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
