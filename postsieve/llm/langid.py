"""Language identification.

Sparse multinomial logistic regression on TF-IDF character n-grams, fitted with
follow-the-regularised-leader and elastic-net penalties, then temperature scaled.

* Statistics: document frequencies of all hashed 1- to 3-grams come from every
  labelled text that may be learned from.
* Fit: on a sample of at most ``fit_rows`` labelled texts, as many per language as
  there are, chosen by hash.  Each is a vector of at most ``BUCKETS`` numbers.
* Prediction: every whole text, where it is read; no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from postsieve.llm.common import crc_mod, keyed

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
UNKNOWN = "und"


@cache
def _alphabetic() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets and counts of the n-grams of a whole text; None if it has no letter.

    Case is folded and everything that is no letter counts as one blank.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = _alphabetic()[codes]
    if not letters.any():
        return None
    # One blank stands for each run of other characters, and at either end.
    keep = letters | np.concatenate(([True], letters[:-1]))
    folded = np.where(letters, codes, np.uint32(32))[keep]
    folded = np.concatenate((np.array([32], dtype=np.uint32), folded, np.array([32], dtype=np.uint32)))
    parts = []
    gram = np.zeros(len(folded), dtype=np.uint32)
    for order in range(1, max(ORDERS) + 1):
        gram = gram[: len(folded) - order + 1] * np.uint32(0x01000193) + folded[order - 1 :]
        if order in ORDERS:
            mixed = (gram ^ np.uint32(order)) * np.uint32(0x9E3779B1)
            parts.append((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(16))
    hashed = np.concatenate(parts)
    if len(hashed) < BUCKETS // 8:
        return np.unique(hashed, return_counts=True)
    counts = np.bincount(hashed, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found.astype(np.uint32), counts[found]


def _vector(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[buckets]
    return values / max(np.sqrt((values * values).sum()), 1e-12)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages, mostly zero
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability; ``und`` and 0 without letters."""
        found = ngram_counts(text) if text and self.languages else None
        if found is None:
            return UNKNOWN, 0.0
        logits = (_vector(*found, self.idf) @ self.weights[found[0]] + self.bias) / self.temperature
        p = np.exp(logits - logits.max())
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts there are, and how many hold each bucket, over all of ``docs``.

    A task sends one row for each bucket it met; at most ``BUCKETS`` sums come back.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals, texts = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                found = ngram_counts(text)
                if found is not None:
                    totals[found[0]] += 1
                    texts += 1
        held = np.flatnonzero(totals)
        yield pd.DataFrame(
            {"bucket": np.append(held, -1).astype(np.int32), "n": np.append(totals[held], texts)}
        )

    rows = (
        docs.select("text").mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    out = np.zeros(BUCKETS, dtype=np.float64)
    grams = rows[rows["bucket"] >= 0]
    out[grams["bucket"].to_numpy()] = grams["n"]
    return int(rows.loc[rows["bucket"] < 0, "n"].sum()), out


def fit_sample(docs: DataFrame, fit_rows: int) -> pd.DataFrame:
    """At most ``fit_rows`` labelled texts as n-gram counts, evenly over languages, by hash.

    A first cut by hash leaves a little more than enough of each language, so the
    exact choice sorts a bounded number of rows whatever a language's share is.
    """
    counts = docs.groupBy("lang").count().collect()
    if not counts:
        return pd.DataFrame({"lang": [], "order": [], "buckets": [], "counts": []})
    share = max(1, fit_rows // len(counts))
    spread = 2.0**62
    limits = docs.sparkSession.createDataFrame(
        [(r["lang"], int(min(1.0, (1.2 * share + 50) / r["count"]) * spread)) for r in counts], "lang string, below long"
    )
    order = F.xxhash64(F.col("doc_id").cast("string"), "text").bitwiseAND(F.lit(2**62 - 1))
    near = docs.withColumn("order", order).join(F.broadcast(limits), "lang").where("order < below")
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))
    chosen = near.withColumn("turn", turn).where(F.col("turn") <= share).select("lang", "order", "text")

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(lang, at, ngram_counts(text)) for lang, at, text in batch.itertuples(index=False)]
            rows = [(lang, at, *found) for lang, at, found in rows if found is not None]
            yield pd.DataFrame(
                {
                    "lang": [r[0] for r in rows],
                    "order": [r[1] for r in rows],
                    "buckets": [r[2].astype(np.uint16).tobytes() for r in rows],
                    "counts": [np.minimum(r[3], 2**32 - 1).astype(np.uint32).tobytes() for r in rows],
                }
            )

    rows = chosen.mapInPandas(vectors, "lang string, order long, buckets binary, counts binary").toPandas()
    return rows.sort_values(["order", "lang"], ignore_index=True)


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    classes: int,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.1,
    epochs: int = 3,
) -> tuple[np.ndarray, np.ndarray]:
    """Follow the regularised leader, proximal, for a softmax over ``classes``.

    Each row is (buckets, values, class).  A weight stays exactly zero until its
    summed gradients outgrow ``l1``; ``l2`` shrinks the rest.
    """
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def solve(at: np.ndarray) -> np.ndarray:
        zs, ns = z[at], n[at]
        w = -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2)
        return np.where(np.abs(zs) <= l1, 0.0, w)

    for _ in range(epochs):
        for buckets, values, label in rows:
            at = np.append(buckets, BUCKETS)  # the last one is the bias
            x = np.append(values, 1.0)
            w = solve(at)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            gradient = x[:, None] * p
            squared = n[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(squared) - np.sqrt(n[at])) / alpha * w
            n[at] = squared
    weights = solve(np.arange(BUCKETS + 1))
    return weights[:-1], weights[-1]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss on rows that were not fitted, by golden section.

    One more row is taken to have been wrong, so that a fit without errors does not
    become sure of everything.
    """
    rows, classes = logits.shape
    doubt = 1 / (rows + 1)
    target = np.full((rows, classes), doubt / (classes - 1))
    target[np.arange(rows), labels] = 1 - doubt

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        top = scaled.max(axis=1, keepdims=True)
        normal = np.log(np.exp(scaled - top).sum(axis=1, keepdims=True)) + top
        return float((target * (normal - scaled)).sum(axis=1).mean())

    low, high, ratio = -4.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, fit_rows: int = 6000) -> LanguageModel:
    """A model from the labelled rows of ``docs`` (doc_id, text, lang).

    Rows without text or language teach nothing; without any, the model answers
    ``und``.  Every fifth row of the sample is kept for the calibration.
    """
    usable = keyed(docs, "doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    texts, frequency = document_frequencies(usable)
    sample = fit_sample(usable, fit_rows)
    languages = sorted(set(sample["lang"]))
    idf = np.log((1 + texts) / (1 + frequency)) + 1
    rows = []
    for lang, buckets, counts in zip(sample["lang"], sample["buckets"], sample["counts"], strict=True):
        at = np.frombuffer(buckets, dtype=np.uint16).astype(np.int64)
        rows.append((at, _vector(at, np.frombuffer(counts, dtype=np.uint32), idf), languages.index(lang)))
    if not rows:
        return LanguageModel([], idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    held = rows[4::5]
    weights, bias = ftrl([r for k, r in enumerate(rows) if k % 5 != 4], len(languages))
    t = 1.0
    if held and len(languages) > 1:
        logits = np.array([values @ weights[at] + bias for at, values, _ in held])
        t = temperature(logits, np.array([label for _, _, label in held]))
    return LanguageModel(languages, idf.astype(np.float32), weights.astype(np.float32), bias, t)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred and score; NULL and letterless texts give ``und``, 0.

    Only the text goes into a prediction.  The model is broadcast: its size is
    ``BUCKETS`` times the number of languages, whatever the corpus.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            found = [own.predict(text) for text in batch["text"]]
            yield batch.assign(lang_pred=[f[0] for f in found], score=[f[1] for f in found])

    base = docs.select(*columns)
    schema = StructType([*base.schema, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return base.mapInPandas(score, schema)


def detect_language(docs: DataFrame, fit_rows: int = 6000) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score.

    Learns from rows whose crc32(doc_id) modulo 4 is not 2 and whose lang is given.
    A row without id is not held out and teaches nothing.  Repeated rows count
    as often as they occur; other columns are ignored.
    """
    fold = crc_mod(F.col("doc_id"), 4)
    rows = keyed(docs, "doc_id", "text", "lang")
    model = fit(rows.where(fold != 2), fit_rows)
    narrow = rows.select("doc_id", "text", F.coalesce(fold == 2, F.lit(False)).alias("held_out"))
    return predict(narrow, model).select("doc_id", "held_out", "lang_pred", "score")


def keep_languages(docs: DataFrame, min_score: float = 0.4, fit_rows: int = 6000) -> DataFrame:
    """The rows of ``docs`` whose text is in a known language, with their own columns.

    Rejected are texts without letters and those whose best language stays below
    ``min_score``; four even guesses give 0.25.
    """
    names = list(docs.columns)
    model = fit(keyed(docs, "doc_id", "text", "lang").where(crc_mod(F.col("doc_id"), 4) != 2), fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def accept(texts: pd.Series) -> pd.Series:
        found = [shared.value.predict(text) for text in texts]
        return pd.Series([lang != UNKNOWN and score >= min_score for lang, score in found], dtype=bool)

    return docs.where(F.pandas_udf(accept, "boolean")(F.col("text"))).select(*names)
