import numpy as np

from postsieve.llm import langid
from tests.llm.conftest import frame, odd_documents

WORDS = {
    "en": "the and that with from this have which their would there been people water",
    "de": "der und nicht mit auch sich über werden können schließlich größe straße zwischen",
    "fr": "les des dans pour avec être cette après même où français élève garçon jusque",
}


def corpus(spark, copies=60):
    draw = np.random.default_rng(3)
    rows = []
    for lang, words in WORDS.items():
        for _ in range(copies):
            rows.append((len(rows), " ".join(draw.choice(words.split(), 20)), lang, "s", 0))
    return frame(spark, rows)


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    found = langid.detect_language(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = found[found["held_out"]]
    assert len(held) > 20
    assert (held["lang"] == held["lang_pred"]).mean() > 0.95
    assert found["score"].between(0, 1).all()


def test_held_out_labels_are_not_used(spark):
    docs = corpus(spark)
    fold = langid.crc_mod(docs["doc_id"], 4)
    changed = docs.withColumn("lang", langid.F.when(fold == 2, "xx").otherwise(docs["lang"]))
    a = langid.detect_language(docs).orderBy("doc_id").collect()
    b = langid.detect_language(changed).orderBy("doc_id").collect()
    assert a == b


def test_odd_documents(spark):
    rows = langid.detect_language(odd_documents(spark)).collect()
    assert len(rows) == 8
    by_id = {r["doc_id"]: r for r in rows}
    for doc_id in (2, 3, 5):
        assert (by_id[doc_id]["lang_pred"], by_id[doc_id]["score"]) == ("und", 0.0)
    assert by_id[None]["held_out"] is False


def test_empty_table(spark):
    assert langid.detect_language(odd_documents(spark).limit(0)).count() == 0


def test_l1_keeps_weights_sparse_and_temperature_is_positive():
    rows = [(np.array([k % 2]), np.array([1.0]), k % 2) for k in range(40)]
    weights, _ = langid.ftrl(rows, 2)
    assert np.count_nonzero(weights) == 4
    assert langid.temperature(np.array([[9.0, 1], [1, 9]]), np.array([0, 1])) > 0


def test_keep_languages_keeps_columns(spark):
    docs = odd_documents(spark)
    kept = langid.keep_languages(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {1, 4, 6}
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({2, 3, 5})
