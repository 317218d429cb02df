import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from postsieve.llm import ppm
from tests.llm.conftest import frame, odd_documents

TEXTS = ["The cat sat.\nThe cat ran.", "a cat a cat a cat", "thé à la carte", None, "", "The dog sat on the cat"]


def rows():
    return [(n, TEXTS[n % len(TEXTS)]) for n in range(40)] + [(100, "wholly unseen wordś"), (None, "no id")]


def trained(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 != 0


def byte_model(texts):
    """PPM by its definition: escape from order 3 down, excluding what longer contexts hold."""
    counts = defaultdict(Counter)
    for text in texts:
        data = ppm.START + (text or "").encode() + bytes([ppm.END])
        for k in range(3, len(data)):
            for order in range(4):
                counts[data[k - order : k]][data[k]] += 1

    def score(text):
        data, total = ppm.START + (text or "").encode() + bytes([ppm.END]), 0.0
        for k in range(3, len(data)):
            excluded, p = set(), 1.0
            for order in (3, 2, 1, 0):
                left = {s: n for s, n in counts.get(data[k - order : k], {}).items() if s not in excluded}
                if not left:
                    continue
                size = sum(left.values()) + len(left)
                if data[k] in left:
                    p *= left[data[k]] / size
                    break
                p *= len(left) / size
                excluded |= set(left)
            else:
                p /= 256 - len(excluded)
            total += math.log10(p)
        return total

    return score


def test_against_the_definition(spark):
    docs = frame(spark, [(d, t, "en", "s", 0) for d, t in rows()])
    found = {r["doc_id"]: r for r in ppm.score_documents(docs).collect()}
    train = [t for d, t in rows() if trained(d)]
    counts = Counter()
    for text in train:
        counts.update(ppm.words((text or "").encode()))
    n, v = sum(counts.values()), len(counts)
    score = byte_model(train)
    assert len(found) == len(rows())
    for doc_id, text in rows():
        row = found[doc_id]
        own = ppm.words((text or "").encode())
        base = sum(k * math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w, k in own.items())
        assert row["base_score"] == pytest.approx(base)
        assert row["score"] == pytest.approx(score(text), rel=1e-4)
        assert (row["n_tokens"], row["train_tokens"]) == (sum(own.values()), n)
        assert row["n_known"] == sum(k for w, k in own.items() if counts[w])
        assert row["held_out"] == (doc_id is not None and not trained(doc_id))


def test_join_gives_what_the_table_gives(spark, monkeypatch):
    docs = frame(spark, [(d, t, "en", "s", 0) for d, t in rows()])
    columns = ("doc_id", "n_known", "n_tokens")
    few = ppm.score_documents(docs).orderBy("doc_id").toPandas()
    monkeypatch.setattr(ppm, "HEAVY_WORDS", 2)
    many = ppm.score_documents(docs).orderBy("doc_id").toPandas()
    assert few[list(columns)].equals(many[list(columns)])
    assert np.allclose(few["base_score"], many["base_score"]) and np.allclose(few["score"], many["score"])


def test_rows_are_distributions():
    keys, n = np.unique(np.concatenate([ppm.grams((t or "").encode()) for t in TEXTS]).astype(np.int64), return_counts=True)
    short, place = np.unique(keys & 0xFFFFFF, return_inverse=True)
    trie = ppm.Trie((keys, n), (short, np.bincount(place, weights=n)))
    assert np.allclose((10.0 ** trie.table.reshape(-1, 256)).sum(axis=1), 1, atol=1e-4)


def test_pruned_contexts_use_their_suffix(spark):
    docs = frame(spark, [(d, t, "en", "s", 0) for d, t in rows()])
    assert ppm.score_documents(docs, max_contexts=3).where("score < 0").count() == len(rows())


def test_contexts_beyond_the_table_are_joined(spark):
    texts = [*TEXTS, "naïve 中文 テスト text", "中文 中国 テレビ", "a cab a car a can"]
    data = [(n, texts[n % len(texts)]) for n in range(60)] + [(100, "wholly unseen wordś 中国"), (None, "no id a cap 文中")]
    docs = frame(spark, [(d, t, "en", "s", 0) for d, t in data])
    score = byte_model([t for d, t in data if trained(d)])
    whole = {r["doc_id"]: r for r in ppm.score_documents(docs).collect()}
    for bound in (1, 3, 40):
        found = {r["doc_id"]: r for r in ppm.score_documents(docs, max_contexts=bound).collect()}
        assert len(found) == len(data)
        for doc_id, text in data:
            row = found[doc_id]
            assert row["score"] == pytest.approx(score(text), rel=1e-4)
            assert (row["n_tokens"], row["n_known"]) == (whole[doc_id]["n_tokens"], whole[doc_id]["n_known"])
            assert row["base_score"] == pytest.approx(whole[doc_id]["base_score"])


def test_odd_documents(spark):
    docs = odd_documents(spark)
    assert ppm.score_documents(docs).count() == 8
    assert ppm.score_documents(docs.limit(0)).count() == 0
    held = docs.where("doc_id IS NULL")  # nothing to learn from
    row = ppm.score_documents(held).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0
    assert row["score"] == pytest.approx(18 * math.log10(1 / 256), rel=1e-5)
