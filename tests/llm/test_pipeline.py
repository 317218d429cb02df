import os

import pytest

import __spark_entry__ as contract
import check
import corpus_pipeline
from tests.llm import test_jaccard, test_lines
from tests.llm.conftest import frame, odd_documents

SF_DIR = "/root/testdata/sf0.001"


def test_every_stage_on_odd_documents(spark):
    for start in (odd_documents(spark), odd_documents(spark).limit(0)):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.columns == start.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()


def brute(rows):
    """(doc_id, text) that are left of rows in a known language: lines, then near copies, one text without words."""
    holders = {}
    for doc_id, text in rows:
        for line in text.split("\n"):
            holders.setdefault(test_lines.key(line), set()).add(doc_id)
    kept = {}
    for doc_id, text in rows:
        lines = [(x, test_lines.key(x)) for x in text.split("\n")]
        kept[doc_id] = "\n".join(x for x, k in lines if len(k) < 40 or len(holders[k]) < 5 or max(holders[k]) == doc_id)
    firsts = {c for _, c, _ in test_jaccard.brute(list(kept.items()))}
    wordless = sorted(d for d, t in kept.items() if not t.split())
    return sorted((d, kept[d]) for d in firsts - set(wordless[1:]))


def copies():
    """Two groups of exact copies with long lines only, which line dedup empties but for one each."""
    texts = [
        "\n".join(f"The {name} of the town wrote a long letter to number {k} of the street" for k in range(6))
        for name in ("mayor", "baker")
    ]
    return [(5_000_000 + 10 * n + g, texts[g], "en", "s", len(texts[g])) for g in (0, 1) for n in range(7)]


def test_one_of_the_emptied_copies_stays(spark):
    docs = frame(spark, copies())
    for _, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, "")
    found = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert found == brute([(d, t) for d, t, *_ in copies()])
    assert len(found) == 3


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")
class TestGivenTables:
    @pytest.mark.parametrize("name", ["op3_line_dedup", "op5_threshold_topk"])
    def test_against_sql(self, spark, name):
        assert check.compare(spark, check.connect(SF_DIR), SF_DIR, name).startswith("ok")

    def test_pipeline(self, spark):
        docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        rows = contract.queries()["pipeline"](spark, SF_DIR).collect()
        ids = [r["doc_id"] for r in rows]
        assert len(ids) == len(set(ids))
        assert 0.5 * docs.count() < len(ids) <= docs.count()
        assert all(r["n_chars"] == len(r["text"]) for r in rows)

    def test_run_against_brute_force(self, spark, folder):
        given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        planted = frame(spark, copies()).select([c for c in given.columns if c in ("doc_id", "text", "lang", "source", "n_chars")])
        given.unionByName(planted, allowMissingColumns=True).to(given.schema).write.parquet(f"{folder}/documents.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        known = [(r["doc_id"], r["text"]) for r in corpus_pipeline.language_id(spark, docs, folder).collect()]
        found = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.run(spark, folder).collect())
        assert {d for d, *_ in copies()} <= {d for d, _ in known}
        assert found == brute(known)
