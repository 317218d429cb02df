import hashlib
from collections import defaultdict

import pytest

from postsieve.llm import linededup
from tests.llm.conftest import frame, odd_documents

A, B = "A line that stands in many documents, number one", "Zweite Zeile, die in vielen Texten steht, ÄÖ 中文"


def key(line):
    bare = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if c.isascii() else c for c in bare)


def brute(rows, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def rows():
    out = [(n, f"own {n}\n  {A}\r\n{B if n % 2 else A.upper()}\n{A}") for n in range(9)]
    out += [(3, f"{A}\nanother text under one id"), (3, f"{A}\nanother text under one id"), (None, A), (20, None), (21, "")]
    out += [(30 + n, "\n".join(["filler"] * (70 * n) + [B.replace("Ä", "ä") if n == 2 else B])) for n in range(5)]
    return out


def test_against_brute_force(spark):
    docs = frame(spark, [(d, t, "en", "s", len(t or "")) for d, t in rows()])
    found = sorted(map(tuple, linededup.line_report(docs).collect()), key=str)
    assert found == sorted(brute(rows()), key=str)


def test_large_way_gives_the_same(spark, monkeypatch):
    docs = frame(spark, [(d, t, "en", "s", len(t or "")) for d, t in rows()])
    small = sorted(map(tuple, linededup.line_report(docs).collect()), key=str)
    monkeypatch.setattr(linededup, "BROADCAST_ROWS", -1)
    assert sorted(map(tuple, linededup.line_report(docs).collect()), key=str) == small


@pytest.mark.parametrize("bound", [1, 2, 3])
def test_heavy_lines_are_broadcast_beyond_the_bound(spark, monkeypatch, bound):
    texts = [(n, "\n".join([A, B, f"{A} again"][: 1 + n % 3])) for n in range(30)]
    docs = frame(spark, [(d, t, "en", "s", len(t)) for d, t in texts])
    monkeypatch.setattr(linededup, "BROADCAST_ROWS", bound)
    found = sorted(map(tuple, linededup.line_report(docs).collect()), key=str)
    assert found == sorted(brute(texts), key=str)


@pytest.mark.parametrize("bits", [0, 2, 12])
def test_runs_across_blocks_and_ranges(spark, monkeypatch, bits):
    texts = [(n * 3 - 40, f"{A}\n{A}\nown {n}") for n in range(40)] + [(2**62, A)]
    docs = frame(spark, [(d, t, "en", "s", len(t)) for d, t in texts])
    monkeypatch.setattr(linededup, "BLOCK_BITS", bits)
    found = sorted(map(tuple, linededup.line_report(docs).collect()), key=str)
    assert found == sorted(brute(texts), key=str)


def test_first_occurrences_stream_over_one_sort(spark):
    docs = frame(spark, [(d, t, "en", "s", len(t or "")) for d, t in rows()])
    crowded = linededup.crowded_lines(linededup.long_lines(docs, 40), 5)
    plan = crowded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and plan.count("Window [") == 1
    sorts = [line for line in plan.split("\n") if " Sort [" in line]
    assert len(sorts) == 1 and "doc_id" in sorts[0] and "pos" in sorts[0]
    assert plan.count("Exchange ") == 2  # by ranges, and one row per hash and task


def test_text_and_length_follow(spark):
    docs = frame(spark, [(n, f"own\n{A}", "en", "s", 99) for n in range(5)])
    kept = {r["doc_id"]: r for r in linededup.dedup_lines(docs).collect()}
    assert (kept[0]["text"], kept[0]["n_chars"]) == ("own", 3)
    assert (kept[4]["text"], kept[4]["n_chars"]) == (f"own\n{A}", 99)


def test_odd_documents_stay(spark):
    docs = odd_documents(spark)
    kept = linededup.dedup_lines(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert linededup.line_report(docs.limit(0)).count() == 0


def test_no_python_on_the_way(spark):
    plan = linededup.line_report(odd_documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
