from collections import Counter, defaultdict

import numpy as np
import pandas as pd

from postsieve.llm import jaccard
from postsieve.llm.components import components
from tests.llm.conftest import frame, odd_documents


def grams(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows, threshold=0.8):
    """(doc_id, class, links) by comparing all pairs."""
    sets = {d: grams(t) for d, t in rows}
    parent, links = {d: d for d in sets}, Counter()

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and both >= threshold * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return sorted((d, top(d), links[d]) for d in ids)


def rows():
    draw = np.random.default_rng(4)
    words = np.array([f"w{k}" for k in range(400)])
    out = []
    for size in (3, 6, 40, 80, 200, 500):
        base = draw.choice(words, size)
        for copy in range(12):
            changed = base.copy()
            changed[draw.choice(size, min(size, copy // 2), replace=False)] = "new"
            out.append(" ".join(changed))
    # A chain: each like the next, the ends unlike.
    base = draw.choice(words, 100)
    for step in range(8):
        changed = base.copy()
        changed[: step * 5] = [f"c{k}" for k in range(step * 5)]
        out.append(" ".join(changed))
    out += ["", None, "  ", "single", "SINGLE"]
    return [(int(d), out[k]) for k, d in enumerate(draw.permutation(len(out)))]


def report(spark, data):
    docs = frame(spark, [(d, t, "en", "s", 0) for d, t in data])
    return sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.near_duplicate_report(docs).collect())


def test_against_all_pairs(spark):
    assert report(spark, rows()) == brute(rows())


def test_blocks_and_joins_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(jaccard, "_CELLS", 64)
    assert report(spark, rows()) == brute(rows())


def test_one_of_each_class_stays(spark):
    docs = frame(spark, [(d, t, "en", "s", 0) for d, t in rows()])
    kept = jaccard.keep_one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c, _ in brute(rows())})


def test_posterior_keeps_what_reaches_the_threshold():
    needed = jaccard.least_matches(0.8, 1e-5)
    assert [n for n, _ in needed] == list(range(32, 161, 32))
    assert all(0.4 * n < m < 0.8 * n for n, m in needed)
    draw = np.random.default_rng(0)
    matches = draw.random((20000, 160)) < 0.8
    kept = np.all([matches[:, :n].sum(axis=1) >= m for n, m in needed], axis=0)
    assert kept.mean() > 0.999


def test_components(spark):
    draw = np.random.default_rng(1)
    edges = [(k, k + 1) for k in range(60) if k % 20] + [tuple(map(int, draw.integers(100, 200, 2))) for _ in range(80)]
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    want = {}
    for node in sorted(near):
        waiting = [] if node in want else [node]
        while waiting:
            at = waiting.pop()
            if at not in want:
                want[at] = node
                waiting += near[at]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in found} == want and len(found) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_documents(spark):
    docs = odd_documents(spark)
    found = jaccard.near_duplicate_report(docs).collect()
    assert len(found) == 8
    links = sorted((r["doc_id"] or 0, r["n_links"]) for r in found)
    assert links == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (4, 1), (5, 0), (6, 0)]
    assert jaccard.near_duplicate_report(docs.limit(0)).count() == 0
    assert jaccard.keep_one_per_class(docs).count() == 8


def test_chunks_are_whole_groups_of_bounded_pairs():
    sizes = [1, 2, 600, 3, 3, 50, 1, 400, 400, 2]
    rows = pd.DataFrame({"key": np.repeat(np.arange(len(sizes)), sizes), "i": 0, "j": 0})
    chunks = list(jaccard._whole_groups(rows, size=500, pairs=2000))
    assert [s for s, _ in chunks] == [0] + [e for _, e in chunks[:-1]] and chunks[-1][1] == len(rows)
    for start, end in chunks:
        members = rows["key"][start:end].value_counts()
        assert (members == [sizes[k] for k in members.index]).all()
        assert len(members) == 1 or (len(rows[start:end]) <= 500 and (members * (members - 1) / 2).sum() <= 2000)
    # The first eight groups have 260,732 pairs; the ninth would go beyond 2**18.
    assert list(jaccard._whole_groups(rows)) == [(0, 1060), (1060, 1462)]
