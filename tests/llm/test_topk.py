import math

import numpy as np
import pytest

from postsieve.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors, queries, k):
    def quantised(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * float(np.float32(x))) for x in v]

    usable = {i: quantised(v) for i, v in vectors}
    out = []
    for i in queries:
        if usable.get(i) is None:
            continue
        scores = [
            (-sum(a * b for a, b in zip(usable[i], v, strict=True)), j)
            for j, v in usable.items()
            if j != i and v is not None and len(v) == len(usable[i])
        ]
        out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(spark, rows, k=5, **options):
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS score", "'x' AS block")
    return sorted(map(tuple, topk.top_k(vectors, vectors.where("vec_id % 5 = 0"), k, **options).collect()))


def test_against_brute_force(spark):
    draw = np.random.default_rng(5)
    rows = [(n, [float(x) for x in draw.normal(0, 0.2, 8).astype(np.float32)]) for n in range(200)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, [0.0] * 8), (205, [0.0] * 8)]  # ties
    rows += [(210, None), (215, [1.0, None] * 4), (220, [math.nan] * 8), (225, [math.inf] * 8), (230, [0.5] * 3), (231, [-0.5] * 3)]
    want = brute(rows, [i for i, _ in rows if i % 5 == 0], 5)
    assert found(spark, rows) == want
    assert found(spark, rows, block_rows=16, query_rows=7) == want


def test_large_components_take_part(spark):
    assert found(spark, [(0, [1.0, 0.0]), (1, [2.0**20, 1.0]), (2, [3.0, 1.0])]) == [(0, 1, 1, 2**36), (0, 2, 2, 3 * 2**16)]
    draw = np.random.default_rng(9)
    rows = [(n, [float(np.float32(x)) for x in draw.normal(0, 0.2, 4)]) for n in range(60)]
    # 2**40 against small ones, and against another of 2**20: sums beyond 2**53, none beyond a long.
    rows += [(61, [2.0**40, 0.0, 1.0, 0.5]), (65, [0.25, 2.0**20, -(2.0**22), 1.0]), (66, [0.0, 2.0**19 + 0.5, 3.0, 1.0])]
    want = brute(rows, [i for i, _ in rows if i % 5 == 0], 5)
    assert found(spark, rows) == want
    assert found(spark, rows, block_rows=7, query_rows=5) == want


def test_scores_beyond_a_long_are_an_error(spark):
    with pytest.raises(Exception, match="fit a long"):
        found(spark, [(0, [2.0**40]), (1, [2.0**40])])


def test_few_candidates_and_empty_table(spark):
    assert found(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 131072)]
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, [(0, [])]) == []
    assert found(spark, []) == []


def test_search_stops_early():
    vectors = np.zeros((4000, 2))
    vectors[:, 0] = np.arange(4000)
    lists = np.argsort(vectors, axis=0, kind="stable").T
    ids, scores, scored = topk.threshold_search(vectors, np.arange(4000), np.array([1.0, 0.0]), 3999, 3, lists)
    assert ids.tolist() == [3998, 3997, 3996] and scores.tolist() == [3998, 3997, 3996]
    assert scored < 300
