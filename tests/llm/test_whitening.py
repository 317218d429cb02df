import math

import numpy as np
import pytest

from postsieve.llm import whitening
from postsieve.llm.whitening import Fit, jacobi_davidson, minres

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, components=8):
    """From the whole matrix: n, exact deviations, eigenvalues, whitened columns up to their signs."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    centred = np.array([[n * c - s for c, s in zip(r, sums, strict=True)] for r in x], dtype=float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return [i for i, _ in kept], n, deviations, values[order], centred @ axes[:, order], values.sum()


def compare(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'a' AS component", "1 AS n", "2 AS x")
    got = whitening.whiten(table).collect()
    ids, n, deviations, values, projected, total = brute(rows)
    k = min(8, len(values))
    assert len(got) == len(ids) * k
    by_row = {(r.vec_id, r.component): r for r in got}
    for place, (i, deviation) in enumerate(zip(ids, deviations, strict=True)):
        for c in range(1, k + 1):
            r = by_row[i, c]
            assert (r.n, r.deviation, r.deviation_exact) == (n, deviation if deviation < 1 << 63 else None, str(deviation))
            assert r.explained == pytest.approx(values[c - 1] / total, rel=1e-9)
            assert r.identity_error < 1e-9
            assert r.residual <= 1e-12 * values[0]
    want = projected / np.sqrt(values)
    have = np.array([[by_row[i, c].whitened for c in range(1, k + 1)] for i in ids])
    signs = np.sign((want * have).sum(axis=0))
    assert np.abs(have * signs - want).max() < 1e-7


def draws(n, d, seed=3):
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(n, d)) @ draw.normal(size=(d, d)) / d).astype(np.float32).tolist()


def test_against_the_whole_matrix(spark):
    rows = list(enumerate(draws(300, 24)))
    rows += [(900, None), (901, []), (902, [1.0, None] * 12), (903, [math.nan] * 24), (904, [-math.inf] * 24)]
    compare(spark, rows)


def test_few_dimensions_and_a_huge_hot_vector(spark):
    compare(spark, list(enumerate(draws(40, 3))))
    heavy = draws(60, 5) + [[2.0**30, 0.0, -(2.0**20), 1.0, 0.5]]
    ids, n, deviations, *_ = brute(list(enumerate(heavy)))
    got = whitening.whiten(spark.createDataFrame(list(enumerate(heavy)), SCHEMA)).collect()
    assert {r.vec_id: int(r.deviation_exact) for r in got} == dict(zip(ids, deviations, strict=True))
    assert any(r.deviation is None for r in got)


def test_copies_of_one_vector_and_missing_ids(spark):
    vectors = draws(50, 6)
    rows = [(7, vectors[0])] * 40 + [(None, vectors[1])] * 2 + list(enumerate(vectors, 100))
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 92 * 6
    assert len({round(r.whitened, 9) for r in got if r.vec_id == 7 and r.component == 1}) == 1
    assert sum(r.vec_id is None for r in got) == 12
    w = np.array([r.whitened for r in got if r.component == 2])
    assert w.mean() == pytest.approx(0, abs=1e-9) and (w * w).mean() == pytest.approx(1)


def test_flat_components_are_null(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(20)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.component, r.whitened is None) for r in got} == {(1, False), (2, True), (3, True)}
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect()
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(0, None, 0.0, None)}


def test_empty_tables_and_other_lengths(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).collect() == []
    rows = [*enumerate(draws(30, 4)), (99, [1.0, 2.0])]
    assert 99 not in {r.vec_id for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}


@pytest.mark.parametrize(("d", "gap"), [(1, 1.0), (9, 0.0), (64, 0.3), (64, 0.01), (150, 0.05)])
def test_eigenpairs_against_lapack(d, gap):
    draw = np.random.default_rng(d)
    basis = np.linalg.qr(draw.normal(size=(d, d)))[0]
    a = basis * (1 + gap * np.arange(d)) @ basis.T
    values, axes, norms = jacobi_davidson(lambda b: a @ b, d, min(8, d))
    want = np.sort(np.linalg.eigvalsh(a))[::-1][: len(values)]
    assert np.abs(values - want).max() < 1e-12 * want[0] and norms.max() < 1e-12 * want[0]
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12


def test_minres_solves_indefinite_systems():
    draw = np.random.default_rng(1)
    basis = np.linalg.qr(draw.normal(size=(20, 20)))[0]
    a = basis * np.concatenate((np.linspace(-3, -1, 7), np.linspace(1, 4, 13))) @ basis.T
    right = np.hstack((draw.normal(size=(20, 3)), np.zeros((20, 1))))
    x = minres(lambda b: a @ b, right, 60, goal=1e-11)
    assert np.abs(a @ x - right).max() < 1e-8


def test_exact_deviations():
    x = np.array([[10**9, 5], [3, -4], [7, 7]], dtype=np.int64)
    fit = Fit(3, [int(s) for s in x.sum(axis=0)])
    want = [sum((3 * int(c) - s) ** 2 for c, s in zip(row, fit.sums, strict=True)) for row in x]
    assert fit.deviations(x) == want and max(want) > 1 << 60
