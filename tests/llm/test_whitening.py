"""Spectrum slicing and whitening against numpy's full decomposition and exact numbers."""

from fractions import Fraction

import numpy as np
import pytest

from billing_guard.llm import queries, whitening
from billing_guard.llm.common import table
from tests.llm.conftest import by


def matrices():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 7, 20, 40):
        a = rng.normal(size=(d, d))
        q = np.linalg.qr(a)[0]
        repeated = q * rng.choice([5.0, 5, 3, 1, 0], size=d) @ q.T
        low_rank = rng.normal(size=(d, 2))
        yield from (a @ a.T, (repeated + repeated.T) / 2, np.eye(d) * 3, low_rank @ low_rank.T,
                    np.diag(rng.integers(0, 4, size=d).astype(float)))


@pytest.mark.parametrize("matrix", list(matrices()))
def test_counts_and_leading_pairs(matrix):
    true = np.linalg.eigvalsh(matrix)[::-1]
    for shift in (-1.3, 0.37, 2.2, 4.4, 30.1):
        assert whitening.inertia_above(matrix, shift) == (true > shift).sum()
    values, vectors = whitening.leading_eigenpairs(matrix, 4)
    k = min(4, int((true > 1e-10 * true.max(initial=0)).sum())) if true.max() > 0 else 0
    assert len(values) == k
    assert np.allclose(values, true[:k], rtol=1e-12, atol=1e-12 * true[0])
    assert np.abs(vectors @ vectors.T - np.eye(k)).max(initial=0) < 1e-12
    assert np.abs(vectors @ matrix - values[:, None] * vectors).max(initial=0) <= 1e-11 * max(true[0], 1)


def test_nothing_to_find():
    assert len(whitening.leading_eigenpairs(np.zeros((3, 3)), 4)[0]) == 0
    assert len(whitening.leading_eigenpairs(np.zeros((0, 0)), 4)[0]) == 0


def brute_force(vectors):
    """Fit of the distinct whole-number vectors of one length with numpy."""
    x = np.unique(np.floor(256 * np.asarray(vectors, np.float64)).astype(np.int64), axis=0)
    y = x - x.mean(axis=0)
    values, basis = np.linalg.eigh(y.T @ y / len(x))
    return x, values[::-1], basis[:, ::-1].T


def check(rows, vectors, ids):
    x, values, basis = brute_force(vectors)
    n, sums = len(x), x.sum(axis=0)
    total = {}
    for r in rows:
        v = np.floor(256 * np.asarray(vectors[ids.index(r.vec_id)], np.float64)).astype(np.int64)
        assert r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, sums))
        expected = basis[r.component - 1] @ (v - sums / n) / np.sqrt(values[r.component - 1])
        assert abs(abs(r.whitened) - abs(expected)) < 1e-9
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9 and r.identity_error < 1e-9
        if abs(expected) > 1e-6:
            assert total.setdefault(r.component, r.whitened * expected > 0) == (r.whitened * expected > 0)


def test_query_against_numpy(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = queries.queries()["op12_embedding_whitening"](spark, sf_dir).collect()
    given = table(spark, sf_dir, "embeddings").collect()
    assert len(rows) == 4 * len(given)
    check(rows, [r.embedding for r in given], [r.vec_id for r in given])


def test_edge_cases(spark):
    rng = np.random.default_rng(2)
    good = [rng.normal(size=3).round(3).tolist() for _ in range(9)]
    schema = "vec_id long, embedding array<float>, label int, x int, component int, n long"
    odd = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 0.0]]
    rows = [(i, v, 1, 0, 0, 0) for i, v in enumerate(good + [good[0], [5.0, 1.0]] + odd)]
    rows.append((None, good[1], None, 0, 0, 0))
    got = by(whitening.whiten_vectors(spark.createDataFrame(rows, schema)), "vec_id")
    stored = [np.float32(v).astype(float).tolist() for v in good]
    check([r for i in range(9) for r in got[i]], stored, list(range(9)))
    assert {k: len(v) for k, v in got.items()} == {None: 3} | dict.fromkeys(range(10), 3)  # 3 dimensions
    assert [r.deviation for r in got[9]] == [r.deviation for r in got[0]]
    empty = spark.createDataFrame([], schema)
    assert whitening.whiten_vectors(empty).count() == 0


def test_large_entries_stay_exact_or_null():
    fit = whitening.Fit(3, [3 << 50, -7], np.ones(1), np.eye(1, 2), 1.0)
    x = np.array([[1 << 50, 2], [(1 << 61), -(1 << 61)]], np.int64)
    assert whitening.deviations(x[:1], fit) == [13 ** 2]
    assert whitening.deviations(x, fit) == [13 ** 2, None]
    centred = fit.centred(x)
    assert centred[0, 1] == pytest.approx(float(Fraction(13, 3)))
