from __future__ import annotations

import math

import numpy as np
import pytest
from regionpulse.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n long, x string, whitened int, d int"


def table(spark, vectors):
    return spark.createDataFrame([(k, v, 7, "a", 1, 2) for k, v in vectors], SCHEMA).repartition(3)


def numbers(vectors):
    return np.array([np.floor(64 * np.asarray(v, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000 for v in vectors])


def check(rows, vectors, components=16):
    """Compares with the eigenvectors of the whole covariance matrix."""
    x = numbers([v for _, v in vectors])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = (fit * n - sums) / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1], turn[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(rows) == len(vectors) * k
    got = {(r.vec_id, r.component): r for r in rows}
    side = {}
    for (vec, _), row in zip(vectors, x):
        want = ((row * n - sums) / n) @ turn[:, :k] / np.sqrt(values[:k])
        for c in range(k):
            r = got[vec, c + 1]
            if abs(want[c]) > 1e-6:
                side.setdefault(c, math.copysign(1, want[c] * r.whitened))
            assert r.whitened == pytest.approx(side.get(c, 1) * want[c], abs=1e-9)
            assert r.n == n and r.deviation == sum(int(e) ** 2 for e in row * n - sums)
            assert r.explained == pytest.approx(values[c] / values.sum(), rel=1e-9) and r.identity_error < 1e-9


def test_equals_the_eigenvectors_of_the_covariance(spark):
    rng = np.random.default_rng(1)
    scale = np.linspace(0.05, 3, 24)
    vectors = [(k, (rng.normal(size=24) * scale).tolist()) for k in range(300)]
    # Copies count once in the fit and are rows of the result.
    vectors += [(1000 + k, vectors[k % 3][1]) for k in range(150)]
    check(whitening.whitened(table(spark, vectors)).collect(), vectors)


def test_fewer_vectors_than_entries_and_constant_entries(spark):
    rng = np.random.default_rng(2)
    vectors = [(k, [*rng.normal(size=6).tolist(), 0.5, -0.5]) for k in range(5)]
    check(whitening.whitened(table(spark, vectors)).collect(), vectors)


def test_repeated_eigenvalues(spark):
    """The corners of a cross have one eigenvalue many times: no direction may be missing."""
    vectors = [(2 * k + s, [float(3 * (1 - 2 * s)) if j == k else 0.0 for j in range(12)]) for k in range(12) for s in (0, 1)]
    rows = whitening.whitened(table(spark, vectors)).collect()
    assert len(rows) == 24 * 12
    matrix = np.zeros((24, 12))
    for r in rows:
        matrix[r.vec_id, r.component - 1] = r.whitened
        assert r.explained == pytest.approx(1 / 12) and r.identity_error < 1e-9
    assert np.allclose(matrix.T @ matrix / 24, np.eye(12), atol=1e-9)


def test_bidiagonal_form_of_a_matrix():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 10)) * np.logspace(0, -4, 10)

    def product(c, earlier):
        u = x @ c
        return x.T @ u, (x @ earlier).T @ u, float(u @ u)

    b, v = whitening.bidiagonal(product, 10)
    assert np.allclose(v.T @ v, np.eye(10), atol=1e-12)
    assert np.allclose(b, np.triu(np.tril(b, 1)))
    assert np.allclose(np.linalg.svd(b)[1], np.linalg.svd(x)[1], rtol=1e-9)


def test_rows_that_cannot_be_used_are_dropped(spark):
    good = [(1, [1.0, 0.0, 2.0]), (None, [0.0, 1.0, 0.5]), (1, [1.0, 0.0, 2.0]), (4, [0.25, -1.0, 0.75]), (5, [0.0, 0.0, 0.0])]
    bad = [(6, None), (7, []), (8, [1.0, None, 1.0]), (9, [float("nan"), 0.0, 0.0]), (10, [float("inf"), 0.0, 0.0]), (11, [1e30, 0.0, 0.0]), (12, [1.0, 2.0])]
    rows = whitening.whitened(table(spark, good + bad)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in rows) == sorted((k or 0, c) for k, _ in good for c in (1, 2, 3))
    assert {r.n for r in rows} == {4}


def test_nothing_to_whiten(spark):
    for vectors in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = whitening.whitened(table(spark, vectors))
        assert out.collect() == [] and out.columns[0] == "vec_id"
