"""Whitening against numpy's own eigenvectors, and the solver's parts on hard matrices."""

import itertools

import numpy as np
import pytest

from retail_marts.llm import whitening as W


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")


def expected(rows, k=4):
    ok = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    x = np.unique(np.stack([v for _, v in ok]), axis=0)
    n, s = len(x), x.sum(axis=0)
    values, vecs = np.linalg.eigh((x - s / n).T @ (x - s / n) / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    return {(i, c + 1): (n, int(((n * v - s) ** 2).sum()), float((v - s / n) @ vecs[:, c] / np.sqrt(values[c])), values[c] / values.sum()) for i, v in ok for c in range(k)}


@pytest.mark.parametrize("scales", [[9, 3, 1, 0.2, 0.05], [1, 1, 1, 1, 1, 1]])
def test_equals_eigenvectors(spark, scales):
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(300, len(scales))) * scales)]
    rows += [(900 + i, rows[0][1]) for i in range(200)] + [(2000, None), (2001, [1.0, None, 0, 0, 0]), (2002, [float("nan")] * 5), (2003, [float("inf")] * 5)]
    want, got = expected(rows), W.whiten(frame(spark, rows).repartition(7)).collect()
    assert {(r.vec_id, r.component) for r in got} == set(want) and got[0].identity_error < 1e-10
    for c in range(1, 5):
        pairs = [(r.whitened, want[r.vec_id, c][2]) for r in got if r.component == c]
        sign = np.sign(sum(a * b for a, b in pairs))
        assert max(abs(a - sign * b) for a, b in pairs) < 1e-9
    assert all((r.n, r.deviation) == want[r.vec_id, r.component][:2] and abs(r.explained / want[r.vec_id, r.component][3] - 1) < 1e-10 for r in got)


def test_equal_eigenvalues_and_lost_rank(spark):
    cube = [(i, v) for i, v in enumerate(itertools.product([-1, 1], repeat=5))]
    assert W.whiten(frame(spark, cube)).first().identity_error < 1e-10
    flat = [(i, [i, 2 * i, -i]) for i in range(20)]
    assert {r.component for r in W.whiten(frame(spark, flat)).collect()} == {1}
    assert W.whiten(frame(spark, [(1, [1, 2]), (2, [1, 2])])).count() == 0
    assert W.whiten(frame(spark, cube).limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 64])
def test_solver_on_random_triangles(n):
    r = np.triu(np.random.default_rng(n).normal(size=(n, n))) + 3 * np.eye(n)
    a, b, v = W.bidiagonal(r)
    s = W.dqds(a, b)
    x = v @ W.vectors(a, b, s)
    assert np.abs(s / np.linalg.svd(r)[1] ** 2 - 1).max() < 1e-9
    assert np.abs(x.T @ x - np.eye(n)).max() < 1e-10
    assert np.abs(r.T @ (r @ x) - x * s).max() < 1e-10 * s[0]


def test_small_values_to_high_relative_accuracy():
    """The bidiagonal with ones and a large superdiagonal: its least value is known from its determinant."""
    n = 12
    s = W.dqds(np.ones(n), np.full(n - 1, 8.0))
    assert abs(np.prod(s) - 1) < 1e-12 and s[-1] < 1e-18


@pytest.mark.parametrize("values", [np.ones(10), [1, 1, 1, 1 - 1e-9, 1 - 1e-12, 0.5, 0.5, 0.25, 1e-3, 1e-7], [1, 1 - 1e-8, 1 - 2e-8, 1 - 1e-10, *[0.9] * 6]])
def test_clusters_stay_at_right_angles(values):
    rng = np.random.default_rng(11)
    for _ in range(10):
        q = [np.linalg.qr(rng.normal(size=(10, 10)))[0] for _ in range(2)]
        r = np.linalg.qr(q[0] * np.array(values) @ q[1], mode="r")
        a, b, v = W.bidiagonal(r)
        s = W.dqds(a, b)
        x = v @ W.vectors(a, b, s[:7])
        assert np.abs(x.T @ x - np.eye(7)).max() < 1e-8 and np.abs(r.T @ (r @ x) - x * s[:7]).max() < 1e-7


def test_deviation_beyond_a_long_is_null():
    m = W.Whitening(3, [2**61, 0], np.zeros(2), np.eye(2), np.ones(2), np.ones(2))
    assert m.deviation(np.array([[1, 1]])) == [None]
