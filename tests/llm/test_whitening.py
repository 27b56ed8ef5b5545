import math
import random

import numpy as np
import pytest

from provender.llm import whitening


def random_matrix(seed, rank, d):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((rank, d)) * np.linspace(1, 3, rank)[:, None]
    return a.T @ a


@pytest.mark.parametrize("rank,d", [(300, 300), (400, 150), (5, 200), (64, 64), (3, 3), (1, 1), (40, 40)])
def test_leading_eigenpairs(rank, d):
    a = random_matrix(rank + d, rank, d)
    values, vectors = whitening.jacobi_davidson(lambda w: a @ w, d, 8, float(np.trace(a)))
    want = np.linalg.eigvalsh(a)[::-1][:min(8, rank, d)]
    assert len(values) == len(want) and np.abs(values / want - 1).max() < 1e-12
    assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() < 1e-13 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def test_equal_eigenvalues_restarts_and_limits():
    a = np.diag([5.0] * 60 + [1.0] * 40)
    assert np.allclose(whitening.jacobi_davidson(lambda w: a @ w, 100, 8, 360.0)[0], 5)
    b = random_matrix(3, 500, 500)
    values, _ = whitening.jacobi_davidson(lambda w: b @ w, 500, 8, float(np.trace(b)), subspace=40)
    assert np.abs(values / np.linalg.eigvalsh(b)[::-1][:8] - 1).max() < 1e-12
    with pytest.raises(ArithmeticError):
        whitening.jacobi_davidson(lambda w: b @ w, 500, 8, float(np.trace(b)), outer=2)
    assert not len(whitening.jacobi_davidson(lambda w: w * 0, 4, 2, 0.0)[0])


def test_correction_solves_its_equation():
    a = random_matrix(11, 30, 30)
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((30, 2)))[0]
    theta = np.array([q[:, i] @ a @ q[:, i] for i in range(2)])
    r = a @ q - q * theta
    t = whitening._corrections(lambda w: a @ w, np.zeros((30, 0)), q, theta, r, 200)
    p = np.eye(30) - q @ q.T
    for i in range(2):
        left = p @ (a - theta[i] * np.eye(30)) @ p @ t[:, i]
        assert np.linalg.norm(left + p @ r[:, i]) < 1e-6 * np.linalg.norm(r[:, i])


def test_against_a_dense_solution(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((400, 20)) * np.linspace(0.2, 1.5, 20)
    rows = [(i, [float(x) for x in v], i % 3, "x") for i, v in enumerate(base)]
    rows += [(7, rows[7][1], 0, "again"), (None, rows[9][1], 0, "no id")]
    bad = [(900, None, 0, ""), (901, [], 0, ""), (902, [None] * 20, 0, ""), (903, [math.nan] * 20, 0, ""),
           (904, [math.inf] + [0.0] * 19, 0, ""), (905, [1e300] * 20, 0, ""), (906, [1.0, 2.0], 0, "short")]
    both = rows + bad
    random.Random(1).shuffle(both)
    df = spark.createDataFrame(both, "vec_id long, embedding array<double>, x int, whitened string").repartition(5)
    got = whitening.whiten(df, 8).collect()
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v, *_ in rows])
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    want = {i: (centred @ vectors / np.sqrt(values))[j] for j, (i, *_) in enumerate(rows)}
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got) == sorted((i is None, i or 0) for i, *_ in rows)
    flips = {tuple(np.sign(np.array(r.whitened) * want[r.vec_id])) for r in got}
    assert len(flips) == 1  # either sign, the same for all rows
    far = {i: sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[j], s, strict=True)) for j, (i, *_) in enumerate(rows)}
    for r in got:
        assert r.n == n and r.deviation == far[r.vec_id]
        assert np.allclose(np.abs(r.whitened), np.abs(want[r.vec_id]), atol=1e-9)
        assert np.allclose(r.explained, values / np.trace(centred.T @ centred / n), rtol=1e-12)
        assert r.identity_error < 1e-10


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    whiten = lambda rows: whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert whiten([]) == [] == whiten([(1, None)]) == whiten([(1, [1.0, 2.0])]) == whiten([(1, [1.0]), (2, [1.0])])
    two = whiten([(1, [0.0, 1.0, 3.0]), (2, [1.0, 1.0, 0.0])])
    assert [len(r.whitened) for r in two] == [1, 1] and all(abs(abs(r.whitened[0]) - 1) < 1e-12 for r in two)
    assert two[0].explained == pytest.approx([1.0])
    huge = whiten([(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 0.5])])
    assert len(huge) == 3 and any(r.deviation is None for r in huge)
