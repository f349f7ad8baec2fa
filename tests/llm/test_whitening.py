"""Operator 13: the solver against numpy's, whitened rows against eigenvectors of the covariance."""

from __future__ import annotations

import math

import numpy as np
import pytest

from gristmill.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, n int, component string, x string"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
DRAW = np.random.default_rng(0)
TURN = np.linalg.qr(DRAW.standard_normal((40, 40)))[0]
MATRICES = {
    "one": DRAW.standard_normal((9, 1)),
    "two": DRAW.standard_normal((9, 2)),
    "random": DRAW.standard_normal((300, 64)),
    "graded": DRAW.standard_normal((300, 40)) * np.logspace(0, -8, 40),
    "graded upwards": DRAW.standard_normal((300, 40)) * np.logspace(-8, 0, 40),
    "equal values": np.eye(40),
    "groups of equal values": np.diag(np.repeat([5, 3, 1.0], [20, 12, 8])) @ TURN,
    "groups of near values": np.diag(np.repeat([5, 3, 1.0], [20, 12, 8]) + 1e-9 * DRAW.standard_normal(40)) @ TURN,
    "low rank": DRAW.standard_normal((90, 5)) @ DRAW.standard_normal((5, 40)),
    "fewer rows": DRAW.standard_normal((10, 40)),
    "block": np.pad(DRAW.standard_normal((5, 5)), ((0, 35), (0, 35))),
    "twins": np.diag(np.abs(np.arange(21) - 10.0)) + np.eye(21, k=1) + np.eye(21, k=-1),
    "zeros": np.zeros((9, 9)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_solver(name):
    a = MATRICES[name]
    p = a.shape[1]
    r = np.linalg.qr(a, mode="r")
    values, right = whitening.right_vectors(np.concatenate([r, np.zeros((p - len(r), p))]))
    expected = np.append(np.linalg.svd(a, compute_uv=False), np.zeros(p))[:p]
    top = max(expected[0], 1e-300)
    assert np.abs(values - expected).max() <= 1e-13 * top
    assert np.abs(right.T @ right - np.eye(p)).max() < 1e-11
    assert np.abs(a.T @ (a @ right) - right * values**2).max() <= 1e-13 * top**2


def test_small_values_are_accurate():
    """Squares of a bidiagonal matrix whose values span 15 powers of ten, against whole-number arithmetic."""
    q, e = np.array([1e15, 1e8, 4.0, 1.0]), np.array([3.0, 2.0, 0.5])
    found = whitening.dqds(q, e)
    product = math.prod(q)
    assert math.isclose(math.prod(found), product, rel_tol=1e-13)
    assert math.isclose(found.sum(), q.sum() + e.sum(), rel_tol=1e-15)


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, "c", "x") for i, v in vectors], SCHEMA)


def check(found, vectors, size, components=32):
    kept = [
        (i, [int(math.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v])
        for i, v in vectors
        if v is not None and len(v) == size and all(c is not None and np.isfinite(c) for c in v)
    ]
    x = np.array([v for _, v in kept], dtype=float)
    n = len(kept)
    centred = x - x.mean(axis=0)
    cov = centred.T @ centred / n
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    use = min(components, int((values > 1e-20 * values[0]).sum()), int(np.linalg.matrix_rank(centred)))
    rows = found.collect()
    assert found.columns == COLUMNS and len(rows) == n * use
    sums = [sum(column) for column in zip(*(v for _, v in kept))]
    deviations = sorted((i is None, i or 0, sum((n * c - s) ** 2 for c, s in zip(v, sums))) for i, v in kept)
    assert sorted((r[0] is None, r[0] or 0, r[3]) for r in rows if r[1] == 1) == deviations
    assert {r[2] for r in rows} == {n} and {r[1] for r in rows} == set(range(1, use + 1))
    (error,) = {r[6] for r in rows}
    assert error < 1e-9
    for k in range(use):
        mine = np.array(sorted(r[4] for r in rows if r[1] == k + 1))
        plain = np.sort(centred @ basis[:, k] / math.sqrt(values[k]))
        distinct = min(abs(values[k] - values[j]) for j in range(size) if j != k) > 1e-3 * values[0] if size > 1 else True
        if distinct:
            assert min(np.abs(mine - plain).max(), np.abs(mine + plain[::-1]).max()) < 1e-8
        assert abs(next(r[5] for r in rows if r[1] == k + 1) / (values[k] / np.trace(cov)) - 1) < 1e-9


def test_equal_to_eigenvectors(spark):
    draw = np.random.default_rng(1)
    spread = draw.standard_normal((12, 12)) * np.linspace(3, 1, 12)
    vectors = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(draw.standard_normal((300, 12)) @ spread)]
    check(whitening.whitened(frame(spark, vectors)), vectors, 12)
    check(whitening.whitened(frame(spark, vectors), components=3), vectors, 12, components=3)


def test_whole_table(spark, sf_dir):
    vectors = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(queries.QUERIES["op13_embedding_whitening"](spark, sf_dir), vectors, 64)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [1.0, 2.0, -3.0]), (1, [1.0, 2.0, -3.0]), (2, [0.5, -0.25, 100.0]), (None, [7.0, 7.0, 7.0]),
        (3, [2.0, 1.0, 0.015625]), (4, None), (5, []), (6, [1.0, None, 2.0]), (7, [nan, 0.0, 0.0]),
        (8, [inf, 0.0, 0.0]), (9, [1.0, 2.0]), (10, [-0.0, 0.0, 1e-9]),
    ]
    check(whitening.whitened(frame(spark, vectors)), vectors, 3)


def test_directions_without_variance_have_no_rows(spark):
    vectors = [(i, [float(i), float(2 * i), 5.0, float(i % 3)]) for i in range(50)]
    check(whitening.whitened(frame(spark, vectors)), vectors, 4)
    assert whitening.whitened(frame(spark, vectors)).select("component").distinct().count() == 2
    for few in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]):
        found = whitening.whitened(frame(spark, few))
        assert found.columns == COLUMNS and found.collect() == []


def test_deviations_beyond_64_bits_are_null(spark):
    vectors = [(i, [1e9 * (i % 2), float(i)]) for i in range(40)]
    found = whitening.whitened(frame(spark, vectors)).select("deviation", "identity_error").collect()
    assert {r[0] for r in found} == {None} and max(r[1] for r in found) < 1e-4
