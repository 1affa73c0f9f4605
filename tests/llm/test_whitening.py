"""Jacobi-Davidson and the whitening query against numpy's dense eigenvectors."""

import math

import numpy as np
import pytest

from swathbook.llm import whitening as W
from swathbook.llm.queries import op13_embedding_whitening


def brute(vectors, k=16):
    """x of every row that stays, n, S, eigenvalues and whitened rows, all from the dense covariance."""
    kept = [v for v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in kept])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    c = fit - sums / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1], axes[:, ::-1]
    held = values > 1e-12 * values[0]
    values, axes = values[held][:k], axes[:, held][:, :k]
    return x, n, sums, values, (x - sums / n) @ axes / np.sqrt(values), np.trace(c.T @ c / n)


@pytest.mark.parametrize(("dims", "rows", "k"), [(40, 400, 16), (12, 60, 16), (30, 10, 8), (3, 2, 16), (150, 500, 5)])
def test_solver(dims, rows, k):
    rng = np.random.default_rng(dims)
    x = rng.integers(-200, 200, (rows, dims)).astype(float)
    a = x.T @ x / rows
    values, vectors, residuals = W.jacobi_davidson(lambda y: a @ y, dims, k)
    want = np.linalg.eigvalsh(a)[::-1][:k]
    assert np.abs(values - want).max() <= 1e-13 * want[0]
    assert residuals.max() <= 2 * W.TOLERANCE * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def test_equal_eigenvalues():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.standard_normal((50, 50)))
    a = q @ np.diag([9.0] * 6 + [4.0] * 30 + [0.0] * 14) @ q.T
    values, _, _ = W.jacobi_davidson(lambda y: a @ y, 50, 10)
    assert np.allclose(values, [9.0] * 6 + [4.0] * 4, rtol=0, atol=1e-12)


def test_minres():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((25, 25))
    a, space = x + x.T, np.linalg.qr(rng.standard_normal((25, 2)))[0]
    right, shifts = rng.standard_normal((25, 3)), np.array([0.3, -1.0, 2.5])
    off = np.eye(25) - space @ space.T
    t = W.minres(lambda y: a @ y, shifts, space, right, 60)
    for i, s in enumerate(shifts):
        assert np.allclose(off @ (a - s * np.eye(25)) @ off @ t[:, i], off @ right[:, i], atol=1e-8)


def check(found, ids, vectors, k=16):
    x, n, sums, values, whitened, trace = brute(vectors, k)
    kept = [i for i, v in zip(ids, vectors, strict=True) if v and all(c is not None and math.isfinite(c) for c in v)]
    rows = found.collect()
    assert len(rows) == len(kept) * len(values)
    by_key = {(r["vec_id"], r["component"]): r for r in rows}
    signs = {}
    for row, i in enumerate(kept):
        far = [int(n) * int(c) - int(s) for c, s in zip(x[row], sums, strict=True)]
        for j in range(len(values)):
            r = by_key[(i, j + 1)]
            signs.setdefault(j, 1.0 if (r["whitened"] > 0) == (whitened[row, j] > 0) else -1.0)
            assert r["n"] == n and r["deviation"] == sum(d * d for d in far)
            assert abs(r["whitened"] - signs[j] * whitened[row, j]) < 1e-7
            assert abs(r["explained"] - values[j] / trace) < 1e-12
            assert r["identity_error"] < 1e-10
    return rows


def test_query(spark, tmp_path):
    rng = np.random.default_rng(8)
    turn = rng.standard_normal((20, 20))
    vectors = [list(map(float, v)) for v in (rng.standard_normal((300, 20)) @ turn).astype(np.float32)]
    vectors += vectors[:40] + [None, [], [1.0, None] + [0.0] * 18, [float("nan")] * 20, [float("inf")] * 20]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int")
    df.repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = op13_embedding_whitening(spark, str(tmp_path))
    assert dict(found.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    check(found, range(len(vectors)), vectors)


def test_small_tables(spark):
    """No vectors, one vector, equal vectors, fewer vectors than dimensions, unequal lengths, clashing names."""
    def run(vectors, **more):
        df = spark.createDataFrame([(i, v, 0.5, 7, "z") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, whitened double, component int, x string")
        return W.whiten(df, W.fit_whitening(df, "embedding", **more))

    assert run([]).collect() == [] and run([None, []]).collect() == []
    assert run([[1.0, 2.0]]).collect() == [] and run([[1.0, 2.0]] * 3).collect() == []
    vectors = [[float(i * i % 7), float(i % 3), i / 2, 1.0, -float(i)] for i in range(4)]
    check(run(vectors), range(4), vectors)
    check(run(vectors, components=2), range(4), vectors, 2)
    uneven = [[1.0], [2.0, 1.0], [0.5, 3.0], [1.0, 0.0]]
    assert len(run(uneven).collect()) == 4 * 2
    assert W.fit_whitening(spark.createDataFrame([(v,) for v in uneven], "e array<double>"), "e").n == 3  # [1] counts as [1, 0]


def test_long_sums():
    """Deviations are exact beyond 2 ** 53, and null beyond a long."""
    x, sums = np.array([[1_000_400], [1_000_000]]), np.array([3_000_000_000], object)
    assert W.deviations(x, 3000, sums) == [1_200_000**2, 0]
    n = 10**7
    far = n * 1_000_400 - 10**13 + 1
    assert W.deviations(x, n, np.array([10**13 - 1], object)) == [None if far * far >= 2**63 else far * far, 1]
    assert W.deviations(np.array([[1_000_401]]), 10**6, np.array([10**12 + 1], object)) == [(10**6 * 401 - 1) ** 2]
