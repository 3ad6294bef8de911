"""Whitening against numpy and exact fractions."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from adsieve.llm import charpoly as P
from adsieve.llm import whitening as W


def leverrier(a):
    """Characteristic polynomial (lowest first), by Faddeev-LeVerrier."""
    d = len(a)
    m, out = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][x] * m[x][j] for x in range(d)) + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        out.append(-sum(a[i][x] * m[x][i] for i in range(d) for x in range(d)) / k)
    return [int(c) for c in out[::-1]]


def psd(rng, d, rank, size=9):
    x = [[rng.randint(-size, size) for _ in range(d)] for _ in range(rank)]
    return [[sum(r[i] * r[j] for r in x) for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("d, rank", [(1, 1), (2, 1), (5, 5), (9, 4), (12, 30)])
def test_characteristic_polynomial(lspark, d, rank):
    rng = random.Random(d)
    for a in (psd(rng, d, rank), psd(rng, d, rank, 10 ** 9), [[(i == j) * 7 for j in range(d)] for i in range(d)]):
        coefficients = W.characteristic(lspark, a)
        assert coefficients == leverrier(a)
        roots = P.Roots(coefficients, sum(a[i][i] for i in range(d)))
        want = np.linalg.eigvalsh(np.array(a, dtype=float))[::-1]
        assert roots.positive == np.linalg.matrix_rank(np.array(a, dtype=float))
        got = [roots.locate(k + 1)[0] * 2.0 ** roots.e for k in range(roots.positive)]
        assert np.allclose(got, want[: len(got)], rtol=1e-9)


def test_zero_pivots_and_decoupled_blocks():
    a = [[0, 0, 2, 0], [0, 3, 0, 0], [2, 0, 5, 0], [0, 0, 0, 3]]
    primes = P.primes_above(10 ** 12)
    assert P.combine(primes, P.residues(a, primes).tolist()) == leverrier(a)


def test_repeated_roots():
    a = [[5, 0, 0, 0], [0, 3, 0, 0], [0, 0, 3, 0], [0, 0, 0, 3]]
    roots = P.Roots(leverrier(a), 14)
    assert [roots.locate(k)[1:] for k in (1, 2, 3, 4)] == [(0, 1), (1, 3), (1, 3), (1, 3)]
    y = roots.locate(3)[0]
    basis = np.array(P.null_space(a, y, roots.e, 3), dtype=float)
    assert np.allclose(basis @ basis.T, np.eye(3), atol=1e-15) and np.allclose(basis[:, 0], 0, atol=1e-15)
    # two roots 1e-12 apart are still two
    k = 10 ** 12
    a = [[k, 0], [0, k + 1]]
    roots = P.Roots(leverrier(a), 2 * k + 1)
    assert [roots.locate(i)[1:] for i in (1, 2)] == [(0, 1), (1, 1)]
    v = P.null_space([[k + 1, 0], [0, k]], roots.locate(1)[0], roots.e, 1)[0]
    assert abs(float(v[0])) == 1 and abs(float(v[1])) < 1e-60


def brute(rows, most=32):
    """By (id, place among its rows): components, from exact centred integers."""
    rows = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    t = n * x - s
    cov = np.array((t.T @ t), dtype=float) / float(n) ** 3
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    k = min(most, int((e > 1e-9 * e[0]).sum()) if e[0] > 0 else 0)
    w = np.array(t / n, dtype=float) @ u[:, :k] / np.sqrt(e[:k])
    return rows, n, [int(v) for v in (t * t).sum(axis=1)], w, e[:k] / cov.trace()


def check(out, rows, most=32):
    kept, n, deviation, w, explained = brute(rows, most)
    got = {}
    for r in out.collect():
        got.setdefault(r.vec_id, []).append(r)
    assert sum(map(len, got.values())) == w.size
    for (i, _), dev, row in zip(kept, deviation, w):
        mine = sorted(got.get(i, []), key=lambda r: r.component)
        assert [r.component for r in mine] == list(range(1, w.shape[1] + 1))
        for r, value, share in zip(mine, row, explained):
            assert r.n == n and r.deviation == dev and r.identity_error < 1e-9
            assert abs(r.explained - share) <= 1e-9 * share and abs(abs(r.whitened) - abs(value)) < 1e-6 * (1 + abs(value))
    return got


@pytest.mark.parametrize("n, d", [(200, 8), (40, 40), (5, 12), (1, 3), (300, 1)])
def test_whitened(lspark, n, d):
    rng = np.random.default_rng(n)
    rows = [(k, (rng.normal(size=d) * (1 + np.arange(d))).tolist()) for k in range(n)]
    rows += [(9000, None), (9001, [float("nan")] * d), (9002, [None] * d), (9003, [float("inf")] + [0.0] * (d - 1))]
    out = W.whitened(lspark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, n int, whitened string").repartition(3))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "dim", "identity_error"]
    check(out, rows)


def test_components_are_orthonormal_eigenvectors(lspark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 5))
    rows = [(k, np.r_[b, b[0], -b[1], 0.25].tolist()) for k, b in enumerate(base)]  # rank 5 of 8
    df = lspark.createDataFrame(rows, "vec_id long, embedding array<float>")
    model = W.fit(df, 32)[8]
    assert len(model.values) == 5
    assert np.abs(model.components @ model.components.T - np.eye(5)).max() < 1e-15 * 10
    x = np.floor(64 * np.array([v for _, v in rows], dtype=np.float32).astype(float))
    cov = np.cov(x.T, bias=True)
    assert np.allclose(cov @ model.components.T, model.components.T * model.values, rtol=1e-12, atol=1e-12 * model.values[0])


def test_equal_eigenvalues(lspark):
    d = 6
    rows = [(2 * i + s, [float(s * 2 - 1) if j == i else 0.0 for j in range(d)]) for i in range(d) for s in (0, 1)]
    got = W.whitened(lspark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    values = np.zeros((len(rows), d))
    for r in got.collect():
        values[r.vec_id, r.component - 1] = r.whitened
        assert r.identity_error < 1e-12 and abs(r.explained - 1 / d) < 1e-12
    assert np.allclose(values.T @ values / len(rows), np.eye(d), atol=1e-12)


def test_edges(lspark):
    schema = "vec_id long, embedding array<double>"
    assert W.whitened(lspark.createDataFrame([], schema)).count() == 0
    assert W.whitened(lspark.createDataFrame([(1, [2.0, 3.0])] * 5 + [(2, [])], schema)).count() == 0  # no variance, no component
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.5]), (None, [2.0, 2.0]), (4, [1.0]), (5, [3.0]), (6, [])]
    got = W.whitened(lspark.createDataFrame(rows, schema)).collect()
    assert sorted((r.n, r.component) for r in got) == [(2, 1), (2, 1)] + [(3, 1)] * 3 + [(3, 2)] * 3
    huge = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [5e17, 4.0])]
    got = W.whitened(lspark.createDataFrame(huge, schema)).collect()
    assert len(got) == 6 and all(r.deviation is None and r.identity_error < 1e-9 for r in got)


def test_limbs():
    for v in (0, -1, 5, -(1 << 200), 3 ** 150, -(3 ** 90), (1 << 62) - 1, -(1 << 62), 1 << 62):
        assert sum(x << 32 * k for k, x in enumerate(W._limbs(v))) == v
        assert all(-(1 << 62) <= x < 1 << 62 for x in W._limbs(v))
