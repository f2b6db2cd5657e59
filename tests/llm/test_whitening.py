"""Whitening: exact parts against integers and fractions, the rest against a dense eigensolver."""

from __future__ import annotations

import decimal
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltmart.llm import whitening as w
from voltmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>"


def plain_polynomial(m):
    """Faddeev and Le Verrier in integers, constant first."""
    d = len(m)
    c, k = [1], np.zeros((d, d), object)
    for i in range(1, d + 1):
        k = m.dot(k) + c[-1] * np.eye(d, dtype=int).astype(object)
        c.append(-int(np.trace(m.dot(k))) // i)
    return c[::-1]


def positive(rows, seed):
    a = np.random.default_rng(seed).integers(-(10**6), 10**6, (rows, rows)).astype(object)
    return a.dot(a.T)


@pytest.mark.parametrize("d", [1, 2, 3, 8, 20])
def test_polynomial_is_exact(spark, d):
    m = positive(d, d)
    assert w.characteristic_polynomial(spark, m) == plain_polynomial(m)


def test_polynomial_of_special_matrices(spark):
    eye = np.eye(6, dtype=int).astype(object)
    for m in (eye * 0, eye * 7, np.ones((6, 6), int).astype(object), np.diag([1, 0, 5, 5, 0, 9]).astype(object)):
        assert w.characteristic_polynomial(spark, m) == plain_polynomial(m)


def poly_of(roots):
    c = [1]
    for r in roots:
        c = [(c[i - 1] if i else 0) - (c[i] * r if i < len(c) else 0) for i in range(len(c) + 1)]
    return c


def test_roots_and_multiplicities():
    roots = [0, 0, 1, 3, 3, 3, 10**6, 10**6 + 1, 2**70, 2**70]
    poly = poly_of(roots)
    for at in (0, 1, 2, 3, 10**6, 2**70 - 1, 2**70):
        assert w.roots_beyond(poly, w.Dyadic(at, 0)) == sum(r > at for r in roots)
    brackets = w.isolated(poly, sum(roots), 100)
    found = [(b.times, w.refined(poly, b)) for b in brackets]
    assert [t for t, _ in found] == [2, 1, 1, 3, 1]
    for (_, got), want in zip(found, (2**70, 10**6 + 1, 10**6, 3, 1)):
        assert abs(got / want - 1) < decimal.Decimal(10) ** -45
    assert [b.times for b in w.isolated(poly, sum(roots), 3)] == [2, 1]


def test_products_are_exact_at_any_size():
    rng = np.random.default_rng(1)
    for reach in (10, 2**30, 2**61):
        y = rng.integers(-reach, reach, (700, 3))
        assert (w.exact_products(y) == y.T.astype(object).dot(y.astype(object))).all()


def test_primes():
    sieve = [n for n in range(2000) if n > 1 and all(n % k for k in range(2, math.isqrt(n) + 1))]
    assert [n for n in range(2000) if w.is_prime(n)] == sieve
    assert not any(w.is_prime(n) for n in (2047, 25326001, 1373653, 46337 * 46337)) and w.is_prime(2**31 - 1)
    primes = w.primes_for(10**40)
    assert math.prod(primes) > 2 * 10**40 and primes == sorted(set(primes), reverse=True)


def frame(spark, vectors, first=0):
    df = spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(vectors, first)], VECTORS)
    for name in ("y", "v", "d", "component", "n", "k"):
        df = df.withColumn(name, F.lit("?"))
    return df


def check(spark, df, kept, components=32):
    """Result rows against exact integers and a dense eigensolver; ``kept`` are the vectors that stay, by id."""
    rows = w.whitening(df, components).collect()
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in kept], object)
    n, s = len(x), x.sum(0)
    centred = n * x - s
    m = centred.T.dot(centred)
    v = (m / (n**3)).astype(float)
    e = np.linalg.eigvalsh(v)[::-1]
    count = min(components, sum(1 for b in range(len(e)) if e[b] > e[0] * 1e-12))
    assert len(rows) == n * count and {r.n for r in rows} == {n}
    table = {}
    for r in rows:
        table.setdefault(r.component, []).append(r)
    assert sorted(table) == list(range(1, count + 1))
    assert sorted(r.deviation for r in table[1]) == sorted(int((row**2).sum()) for row in centred)
    share = e[:count] / e.sum()
    assert np.allclose([table[k + 1][0].explained for k in range(count)], share, rtol=1e-9)
    z = np.array([[r.whitened for r in sorted(table[k], key=lambda r: r.vec_id)] for k in table])
    assert np.abs(z @ z.T / n - np.eye(count)).max() < 1e-9
    assert max(r.identity_error for r in rows) < 1e-9
    # Each whitened row is the centred data projected on an eigenvector.
    back = np.linalg.lstsq((centred / n).astype(float), z.T, rcond=None)[0] * np.sqrt(e[:count])
    assert np.allclose(v @ back, back * e[:count], atol=1e-8 * e[0])
    return rows


def test_against_dense_eigensolver(spark):
    v = np.random.default_rng(3).normal(size=(300, 12)) * np.arange(1, 13)
    check(spark, frame(spark, v.tolist()), v.tolist())
    check(spark, frame(spark, v.tolist()), v.tolist(), components=5)


def test_rows_that_go(spark):
    v = np.random.default_rng(4).normal(size=(60, 3)).tolist()
    odd = [None, [], [1.0, None, 2.0], [float("nan"), 0, 0], [0, float("inf"), 0], [1e300, 0, 0], [1.0, 2.0], [1.0]]
    both = frame(spark, odd, 1000).union(frame(spark, v)).union(frame(spark, v[:5]))
    check(spark, both, [v[i] for i in sorted([*range(60), *range(5)])])


def test_equal_and_missing_variances(spark):
    eye = [[float(i == k) for i in range(4)] + [3.0] for k in range(4)]
    rows = w.whitening(frame(spark, eye)).collect()
    assert len(rows) == 4 * 3  # the sum of the four and the fifth never vary
    assert max(r.identity_error for r in rows) < 1e-12
    assert all(abs(r.explained - 1 / 3) < 1e-15 for r in rows)


def test_no_variance_no_rows(spark):
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, []]):
        out = w.whitening(frame(spark, vectors))
        assert out.count() == 0
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_close_roots_are_told_apart(spark):
    """Roots that agree to 20 digits and a basis known exactly: a dense solver mixes their vectors."""
    v = np.array([1, 2, 3, 4, 5], object)
    size = int(v.dot(v))
    basis = size * np.eye(5, dtype=int).astype(object) - 2 * np.outer(v, v)  # orthogonal, of norm ``size``
    wanted = [10**20 + 1, 10**20, 10**10, 7, 0]
    m = sum(value * np.outer(u, u) for value, u in zip(wanted, basis))
    values, vectors = w.spectrum(spark, m, 5)
    assert values == [float(value * size**2) for value in wanted[:4]]
    for got, u in zip(vectors, basis):
        exact = (u / size).astype(float)
        assert min(np.abs(got - exact).max(), np.abs(got + exact).max()) < 1e-15


def test_large_values_have_null_deviation(spark):
    v = [[1e15 * i, 2e14 * i * i] for i in range(20)]
    rows = w.whitening(frame(spark, v)).collect()
    assert rows and all(r.deviation is None for r in rows if r.vec_id == 19)


def test_query(spark):
    rows = QUERIES["op13_whitening"](spark, SF).collect()
    vectors = [r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert len(rows) == 32 * len(vectors) and rows[0].identity_error < 1e-10
