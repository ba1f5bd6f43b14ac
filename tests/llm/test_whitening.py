"""Exact principal components against plain linear algebra."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from lakegauge.llm.queries import QUERIES
from lakegauge.llm.whitening import (
    Roots,
    _bits,
    _joined,
    component,
    polynomial_modulo,
    primes,
    whitened_components,
)

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int"


def exact_polynomial(matrix):
    """Faddeev and Leverrier, in fractions; that of ``x**0`` first."""
    size = len(matrix)
    a = [[Fraction(v) for v in row] for row in matrix]
    coefficients, b = [Fraction(1)], [[Fraction(i == j) for j in range(size)] for i in range(size)]
    for k in range(1, size + 1):
        b = [[sum(a[i][t] * b[t][j] for t in range(size)) for j in range(size)] for i in range(size)]
        coefficients.append(-sum(b[i][i] for i in range(size)) / k)
        b = [[b[i][j] + (coefficients[-1] if i == j else 0) for j in range(size)] for i in range(size)]
    return [int(c) for c in coefficients[::-1]]


def polynomial(matrix):
    size, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    found = {}
    for p in primes(_bits(size, trace)):
        found[p] = polynomial_modulo(np.array([[v % p for v in row] for row in matrix], np.int64), p)
    return _joined(found)


def scatter(size, rank, seed, most=1000):
    rows = np.random.default_rng(seed).integers(-most, most, (rank, size)).astype(object)
    return (rows.T @ rows).tolist()


@pytest.mark.parametrize("size,rank", [(1, 1), (2, 2), (5, 3), (8, 8), (12, 5), (6, 0)])
def test_polynomial_is_exact(size, rank):
    matrix = scatter(size, rank, size) if rank else [[0] * size for _ in range(size)]
    assert polynomial(matrix) == exact_polynomial(matrix)


def test_polynomial_with_large_entries():
    matrix = scatter(7, 7, 3, most=10**15)
    assert polynomial(matrix) == exact_polynomial(matrix)


def test_roots_and_components():
    """Repeated, tiny and zero roots of a matrix made from known ones."""
    matrix = np.zeros((6, 6), object)
    # Blocks with the roots 4, 2; 4, 2; 10**12; 0.
    for at in (0, 2):
        matrix[at : at + 2, at : at + 2] = [[3, 1], [1, 3]]
    matrix[4, 4] = 10**12
    matrix = matrix.tolist()
    roots = Roots(polynomial(matrix), 10**12 + 12)
    found = [roots.largest(k) for k in range(1, 7)]
    assert [f and round(f[0] / (1 << roots.shift)) for f in found] == [10**12, 4, 4, 2, 2, None]
    assert [f and f[1] for f in found] == [0, 0, 1, 0, 1, None]
    vectors = np.array([[int(v) / (1 << 200) for v in component(matrix, *f, roots.shift)] for f in found[:5]])
    assert np.abs(vectors @ vectors.T - np.eye(5)).max() < 1e-15
    values = np.array([10**12, 4, 4, 2, 2], float)
    assert np.abs(vectors @ np.array(matrix, float) - values[:, None] * vectors).max() < 1e-3
    assert np.abs((vectors @ np.array(matrix, float) - values[:, None] * vectors)[1:]).max() < 1e-14


def test_close_roots():
    """Roots that differ in the 13th digit still get their own components."""
    matrix = [[10**13 + 1, 0, 0], [0, 10**13, 0], [0, 0, 5]]
    roots = Roots(polynomial(matrix), 2 * 10**13 + 6)
    for k in range(3):
        root, before = roots.largest(k + 1)
        assert Fraction(root, 1 << roots.shift) == [10**13 + 1, 10**13, 5][k] and before == 0
        vector = [int(v) / (1 << 200) for v in component(matrix, root, before, roots.shift)]
        assert np.abs(np.array(vector) - np.eye(3)[k]).max() < 1e-30


def check(rows, found, components=32):
    keys = [r[0] for r in rows]
    whole = np.floor(64 * np.array([r[1] for r in rows], float)).astype(int) + 1_000_000
    n, size = whole.shape
    centred = whole - whole.mean(axis=0)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(components, size)
    by_key = {}
    for r in found:
        by_key.setdefault(r.vec_id, {})[r.component] = r
    assert len(found) == n * count and {r.n for r in found} == {n}
    deviation = ((n * whole.astype(object) - whole.sum(axis=0).astype(object)) ** 2).sum(axis=1)
    assert [by_key[k][1].deviation for k in keys] == [v if v < 1 << 63 else None for v in deviation.tolist()]
    mine = np.array([[by_key[k][c + 1].whitened for c in range(count)] for k in keys])
    wanted = centred @ vectors[:, :count] / np.sqrt(values[:count])
    wanted *= np.sign((mine * wanted).sum(axis=0))
    assert np.abs(mine - wanted).max() < 1e-6
    assert np.abs(np.cov(mine.T, bias=True) - np.eye(count)).max() < 1e-9
    shares = [by_key[keys[0]][c + 1].explained for c in range(count)]
    assert np.allclose(shares, values[:count] / values.sum(), rtol=1e-9)
    assert all(r.identity_error < 1e-9 for r in found)


def test_whitened(spark):
    source = np.random.default_rng(5)
    mixing = source.standard_normal((40, 40)) * np.logspace(0, -2, 40)
    rows = [(k, (source.standard_normal(40) @ mixing * 5 + 3).tolist(), 1) for k in range(700)]
    found = whitened_components(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    check(rows, found)
    narrow = [(k, v[:3], 1) for k, v, _ in rows]
    check(narrow, whitened_components(spark.createDataFrame(narrow, SCHEMA)).collect())


def test_query_on_the_tables(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check([tuple(r) for r in frame.collect()], QUERIES["op12_exact_whitening"](spark, "/root/testdata/sf0.001").collect())


def test_odd_vectors(spark):
    """Constant components, one vector, equal vectors, dropped rows, two dimensions and clashing names."""
    rows = [(1, None, 1), (2, [1.0, None], 1), (3, [1.0, NAN], 1), (4, [INF, 1.0], 1), (5, [], 2), (6, [7.0], 1)]
    rows += [(None, [1.0, 2.0, 5.0], 1), (7, [1.0, 2.0, 5.0], 1), (7, [2.0, 2.0, 6.0], 1), (8, [4.0, 2.0, 8.0], 1)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "2 AS n", "3 AS component", "4 AS vector")
    found = whitened_components(frame)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = found.collect()
    single = [r for r in found if r.vec_id == 6]
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in single] == [
        (1, 1, 0, None, None, None)
    ]
    wide = [r for r in found if r.vec_id != 6]
    # The second component is constant, and the third follows the first.
    assert len(wide) == 12 and {r.n for r in wide} == {4}
    assert all((r.whitened is None) == (r.component > 1) for r in wide)
    assert all(r.identity_error < 1e-12 and r.explained == (r.component == 1) for r in wide)
    first = sorted(r.whitened for r in wide if r.component == 1)
    assert abs(sum(first)) < 1e-12 and abs(sum(v * v for v in first) - 4) < 1e-12
    assert whitened_components(spark.createDataFrame([], SCHEMA)).count() == 0
    large = [(k, [k * 1e6, -k * 2e6], 1) for k in range(9)]
    check(large, whitened_components(spark.createDataFrame(large, SCHEMA), components=1).collect(), 1)
