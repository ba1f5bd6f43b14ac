"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from lakegauge.llm.components import components
from lakegauge.llm.itq import codes, learn_rotation, near_vectors
from llm.conftest import SF_DIR


def classes(edges, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def all_pairs(rows, threshold):
    usable = []
    for key, vector, label in rows:
        good = vector and label is not None and all(v is not None and math.isfinite(v) for v in vector) and any(vector)
        if good:
            usable.append((key, np.array(vector, float) / np.linalg.norm(np.array(vector, float)), label))
    links = set()
    for i, (a, x, label) in enumerate(usable):
        for b, y, other in usable[:i]:
            if label == other and len(x) == len(y) and x @ y >= threshold:
                links.add((min(a, b), max(a, b)))
    return links


def made_up():
    """Families of near copies, exact copies, a crowd and lone vectors, over two labels."""
    source = np.random.default_rng(8)
    rows, key = [], 0
    for size, spread in ((2, 0.01), (3, 0.02), (40, 0.015), (5, 0.03), (300, 0.012)):
        for label in (0, 1):
            centre = source.standard_normal(64)
            for _ in range(size):
                rows.append((key, (centre + spread * 8 * source.standard_normal(64)).astype("f4").tolist(), label))
                key += 1
    for _ in range(400):
        rows.append((key, source.standard_normal(64).astype("f4").tolist(), int(source.integers(0, 2))))
        key += 1
    for _ in range(60):
        rows.append((key, rows[0][1], 0))
        key += 1
    return rows


def test_links_and_components(spark):
    rows = made_up()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    wanted = all_pairs(rows, 0.98)
    degree = {key: 0 for key, _, _ in rows}
    for a, b in wanted:
        degree[a] += 1
        degree[b] += 1
    whole = classes(wanted, degree)
    # Also in small blocks, so that crowds are cut.
    for found in (near_vectors(frame).collect(), near_vectors(frame, block_vectors=64).collect()):
        assert len(found) == len(rows)
        assert all(r.n_links <= degree[r.vec_id] for r in found)
        assert sum(r.n_links for r in found) >= 0.98 * sum(degree.values()) > 0
        # What is called one component is one, and nearly all that is one is found.
        assert all(whole[r.vec_id] == whole[r.component_id] and r.component_id <= r.vec_id for r in found)
        assert sum(r.component_id == whole[r.vec_id] for r in found) >= 0.98 * len(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def turned(vectors, cosine, source):
    """Vectors at the given cosine to the unit ``vectors``."""
    other = source.standard_normal(vectors.shape)
    other -= (other * vectors).sum(axis=1, keepdims=True) * vectors
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    return cosine * vectors + math.sqrt(1 - cosine**2) * other


@pytest.mark.parametrize("size", [200, 5000])
def test_recall_does_not_depend_on_the_size_of_a_label(spark, size):
    """Every vector of one label has one other hardly beyond the threshold from it, in two labels of the same vectors."""
    source = np.random.default_rng(size)
    half = source.standard_normal((size // 2, 64))
    half /= np.linalg.norm(half, axis=1, keepdims=True)
    vectors = np.concatenate([half, turned(half, 0.9801, source)])
    rows = [(i + label * size, v.tolist(), label) for label in (0, 1) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r for r in near_vectors(frame).collect()}
    linked = [i for i in range(2 * size) if i % size >= size // 2 and found[i].component_id == i - size // 2]
    assert len(found) == 2 * size and len(linked) >= 0.95 * size
    assert sum(r.n_links for r in found.values()) == 2 * len(linked)


def test_recall_on_the_tables(spark):
    """The vectors of a table and, as none of them are near, two turned from each: at the threshold, and nearer."""
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    given = np.array([v for _, v, _ in rows], float)
    units = given / np.linalg.norm(given, axis=1, keepdims=True)
    source = np.random.default_rng(5)
    for at, cosine in ((1, 0.9805), (2, 0.99)):
        near = turned(units, cosine, source)
        rows += [(k + at * 10**6, v.tolist(), label) for (k, _, label), v in zip(rows[: len(given)], near)]
    schema = "vec_id long, embedding array<double>, label int"
    links = all_pairs(rows, 0.98)
    found = near_vectors(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == len(rows) and len(links) >= 2 * len(given)
    assert 0.95 * 2 * len(links) <= sum(r.n_links for r in found) <= 2 * len(links)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, nan], 1), (6, [inf, 1.0], 1),
        (7, [1.0, 2.0], None), (8, [1.0, 2.0], 1), (9, [2.0, 4.0], 1), (9, [2.0, 4.0], 1), (None, [1.0, 2.0], 1),
        (10, [1.0, 2.0, 0.0], 1), (11, [1.0, 2.0], 2),
    ]
    schema = "vec_id long, embedding array<double>, label int"
    frame = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS key", "2 AS rep", "3 AS code", "4 AS kept")
    found = [tuple(r) for r in near_vectors(frame).collect()]
    alone = [(k, 0, k, True) for k in (1, 2, 3, 4, 5, 6, 7, 10, 11)]
    linked = [(8, 2, 8, True), (9, 2, 8, False), (9, 2, 8, False)]
    assert sorted(found, key=repr) == sorted([*alone, *linked, (None, 0, None, True)], key=repr)
    nothing = near_vectors(spark.createDataFrame([], schema))
    assert nothing.columns == ["vec_id", "n_links", "component_id", "kept"] and nothing.count() == 0


def test_codes_are_balanced():
    vectors = np.random.default_rng(1).standard_normal((2000, 64)) + 3
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    found = codes(vectors, learn_rotation(vectors))
    bits = (found[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    assert np.all(np.abs(bits.mean(axis=0) - 0.5) < 0.1)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    source = np.random.default_rng(seed)
    edges = [tuple(map(int, e)) for e in source.integers(0, 300, (260, 2))]
    edges += [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    wanted = classes(edges, {n for e in edges for n in e})
    found = components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()
    assert {r.node: r.component for r in found} == {n: c for n, c in wanted.items() if n != c}
