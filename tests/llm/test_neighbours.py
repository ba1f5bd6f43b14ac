"""Neighbours by inner product against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakegauge.llm import multiprobe
from lakegauge.llm.multiprobe import Directory, Hashing, nearest_neighbours
from lakegauge.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int"


def in_order(x, y):
    total = 0.0
    for a, b in zip(x, y, strict=True):
        total += a * b
    return total


def exact(rows, every=20, count=20):
    found = {}
    for key, x, _ in rows:
        if key % every == 0:
            others = [(-in_order(x, y), k) for k, y, _ in rows if k != key and len(x) == len(y)]
            found[key] = [(k, -s) for s, k in sorted(others)[:count]]
    return found


def by_query(frame):
    found = {}
    for r in frame.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert all([f[0] for f in rows] == list(range(1, len(rows) + 1)) for rows in found.values())
    return {q: [f[1:] for f in rows] for q, rows in found.items()}


def recall(found, wanted):
    shares = [len({k for k, _ in found.get(q, [])} & {k for k, _ in w}) / len(w) for q, w in wanted.items()]
    return sum(shares) / len(shares)


def vectors(number, size, seed, norms=False):
    """Clusters, lone vectors and copies, with 32-bit components."""
    source = np.random.default_rng(seed)
    centres = source.standard_normal((8, size))
    rows = []
    for key in range(number):
        vector = source.standard_normal(size)
        if key % 3 == 0:
            vector = centres[key % 8] + 0.2 * vector
        vector /= np.linalg.norm(vector) / (source.lognormal(0, 1.5) if norms else 1)
        rows.append((key, [float(v) for v in vector.astype("f4")], key % 5))
    return rows + [(number + k, rows[3][1], 0) for k in range(60)]


@pytest.mark.parametrize("norms", [False, True])
def test_recall(spark, norms, monkeypatch):
    rows = vectors(3000, 24, 4, norms)
    # Small groups, so that buckets of many rows are split.
    monkeypatch.setattr(multiprobe, "_GROUP_ROWS", (150, 150))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = by_query(nearest_neighbours(frame, F.col("vec_id") % 20 == 0))
    wanted = exact(rows)
    assert found.keys() == wanted.keys() and all(len(f) == 20 for f in found.values())
    assert recall(found, wanted) >= 0.9
    scores = {(q, k): s for q in wanted for k, y, _ in rows for s in [in_order(rows[q][1], y)] if q < 3000}
    assert all(scores[q, k] == s for q, f in found.items() if q < 3000 for k, s in f)
    assert all(f == sorted(f, key=lambda x: (-x[1], x[0])) and q not in {k for k, _ in f} for q, f in found.items())
    # Copies of a query are its nearest, the smallest keys first.
    copies = next(f for q, f in found.items() if q >= 3000)
    assert [k for k, _ in copies if k >= 3000 or k == 3][:1] == [3] or norms


@pytest.mark.parametrize("scale", ["0.001", "0.1"])
def test_recall_on_the_tables(spark, scale):
    folder = f"/root/testdata/sf{scale}"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    whole = np.array([r.embedding for r in rows], float)
    asked = np.arange(0, len(rows), 20)
    scores = whole[asked] @ whole.T
    scores[np.arange(len(asked)), asked] = -9
    wanted = {int(q): [(int(k), 0) for k in np.argsort(-s, kind="stable")[:20]] for q, s in zip(asked, scores, strict=True)}
    found = by_query(QUERIES["op13_multiprobe_neighbours"](spark, folder))
    assert all(len(f) == 20 for f in found.values()) and recall(found, wanted) >= 0.9


def test_fewer_rows_than_asked_for(spark):
    rows = [(k, [float(k % 7 - 3), 1.0, float(k % 3)], 0) for k in range(15)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert by_query(nearest_neighbours(frame, F.col("vec_id") % 2 == 0)) == exact(rows, every=2)


def test_estimates_are_probabilities():
    hashing = Hashing(16, 2.0, 4)
    source = np.random.default_rng(2)
    direction = source.standard_normal((1, 16))
    direction /= np.linalg.norm(direction)
    likely = hashing.success(direction, 0, np.array([0.7]))
    assert abs(likely.sum() - 1) < 1e-9
    # Candidates of that score, drawn over many projections, are as often in the query's likeliest bucket as estimated.
    hits = estimates = 0.0
    for seed in range(300):
        hashing.lines = np.random.default_rng(seed).standard_normal(hashing.lines.shape)
        away = source.standard_normal(16)
        away -= direction[0] * (away @ direction[0])
        candidate = 2 * (0.7 * direction + 0.5 * away / np.linalg.norm(away))
        likely = hashing.success(direction, 0, np.array([0.7]))[0]
        hits += hashing.buckets_of(candidate)[1][0, 0] % hashing.buckets == likely.argmax()
        estimates += likely.max()
    assert abs(hits - estimates) < 35


def test_large_buckets_are_spread():
    rows = np.array([0, 10, 1000, 5, 250, 90])
    directory, end = Directory.of(rows, 100, 7)
    assert directory.spread.tolist() == [1, 1, 10, 1, 3, 1]
    large = [set(range(directory.group[i], directory.group[i] + directory.spread[i])) for i in (2, 4)]
    assert not large[0] & large[1] and max(map(max, large)) == end - 1
    assert not (large[0] | large[1]) & set(directory.group[[1, 3, 5]].tolist()) and directory.group.min() == 7


def test_odd_vectors(spark):
    rows = [(0, None, 1), (20, [1.0, None], 1), (40, [1.0, NAN], 1), (60, [INF, 1.0], 1), (80, [], 2), (100, [0.0, 0.0], 1)]
    rows += [(None, [1.0, 2.0], 1), (120, [1.0, 2.0], 1), (120, [1.0, 2.0], 1), (140, [2.0, 1.0], 1), (140, [3.0, 0.0], 1)]
    rows += [(1, [1.0, 2.0], 2), (2, [-1.0, -1.0], 3), (160, [1.0, 1.0, 1.0], 1), (180, [5.0], 1), (3, [0.5, 0.5, -9.0], 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    frame = frame.selectExpr("*", "1 AS key", "2 AS `rank`", "3 AS score", "4 AS digest", "5 AS vector", "6 AS query")
    found = nearest_neighbours(frame, F.col("vec_id") % 20 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    lists = {}
    for r in found.collect():
        lists.setdefault(r.query_id, []).append((r.score, r.vec_id))
    # Rows repeating a key with other vectors are rows of their own and find each other.
    assert sorted(lists[120]) == [(-3.0, 2), (3.0, 140), (4.0, 140), (5.0, 1)]
    first, second = [(6.0, 140), (4.0, 1), (4.0, 120), (-3.0, 2)], [(6.0, 140), (3.0, 1), (3.0, 120), (-3.0, 2)]
    assert sorted(lists[140]) == sorted(first + second)
    assert lists[160] == [(-8.0, 3)] and lists.keys() == {120, 140, 160}
    assert nearest_neighbours(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
