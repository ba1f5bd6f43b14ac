"""Codes of vectors against the nearest entry of all."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from lakegauge.llm.orchard import Neighbours, edges, vector_codes
from lakegauge.llm.queries import ORACLES, QUERIES
from oracle import differences

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """``key -> (code, error)`` and the digest, of rows of one dimension, by measuring all entries."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))
    whole = np.floor(256 * np.array([r[1] for r in rows], float)).astype(int)
    cuts = edges(whole.shape[1], parts)
    pieces = [whole[:, a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    books = [p[:entries].copy() for p in pieces]

    def assign():
        apart = [((p[:, None] - b[None]) ** 2).sum(axis=2) for p, b in zip(pieces, books, strict=True)]
        return [a.argmin(axis=1) for a in apart], sum(a.min(axis=1) for a in apart)

    for _ in range(rounds):
        for piece, book, code in zip(pieces, books, assign()[0], strict=True):
            for e in set(code.tolist()):
                book[e] = piece[code == e].sum(axis=0) // (code == e).sum()
    codes, errors = assign()
    texts = [bytes(row.tolist()).hex() for row in np.stack(codes, axis=1)]
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    return [(r[0], t, e) for r, t, e in zip(rows, texts, errors.tolist(), strict=True)], digest


@pytest.mark.parametrize("seed", range(4))
def test_orchard_search_is_exact(seed):
    """Ties, repeated entries and far points included."""
    source = np.random.default_rng(seed)
    entries = source.integers(-4, 5, (64, 3))
    points = np.concatenate([source.integers(-6, 7, (3000, 3)), source.integers(-10_000, 10_000, (500, 3)), entries])
    apart = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    found, distance = Neighbours(entries).nearest(points)
    assert (found == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_search_skips_entries():
    """Well apart entries are hardly measured: the walk ends by the triangle inequality."""
    entries = np.arange(64)[:, None] * 1000
    lists = Neighbours(entries)
    assert (lists.ends_at[:, 1] >= 100**2).all()
    points = entries + np.random.default_rng(1).integers(-100, 100, entries.shape)
    assert (lists.nearest(points)[0] == np.arange(64)).all()


def test_codes(spark):
    source = np.random.default_rng(3)
    rows = [(int(k), source.standard_normal(32).round(2).tolist(), int(k) % 3 or None) for k in source.permutation(900)]
    rows += [(1000 + k, rows[k][1], 1) for k in range(50)]
    found = vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    wanted, digest = plain(rows)
    assert sorted((r.vec_id, r.code, r.error) for r in found) == sorted(wanted)
    assert {r.codebooks_sha256 for r in found} == {digest}
    labels, errors = {r[0]: r[2] for r in rows}, {k: e for k, _, e in wanted}
    totals = {}
    for k, label in labels.items():
        totals[label] = totals.get(label, 0) + errors[k]
    assert all(r.label_error == totals[labels[r.vec_id]] for r in found)


def test_odd_vectors(spark):
    rows = [(1, None, 1), (2, [1.0, None], 1), (3, [1.0, NAN], 1), (4, [INF, 1.0], 1), (5, [], 2), (None, [1.0, 2.0], None)]
    rows += [(6, [1.0, 2.0], None), (6, [1.0, 2.0], None), (7, [0.5, -0.001], 1), (8, [0.1] * 20, 1), (9, [-3.0] * 20, 1)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "'x' AS code", "2 AS error", "3 AS __label")
    found = vector_codes(frame)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    found = sorted(((r.vec_id, r.code, r.error, r.label_error) for r in found.collect()), key=repr)
    short = [r for r in rows if r[1] and len(r[1]) == 2 and r[0] not in (2, 3, 4)]
    wide = [r for r in rows if r[1] and len(r[1]) == 20]
    wanted = [*plain(short)[0], *plain(wide)[0], (5, "00" * 16, 0)]
    assert [f[:3] for f in found] == sorted(wanted, key=repr)
    assert all(f[3] == 0 for f in found)
    nothing = vector_codes(spark.createDataFrame([], SCHEMA))
    assert nothing.count() == 0
    with pytest.raises(Exception, match="cannot be coded"):
        vector_codes(spark.createDataFrame([(1, [1e9], 1)], SCHEMA)).collect()


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_query_equals_its_sql(spark, scale):
    name = "op11_orchard_codes"
    assert not differences(spark, f"/root/testdata/sf{scale}", QUERIES[name], ORACLES[name])
