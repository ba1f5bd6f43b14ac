"""Packing: every piece once, no bin too full, and bins no larger than their contents need."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakegauge.llm.packing import CAPACITIES, Cost, opening_sets, pack, pack_block


def check(rows, lengths, capacities):
    pieces, bins = defaultdict(list), defaultdict(list)
    for row in rows:
        if row.bin_id is None:
            assert row.piece_length == 0
        else:
            pieces[row.doc_id].append((row.piece, row.piece_start, row.piece_length))
            bins[row.bin_id].append(row)
    for key, length in lengths.items():
        ordered = sorted(pieces.get(key, []))
        assert sum(p[2] for p in ordered) == (length or 0)
        assert [p[1] for p in ordered] == [max(capacities) * i for i in range(len(ordered))]
    for held in bins.values():
        held.sort(key=lambda r: r.bin_offset)
        assert held[0].bin_offset == 0
        assert all(a.bin_offset + a.piece_length == b.bin_offset for a, b in zip(held, held[1:]))
        used = held[-1].bin_offset + held[-1].piece_length
        assert held[0].bin_capacity == min(c for c in capacities if c >= used)
    return bins


@pytest.mark.parametrize("block_pieces", [7, 10_000])
def test_pack(spark, block_pieces):
    source = random.Random(3)
    lengths = {i: source.choice([0, None, 1, 9, 500, 4096, 20_000, source.randint(1, 3000)]) for i in range(300)}
    frame = spark.createDataFrame(list(lengths.items()), "doc_id long, size int")
    rows = pack(frame, F.col("size"), block_pieces=block_pieces).collect()
    check(rows, lengths, CAPACITIES)
    assert {r.doc_id for r in rows} == set(lengths)
    assert sorted(rows) == sorted(pack(frame, F.col("size"), block_pieces=block_pieces).collect())


def test_best_fit_fills_well():
    source = random.Random(5)
    lengths = sorted((source.randint(1, 3000) for _ in range(5000)), reverse=True)
    placed, sizes, total = pack_block(lengths)
    assert sum(lengths) / sum(sizes) > 0.97
    only_largest = Cost().of(4096) * -(-sum(lengths) // 4096)
    assert total < 1.05 * only_largest


def test_cheapest_trial_stays():
    # With a steep price for length, small bins must win; with a high fixed one, large bins.
    lengths = [100] * 64
    assert set(pack_block(lengths, (512, 4096), Cost(1, 512))[1]) == {512}
    assert max(pack_block(lengths, (512, 4096), Cost(10_000, 1e9))[1]) == 4096


def least_cost(lengths, capacities, cost):
    """The cheapest packing there is, by trying every way to share the pieces among bins."""
    best = [float("inf")]

    def place(at, bins):
        if at == len(lengths):
            best[0] = min(best[0], sum(cost.of(min(c for c in capacities if c >= b)) for b in bins))
            return
        for i in range(len(bins)):
            if bins[i] + lengths[at] <= max(capacities):
                place(at + 1, [*bins[:i], bins[i] + lengths[at], *bins[i + 1 :]])
        place(at + 1, [*bins, lengths[at]])

    place(0, [])
    return best[0]


def test_blocks_against_all_packings():
    source, ratios = random.Random(11), []
    for _ in range(150):
        cost = Cost(source.choice([1, 16, 300]), source.choice([1_000, 65_536, 1e7]))
        # Some blocks hold a piece of the largest length, as blocks of real documents do.
        lengths = [source.choice([4096, 2500, 30]), *(source.randint(1, 1500) for _ in range(source.randint(0, 6)))]
        lengths.sort(reverse=True)
        placed, sizes, total = pack_block(lengths, CAPACITIES, cost)
        filled = [sum(n for n, b in zip(lengths, placed) if b == at) for at in range(len(sizes))]
        assert sizes == [min(c for c in CAPACITIES if c >= used) for used in filled]
        assert total == pytest.approx(sum(map(cost.of, sizes)))
        ratios.append(total / least_cost(lengths, CAPACITIES, cost))
    assert min(ratios) > 1 - 1e-9
    assert sum(ratios) / len(ratios) < 1.02 and sum(r < 1 + 1e-9 for r in ratios) > 0.75 * len(ratios)


def test_long_pieces_leave_the_trials_open():
    assert len(opening_sets(CAPACITIES)) == 12
    small = [300] * 200
    for most in (512, 4096):
        cost = Cost(1, 512) if most == 512 else Cost(10_000, 1e9)
        placed, sizes, _ = pack_block([4096, *small], CAPACITIES, cost)
        assert sizes[0] == 4096 and max(sizes[1:]) == most


def test_ties_and_repeated_rows(spark):
    frame = spark.createDataFrame([(1, 10, 5)] * 3 + [(None, 10, 5)], "doc_id long, size int, bin_id int")
    rows = pack(frame, F.col("size")).collect()
    assert len(rows) == 4 and {(r.bin_id, r.bin_capacity) for r in rows} == {(0, 512)}
    assert sorted(r.bin_offset for r in rows) == [0, 10, 20, 30]


def test_no_documents(no_documents):
    frame = pack(no_documents, F.length("text"))
    assert frame.count() == 0
    assert frame.columns[:2] == ["doc_id", "piece"]
