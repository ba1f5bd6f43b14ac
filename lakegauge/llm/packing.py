"""Best-fit packing of documents into training sequences of several permitted lengths.

A document longer than the largest length is cut into pieces of that length and a rest. Pieces are
dealt at random to blocks of bounded size, each packed on its own: longest piece first, each into the
fullest bin it still fits. Where none is open that can take it, a bin is opened of the length that
costs least per unit it can be filled with. Every set of at most two lengths, and of the smallest few, is tried
for opening, whatever lengths the block's pieces have: a piece that fits none of a set opens the smallest permitted
length it fits. Bins are cut down to the smallest length holding their contents, and the cheapest trial stays.

The cost of a bin of length ``c`` is ``fixed + c + c * c / square``: a share for every bin, for its
units, and for attention over them.

Edge cases: a document of length 0 or null takes no room and gets one row with null bin columns;
repeated rows are packed one by one; ties of length go by key, piece and row; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakegauge.llm.columns import stored

CAPACITIES = (512, 1024, 2048, 4096)
BLOCK_PIECES = 20_000


@dataclass(frozen=True)
class Cost:
    """What a bin of a length costs, in units of one word."""

    fixed: float = 16.0
    square: float = 65_536.0

    def of(self, capacity: int) -> float:
        return self.fixed + capacity + capacity * capacity / self.square


def _opened(
    lengths: Sequence[int], opening: Sequence[int], sizes: Sequence[int], cost: Cost
) -> tuple[list[int], list[int]]:
    """Bin of each piece (``lengths`` falling) and length of each bin as opened, by best fit.

    Bins open at a length of ``opening``, or for pieces beyond these at the smallest of ``sizes`` that holds them.
    """
    rest = sum(lengths)
    space: list[tuple[int, int]] = []
    bins: list[int] = []
    placed: list[int] = []
    for length in lengths:
        at = bisect_left(space, (length, -1))
        if at < len(space):
            room, number = space.pop(at)
        else:
            fitting = [c for c in opening if c >= length] or [sizes[bisect_left(sizes, length)]]
            room = min(fitting, key=lambda c: (cost.of(c) / min(c, rest), -c))
            number = len(bins)
            bins.append(room)
        placed.append(number)
        rest -= length
        if room > length:
            insort(space, (room - length, number))
    return placed, bins


def opening_sets(sizes: Sequence[int]) -> list[tuple[int, ...]]:
    """The sets of lengths tried for opening: those of one or two lengths, and the smallest few."""
    few = [tuple(sizes[:most]) for most in range(3, len(sizes) + 1)]
    return [*combinations(sizes, 1), *combinations(sizes, 2), *few]


def pack_block(
    lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, cost: Cost = Cost()
) -> tuple[list[int], list[int], float]:
    """Bin of each piece (``lengths`` falling), length of each bin, and what the bins cost."""
    sizes = sorted(set(capacities))
    best: tuple[list[int], list[int], float] | None = None
    for opening in opening_sets(sizes):
        placed, bins = _opened(lengths, opening, sizes, cost)
        used = np.bincount(placed, lengths, len(bins)) if placed else np.zeros(0)
        final = [sizes[bisect_left(sizes, int(u))] for u in used]
        total = sum(map(cost.of, final))
        if best is None or total < best[2]:
            best = placed, final, total
    return best or ([], [], 0.0)


def pack(
    documents: DataFrame,
    length: Column,
    *,
    key: str = "doc_id",
    capacities: Sequence[int] = CAPACITIES,
    cost: Cost = Cost(),
    block_pieces: int = BLOCK_PIECES,
) -> DataFrame:
    """One row per piece: ``key``, ``piece``, ``piece_start``, ``piece_length``, ``bin_id``, ``bin_capacity``
    and ``bin_offset``, the place of the piece in its bin.

    ``length`` is computed once and stored, so blocks are the same whenever a task is run again.
    """
    largest = max(capacities)
    sized = documents.select(
        F.col(key).alias("key"), F.coalesce(length.cast("long"), F.lit(0).cast("long")).alias("length")
    )
    sized = stored(sized.withColumn("row", F.monotonically_increasing_id()), "pack-lengths")
    pieces = sized.where("length > 0").select(
        "key",
        "row",
        "length",
        F.explode(F.expr(f"sequence(0L, (length - 1) DIV {largest})")).alias("piece"),
    )
    pieces = pieces.select(
        "key",
        "row",
        "piece",
        (F.col("piece") * largest).alias("piece_start"),
        F.least(F.col("length") - F.col("piece") * largest, F.lit(largest)).alias("piece_length"),
    )
    count = sized.agg(F.sum(F.expr(f"(length + {largest - 1}) DIV {largest}"))).first()[0] or 0
    blocks = max(1, -(-count // block_pieces))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("row", "piece"), F.lit(blocks)))

    columns = ["key", "piece", "piece_start", "piece_length"]
    added = "bin_id long, bin_capacity long, bin_offset long"
    schema = StructType([*pieces.select(*columns).schema.fields, *StructType.fromDDL(added).fields])

    def packed(block: pa.Table) -> pa.Table:
        falling = [("piece_length", "descending"), ("key", "ascending"), ("piece", "ascending"), ("row", "ascending")]
        block = block.sort_by(falling)
        lengths = block["piece_length"].to_numpy()
        placed, sizes, _ = pack_block(lengths.tolist(), capacities, cost)
        bins = np.array(placed, np.int64)
        order = np.argsort(bins, kind="stable")
        filled = np.cumsum(lengths[order]) - lengths[order]
        starts = np.searchsorted(bins[order], np.arange(len(sizes)))
        offsets = np.empty(len(bins), np.int64)
        offsets[order] = filled - filled[starts][bins[order]]
        numbers = (block["block"][0].as_py() << 32) + bins
        added = (numbers, np.array(sizes, np.int64)[bins], offsets)
        arrays = [*block.select(columns).columns, *map(pa.array, added)]
        return pa.Table.from_arrays(arrays, names=schema.names)

    result = dealt.groupBy("block").applyInArrow(packed, schema)
    nothing = F.lit(None).cast("long")
    empty = sized.where("length = 0").select(
        "key",
        F.lit(0).cast("long").alias("piece"),
        F.lit(0).cast("long").alias("piece_start"),
        F.lit(0).cast("long").alias("piece_length"),
        *(nothing.alias(name) for name in ("bin_id", "bin_capacity", "bin_offset")),
    )
    return result.unionByName(empty).withColumnRenamed("key", key)
