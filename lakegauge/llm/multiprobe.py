"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Inner products become distances: a vector gets one more component that brings it to the largest norm of its
band, and a query gets a zero there. A table hashes a vector to the intervals that a few Gaussian projections
of it fall in, three intervals a projection, shifted at random. For a candidate of a given score a projection
is normal around the score's share of the query's own, so the probability that a perturbed bucket holds it is a
product over the projections. Buckets are visited in falling order of this estimate.

There are two visits. The first takes buckets up to ``FIRST`` rows a table, by the sizes counted beforehand;
the worst of the scores found is a lower bound of the last neighbour's. The second goes on until buckets
hold a candidate of that score with probability ``SUCCESS`` over all tables, and hands on only what reaches
the bound. So the estimate adapts to each query, at any size of table: neighbours that stand out take a few
buckets, neighbours hardly nearer than the rest take many. A query with fewer than ``count`` rows after the first
visit visits all buckets of one table. What tables find is merged, scores are taken from the original vectors
by adding products in order, in double precision.

Buckets are packed into groups of about ``_group_rows`` rows, one bucket of more rows is dealt to several by hash,
and the queries of a group (by their own bucket) meet another group as one unit of work. Of equal vectors in a
unit only the ``count + 1`` smallest keys can be returned, so copies cost no comparisons. The driver holds the
number of rows per bucket, at most ``BANDS * TABLES * 3**9`` a dimension.

Edge cases: vectors that are null, zero or hold null or non-finite components take no part, nor do rows with a
null key. Vectors of different dimension are never compared. Rows repeating key and vector are one row; rows
repeating only the key are rows of their own, each a query of its own under the same key, and may find each other. An empty
table gives an empty result. Extra columns are not read. Norms have to fit a double.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakegauge.llm.columns import stored
from lakegauge.llm.dense import finite, matrices

COUNT = 20
TABLES = 2
FIRST = 256
SUCCESS = 0.9
#: Width of an interval, in norms of the band.
WIDTH = 1.2
#: Rows a bucket is meant to hold.
BUCKET_ROWS = 128
#: Bands of norms: each halves the norm, the last takes all that is left.
BANDS = 8

_SIDES = 3
_PROJECTIONS = 3, 9
_GROUP_ROWS = 1 << 12, 1 << 17
#: Numbers a task holds at once for estimates or scores.
_AT_ONCE = 1 << 22

def _normal(x: np.ndarray) -> np.ndarray:
    """The distribution function of the standard normal distribution."""
    return np.array([0.5 + 0.5 * math.erf(v) for v in (x / math.sqrt(2)).ravel().tolist()]).reshape(x.shape)


@dataclass
class Hashing:
    """Projections of vectors of one dimension; ``largest`` is the largest norm."""

    dimension: int
    largest: float
    projections: int

    def __post_init__(self) -> None:
        random = np.random.default_rng([13, self.dimension])
        self.lines = random.standard_normal((TABLES, self.projections, self.dimension + 1))
        self.shifts = random.uniform(0, WIDTH, (TABLES, self.projections))

    @property
    def buckets(self) -> int:
        return _SIDES**self.projections

    def norms(self, bands: np.ndarray | int) -> np.ndarray:
        return self.largest * 0.5 ** np.asarray(bands)

    def buckets_of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band, and bucket in each table, numbered through bands and tables."""
        share = np.linalg.norm(vectors, axis=1) / self.largest
        bands = np.clip(np.floor(-np.log2(share)), 0, BANDS - 1).astype(np.int64)
        scaled = vectors / self.norms(bands)[:, None]
        rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
        numbers = []
        for table in range(TABLES):
            along = scaled @ self.lines[table, :, :-1].T + rest[:, None] * self.lines[table, :, -1]
            sides = np.clip(np.floor((along + self.shifts[table]) / WIDTH), -1, 1).astype(np.int64) + 1
            number = sides @ (_SIDES ** np.arange(self.projections - 1, -1, -1))
            numbers.append((bands * TABLES + table) * self.buckets + number)
        return bands, np.stack(numbers, axis=1)

    def success(self, directions: np.ndarray, table: int, shares: np.ndarray) -> np.ndarray:
        """Probability that a candidate lies in each bucket, per query: its projection on the query's unit
        ``directions`` is the share ``shares`` of its band's norm."""
        centre = shares[:, None] * (directions @ self.lines[table, :, :-1].T)
        spread = np.sqrt(np.maximum(1 - shares**2, 1e-12))[:, None]
        low = _normal((-self.shifts[table] - centre) / spread)
        high = _normal((WIDTH - self.shifts[table] - centre) / spread)
        sides = np.stack([low, high - low, 1 - high], axis=2)
        found = np.ones((len(directions), 1))
        for i in range(self.projections):
            found = (found[:, :, None] * sides[:, i, None, :]).reshape(len(directions), -1)
        return found


@dataclass
class Directory:
    """Rows of each bucket of a dimension, and the groups it is dealt to: ``spread`` of them from ``group`` on."""

    rows: np.ndarray
    group: np.ndarray
    spread: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray, group_rows: int, base: int) -> tuple[Directory, int]:
        spread = np.maximum(1, -(-rows // group_rows))
        small = np.where(spread == 1, rows, 0)
        group = base + (np.cumsum(small) - small) // group_rows
        large = spread > 1
        after = int(group.max(initial=base)) + 1
        group[large] = after + np.cumsum(spread[large]) - spread[large]
        return cls(rows, group, spread), after + int(spread[large].sum())


def _visited(probability: np.ndarray, most: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Which buckets are visited, in falling order of ``probability``, until ``weights`` of them add up to ``most``."""
    order = np.argsort(-probability, axis=1, kind="stable")
    ordered = np.take_along_axis(np.broadcast_to(weights, probability.shape), order, axis=1)
    before = np.cumsum(ordered, axis=1) - ordered
    visited = np.zeros(probability.shape, bool)
    np.put_along_axis(visited, order, before < most[:, None], axis=1)
    return visited


def _probes(
    vectors: np.ndarray, bounds: np.ndarray | None, hashing: Hashing, directory: Directory
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Queries and numbers of the buckets they visit: first, or second with ``bounds`` of the last score."""
    norms = np.linalg.norm(vectors, axis=1)
    directions = vectors / norms[:, None]
    per_table = 1 - (1 - SUCCESS) ** (1 / TABLES)
    for part in range(len(directory.rows) // hashing.buckets):
        band, table = divmod(part, TABLES)
        base = part * hashing.buckets
        rows = directory.rows[base : base + hashing.buckets]
        if not rows.any():
            continue
        half = np.full(len(vectors), 0.5)
        likely = np.where(rows > 0, hashing.success(directions, table, half), -1)
        visited = _visited(likely, np.full(len(vectors), FIRST), rows)
        if bounds is not None:
            unbounded = np.isneginf(bounds)
            shares = np.where(unbounded, 0, bounds / (norms * hashing.norms(band)))
            likely = hashing.success(directions, table, np.clip(shares, -1, 1))
            most = np.where(shares > 1 + 1e-9, 0, per_table)
            second = np.where(unbounded[:, None], table == 0, _visited(likely, most, likely))
            visited = second & ~visited
        query, bucket = np.nonzero(visited & (rows > 0))
        yield query, bucket + base


def _group_rows(total: int) -> int:
    """Grows with the root of the table, so that units and the copies of rows they take grow alike."""
    return int(np.clip(64 * math.isqrt(total), *_GROUP_ROWS))


def _ranked(names: np.ndarray, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorting by ``names`` and then ``order``, and the rank within a name of each."""
    by = np.lexsort((*order[::-1], names))
    names = names[by]
    firsts = np.flatnonzero(np.diff(names, prepend=-1)) if len(names) else np.zeros(0, np.int64)
    return by, np.arange(len(names)) - np.repeat(firsts, np.diff(firsts, append=len(names)))


def _in_order(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows, added from the first component on whatever the number of rows."""
    total = np.zeros(len(left))
    for i in range(left.shape[1]):
        total += left[:, i] * right[:, i]
    return total


def _met(probes: pa.Table, rows: pa.Table, count: int) -> pa.Table:
    """The best rows for each query of a unit, among the buckets the query visits."""
    names = ["query", "own", "key", "digest", "score"]
    if not rows.num_rows:  # A bucket's part by hash may be empty.
        return pa.Table.from_arrays([*(pa.array([], pa.int64()) for _ in names[:4]), pa.array([], pa.float64())], names)
    bucket, key, digest = (rows[n].to_numpy() for n in ("bucket", "key", "digest"))
    # Equal vectors tie: the smallest keys of them go first, and one may be the query's own.
    once = np.unique(np.stack([bucket, digest, key], axis=1), axis=0, return_index=True)[1]
    vector_number = np.cumsum(np.append(0, (np.diff(bucket[once]) != 0) | (np.diff(digest[once]) != 0)))
    by, rank = _ranked(vector_number, key[once])
    by = once[by[rank <= count]]
    bucket, key, digest = bucket[by], key[by], digest[by]
    ((_, _, vectors),) = matrices(rows["vector"].combine_chunks())
    vectors = vectors[by]
    ((_, _, wanted),) = matrices(probes["vector"].combine_chunks())
    query, own = probes["query"].to_numpy(), probes["own"].to_numpy()
    bounds = probes["bound"].to_numpy()
    lists = probes["buckets"].combine_chunks()
    visits = np.repeat(np.arange(len(query)), np.diff(lists.offsets.to_numpy()))
    visited = lists.flatten().to_numpy()
    order = np.argsort(visited, kind="stable")
    visits, visited = visits[order], visited[order]
    slack = 1e-12 * np.linalg.norm(wanted, axis=1) * np.linalg.norm(vectors, axis=1).max(initial=0)
    left, right, scores = [], [], []
    for number in np.unique(visited).tolist():
        a, b = np.searchsorted(bucket, [number, number + 1])
        asking = visits[slice(*np.searchsorted(visited, [number, number + 1]))]
        step = max(1, _AT_ONCE // max(1, b - a))
        for at in range(0, len(asking) if b > a else 0, step):
            some = asking[at : at + step]
            found = wanted[some] @ vectors[a:b].T
            found[(query[some, None] == key[a:b]) & (own[some, None] == digest[a:b])] = -np.inf
            least = bounds[some]
            if b - a > count:
                least = np.maximum(least, np.partition(found, b - a - count, axis=1)[:, b - a - count])
            i, j = np.nonzero((found >= (least - slack[some])[:, None]) & ~np.isneginf(found))
            left.append(some[i]), right.append(j + a), scores.append(found[i, j])
    empty = np.zeros(0, np.int64)
    left, right = np.concatenate([empty, *left]), np.concatenate([empty, *right])
    scores = np.concatenate([np.zeros(0), *scores])
    by, rank = _ranked(left, -scores)
    left, right, scores = left[by], right[by], scores[by]
    last = np.full(len(query), -np.inf)
    last[left[rank == count - 1]] = scores[rank == count - 1]
    near = scores >= (last - slack)[left]
    left, right = left[near], right[near]
    step = max(1, _AT_ONCE // max(1, vectors.shape[1]))
    pieces = [slice(at, at + step) for at in range(0, len(left), step)]
    scores = np.concatenate([np.zeros(0), *(_in_order(wanted[left[p]], vectors[right[p]]) for p in pieces)])
    by, rank = _ranked(left, -scores, key[right], digest[right])
    by = by[rank < count]
    left, right = left[by], right[by]
    return pa.Table.from_arrays([pa.array(x) for x in (query[left], own[left], key[right], digest[right], scores[by])], names)


def _best(found: DataFrame, count: int) -> DataFrame:
    """The ``count`` best different rows of each query, with their ``rank``."""
    once = found.groupBy("query", "own", "key", "digest").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query", "own").orderBy(F.col("score").desc(), "key", "digest")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def nearest_neighbours(
    embeddings: DataFrame,
    queries: Column,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    count: int = COUNT,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``: for each row where ``queries`` holds, the ``count`` rows of
    largest inner product found among all others, ties to the smaller key. Keys are integers."""
    rows = embeddings.select(
        F.col(key).cast("long").alias("key"), F.col(vector).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asked")
    )
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    rows = rows.where(F.col("key").isNotNull() & finite("vector")).withColumn("norm", norm).where("norm > 0")
    rows = rows.withColumn("digest", F.xxhash64("vector"))
    sizes = rows.groupBy(F.size("vector").alias("dimension")).agg(
        F.count(F.lit(1)).alias("n"), F.max("norm").alias("largest")
    )
    hashings, total = {}, 0
    for size in sizes.collect():
        least, most = _PROJECTIONS
        needed = math.ceil(math.log(max(1, size.n / BUCKET_ROWS), _SIDES))
        hashings[size.dimension] = Hashing(size.dimension, size.largest, min(max(needed, least), most))
        total += size.n

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dimension, chosen, vectors in matrices(batch.column("vector")):
                _, numbers = hashings[dimension].buckets_of(vectors)
                own = batch.take(pa.array(chosen))
                lists = pa.ListArray.from_arrays(np.arange(0, numbers.size + 1, TABLES, dtype=np.int32), numbers.ravel())
                yield pa.RecordBatch.from_arrays([*own.columns, lists], names=[*batch.schema.names, "buckets"])

    fields = [rows.schema[n] for n in ("key", "digest", "asked", "vector")]
    index = rows.select(*(f.name for f in fields))
    index = index.mapInArrow(find, StructType([*fields, *StructType.fromDDL("buckets array<long>").fields]))
    index = stored(index, "hashed-vectors")

    counted = index.select(F.size("vector").alias("dimension"), F.explode("buckets").alias("bucket"))
    counts = {n: np.zeros(BANDS * TABLES * h.buckets, np.int64) for n, h in hashings.items()}
    for row in counted.groupBy("dimension", "bucket").count().toLocalIterator():
        counts[row["dimension"]][row["bucket"]] = row["count"]
    directories, base = {}, 0
    for dimension, rows_of in counts.items():
        directories[dimension], base = Directory.of(rows_of, _group_rows(total), base)
    plain = {n: (h.largest, h.projections, vars(directories[n])) for n, h in hashings.items()}
    known = index.sparkSession.sparkContext.broadcast(plain)

    def directory_of(dimension: int) -> Directory:
        return Directory(**known.value[dimension][2])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row once per table, with the group of its bucket there."""
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy()
            numbers = batch.column("buckets").flatten().to_numpy().reshape(-1, TABLES)
            keys = batch.column("key").to_numpy().view(np.uint64)
            for table in range(TABLES):
                groups = np.zeros(len(sizes), np.int64)
                for dimension in np.unique(sizes).tolist():
                    own, directory = sizes == dimension, directory_of(dimension)
                    bucket = numbers[own, table]
                    spread = directory.spread[bucket].astype(np.uint64)
                    mixed = (keys[own] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
                    groups[own] = directory.group[bucket] + (mixed % spread).astype(np.int64)
                columns = [pa.array(groups), pa.array(numbers[:, table]), pa.array(np.full(len(sizes), table, np.int32))]
                columns += [batch.column(n) for n in ("key", "digest", "asked", "vector")]
                yield pa.RecordBatch.from_arrays(columns, names=dealt_schema.names)

    dealt_schema = StructType([*StructType.fromDDL("group long, bucket long, table int").fields, *fields])
    dealt = index.mapInArrow(deal, dealt_schema)
    asked = dealt.where("asked AND table = 0").select(
        F.col("key").alias("query"), F.col("digest").alias("own"), F.col("group").alias("home"), "vector"
    )

    def visit(asked: DataFrame) -> DataFrame:
        """What queries find; with a ``bound``, in their second visit."""
        second = "bound" in asked.columns
        if not second:
            asked = asked.withColumn("bound", F.lit(float("-inf")))
        rest = StructType.fromDDL("group long, buckets array<long>").fields
        schema = StructType([*(asked.schema[n] for n in ("query", "own", "home", "vector", "bound")), *rest])
        asked = asked.select(*schema.names[:5])

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for dimension, chosen, vectors in matrices(batch.column("vector")):
                    hashing = Hashing(dimension, *known.value[dimension][:2])
                    directory = directory_of(dimension)
                    bounds = batch.column("bound").to_numpy()[chosen]
                    step = max(1, _AT_ONCE // hashing.buckets)
                    for at in range(0, len(chosen), step):
                        some = slice(at, at + step)
                        found = _probes(vectors[some], bounds[some] if second else None, hashing, directory)
                        for query, bucket in found:
                            spread = directory.spread[bucket]
                            ends = np.cumsum(spread)
                            within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - spread, spread)
                            query, bucket = np.repeat(query, spread), np.repeat(bucket, spread)
                            group = directory.group[bucket] + within
                            order = np.lexsort((bucket, group, query))
                            query, bucket, group = query[order], bucket[order], group[order]
                            new = np.ones(len(query), bool)
                            new[1:] = (query[1:] != query[:-1]) | (group[1:] != group[:-1])
                            firsts = np.flatnonzero(new)
                            offsets = np.append(firsts, len(query)).astype(np.int32)
                            own = batch.take(pa.array(chosen[some][query[firsts]]))
                            lists = pa.ListArray.from_arrays(offsets, pa.array(bucket))
                            columns = [*own.columns, pa.array(group[firsts]), lists]
                            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        probes = stored(asked.mapInArrow(probe, schema), "probes")
        units = probes.select(F.col("group").alias("met"), F.col("home").alias("by")).distinct()
        candidates = dealt.select("group", "bucket", "key", "digest", "vector")
        candidates = candidates.join(units, F.col("group") == F.col("met")).drop("group")
        met = probes.groupBy("group", "home").cogroup(candidates.groupBy("met", "by"))
        found = met.applyInArrow(
            lambda probes, rows: _met(probes, rows, count), "query long, own long, key long, digest long, score double"
        )
        return stored(found, "neighbours-found")

    first = visit(asked)
    bounds = _best(first, count).where(F.col("rank") == count).select("query", "own", F.col("score").alias("bound"))
    bound = F.coalesce("bound", F.lit(float("-inf"))).alias("bound")
    again = asked.join(bounds, ["query", "own"], "left").select("query", "own", "home", "vector", bound)
    best = _best(first.unionByName(visit(again)), count)
    return best.select(F.col("query").alias("query_id"), "rank", F.col("key").alias("vec_id"), "score")
