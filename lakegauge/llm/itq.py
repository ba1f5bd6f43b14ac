"""Near-duplicate vectors: codes by iterative quantisation, candidates by several Hamming tables.

Unit vectors are projected on the principal directions of a sample and rotated so that the signs of
the coordinates lose least, which gives balanced bits. The code is cut into ``TABLES`` substrings;
two vectors are compared where a substring agrees, by the cosine of the original vectors in double
precision. Pairs differing in up to ``TABLES - 1`` bits always agree in one, and most others do. The substrings
are the same for every label, whatever its size, so a pair's chance of being met does not depend on how many
other vectors there are. A cell holds about a two-thousandth of a label, so beyond some millions of vectors in
one label the comparisons grow faster than the vectors.

Equal vectors of a label are one with a number of copies. A crowded cell is cut into blocks, and
each pair of blocks is a unit of work. A unit returns a row per vector, with its number of links
that no earlier table has and the least vector it is connected to, so rows grow with the vectors
and not with the pairs.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, null labels
and null ids link with nothing; vectors of different dimension are never compared; a repeated id
counts as another vector; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakegauge.llm.columns import stored
from lakegauge.llm.components import components

THRESHOLD = 0.98
BITS = 64
TABLES = 6

#: Vectors the rotation is learned from, chosen by hash; every vector is indexed.
FIT_VECTORS = 20_000
ROUNDS = 50

BLOCK_VECTORS = 1024


def learn_rotation(vectors: np.ndarray, bits: int = BITS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and the matrix whose product's signs are the code, of unit vectors in rows."""
    mean = vectors.mean(axis=0)
    centred = vectors - mean
    width = min(bits, vectors.shape[1])
    _, directions = np.linalg.eigh(centred.T @ centred)
    projection = directions[:, ::-1][:, :width]
    projected = centred @ projection
    rotation = np.linalg.qr(np.random.default_rng(3).standard_normal((width, width)))[0]
    for _ in range(rounds):
        signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ projected)
        rotation = (left @ right).T
    return mean, projection @ rotation


def codes(vectors: np.ndarray, learned: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The code of each unit vector as a 64-bit integer."""
    mean, matrix = learned
    signs = (vectors - mean) @ matrix >= 0
    weights = np.left_shift(np.uint64(1), np.arange(signs.shape[1], dtype=np.uint64))
    return (signs * weights).sum(axis=1, dtype=np.uint64)


def substrings(width: int, tables: int = TABLES) -> list[tuple[int, int]]:
    """First bit and number of bits of each table's substring of a code of ``width`` bits."""
    edges = [width * t // tables for t in range(tables + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key, label, vector and its digest, null where the vector can have no links."""
    for batch in batches:
        vectors = batch.column("vector")
        values = vectors.flatten()
        flat = values.to_numpy(zero_copy_only=False).astype(np.float64)
        bad = ~np.isfinite(flat)
        sizes = np.array([len(v) if v.is_valid else 0 for v in vectors], np.int64)
        ends = np.cumsum(sizes)
        digests = []
        for size, end in zip(sizes.tolist(), ends.tolist(), strict=True):
            part = slice(end - size, end)
            usable = size and not bad[part].any() and flat[part].any() and np.isfinite(np.linalg.norm(flat[part]))
            digests.append(hashlib.blake2b(flat[part].tobytes(), digest_size=16).digest() if usable else None)
        columns = [batch.column("key"), batch.column("label"), pa.array(digests, pa.binary()), vectors]
        yield pa.RecordBatch.from_arrays(columns, ["key", "label", "digest", "vector"])


def _learned(distinct: DataFrame, fit_vectors: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A rotation per dimension, from a sample of at most about ``fit_vectors`` vectors."""
    total = distinct.count()
    share = F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) / float(1 << 30)
    sample = distinct.where(share < min(1.0, fit_vectors / max(1, total))).select("vector")
    by_size: dict[int, list] = {}
    for (vector,) in sample.collect():
        by_size.setdefault(len(vector), []).append(vector)
    return {n: learn_rotation(_units(np.array(v, np.float64))) for n, v in by_size.items()}


def _rotation(learned: dict[int, tuple[np.ndarray, np.ndarray]], dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """The learned one, or random directions for a dimension that the sample lacks."""
    if dimension not in learned:
        random = np.random.default_rng(dimension).standard_normal((dimension, min(BITS, dimension)))
        return np.zeros(dimension), np.linalg.qr(random)[0]
    return learned[dimension]


def _links_of_unit(unit: pa.Table, threshold: float) -> pa.Table:
    """Links among the vectors of one unit: those of its two blocks, or within its single block."""
    dimension, table = unit["dimension"][0].as_py(), unit["table"][0].as_py()
    ids = unit["rep"].to_numpy()
    copies = unit["copies"].to_numpy()
    code = unit["code"].to_numpy().view(np.uint64)
    vectors = _units(_matrix(unit["vector"].combine_chunks(), dimension))
    side = unit["block"].to_numpy() == unit["high"][0].as_py()
    rows = np.arange(len(ids))
    left, right = (rows, rows) if side.all() else (rows[~side], rows[side])
    near = np.argwhere(vectors[left] @ vectors[right].T >= threshold)
    a, b = left[near[:, 0]], right[near[:, 1]]
    within = side.all()
    a, b = (a[a != b], b[a != b]) if within else (a, b)
    differing = code[a] ^ code[b]
    fresh = np.ones(len(a), bool)
    for start, width in substrings(min(BITS, dimension))[:table]:
        mask = np.uint64(((1 << width) - 1) << start)
        fresh &= (differing & mask) != 0
    counts = np.bincount(a[fresh], copies[b[fresh]], len(ids))
    if not within:
        counts += np.bincount(b[fresh], copies[a[fresh]], len(ids))
    least = ids.copy()
    while True:
        new = least.copy()
        np.minimum.at(new, a, least[b])
        np.minimum.at(new, b, least[a])
        if (new == least).all():
            break
        least = new
    linked = np.zeros(len(ids), bool)
    linked[a] = linked[b] = True
    return pa.table({"rep": ids[linked], "n": counts[linked].astype(np.int64), "least": least[linked]})


def near_vectors(
    embeddings: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    fit_vectors: int = FIT_VECTORS,
    block_vectors: int = BLOCK_VECTORS,
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` for every row.

    Rows link when their labels are equal and the cosine of their vectors is at least ``threshold``.
    """
    rows = embeddings.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    fields = [rows.schema["key"], rows.schema["label"]]
    schema = StructType([*fields, *StructType.fromDDL("digest binary").fields, rows.schema["vector"]])
    usable = F.col("key").isNotNull() & F.col("label").isNotNull() & F.col("digest").isNotNull()
    digested = rows.mapInArrow(_digests, schema).withColumn("digest", F.when(usable, F.col("digest")))
    digested = stored(digested, "vectors")
    distinct = digested.where(F.col("digest").isNotNull()).groupBy("label", "digest").agg(
        F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector")
    )
    distinct = stored(distinct, "distinct-vectors")
    learned = _learned(distinct, fit_vectors)
    learned_ref = distinct.sparkSession.sparkContext.broadcast(learned)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("vector")], np.int32)
            result = np.zeros(len(sizes), np.uint64)
            for dimension in np.unique(sizes).tolist():
                chosen = sizes == dimension
                vectors = _matrix(batch.column("vector").filter(pa.array(chosen)), dimension)
                result[chosen] = codes(_units(vectors), _rotation(learned_ref.value, dimension))
            columns = [*batch.columns, pa.array(sizes), pa.array(result.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "dimension", "code"])

    coded_schema = StructType([*distinct.schema.fields, *StructType.fromDDL("dimension int, code long").fields])
    coded = distinct.mapInArrow(encode, coded_schema)
    width = F.least(F.col("dimension"), F.lit(BITS))
    starts = [F.floor(width * t / TABLES).cast("int") for t in range(TABLES + 1)]
    slots = F.array(
        *(
            F.struct(F.lit(t).alias("table"), starts[t].alias("start"), (starts[t + 1] - starts[t]).alias("width"))
            for t in range(TABLES)
        )
    )
    cells = coded.withColumn("slot", F.explode(slots))
    part = F.expr("shiftrightunsigned(code, slot.start) & (shiftleft(1L, slot.width) - 1)")
    cell = ["label", "dimension", "table", "part"]
    cells = cells.select("*", F.col("slot.table").alias("table"), part.alias("part")).drop("slot")
    members = F.count(F.lit(1))
    sizes = cells.groupBy(*cell).agg(members.alias("members"), F.ceil(members / float(block_vectors)).cast("int").alias("blocks"))
    # A vector alone in its cell has nothing to be compared with.
    cells = cells.join(sizes.where("members > 1").drop("members"), cell).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    units = cells.select("*", other).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    )
    found = units.groupBy(*cell, "low", "high").applyInArrow(
        lambda unit: _links_of_unit(unit, threshold), "rep long, n long, least long"
    )
    found = stored(found, "vector-links")
    joined = components(found, "rep", "least")
    counted = found.groupBy("rep").agg(F.sum("n").alias("n"))
    summary = distinct.select("label", "digest", "rep", "copies").join(counted, "rep", "left")
    summary = summary.join(joined, F.col("rep") == F.col("node"), "left").select(
        "label",
        "digest",
        (F.coalesce("n", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    result = digested.select("key", "label", "digest").join(summary, ["label", "digest"], "left")
    component = F.coalesce("component_id", "key")
    return result.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )
