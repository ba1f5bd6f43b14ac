"""Vector codes: each part of a vector is named by its codebook's nearest entry, found by Orchard's search.

Components become integers, ``floor(256 x)``, and vectors are cut into equal consecutive parts. The codebook of
a part position starts as that part of the vectors of the smallest keys; a round assigns all parts and moves
each entry to the floor of its parts' mean. Sums are of integers, so codes and codebooks do not depend on how
rows are dealt to tasks, nor on a task being run again.

Orchard's search keeps, for every entry, a list of all entries by distance from it. It starts at a guess and
walks down the guess's list; an entry nearer to the point becomes the guess and its list is begun. Visited
entries are marked and not measured again. By the triangle inequality an entry further than twice the
current distance from the guess is further from the point than the guess is: there the walk ends, exactly.
An entry at exactly twice the distance may tie and is still visited; ties go to the lower index.

The driver holds codebooks (``entries`` times the dimension) and a sum per entry and component, whatever the
number of vectors; a task hands on one row per entry and component.

Edge cases: vectors that are null or hold null or non-finite components are dropped. A null label is a label
of its own. A null key comes after all others and its vector is coded like the rest; rows repeating a key are
separate rows, the smaller vector first. Fewer vectors than entries give a smaller codebook. Vectors of
different dimension have codebooks of their own; a dimension that ``parts`` does not divide is cut at
the floors of equal shares, so that parts may be empty. An empty table gives an empty result. Extra columns
are not read. Integers beyond 2**26 raise, since squared distances would leave 64 bits.
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
from lakegauge.llm.dense import finite, matrices

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2

_LARGEST = 1 << 26
#: Points searched at once, which bounds the marks a task holds.
_POINTS = 1 << 14

#: A codebook per part.
Codebooks = list[np.ndarray]


def edges(dimension: int, parts: int = PARTS) -> list[int]:
    return [dimension * p // parts for p in range(parts + 1)]


def integers(vectors: np.ndarray) -> np.ndarray:
    scaled = np.floor(SCALE * vectors)
    if (np.abs(scaled) > _LARGEST).any():
        raise ValueError(f"a component beyond {_LARGEST / SCALE:g} cannot be coded")
    return scaled.astype(np.int64)


class Neighbours:
    """The lists of one codebook."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        apart = ((entries[:, None] - entries[None]) ** 2).sum(axis=2)
        self.order = np.argsort(apart, axis=1, kind="stable")
        # An entry is further than twice a distance if the square of the latter is at most this.
        self.ends_at = (np.take_along_axis(apart, self.order, axis=1) - 1) // 4
        spread = entries.max(axis=0) - entries.min(axis=0)
        self.widest = int(spread.argmax()) if len(spread) else None
        if self.widest is not None:
            self.along = np.argsort(entries[:, self.widest], kind="stable")

    def _guess(self, points: np.ndarray) -> np.ndarray:
        """An entry near in the component in which entries differ most."""
        if self.widest is None:
            return np.zeros(len(points), np.int64)
        at = np.searchsorted(self.entries[self.along, self.widest], points[:, self.widest])
        return self.along[np.minimum(at, len(self.entries) - 1)]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance of each point; all points walk in step."""
        found = [self._walk(points[at : at + _POINTS]) for at in range(0, len(points), _POINTS)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _walk(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        current = self._guess(points)
        distance = ((points - self.entries[current]) ** 2).sum(axis=1)
        visited = np.zeros((len(points), len(self.entries)), bool)
        visited[np.arange(len(points)), current] = True
        place = np.zeros(len(points), np.int64)
        walking = np.arange(len(points))
        while len(walking):
            at = current[walking], place[walking]
            walking = walking[distance[walking] > self.ends_at[at]]
            entry = self.order[current[walking], place[walking]]
            place[walking] += 1
            unseen = ~visited[walking, entry]
            point, entry = walking[unseen], entry[unseen]
            visited[point, entry] = True
            measured = ((points[point] - self.entries[entry]) ** 2).sum(axis=1)
            tie = (measured == distance[point]) & (entry < current[point])
            better = (measured < distance[point]) | tie
            point = point[better]
            current[point], distance[point], place[point] = entry[better], measured[better], 0
            walking = walking[place[walking] < len(self.entries)]
        return current, distance


def _coded(vectors: np.ndarray, codebooks: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Entry of each part, and the squared distances added up, of integer vectors."""
    cuts = edges(vectors.shape[1], len(codebooks))
    codes, errors = [], np.zeros(len(vectors), np.int64)
    for a, b, entries in zip(cuts, cuts[1:], codebooks, strict=False):
        code, distance = Neighbours(entries).nearest(vectors[:, a:b])
        codes.append(code)
        errors += distance
    return np.stack(codes, axis=1), errors


def _first(rows: DataFrame, entries: int, parts: int) -> dict[int, Codebooks]:
    """Codebooks of the smallest keys, by dimension."""
    found: dict[int, Codebooks] = {}
    for (dimension,) in rows.select(F.size("vector")).distinct().collect():
        own = rows.where(F.size("vector") == dimension)
        chosen = own.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
        vectors = integers(np.array([r.vector for r in chosen], np.float64).reshape(len(chosen), dimension))
        cuts = edges(dimension, parts)
        found[dimension] = [vectors[:, a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    return found


def _moved(rows: DataFrame, codebooks: dict[int, Codebooks], parts: int) -> dict[int, Codebooks]:
    """Codebooks after a round over all rows."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for dimension, _, vectors in matrices(batch.column("vector")):
                vectors, books = integers(vectors), codebooks[dimension]
                codes, _ = _coded(vectors, books)
                size = len(books[0])
                count = counts.setdefault(dimension, np.zeros((dimension, size), np.int64))
                total = totals.setdefault(dimension, np.zeros((dimension, size), np.int64))
                cuts = edges(dimension, parts)
                for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    count[a:b] += np.bincount(codes[:, p], minlength=size)
                    for i in range(a, b):
                        # Exact: a batch's sums stay far below 2**53.
                        total[i] += np.bincount(codes[:, p], vectors[:, i], size).astype(np.int64)
        for dimension, count in counts.items():
            place, entry = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(place), dimension, np.int32)),
                    pa.array(place.astype(np.int32)),
                    pa.array(entry.astype(np.int32)),
                    pa.array(count[place, entry]),
                    pa.array(totals[dimension][place, entry]),
                ],
                names=["dimension", "place", "entry", "n", "total"],
            )

    added = rows.select("vector").mapInArrow(add_up, "dimension int, place int, entry int, n long, total long")
    added = added.groupBy("dimension", "place", "entry").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    moved = {n: np.concatenate(books, axis=1) for n, books in codebooks.items()}
    for row in added.collect():
        moved[row.dimension][row.entry, row.place] = row.total // row.n
    return {n: np.split(whole, edges(n, parts)[1:-1], axis=1) for n, whole in moved.items()}


def codebooks_digest(codebooks: Codebooks) -> str:
    """SHA-256 of all components in order of part, entry and place, as decimal numbers between commas."""
    return hashlib.sha256(",".join(str(v) for book in codebooks for v in book.ravel().tolist()).encode()).hexdigest()


def vector_codes(
    embeddings: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``key``, ``code`` (two hexadecimal digits per part), ``error``, ``label_error`` (of all rows of the label)
    and ``codebooks_sha256`` of every row with a finite vector. ``entries`` may be up to 256."""
    rows = embeddings.select(
        F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")
    ).where(finite("vector"))
    codebooks = _first(rows, entries, parts)
    for _ in range(rounds):
        codebooks = _moved(rows, codebooks, parts)
    digests = {n: codebooks_digest(books) for n, books in codebooks.items()}
    rest = StructType.fromDDL("code string, error long, codebooks_sha256 string").fields
    schema = StructType([rows.schema["key"], rows.schema["label"], *rest])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dimension, chosen, vectors in matrices(batch.column("vector")):
                codes, errors = _coded(integers(vectors), codebooks[dimension])
                texts = [row.tobytes().hex() for row in codes.astype(np.uint8)]
                own = batch.take(pa.array(chosen))
                columns = [own.column("key"), own.column("label"), pa.array(texts, pa.string()), pa.array(errors)]
                columns.append(pa.repeat(digests[dimension], len(texts)))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    coded = stored(rows.mapInArrow(encode, schema), "vector-codes")
    # Written, so that both inputs of the join are plain shuffles and a label of very many rows is split.
    labels = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    labels = labels.withColumnRenamed("label", "__label")
    result = coded.join(labels, F.col("label").eqNullSafe(F.col("__label")))
    return result.select(F.col("key").alias(key), "code", "error", "label_error", "codebooks_sha256")
