"""Whitening of vectors by exact principal components.

Components of vectors become integers, ``floor(64 c)``, so that sums and the scatter matrix
``n * sum(x x') - sum(x) sum(x)'`` (``n**2`` times the covariance, whatever is added to all vectors) are exact, however
rows are dealt to tasks and however often a task runs. From there nothing is rounded before the end:

* The scatter's characteristic polynomial is computed modulo many primes of 31 bits, one prime a row: reduction to Hessenberg
  form, then the recurrence over its leading minors. Chinese remainders give the integer coefficients; as
  the scatter has no negative eigenvalue, their size is bounded by its trace, which tells how many primes are enough.
* All roots are real, so the number of roots above a point is exactly the number of sign changes of the polynomial shifted
  there. Halving by this count isolates a root, halving by sign refines it to 2**-160 of the trace.
* The component is in the null space of the scatter less its root: inverse iteration in integer arithmetic of 200
  bits finds it. Roots that cannot be told apart share a null space, of which an orthonormal basis is taken.

Primes and components are rows of small tables and worked on in parallel; the driver holds a matrix and a polynomial per
dimension, never vectors. A last pass gives the covariance of the whitened values.

Edge cases: vectors that are null or hold null or non-finite components are dropped. A null or repeated key is a row
like any other. Vectors of different dimension are fitted apart, each with its own ``n``; of fewer than
``components`` dimensions all are returned. A component without variance (and any, where a
single vector or equal vectors are fitted) has a null ``whitened`` and no part in ``identity_error``, which is
null if all are such; without any variance ``explained`` is null too. A ``deviation`` beyond 64 bits is null. An empty
table gives an empty result. Extra columns are not read. Integers beyond 2**40 raise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakegauge.llm.dense import finite, matrices

SCALE = 64
COMPONENTS = 32

_LARGEST = 1 << 40
_SLICE = 4096
#: Bits of roots, below the trace; roots nearer than the second cannot be told apart; bits of vectors.
_ROOT_BITS, _SAME_BITS, _VECTOR_BITS = 160, 120, 200

Matrix = list[list[int]]


# --- exact moments ------------------------------------------------------------


def integers(vectors: np.ndarray) -> np.ndarray:
    scaled = np.floor(SCALE * vectors)
    if (np.abs(scaled) > _LARGEST).any():
        raise ValueError(f"a component beyond {_LARGEST / SCALE:g} cannot be summed exactly")
    return scaled.astype(np.int64)


def _products(rows: np.ndarray) -> np.ndarray:
    """Sum of the outer products of integer rows, exact."""
    most = int(np.abs(rows).max(initial=0))
    if most**2 * len(rows) < 1 << 53:
        return (rows.T.astype(float) @ rows.astype(float)).astype(np.int64).astype(object)
    wide = rows.astype(object)
    return wide.T @ wide


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers, sums and sums of products of a task: ``dimension, i, j, total``; number and sums have ``j`` -1."""
    totals: dict[int, list] = {}
    for batch in batches:
        for dimension, _, vectors in matrices(batch.column("vector")):
            own = totals.setdefault(dimension, [0, np.zeros(dimension, object), np.zeros((dimension, dimension), object)])
            for at in range(0, len(vectors), _SLICE):
                rows = integers(vectors[at : at + _SLICE])
                own[0] += len(rows)
                own[1] += rows.sum(axis=0).astype(object)
                own[2] += _products(rows)
    for dimension, (n, sums, products) in totals.items():
        i, j = np.triu_indices(dimension)
        values = [n, *sums.tolist(), *products[i, j].tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(values), dimension, np.int32)),
                pa.array(np.concatenate([[-1], np.arange(dimension), i]).astype(np.int32)),
                pa.array(np.concatenate([np.full(dimension + 1, -1), j]).astype(np.int32)),
                pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0)),
            ],
            names=["dimension", "i", "j", "total"],
        )


@dataclass
class Scatter:
    """``n``, the sums, and ``n**2`` times the covariance, of integer vectors."""

    n: int
    sums: list[int]
    matrix: Matrix

    @property
    def trace(self) -> int:
        return sum(self.matrix[i][i] for i in range(len(self.sums)))


def scatters(rows: DataFrame) -> dict[int, Scatter]:
    """By dimension, of the column ``vector``."""
    added = rows.select("vector").mapInArrow(_moments, "dimension int, i int, j int, total decimal(38,0)")
    added = added.groupBy("dimension", "i", "j").agg(F.sum("total").alias("total"))
    found: dict[int, dict[tuple[int, int], int]] = {}
    for row in added.collect():
        found.setdefault(row.dimension, {})[row.i, row.j] = int(row.total)
    result = {}
    for dimension, totals in found.items():
        n, sums = totals[-1, -1], [totals[i, -1] for i in range(dimension)]
        matrix = [
            [n * totals[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(dimension)] for i in range(dimension)
        ]
        result[dimension] = Scatter(n, sums, matrix)
    return result


# --- the characteristic polynomial ------------------------------------------------


def _is_prime(n: int) -> bool:
    """For odd ``n`` below 3,215,031,751, where these bases decide."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes(bits: int) -> list[int]:
    """Primes below 2**31 whose product has more than ``bits`` bits."""
    found, product, n = [], 1, (1 << 31) - 1
    while product.bit_length() <= bits:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, prime: int) -> list[int]:
    """Coefficients of the characteristic polynomial modulo a prime below 2**31, that of ``x**0`` first."""
    h, size = matrix % prime, len(matrix)
    for k in range(size - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + below[0]
        h[[k + 1, pivot]] = h[[pivot, k + 1]]
        h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        times = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, prime) % prime
        h[k + 2 :] = (h[k + 2 :] - times[:, None] * h[k + 1]) % prime
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * times % prime).sum(axis=1)) % prime
    minors = np.zeros((size + 1, size + 1), np.int64)
    minors[0, 0] = 1
    for m in range(1, size + 1):
        weights, below = np.empty(m, np.int64), 1
        for i in range(m - 1, -1, -1):
            weights[i] = int(h[i, m - 1]) * below % prime
            below = below * int(h[i, i - 1]) % prime if i else below
        minors[m, 1:] = minors[m - 1, :-1]
        minors[m] = (minors[m] - (weights[:, None] * minors[:m] % prime).sum(axis=0)) % prime
    return minors[size].tolist()


def _bits(size: int, trace: int) -> int:
    """Bits that hold the coefficients, signs included, if no root is negative."""
    share = math.log2(trace) - math.log2(size) if trace else 0
    return 3 + math.ceil(max(math.log2(math.comb(size, k)) + k * share for k in range(size + 1)))


def _joined(found: dict[int, list[int]]) -> list[int]:
    """The integers of least size with these remainders, by prime."""
    product = math.prod(found)
    parts = {p: product // p * pow(product // p % p, -1, p) for p in found}
    values = (sum(parts[p] * row[k] for p, row in found.items()) % product for k in range(len(next(iter(found.values())))))
    return [v - product if 2 * v > product else v for v in values]


def polynomials(spark: SparkSession, fits: dict[int, Scatter]) -> dict[int, list[int]]:
    """The characteristic polynomial of each scatter, a prime a row."""
    wanted = [(n, p) for n, fit in fits.items() for p in primes(_bits(n, fit.trace))]
    known = spark.sparkContext.broadcast({n: fit.matrix for n, fit in fits.items()})

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for dimension, prime in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                matrix = np.array([[v % prime for v in line] for line in known.value[dimension]], np.int64)
                rows.append(polynomial_modulo(matrix, prime))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, pa.list_(pa.int64()))], names=["dimension", "prime", "found"]
            )

    found: dict[int, dict[int, list[int]]] = {}
    for row in _spread(spark, wanted, "dimension int, prime long").mapInArrow(
        solve, "dimension int, prime long, found array<long>"
    ).collect():
        found.setdefault(row.dimension, {})[row.prime] = row.found
    return {n: _joined(rows) for n, rows in found.items()}


def _spread(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema).repartition(max(1, min(len(rows), spark.sparkContext.defaultParallelism)))


# --- roots ------------------------------------------------------------------------


class Roots:
    """Roots, all real and none negative, of a polynomial given from ``x**0`` on: in units of ``2**-shift``."""

    def __init__(self, polynomial: list[int], trace: int) -> None:
        self.shift = max(0, _ROOT_BITS - trace.bit_length())
        degree = len(polynomial) - 1
        # The polynomial whose roots are these units, from the highest power on.
        self.scaled = [c << (self.shift * (degree - k)) for k, c in enumerate(polynomial)][::-1]
        self.most = (trace << self.shift) + 1
        self.same = self.most >> _SAME_BITS
        self.above = cache(self._above)

    def _above(self, point: int) -> int:
        """How many roots lie above a point: sign changes of the polynomial shifted there."""
        values = list(self.scaled)
        for end in range(len(values), 1, -1):
            for i in range(1, end):
                values[i] += point * values[i - 1]
        signs = [v > 0 for v in values if v]
        return sum(a != b for a, b in zip(signs, signs[1:], strict=False))

    def _sign(self, point: int) -> int:
        value = 0
        for c in self.scaled:
            value = value * point + c
        return (value > 0) - (value < 0)

    def largest(self, k: int) -> tuple[int, int] | None:
        """The ``k``-th largest root and how many equal ones come before it; none where it is zero."""
        low, high = 0, self.most
        if self.above(0) < k:
            return None
        while high - low > max(1, self.same) and not (self.above(low) == k and self.above(high) == k - 1):
            middle = (low + high) // 2
            low, high = (middle, high) if self.above(middle) >= k else (low, middle)
        before = k - 1 - self.above(high)
        if self.above(low) - self.above(high) == 1:
            right = self._sign(high)
            # The root may be the upper end itself.
            while high - low > 1 and right:
                middle = (low + high) // 2
                sign = self._sign(middle)
                low, high = (middle, high) if sign == -right else (low, middle)
                right = sign if sign != -right else right
            return high, before
        return (low + high) // 2, before


# --- components -------------------------------------------------------------------


class _Eliminated:
    """Triangular factors of an integer matrix, multipliers with ``_VECTOR_BITS`` bits after the point."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.rows, size = matrix.copy(), len(matrix)
        self.order = np.arange(size)
        self.times = np.zeros((size, size), object)
        for k in range(size):
            pivot = max(range(k, size), key=lambda i: abs(self.rows[i, k]))
            for held in (self.rows, self.order, self.times):
                held[[k, pivot]] = held[[pivot, k]]
            # Where nothing is left of the last columns, any small number stands for the pivot.
            self.rows[k, k] = self.rows[k, k] or 1
            self.times[k + 1 :, k] = (self.rows[k + 1 :, k] << _VECTOR_BITS) // self.rows[k, k]
            self.rows[k + 1 :, k:] -= (self.times[k + 1 :, k, None] * self.rows[k, k:]) >> _VECTOR_BITS

    def solve(self, right: np.ndarray) -> np.ndarray:
        values, size = right[self.order].copy(), len(right)
        for k in range(size):
            values[k + 1 :] -= (self.times[k + 1 :, k] * values[k]) >> _VECTOR_BITS
        values <<= _VECTOR_BITS
        for k in range(size - 1, -1, -1):
            values[k] = (values[k] - sum(self.rows[k, k + 1 :] * values[k + 1 :])) // self.rows[k, k]
        return values


def _unit(values: np.ndarray) -> np.ndarray:
    values = values << _VECTOR_BITS
    length = math.isqrt(sum(values * values)) or 1
    return (values << _VECTOR_BITS) // length


def component(matrix: Matrix, root: int, before: int, shift: int) -> np.ndarray:
    """The unit vector of a root in units of ``2**-shift``, orthogonal to those of the ``before`` equal roots,
    with ``_VECTOR_BITS`` bits after the point; its largest entry is positive."""
    size = len(matrix)
    wide = np.array(matrix, object).reshape(size, size) << shift
    factors = _Eliminated(wide - np.diag(np.array([root] * size, object)))
    random, basis = np.random.default_rng(12), []
    for _ in range(before + 1):
        vector = np.array(random.integers(-(1 << 30), 1 << 30, size).tolist(), object) << (_VECTOR_BITS - 30)
        for _ in range(2):
            vector = _unit(factors.solve(vector))
            for other in basis:
                vector = vector - (other * (sum(vector * other) >> _VECTOR_BITS) >> _VECTOR_BITS)
            vector = _unit(vector)
        basis.append(vector)
    largest = max(range(size), key=lambda i: abs(basis[-1][i]))
    return basis[-1] if basis[-1][largest] > 0 else -basis[-1]


@dataclass
class Whitening:
    """What whitens vectors of one dimension: ``factors`` are for ``n x - sums``, a column per component with variance."""

    n: int
    sums: np.ndarray
    factors: np.ndarray
    explained: list[float | None]
    identity_error: float | None = None

    def centred(self, vectors: np.ndarray) -> np.ndarray:
        """``n x - sums``, exact."""
        rows, most = integers(vectors), int(np.abs(self.sums).max(initial=0)) if len(self.sums) else 0
        if self.n * int(np.abs(rows).max(initial=0)) + most < 1 << 62:
            return self.n * rows - self.sums.astype(np.int64)
        return self.n * rows.astype(object) - self.sums

    def whitened(self, vectors: np.ndarray) -> np.ndarray:
        return self.centred(vectors).astype(float) @ self.factors

    def deviations(self, vectors: np.ndarray) -> list[int | None]:
        rows = self.centred(vectors)
        most = int(np.abs(rows).max(initial=0))
        if most**2 * max(1, rows.shape[1]) < 1 << 63:
            return (rows.astype(np.int64) ** 2).sum(axis=1).tolist()
        found = ((v := row.astype(object)) @ v for row in rows)
        return [v if v < 1 << 63 else None for v in found]


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of all vectors of each dimension, from the column ``vector``."""
    spark = rows.sparkSession
    fits = scatters(rows)
    found = polynomials(spark, fits)
    plain = {n: (fit.matrix, found[n], fit.trace) for n, fit in fits.items()}
    known = spark.sparkContext.broadcast(plain)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            factors, shares = [], []
            for dimension, k in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                matrix, polynomial, trace = known.value[dimension]
                roots = Roots(polynomial, trace)
                root = roots.largest(k)
                shares.append((root[0] / (trace << roots.shift) if root else 0.0) if trace else None)
                if root is None:
                    factors.append(None)
                    continue
                vector = component(matrix, *root, roots.shift)
                # The square root of the root, with as many bits after the point as the vector.
                length = math.isqrt(root[0] << (2 * _VECTOR_BITS - roots.shift))
                factors.append([int(v) / length for v in vector])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(factors, pa.list_(pa.float64())), pa.array(shares, pa.float64())],
                names=["dimension", "component", "factors", "explained"],
            )

    wanted = [(n, k) for n in fits for k in range(1, min(n, components) + 1)]
    solved: dict[int, dict[int, tuple]] = {n: {} for n in fits}
    for row in _spread(spark, wanted, "dimension int, component int").mapInArrow(
        solve, "dimension int, component int, factors array<double>, explained double"
    ).collect() if wanted else []:
        solved[row.dimension][row.component] = row.factors, row.explained
    result = {}
    for n, own in fits.items():
        ordered = [solved[n][k] for k in sorted(solved[n])]
        columns = [f for f, _ in ordered if f is not None]
        factors = np.array(columns, float).reshape(len(columns), n).T
        result[n] = Whitening(own.n, np.array(own.sums, object), factors, [e for _, e in ordered])
    _measure(rows, result)
    return result


def _measure(rows: DataFrame, fits: dict[int, Whitening]) -> None:
    """Sets how far the covariance of the whitened values is from the identity."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for dimension, _, vectors in matrices(batch.column("vector")):
                # With a first column of ones, products hold the sums too.
                values = np.insert(fits[dimension].whitened(vectors), 0, 1, axis=1)
                totals[dimension] = totals.get(dimension, 0) + values.T @ values
        for dimension, total in totals.items():
            i, j = np.indices(total.shape).reshape(2, -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), dimension, np.int32)), pa.array(i), pa.array(j), pa.array(total.ravel())],
                names=["dimension", "i", "j", "total"],
            )

    added = rows.select("vector").mapInArrow(add_up, "dimension int, i int, j int, total double")
    sizes = {n: fit.factors.shape[1] + 1 for n, fit in fits.items()}
    totals = {n: np.zeros((size, size)) for n, size in sizes.items()}
    for row in added.groupBy("dimension", "i", "j").agg(F.sum("total").alias("total")).collect():
        totals[row.dimension][row.i, row.j] = row.total
    for n, fit in fits.items():
        if sizes[n] > 1:
            # Whitened values are centred exactly beforehand: their means are rounding errors.
            means = totals[n][0, 1:] / fit.n
            covariance = totals[n][1:, 1:] / fit.n - np.outer(means, means)
            fit.identity_error = float(np.abs(covariance - np.eye(len(means))).max())


def whitened_components(
    embeddings: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """``key``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``, for every row with a
    finite vector and each of the first ``components`` principal components."""
    rows = embeddings.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(finite("vector"))
    fits = fit(rows, components)
    rest = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    schema = StructType([rows.schema["key"], *StructType.fromDDL(rest).fields])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dimension, chosen, vectors in matrices(batch.column("vector")):
                own = fits[dimension]
                count, filled = len(own.explained), own.factors.shape[1]
                for at in range(0, len(vectors) if count else 0, _SLICE):
                    part = vectors[at : at + _SLICE]
                    values = np.full((len(part), count), np.nan)
                    values[:, :filled] = own.whitened(part)
                    rows = np.repeat(np.arange(len(part)), count)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("key").take(pa.array(chosen[at : at + _SLICE][rows])),
                            pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(part))),
                            pa.repeat(pa.scalar(own.n, pa.int64()), len(rows)),
                            pa.array(own.deviations(part), pa.int64()).take(pa.array(rows)),
                            pa.array(values.ravel(), pa.float64(), mask=np.isnan(values.ravel())),
                            pa.array(own.explained * len(part), pa.float64()),
                            pa.repeat(pa.scalar(own.identity_error, pa.float64()), len(rows)),
                        ],
                        names=schema.names,
                    )

    return rows.mapInArrow(apply, schema).withColumnRenamed("key", key)
