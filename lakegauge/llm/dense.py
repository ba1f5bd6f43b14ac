"""Columns of dense vectors as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether a vector is given and all its components are given and finite."""
    usable = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & usable


def matrices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per dimension: the rows having it, and their vectors as a matrix. All rows hold a vector without nulls."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.array([len(v) for v in column], np.int64) if column.null_count else np.diff(column.offsets.to_numpy())
    starts = np.cumsum(sizes) - sizes
    for dimension in np.unique(sizes).tolist():
        chosen = np.flatnonzero(sizes == dimension)
        places = starts[chosen, None] + np.arange(dimension)
        yield dimension, chosen, values[places].reshape(len(chosen), dimension)
