"""Distinct integers per group as bitmaps that can be kept and merged.

For few groups and dense ids, such as players over seasons: a (group, range of 32,768 ids) is one row of 4 KB however many
rows it stands for, filled on the map side. Bitmaps of parts, such as seasons, merge into those of the whole without
reading the rows again. For many small groups, or scattered ids, :func:`distinct_per_group` moves less.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.functions.columns import quoted, types_of
from lakegauge.operators.coverage import _VALUE, pooled_values

_BUCKET, _BITS = "bucket", "bits"
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def distinct_bitmaps(frame: DataFrame, group_by: Sequence[str], value_columns: Sequence[str]) -> DataFrame:
    """``group_by``, ``bucket`` and ``bits`` of the pooled values; nulls are a bucket of their own, a null one."""
    for kind in types_of(frame, value_columns):
        if kind.simpleString() not in _INTEGERS:
            raise TypeError(f"bitmaps hold integers, not {kind.simpleString()}")
    groups = list(map(quoted, group_by))
    values = pooled_values(frame, group_by, value_columns).selectExpr(
        *groups, f"bitmap_bucket_number({_VALUE}) AS {_BUCKET}", f"coalesce(bitmap_bit_position({_VALUE}), 0L) AS __bit"
    )
    return values.groupBy(*groups, _BUCKET).agg(F.expr(f"bitmap_construct_agg(__bit) AS {_BITS}"))


def merged_bitmaps(parts: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Bitmaps of the groups of ``group_by`` from bitmaps of any parts of them."""
    return parts.groupBy(*map(quoted, group_by), _BUCKET).agg(F.expr(f"bitmap_or_agg({_BITS}) AS {_BITS}"))


def distinct_counts(bitmaps: DataFrame, group_by: Sequence[str], count_as: str = "n_distinct") -> DataFrame:
    """Distinct values per group, null counting as one, from bitmaps holding each group and bucket once."""
    return bitmaps.groupBy(*map(quoted, group_by)).agg(F.expr(f"sum(bitmap_count({_BITS})) AS {quoted(count_as)}"))
