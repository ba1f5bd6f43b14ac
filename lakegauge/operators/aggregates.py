"""The small aggregates the pipeline leans on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.functions.columns import column


def group_sum(frame: DataFrame, group_by: Sequence[str], value: str, name: str) -> DataFrame:
    return frame.groupBy(*map(column, group_by)).agg(F.sum(column(value)).alias(name))


def filtered_min(frame: DataFrame, condition: Column, value: str, name: str) -> DataFrame:
    """Smallest ``value`` among the rows meeting ``condition``; the filter reaches the file scan."""
    return frame.where(condition).agg(F.min(column(value)).alias(name))
