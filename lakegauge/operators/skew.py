"""Joining tables small enough to broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.functions.columns import quoted


def join_bounded(frame: DataFrame, bounded: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Broadcast join on the columns ``names`` with a table of bounded size holding each key once; a
    null key meets the null key."""
    renamed = {name: f"__g{i}" for i, name in enumerate(names)}
    bounded = bounded.withColumnsRenamed(renamed)
    same = F.expr(" AND ".join(f"{quoted(name)} <=> {alias}" for name, alias in renamed.items()))
    return frame.join(F.broadcast(bounded), same, how).drop(*renamed.values())
