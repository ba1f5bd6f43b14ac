"""Strict casts: a value that does not fit its declared type fails the job instead of turning null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, LongType, StringType, StructType

from lakegauge.functions.columns import column

# Spark's own cast also takes surrounding blanks and Java suffixes such as 1.0d, so the accepted
# texts are stated here and the cast only converts them. Both Java and RE2 read these patterns.
ACCEPTED = {
    LongType(): r"^[+-]?[0-9]+$",
    DoubleType(): r"^(?:[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
    r"|[+-]?(?i:inf|infinity)|(?i:nan))$",
}


def strict_cast(text: Column, to: DataType, label: str) -> Column:
    """Cast a string column: null stays null, a misfit (overflow included) raises naming ``label``."""
    if to == StringType():
        return text
    if to not in ACCEPTED:
        raise TypeError(f"{label}: no strict cast to {to.simpleString()}")
    fits = F.when(text.rlike(ACCEPTED[to]), text.try_cast(to))
    misfit = F.raise_error(F.concat(F.lit(f"{label} does not fit {to.simpleString()}: "), text)).cast(to)
    return F.when(text.isNotNull(), F.coalesce(fits, misfit))


def apply_schema(frame: DataFrame, schema: StructType, *keep: str) -> DataFrame:
    """Strictly type an all-string frame, in declared column order.

    Spark skips casts whose column is not read, so a bad value surfaces when the frame is written
    or fully read, not on ``count()``. ``keep`` names extra columns passed through in front.
    """
    typed = [strict_cast(column(f.name), f.dataType, f.name).alias(f.name) for f in schema.fields]
    return frame.select(*(column(name) for name in keep), *typed)
