"""Small helpers over column names.

Operators state their projections as SQL text where they can: a text is one call to the JVM, a tree
of columns one call per node, and building a report from trees took longer than planning it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as SQL text, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """Reference to a column by its exact name."""
    return F.col(quoted(name))


def text(value: str) -> str:
    """A string literal as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def has_null(names: Sequence[str]) -> str:
    """Condition true where any of the columns is null; such a key never matches another key."""
    return "(" + " OR ".join(f"{quoted(name)} IS NULL" for name in names) + ")"


def types_of(frame: DataFrame, names: Sequence[str]) -> list:
    fields = {field.name: field.dataType for field in frame.schema.fields}
    return [fields[n] if n in fields else frame.select(column(n)).schema[0].dataType for n in names]
