"""Column drift: do the headers met name exactly the declared columns?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class SchemaDrift(ValueError):
    """A file's columns are not the declared ones."""


def header_drift(headers: DataFrame, declared: Sequence[str]) -> DataFrame:
    """Rows of ``headers`` (``name``, ``columns``) that drift, with sorted ``missing`` and ``unexpected``.

    Names compare case-sensitively and order is free. A repeated header is unexpected.
    """
    expected = F.array(*map(F.lit, declared))
    repeated = F.filter(
        F.array_distinct("columns"), lambda c: F.size(F.filter("columns", lambda other: other == c)) > 1
    )
    drift = headers.select(
        "name",
        F.sort_array(F.array_except(expected, "columns")).alias("missing"),
        F.sort_array(F.array_union(F.array_except("columns", expected), repeated)).alias("unexpected"),
    )
    return drift.where((F.size("missing") > 0) | (F.size("unexpected") > 0))


def require_no_drift(headers: DataFrame, declared: Sequence[str], shown: int = 5) -> None:
    """Raise :class:`SchemaDrift` naming the first few drifting files, in name order."""
    found = header_drift(headers, declared).orderBy("name").limit(shown).collect()
    if found:
        raise SchemaDrift(
            "; ".join(f"{r.name}: missing={r.missing} unexpected={r.unexpected}" for r in found)
        )
