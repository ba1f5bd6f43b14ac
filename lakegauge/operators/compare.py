"""Whether two tables hold the same rows, and where they do not.

Both forms stack the tables and group, so duplicates are counted rather than fanned out and a key
holding many rows is reduced on the map side.

Tables kept in parts can be held against each other part by part first: a fingerprint is a row of sums over the part's
rows, so it depends on no order, is reduced on the map side and can be kept and merged. Rows are then
shuffled only for the parts that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.functions.columns import quoted


def _same_columns(a: DataFrame, b: DataFrame) -> None:
    if sorted(a.dtypes) != sorted(b.dtypes):
        raise TypeError(f"columns differ: {a.dtypes} and {b.dtypes}")


def _counted(a: DataFrame, b: DataFrame, names: Sequence[str]) -> DataFrame:
    quoted_names = list(map(quoted, names))

    def side(frame: DataFrame, left: int) -> DataFrame:
        return frame.selectExpr(*quoted_names, f"{left}L AS left_rows", f"{1 - left}L AS right_rows")

    return (
        side(a, 1)
        .unionAll(side(b, 0))
        .groupBy(*quoted_names)
        .agg(F.expr("sum(left_rows) AS left_rows"), F.expr("sum(right_rows) AS right_rows"))
    )


def row_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows whose number differs, with ``left_rows`` and ``right_rows``. Null equals null."""
    _same_columns(a, b)
    return _counted(a, b, a.columns).where("left_rows <> right_rows")


def identical(a: DataFrame, b: DataFrame) -> bool:
    """Same column names, order and types, and the same multiset of rows."""
    return a.dtypes == b.dtypes and row_differences(a, b).isEmpty()


#: A row's hash is summed in pieces, so that no sum overflows below two million million rows.
_PIECES = ((0, 22), (22, 21), (43, 21))
_SEEDS = (1, 2)
_SUMS = [f"s{seed}_{start}" for seed in _SEEDS for start, _ in _PIECES]


def fingerprints(frame: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group of the ``by`` columns: its ``rows`` and sums of two hashes of the rows' other columns.

    Equal multisets of rows have equal fingerprints; others have, but for a chance of about 2^-128, different ones. Rows of
    separate parts of a group, grouped once more by :func:`merged_fingerprints`, give the group's.
    """
    names = [n for n in frame.columns if n not in by]
    # Hashing passes over nulls, so where they stand is hashed too.
    nulls = "".join(f", isnull({quoted(n)})" for n in names)
    values = "".join(f", {quoted(n)}" for n in names)
    hashes = [f"xxhash64({seed}{values}{nulls}) AS __h{seed}" for seed in _SEEDS]
    hashed = frame.selectExpr(*map(quoted, by), *hashes)
    sums = [
        F.expr(f"sum(shiftrightunsigned(__h{seed}, {start}) & {(1 << bits) - 1}L) AS s{seed}_{start}")
        for seed in _SEEDS
        for start, bits in _PIECES
    ]
    return hashed.groupBy(*map(quoted, by)).agg(F.expr("count(*) AS rows"), *sums)


def merged_fingerprints(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Fingerprints of the groups of ``by`` from fingerprints of any parts of them."""
    return parts.groupBy(*map(quoted, by)).agg(*(F.expr(f"sum({n}) AS {n}") for n in ("rows", *_SUMS)))


def compare_parts(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group of ``by`` of either table: ``left_rows``, ``right_rows`` and whether they are ``equal``."""
    _same_columns(a, b)
    sides = fingerprints(a, by).selectExpr("*", "1 AS __side", "rows AS left_rows", "0L AS right_rows").unionByName(
        fingerprints(b.select(*a.columns), by).selectExpr("*", "-1 AS __side", "0L AS left_rows", "rows AS right_rows")
    )
    off = " OR ".join(f"coalesce(sum(__side * {n}), 0) <> 0" for n in ("rows", *_SUMS))
    return sides.groupBy(*map(quoted, by)).agg(
        F.expr("sum(left_rows) AS left_rows"), F.expr("sum(right_rows) AS right_rows"), F.expr(f"NOT ({off}) AS equal")
    )


def row_differences_by_part(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """:func:`row_differences`, of which only rows in groups of ``by`` with unequal fingerprints are shuffled."""
    parts = compare_parts(a, b, by).where("NOT equal")
    unequal = parts.selectExpr(*(f"{quoted(n)} AS {quoted('__' + n)}" for n in by))

    def within(frame: DataFrame) -> DataFrame:
        return frame.join(unequal, [F.col(quoted(n)).eqNullSafe(F.col(quoted("__" + n))) for n in by], "left_semi")

    return row_differences(within(a), within(b))


def compare_by_key(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key of either table with its ``status``.

    ``left_only`` and ``right_only`` keys are absent from the other table; ``match`` keys carry the
    same multiset of remaining values on both sides, ``mismatch`` keys do not.
    """
    _same_columns(a, b)
    values = _counted(a, b, a.columns)
    keys = values.groupBy(*map(quoted, key)).agg(
        F.expr("sum(left_rows) AS left_rows"),
        F.expr("sum(right_rows) AS right_rows"),
        F.expr("max(left_rows <> right_rows) AS __differs"),
    )
    status = (
        "CASE WHEN right_rows = 0 THEN 'left_only' WHEN left_rows = 0 THEN 'right_only' "
        "WHEN __differs THEN 'mismatch' ELSE 'match' END AS status"
    )
    return keys.selectExpr(*map(quoted, key), "left_rows", "right_rows", status)


def status_counts(compared: DataFrame) -> DataFrame:
    """Number of keys per status."""
    return compared.groupBy("status").agg(F.expr("count(*) AS n"))
