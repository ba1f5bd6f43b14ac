"""How much of a key space a table populates, and how densely."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.functions.columns import has_null, quoted, text, types_of
from lakegauge.operators.joins import SAMPLE, attach_sample, first_keys

_VALUE = "__value"


def pooled_values(frame: DataFrame, group_by: Sequence[str], value_columns: Sequence[str]) -> DataFrame:
    """(group, ``__value``) rows with all value columns pooled as one population, in one scan."""
    kinds = types_of(frame, value_columns)
    if not kinds:
        raise ValueError("no value columns given")
    if any(kind != kinds[0] for kind in kinds):
        raise TypeError(f"pooled columns differ in type: {dict(zip(value_columns, kinds))}")
    groups = list(map(quoted, group_by))
    if len(value_columns) == 1:
        return frame.selectExpr(*groups, f"{quoted(value_columns[0])} AS {_VALUE}")
    return frame.selectExpr(*groups, f"explode(array({', '.join(map(quoted, value_columns))})) AS {_VALUE}")


def distinct_per_group(
    frame: DataFrame, group_by: Sequence[str], value_columns: Sequence[str], count_as: str = "n_distinct"
) -> DataFrame:
    """Distinct pooled values per group; null counts as one value, and null groups are kept.

    The first shuffle is spread over (group, value) and the second carries one partial count per
    group and task, so a group holding a large share of the rows is never gathered in one place.
    """
    pairs = pooled_values(frame, group_by, value_columns).distinct()
    return pairs.groupBy(*map(quoted, group_by)).agg(F.expr(f"count(*) AS {quoted(count_as)}"))


def key_coverage(
    frame: DataFrame,
    *,
    group_by: Sequence[str],
    value_columns: Sequence[str],
    name: str,
    dataset: str,
    unit: str,
    measure: str,
    reference_keys: DataFrame | None = None,
    sample: int = SAMPLE,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row on how many groups have rows, which expected ones have none, and the spread of
    distinct values per group.

    The first ``len(by) + len(group_by)`` columns of ``reference_keys`` name the expected groups; it
    may repeat them. Extreme groups are named, ties going to the smallest key. A null value counts as
    a value, and a reference key holding a null counts as missing. ``by`` gives one row per group of
    those columns from the same pass.
    """
    by, group_by = list(by), list(group_by)
    full = by + group_by
    pairs = pooled_values(frame, full, value_columns).distinct()
    found = pairs.selectExpr(*map(quoted, full), "1L AS __n", "false AS __expected")
    if reference_keys is None:
        rows = found
    else:
        names = reference_keys.columns[: len(full)]
        theirs, mine = types_of(reference_keys, names), types_of(frame, full)
        if theirs != mine:
            raise TypeError(f"reference key types {theirs} differ from {mine}")
        renamed = [f"{quoted(n)} AS {quoted(g)}" for n, g in zip(names, full)]
        rows = found.unionAll(reference_keys.selectExpr(*renamed, "0L AS __n", "true AS __expected"))
    units = rows.groupBy(*map(quoted, full)).agg(
        F.expr("sum(__n) AS __n"), F.expr("max(__expected) AS __expected")
    )

    missing = f"__expected AND (__n = 0 OR {has_null(full)})"
    key = f"struct({', '.join(map(quoted, group_by))})"
    count = "CASE WHEN __n > 0 THEN __n END"
    # The exact median buffers one entry per distinct count, not per group: at most about
    # sqrt(2 * distinct pairs) entries.
    metrics = units.groupBy(*map(quoted, by)).agg(
        F.expr("count_if(__n > 0) AS units"),
        F.expr("count_if(__expected) AS expected"),
        F.expr(f"count_if({missing}) AS missing_units"),
        F.expr(f"min(CASE WHEN __n > 0 THEN struct(__n AS n, {key} AS key) END) AS fewest"),
        F.expr(f"min(CASE WHEN __n > 0 THEN struct(-__n AS n, {key} AS key) END) AS most"),
        F.expr(f"median({count}) AS median"),
        F.expr(f"avg({count}) AS mean"),
    )
    evidence = first_keys(units.where(missing), group_by, sample, by)
    report = attach_sample(metrics, evidence, group_by, "missing_sample", by)
    expected = "report.expected" if reference_keys is not None else "CAST(NULL AS BIGINT)"
    return report.selectExpr(
        f"{text(name)} AS name",
        f"{text(dataset)} AS dataset",
        f"{text(unit)} AS unit",
        f"{text(measure)} AS measure",
        *map(quoted, by),
        "report.units",
        f"{expected} AS reference_units",
        "report.missing_units",
        "coalesce(report.fewest.n, 0L) AS minimum",
        "report.fewest.key AS minimum_key",
        "coalesce(report.median, 0D) AS median",
        "coalesce(report.mean, 0D) AS mean",
        "coalesce(-report.most.n, 0L) AS maximum",
        "report.most.key AS maximum_key",
        "missing_sample",
    )
