"""Sequence features per group: the previous value and the running total.

A window gathers each group in one task, which is right for games of a few hundred events and wrong
for a group holding a large share of the table. So every group is cut into consecutive blocks along
its order, the window runs per block, and one small row per block carries the last value or the total
across the cut. A row starts a block if its group and order values hash to it, one row in
``block_rows`` on average. Small groups are rarely cut, large ones into blocks of about that size, and
a retried task finds the same cuts. Results do not depend on the cuts. Building the operators starts
no job, but for totals of floating-point values; where no row is drawn, the joins with cuts and carries are dropped
at run time.

The order has to tell the rows of a group apart: equal positions raise when the result is read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from lakegauge.functions.columns import column, types_of
from lakegauge.functions.exact import ExactSum
from lakegauge.operators.skew import join_bounded

# Rows of a block, on average.
BLOCK_ROWS = 5_000_000

# Cuts of a table, on average: larger tables get larger blocks, since cuts and carries are broadcast.
_MOST_CUTS = 1 << 17

# Cuts are looked up in two steps so that no row carries an array longer than this.
_FAN = 256

_BLOCK = "__block"


def _position(order_by: Sequence[str]) -> Column:
    return F.struct(*(column(name).alias(f"o{i}") for i, name in enumerate(order_by)))


def _located(bounds: str) -> Column:
    """Number of sorted ``bounds`` at or below the row's ``__position``, found by halving."""
    return F.expr(
        f"""
        CASE WHEN {bounds} IS NULL THEN 0 ELSE aggregate(
            sequence(1, length(bin(size({bounds})))),
            named_struct('lo', 0, 'hi', size({bounds})),
            (s, i) -> CASE
                WHEN s.lo >= s.hi THEN s
                WHEN {bounds}[shiftright(s.lo + s.hi, 1)] <= __position
                    THEN named_struct('lo', shiftright(s.lo + s.hi, 1) + 1, 'hi', s.hi)
                ELSE named_struct('lo', s.lo, 'hi', shiftright(s.lo + s.hi, 1)) END,
            s -> s.lo) END
        """
    )


def _cuts(
    frame: DataFrame, group_by: Sequence[str], order_by: Sequence[str], block_rows: int
) -> DataFrame:
    """Order positions (``__position``, numbered by ``__cut``) that blocks start at.

    Their number is about the table's rows over ``block_rows``, ``_MOST_CUTS`` at most, however the
    rows are spread over the groups.
    """
    names = list(dict.fromkeys([*group_by, *order_by]))
    rows = frame.select(F.count(F.lit(1))).scalar()
    one_in = F.greatest(F.lit(int(block_rows)).cast("long"), F.ceil(rows / F.lit(_MOST_CUTS)))
    drawn = frame.select(*map(column, names)).where(F.pmod(F.xxhash64(*map(column, names)), one_in) == 0)
    positions = drawn.select(*map(column, group_by), _position(order_by).alias("__position")).distinct()
    ranked = Window.partitionBy(*map(column, group_by)).orderBy("__position")
    return positions.withColumn("__cut", F.row_number().over(ranked) - 1)


@dataclass(frozen=True)
class _Blocks:
    """Block numbering of a table: 0 throughout a group without cuts."""

    group_by: Sequence[str]
    order_by: Sequence[str]
    cuts: DataFrame

    def number(self, rows: DataFrame) -> DataFrame:
        """Add the block number to rows of the table."""
        groups = list(map(column, self.group_by))
        is_coarse = (F.col("__cut") % _FAN == 0) & (F.col("__cut") > 0)
        coarse = self.cuts.where(is_coarse).groupBy(*groups)
        cell = F.expr(f"CAST(__cut DIV {_FAN} AS INT) AS __cell")
        fine = self.cuts.where(~is_coarse).groupBy(*groups, cell)
        sorted_cuts = F.expr("array_sort(collect_list(__position))")

        rows = rows.withColumn("__position", _position(self.order_by))
        rows = join_bounded(rows, coarse.agg(sorted_cuts.alias("__coarse")), self.group_by, "left")
        rows = rows.withColumn("__cell", _located("__coarse")).drop("__coarse")
        rows = join_bounded(rows, fine.agg(sorted_cuts.alias("__fine")), [*self.group_by, "__cell"], "left")
        rows = rows.withColumn(_BLOCK, F.col("__cell") * (_FAN + 1) + _located("__fine"))
        return rows.drop("__cell", "__fine", "__position")

    def carry(self, frame: DataFrame, rows: DataFrame, summary: Column, across: Column) -> DataFrame:
        """Attach ``__carry`` to ``rows``: each block's ``summary``, moved ``across`` its group's blocks.

        Only rows of groups with a cut are summarised, so the joined table has at most two rows per cut.
        """
        groups = self.cuts.where("__cut = 0").select(*map(column, self.group_by))
        cut = self.number(join_bounded(frame, groups, self.group_by, "inner"))
        per_block = cut.groupBy(*map(column, self.group_by), _BLOCK).agg(summary.alias("__summary"))
        moved = per_block.select(*map(column, self.group_by), _BLOCK, across.alias("__carry"))
        return join_bounded(rows, moved, [*self.group_by, _BLOCK], "left")


def _blocks(
    frame: DataFrame, group_by: Sequence[str], order_by: Sequence[str], block_rows: int
) -> _Blocks:
    return _Blocks(group_by, order_by, _cuts(frame, group_by, order_by, block_rows))


def _told_apart(order_by: Sequence[str], in_order: WindowSpec, result: Column) -> Column:
    """``result``, unless the row before has the same position. Equal positions lie in one block."""
    position = _position(order_by)
    tie = F.lag(position).over(in_order).eqNullSafe(position)
    message = f"rows of one group are equal in {', '.join(order_by)}; the order has to tell them apart"
    return F.when(tie, F.raise_error(F.lit(message))).otherwise(result)


def previous_value(
    frame: DataFrame,
    value: str,
    *,
    group_by: Sequence[str],
    order_by: Sequence[str],
    name: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``name``: ``value`` of the row before in the same group, null on a group's first row.

    Order is ascending with nulls first and identifies a row within its group.
    """
    blocks = _blocks(frame, group_by, order_by, block_rows)
    blocked = blocks.number(frame)
    window = Window.partitionBy(*map(column, [*group_by, _BLOCK])).orderBy(*map(column, order_by))
    within = _told_apart(order_by, window, F.lag(column(value)).over(window))
    rows = blocked.withColumns({"__within": within, "__row": F.row_number().over(window)})
    in_turn = Window.partitionBy(*map(column, group_by)).orderBy(_BLOCK)
    last = F.max_by(column(value), _position(order_by))
    rows = blocks.carry(frame, rows, last, F.lag("__summary").over(in_turn))
    result = F.when(F.col("__row") == 1, F.col("__carry")).otherwise(F.col("__within"))
    return rows.withColumn(name, result).drop("__within", "__row", "__carry", _BLOCK)


def running_total(
    frame: DataFrame,
    value: str,
    *,
    group_by: Sequence[str],
    order_by: Sequence[str],
    name: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the group's rows up to and including this one.

    A row whose value is null has a null total; the rows after it carry on from the sum before it.
    A total of floating-point values is a DOUBLE, the one nearest to the exact sum, wherever a group is cut; how
    their bits are split is read from the column when the operator is built.
    """
    kind = types_of(frame, [value])[0]
    exact = ExactSum.of(frame, value) if isinstance(kind, (DoubleType, FloatType)) else None
    if exact:
        frame = frame.withColumn("__split", exact.split(value))
        named = {f"__{n}": F.col(f"__split.{n}") for n in exact.names}
    else:
        named = {"__whole": column(value)}
    blocks = _blocks(frame, group_by, order_by, block_rows)
    blocked = blocks.number(frame)
    in_order = Window.partitionBy(*map(column, [*group_by, _BLOCK])).orderBy(*map(column, order_by))
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    has_value = column(value).isNotNull()
    within = {n: F.sum(part).over(upto) for n, part in named.items()}
    first = next(iter(within))
    rows = blocked.withColumns(within | {first: _told_apart(order_by, in_order, within[first])})
    before = (
        Window.partitionBy(*map(column, group_by))
        .orderBy(_BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summary = F.struct(*(F.sum(part).alias(n) for n, part in named.items()))
    across = F.struct(*(F.sum(f"__summary.{n}").over(before).alias(n) for n in named))
    rows = blocks.carry(frame, rows, summary, across)
    carried = {f.name: f.dataType for f in rows.schema["__carry"].dataType.fields}
    totals = {n: F.col(n) + F.coalesce(F.col(f"__carry.{n}"), F.lit(0).cast(carried[n])) for n in named}
    if exact:
        rows = rows.withColumn("__sums", F.struct(*(totals[f"__{n}"].alias(n) for n in exact.names)))
        total = exact.rounded("__sums")
    else:
        total = totals[first]
    return rows.withColumn(name, F.when(has_value, total)).drop(*named, "__carry", "__split", "__sums", _BLOCK)
