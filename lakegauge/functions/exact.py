"""Sums of doubles that do not depend on the order of addition.

A double is split without error into whole numbers of fixed powers of two, 32 bits apart. These are added as whole
numbers, in any order and grouping, and the sum of all is rounded to a double once. Which powers occur is asked of the
column beforehand, so that a column of ordinary amounts needs three or four.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.functions.columns import column, quoted

_BITS = 32
_UNUSUAL = ("nan", "up", "down")


def _power(exponent: str) -> str:
    """SQL of a power of two in two factors, neither of which leaves the range of doubles."""
    return f"pow(2D, floor(({exponent}) / 2)) * pow(2D, ({exponent}) - floor(({exponent}) / 2))"


@dataclass(frozen=True)
class ExactSum:
    """How a column is split: whole numbers of ``2**(32 * b)`` for ``b`` from ``low`` to ``high``."""

    low: int
    high: int

    @classmethod
    def of(cls, frame: DataFrame, name: str) -> ExactSum:
        """Reads the column once."""
        value = F.abs(column(name).cast("double"))
        usual = F.when((value > 0) & (value < float("inf")), value)
        least, most = frame.agg(F.min(usual), F.max(usual)).first()
        if least is None:
            return cls(0, 0)
        # The last of 53 bits, and the first.
        return cls((math.frexp(least)[1] - 53) // _BITS, (math.frexp(most)[1]) // _BITS)

    def split(self, name: str) -> Column:
        """The column's values as structs of parts."""
        exponents = ", ".join(str(_BITS * b) for b in range(self.high, self.low - 1, -1))
        # Factors are applied one by one: their product may leave the range that the result lies in.
        up, down = "pow(2D, floor(e / 2))", "pow(2D, e - floor(e / 2))"
        whole = f"CAST(s.r / {up} / {down} AS BIGINT)"
        digits = (
            f"aggregate(array({exponents}), named_struct('r', v, 'd', CAST(array() AS ARRAY<BIGINT>)), "
            # Exact: what is taken off are the first bits of what is left.
            f"(s, e) -> named_struct('r', s.r - CAST({whole} AS DOUBLE) * {up} * {down}, 'd', array_append(s.d, {whole})), "
            f"s -> reverse(s.d))"
        )
        usual = f"transform(array(IF(abs(v) < double('inf'), v, 0D)), v -> {digits})[0]"
        fields = ", ".join(f"'{n}', CAST(d[{i}] AS DECIMAL(38,0))" for i, n in enumerate(self._digits()))
        counts = ", ".join(
            f"'{n}', CAST(IF({test}, 1, 0) AS DECIMAL(38,0))"
            for n, test in zip(_UNUSUAL, ("isnan(v)", "v = double('inf')", "v = double('-inf')"), strict=True)
        )
        struct = f"transform(array({usual}), d -> named_struct({fields}, {counts}))[0]"
        return F.expr(f"transform(array(CAST({quoted(name)} AS DOUBLE)), v -> IF(v IS NULL, NULL, {struct}))[0]")

    @property
    def names(self) -> list[str]:
        """Of the parts: whole numbers from the lowest power on, and counts of unusual values."""
        return [*self._digits(), *_UNUSUAL]

    def _digits(self) -> list[str]:
        return [f"b{i}" for i in range(self.high - self.low + 1)]

    def rounded(self, sums: str) -> Column:
        """The double nearest to the sum whose parts are the fields of the struct ``sums``; ties to even."""
        return F.expr(
            f"""
            CASE WHEN {sums}.nan > 0 OR ({sums}.up > 0 AND {sums}.down > 0) THEN double('nan')
                 WHEN {sums}.up > 0 THEN double('inf') WHEN {sums}.down > 0 THEN double('-inf')
                 ELSE {self._nearest(self._carried(sums, ""))} - {self._nearest(self._carried(sums, "-"))} END
            """
        )

    def _carried(self, sums: str, sign: str) -> str:
        """The digits of the sum or of its negative, the last of which holds the sign and all that is left."""
        digits = ", ".join(f"{sign}coalesce({sums}.{n}, CAST(0 AS DECIMAL(38,0)))" for n in self._digits())
        base = f"CAST({1 << _BITS} AS DECIMAL(38,0))"
        step = (
            f"(s, x) -> named_struct('d', array_append(s.d, CAST(pmod(s.c + x, {base}) AS DECIMAL(38,0))), "
            f"'c', CAST((s.c + x - pmod(s.c + x, {base})) DIV {base} AS DECIMAL(38,0)))"
        )
        start = "named_struct('d', CAST(array() AS ARRAY<DECIMAL(38,0)>), 'c', CAST(0 AS DECIMAL(38,0)))"
        return f"aggregate(array({digits}), {start}, {step}, s -> array_append(s.d, s.c))"

    def _nearest(self, digits: str) -> str:
        """The double nearest to a number of these digits, zero if it is negative."""
        # Three digits from the first that is not zero hold over 64 bits. Whether anything follows is told by an odd
        # last one, far below the last bit of the double, so that rounding them rounds the whole.
        top = "array_max(transform(d, (x, i) -> IF(x <> 0, i, 0)))"
        lead = (
            "CAST(get(d, j) * 18446744073709551616BD + coalesce(get(d, j - 1), 0BD) * 4294967296BD "
            "+ coalesce(get(d, j - 2), 0BD) "
            "+ IF(coalesce(get(d, j - 2), 0BD) % 2 = 0 AND j > 2 AND exists(slice(d, 1, greatest(j - 2, 0)), x -> x <> 0), 1BD, 0BD) "
            "AS DECIMAL(38,0))"
        )
        scaled = f"CAST({lead} AS DOUBLE) * {_power(f'{_BITS} * ({self.low} + j - 2)')}"
        chosen = f"transform(array({top}), j -> {scaled})[0]"
        return f"transform(array({digits}), d -> IF(get(d, size(d) - 1) < 0, 0D, {chosen}))[0]"
