"""Averages that do not depend on the order of summation.

A sum of doubles differs with the order in which partitions arrive, and a rounded
average then flips in its last digit between runs.  Decimal sums are exact, so
a retried task, another partition count or a roll-up of partial sums all give the
same result.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Places kept of every value.  22 digits before the point are left, and the sum has room for 10**10 values.
SCALE = 6


def _odd(column: str) -> Column:
    """Whether a value is NaN or infinite, which no decimal can be."""
    value = F.col(column).cast("double")
    return F.isnan(value) | (F.abs(value) == float("inf"))


def decimal_total(column: str, scale: int = SCALE) -> Column:
    """Exact sum of a numeric column (aggregate), NaN and infinities aside."""
    exact = F.when(~_odd(column), F.col(column)).cast(f"decimal({22 + scale},{scale})")
    return F.sum(exact)


def exact_mean(total: Column, n: Column, digits: int, scale: int = SCALE) -> Column:
    """``total / n`` rounded half up, as double; NULL where ``n`` is 0.

    Rounded once, by the remainder: what the total holds beyond a multiple of ``n`` steps of the last digit is at least half of
    them or not.  Rounding a quotient would round twice, and lift a mean just below a tie.
    """
    if scale > SCALE:
        # One digit less before the point, or a subtraction would drop the last one behind it.
        total = total.cast(f"decimal(37,{scale})")
    many = F.nullif(n, F.lit(0)).cast("decimal(19,0)")
    step = F.lit(Decimal(1).scaleb(-digits))
    rest = total % (many * step)
    # The division comes out even within the total's scale, which is no less than the digits.
    whole = ((total - rest) / many).cast(f"decimal({23 + scale},{scale})")
    up = F.when(F.abs(rest) * 2 >= many * step, F.signum(rest).cast("decimal(1,0)") * step).otherwise(0)
    return (whole + up).cast("double")


@dataclass(frozen=True)
class Average:
    """A rounded average of one column, over rows or over partial sums.

    Values are taken to ``scale`` decimal places, which has to suit the digits asked for.  A NaN or an infinity
    makes the average NaN, as it does a plain one; NULL values do not count.
    """

    column: str
    digits: int
    scale: int = SCALE

    def __post_init__(self) -> None:
        if not 0 <= self.digits <= self.scale <= 10:
            raise ValueError("an average needs digits within its scale, and a scale of at most 10")

    @property
    def name(self) -> str:
        return f"average_{self.column}"

    @property
    def _total(self) -> str:
        return f"{self.column}_total"

    @property
    def _n(self) -> str:
        return f"{self.column}_n"

    @property
    def _has_odd(self) -> str:
        return f"{self.column}_odd"

    def _rounded(self, total: Column, n: Column, odd: Column) -> Column:
        mean = exact_mean(total, n, self.digits, self.scale)
        return F.when(odd, float("nan")).otherwise(mean).alias(self.name)

    def of_rows(self) -> Column:
        odd = F.bool_or(_odd(self.column))
        return self._rounded(decimal_total(self.column, self.scale), F.count(self.column), odd)

    def partials(self) -> list[Column]:
        return [
            decimal_total(self.column, self.scale).alias(self._total),
            F.count(self.column).alias(self._n),
            F.bool_or(_odd(self.column)).alias(self._has_odd),
        ]

    def merged(self) -> list[Column]:
        """Partial sums of partial sums."""
        return [
            F.sum(self._total).cast(f"decimal(38,{self.scale})").alias(self._total),
            F.sum(self._n).alias(self._n),
            F.bool_or(self._has_odd).alias(self._has_odd),
        ]

    def of_partials(self) -> Column:
        return self._rounded(F.sum(self._total), F.sum(self._n), F.bool_or(self._has_odd))
