"""Arithmetic on DOUBLE money columns.

Amounts are summed as they are. The last digits of such a sum depend on the order in which partial sums
meet, so rankings compare sums rounded to ``RANK_PLACES`` and break ties by key.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

RANK_PLACES = 6


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money_sum(amount: Column | str, over: WindowSpec | None = None) -> Column:
    """Sum of a money column as DOUBLE; a window sum when ``over`` is set."""
    total = F.sum(_column(amount).cast("double"))
    return total if over is None else total.over(over)


def money_mean(amount: Column | str, over: WindowSpec | None = None) -> Column:
    """Mean of the non-null amounts, null if there are none."""
    mean = F.avg(_column(amount).cast("double"))
    return mean if over is None else mean.over(over)


def growth(current: Column, base: Column) -> Column:
    """Relative change of ``current`` against ``base``; 0 where the base is not positive."""
    return F.when(base > 0, F.try_divide(current - base, base)).otherwise(F.lit(0.0))


def money_text(amount: Column | str) -> Column:
    """Amount as text with thousands separators and two decimals."""
    return F.format_number(_column(amount), 2)
