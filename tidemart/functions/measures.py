"""Measures over an observed value and its predecessor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reciprocal(value: Column) -> Column:
    """``1 / value``, not rounded: ``DECIMAL(20,8)`` gives ``DECIMAL(30,21)``.

    Values span seven orders of magnitude, so a fixed number of decimals would
    lose significant digits of the large ones.
    """
    return F.lit(1).cast("decimal(1,0)") / value


def reciprocal_error(value: Column, inverse: Column) -> Column:
    return F.abs(value * inverse - 1)


def pct_change(current: Column, previous: Column, scale: int = 6) -> Column:
    """Percent change, null without a predecessor."""
    change = F.round(F.lit(100) * (current - previous) / previous, scale)
    return F.when(previous.isNotNull(), change)


def guarded_pct_change(current: Column, previous: Column, scale: int = 6) -> Column:
    """Percent change, null also for a zero predecessor (ANSI division raises)."""
    change = F.round(F.lit(100) * (current - previous) / previous, scale)
    return F.when(previous.isNotNull() & (previous != 0), change)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)
