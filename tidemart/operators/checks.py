"""Data-quality checks: each yields the rows that break a rule."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tidemart.functions import instant_to_local, reciprocal_error, utc_to_local

WARN = "warn"
ERROR = "error"
N_RECORDS, HAS_PARENT = "n_records", "has_parent"


@dataclass(frozen=True, eq=False)
class Check:
    """A rule and what to do about its violations.

    * A rule over single rows is a ``breaks`` expression; all such rules of a table are
      counted in one scan.
    * A rule over equal values of some columns has ``keys``, and ``breaks`` over the
      groups: their values, ``n_records`` and, with a ``parent``, ``has_parent``. All
      such rules are counted in one more scan, by grouping sets. ``parent`` has the
      columns ``keys``; null values have none.
    * Any other rule is a ``find`` function from the table to its violations.

    ``weight`` names a column of the violations that says how many rows each stands for.
    """

    name: str
    breaks: Column | None = None
    find: Callable[[DataFrame], DataFrame] | None = None
    severity: str = WARN
    weight: str | None = None
    keys: tuple[str, ...] = ()
    parent: DataFrame | None = None

    def violations(self, df: DataFrame) -> DataFrame:
        if self.find is not None:
            return self.find(df)
        if not self.keys:
            return df.filter(self.breaks)
        groups = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias(N_RECORDS))
        if self.parent is not None:
            # Equal values are counted first, so that a value which most rows share
            # costs no more than a rare one.
            orphans = groups.join(self.parent, list(self.keys), "left_anti")
            groups = orphans.withColumn(HAS_PARENT, F.lit(False))
        return groups.filter(self.breaks).drop(HAS_PARENT)


def not_null(column: str, severity: str = WARN) -> Check:
    return Check(f"not_null_{column}", breaks=F.col(column).isNull(), severity=severity)


def unique(column: str, severity: str = WARN) -> Check:
    """Repeated values with their row counts; nulls may repeat."""
    breaks = F.col(column).isNotNull() & (F.col(N_RECORDS) > 1)
    return Check(f"unique_{column}", breaks=breaks, keys=(column,), severity=severity)


def unique_combination(columns: Sequence[str], severity: str = WARN) -> Check:
    return Check(
        f"unique_combination_{'_'.join(columns)}",
        breaks=F.col(N_RECORDS) > 1,
        keys=tuple(columns),
        severity=severity,
    )


def between(
    column: str,
    minimum: object = None,
    maximum: object = None,
    strictly: bool = False,
    severity: str = WARN,
) -> Check:
    """Values outside the bounds (on them too, if ``strictly``); nulls pass."""
    value, breaks = F.col(column), F.lit(False)
    if minimum is not None:
        breaks = breaks | (value <= minimum if strictly else value < minimum)
    if maximum is not None:
        breaks = breaks | (value >= maximum if strictly else value > maximum)
    return Check(f"between_{column}", breaks=breaks, severity=severity)


def length_equals(column: str, n: int, severity: str = WARN) -> Check:
    return Check(f"length_{column}", breaks=F.length(column) != n, severity=severity)


def relationships(
    child: str, parent: DataFrame, parent_key: str, severity: str = WARN
) -> Check:
    """Child values without a parent row, with their row counts; nulls pass."""
    return Check(
        f"relationships_{child}",
        breaks=F.col(child).isNotNull() & ~F.col(HAS_PARENT),
        keys=(child,),
        parent=parent.select(F.col(parent_key).alias(child)),
        severity=severity,
        weight=N_RECORDS,
    )


def reciprocal_coherence(
    value: str, inverse: str, tolerance: float = 1e-8, severity: str = WARN
) -> Check:
    breaks = reciprocal_error(F.col(value), F.col(inverse)) > F.lit(tolerance)
    return Check(f"reciprocal_{value}", breaks=breaks, severity=severity)


def no_future(column: str, today: date | None = None, severity: str = WARN) -> Check:
    """Days later than ``today`` (the session's date by default) with row counts."""
    limit = F.current_date() if today is None else F.lit(today)
    return Check(f"no_future_{column}", breaks=F.col(column) > limit, keys=(column,), severity=severity)


def session_timezone(expected: str, at: str | None = None, severity: str = WARN) -> Check:
    """One row when the session runs in another zone than the project's.

    With ``at``, a time (one without a zone counts as UTC): the days, by the session, of
    rows that the project's zone puts on another day, with their row counts.
    """
    zones = (F.current_timezone().alias("session_zone"), F.lit(expected).alias("expected_zone"))
    differ = F.current_timezone() != F.lit(expected)

    def find(df: DataFrame) -> DataFrame:
        if at is None:
            return df.sparkSession.range(1).select(*zones).filter(differ)
        is_instant = isinstance(df.schema[at].dataType, TimestampType)
        local = instant_to_local if is_instant else utc_to_local
        days = df.select(
            *zones,
            F.to_date(local(F.col(at), F.current_timezone())).alias("session_day"),
            F.to_date(local(F.col(at), expected)).alias("expected_day"),
        )
        moved = days.filter(differ & (F.col("session_day") != F.col("expected_day")))
        return moved.groupBy(*days.columns).agg(F.count(F.lit(1)).alias(N_RECORDS))

    weight = N_RECORDS if at else None
    return Check("session_timezone", find=find, severity=severity, weight=weight)


def custom(
    name: str, rule: Column | Callable[[DataFrame], DataFrame], severity: str = WARN
) -> Check:
    """Rows for which an expression holds, or any query that returns violations."""
    if isinstance(rule, Column):
        return Check(name, breaks=rule, severity=severity)
    return Check(name, find=rule, severity=severity)
