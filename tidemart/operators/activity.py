"""Universe of entities seen in facts or listed in a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def activity_by_period(
    facts: DataFrame, entity: str, base: str, at: str, code: str, period: str | None = None
) -> DataFrame:
    """Activity per entity, per period of a date ``at``: what `entity_activity` adds up.

    Without a ``period`` the whole time is one. Days of different periods differ, so
    counts of days add up over periods.
    """
    of = [F.trunc(at, period).alias("period")] if period else []
    observed = facts.groupBy(F.col(entity).alias(code), *of).agg(
        F.min(at).alias("first_at"),
        F.max(at).alias("last_at"),
        F.countDistinct(at).alias("n_at"),
    )
    bases = facts.select(F.col(base).alias(code), *of).distinct().withColumn("is_base", F.lit(True))
    return observed.unionByName(bases, allowMissingColumns=True)


def entity_activity(
    facts: DataFrame | None,
    catalog: DataFrame,
    entity: str,
    base: str,
    at: str,
    code: str,
    name: str,
    names: dict[str, str] | None = None,
    periods: DataFrame | None = None,
) -> DataFrame:
    """One row per entity observed, used as a base, or listed in the catalog.

    Entities the catalog no longer lists stay, so old facts keep a parent. The
    three sources are tagged, united and grouped once instead of being united
    and joined back three times; observed entities are already aggregated then.
    ``periods``, from `activity_by_period`, stand for the facts where they are stored.
    """
    if periods is None:
        periods = activity_by_period(facts, entity, base, at, code)
    listed = catalog.select(code, name).withColumn("is_listed", F.lit(True))
    tagged = periods.unionByName(listed, allowMissingColumns=True)
    grouped = tagged.groupBy(code).agg(
        F.max(name).alias(name),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.coalesce(F.sum("n_at"), F.lit(0)).cast("bigint").alias("n_at"),
        F.max("is_listed").isNotNull().alias("is_listed"),
        F.max("is_base").isNotNull().alias("is_base"),
    )
    return grouped.withColumnsRenamed(names or {})
