"""Freshness and raw-table diagnostics."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import moment
from tidemart.specs import INGESTED_AT, TableSpec

# Age limits in hours that must equal the reference's (fixed values).
WARN_AFTER_HOURS = 30
ERROR_AFTER_HOURS = 72


def freshness(
    df: DataFrame,
    loaded_at: str = INGESTED_AT,
    as_of: datetime | None = None,
    warn_after: int = WARN_AFTER_HOURS,
    error_after: int = ERROR_AFTER_HOURS,
) -> DataFrame:
    """``(max_loaded_at, age_hours, status)``; an empty table is an error.

    Limits are compared with the exact age; ``age_hours`` is in whole hours.
    """
    now = F.current_timestamp() if as_of is None else moment(as_of, df.schema[loaded_at].dataType)
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = now - F.col("max_loaded_at")

    def hours(n: int):
        return F.make_dt_interval(F.lit(0), F.lit(n))

    status = (
        F.when(F.col("max_loaded_at").isNull() | (age > hours(error_after)), "error")
        .when(age > hours(warn_after), "warn")
        .otherwise("pass")
    )
    return newest.select(
        "max_loaded_at",
        F.timestamp_diff("HOUR", F.col("max_loaded_at"), now).alias("age_hours"),
        status.alias("status"),
    )


_PROFILE = (
    "`table` STRING, is_missing BOOLEAN, n_rows BIGINT, n_duplicate_keys BIGINT, "
    "cursor_min STRING, cursor_max STRING, n_null_cursors BIGINT, n_problems INT"
)


def _profile(df: DataFrame, spec: TableSpec) -> DataFrame:
    cursor = F.col(spec.cursor) if spec.cursor else F.lit(None).cast("string")
    # Counting per key first gives rows, duplicates and cursor range in one pass.
    by_key = df.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(cursor).alias("lo"),
        F.max(cursor).alias("hi"),
        F.count_if(cursor.isNull()).alias("nulls"),
    )
    totals = by_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_if(F.col("n") > 1).alias("n_duplicate_keys"),
        F.min("lo").cast("string").alias("cursor_min"),
        F.max("hi").cast("string").alias("cursor_max"),
        (F.coalesce(F.sum("nulls"), F.lit(0)) if spec.cursor else F.lit(None).cast("bigint")).alias(
            "n_null_cursors"
        ),
    )
    problems = (F.col("n_duplicate_keys") > 0).cast("int") + F.coalesce(
        (F.col("n_null_cursors") > 0).cast("int"), F.lit(0)
    )
    return totals.select(
        F.lit(spec.name).alias("table"),
        F.lit(False).alias("is_missing"),
        "n_rows",
        "n_duplicate_keys",
        "cursor_min",
        "cursor_max",
        "n_null_cursors",
        problems.alias("n_problems"),
    )


def raw_profile(
    spark: SparkSession, tables: Mapping[TableSpec, DataFrame | None]
) -> DataFrame:
    """One row per declared table; None stands for a table that does not exist."""
    absent = [
        (spec.name, True, None, None, None, None, None, 1)
        for spec, df in tables.items()
        if df is None
    ]
    profile = spark.createDataFrame(absent, _PROFILE)
    for spec, df in tables.items():
        if df is not None:
            profile = profile.unionByName(_profile(df, spec))
    return profile
