"""Calendar generator."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def default_calendar_end(today: date) -> date:
    """First day not covered: January 1st, two years after the current year."""
    return date(today.year + 2, 1, 1)


def calendar(spark: SparkSession, start: date, end: date, column: str = "fecha") -> DataFrame:
    """Every day from ``start`` up to, not including, ``end``."""
    days = max((end - start).days, 0)
    offset = F.col("id").cast("int")
    return spark.range(days).select(F.date_add(F.lit(start), offset).alias(column))
