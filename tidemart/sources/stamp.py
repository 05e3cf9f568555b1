"""Provenance columns added to raw rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions import moment, row_id
from tidemart.specs import INGESTED_AT, SOURCE


def with_metadata(df: DataFrame, source: str, ts: datetime | None = None) -> DataFrame:
    """Adds when the row was loaded and where it came from; other columns stay."""
    loaded = F.current_timestamp() if ts is None else moment(ts)
    return df.withColumns({INGESTED_AT: loaded, SOURCE: F.lit(source)})


def with_row_id(df: DataFrame, fields: list[str]) -> DataFrame:
    """Adds ``_row_id`` from fields that do not change between runs."""
    return df.withColumn("_row_id", row_id(*(F.col(f) for f in fields)))
