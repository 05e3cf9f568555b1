"""Time buckets that split the rows of one key over many tasks.

A window partitioned by key alone puts every row of a hot key into one task.
The operators here partition by (key, bucket of time) instead and hand each
bucket a carry row: the state the key had when the bucket began. Carry rows
come from a map-side aggregate per (key, bucket), so the only window over whole
keys sees one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

BUCKET = "__bucket"

# Bucket widths for series with one row per key and time: by date a key has at
# most 366 rows a year; timestamps can come at any rate, so they are cut finer.
DATE_PERIOD = "year"
TIMESTAMP_PERIOD = "day"


def time_bucket(df: DataFrame, at: str, period: str | None) -> Column:
    """Start of the period ``at`` falls in; never decreases as ``at`` grows."""
    is_date = isinstance(df.schema[at].dataType, DateType)
    width = period or (DATE_PERIOD if is_date else TIMESTAMP_PERIOD)
    if is_date and width == "day":
        return F.col(at)
    return F.trunc(at, width) if is_date else F.date_trunc(width, at)
