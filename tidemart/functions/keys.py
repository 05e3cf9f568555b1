"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stands for a null field inside a surrogate key (fixed value).
NULL_FIELD = "_dbt_utils_surrogate_key_null_"


def _text(column: Column, missing: str) -> Column:
    return F.coalesce(column.cast("string"), F.lit(missing))


def surrogate_key(*columns: Column) -> Column:
    """md5 of the fields as text, joined by ``-``; pass times through `timestamp_key`."""
    return F.md5(F.concat_ws("-", *(_text(c, NULL_FIELD) for c in columns)))


def timestamp_key(ts: Column) -> Column:
    """A timestamp as text of fixed width, so that its hash is the same in any engine."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def row_id(*columns: Column) -> Column:
    """Row identity for sources without a natural key; missing fields count as empty."""
    return F.sha2(F.concat_ws("|", *(_text(c, "") for c in columns)), 256)
