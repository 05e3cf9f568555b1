"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, VariantType


def comparable(data_type: DataType) -> bool:
    """Whether values can be ordered and hashed."""
    return not isinstance(data_type, MapType | VariantType)


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The last row of each key by ``order_by``, ties broken by the other columns.

    The order is total over orderable columns, so the outcome does not depend on
    the partitioning. Duplicates collapse map-side, before the shuffle, and a row is
    its own rank: each column is shuffled once. Only a table with columns that can't be
    compared (maps, variants) ships its rank beside its row.
    """
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.distinct()
    ranked = [f.name for f in df.schema.fields if f.name in payload and comparable(f.dataType)]
    order = [*order_by, *(c for c in ranked if c not in order_by)]
    rank = F.struct(*(F.col(f"`{c}`") for c in order)) if order else F.lit(0)
    if set(order) == set(payload):
        last = F.max(rank)
    else:
        last = F.max_by(F.struct(*(F.col(f"`{c}`") for c in payload)), rank)
    grouped = df.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(last.alias("__row"))
    return grouped.select(
        *(F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`").alias(c) for c in df.columns)
    )
