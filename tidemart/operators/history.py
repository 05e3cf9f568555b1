"""Reading a Type 2 history at a point in time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions import moment
from tidemart.operators.buckets import BUCKET, time_bucket
from tidemart.operators.dedup import comparable

_VERSION = "__version"
_SALT = "__salt"


def valid_at(
    history: DataFrame,
    at: datetime | Column,
    valid_from: str = "valido_desde",
    valid_to: str = "valido_hasta",
) -> DataFrame:
    """The versions in force at one moment."""
    at = at if isinstance(at, Column) else moment(at, history.schema[valid_from].dataType)
    return history.filter(
        (F.col(valid_from) <= at) & (F.col(valid_to).isNull() | (at < F.col(valid_to)))
    )


def asof_lookup(
    df: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    valid_from: str,
    valid_to: str,
    columns: Sequence[str],
    period: str = "day",
    salts: int = 1,
) -> DataFrame:
    """Left lookup of the version in force at each row's own time.

    Versions of a key do not overlap, so the only candidate is the last one that
    began at or before the row; it counts if it had not ended by then. Rows and
    versions are merged in time order per key and bucket (see `buckets`). No
    pairs of rows and versions are formed, and no key is held by a single task.
    Where even one key's rows of one ``period`` are too many for a task,
    ``salts`` cuts them further, at the price of as many copies of the versions.
    ``at`` and the validity columns are of one type.
    """
    if salts < 1:
        raise ValueError("salts must be at least 1")
    bucket = time_bucket(df, at, period)
    begins = history.select(
        *keys,
        F.col(valid_from).alias(at),
        F.struct(valid_from, valid_to, *columns).alias(_VERSION),
    ).withColumn(BUCKET, bucket)
    no_version = F.lit(None).cast(begins.schema[_VERSION].dataType)
    rows = df.withColumns({BUCKET: bucket, "__is_row": F.lit(True), _VERSION: no_version})

    # Version each (key, bucket) starts with: the last to begin in an earlier bucket.
    begun = begins.groupBy(*keys, BUCKET).agg(F.max_by(_VERSION, at).alias(_VERSION))
    seen = rows.select(*keys, BUCKET).distinct()
    earlier = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        seen.unionByName(begun, allowMissingColumns=True)
        .groupBy(*keys, BUCKET)
        .agg(F.first(_VERSION, ignorenulls=True).alias(_VERSION))
        .withColumn(_VERSION, F.last(_VERSION, ignorenulls=True).over(earlier))
        .filter(F.col(_VERSION).isNotNull())
        .withColumn(at, F.col(f"{_VERSION}.{valid_from}"))
    )

    # Rows do not depend on each other, so each goes to one salt; versions to all.
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    versions = begins.unionByName(carried.select(*begins.columns)).withColumn(_SALT, every_salt)
    hashed = [f.name for f in df.schema.fields if comparable(f.dataType)]
    salt = F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int")
    timeline = rows.withColumn(_SALT, salt).unionByName(versions, allowMissingColumns=True)
    # Ties: a version that begins at the very time of a row is in force for it,
    # so versions (null flag) sort before rows.
    up_to_row = (
        Window.partitionBy(*keys, BUCKET, _SALT)
        .orderBy(F.col(at), F.col("__is_row").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    current = F.last(_VERSION, ignorenulls=True).over(up_to_row)
    found = timeline.withColumn(_VERSION, current).filter("__is_row")
    ended = F.col(f"{_VERSION}.{valid_to}") <= F.col(at)
    in_force = F.when(F.coalesce(ended, F.lit(False)), None).otherwise(F.col(_VERSION))
    return found.withColumn(_VERSION, in_force).select(
        *df.columns, *(F.col(f"{_VERSION}.{c}").alias(c) for c in columns)
    )
