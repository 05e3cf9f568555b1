"""Measures over irregular series: previous observation and period summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions import guarded_pct_change
from tidemart.operators.buckets import BUCKET, time_bucket

_CARRY, SHARE = "__carry", "__share"


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    previous: dict[str, str],
    period: str | None = None,
    ends: DataFrame | None = None,
    shares: int | None = None,
) -> DataFrame:
    """Adds columns of the row before this one in its series.

    ``previous`` maps a column to the name its predecessor's value gets; map
    ``at`` too for the time of the predecessor. (keys, at) identifies a row.
    "Previous" is the last row that exists, not the day before.

    Work is split by key and time bucket (see `buckets`): the rows are shuffled
    once, whatever the share of the largest key.

    ``ends`` are the `bucket_ends` of all buckets, stored earlier; then ``df`` may hold
    the rows of some buckets only, each of them whole.

    ``shares`` deals the rows out by time bucket and that many shares of the keys, not by
    bucket and key: what is written by bucket then needs no other shuffle.
    """
    values = [c for c in previous if c != at]
    bucketed = df.withColumn(BUCKET, time_bucket(df, at, period))
    if ends is None:
        ends = bucket_ends(df, keys, at, values, period)
    by_key = Window.partitionBy(*keys).orderBy(BUCKET)
    carried = ends.select(
        *keys,
        BUCKET,
        *(F.lag(c).over(by_key).alias(c) for c in [at, *values]),
        F.lit(True).alias(_CARRY),
    ).filter(F.col(at).isNotNull())

    rows = bucketed.withColumn(_CARRY, F.lit(False)).unionByName(carried, allowMissingColumns=True)
    series = [*keys, BUCKET]
    if shares is not None:
        rows = dealt_by(rows, BUCKET, keys, shares)
        series.append(SHARE)
    by_bucket = Window.partitionBy(*series).orderBy(at)
    lagged = {name: F.lag(c).over(by_bucket) for c, name in previous.items()}
    return rows.withColumns(lagged).filter(~F.col(_CARRY)).drop(_CARRY, BUCKET, SHARE)


def dealt_by(df: DataFrame, bucket: str, keys: Sequence[str], shares: int) -> DataFrame:
    """Rows dealt out by a bucket and by ``shares`` shares of the keys, in a column `SHARE`.

    Grouping by bucket, keys and `SHARE` takes no shuffle afterwards.
    """
    share = F.pmod(F.xxhash64(*keys), F.lit(shares)).cast("int")
    return df.withColumn(SHARE, share).repartition(bucket, SHARE)


def bucket_ends(
    df: DataFrame, keys: Sequence[str], at: str, values: Sequence[str], period: str | None = None
) -> DataFrame:
    """The last row of each key and time bucket, which the key's next bucket begins with."""
    bucketed = df.withColumn(BUCKET, time_bucket(df, at, period))
    return bucketed.groupBy(*keys, BUCKET).agg(
        F.max(at).alias(at), *(F.max_by(c, at).alias(c) for c in values)
    )


def period_summary(
    df: DataFrame,
    keys: Sequence[str | Column],
    at: str,
    value: str,
    change: str,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Count, average, extremes, first and last value, and dispersion per group.

    All measures are partial aggregates of one pass, so a group of any size
    reaches its reducer as one row per map task. ``names`` renames the outputs.
    """
    first, last = F.min_by(value, at), F.max_by(value, at)
    measures = {
        "n": F.count(F.lit(1)),
        "average": F.round(F.avg(value), 8),
        "minimum": F.min(value),
        "maximum": F.max(value),
        "first": first,
        "last": last,
        # Sample deviation of a single row is null: no dispersion.
        "deviation": F.round(F.coalesce(F.stddev_samp(change), F.lit(0.0)), 6),
    }
    named = {key: (names or {}).get(key, key) for key in [*measures, "change"]}
    grouped = df.groupBy(*keys).agg(*(m.alias(named[k]) for k, m in measures.items()))
    return grouped.withColumn(
        named["change"],
        guarded_pct_change(F.col(named["last"]), F.col(named["first"])),
    )
