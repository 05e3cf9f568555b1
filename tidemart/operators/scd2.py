"""Type 2 history of a catalog that its source overwrites."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import moment
from tidemart.operators.dedup import latest_by_key

VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"


def step_snapshot(
    open_versions: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    at: datetime | Column,
    hard_deletes: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    """Open versions after the batch, along with those the batch closes.

    Closed history does not take part. A key that the batch repeats counts once,
    by `latest_by_key`; so keys are unique on both sides, and one full join yields
    one row per key. A changed key turns into two versions.

    ``buckets``: the open versions are stored in so many buckets by their keys, none of
    which is null in any row. Then only the batch is shuffled.
    """
    now = at if isinstance(at, Column) else moment(at)
    old = open_versions.select(
        *(F.col(k).alias(f"__old_{k}") for k in keys),
        F.struct(*keys, *check_cols, VALID_FROM).alias("old"),
    )
    batch = latest_by_key(batch.select(*keys, *check_cols), keys)
    if buckets is not None:
        batch = batch.repartition(buckets, *keys)
    new = batch.select(
        *(F.col(k).alias(f"__new_{k}") for k in keys), F.struct(*keys, *check_cols).alias("new")
    )

    def same(k: str) -> Column:
        a, b = F.col(f"__old_{k}"), F.col(f"__new_{k}")
        return a.eqNullSafe(b) if buckets is None else a == b

    joined = old.join(new, [same(k) for k in keys], "full_outer")

    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = F.lit(False)
    for c in check_cols:
        changed = changed | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))

    def version(side: str, valid_from: Column, valid_to: Column) -> Column:
        fields = [F.col(f"{side}.{c}").alias(c) for c in [*keys, *check_cols]]
        return F.struct(*fields, valid_from.alias(VALID_FROM), valid_to.alias(VALID_TO))

    open_ended = F.lit(None).cast("timestamp")
    unchanged = version("old", F.col(f"old.{VALID_FROM}"), open_ended)
    closed = version("old", F.col(f"old.{VALID_FROM}"), now)
    opened = version("new", now, open_ended)
    missing = closed if hard_deletes else unchanged
    outcome = (
        F.when(has_old & ~has_new, F.array(missing))
        .when(~has_old, F.array(opened))
        .when(changed, F.array(closed, opened))
        .otherwise(F.array(unchanged))
    )
    return joined.select(F.explode(outcome).alias("v")).select("v.*")


def apply_snapshot(
    history: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    at: datetime | Column,
    hard_deletes: bool = True,
) -> DataFrame:
    """Whole history after the batch.

    A new key opens a version, a changed one closes its version and opens
    another, an unchanged one stays, a missing one is closed (``hard_deletes``),
    and a key that returns opens a fresh version. ``check_cols`` are compared
    null-safely. To keep a history over many runs store it (`load_snapshot`):
    each step here reads the history twice, so long chains grow their plan.
    """
    columns = [*keys, *check_cols, VALID_FROM, VALID_TO]
    history = history.select(*columns)
    closed = history.filter(F.col(VALID_TO).isNotNull())
    open_versions = history.filter(F.col(VALID_TO).isNull())
    versions = step_snapshot(open_versions, batch, keys, check_cols, at, hard_deletes)
    return closed.unionByName(versions)
