"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import work_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, options: dict[str, object] | None = None) -> DataFrame:
    """``df`` written under the cluster's shared folder (with writer ``options``) and read back.

    Cuts the lineage: an executor lost later costs a re-read, not a re-run.
    """
    path = f"{work_dir(df.sparkSession)}/{name}"
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer if need be, for a column that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_counted(
    rows: DataFrame, per_key: DataFrame, key: str, count: str, share: int = 1000
) -> DataFrame:
    """Inner join of ``rows`` with ``per_key``, which has one row for each key.

    ``count`` says how many of ``rows`` have the key. Keys with more than
    1 / ``share`` of all rows go by broadcast; there are fewer than ``share`` of
    them, whatever the data, and so no task gets more than that part of the rows.
    Both inputs are read more than once and should be stored tables.
    """
    total = per_key.agg(F.sum(count)).first()[0] or 0
    hot = per_key.where(F.col(count) * share > total)
    rest = per_key.where(F.col(count) * share <= total)
    spread = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key)
    return rows.join(F.broadcast(hot), key).unionByName(spread)
