"""Operator inputs derived from the test tables.

Line items play the daily quotes: shipping day, return flag as base, supplier as
quoted entity, price as rate. Suppliers play the catalog.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from tidemart import work_dir
from tidemart.functions import instant_to_local
from tidemart.loads import Warehouse
from tidemart.plans import stage_catalog, stage_quotes
from tidemart.sources import with_metadata

LOADED = datetime(2026, 1, 7, 12, tzinfo=UTC)
SOURCE = "tpch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, work_dir(spark))


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, decimals as doubles: the same in any engine."""

    def cast(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, TimestampType):
            column = instant_to_local(column, "UTC")
        if isinstance(field.dataType, TimestampType | TimestampNTZType):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, DecimalType):
            return column.cast("double").alias(field.name)
        return column

    return df.select(*(cast(f) for f in df.schema.fields))


def line_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote per line item."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_returnflag").alias("base"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("currency"),
        F.col("l_extendedprice").cast("decimal(20,8)").alias("rate"),
    )


def raw_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote per day and pair: the highest."""
    quotes = (
        line_quotes(spark, sf_dir)
        .groupBy("date", "base", "currency")
        .agg(F.max("rate").alias("rate"))
        .withColumn("amount", F.lit(1).cast("decimal(20,8)"))
    )
    return with_metadata(quotes, SOURCE, LOADED)


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in credit, as a messy catalog; those in debt are retired."""
    suppliers = table(spark, sf_dir, "supplier").filter("s_acctbal > 0")
    rows = suppliers.select(
        F.concat(F.lit(" s"), F.col("s_suppkey").cast("string")).alias("code"),
        F.when(F.col("s_acctbal") > 9000, "  ").otherwise(F.col("s_name")).alias("name"),
    )
    return with_metadata(rows, SOURCE, LOADED)


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_quotes(raw_rates(spark, sf_dir))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_catalog(raw_catalog(spark, sf_dir))


def region_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region per supplier; one region is left out."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region").filter("r_name <> 'ASIA'"),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    suppliers = table(spark, sf_dir, "supplier")
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("codigo_moneda"),
        F.upper("s_name").alias("nombre_alternativo"),
        F.col("r_name").alias("region"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
    )


def daily_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote per day and entity: the highest."""
    quotes = line_quotes(spark, sf_dir).groupBy("date", "currency")
    quotes = quotes.agg(F.max("rate").alias("rate"), F.max("base").alias("base"))
    return quotes.withColumn("amount", F.lit(1).cast("decimal(20,8)"))


def land_payloads(
    spark: SparkSession, quotes: DataFrame, path: str | None = None, packing: str = "none"
) -> str:
    """Writes one reply per quote, nested or flat, with or without an amount.

    ``fetched_at``, where there, says in which order the replies were fetched. A file that
    is packed (``gzip``) takes less of the disk, but is read by one task.
    """
    rates = F.create_map("currency", "rate")
    fetched = [c for c in quotes.columns if c == "fetched_at"]
    by_day = F.create_map(F.col("date").cast("string"), rates).alias("rates")
    nested = F.struct("amount", "base", *fetched, by_day)
    flat = F.struct("base", "date", *fetched, rates.alias("rates"))
    reply = F.when(F.col("base") == "A", F.to_json(nested)).otherwise(F.to_json(flat))
    path = path or f"{work_dir(spark)}/landing"
    quotes.select(reply.alias("value")).write.option("compression", packing).text(path)
    return path
