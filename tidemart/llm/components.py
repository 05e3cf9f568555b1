"""Connected components of pairs, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm._common import join_counted, staged


def _to_least(pairs: DataFrame) -> DataFrame:
    """Links the larger neighbours v of each u to the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"), F.count("*").alias("n"))
    least = staged(least.withColumn("least", F.least("u", "least")), "least")
    return join_counted(pairs, least, "u", "n")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component_id) of every id in ``edges``: the smallest id it is linked with.

    Alternates linking each node's larger neighbours, and its smaller ones, to its
    least neighbour until only stars remain; rounds grow with the logarithm of the
    longest path. Nulls, loops and repeated pairs are ignored. Hubs are spread.
    """
    some = F.col(a).isNotNull() & F.col(b).isNotNull()
    pairs = edges.where(some & (F.col(a) != F.col(b)))
    pairs = pairs.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct()
    pairs, before = staged(pairs, "edges"), None
    while True:
        mark = pairs.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("u") % 2)
        ).first()
        if mark == before:
            break
        before = mark
        both = pairs.select("u", "v").union(pairs.select(F.col("v"), F.col("u")))
        large = _to_least(both).where("v > u").select(F.col("v"), F.col("least").alias("u"))
        large = staged(large.distinct(), "large")
        # Now of each node v, its smaller neighbours u.
        down = large.select(F.col("v").alias("u"), F.col("u").alias("v"))
        small = _to_least(down).select("u", "v", "least")
        pairs = (
            small.select(F.col("v"), F.col("least").alias("u"))
            .union(small.select(F.col("u").alias("v"), F.col("least").alias("u")))
            .where("u < v")
            .distinct()
        )
        pairs = staged(pairs, "edges")
    roots = pairs.select(F.col("u").alias("id"), F.col("u").alias("component_id")).distinct()
    return pairs.select(F.col("v").alias("id"), F.col("u").alias("component_id")).union(roots)
