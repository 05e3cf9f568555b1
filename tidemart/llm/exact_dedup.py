"""Exact deduplication against a persistent digest index.

The index is a Parquet table (digest, keep_id), bucketed and sorted by digest.
A batch is reduced to one row per digest, sort-merge anti-joined with the index,
and what is new is appended. Texts never leave the scan: only digests move.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm._common import join_counted, staged
from tidemart.session import work_dir


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with each run of white space as one space; null as empty."""
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.unhex(F.sha2(flat.cast("binary"), 256))


class DigestIndex:
    """The digests seen so far and the document that stays for each.

    ``path`` must be reachable by all executors. ``buckets`` is written beside
    the data when the index is made; reopening uses the stored number.
    """

    def __init__(
        self, spark: SparkSession, path: str, buckets: int = 64, id_type: str = "bigint"
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        try:
            made = spark.read.parquet(f"{self.path}/made").first()
        except AnalysisException:
            made = spark.createDataFrame([(buckets, id_type)], "buckets int, id_type string")
            made.coalesce(1).write.parquet(f"{self.path}/made")
            made = made.first()
        self.buckets = made["buckets"]
        # The catalog may be of this session only; the files are what persists.
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id {made['id_type']}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}/digests'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append_new(self, firsts: DataFrame) -> None:
        """Adds the digests of ``firsts`` (digest, keep_id; one row each) not yet there.

        A run that died half-way may be repeated: what it added is found again.
        """
        new = firsts.hint("merge").join(self.read(), "digest", "left_anti")
        # Dealt like the buckets, so that each gets one sorted file.
        new = new.select("digest", "keep_id").repartition(self.buckets, "digest")
        new.write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)


def dedup_exact(
    docs: DataFrame,
    index: DigestIndex,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
) -> DataFrame:
    """Marks which rows of ``docs`` stay: (id, keep_id, group_size, kept, text_sha256).

    Of equal texts the smallest id stays, unless the index already had the text;
    then the earlier document does. Null texts count as empty; a null id is larger
    than any other. Of rows that repeat an id and a text, one is kept. An empty
    input gives no rows. Other columns are ignored, whatever their names.
    ``group_size`` counts this batch. ``row_col``, if given, is a column of stored row
    numbers; the result has it, too, to find the rows by.
    """
    rows = staged(
        docs.select(
            F.col(id_col).alias("id"),
            text_digest(F.col(text_col)).alias("digest"),
            (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
        ),
        "digests",
    )
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    groups = staged(
        rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size")),
        "groups",
    )
    index.append_new(groups.select("digest", F.col("first.id").alias("keep_id")))
    known = staged(groups.hint("merge").join(index.read(), "digest"), "known")
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("row") == F.col("first.row"))
    return join_counted(rows, known, "digest", "group_size").select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        kept.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *([F.col("row").alias(row_col)] if row_col else []),
    )


def new_index(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id") -> DigestIndex:
    """An empty index in the shared folder, for ids of the type in ``docs``."""
    kind = docs.schema[id_col].dataType.simpleString()
    return DigestIndex(spark, f"{work_dir(spark)}/index", id_type=kind)
