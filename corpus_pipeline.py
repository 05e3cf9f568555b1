"""A training corpus from raw documents: filter, deduplicate, pseudonymise, pack.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read
again as the next stage's ``docs``. Stages decide on rows, so that null and repeated ids
do no harm; columns other than ``doc_id``, ``text`` and ``n_chars`` pass through, whatever
their names, up to packing. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm import exact_dedup, jaccard, packing, pii, toxicity
from tidemart.llm._common import free_name, read, staged
from tidemart.llm.queries import PSEUDONYM_KEY, tokenizer_path

TOXIC_FROM = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC_FROM``; null and empty texts stay."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    scored = toxicity.score_toxicity(docs, model, score_col=score)
    return scored.where(F.col(score) < TOXIC_FROM).drop(score)


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row, and its column; ids may be null or repeated.

    Each reading has the same numbers: rows of stored files are numbered by file and
    place, others are stored first. File names are numbered in one task.
    """
    name = free_name(docs, "row")
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("file"), "_metadata.row_index")
    except AnalysisException:  # not read from files
        return staged(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name
    file, place = free_name(docs, "row_file"), free_name(docs, "row_place")
    placed = placed.toDF(*docs.columns, file, place)
    files = placed.select(file).distinct()
    files = files.withColumn(name, F.row_number().over(Window.orderBy(file)).cast("bigint"))
    number = F.col(name) * F.lit(1 << 40) + F.col(place)
    joined = placed.join(staged(files, "files"), file)
    return joined.withColumn(name, number).drop(file, place), name


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts, one with the smallest id; no id is larger than any.

    Texts are equal when white space is read as one space each, null as empty.
    """
    rows, number = _numbered(docs)
    marked = exact_dedup.dedup_exact(rows, exact_dedup.new_index(spark, rows), row_col=number)
    gone = staged(marked.where("NOT kept").select(number), "copies")
    return rows.join(gone, number, "left_anti").select(*_columns(docs))


def _ids_name_rows(docs: DataFrame) -> bool:
    """Whether every row has an id of its own."""
    per_id = docs.groupBy("doc_id").count()
    found = per_id.agg(F.max("count"), F.count_if(F.col("doc_id").isNull())).first()
    return (found[0] or 1) == 1 and not found[1]


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows connected by near copies, one with the smallest id, as for equal texts.

    Texts without words are near to none. Where ids are null or repeated, row numbers
    stand for them, so that texts which share an id aren't taken for one. Joined are the
    rows to drop, mostly few, so that texts move only where these are too many to broadcast.
    """
    if _ids_name_rows(docs):
        named = jaccard.similar_components(docs).where("doc_id <> component_id")
        gone = staged(named.select("doc_id"), "similar")
        return docs.join(gone, "doc_id", "left_anti").select(*_columns(docs))
    rows, number = _numbered(docs)
    named = jaccard.similar_components(rows, id_col=number).select(number, "component_id")
    ids = rows.select(number, F.col("doc_id").isNull().alias("none"), "doc_id")
    named = staged(named.join(ids, number), "components")
    first = named.groupBy("component_id")
    first = first.agg(F.min(F.struct("none", "doc_id", number)).alias("first"))
    kept = first.select(F.col(f"first.{number}").alias(number))
    gone = staged(named.select(number).join(kept, number, "left_anti"), "similar")
    return rows.join(gone, number, "left_anti").select(*_columns(docs))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms; ``n_chars`` follows where a text changed."""
    found_col = free_name(docs, "pii")
    found = pii.pseudonymise(docs, PSEUDONYM_KEY, found_col=found_col)
    n_chars = F.when(F.size(found_col) > 0, F.length("text")).otherwise(F.col("n_chars"))
    kind = docs.schema["n_chars"].dataType
    return found.withColumn("n_chars", n_chars.cast(kind)).select(*_columns(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, and their places in sequences; null texts are empty."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_similar),
    ("pii", pseudonymise),
    ("packing", pack),
]

# A trained model and tokenizers are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
