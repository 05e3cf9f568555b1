"""One query per corpus operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import (
    centroids,
    codes,
    embeddings,
    exact_dedup,
    jaccard,
    licenses,
    main_text,
    packing,
    passages,
    pieces,
    pii,
    suffixes,
    toxicity,
)
from tidemart.llm._common import read

PSEUDONYM_KEY = "tidemart-workload"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model, score_col="score")
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


def op3_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(read(spark, sf_dir, "documents"))


def op4_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.PieceModel.load(tokenizer_path("piece_bpe_32k.model"))
    return pieces.round_trip(read(spark, sf_dir, "documents"), model)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(read(spark, sf_dir, "documents"))


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = pii.pseudonymise(docs, PSEUDONYM_KEY)
    return found.select("doc_id", "text", F.size("pii").alias("n_replaced"), "pii")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "licenses", "license_sentences")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return exact_dedup.dedup_exact(docs, exact_dedup.new_index(spark, docs))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(read(spark, sf_dir, "embeddings"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(read(spark, sf_dir, "embeddings"))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    found = main_text.extract_main_text(pages, main_text.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress_vectors(read(spark, sf_dir, "embeddings"))


def _sql_rounds(name: str, rounds: int, assign: str, update: str) -> str:
    """CTEs of a clustering: ``<name>0`` exists; round r assigns to it and makes the next.

    ``assign`` and ``update`` are SQL with {old}, {near} and {new} for the round's tables.
    """
    steps = []
    for r in range(rounds + 1):
        names = {"old": f"{name}{r}", "near": f"near{r}", "new": f"{name}{r + 1}"}
        steps.append(f"near{r} AS MATERIALIZED ({assign.format(**names)})")
        if r < rounds:
            steps.append(f"{name}{r + 1} AS MATERIALIZED ({update.format(**names)})")
    return ",\n".join(steps)


# Every vector beside every centroid, component by component: for small tables.
_SQL_FINITE = """embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""
_SQL_FLOOR = """CAST((sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*)
                      AS BIGINT) AS x"""
_SQL_CENTROIDS = _sql_rounds(
    "centroid",
    5,
    """SELECT vec_id, arg_min(cluster, struct_pack(d, cluster)) AS cluster, min(d) AS d
            FROM (SELECT v.vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS d
                  FROM vector v JOIN {old} c ON v.i = c.i GROUP BY ALL) GROUP BY vec_id""",
    f"""SELECT cluster, i, coalesce(m.x, c.x) AS x FROM {{old}} c LEFT JOIN (
              SELECT cluster, i, {_SQL_FLOOR}
              FROM vector v JOIN {{near}} USING (vec_id) GROUP BY cluster, i) m
            USING (cluster, i)""",
)
_SQL_CODEBOOKS = _sql_rounds(
    "entry",
    6,
    """SELECT vec_id, part, arg_min(e, struct_pack(d, e)) AS e, min(d) AS d
            FROM (SELECT v.vec_id, v.part, c.e, sum((v.x - c.x) * (v.x - c.x)) AS d
                  FROM vector v JOIN {old} c USING (part, i) GROUP BY ALL) GROUP BY vec_id, part""",
    f"""SELECT part, e, i, coalesce(m.x, c.x) AS x FROM {{old}} c LEFT JOIN (
              SELECT part, e, i, {_SQL_FLOOR}
              FROM vector v JOIN {{near}} USING (vec_id, part) GROUP BY part, e, i) m
            USING (part, e, i)""",
)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_best_fit_packing,
        op3_shared_passages,
        op4_piece_round_trip,
        op5_ngram_jaccard_join,
        op6_pseudonyms,
        op7_license_scan,
        op8_exact_dedup,
        op9_embedding_near_dedup,
        op10_suffix_array_dedup,
        op11_centroid_clustering,
        op12_main_text,
        op13_vector_codes,
    )
}

ORACLES: dict[str, str] = {
    # Unequal pairs of like size that share a shingle; then labels spread along links.
    "op5_ngram_jaccard_join": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3),
                     lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
            FROM split),
        groups AS (
            SELECT list_sort(s) AS s, len(s) AS n, min(doc_id) AS id FROM sets WHERE len(s) > 0
            GROUP BY ALL),
        items AS (SELECT id, n, unnest(s) AS x FROM groups),
        links AS (
            SELECT a.id AS a, b.id AS b
            FROM items a JOIN items b ON a.x = b.x AND a.id < b.id
                AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            GROUP BY a.id, b.id, a.n, b.n
            HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach(id, to_id) AS (
            SELECT id, id FROM groups
            UNION
            SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON reach.to_id = both_ways.a),
        named AS (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id)
        SELECT sets.doc_id, len(sets.s) AS n_shingles,
               coalesce(named.component_id, sets.doc_id) AS component_id
        FROM sets
        LEFT JOIN groups ON list_sort(sets.s) = groups.s
        LEFT JOIN named ON named.id = groups.id""",
    "op9_embedding_near_dedup": """
        WITH RECURSIVE fine AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b
            ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
               AND list_cosine_similarity(a.v, b.v) >= 0.95),
        reach(id, to_id) AS (
            SELECT vec_id, vec_id FROM fine
            UNION
            SELECT reach.id, links.b FROM reach JOIN links ON reach.to_id = links.a),
        named AS (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id),
        counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links,
               coalesce(component_id, vec_id) AS component_id,
               vec_id = coalesce(component_id, vec_id) AS kept
        FROM embeddings LEFT JOIN named ON id = vec_id LEFT JOIN counted ON a = vec_id""",
    "op8_exact_dedup": r"""
        WITH hashed AS (
            SELECT doc_id,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                       AS text_sha256
            FROM documents)
        SELECT doc_id,
               min(doc_id) OVER g AS keep_id,
               count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept,
               text_sha256
        FROM hashed WINDOW g AS (PARTITION BY text_sha256)""",
    "op11_centroid_clustering": f"""
        WITH kept AS (
            SELECT vec_id, embedding FROM embeddings WHERE {_SQL_FINITE} AND len(embedding) = 64),
        vector AS MATERIALIZED (
            SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x
            FROM (SELECT vec_id, unnest(embedding) AS x, unnest(range(64)) AS i FROM kept)),
        centroid0 AS MATERIALIZED (
            SELECT cluster, i, x FROM vector JOIN (
                SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster
                FROM kept) USING (vec_id) WHERE cluster < 40),
        {_SQL_CENTROIDS},
        digest AS (
            SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h
            FROM centroid5 GROUP BY cluster)
        SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
               CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
        FROM near5 JOIN digest USING (cluster)""",
    "op13_vector_codes": f"""
        WITH kept AS (SELECT vec_id, label, embedding FROM embeddings WHERE {_SQL_FINITE}),
        vector AS MATERIALIZED (
            SELECT vec_id, place // size AS part, place % size AS i,
                   CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) AS x
            FROM (SELECT vec_id, len(embedding) // 8 AS size, unnest(embedding) AS x,
                         unnest(range(len(embedding))) AS place FROM kept)),
        entry0 AS MATERIALIZED (
            SELECT part, e, i, x FROM vector JOIN (
                SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept)
            USING (vec_id) WHERE e < 16),
        {_SQL_CODEBOOKS},
        coded AS (
            SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY part) AS code,
                   CAST(sum(d) AS BIGINT) AS error FROM near6 GROUP BY vec_id)
        SELECT vec_id, code, error,
               CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, e, i)) FROM entry6)
                   AS codebooks_sha256
        FROM coded JOIN kept USING (vec_id)""",
}
