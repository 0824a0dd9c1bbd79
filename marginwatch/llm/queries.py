"""The dealt operators as queries over the given tables, and SQL where it can express them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .divergence import audit_sources
from .embedding_graph import near_vectors
from .exact_dedup import exact_dedup
from .language_model import score_texts
from .line_dedup import line_dedup
from .mixing import mix
from .neighbour_descent import nearest_neighbours
from .packing import pack_documents
from .parity_join import jaccard_components
from .personal_data import digests, find_personal_data
from .quality import classify, grades_of
from .token_files import token_file_digests
from .tokens import vocabulary_path
from .whitening import whiten


def op1_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op2_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text"), grades_of(table(spark, sf_dir, "labels"))).drop("text")


def op3_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(find_personal_data(table(spark, sf_dir, "documents")))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), all_digests=True)


def op6_pruned_graph_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op7_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(spark, table(spark, sf_dir, "documents"), vocabulary_path())


def op8_proportional_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("row_key")


def op9_line_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"), exact_chars=1).select("doc_id", "n_lines", "n_dropped", "dropped", "text")


def op10_parity_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), width=4, num=85, den=100)


def op11_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_count_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"))


def op13_neighbour_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_hierarchical_packing, op2_ordinal_quality, op3_recurrent_lm, op4_personal_data, op5_exact_dedup, op6_pruned_graph_vectors, op7_simple8b_ids, op8_proportional_mixing, op9_line_edit_join, op10_parity_jaccard_join, op11_chebyshev_whitening, op12_count_bitmaps, op13_neighbour_descent)}

ORACLE_SQL = {
    "op5_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
    # Term by term over every pair of sources, zeros included: no levels, bitsets or complements.
    "op12_count_bitmaps": r"""
        WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
        w AS (SELECT k, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
        t AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT k) >= 10),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN t USING (lang, term) GROUP BY ALL),
        cells AS (SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n, t.total FROM g JOIN t USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
        sums AS (SELECT lang, source, sum(n) + 2 * count(*) AS den, sum(total) + 2 * count(*) AS den_lang FROM cells GROUP BY ALL),
        p AS (SELECT lang, source, term, n, 1 + ((1000000000 * (n + 2)::HUGEINT) // den::HUGEINT) AS p, 1 + ((1000000000 * (total + 2)::HUGEINT) // den_lang::HUGEINT) AS q FROM cells JOIN sums USING (lang, source)),
        pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
            UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10""",
}
