"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import chat_views, dual_tree, exact_dedup, lang_id, near_dedup, packing, sentence_pieces, token_counts, topk, toxicity, url_filters, whitening, winnowing
from tallybrook.llm.common import read

TOKENIZER = "byte_bpe_50k.json"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(read(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), vocabularies.path(TOKENIZER))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trip(read(spark, sf_dir, "documents"), vocabularies.path("piece_bpe_32k.model"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_views.views(read(spark, sf_dir, "conversations"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


#: The rules of the query (host, path, verdict).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(read(spark, sf_dir, "pages"), RULES)


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), vocabularies.path(TOKENIZER))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.clusters(spark, read(spark, sf_dir, "embeddings"))


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.digest(winnowing.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_toxicity, op3_best_fit_packing, op4_sentencepiece, op5_chat_formatting, op6_exact_dedup, op7_minhash_near_dedup, op8_url_filters, op9_exact_top_k, op10_token_counts, op11_centroid_clustering, op12_benchmark_decontamination, op13_embedding_whitening)}

def _lloyd(rounds: int = 10) -> str:
    """Plain Lloyd rounds, one after another."""
    steps = [f"""
        m{i} AS MATERIALIZED (
            SELECT v.row, min_by(c.j, list_value(d, c.j)) AS j, min(d) AS d
            FROM v, c{i} c, LATERAL (SELECT list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d)
            GROUP BY v.row)""" for i in range(rounds + 1)]  # fmt: skip
    moves = [f"""
        c{i + 1} AS MATERIALIZED (
            SELECT c.j, coalesce(any_value(s.x), any_value(c.x)) AS x
            FROM c{i} c LEFT JOIN (
                SELECT j, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY p) AS x
                FROM (SELECT j, p, sum(v.x[p]) AS s, count(*) AS n FROM m{i} JOIN v USING (row), range(1, 65) r(p) GROUP BY j, p) GROUP BY j) s ON s.j = c.j
            GROUP BY c.j)""" for i in range(rounds)]  # fmt: skip
    body = ",".join(x for i in range(rounds + 1) for x in ([steps[i], moves[i]] if i < rounds else [steps[i]]))
    return f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, x) - 1 AS j, x FROM (SELECT sha256('3:' || vec_id) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT 8)), {body}
        SELECT vec_id, m.j::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY m.j))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
        FROM m{rounds} m JOIN v USING (row) JOIN c{rounds} c ON c.j = m.j"""


ORACLE_SQL = {
    "op11_centroid_clustering": _lloyd(),
    "op12_benchmark_decontamination": r"""
        WITH texts AS (
            SELECT 'd' AS kind, row_number() OVER () AS row, doc_id::VARCHAR AS id, text FROM documents
            UNION ALL SELECT 'i', row_number() OVER (), item_id::VARCHAR, text FROM benchmark),
        words AS MATERIALIZED (
            SELECT kind, row, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM texts),
        windows AS MATERIALIZED (
            SELECT DISTINCT id, size, array_to_string(w[p : p + size - 1], ' ') AS words
            FROM (SELECT id, w, least(10, len(w)) AS size FROM words WHERE kind = 'i' AND len(w) > 0), LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS p)),
        hits AS MATERIALIZED (
            SELECT DISTINCT row, p, size, words
            FROM (SELECT row, size, p, array_to_string(w[p : p + size - 1], ' ') AS words
                  FROM words, (SELECT DISTINCT size FROM windows), LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS p) WHERE kind = 'd')
            WHERE words IN (SELECT words FROM windows)),
        covered AS (SELECT row, count(DISTINCT q) AS n FROM hits, LATERAL (SELECT unnest(range(p, p + size)) AS q) GROUP BY row),
        items AS (SELECT row, list(DISTINCT id) AS ids FROM hits JOIN windows USING (words) WHERE id IS NOT NULL GROUP BY row)
        SELECT d.id::BIGINT AS doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(len(i.ids), 0)::BIGINT AS n_items,
               sha256(coalesce(array_to_string(list_sort(i.ids), ','), '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
        FROM words d LEFT JOIN covered c USING (row) LEFT JOIN items i USING (row) WHERE d.kind = 'd'""",
    "op5_chat_formatting": r"""
        WITH said AS (
            SELECT conv_id, turn, regexp_replace(coalesce(role, 'unknown'), '[^\p{L}\p{N}_-]', '_', 'g') AS speaker, coalesce(text, '') AS text
            FROM conversations),
        people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
        headed AS (
            SELECT s.conv_id, p.perspective, s.turn, s.speaker, s.text,
                   '<|im_start|>' || CASE WHEN s.speaker = p.perspective THEN 'assistant' WHEN s.speaker = 'system' THEN 'system'
                                          ELSE 'user name=' || s.speaker END || chr(10) AS header
            FROM said s JOIN people p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
        placed AS (
            SELECT *, header || text || '<|im_end|>' || chr(10) AS segment,
                   row_number() OVER w - 1 AS position,
                   coalesce(sum(length(header || text || '<|im_end|>' || chr(10))) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
            FROM headed
            WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text))
        SELECT conv_id, perspective, position, turn, speaker, segment, start, start + length(segment) AS "end",
               CASE WHEN speaker = perspective THEN start + length(header) END AS train_start,
               CASE WHEN speaker = perspective THEN start + length(segment) END AS train_end
        FROM placed""",
    "op9_exact_top_k": """
        WITH v AS (
            SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.row, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.row <> b.row AND len(a.q) = len(b.q)),
        r AS (
            SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
            FROM s)
        SELECT * FROM r WHERE rank <= 5""",
    "op6_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER g AS keep_id,
               count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW g AS (PARTITION BY coalesce(text, ''))""",
}
