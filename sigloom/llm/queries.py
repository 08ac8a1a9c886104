"""The registered queries of the corpus operators: each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm import alignment, blockjoin, bpe, ctw, decontam, html, langid, mtree, neardup, quality, substring, toxicity, whitening
from sigloom.session import ship, table


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return substring.deduplicate(table(spark, sf_dir, "documents"), ["doc_id"])


def op4_html_tree_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return html.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op5_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return mtree.top_k(table(spark, sf_dir, "embeddings"))


def op6_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return ctw.score(table(spark, sf_dir, "documents"), ["doc_id"])


def op7_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return neardup.group(table(spark, sf_dir, "documents"), ["doc_id"])


def op8_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_bpe_monoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.encode(table(spark, sf_dir, "documents"), ["doc_id"])


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    out = alignment.align(table(spark, sf_dir, "documents"), ["doc_id"])
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_jacobi_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_block_matrix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return blockjoin.nearest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality_fm, op2_toxicity_nnpu, op3_substring_automata, op4_html_tree_model, op5_mtree_topk, op6_context_tree_weighting, op7_odd_sketch_dedup, op8_template_decontamination, op9_bpe_monoid, op10_language_id, op11_token_alignment, op12_jacobi_whitening, op13_block_matrix_join)}

ORACLES: dict[str, str] = {
    "op3_substring_automata": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        w AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
        s AS (SELECT r, unnest(range(1, len(ws) - 33)) AS i, ws FROM d WHERE len(ws) >= 35),
        k AS (SELECT r, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM s),
        again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM k) WHERE n > 1),
        marked AS (
            SELECT w.r, w.i, w.word, max(CASE WHEN a.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY w.r ORDER BY w.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
            FROM w LEFT JOIN again a ON a.r = w.r AND a.i = w.i
        ),
        kept AS (SELECT r, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS t FROM marked GROUP BY r)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)
    """,
    "op7_odd_sketch_dedup": r"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), s AS (
            SELECT r, doc_id, CASE WHEN len(ws) >= 4 THEN list_sort(list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS g FROM d
        ), c AS MATERIALIZED (
            SELECT r, doc_id, len(g)::BIGINT AS n, CASE WHEN len(g) = 0 THEN NULL ELSE min(doc_id) OVER (PARTITION BY md5(array_to_string(g, '|'))) END AS cid, g FROM s
        ), item AS (SELECT cid, n, unnest(g) AS x FROM c WHERE doc_id = cid),
        links AS MATERIALIZED (
            SELECT a, b FROM (SELECT p.cid AS a, q.cid AS b, any_value(p.n) AS m, any_value(q.n) AS n, count(*) AS k FROM item p JOIN item q ON p.x = q.x AND p.cid <> q.cid GROUP BY 1, 2)
            WHERE 100 * k >= 80 * (m + n - k)
        ), reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        low AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
        SELECT doc_id, n AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE least(cid, coalesce(m, cid)) END AS component_id,
               coalesce(doc_id = CASE WHEN n = 0 THEN doc_id ELSE least(cid, coalesce(m, cid)) END, FALSE) AS kept
        FROM c LEFT JOIN low ON c.cid = low.a
    """,
    "op5_mtree_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END), 'sum') = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, rank, vec_id, score FROM (
            SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
        ) WHERE rank <= 5
    """,
    "op13_block_matrix_join": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END), 'sum') = 0
                AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END), 'sum') > 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, rank, vec_id, score FROM (
            SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
        ) WHERE rank <= 20
    """,
}
