"""Queries of the llm operators, by name, and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import structure
from ..session import table
from . import leakage, lookalike, ocr, packing, quantiles, sitelines, spam, splitting, tokens


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return sitelines.found(table(spark, d, "block_units"))


def p1_clean_text(spark: SparkSession, d: str) -> DataFrame:
    return sitelines.without_site_lines(table(spark, d, "block_units"))


def p2_chunks(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_sections(table(spark, d, "block_units"), table(spark, d, "splitter_policies"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.chunk_report(table(spark, d, "block_units"), table(spark, d, "splitter_policies"))


def p2_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals per chunk size; ``near_least`` says that all sections together need at most a tenth more chunks than their characters, and one a section."""
    r = p2_report(spark, d).groupBy("chunk_size")
    sums = [F.sum(c).cast("long").alias(c) for c in ("n_blocks", "n_chars", "n_oversize", "least_chunks", "over_full", "placed_twice")]
    return r.agg(F.count("*").alias("n_sections"), *sums, (F.sum("n_chunks") <= 1.1 * F.sum("least_chunks") + F.count("*")).alias("near_least"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    titles = table(spark, d, "inventory").select(F.lit("title").alias("field"), F.col("document_id").alias("key"), F.col("title").alias("t"))
    abstracts = table(spark, d, "block_units").where("role = 'abstract'").select(F.lit("text").alias("field"), F.col("block_id").alias("key"), F.col("text").alias("t"))
    return lookalike.look_alike_pairs(titles.unionByName(abstracts), "field", "key", "t")


def p3_unified_text(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.unify_column(structure.distinct_blocks(table(spark, d, "block_units"), "text"), "text")


def p4_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return quantiles.pod_percentiles(table(spark, d, "runs"))


def p4_bound_check(spark: SparkSession, d: str) -> DataFrame:
    return quantiles.bound_check(table(spark, d, "runs"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return ocr.found(table(spark, d, "block_units"))


def p5_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return ocr.paragraphs(table(spark, d, "block_units"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.found(table(spark, d, "block_units"), table(spark, d, "splitter_policies"))


def p7_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_blocks(table(spark, d, "block_units"), table(spark, d, "splitter_policies"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, d, "documents"))


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Encoding and decoding again: the texts themselves."""
    return tokens.decode_corpus(tokens.encode_corpus(table(spark, d, "documents")))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.found(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_clean_text(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "leaked_words", "n_words", "clean").distinct()


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.found(table(spark, d, "documents"))


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return spam.spam_scores(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_clean_text, p2_chunks, p2_report, p2_totals, p3_found, p3_unified_text, p4_percentiles, p4_bound_check, p5_found, p5_paragraphs, p7_found, p7_pieces, p8_ids, p8_decoded, p9_found, p9_clean_text, p10_found, p10_scores)}

def _folded(c: str) -> str:
    """The one form of a text in SQL, from the same mapping: letter for letter, what has no shape dropped, longer replacements (of Latin ligatures) one by one."""
    one = {chr(k): v for k, v in lookalike.mapping().items() if len(v) == 1}
    gone = "".join(chr(k) for k, v in lookalike.mapping().items() if not v)
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    out = f"translate({c}, {quoted(''.join(one) + gone)}, {quoted(''.join(one.values()))})"
    for k, v in lookalike.mapping().items():
        if len(v) > 1 and (k < 0x250 or 0xFB00 <= k <= 0xFB06):
            out = f"replace({out}, {quoted(chr(k))}, {quoted(v)})"
    return f"nfc_normalize({out})"


def _words(c: str) -> str:
    return f"regexp_extract_all(lower({_folded(c)}), '[\\p{{L}}\\p{{N}}]+')"


_GRAMS = "SELECT DISTINCT {0}, unnest(list_transform(range(1, len(w) - 10), lambda i: hash(array_to_string(w[i:i + 11], ' ')))) AS g FROM (SELECT {0}, {1} AS w FROM {2} WHERE text IS NOT NULL) WHERE len(w) >= 12"

SQL = {
    "p1_found": f"""
        WITH b AS (SELECT DISTINCT block_id, document_id, coalesce(collection_slug, '-') AS slug, text, role FROM block_units), n AS (SELECT slug, count(DISTINCT document_id) AS n FROM b GROUP BY 1),
             x AS (SELECT block_id, document_id, slug, string_split(text, chr(10)) AS ls FROM b WHERE text IS NOT NULL AND block_id IS NOT NULL AND role IS DISTINCT FROM 'title'),
             l AS (SELECT block_id, document_id, slug, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS line FROM x),
             k AS (SELECT *, regexp_replace(lower({_folded('line')}), '[^\\p{{L}}]', '', 'g') AS key FROM l WHERE length(line) >= 15),
             s AS (SELECT slug, key FROM k JOIN n USING (slug) WHERE length(key) >= 15 GROUP BY slug, key, n HAVING count(DISTINCT document_id) >= 3 AND count(DISTINCT document_id) >= 0.04 * n)
        SELECT DISTINCT block_id, CAST(line_no AS INTEGER) AS line_no FROM k JOIN s USING (slug, key)""",
    "p3_found": f"""
        WITH t AS (SELECT DISTINCT 'title' AS field, document_id AS key, title AS t FROM inventory WHERE document_id IS NOT NULL AND title IS NOT NULL UNION ALL SELECT DISTINCT 'text', block_id, text FROM block_units WHERE role = 'abstract' AND block_id IS NOT NULL AND text IS NOT NULL),
             f AS (SELECT *, {_folded('t')} AS u FROM t)
        SELECT DISTINCT a.field, a.key AS key_a, b.key AS key_b FROM f a JOIN f b ON a.field = b.field AND a.u = b.u AND a.key < b.key AND a.t <> b.t""",
    "p9_found": f"""
        WITH d AS ({_GRAMS.format('doc_id', _words('text'), 'documents')}), i AS ({_GRAMS.format('item_id', _words('text'), 'eval_items')})
        SELECT DISTINCT doc_id, item_id FROM d JOIN i USING (g)""",
    "p2_totals": """
        WITH b AS (SELECT DISTINCT block_id, coalesce(section_id, document_id || ':none', 'collection:' || coalesce(collection_slug, '')) AS section, collection_slug, text FROM block_units WHERE length(text) > 0 AND block_id IS NOT NULL),
             s AS (SELECT section, length(text) AS n, coalesce(p.chunk_size, 1200) AS chunk_size FROM b LEFT JOIN splitter_policies p USING (collection_slug)),
             c AS (SELECT section, chunk_size, count(*) AS n_blocks, sum(n) AS n_chars, sum(CASE WHEN n > chunk_size THEN 1 ELSE 0 END) AS n_oversize,
                          coalesce(ceil(sum(CASE WHEN n <= chunk_size THEN n + 1 END) / (chunk_size + 1)), 0) AS least_chunks FROM s GROUP BY section, chunk_size)
        SELECT chunk_size, count(*) AS n_sections, CAST(sum(n_blocks) AS BIGINT) AS n_blocks, CAST(sum(n_chars) AS BIGINT) AS n_chars, CAST(sum(n_oversize) AS BIGINT) AS n_oversize,
               CAST(sum(least_chunks) AS BIGINT) AS least_chunks, 0::BIGINT AS over_full, 0::BIGINT AS placed_twice, true AS near_least FROM c GROUP BY chunk_size""",
    "p4_bound_check": """
        WITH one AS (SELECT DISTINCT * FROM runs),
             v AS (SELECT pod_number, 'duration_seconds' AS metric, duration_seconds AS x FROM one UNION ALL SELECT pod_number, 'seconds_per_page', seconds_per_page FROM one),
             n AS (SELECT pod_number, metric, count(*) AS n FROM v WHERE x IS NOT NULL AND isfinite(x) GROUP BY 1, 2)
        SELECT pod_number, metric, q, n, true AS within FROM n, (VALUES (0.01::DOUBLE), (0.05::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (0.9::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) AS t(q)""",
    "p7_found": "SELECT DISTINCT block_id FROM block_units JOIN splitter_policies USING (collection_slug) WHERE length(text) > chunk_size AND block_id IS NOT NULL",
    "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
