"""Queries on the nested extraction payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ir, nested
from ..session import table
from .base import query


# The nodes of payloads as a walk over JSON values, level by level, from the statement of the problem.
_RULES = "(VALUES ('page', 'para_blocks', 'b', 'block'), ('page', 'discarded_blocks', 'd', 'block'), ('block', 'blocks', 'b', 'block'), ('block', 'lines', 'l', 'line'), ('line', 'spans', 's', 'span')) AS r(kind, name, letter, child)"
_LIST = lambda x: f"CASE json_type({x}) WHEN 'ARRAY' THEN json_extract({x}, '$[*]') WHEN 'OBJECT' THEN [{x}] ELSE [] END"
_PAGES = "CASE " + " ".join(f"WHEN coalesce(json_type(j, '$.{k}'), 'NULL') <> 'NULL' THEN j->'{k}'" for k in ("pdf_info", "pages", "page_info")) + " ELSE j END"
_NEWEST = "SELECT record_id, max_by(document_id, (received_at, payload)) AS document_id, max_by(payload, (received_at, payload)) AS payload FROM extractions WHERE json_valid(payload) GROUP BY record_id"


def nodes_sql(source: str) -> str:
    """Head of a query with ``v(record_id, document_id, j)`` and ``n(record_id, document_id, parent, node, kind, obj)`` of the payloads of ``source``."""
    return f"""WITH RECURSIVE v AS MATERIALIZED (SELECT record_id, document_id, payload::JSON AS j FROM ({source}) WHERE json_valid(payload) AND json_type(payload::JSON) = 'OBJECT'),
        n AS (SELECT record_id, document_id, 'root' AS parent, 'p' || lpad(CAST(i - 1 AS VARCHAR), 4, '0') AS node, 'page' AS kind, x AS obj FROM (SELECT record_id, document_id, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT record_id, document_id, {_LIST(_PAGES)} AS l FROM v)) WHERE json_type(x) = 'OBJECT'
              UNION ALL SELECT record_id, document_id, node, node || ':' || letter || lpad(CAST(i - 1 AS VARCHAR), 4, '0'), child, x FROM (SELECT record_id, document_id, node, letter, child, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT n.*, letter, child, {_LIST("(obj->name)")} AS l FROM n JOIN {_RULES} ON r.kind = n.kind)) WHERE json_type(x) = 'OBJECT')"""


_EVERY = nodes_sql("SELECT record_id, document_id, payload FROM extractions")
_ONE = nodes_sql(_NEWEST)
_KEYS = f"{_EVERY}, k AS (SELECT record_id, document_id, kind, unnest(json_keys(obj)) AS key FROM n UNION ALL SELECT record_id, document_id, 'root', unnest(json_keys(j)) FROM v)"
NUMBER = "CASE WHEN json_type(obj, '$.{0}') IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN CAST(obj->>'{0}' AS DOUBLE) END"
_SCORES = "count(*) AS n, count(score) AS with_score, min(score) AS score_min, avg(score) AS score_mean, median(score) AS score_median, max(score) AS score_max"


@query(f"{_EVERY} SELECT DISTINCT record_id, parent, node FROM n")
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.found(table(spark, d, "extractions"))


@query()
def p6_objects(spark: SparkSession, d: str) -> DataFrame:
    return nested.objects(table(spark, d, "extractions"))


@query()
def p6_blocks(spark: SparkSession, d: str) -> DataFrame:
    return nested.level_table(table(spark, d, "extractions"), "block")


@query(f"""{_KEYS} SELECT kind, key, count(*) AS n, count(DISTINCT document_id) AS documents FROM k GROUP BY ALL""")
def p6_key_counts(spark: SparkSession, d: str) -> DataFrame:
    return nested.key_counts(table(spark, d, "extractions"))


@query(f"""{_KEYS} SELECT document_id, record_id, kind, key, count(*) AS n FROM k GROUP BY ALL""")
def p6_record_key_counts(spark: SparkSession, d: str) -> DataFrame:
    return nested.record_key_counts(table(spark, d, "extractions"))


@query(f"""{_KEYS}, i AS (SELECT DISTINCT document_id, collection_slug FROM inventory WHERE document_id IS NOT NULL) SELECT collection_slug, kind, key, count(*) AS n, count(DISTINCT k.document_id) AS documents FROM k LEFT JOIN i ON k.document_id = i.document_id GROUP BY ALL""")
def p6_collection_key_counts(spark: SparkSession, d: str) -> DataFrame:
    return nested.collection_key_counts(table(spark, d, "extractions"), table(spark, d, "inventory"))


_VALID = "SELECT record_id, document_id, payload::JSON AS j FROM extractions WHERE payload IS NOT NULL AND json_valid(payload)"


@query(f"""
    WITH v AS ({_VALID}), k AS (SELECT record_id, unnest(json_keys(j)) AS key FROM v)
    SELECT key, count(*) AS occurrences, count(DISTINCT record_id) AS records FROM k GROUP BY key""")
def ir_root_keys(spark: SparkSession, d: str) -> DataFrame:
    return ir.root_keys(table(spark, d, "extractions"))


@query("""
    SELECT record_id, count(*) AS copies, CAST(sum(CASE WHEN payload IS NOT NULL AND json_valid(payload) THEN 1 ELSE 0 END) AS BIGINT) AS valid_copies,
           CASE WHEN sum(CASE WHEN payload IS NOT NULL AND json_valid(payload) THEN 1 ELSE 0 END) > 0 THEN 'ok' WHEN count(payload) = 0 THEN 'missing' ELSE 'pending' END AS render_status
    FROM extractions GROUP BY record_id""")
def ir_record_status(spark: SparkSession, d: str) -> DataFrame:
    return ir.record_status(table(spark, d, "extractions"))


@query()
def ir_blocks(spark: SparkSession, d: str) -> DataFrame:
    return ir.blocks(table(spark, d, "extractions"))


@query(f"""{_ONE} SELECT record_id, count(*) FILTER (kind = 'page') AS pages, count(*) FILTER (kind = 'block' AND NOT regexp_matches(node, '^p\\d+:d')) AS content_blocks, count(*) FILTER (kind = 'block' AND regexp_matches(node, '^p\\d+:d')) AS discarded_blocks, count(*) FILTER (regexp_full_match(node, 'p\\d+:[bd]\\d+')) AS root_blocks,
    count(*) FILTER (kind = 'line') AS lines, count(*) FILTER (kind = 'span') AS spans, count(*) FILTER (kind = 'span' AND coalesce(obj->>'text', obj->>'content', '') = '') AS spans_without_text FROM n GROUP BY 1""")
def ir_counts(spark: SparkSession, d: str) -> DataFrame:
    return ir.counts(table(spark, d, "extractions")).drop("repeated_objects")


@query()
def ir_invariants(spark: SparkSession, d: str) -> DataFrame:
    return ir.invariants(table(spark, d, "extractions"))


@query()
def ir_inspection(spark: SparkSession, d: str) -> DataFrame:
    return ir.inspection(table(spark, d, "extractions"))


@query(f"""{_ONE}, b AS (SELECT *, json_extract(obj, '$.bbox') AS box FROM n WHERE kind = 'block')
    SELECT record_id, count(*) FILTER (coalesce(obj->>'type', obj->>'block_type') IS NULL) AS null_type, count(*) FILTER (NOT coalesce(json_type(box) = 'ARRAY' AND json_array_length(box) = 4 AND len(list_filter(json_extract(box, '$[*]'), lambda x: json_type(x) IN ('DOUBLE', 'BIGINT', 'UBIGINT'))) = 4, false)) AS null_bbox,
           count(*) FILTER ({NUMBER.format('score')} IS NULL) AS null_score, count(*) FILTER (try_cast(obj->>'level' AS INTEGER) IS NULL) AS null_level, count(*) FILTER (obj->>'text' IS NULL) AS null_text FROM b GROUP BY 1""")
def ir_null_metrics(spark: SparkSession, d: str) -> DataFrame:
    return ir.null_metrics(table(spark, d, "extractions"))


@query()
def ir_text_by_block(spark: SparkSession, d: str) -> DataFrame:
    return ir.block_texts(table(spark, d, "extractions"))


@query()
def ir_duplicate_preproc_ratio(spark: SparkSession, d: str) -> DataFrame:
    return ir.preproc_ratio(table(spark, d, "extractions"))


@query()
def ir_bbox_metrics(spark: SparkSession, d: str) -> DataFrame:
    from ..functions import geometry

    b = ir.blocks(table(spark, d, "extractions")).where(F.col("bbox").isNotNull())
    return b.select("record_id", "node", *geometry.bbox_columns(F.col("bbox")))


@query(f"""{_ONE} SELECT collection, type, {_SCORES} FROM (SELECT CASE WHEN regexp_matches(node, '^p\\d+:d') THEN 'discarded' ELSE 'content' END AS collection, coalesce(obj->>'type', obj->>'block_type') AS type, {NUMBER.format('score')} AS score FROM n WHERE kind = 'block') GROUP BY ALL""")
def score_summary(spark: SparkSession, d: str) -> DataFrame:
    return ir.score_summary(table(spark, d, "extractions"))


@query(f"""{_ONE} SELECT record_id, node, type, score FROM (SELECT record_id, node, obj->>'type' AS type, {NUMBER.format('score')} AS score FROM n WHERE kind = 'span') WHERE score < 0.8""")
def low_score(spark: SparkSession, d: str) -> DataFrame:
    return ir.low_score(table(spark, d, "extractions"))


@query(f"""{_ONE} SELECT record_id, count(*) AS n_cross_page, count(DISTINCT regexp_extract(node, '^(p\\d+)', 1)) AS n_pages FROM n WHERE obj->>'cross_page' = 'true' GROUP BY 1""")
def cross_page_summary(spark: SparkSession, d: str) -> DataFrame:
    return ir.cross_page(table(spark, d, "extractions"))


@query()
def payload_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Markdown of every record with its missing images and its state as of the end of the data."""
    from ..operators import render

    e = table(spark, d, "extractions")
    assets = table(spark, d, "block_units").select("document_id", F.explode("asset_ids").alias("path")).distinct()
    return render.payload_markdown(e, assets, "2030-01-01 00:00:00")
