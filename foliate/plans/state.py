"""Queries on audits, plans and the state of catalogue and pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import identity
from ..operators import audit, bibliography, extras, ir, nested, runs, state, structure
from ..session import checkpointed, table
from .base import query
from .blocks import _B, _O, _WITH
from .nested import _KEYS, _ONE, _SCORES, NUMBER
from .runs import _R, _X


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return table(spark, d, name)


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return runs.distinct_runs(_t(spark, d, "runs"))


def _blocks(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return structure.distinct_blocks(_t(spark, d, "block_units"), *columns)


# ---- audits of payloads ---------------------------------------------------------------------


@query()
def extraction_inspection(spark: SparkSession, d: str) -> DataFrame:
    return audit.inspection(_t(spark, d, "extractions"), _t(spark, d, "inventory"))


@query()
def extraction_audit_summary(spark: SparkSession, d: str) -> DataFrame:
    return audit.summary(extraction_inspection(spark, d))


@query(f"""{_ONE}, c AS (SELECT record_id, count(*) FILTER (kind = 'page') AS pages, count(*) FILTER (regexp_full_match(node, 'p\\d+:b\\d+')) AS blocks, count(*) FILTER (regexp_full_match(node, 'p\\d+:d\\d+')) AS discarded, count(*) FILTER (kind = 'block') AS nodes, count(*) FILTER (kind = 'line') AS lines, count(*) FILTER (kind = 'span') AS spans FROM n GROUP BY 1)
    SELECT r.record_id, coalesce(pages, 0) AS pages, coalesce(blocks, 0) AS blocks, coalesce(discarded, 0) AS discarded, coalesce(nodes - blocks - discarded, 0) AS nested, coalesce(nodes, 0) AS nodes, coalesce(lines, 0) AS lines, coalesce(spans, 0) AS spans, '' AS failed FROM (SELECT DISTINCT record_id FROM extractions WHERE json_valid(payload)) r LEFT JOIN c ON r.record_id = c.record_id""")
def tree_validation(spark: SparkSession, d: str) -> DataFrame:
    return audit.tree_validation(_t(spark, d, "extractions"))


@query()
def tree_metrics(spark: SparkSession, d: str) -> DataFrame:
    return audit.document_metrics(_t(spark, d, "extractions"))


@query()
def metric_deltas(spark: SparkSession, d: str) -> DataFrame:
    """The first copy of each record against its newest."""
    e = _t(spark, d, "extractions")
    first = e.where(nested.is_json(F.col("payload"))).groupBy("record_id").agg(F.min_by(F.struct("document_id", "source_name", "payload", "received_at"), F.struct("received_at", "payload")).alias("r")).select("record_id", "r.*")
    return audit.metric_deltas(audit.document_metrics(first), audit.document_metrics(e))


@query(f"""{_ONE} SELECT CASE WHEN regexp_matches(node, '^p\\d+:d') THEN 'discarded' ELSE 'content' END AS collection, coalesce(obj->>'type', 'unknown') AS type, count(*) AS n, count(DISTINCT record_id) AS records FROM n WHERE kind = 'span' GROUP BY ALL""")
def span_type_counts(spark: SparkSession, d: str) -> DataFrame:
    s = ir.spans(_t(spark, d, "extractions"))
    at = F.when(F.col("node").rlike("^p\\d+:d"), "discarded").otherwise("content")
    return s.groupBy(at.alias("collection"), F.coalesce("type", F.lit("unknown")).alias("type")).agg(F.count("*").alias("n"), F.countDistinct("record_id").alias("records"))


@query(f"""{_ONE} SELECT type, {_SCORES} FROM (SELECT obj->>'type' AS type, {NUMBER.format('score')} AS score FROM n WHERE kind = 'span') GROUP BY ALL""")
def span_score_summary(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("score")
    return ir.spans(_t(spark, d, "extractions")).groupBy("type").agg(F.count("*").alias("n"), F.count(s).alias("with_score"), F.min(s).alias("score_min"), F.avg(s).alias("score_mean"), F.median(s).alias("score_median"), F.max(s).alias("score_max"))


@query(f"""{_ONE}, x AS (SELECT record_id, CASE WHEN kind = 'block' THEN coalesce(obj->>'type', obj->>'block_type') ELSE obj->>'type' END AS type, length(coalesce(obj->>'html', '')) > 0 AS html, length(coalesce(obj->>'latex', '')) > 0 AS latex FROM n WHERE kind IN ('block', 'span'))
    SELECT record_id, count(*) FILTER (type = 'table' AND html) AS tables_filled, count(*) FILTER (type = 'table' AND NOT html) AS tables_empty, count(*) FILTER (type IN ('interline_equation', 'inline_equation') AND latex) AS formulas_filled, count(*) FILTER (type IN ('interline_equation', 'inline_equation') AND NOT latex) AS formulas_empty FROM x GROUP BY ALL""")
def table_formula_summary(spark: SparkSession, d: str) -> DataFrame:
    """Per record tables with and without HTML, formulas with and without LaTeX, of blocks and of spans."""
    parsed = checkpointed(ir.nodes(_t(spark, d, "extractions")))
    cols = ("record_id", "type", "html", "latex")
    both = ir.blocks(None, parsed).select(*cols).unionByName(ir.spans(None, parsed).select(*cols))
    filled = lambda c: F.coalesce(F.length(c), F.lit(0)) > 0
    tables, formulas = F.col("type") == "table", F.col("type").isin("interline_equation", "inline_equation")
    return both.groupBy("record_id").agg(F.count_if(tables & filled("html")).alias("tables_filled"), F.count_if(tables & ~filled("html")).alias("tables_empty"), F.count_if(formulas & filled("latex")).alias("formulas_filled"), F.count_if(formulas & ~filled("latex")).alias("formulas_empty"))


@query(f"""{_KEYS} SELECT kind, key, count(DISTINCT record_id) AS records, count(*) AS occurrences FROM k GROUP BY ALL""")
def key_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Keys per record and level first, then over records: how many hold a key and how often it stands."""
    one = nested.record_key_counts(_t(spark, d, "extractions"))
    return one.groupBy("kind", "key").agg(F.countDistinct("record_id").alias("records"), F.sum("n").alias("occurrences"))


@query()
def duplicate_ratio(spark: SparkSession, d: str) -> DataFrame:
    return ir.preproc_ratio(_t(spark, d, "extractions"))


@query()
def referenced_images(spark: SparkSession, d: str) -> DataFrame:
    """Images that blocks and spans name and no asset of the record's document is called by."""
    e = _t(spark, d, "extractions")
    parsed = checkpointed(ir.nodes(e))
    named = ir.blocks(None, parsed).select("record_id", "image_path").unionByName(ir.spans(None, parsed).select("record_id", "image_path")).where("image_path is not null")
    refs = named.join(e.select("record_id", "document_id").distinct(), "record_id").select("document_id", F.substring_index("image_path", "/", -1).alias("path"))
    held = structure.assets(_t(spark, d, "block_units")).select("document_id", F.substring_index("asset_id", "/", -1).alias("path"))
    return state.missing_references(refs, held, ["document_id", "path"])


# ---- structure ------------------------------------------------------------------------------

_FURNITURE = "('header', 'footer', 'page_number')"


@query(f"SELECT block_id, CASE WHEN source_type IN {_FURNITURE} THEN 'furniture' ELSE 'content' END AS part, coalesce(page, 0) = 0 AS first_page, length(text) AS chars FROM {_B}")
def html_furniture_split(spark: SparkSession, d: str) -> DataFrame:
    """Every block as furniture or content, and whether it stands on the first page."""
    b = _blocks(spark, d, "source_type", "page", "text")
    return b.select("block_id", F.when(F.col("source_type").isin(*structure.FURNITURE), "furniture").otherwise("content").alias("part"), (F.coalesce("page", F.lit(0)) == 0).alias("first_page"), F.length("text").cast("long").alias("chars"))


_STARTS = "('abstract', 'resumen', 'resumo', 'introducao', 'introduction', 'introduccion')"
_HEAD = "trim(regexp_replace(lower(strip_accents(regexp_replace(text, '<[^>]+>', ' ', 'g'))), '[\\s\\x{85}\\x{A0}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{3000}]+', ' ', 'g'), ' .:-')"


@query(f"""WITH o AS (SELECT *, role = 'title' AS t, CASE WHEN role = 'title' THEN {_HEAD} END AS h FROM {_O} WHERE document_id IS NOT NULL),
    f AS (SELECT *, bool_or(coalesce(t AND h NOT IN {_STARTS}, false)) OVER w AS seen, bool_or(coalesce(t AND h IN {_STARTS} OR role = 'abstract', false)) OVER w AS over FROM o WINDOW w AS (PARTITION BY document_id ORDER BY position ROWS UNBOUNDED PRECEDING))
    SELECT block_id, coalesce(seen AND NOT over AND NOT t AND coalesce(page, 0) <= 1, false) AS front_matter FROM f""")
def front_matter_flags(spark: SparkSession, d: str) -> DataFrame:
    return structure.front_matter(_t(spark, d, "block_units"))


@query(f"""{_WITH}, x AS (SELECT block_id, section FROM s), n AS (SELECT t.block_id AS section, t.level, count(x.block_id) AS held FROM titles t LEFT JOIN x ON x.section = t.block_id AND x.block_id <> t.block_id GROUP BY 1, 2),
    a AS (SELECT DISTINCT document_id, block_id, role, unnest(asset_ids) AS asset_id FROM {_B})
    SELECT 'sections' AS what, CAST(level AS VARCHAR) AS key, count(*) AS n FROM n GROUP BY 2 UNION ALL SELECT 'empty_sections', CAST(level AS VARCHAR), count(*) FROM n WHERE held = 0 GROUP BY 2
    UNION ALL SELECT 'roles', role, count(*) FROM {_B} GROUP BY 2 UNION ALL SELECT 'source_types', source_type, count(*) FROM {_B} GROUP BY 2
    UNION ALL SELECT 'assets', CASE WHEN role IN ('figure', 'chart', 'table', 'equation', 'code') THEN role ELSE 'figure' END, count(*) FROM a GROUP BY 2""")
def structure_summary(spark: SparkSession, d: str) -> DataFrame:
    return structure.summary(_t(spark, d, "block_units"))


@query(f"""{_WITH}, l AS (SELECT *, role = 'list' AND NOT (coalesce(lag(role = 'list') OVER w, false) AND lag(section) OVER w IS NOT DISTINCT FROM section) AS st FROM s WINDOW w AS (PARTITION BY document_id ORDER BY position)),
    a AS (SELECT document_id, count(*) AS assets FROM (SELECT DISTINCT document_id, block_id, unnest(asset_ids) AS x FROM {_B}) GROUP BY 1)
    SELECT l.document_id, count(*) AS blocks, count(DISTINCT page) AS pages, count(*) FILTER (source_type IN {_FURNITURE}) AS furniture, count(level) AS sections, count(*) FILTER (st) AS list_groups, coalesce(max(assets), 0) AS assets, '' AS failed
    FROM l LEFT JOIN a ON a.document_id IS NOT DISTINCT FROM l.document_id GROUP BY 1""")
def structure_checks(spark: SparkSession, d: str) -> DataFrame:
    """Counts of each document's structure and the checks that fail, none."""
    return structure.checks(_t(spark, d, "block_units"))


@query(f"""WITH a AS (SELECT DISTINCT document_id, block_id, coalesce(length(text), 0) > 0 AS material, CASE WHEN role IN ('figure', 'chart', 'table', 'equation', 'code') THEN role ELSE 'figure' END AS kind, unnest(asset_ids) AS asset_id FROM {_B}),
    m AS (SELECT *, bool_or(material) OVER (PARTITION BY document_id, asset_id, kind) AS has FROM a) SELECT document_id, asset_id, kind, min(block_id) AS block_id, count(*) AS blocks FROM m WHERE material OR NOT has GROUP BY 1, 2, 3""")
def material_assets(spark: SparkSession, d: str) -> DataFrame:
    """Each asset of a document once per kind; mentions by empty blocks count only where no other mentions it."""
    b = _blocks(spark, d, "document_id", "role", "text", "asset_ids").where(F.size("asset_ids") > 0)
    a = b.select("document_id", "block_id", (F.coalesce(F.length("text"), F.lit(0)) > 0).alias("material"), F.coalesce(structure._lookup(F.col("role"), structure.ASSET_KIND_BY_ROLE), F.lit("figure")).alias("kind"), F.explode(F.array_distinct("asset_ids")).alias("asset_id"))
    g = a.groupBy("document_id", "asset_id", "kind").agg(F.min(F.when(F.col("material"), F.col("block_id"))).alias("m"), F.count_if("material").alias("n"), F.min("block_id").alias("b"), F.count("*").alias("all"))
    return g.select("document_id", "asset_id", "kind", F.coalesce("m", "b").alias("block_id"), F.when(F.col("n") > 0, F.col("n")).otherwise(F.col("all")).alias("blocks"))


@query(f"SELECT b.block_id, b.document_id, CASE WHEN b.role IN ('body', 'abstract', 'list', 'reference', 'metadata') THEN 'embed' WHEN b.role IN ('table', 'figure', 'chart', 'equation', 'code') THEN 'payload' WHEN b.role = 'title' THEN 'placeholder' ELSE 'exclude' END AS action, p.kind AS splitter, b.position FROM {_O} b JOIN splitter_policies p ON b.collection_slug = p.collection_slug WHERE b.text IS NOT NULL")
def annotated_policies(spark: SparkSession, d: str) -> DataFrame:
    """Blocks in flow order with their role's action and their collection's splitter."""
    from ..operators import chunking

    o = structure.reading_order(_t(spark, d, "block_units"), "role", "collection_slug", "text").where("text is not null")
    return chunking.with_actions(o).join(_t(spark, d, "splitter_policies").select("collection_slug", F.col("kind").alias("splitter")), "collection_slug").select("block_id", "document_id", "action", "splitter", "position")


@query(f"SELECT document_id, count(*) AS chunks, count(DISTINCT a) AS assets, CAST(coalesce(sum(CASE WHEN k = 1 OR k IS NULL THEN 4 * ceil(octet_length(encode(text)) / 3.0) END), 0) AS BIGINT) AS base64_chars FROM (SELECT document_id, text, unnest(CASE WHEN len(asset_ids) > 0 THEN asset_ids ELSE [NULL] END) AS a, unnest(CASE WHEN len(asset_ids) > 0 THEN range(1, len(asset_ids) + 1) ELSE [NULL] END) AS k FROM {_B} WHERE text IS NOT NULL) GROUP BY 1")
def ingest_metrics(spark: SparkSession, d: str) -> DataFrame:
    b = _blocks(spark, d, "document_id", "text", "asset_ids").where("text is not null")
    x = b.select("document_id", F.octet_length("text").alias("n"), F.posexplode_outer("asset_ids").alias("k", "a"))
    first = F.coalesce(F.col("k"), F.lit(0)) == 0
    return x.groupBy("document_id").agg(F.count("*").alias("chunks"), F.countDistinct("a").alias("assets"), F.coalesce(F.sum(F.when(first, 4 * F.ceil(F.col("n") / 3))), F.lit(0)).cast("long").alias("base64_chars"))


@query(f"SELECT block_id, (text <> '' OR len(asset_ids) > 0) IS TRUE AS has_content FROM {_B}")
def has_content(spark: SparkSession, d: str) -> DataFrame:
    b = _blocks(spark, d, "text", "asset_ids")
    return b.select("block_id", (extras.has_content(["text"]) | (F.coalesce(F.col("text"), F.lit("")) != "") | (F.coalesce(F.size("asset_ids"), F.lit(0)) > 0)).alias("has_content"))


@query()
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose authors a human has to see, with the reason and the candidates."""
    from .blocks import bibliographic_records

    return bibliographic_records(spark, d).where("review is not null").select("document_id", "review", "authors", "author_confidence")


# ---- inventories, plans, packages -----------------------------------------------------------


@query("""SELECT document_id, revision_id, relative_path AS relative_pdf_path, path AS pdf_path, regexp_replace(path, '[^/]*$', '') || b AS document_dir, regexp_replace(path, '[^/]*$', '') || b || '/intermediate' AS intermediate_dir, regexp_replace(path, '[^/]*$', '') || b || '/intermediate/results' AS results_dir, regexp_replace(path, '[^/]*$', '') || b || '/canonical' AS canonical_dir,
    regexp_replace(path, '[^/]*$', '') || b || '/manifest.json' AS manifest_path, regexp_replace(path, '[^/]*$', '') || b || '/canonical/document_ir.json' AS ir_path, regexp_replace(path, '[^/]*$', '') || b || '/canonical/structure.json' AS structure_path, regexp_replace(path, '[^/]*$', '') || b || '/canonical/metadata.json' AS metadata_path,
    regexp_replace(path, '[^/]*$', '') || b || '/canonical/document.md' AS markdown_path, regexp_replace(path, '[^/]*$', '') || b || '/canonical/render.json' AS render_path, NOT starts_with(relative_path, '/') AND NOT regexp_matches(relative_path, '(^|/)\\.\\.(/|$)') AND ends_with(lower(relative_path), '.pdf') AS valid
    FROM (SELECT *, rtrim(regexp_replace(regexp_replace(relative_path, '^.*/', ''), '\\.[^.]*$', ''), ' .') AS b FROM inventory WHERE relative_path IS NOT NULL AND path IS NOT NULL)""")
def document_layouts(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import inventory

    return inventory.layouts(_t(spark, d, "inventory"))


@query("SELECT document_id, revision_id, trim(regexp_replace(lower(strip_accents(collection)), '[^a-z0-9]+', '-', 'g'), '-') = collection_slug AS slug_ok FROM inventory WHERE collection IS NOT NULL")
def config_identity(spark: SparkSession, d: str) -> DataFrame:
    i = _t(spark, d, "inventory").where("collection is not null")
    return i.select("document_id", "revision_id", (identity.slug(F.col("collection")) == F.col("collection_slug")).alias("slug_ok"))


_LATEST = f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY try_cast(completed_at AS TIMESTAMPTZ) DESC NULLS LAST, log_path DESC NULLS LAST) AS rn FROM {_R} WHERE sha256 IS NOT NULL) WHERE rn = 1)"


@query(f"SELECT sha256, completed_at FROM {_LATEST} WHERE try_cast(completed_at AS TIMESTAMPTZ) >= TIMESTAMPTZ '2024-01-01 00:00:00+00' AND sha256 NOT IN (SELECT sha256 FROM inventory WHERE page_count > 8 AND sha256 IS NOT NULL)")
def promotion_candidates(spark: SparkSession, d: str) -> DataFrame:
    r = _runs(spark, d).where("sha256 is not null")
    done = F.try_to_timestamp(F.col("completed_at"))
    latest = r.groupBy("sha256").agg(F.max_by(F.struct("completed_at"), F.struct(done, "log_path")).alias("r")).select("sha256", "r.*")
    known = _t(spark, d, "inventory").where("page_count > 8 and sha256 is not null")
    return state.promotion_candidates(latest, known, "sha256", done, F.lit("2024-01-01 00:00:00").cast("timestamp")).select("sha256", "completed_at")


@query("SELECT i.document_id, i.revision_id, i.path, coalesce(n, 0) AS found FROM inventory i LEFT JOIN (SELECT path, count(*) AS n FROM runs GROUP BY 1) r USING (path)")
def promoted_inventory(spark: SparkSession, d: str) -> DataFrame:
    return state.looked_up(_t(spark, d, "inventory").select("document_id", "revision_id", "path"), _t(spark, d, "runs"), "path")


@query("""WITH s AS (SELECT sha256, arg_min(path, (CASE WHEN status = 'ok' THEN 0 ELSE 1 END, lower(path), path)) AS source, count(DISTINCT path) AS copies FROM inventory WHERE sha256 IS NOT NULL GROUP BY 1),
    w AS (SELECT DISTINCT sha256, document_id, path AS wanted FROM runs WHERE sha256 IS NOT NULL AND path IS NOT NULL), j AS (SELECT w.*, s.source, coalesce(copies, 0) AS copies, '/store/' || document_id || '.pdf' AS target FROM w LEFT JOIN s USING (sha256))
    SELECT *, count(*) OVER (PARTITION BY target) > 1 AS collision FROM j""")
def bootstrap_plan(spark: SparkSession, d: str) -> DataFrame:
    """For every document seen in a run its source by hash, its target, the number of copies and whether two documents share the target."""
    path = F.struct((F.col("status") != "ok").cast("int").alias("p"), F.lower("path").alias("l"), "path")
    s = _t(spark, d, "inventory").where("sha256 is not null").groupBy("sha256").agg(F.min(path)["path"].alias("source"), F.countDistinct("path").alias("copies"))
    w = _t(spark, d, "runs").where("sha256 is not null and path is not null").select("sha256", "document_id", F.col("path").alias("wanted")).distinct()
    j = w.join(s, "sha256", "left").select("sha256", "document_id", "wanted", "source", F.coalesce("copies", F.lit(0)).alias("copies"), F.concat(F.lit("/store/"), "document_id", F.lit(".pdf")).alias("target"))
    n = j.groupBy("target").agg((F.count("*") > 1).alias("collision"))
    return j.join(n, j["target"].eqNullSafe(n["target"])).select(j["*"], "collision")


@query("SELECT revision_id, document_id, array_to_string(list_filter([CASE WHEN NOT coalesce(regexp_full_match(lower(sha256), '[0-9a-f]{64}'), false) THEN 'key' END, CASE WHEN coalesce(page_count, 0) <> 1 THEN 'files' END, CASE WHEN NOT coalesce(regexp_full_match(lower(sha256), '[0-9a-f]{64}'), false) THEN 'declared_hash' END, CASE WHEN NOT coalesce(lower(filename) = lower(sha256) || '.pdf', false) THEN 'name' END], lambda x: x IS NOT NULL), ',') AS errors FROM inventory")
def submission_validation(spark: SparkSession, d: str) -> DataFrame:
    h = F.col("sha256")
    return _t(spark, d, "inventory").select("revision_id", "document_id", F.array_join(state.submission_errors(h, F.col("page_count"), F.col("filename"), h, F.upper(h)), ",").alias("errors"))


@query("""SELECT o_orderkey, sha256('{"customer":' || o_custkey || ',"order":' || o_orderkey || ',"status":"' || o_orderstatus || '"}') AS plan_sha256, o_orderkey % 10 <> 3 AS valid FROM orders""")
def plan_checksum(spark: SparkSession, d: str) -> DataFrame:
    """Plans with the checksum of their canonical body and whether the declared one, spoilt for every tenth, equals it."""
    o = _t(spark, d, "orders")
    body = identity.canonical_json({"customer": F.col("o_custkey"), "order": F.col("o_orderkey"), "status": F.col("o_orderstatus")})
    h = F.sha2(body, 256)
    declared = F.when(F.col("o_orderkey") % 10 == 3, F.reverse(h)).otherwise(h)
    return o.select("o_orderkey", h.alias("plan_sha256"), (h == declared).alias("valid"))


@query("""WITH p AS (SELECT l_orderkey, count(*) AS artifacts, CAST(sum(l_quantity) AS BIGINT) AS bytes FROM lineitem GROUP BY 1) SELECT l_orderkey, artifacts, bytes, l_orderkey % 7 <> 0 AND l_orderkey % 5 <> 0 AS reuse FROM p""")
def artifact_revalidation(spark: SparkSession, d: str) -> DataFrame:
    """Packages that need no second look; the previous audit lacks every seventh and saw other bytes in every fifth."""
    a = _t(spark, d, "lineitem").select("l_orderkey", F.col("l_quantity").cast("long").alias("size"))
    before = a.groupBy("l_orderkey").agg(F.count("*").alias("artifacts"), (F.sum("size") + F.when(F.col("l_orderkey") % 5 == 0, 1).otherwise(0)).alias("bytes")).where("l_orderkey % 7 <> 0")
    return state.revalidation(a, before, "l_orderkey", "size")


@query(f"""WITH o AS (SELECT l_orderkey, l_linenumber, l_partkey AS v, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS dup, l_linenumber AS p FROM lineitem),
    n AS (SELECT DISTINCT l_orderkey, CAST(l_linenumber + 2 AS INTEGER) AS l_linenumber FROM lineitem WHERE l_orderkey % 4 = 0)
    SELECT coalesce(o.l_orderkey, n.l_orderkey) AS l_orderkey, coalesce(o.l_linenumber, n.l_linenumber) AS l_linenumber, CASE WHEN n.l_orderkey IS NOT NULL THEN -1 ELSE o.v END AS value, coalesce(dup, false) AS duplicate FROM o FULL JOIN n ON o.l_orderkey = n.l_orderkey AND o.l_linenumber = n.l_linenumber""")
def manifest_merge(spark: SparkSession, d: str) -> DataFrame:
    """Artefacts of every fourth manifest replaced or appended."""
    t = _t(spark, d, "lineitem")
    old = t.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("value"), F.col("l_linenumber").alias("position"))
    new = t.where("l_orderkey % 4 = 0").select("l_orderkey", (F.col("l_linenumber") + 2).cast("int").alias("l_linenumber"), F.lit(-1).cast("long").alias("value")).distinct()
    return state.merged_manifest(old, new, "l_orderkey", "l_linenumber", "value", "position").drop("place")


@query("""WITH a AS (SELECT l_orderkey, l_partkey, l_quantity FROM lineitem), b AS (SELECT l_orderkey, l_partkey, CASE WHEN l_orderkey % 50 = 1 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity FROM lineitem WHERE l_orderkey % 61 <> 2),
    u AS (SELECT *, 1 AS d FROM a UNION ALL SELECT *, -1 FROM b), g AS (SELECT l_orderkey, abs(sum(d)) AS d FROM u GROUP BY l_orderkey, l_partkey, l_quantity) SELECT l_orderkey, CAST(sum(d) AS BIGINT) AS different FROM g GROUP BY 1""")
def inventory_drift(spark: SparkSession, d: str) -> DataFrame:
    a = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    b = a.where("l_orderkey % 61 <> 2").withColumn("l_quantity", F.when(F.col("l_orderkey") % 50 == 1, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    return state.drift(a, b, "l_orderkey", ["l_partkey", "l_quantity"])


@query("""WITH f AS (SELECT l_orderkey AS package, CASE WHEN l_linenumber = 1 THEN 'doc_middle.json' WHEN l_linenumber = 2 THEN 'document.md' ELSE 'images/' || l_linenumber || '.jpg' END AS path, min(l_partkey) AS h FROM lineitem GROUP BY 1, 2),
    g AS (SELECT package, path, CASE WHEN package % 9 = 0 THEN h + 1 ELSE h END AS h FROM f WHERE package % 11 <> 0 OR path <> 'doc_middle.json'),
    j AS (SELECT coalesce(f.package, g.package) AS package, f.path AS p, f.h IS DISTINCT FROM g.h AS bad FROM f FULL JOIN g ON f.package = g.package AND f.path = g.path)
    SELECT package, count(*) FILTER (bad) AS different, count(*) FILTER (ends_with(p, '_middle.json')) AS json, count(*) FILTER (ends_with(p, '.md')) AS markdown, count(*) FILTER (bad) = 0 AND count(*) FILTER (ends_with(p, '_middle.json')) = 1 AND count(*) FILTER (ends_with(p, '.md')) >= 1 AS valid FROM j GROUP BY 1""")
def package_members(spark: SparkSession, d: str) -> DataFrame:
    """Packages whose files and hashes agree and that hold their two required members."""
    n = F.col("l_linenumber")
    path = F.when(n == 1, "doc_middle.json").when(n == 2, "document.md").otherwise(F.concat(F.lit("images/"), n.cast("string"), F.lit(".jpg")))
    a = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("package"), path.alias("path")).agg(F.min("l_partkey").alias("h"))
    b = a.where("package % 11 <> 0 or path <> 'doc_middle.json'").withColumn("h", F.when(F.col("package") % 9 == 0, F.col("h") + 1).otherwise(F.col("h")))
    return state.package_check(a, b, "package", "path", "h")


@query(f"SELECT DISTINCT document_id, pod_number FROM {_R} WHERE document_id IS NOT NULL AND pod_number IS NOT NULL EXCEPT SELECT document_id, pod_number FROM {_R} WHERE status = 'error'")
def unused_task_ids(spark: SparkSession, d: str) -> DataFrame:
    r = _runs(spark, d)
    c = r.where("document_id is not null and pod_number is not null").select("document_id", "pod_number").distinct()
    return state.unused_ids(c, r, ["document_id", "pod_number"], F.col("status") == "error")


@query("""WITH e AS (SELECT l_orderkey, l_linenumber, min(l_quantity) AS q FROM lineitem WHERE l_orderkey % 13 <> 0 GROUP BY 1, 2), l AS (SELECT l_orderkey, l_linenumber, min(l_quantity) + CASE WHEN l_orderkey % 17 = 0 THEN 1 ELSE 0 END AS q FROM lineitem WHERE l_linenumber <> 4 GROUP BY 1, 2),
    j AS (SELECT CASE WHEN l.l_orderkey IS NULL THEN 'missing' WHEN e.l_orderkey IS NULL THEN 'extra' WHEN l.q IS DISTINCT FROM e.q THEN 'changed' ELSE 'ok' END AS verdict FROM e FULL JOIN l ON e.l_orderkey = l.l_orderkey AND e.l_linenumber = l.l_linenumber) SELECT verdict, count(*) AS n FROM j GROUP BY 1""")
def dump_verdicts(spark: SparkSession, d: str) -> DataFrame:
    k = ["l_orderkey", "l_linenumber"]
    t = _t(spark, d, "lineitem").groupBy(*k).agg(F.min("l_quantity").alias("q"))
    e = t.where("l_orderkey % 13 <> 0")
    seen = t.where("l_linenumber <> 4").withColumn("q", F.when(F.col("l_orderkey") % 17 == 0, F.col("q") + 1).otherwise(F.col("q")))
    return state.dump_report(seen, e, k, "q").groupBy("verdict").agg(F.count("*").alias("n"))


@query(f"SELECT document_position, log_path, sha256, sha256 IS NOT NULL AND row_number() OVER (PARTITION BY sha256 ORDER BY document_position, log_path, started_at, completed_at) > 1 AS duplicate FROM {_R}")
def duplicate_tasks(spark: SparkSession, d: str) -> DataFrame:
    return state.duplicate_hashes(_runs(spark, d), "sha256", ["document_position", "log_path", "started_at", "completed_at"]).select("document_position", "log_path", "sha256", "duplicate")


@query("""WITH l AS (SELECT event_id AS p, 'pod-' || user_id AS k, event_type, event_type = 'purchase' AND event_id % 50 = 0 AS reset, value FROM events), r AS (SELECT max(p) AS r FROM l WHERE reset)
    SELECT k, p, event_type, reset, value FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p DESC) AS rn FROM l WHERE p > coalesce((SELECT r FROM r), -1)) WHERE rn = 1""")
def dashboard_after_reset(spark: SparkSession, d: str) -> DataFrame:
    reset = (F.col("event_type") == "purchase") & (F.col("event_id") % 50 == 0)
    e = _t(spark, d, "events").select(F.col("event_id").alias("p"), F.concat(F.lit("pod-"), F.col("user_id").cast("string")).alias("k"), "event_type", reset.alias("reset"), "value")
    return state.last_after_reset(e, "k", "p", F.col("reset")).select("k", "p", "event_type", "reset", "value")


@query(f"""WITH u AS (SELECT document_id, lower(api_url) AS url, min((document_position, log_path, started_at, completed_at)) AS seen FROM {_R} WHERE document_id IS NOT NULL AND api_url IS NOT NULL GROUP BY 1, 2) SELECT document_id, string_agg(url, ' ' ORDER BY seen, url) AS urls FROM u GROUP BY 1""")
def ordered_urls(spark: SparkSession, d: str) -> DataFrame:
    """The endpoints each document met, each once, in the order first met."""
    r = _runs(spark, d).where("document_id is not null and api_url is not null").groupBy("document_id", F.lower("api_url").alias("url")).agg(F.min(F.struct("document_position", "log_path", "started_at", "completed_at")).alias("seen"))
    return r.groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seen", "url"))), lambda x: x["url"]), " ").alias("urls"))


# ---- catalogue ------------------------------------------------------------------------------


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'insert' WHEN o_orderkey % 5 = 0 THEN 'conflict' ELSE 'keep' END AS action FROM orders")
def create_snapshots(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    old = o.where("o_orderkey % 3 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return state.create_if_absent(old, o, "o_orderkey", ["o_custkey", "o_totalprice"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return state.insert_ignore(o.where("o_orderkey % 3 <> 0"), o.withColumn("o_orderstatus", F.lit("new")), "o_orderkey")


@query("""SELECT collection_slug, count(*) AS n, sha256(string_agg('{"document_id":"' || document_id || '","revision_id":"' || revision_id || '","sha256":"' || sha256 || '"}' || chr(10), '' ORDER BY document_id, revision_id, sha256)) AS sha256
    FROM inventory WHERE status = 'ok' AND document_id IS NOT NULL AND revision_id IS NOT NULL AND sha256 IS NOT NULL GROUP BY 1""")
def snapshot_digests(spark: SparkSession, d: str) -> DataFrame:
    i = _t(spark, d, "inventory").where("status = 'ok' and document_id is not null and revision_id is not null and sha256 is not null")
    line = identity.canonical_json({c: F.col(c) for c in ("document_id", "revision_id", "sha256")})
    return state.snapshot_digests(i, "collection_slug", line, ["document_id", "revision_id"])


@query()
def fenced_runs(spark: SparkSession, d: str) -> DataFrame:
    """Every event as a step of a stage run: views claim, the others move on, retries come from the owner and from others."""
    kind = F.array(*map(F.lit, ("claim", "processing", "heartbeat", "uploading", "cataloging", "completed", "failed", "orphaned")))
    e = _t(spark, d, "events").select(
        F.col("user_id").cast("string").alias("run"), F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("t"), F.when(F.col("event_id") % 11 == 0, "b").otherwise("a").alias("owner"), F.lit(None).cast("int").alias("attempt"), F.get(kind, (F.col("event_id") % 8).cast("int")).alias("what")
    )
    return state.fenced_runs(e.withColumn("t", F.col("t") / 1e6))


@query("""SELECT o_custkey, o_orderpriority, count(*) AS records, bool_and(o_orderstatus = 'F') AS complete FROM orders GROUP BY 1, 2 HAVING count(*) = 1 AND bool_and(o_orderstatus = 'F')""")
def complete_alias(spark: SparkSession, d: str) -> DataFrame:
    """Keys with exactly one legacy record, which is complete."""
    return _t(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("records"), F.min((F.col("o_orderstatus") == "F")).alias("complete")).where("records = 1 and complete")


@query("""SELECT CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'pending' END AS status, count(*) AS manifests, count(n) AS with_artifacts, CAST(coalesce(sum(n), 0) AS BIGINT) AS artifacts, CAST(coalesce(sum(u), 0) AS BIGINT) AS hashes
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_partkey) AS u FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey GROUP BY 1""")
def manifest_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    a = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.countDistinct("l_partkey").alias("u"))
    j = _t(spark, d, "orders").join(a, "o_orderkey", "left")
    return j.groupBy(F.when(F.col("o_orderstatus") == "F", "completed").otherwise("pending").alias("status")).agg(F.count("*").alias("manifests"), F.count("n").alias("with_artifacts"), F.coalesce(F.sum("n"), F.lit(0)).alias("artifacts"), F.coalesce(F.sum("u"), F.lit(0)).alias("hashes"))


# ---- runs and sizes -------------------------------------------------------------------------


@query("SELECT extension, coalesce(producer, '-') AS name, count(*) AS n, round(CAST(sum(size_bytes) AS DOUBLE) / 1048576, 3) AS mb FROM inventory GROUP BY 1, 2")
def artifact_summary(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "inventory").groupBy("extension", F.coalesce("producer", F.lit("-")).alias("name")).agg(F.count("*").alias("n"), F.round(F.sum("size_bytes").cast("double") / 1048576, 3).alias("mb"))


@query(f"SELECT document_id, count(*) AS n, round(sum(duration_seconds), 6) AS total, round(median(duration_seconds), 9) AS middle, round(quantile_cont(duration_seconds, 0.95), 9) AS p95, max(duration_seconds) AS most FROM {_R} WHERE {_X} AND document_id IS NOT NULL GROUP BY 1")
def document_timings(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("duration_seconds")
    r = _runs(spark, d).where(x.isNotNull() & ~F.isnan(x) & F.col("document_id").isNotNull())
    return r.groupBy("document_id").agg(F.count("*").alias("n"), F.round(F.sum(x), 6).alias("total"), F.round(F.median(x), 9).alias("middle"), F.round(F.percentile(x, 0.95), 9).alias("p95"), F.max(x).alias("most"))


@query(f"SELECT document_id, log_path, duration_seconds FROM {_R} WHERE {_X} ORDER BY duration_seconds DESC, document_id, log_path, started_at LIMIT 20")
def slowest_runs(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("duration_seconds")
    return _runs(spark, d).where(x.isNotNull() & ~F.isnan(x)).orderBy(x.desc(), "document_id", "log_path", "started_at").limit(20).select("document_id", "log_path", "duration_seconds")


@query(f"SELECT i.document_id, i.revision_id, r.status AS run_status, r.return_code, r.pod_number FROM inventory i LEFT JOIN (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY try_cast(started_at AS TIMESTAMPTZ) DESC NULLS LAST, document_position DESC NULLS LAST) AS rn FROM {_R} WHERE document_id IS NOT NULL) WHERE rn = 1) r USING (document_id)")
def audited_with_runs(spark: SparkSession, d: str) -> DataFrame:
    """Every inventory row with what its last run says."""
    last = runs.last_runs(_runs(spark, d)).select("document_id", F.col("status").alias("run_status"), "return_code", "pod_number")
    return _t(spark, d, "inventory").select("document_id", "revision_id").join(last, "document_id", "left")


@query("SELECT document_id, revision_id, lower(coalesce(status, '')) = 'ok' AND modified_at IS NOT NULL AND (coalesce(artifact_dir, '') <> '' OR coalesce(manifest_path, '') <> '') AND coalesce(page_count, 0) > 0 AS complete FROM inventory")
def persisted_complete(spark: SparkSession, d: str) -> DataFrame:
    """Completed, stored at a known time and place, with at least one part."""
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    ok = (F.lower(F.coalesce("status", F.lit(""))) == "ok") & F.col("modified_at").isNotNull() & (filled("artifact_dir") | filled("manifest_path")) & (F.coalesce("page_count", F.lit(0)) > 0)
    return _t(spark, d, "inventory").select("document_id", "revision_id", ok.alias("complete"))


@query("""SELECT a.document_id, a.sha256, (a.sha256 IS NOT DISTINCT FROM b.sha256 AND a.size_bytes IS NOT DISTINCT FROM b.size_bytes AND a.pdf_version IS NOT DISTINCT FROM b.pdf_version) AS current FROM (SELECT document_id, max_by(sha256, (try_cast(modified_at AS TIMESTAMPTZ), revision_id)) AS sha256, max_by(size_bytes, (try_cast(modified_at AS TIMESTAMPTZ), revision_id)) AS size_bytes, arg_max_null(pdf_version, (try_cast(modified_at AS TIMESTAMPTZ), revision_id)) AS pdf_version FROM inventory GROUP BY 1) a
    JOIN (SELECT document_id, min_by(sha256, (try_cast(modified_at AS TIMESTAMPTZ), revision_id)) AS sha256, min_by(size_bytes, (try_cast(modified_at AS TIMESTAMPTZ), revision_id)) AS size_bytes, arg_min_null(pdf_version, (try_cast(modified_at AS TIMESTAMPTZ), revision_id)) AS pdf_version FROM inventory GROUP BY 1) b USING (document_id)""")
def current_results(spark: SparkSession, d: str) -> DataFrame:
    """Whether what was made of a document's first scan still holds for its newest: hash, size and version all equal."""
    order = F.struct(F.try_to_timestamp(F.col("modified_at")), "revision_id")
    facts = F.struct("sha256", "size_bytes", "pdf_version")
    g = _t(spark, d, "inventory").groupBy("document_id").agg(F.max_by(facts, order).alias("a"), F.min_by(facts, order).alias("b"))
    return g.where("document_id is not null").select("document_id", "a.sha256", F.col("a").eqNullSafe(F.col("b")).alias("current"))


@query("SELECT CAST(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') - k * INTERVAL '6 hours' AS TIMESTAMP) AS window_start, event_type, count(*) AS n FROM events, range(0, 4) t(k) GROUP BY 1, 2")
def sliding_activity(spark: SparkSession, d: str) -> DataFrame:
    """Events of each day-long window that begins every six hours, as a stream run to its end."""
    from ..streaming import streams

    return streams.drained(streams.sliding(streams.event_stream(spark, f"{d}/events.parquet")), "update", ["window_start", "event_type"])


@query("""WITH l AS (SELECT DISTINCT l_orderkey AS k, CASE l_linenumber % 4 WHEN 0 THEN 'a' || l_linenumber || '.png' WHEN 1 THEN 'images/a' || l_linenumber || '.png' WHEN 2 THEN 'old/deep/a' || l_linenumber || '.png' ELSE 'new/b' || l_linenumber || '.png' END AS p FROM lineitem),
    r AS (SELECT DISTINCT l_orderkey AS k, CASE WHEN l_linenumber % 4 = 3 AND l_orderkey % 2 = 0 THEN 'new/b' ELSE 'pics/a' END || l_linenumber || '.png' AS ref FROM lineitem),
    h AS (SELECT r.k, r.ref, l.p, CASE WHEN l.p = r.ref THEN 0 WHEN l.p = 'images/' || regexp_replace(r.ref, '^.*/', '') THEN 1 WHEN l.p = regexp_replace(r.ref, '^.*/', '') THEN 2 ELSE 3 END AS rank FROM r JOIN l ON r.k = l.k AND regexp_replace(r.ref, '^.*/', '') = regexp_replace(l.p, '^.*/', ''))
    SELECT r.k AS package, r.ref AS reference, m.p AS resolved FROM r LEFT JOIN (SELECT k, ref, arg_min(p, (rank, p)) AS p FROM h GROUP BY 1, 2) m ON r.k = m.k AND r.ref = m.ref""")
def asset_paths(spark: SparkSession, d: str) -> DataFrame:
    """References of packages' images against their listings, by three candidates and then by name."""
    n, k = F.col("l_linenumber"), F.col("l_orderkey")
    file = lambda letter: F.concat(F.lit(letter), n.cast("string"), F.lit(".png"))
    t = _t(spark, d, "lineitem")
    listing = t.select(k.alias("package"), F.when(n % 4 == 0, file("a")).when(n % 4 == 1, F.concat(F.lit("images/"), file("a"))).when(n % 4 == 2, F.concat(F.lit("old/deep/"), file("a"))).otherwise(F.concat(F.lit("new/"), file("b"))).alias("path"))
    refs = t.select(k.alias("package"), F.when((n % 4 == 3) & (k % 2 == 0), F.concat(F.lit("new/"), file("b"))).otherwise(F.concat(F.lit("pics/"), file("a"))).alias("reference"))
    return state.resolved_assets(refs, listing, "package", "reference", "path")
