"""Queries on rendered documents and on two readings of one document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import content_list, ir, reconcile
from ..session import checkpointed, table
from .base import query


def _d(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


@query("SELECT doc_id, rtrim(regexp_extract(text, '(?i)\\b10\\.\\d{4,9}/[-._;()/:A-Z0-9]+', 0), '.,;') AS doi FROM documents WHERE regexp_matches(text, '(?i)\\b10\\.\\d{4,9}/[-._;()/:A-Z0-9]+')")
def document_doi(spark: SparkSession, d: str) -> DataFrame:
    return _d(spark, d).select("doc_id", text.doi(F.col("text")).alias("doi")).where("doi is not null")


@query("SELECT lower(substr(lang, 1, 2)) AS lang, count(*) AS n, count(text) AS with_text, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(CASE WHEN n_chars <> length(text) THEN 1 ELSE 0 END) AS BIGINT) AS stale_counts FROM documents GROUP BY 1")
def document_languages(spark: SparkSession, d: str) -> DataFrame:
    n = F.length("text")
    return _d(spark, d).groupBy(F.lower(F.substring("lang", 1, 2)).alias("lang")).agg(F.count("*").alias("n"), F.count("text").alias("with_text"), F.sum(n).cast("long").alias("chars"), F.count_if(F.col("n_chars") != n).alias("stale_counts"))


@query("SELECT sha256(text) AS fp, count(*) AS copies, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def exact_copies(spark: SparkSession, d: str) -> DataFrame:
    """Classes of equal texts by hash: one row a class, combined before the shuffle."""
    g = _d(spark, d).where("text is not null").groupBy(F.sha2("text", 256).alias("fp")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc"))
    return g.where("copies > 1")


@query("SELECT i.collection_slug, count(DISTINCT d.doc_id) AS documents, count(DISTINCT d.source) AS sources FROM documents d JOIN (SELECT DISTINCT document_id, collection_slug FROM inventory) i ON d.document_id = i.document_id GROUP BY 1")
def documents_by_collection(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "inventory").select("document_id", "collection_slug").distinct()
    return _d(spark, d).select("doc_id", "document_id", "source").join(i, "document_id").groupBy("collection_slug").agg(F.countDistinct("doc_id").alias("documents"), F.countDistinct("source").alias("sources"))


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '[\\s\\x{85}\\x{A0}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{3000}]+', ' ', 'g')) AS plain FROM documents WHERE text IS NOT NULL")
def stripped_tags(spark: SparkSession, d: str) -> DataFrame:
    return _d(spark, d).where("text is not null").select("doc_id", text.strip_tags(F.col("text")).alias("plain"))


@query()
def html_to_text(spark: SparkSession, d: str) -> DataFrame:
    return _d(spark, d).where("text is not null").select("doc_id", text.html_to_text("text").alias("plain"))


@query()
def html_to_markdown(spark: SparkSession, d: str) -> DataFrame:
    return _d(spark, d).where("text is not null").select("doc_id", text.html_to_markdown("text").alias("markdown"))


@query("SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, CAST(len(list_filter(string_split(text, chr(10)), lambda x: starts_with(x, '#'))) AS INTEGER) AS headings, CAST(len(list_filter(string_split(text, chr(10)), lambda x: starts_with(x, '- '))) AS INTEGER) AS items FROM documents WHERE text IS NOT NULL")
def line_profile(spark: SparkSession, d: str) -> DataFrame:
    lines = F.split("text", "\n")
    return _d(spark, d).where("text is not null").select("doc_id", F.size(lines).cast("long").alias("n_lines"), F.size(F.filter(lines, lambda x: F.startswith(x, F.lit("#")))).alias("headings"), F.size(F.filter(lines, lambda x: F.startswith(x, F.lit("- ")))).alias("items"))


def _readings(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Items of the second reading, the working copies of each page as a content list, and the root blocks of the first."""
    records = table(spark, d, "extractions")
    b = ir.blocks(records, checkpointed(ir.nodes(records))).where(F.col("node").rlike("^p\\d+:[bd]\\d+$")).drop("text")
    texts = ir.block_texts(records).select("record_id", F.col("block").alias("node"), F.col("reconcile").alias("text"))
    # content blocks before discarded ones
    order = F.col("ordinal") + F.when(F.col("collection") == "discarded", 1 << 20).otherwise(0)
    blocks = checkpointed(b.join(texts, ["record_id", "node"], "left").select("record_id", F.regexp_extract("node", "^(p\\d+)", 1).alias("page"), F.col("node").alias("id"), order.alias("ordinal"), "type", "bbox", "text"))
    made = content_list.content_items(ir.second_reading(records), "content_list", "record_id").where("not bad")
    items = made.select("record_id", F.format_string("p%04d", "page").alias("page"), F.col("item").alias("id"), F.col("global_order").alias("ordinal"), "type", "bbox", "text", "level")
    return checkpointed(items.join(ir.pages(records), ["record_id", "page"], "left")), blocks


@query()
def content_items(spark: SparkSession, d: str) -> DataFrame:
    return content_list.content_items(ir.second_reading(table(spark, d, "extractions")), "content_list", "record_id")


@query()
def match_candidates(spark: SparkSession, d: str) -> DataFrame:
    """All candidates of the second reading with overlap, similarity, type and score."""
    items, blocks = _readings(spark, d)
    pairs = reconcile.candidates(items, blocks)
    t = lambda df, name, out: df.select("record_id", F.col("id").alias(name), text.normalize_text("text").alias(out))
    j = pairs.join(t(items, "item", "a"), ["record_id", "item"]).join(t(blocks, "block", "b"), ["record_id", "block"])
    ratio = F.coalesce(text.sequence_ratio(F.nullif("a", F.lit("")), F.nullif("b", F.lit(""))), F.lit(0.0))
    return reconcile.scored(j.withColumn("r", ratio), F.col("r")).drop("a", "b", "r")


def _boxes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Boxes made of the numbers of order lines, one page an order: an exact input for the arithmetic of candidates.

    Both sides are made of the same lines, dealt by page once.
    """
    t = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("record_id"), F.lit("p").alias("page"), F.col("l_linenumber").cast("string").alias("id"), F.col("l_quantity").alias("q"), (F.col("l_partkey") % 60).cast("double").alias("u"), (F.col("l_suppkey") % 40).cast("double").alias("v"), "l_returnflag").repartition("record_id")
    items = t.select("record_id", "page", "id", F.when(F.col("l_returnflag") == "R", "title").otherwise("paragraph").alias("type"), F.array(F.col("u") * 2, F.col("v") * 2, F.col("u") * 2 + F.col("q") * 2, F.col("v") * 2 + 40).alias("bbox"), F.lit(500.0).alias("width"), F.lit(500.0).alias("height"))
    return items, t.select("record_id", "page", "id", F.when(F.col("l_returnflag") == "A", "title").otherwise("text").alias("type"), F.array(F.col("u"), F.col("v"), F.col("u") + F.col("q"), F.col("v") + 20).alias("bbox"))


def _iou_sql(k: str) -> str:
    x0, y0, x1, y1 = (f"(i.{c}{k})" for c in ("x0", "y0", "x1", "y1"))
    w, h = f"greatest(0, least({x1}, b.x1) - greatest({x0}, b.x0))", f"greatest(0, least({y1}, b.y1) - greatest({y0}, b.y0))"
    return f"(({w}) * ({h}) / (({x1} - {x0}) * ({y1} - {y0}) + (b.x1 - b.x0) * (b.y1 - b.y0) - ({w}) * ({h})))"


_PAIRS = f"""WITH t AS (SELECT l_orderkey AS record_id, CAST(l_linenumber AS VARCHAR) AS id, l_quantity::DOUBLE AS q, (l_partkey % 60)::DOUBLE AS u, (l_suppkey % 40)::DOUBLE AS v, l_returnflag AS f FROM lineitem),
    b AS (SELECT record_id, id, u AS x0, v AS y0, u + q AS x1, v + 20 AS y1, f = 'A' AS title FROM t), i AS (SELECT record_id, id, u * 2 AS x0, v * 2 AS y0, u * 2 + q * 2 AS x1, v * 2 + 40 AS y1, f = 'R' AS title FROM t),
    p AS (SELECT i.record_id, i.id AS item, b.id AS block, {_iou_sql('')} AS one, {_iou_sql(' / 2')} AS two, (i.title = b.title) AS fits FROM i JOIN b ON i.record_id = b.record_id),
    s AS (SELECT *, greatest(one, two) AS iou, 0.55 * greatest(one, two) + CASE WHEN fits THEN 0.1 ELSE 0 END AS score FROM p)"""


@query(f"{_PAIRS} SELECT record_id, item, block, round(iou, 9) AS iou, CASE WHEN two > one THEN 1 ELSE 0 END AS space FROM s WHERE iou > 0")
def iou_pairs(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.candidates(*_boxes(spark, d)).where("iou > 0").select("record_id", "item", "block", F.round("iou", 9).alias("iou"), "space")


@query(f"""{_PAIRS}, r AS (SELECT *, row_number() OVER w AS rn, lead(score) OVER w AS ns, lead(iou) OVER w AS ni FROM s WINDOW w AS (PARTITION BY record_id, item ORDER BY score DESC, iou DESC, block))
    SELECT record_id, item, block, round(score, 6) AS score, round(score - coalesce(ns, 0), 6) AS margin, coalesce(score - coalesce(ns, 0) < 0.05 AND ni >= 0.5, false) AS ambiguous FROM r WHERE rn = 1""")
def best_and_margin(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.best_and_margin(reconcile.scored(reconcile.candidates(*_boxes(spark, d)), F.lit(0.0))).drop("page")


@query()
def greedy_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.greedy(*_readings(spark, d))


@query()
def reconciliation_divergences(spark: SparkSession, d: str) -> DataFrame:
    items, blocks = _readings(spark, d)
    return reconcile.divergences(reconcile.greedy(items, blocks), items.select("record_id", F.col("id").alias("item"), (F.length("text") > 0).alias("has_text")))


@query()
def reconciliation_counts(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.counts(reconcile.greedy(*_readings(spark, d)))


@query()
def unmatched_items(spark: SparkSession, d: str) -> DataFrame:
    items, blocks = _readings(spark, d)
    return reconcile.unmatched_items(reconcile.greedy(items, blocks), items)


@query()
def unmatched_blocks(spark: SparkSession, d: str) -> DataFrame:
    items, blocks = _readings(spark, d)
    return reconcile.unmatched_blocks(reconcile.greedy(items, blocks), blocks)


@query()
def sequence_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Similarity of each title in the inventory to the front-matter title of its document."""
    from .blocks import title_pick

    i = table(spark, d, "inventory").where("trim(title) <> ''").groupBy("document_id").agg(F.max_by("title", F.struct("modified_at", "revision_id")).alias("stated"))
    return i.join(title_pick(spark, d), "document_id").select("document_id", text.sequence_ratio(text.normalize_text("stated"), text.normalize_text("title")).alias("ratio"), text.sequence_ratio_exact("stated", "title").alias("exact_ratio"))
