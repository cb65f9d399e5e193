"""Queries on the pipeline's smaller rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extras, runs, structure
from ..session import table
from .base import query
from .blocks import _B, _O, _WITH
from .runs import _R


@query(f"""{_WITH}, p AS (SELECT block_id AS section, parent AS up, coalesce(text, '') AS path FROM s WHERE level IS NOT NULL UNION ALL SELECT p.section, s.parent, coalesce(s.text, '') || ' > ' || p.path FROM p JOIN s ON s.block_id = p.up)
    SELECT s.block_id, trim(coalesce(nullif(concat_ws(chr(10), CASE WHEN trim(i.title) <> '' THEN 'Documento: ' || i.title END, CASE WHEN trim(p.path) <> '' THEN 'Seção: ' || p.path END), '') || chr(10) || chr(10), '') || s.text, ' ' || chr(9) || chr(10) || chr(13)) AS contextual
    FROM s LEFT JOIN (SELECT document_id, max_by(title, (try_cast(modified_at AS TIMESTAMPTZ), revision_id)) AS title FROM inventory GROUP BY 1) i ON s.document_id = i.document_id LEFT JOIN (SELECT section, path FROM p WHERE up IS NULL) p ON s.section = p.section WHERE s.text IS NOT NULL""")
def contextual_prefix(spark: SparkSession, d: str) -> DataFrame:
    """The contextual header with the heading path above every block that has a text, whatever its role."""
    i = table(spark, d, "inventory").groupBy("document_id").agg(F.max_by("title", F.struct(F.try_to_timestamp(F.col("modified_at")), "revision_id")).alias("title"))
    return extras.contextual_blocks(table(spark, d, "block_units"), i)


@query(f"SELECT block_id FROM {_B} WHERE regexp_matches(text, '(?i)\\b(?:doi|e-?mail|orcid|institui[cç][aã]o|universidade|faculdade|submitted|approved|recebido|aceito|vers[aã]o|doutor(?:a|ando|anda)?|mestre|p[oó]s[- ]graduando)\\b')")
def metadata_markers(spark: SparkSession, d: str) -> DataFrame:
    return structure.distinct_blocks(table(spark, d, "block_units"), "text").where(F.col("text").rlike(extras.METADATA_MARKER)).select("block_id")


@query("SELECT api_url, count(*) AS n, 'https://' || lower(regexp_extract(api_url, '://([^/?#]+)', 1)) AS url FROM (SELECT DISTINCT * FROM runs) GROUP BY 1")
def normal_urls(spark: SparkSession, d: str) -> DataFrame:
    r = runs.distinct_runs(table(spark, d, "runs"))
    return r.groupBy("api_url").agg(F.count("*").alias("n")).withColumn("url", extras.normal_url(F.concat(F.upper("api_url"), F.lit("/?q=1"))))


@query(f"SELECT document_id, round((page_count + generated_files) / 2.0, 6) AS mean, CAST(greatest(page_count, generated_files) AS DOUBLE) AS most FROM {_R} WHERE page_count IS NOT NULL AND generated_files IS NOT NULL")
def percent_lists(spark: SparkSession, d: str) -> DataFrame:
    r = runs.distinct_runs(table(spark, d, "runs")).where("page_count is not null and generated_files is not null")
    mean, most = extras.percent_list(F.concat(F.col("page_count").cast("string"), F.lit("% / "), F.col("generated_files").cast("string"), F.lit("%/x")))
    return r.select("document_id", F.round(mean, 6).alias("mean"), most.alias("most"))


@query("""WITH g AS (SELECT user_id, event_type = 'error' AS m, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events),
    r AS (SELECT user_id, g, count(*) AS n FROM g WHERE m GROUP BY 1, 2) SELECT user_id, max(n) AS longest FROM r GROUP BY 1 HAVING max(n) >= 3""")
def orphan_confirmation(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("o", F.struct("ts", "event_id"))
    return extras.consecutive_missing(e, "user_id", "o", F.col("event_type") == "error", 3)


@query(f"SELECT document_id, string_agg(status, ',' ORDER BY document_position, started_at, log_path, completed_at) AS history FROM {_R} WHERE document_id IS NOT NULL GROUP BY 1")
def task_history(spark: SparkSession, d: str) -> DataFrame:
    r = runs.distinct_runs(table(spark, d, "runs")).where("document_id is not null")
    h = F.array_sort(F.collect_list(F.struct("document_position", "started_at", "log_path", "completed_at", "status")))
    return r.groupBy("document_id").agg(F.array_join(F.transform(h, lambda x: x["status"]), ",").alias("history"))


@query(f"SELECT d.document_id, concat_ws(',', h.history, CASE WHEN h.history IS NULL THEN 'unseen' ELSE 'closed' END) AS history FROM (SELECT DISTINCT document_id FROM inventory WHERE document_id IS NOT NULL) d LEFT JOIN (SELECT document_id, string_agg(status, ',' ORDER BY document_position, started_at, log_path, completed_at) AS history FROM {_R} WHERE document_id IS NOT NULL AND pod_number > 3 GROUP BY 1) h ON d.document_id = h.document_id")
def appended_history(spark: SparkSession, d: str) -> DataFrame:
    """The history of each document of the inventory on the later pods, with an entry after it; documents without one begin theirs."""
    r = runs.distinct_runs(table(spark, d, "runs")).where("document_id is not null and pod_number > 3")
    h = F.array_sort(F.collect_list(F.struct("document_position", "started_at", "log_path", "completed_at", "status")))
    known = r.groupBy("document_id").agg(F.transform(h, lambda x: x["status"]).alias("h"))
    j = table(spark, d, "inventory").select("document_id").where("document_id is not null").distinct().join(known, "document_id", "left")
    entry = F.array(F.when(F.col("h").isNull(), "unseen").otherwise("closed"))
    return j.select("document_id", F.array_join(extras.append_history(entry, F.col("h")), ",").alias("history"))


@query(f"SELECT count(*) AS attempts, CAST(sum(CASE WHEN return_code IS NOT NULL AND started_at IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS submitted, CAST(sum(CASE WHEN status = 'ok' THEN page_count END) AS DOUBLE) AS pages, CAST(sum(CASE WHEN status = 'ok' AND generated_files = 0 THEN page_count END) AS DOUBLE) AS reconciled_pages FROM {_R}")
def throughput_eligibility(spark: SparkSession, d: str) -> DataFrame:
    ok = F.col("status") == "ok"
    return runs.distinct_runs(table(spark, d, "runs")).agg(F.count("*").alias("attempts"), F.count_if(F.col("return_code").isNotNull() & F.col("started_at").isNotNull()).alias("submitted"), F.sum(F.when(ok, F.col("page_count"))).alias("pages"), F.sum(F.when(ok & (F.col("generated_files") == 0), F.col("page_count"))).alias("reconciled_pages"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def idempotency_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Per key the best task: persisted ones first, then the newest; a keyed maximum."""
    best = F.max(F.struct((F.col("o_orderstatus") == "F").alias("p"), "o_orderdate", "o_orderkey")).alias("b")
    return table(spark, d, "orders").groupBy("o_custkey").agg(best).select("o_custkey", "b.o_orderkey")


@query("""WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem), b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 50 = 1 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity FROM lineitem),
    u AS (SELECT l_orderkey, l_linenumber, l_quantity, 1 AS d FROM a UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, -1 FROM b), g AS (SELECT l_orderkey, abs(sum(d)) AS d FROM u GROUP BY l_orderkey, l_linenumber, l_quantity) SELECT l_orderkey AS package, max(d) = 0 AS equal FROM g GROUP BY 1""")
def package_validation(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("package"), "l_linenumber", "l_quantity")
    b = a.withColumn("l_quantity", F.when(F.col("package") % 50 == 1, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    return extras.equal_sets(a, b, "package", ["l_linenumber", "l_quantity"])


@query(f"WITH a AS (SELECT role, count(*) AS n FROM {_B} GROUP BY 1), b AS (SELECT CASE WHEN source_type = 'text' THEN 'body' ELSE source_type END AS role, count(*) AS n FROM {_B} GROUP BY 1) SELECT a.role, CAST(a.n - coalesce(b.n, 0) AS BIGINT) AS n FROM a LEFT JOIN b ON a.role = b.role WHERE a.n > coalesce(b.n, 0)")
def multiset_difference(spark: SparkSession, d: str) -> DataFrame:
    b = structure.distinct_blocks(table(spark, d, "block_units"), "role", "source_type")
    return extras.multiset_minus(b.select("role"), b.select(F.when(F.col("source_type") == "text", "body").otherwise(F.col("source_type")).alias("role")), ["role"])


@query("""WITH c AS (SELECT DISTINCT document_id, unnest(['/work/out/' || document_id, '/work/old/' || document_id]) AS path FROM inventory), h AS (SELECT c.document_id, count(l.output_dir) AS copies FROM c LEFT JOIN (SELECT DISTINCT output_dir FROM runs) l ON c.path = l.output_dir GROUP BY 1) SELECT document_id, copies FROM h WHERE copies <> 1""")
def preflight_one_copy(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "inventory").select("document_id").where("document_id is not null").distinct()
    c = ids.select("document_id", F.explode(F.array(F.concat(F.lit("/work/out/"), "document_id"), F.concat(F.lit("/work/old/"), "document_id"))).alias("path"))
    return extras.exactly_one(c, "document_id", "path", table(spark, d, "runs"), "output_dir")


@query(f"SELECT sha256, string_agg(DISTINCT error, ',' ORDER BY error) AS errors, count(*) AS n FROM {_R} WHERE error IS NOT NULL AND sha256 IS NOT NULL GROUP BY 1")
def errors_by_hash(spark: SparkSession, d: str) -> DataFrame:
    r = runs.distinct_runs(table(spark, d, "runs")).where("error is not null and sha256 is not null")
    return r.groupBy("sha256").agg(F.array_join(F.array_sort(F.collect_set("error")), ",").alias("errors"), F.count("*").alias("n"))


@query(f"SELECT pod_number, array_to_string(list_filter([CASE WHEN count(*) >= 60 THEN 'backlog' END, CASE WHEN min(size_mb) < 0.05 THEN 'disk' END], lambda x: x IS NOT NULL), ',') AS reasons FROM {_R} WHERE pod_number IS NOT NULL GROUP BY 1")
def admission_control(spark: SparkSession, d: str) -> DataFrame:
    g = runs.distinct_runs(table(spark, d, "runs")).where("pod_number is not null").groupBy("pod_number").agg(F.count("*").alias("n"), F.min("size_mb").alias("free"))
    return g.select("pod_number", F.array_join(extras.admission(F.col("n"), F.lit(60), F.col("free"), F.lit(0.05)), ",").alias("reasons"))


@query("""WITH last AS (SELECT document_id, max_by(status, (try_cast(started_at AS TIMESTAMPTZ), document_position)) AS st FROM (SELECT DISTINCT * FROM runs) WHERE document_id IS NOT NULL GROUP BY 1), d AS (SELECT DISTINCT document_id, collection_slug FROM inventory WHERE status = 'ok')
    SELECT collection_slug, count(*) AS documents, CAST(sum(CASE WHEN st = 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS extracted, CASE WHEN sum(CASE WHEN st = 'ok' THEN 1 ELSE 0 END) = 0 THEN 'inventory' WHEN sum(CASE WHEN st = 'ok' THEN 1 ELSE 0 END) < count(*) THEN 'extracting' ELSE 'extracted' END AS stage FROM d LEFT JOIN last USING (document_id) GROUP BY 1""")
def collection_status(spark: SparkSession, d: str) -> DataFrame:
    last = runs.last_runs(runs.distinct_runs(table(spark, d, "runs"))).select("document_id", (F.col("status") == "ok").alias("done"))
    docs = table(spark, d, "inventory").where("status = 'ok'").select("document_id", "collection_slug").distinct()
    g = docs.join(last, "document_id", "left").groupBy("collection_slug").agg(F.count("*").alias("documents"), F.count_if(F.coalesce("done", F.lit(False))).alias("extracted"))
    return g.withColumn("stage", F.when(F.col("extracted") == 0, "inventory").when(F.col("extracted") < F.col("documents"), "extracting").otherwise("extracted"))


@query("SELECT filename, CASE lower(regexp_extract(filename, '(\\.[^./]*)$', 1)) WHEN '.pdf' THEN 'application/pdf' ELSE 'application/octet-stream' END AS media, base64(encode(filename)) AS encoded FROM (SELECT DISTINCT filename FROM runs WHERE filename IS NOT NULL)")
def media_types(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "runs").select("filename").where("filename is not null").distinct()
    return f.select("filename", extras.media_type(F.col("filename")).alias("media"), F.regexp_replace(F.base64(F.encode("filename", "UTF-8")), "\\s", "").alias("encoded"))


@query("SELECT event_id, key, value FROM (SELECT event_id, unnest(json_keys(props::JSON)) AS key, props FROM events) t, LATERAL (SELECT json_extract_string(props, '$.' || key) AS value)")
def open_keys(spark: SparkSession, d: str) -> DataFrame:
    """The open remainder of an event's properties as rows."""
    return table(spark, d, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))


@query()
def key_paths(spark: SparkSession, d: str) -> DataFrame:
    return extras.key_paths(table(spark, d, "extractions"), "record_id", "payload", "level")


@query()
def split_text_function(spark: SparkSession, d: str) -> DataFrame:
    extras.register(spark)
    table(spark, d, "documents").createOrReplaceTempView("documents")
    return spark.sql("SELECT doc_id, piece, start, length(p.text) AS n FROM documents d, LATERAL split_text(d.text, 500) p")


@query()
def explode_document_function(spark: SparkSession, d: str) -> DataFrame:
    extras.register(spark)
    table(spark, d, "extractions").createOrReplaceTempView("extractions")
    return spark.sql("SELECT record_id, kind, count(*) AS n FROM extractions e, LATERAL explode_document(e.payload) GROUP BY record_id, kind")


@query(f"""WITH h AS (SELECT document_id, position, lower(trim(regexp_replace(text, '^[\\d.\\s#]+|[.:\\-\\s]+$', '', 'g'))) AS heading, role, text FROM {_O}), a AS (SELECT document_id, count(*) AS abstracts, CAST(sum(length(text)) AS BIGINT) AS chars FROM h WHERE role = 'abstract' GROUP BY 1), r AS (SELECT document_id, min(position) AS reference_at FROM h WHERE role = 'title' AND heading IN ('references', 'referencias', 'referências') GROUP BY 1)
    SELECT d.document_id, coalesce(abstracts, 0) AS abstracts, coalesce(chars, 0) AS chars, reference_at FROM (SELECT DISTINCT document_id FROM h) d LEFT JOIN a USING (document_id) LEFT JOIN r USING (document_id)""")
def abstract_segments(spark: SparkSession, d: str) -> DataFrame:
    """One conditional aggregation per document in place of three joins."""
    o = structure.reading_order(table(spark, d, "block_units"), "role", "text")
    a = F.col("role") == "abstract"
    return o.groupBy("document_id").agg(
        F.count_if(a).alias("abstracts"), F.coalesce(F.sum(F.when(a, F.length("text"))), F.lit(0)).cast("long").alias("chars"),
        F.min(F.when((F.col("role") == "title") & extras.heading_of(F.col("text")).isin("references", "referencias", "referências"), F.col("position"))).alias("reference_at"),
    )


@query(f"""SELECT document_id, greatest(count(*) FILTER (role = 'table'), count(*) FILTER (source_type = 'table'), 0) AS tables, count(*) FILTER (role IN ('figure', 'chart')) AS images, count(*) FILTER (role = 'equation') AS equations, count(*) FILTER (role = 'table' AND coalesce(length(text), 0) = 0) AS empty_tables FROM {_B} GROUP BY 1""")
def document_metrics(spark: SparkSession, d: str) -> DataFrame:
    b = structure.distinct_blocks(table(spark, d, "block_units").withColumn("chars", F.length("text")), "document_id", "role", "source_type", "chars")
    t = F.col("role") == "table"
    return b.groupBy("document_id").agg(F.greatest(F.count_if(t), F.count_if(F.col("source_type") == "table")).alias("tables"), F.count_if(F.col("role").isin("figure", "chart")).alias("images"), F.count_if(F.col("role") == "equation").alias("equations"), F.count_if(t & (F.coalesce("chars", F.lit(0)) == 0)).alias("empty_tables"))


@query(f"SELECT c.document_id, c.blocks AS current_blocks, o.blocks AS old_blocks, c.blocks - o.blocks AS delta FROM (SELECT document_id, count(*) AS blocks FROM {_B} GROUP BY 1) c LEFT JOIN (SELECT document_id, count(DISTINCT block_id) AS blocks FROM block_units WHERE loaded_at < TIMESTAMP '2024-04-30 12:00:00' GROUP BY 1) o ON c.document_id = o.document_id")
def old_and_current(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "block_units").where("block_id is not null")
    g = b.groupBy("document_id").agg(F.countDistinct("block_id").alias("current_blocks"), F.countDistinct(F.when(F.col("loaded_at") < F.lit("2024-04-30 12:00:00").cast("timestamp_ntz"), F.col("block_id"))).alias("old"))
    return g.select("document_id", "current_blocks", F.nullif("old", F.lit(0)).alias("old_blocks"), (F.col("current_blocks") - F.nullif("old", F.lit(0))).alias("delta"))
