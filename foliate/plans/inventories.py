"""Queries on the inventory of scanned documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity
from ..operators import inventory
from ..session import table
from .base import query

_INVALID = "(coalesce(trim(document_id), '') = '' OR coalesce(trim(sha256), '') = '' OR coalesce(status, '') <> 'ok' OR coalesce(page_count, 0) <= 0)"
_POS = "try_cast(modified_at AS TIMESTAMPTZ)"
_FIRST = f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY {_POS} NULLS FIRST, revision_id NULLS FIRST) AS rn FROM inventory WHERE NOT {_INVALID}) WHERE rn = 1)"""
_NEWEST = f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY {_POS} DESC NULLS LAST, revision_id DESC NULLS LAST, document_id) AS rn FROM inventory WHERE NOT {_INVALID}) WHERE rn = 1)"""
_PAGES = "CASE WHEN page_count <= 2 THEN '001_002' WHEN page_count <= 5 THEN '003_005' WHEN page_count <= 10 THEN '006_010' WHEN page_count <= 25 THEN '011_025' WHEN page_count <= 50 THEN '026_050' WHEN page_count <= 100 THEN '051_100' WHEN page_count <= 250 THEN '101_250' WHEN page_count IS NOT NULL THEN '251_plus' END"
_SIZES = "CASE WHEN size_mb <= 0.25 THEN '000_025mb' WHEN size_mb <= 1 THEN '025_001mb' WHEN size_mb <= 5 THEN '001_005mb' WHEN size_mb <= 20 THEN '005_020mb' WHEN size_mb <= 100 THEN '020_100mb' WHEN size_mb IS NOT NULL THEN '100mb_plus' END"
_STRATA = f"(SELECT *, {_PAGES} AS page_bucket, {_SIZES} AS size_bucket, concat_ws('|', coalesce({_PAGES}, 'nan'), coalesce({_SIZES}, 'nan'), coalesce(CAST(encrypted AS VARCHAR), 'nan')) AS stratum FROM {_NEWEST})"
_UUID5 = "(SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST(instr('0123456789abcdef', substr(h, 17, 1)) - 1 AS INTEGER) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) FROM (SELECT sha1(from_hex(replace({ns}, '-', '')) || encode({name})) AS h))"


def _inv(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "inventory")


@query(f"""
    SELECT (SELECT count(*) FROM inventory) AS inventory_rows, (SELECT count(*) FROM inventory WHERE NOT {_INVALID}) AS valid_rows, (SELECT count(*) FROM inventory WHERE {_INVALID}) AS invalid_rows,
           count(*) AS unique_documents, (SELECT count(*) FROM inventory WHERE NOT {_INVALID}) - count(*) AS duplicate_rows, CAST(coalesce(sum(page_count), 0) AS BIGINT) AS expected_pages FROM {_FIRST}""")
def inventory_audit(spark: SparkSession, d: str) -> DataFrame:
    return inventory.audit(_inv(spark, d))


@query("""
    WITH s AS (SELECT *, trim(regexp_replace(lower(strip_accents(collection)), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM inventory),
         c AS (SELECT *, """ + _UUID5.format(ns="'" + identity.NAMESPACE + "'", name="'collection:' || slug") + """ AS collection_uuid, """ + _UUID5.format(ns="'" + identity.NAMESPACE + "'", name="'document:' || slug || ':' || collection_relative_path") + """ AS document_uuid FROM s)
    SELECT path, slug, collection_uuid, document_uuid, """ + _UUID5.format(ns="document_uuid", name="'revision:' || lower(sha256)") + """ AS revision_uuid, round(size_bytes / 1024.0 / 1024.0, 4) AS mb, regexp_full_match(lower(sha256), '[0-9a-f]{64}') AS sha_ok FROM c""")  # fmt: skip
def inventory_projection(spark: SparkSession, d: str) -> DataFrame:
    return inventory.projection(_inv(spark, d))


@query(f"SELECT document_id, path, status, page_count, error FROM inventory WHERE {_INVALID}")
def inventory_invalid(spark: SparkSession, d: str) -> DataFrame:
    return _inv(spark, d).where(inventory.is_invalid()).select("document_id", "path", "status", "page_count", "error")


@query("SELECT sha256, path, document_id, modified_at FROM inventory WHERE sha256 IN (SELECT sha256 FROM inventory WHERE trim(sha256) <> '' GROUP BY sha256 HAVING count(*) > 1)")
def inventory_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return inventory.duplicates(_inv(spark, d)).select("sha256", "path", "document_id", "modified_at")


@query(f"SELECT document_id, revision_id, sha256, relative_path, page_count FROM {_FIRST}")
def extraction_manifest(spark: SparkSession, d: str) -> DataFrame:
    return inventory.extraction_manifest(_inv(spark, d)).select("document_id", "revision_id", "sha256", "relative_path", "page_count")


@query(f"""
    SELECT document_id, revision_id, path, status FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY {_POS} DESC NULLS LAST, revision_id DESC NULLS LAST) AS rn FROM inventory WHERE NOT {_INVALID}) WHERE rn = 1
    UNION ALL SELECT document_id, revision_id, path, status FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY {_POS} DESC NULLS LAST, revision_id DESC NULLS LAST) AS rn FROM inventory WHERE {_INVALID}) WHERE rn = 1""")
def inventory_merge_keep_last(spark: SparkSession, d: str) -> DataFrame:
    inv = _inv(spark, d)
    year = F.substring("modified_at", 1, 4)
    return inventory.merge(inv.where(year < "2024"), inv.where((year >= "2024") | year.isNull())).select("document_id", "revision_id", "path", "status")


@query("SELECT document_id, string_agg(revision_id, ',' ORDER BY revision_id) AS revisions FROM (SELECT DISTINCT document_id, revision_id FROM inventory WHERE trim(document_id) <> '' AND revision_id IS NOT NULL) GROUP BY document_id HAVING count(*) > 1")
def inventory_collisions(spark: SparkSession, d: str) -> DataFrame:
    return inventory.logical_collisions(_inv(spark, d))


@query("SELECT lower(path) AS path_key, count(DISTINCT document_id) AS ids FROM inventory GROUP BY 1 HAVING count(DISTINCT document_id) > 1")
def physical_collisions(spark: SparkSession, d: str) -> DataFrame:
    return inventory.physical_collisions(_inv(spark, d))


@query("SELECT document_id, path FROM inventory WHERE status = 'ok' AND (lower(collection) = 'library vinabigium' OR collection_slug = 'Library Vinabigium')")
def select_by_collection(spark: SparkSession, d: str) -> DataFrame:
    return inventory.select(_inv(spark, d), collection="Library Vinabigium").select("document_id", "path")


@query("SELECT document_id, path FROM inventory WHERE status = 'ok' AND (relative_path = 'library-vinabigium/lote-01' OR starts_with(relative_path, 'library-vinabigium/lote-01/'))")
def select_by_path(spark: SparkSession, d: str) -> DataFrame:
    return inventory.select(_inv(spark, d), path="library-vinabigium/lote-01").select("document_id", "path")


@query("""SELECT sha256('[' || coalesce(string_agg('{"document_id":"' || document_id || '","revision_id":"' || revision_id || '","sha256":"' || sha256 || '"}', ',' ORDER BY document_id, revision_id, sha256), '') || ']') AS fingerprint, count(*) AS n
    FROM inventory WHERE status = 'ok' AND document_id IS NOT NULL AND revision_id IS NOT NULL AND sha256 IS NOT NULL""")
def inventory_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """The hash of the sorted identities of readable rows, as it is stored beside an inventory."""
    return inventory.stored_fingerprint(_inv(spark, d))


@query("""
    WITH one AS (SELECT DISTINCT '{"document_id":' || coalesce('"' || document_id || '"', 'null') || ',"revision_id":' || coalesce('"' || revision_id || '"', 'null') || ',"sha256":' || coalesce('"' || sha256 || '"', 'null') || '}' AS j FROM inventory),
         h AS (SELECT sha256(j) AS h FROM one), p AS (SELECT substr(h, 1, 3) AS p, sha256(string_agg(h, ',' ORDER BY h)) AS g, count(*) AS n FROM h GROUP BY 1)
    SELECT sha256(string_agg(g, ',' ORDER BY p)) AS fingerprint, CAST(sum(n) AS BIGINT) AS n FROM p""")
def inventory_digest(spark: SparkSession, d: str) -> DataFrame:
    return inventory.fingerprint(_inv(spark, d))


@query(f"SELECT document_id, revision_id, {_PAGES} AS page_bucket, {_SIZES} AS size_bucket FROM inventory")
def size_page_buckets(spark: SparkSession, d: str) -> DataFrame:
    return _inv(spark, d).select("document_id", "revision_id", inventory.bucket(F.col("page_count"), inventory.PAGE_BUCKETS).alias("page_bucket"), inventory.bucket(F.col("size_mb"), inventory.SIZE_BUCKETS).alias("size_bucket"))


@query(f"""
    WITH s AS (SELECT stratum, count(*) AS population FROM {_STRATA} GROUP BY 1), t AS (SELECT sum(population) AS total, count(*) AS k FROM s)
    SELECT stratum, population, least(population, 1 + CAST(round_even(population / total * greatest(0, 60 - k), 0) AS BIGINT)) AS quota FROM s, t""")
def strata_population(spark: SparkSession, d: str) -> DataFrame:
    return inventory.strata(inventory.stratified_frame(_inv(spark, d)), 60)


@query(f"SELECT document_id FROM {_FIRST} ORDER BY sha256('42:' || document_id), document_id LIMIT 50")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return inventory.seeded_sample(_inv(spark, d), 50).select("document_id")


_SAMPLE = f"""
    WITH f AS (SELECT *, sha256('42:' || sha256) AS h FROM {_STRATA}), s AS (SELECT stratum, count(*) AS population FROM f GROUP BY 1), t AS (SELECT sum(population) AS total, count(*) AS k FROM s),
         q AS (SELECT stratum, least(population, 1 + CAST(round_even(population / total * greatest(0, 60 - k), 0) AS BIGINT)) AS quota FROM s, t),
         r AS (SELECT f.*, q.quota, row_number() OVER (PARTITION BY f.stratum ORDER BY h) AS rn FROM f JOIN q USING (stratum)),
         sample AS (SELECT * FROM r ORDER BY CAST(rn > quota AS INTEGER), CAST(rn > 1 AS INTEGER), h LIMIT 60)"""


@query(_SAMPLE + " SELECT sha256, stratum FROM sample")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return inventory.stratified_sample(_inv(spark, d), 60).select("sha256", "stratum")


@query(_SAMPLE + """, u AS ((SELECT sha256 FROM f ORDER BY size_bytes DESC, sha256 LIMIT 10) UNION (SELECT sha256 FROM f ORDER BY page_count DESC, sha256 LIMIT 10) UNION (SELECT sha256 FROM f ORDER BY size_bytes, sha256 LIMIT 10) UNION (SELECT sha256 FROM f WHERE encrypted ORDER BY h LIMIT 10))
    SELECT sha256 FROM u WHERE sha256 NOT IN (SELECT sha256 FROM sample)""")
def edge_cases(spark: SparkSession, d: str) -> DataFrame:
    inv = _inv(spark, d)
    return inventory.edge_cases(inv, inventory.stratified_sample(inv, 60)).select("sha256")


@query(" UNION ALL ".join(f"(SELECT document_id, '{m}' AS metric, '{side}' AS side, CAST({m} AS DOUBLE) AS value FROM {_FIRST} WHERE {m} IS NOT NULL ORDER BY value {o}, document_id LIMIT 10)" for m in ("size_bytes", "page_count") for side, o in (("smallest", "ASC"), ("largest", "DESC"))))
def outliers_top_bottom(spark: SparkSession, d: str) -> DataFrame:
    return inventory.outliers(inventory.extraction_manifest(_inv(spark, d)), "document_id", ["size_bytes", "page_count"])


@query("SELECT i.document_id, i.sha256, i.path FROM (SELECT DISTINCT document_id, sha256, path FROM inventory) i WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.document_id = i.document_id AND r.sha256 = i.sha256 AND r.path = i.path)")
def sample_identity_violations(spark: SparkSession, d: str) -> DataFrame:
    """Identity triples of the inventory that no run carries."""
    keys = ["document_id", "sha256", "path"]
    return _inv(spark, d).select(*keys).distinct().join(table(spark, d, "runs").select(*keys), keys, "left_anti")


@query("""
    SELECT m AS metric, count(x) AS n, min(x) AS x_min, avg(x) AS x_mean, quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75, quantile_cont(x, 0.9) AS p90, quantile_cont(x, 0.95) AS p95, quantile_cont(x, 0.99) AS p99, max(x) AS x_max
    FROM (SELECT 'page_count' AS m, CAST(page_count AS DOUBLE) AS x FROM inventory UNION ALL SELECT 'size_mb', size_mb FROM inventory) WHERE x IS NOT NULL GROUP BY m""")
def describe_quantiles(spark: SparkSession, d: str) -> DataFrame:
    long = _inv(spark, d).select(F.inline(F.array(F.struct(F.lit("page_count").alias("metric"), F.col("page_count").cast("double").alias("x")), F.struct(F.lit("size_mb").alias("metric"), F.col("size_mb").alias("x"))))).where("x is not null")
    p = F.percentile("x", [0.25, 0.5, 0.75, 0.9, 0.95, 0.99])
    return long.groupBy("metric").agg(F.count("x").alias("n"), F.min("x").alias("x_min"), F.avg("x").alias("x_mean"), p.alias("p"), F.max("x").alias("x_max")).select("metric", "n", "x_min", "x_mean", *[F.col("p")[i].alias(f"p{k}") for i, k in enumerate((25, 50, 75, 90, 95, 99))], "x_max")


@query("SELECT path, size_bytes FROM inventory ORDER BY size_bytes DESC, path, modified_at LIMIT 30")
def largest_documents(spark: SparkSession, d: str) -> DataFrame:
    return _inv(spark, d).orderBy(F.desc("size_bytes"), "path", "modified_at").limit(30).select("path", "size_bytes")


@query("SELECT collection_slug, count(*) AS n_rows, count(DISTINCT document_id) AS documents, CAST(sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS ok_rows, CAST(sum(coalesce(page_count, 0)) AS BIGINT) AS pages, CAST(sum(size_bytes) AS BIGINT) AS bytes FROM inventory GROUP BY 1")
def collection_counts(spark: SparkSession, d: str) -> DataFrame:
    return _inv(spark, d).groupBy("collection_slug").agg(F.count("*").alias("n_rows"), F.countDistinct("document_id").alias("documents"), F.count_if(F.col("status") == "ok").alias("ok_rows"), F.sum(F.coalesce("page_count", F.lit(0))).cast("long").alias("pages"), F.sum("size_bytes").alias("bytes"))


@query("SELECT producer, creator, coalesce(encrypted, false) AS encrypted, count(*) AS n FROM inventory GROUP BY 1, 2, 3")
def producer_counts(spark: SparkSession, d: str) -> DataFrame:
    return _inv(spark, d).groupBy("producer", "creator", F.coalesce("encrypted", F.lit(False)).alias("encrypted")).agg(F.count("*").alias("n"))


@query("""
    SELECT document_id, revision_id, 'sources/' || collection_slug || '/' || collection_relative_path AS source_key, 'artifacts/' || collection_slug || '/' || regexp_replace(collection_relative_path, '\\.[^./]*$', '') AS artifact_prefix,
           regexp_replace(relative_path, '/?[^/]*$', '') AS parent, regexp_replace(path, '\\.[^./]*$', '') || '/canonical/document.md' AS markdown_path, regexp_replace(path, '\\.[^./]*$', '') = artifact_dir AS layout_ok FROM inventory""")
def layout_paths(spark: SparkSession, d: str) -> DataFrame:
    stem = F.regexp_replace("path", "\\.[^./]*$", "")
    return _inv(spark, d).select(
        "document_id", "revision_id", F.concat_ws("/", F.lit("sources"), "collection_slug", "collection_relative_path").alias("source_key"), F.concat_ws("/", F.lit("artifacts"), "collection_slug", F.regexp_replace("collection_relative_path", "\\.[^./]*$", "")).alias("artifact_prefix"),
        F.regexp_replace("relative_path", "/?[^/]*$", "").alias("parent"), F.concat(stem, F.lit("/canonical/document.md")).alias("markdown_path"), (stem == F.col("artifact_dir")).alias("layout_ok"),
    )


_BARE = "lower(regexp_replace({0}, '\\.[^.]*$', ''))"


@query(f"""
    WITH f AS (SELECT DISTINCT coalesce(path, filename) AS file, filename FROM runs WHERE filename IS NOT NULL), k AS (SELECT file, {_BARE.format("filename")} AS name FROM f UNION SELECT file, {_BARE.format("regexp_replace(file, '^.*/', '')")} FROM f),
         i AS (SELECT DISTINCT path, lower(stem) AS stem, lower(filename) AS filename FROM inventory WHERE path IS NOT NULL), e AS (SELECT file, count(DISTINCT path) AS n FROM k JOIN i ON name = stem WHERE name <> '' GROUP BY 1),
         z AS (SELECT file, count(DISTINCT path) AS n FROM k JOIN i ON contains(filename, name) WHERE name <> '' AND file NOT IN (SELECT file FROM e) GROUP BY 1)
    SELECT f.file, CASE WHEN e.n = 1 THEN 'exact' WHEN e.n > 1 THEN 'multiple_exact' WHEN z.n = 1 THEN 'fuzzy' WHEN z.n > 1 THEN 'multiple_fuzzy' ELSE 'not_found' END AS outcome, coalesce(e.n, z.n, 0) AS n
    FROM (SELECT DISTINCT file FROM f) f LEFT JOIN e ON f.file = e.file LEFT JOIN z ON f.file = z.file""")
def file_matching(spark: SparkSession, d: str) -> DataFrame:
    """Run files, by the names of file and path, against all of the inventory: exact, else contained, with the five outcomes."""
    bare = lambda c: F.regexp_replace(c, "\\.[^.]*$", "")
    f = table(spark, d, "runs").where("filename is not null").select(F.coalesce("path", "filename").alias("file"), "filename").distinct()
    names = f.select("file", F.explode(F.array(bare(F.col("filename")), bare(F.regexp_replace("file", "^.*/", "")))).alias("name"))
    return inventory.file_matches(names, _inv(spark, d).select("path", "stem", "filename"))


@query("""
    WITH k AS (SELECT sha256, document_id, path, CASE WHEN contains(path, '/lote-') THEN 0 WHEN contains(path, '/incoming/') THEN 1 ELSE 2 END AS priority FROM inventory WHERE status = 'ok')
    SELECT sha256, document_id, path FROM (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY priority, lower(path), path, document_id) AS rn FROM k) WHERE rn = 1""")
def source_selection(spark: SparkSession, d: str) -> DataFrame:
    """One source per hash by directory priority, then path; a keyed minimum combined before the shuffle."""
    rank = F.when(F.contains(F.col("path"), F.lit("/lote-")), 0).when(F.contains(F.col("path"), F.lit("/incoming/")), 1).otherwise(2)
    best = F.min(F.struct(rank.alias("r"), F.lower("path").alias("l"), F.col("path"), F.col("document_id"))).alias("s")
    return _inv(spark, d).where("status = 'ok'").groupBy("sha256").agg(best).select("sha256", "s.document_id", "s.path")


@query("""
    WITH n AS (SELECT document_id, revision_id, row_number() OVER (ORDER BY document_id, revision_id, modified_at) - 1 AS i FROM inventory)
    SELECT document_id, revision_id, CAST(i % 4 AS INTEGER) AS worker FROM n""")
def round_robin(spark: SparkSession, d: str) -> DataFrame:
    """Documents dealt to four workers in order: positions from per-partition counts of a range-partitioned sort, no single-task window."""
    from ..operators.ordering import with_global_index

    return with_global_index(_inv(spark, d).select("document_id", "revision_id", "modified_at"), ["document_id", "revision_id", "modified_at"], "i").select("document_id", "revision_id", F.pmod("i", F.lit(4)).cast("int").alias("worker"))
