"""Queries on catalogue state; orders stand for revisions, line items for their artefacts, events for stage events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog
from ..session import table
from .base import query


@query("""SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_orderstatus ELSE a.o_orderstatus END AS o_orderstatus,
    CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN b.o_orderkey IS NOT NULL AND a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'update' ELSE 'keep' END AS action
    FROM (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01') a FULL JOIN (SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01') b ON a.o_orderkey = b.o_orderkey""")
def catalog_merge(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    old = o.where("o_orderdate < timestamp_ntz'1997-01-01'").select("o_orderkey", "o_orderstatus")
    new = o.where("o_orderdate >= timestamp_ntz'1995-01-01'").select("o_orderkey", F.when(F.col("o_totalprice") > 200000, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    return catalog.merge(old, new, ["o_orderkey"], ["o_orderstatus"])


@query("SELECT year(o_orderdate) AS snapshot, count(DISTINCT o_orderkey) AS revisions, count(l_linenumber) AS artifacts, CAST(count(DISTINCT o_custkey) AS BIGINT) AS documents FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def snapshot_counts(spark: SparkSession, d: str) -> DataFrame:
    """Artefacts are counted per revision before the join, so the join meets one row a revision."""
    per = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("l_linenumber").alias("n"))
    j = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate").join(per, "o_orderkey", "left")
    return j.groupBy(F.year("o_orderdate").cast("long").alias("snapshot")).agg(F.countDistinct("o_orderkey").alias("revisions"), F.coalesce(F.sum("n"), F.lit(0)).alias("artifacts"), F.countDistinct("o_custkey").alias("documents"))


_SNAP = """(SELECT o_orderpriority AS scope, year(o_orderdate) AS y, count(*) AS declared, count(o_custkey) AS listed, count(*) - CASE WHEN year(o_orderdate) = 1996 AND o_orderpriority LIKE '1%' THEN 1 ELSE 0 END AS stored, CASE WHEN year(o_orderdate) = 1995 THEN 'active' ELSE 'ready' END AS status FROM orders GROUP BY o_orderpriority, year(o_orderdate))"""


@query(f"""WITH m AS (SELECT *, y = 1996 AS c, declared = listed AND listed = stored AS agree FROM {_SNAP}), g AS (SELECT scope, max(CAST(c AND agree AS INTEGER)) AS go FROM m GROUP BY 1)
    SELECT m.scope, y, CASE WHEN c AND agree THEN 'active' WHEN status = 'active' AND go = 1 THEN 'superseded' WHEN c AND NOT agree THEN 'rejected' ELSE status END AS new_status FROM m JOIN g ON m.scope = g.scope""")
def snapshot_activation(spark: SparkSession, d: str) -> DataFrame:
    y = F.year("o_orderdate").cast("long")
    s = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("scope"), y.alias("y")).agg(F.count("*").alias("declared"), F.count("o_custkey").alias("listed"))
    s = s.withColumn("stored", F.col("declared") - F.when((F.col("y") == 1996) & F.col("scope").like("1%"), 1).otherwise(0)).withColumn("status", F.when(F.col("y") == 1995, "active").otherwise("ready"))
    return catalog.activation(s, F.col("y") == 1996).select("scope", "y", "new_status")


_FACT = "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_orderkey % 97 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity FROM lineitem)"


@query("""WITH f AS (SELECT l_orderkey, l_linenumber + CASE WHEN l_orderkey % 89 = 0 THEN 100 ELSE 0 END AS l_linenumber, l_partkey + CASE WHEN l_orderkey % 83 = 0 THEN 1000000 ELSE 0 END AS l_partkey, l_suppkey, l_quantity + CASE WHEN l_orderkey % 97 = 0 OR l_orderkey % 89 = 0 THEN 1 ELSE 0 END AS l_quantity FROM lineitem)
    SELECT DISTINCT f.l_orderkey, f.l_linenumber, f.l_partkey FROM f JOIN lineitem s ON f.l_orderkey = s.l_orderkey AND (f.l_linenumber = s.l_linenumber OR (f.l_partkey = s.l_partkey AND f.l_suppkey = s.l_suppkey)) WHERE f.l_quantity IS DISTINCT FROM s.l_quantity""")
def snapshot_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Facts that share a place or a part with the snapshot but not the quantity; some match by one of the two keys only."""
    b = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    off = lambda c, n, k: (F.col(c) + F.when(F.col("l_orderkey") % n == 0, k).otherwise(0)).alias(c)
    more = F.when((F.col("l_orderkey") % 97 == 0) | (F.col("l_orderkey") % 89 == 0), 1).otherwise(0)
    a = b.select("l_orderkey", off("l_linenumber", 89, 100), off("l_partkey", 83, 1000000), "l_suppkey", (F.col("l_quantity") + more).alias("l_quantity"))
    made = catalog.snapshot_conflicts(a, b, [["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey", "l_suppkey"]], ["l_quantity"])
    return made.select("l_orderkey", "l_linenumber", "l_partkey").distinct()


_PATHS = """(SELECT l_orderkey, l_linenumber, CASE CAST(l_partkey % 9 AS INTEGER) WHEN 0 THEN 'canonical/document.md' WHEN 1 THEN 'canonical/chunks/' || l_linenumber || '.jsonl' WHEN 2 THEN 'doc_middle.json' WHEN 3 THEN 'images/' || l_suppkey || '.JPG' WHEN 4 THEN 'doc_content_list_v2.json' WHEN 5 THEN '.cache/x.tmp' WHEN 6 THEN 'source.pdf' WHEN 7 THEN 'notes.md' ELSE 'other.bin' END AS path FROM lineitem)"""


@query(f"""SELECT CASE WHEN path = 'canonical/document.md' THEN 'canonical_markdown' WHEN starts_with(path, 'canonical/chunks/') THEN 'canonical_chunks' WHEN ends_with(lower(path), '_middle.json') THEN 'extraction_json' WHEN ends_with(lower(path), '_content_list_v2.json') THEN 'content_list'
    WHEN ends_with(lower(path), '.md') THEN 'markdown' WHEN ends_with(lower(path), '.jpg') THEN 'image' WHEN ends_with(lower(path), '.pdf') THEN 'pdf' ELSE 'artifact' END AS kind, starts_with(path, 'canonical/') AS canonical, regexp_matches(path, '(^|/)\\.') OR regexp_matches(path, '\\.tmp$') AS operational, count(*) AS n FROM {_PATHS} GROUP BY 1, 2, 3""")
def artifact_kinds(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("l_partkey") % 9
    path = (
        F.when(p == 0, "canonical/document.md").when(p == 1, F.concat(F.lit("canonical/chunks/"), F.col("l_linenumber").cast("string"), F.lit(".jsonl"))).when(p == 2, "doc_middle.json").when(p == 3, F.concat(F.lit("images/"), F.col("l_suppkey").cast("string"), F.lit(".JPG")))
        .when(p == 4, "doc_content_list_v2.json").when(p == 5, ".cache/x.tmp").when(p == 6, "source.pdf").when(p == 7, "notes.md").otherwise("other.bin")
    )
    a = table(spark, d, "lineitem").select(path.alias("path"))
    k, c = catalog.kind(F.col("path"))
    return a.groupBy(k.alias("kind"), c.alias("canonical"), catalog.is_operational(F.col("path")).alias("operational")).agg(F.count("*").alias("n"))


@query("""SELECT n.l_orderkey || '/' || n.l_linenumber AS object_key, coalesce(p.origin, 'new') AS origin FROM lineitem n LEFT JOIN (SELECT l_orderkey, l_linenumber, l_quantity, 'run-' || (l_suppkey % 5) AS origin FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01' AND l_orderkey % 10 <> 3) p ON n.l_orderkey = p.l_orderkey AND n.l_linenumber = p.l_linenumber AND n.l_quantity = p.l_quantity""")
def manifest_carry_over(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("object_key"), "l_quantity", "l_suppkey", "l_shipdate", "l_orderkey")
    before = rows.where((F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("l_orderkey") % 10 != 3)).select("object_key", "l_quantity", F.concat(F.lit("run-"), (F.col("l_suppkey") % 5).cast("string")).alias("origin"))
    return catalog.carry_over(rows.select("object_key", "l_quantity", F.lit("new").alias("origin")), before, "object_key", ["l_quantity"], ["origin"]).select("object_key", "origin")


@query("SELECT event_type, user_id, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def outbox_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Keep the first event per (topic, aggregate): a keyed minimum."""
    return table(spark, d, "events").groupBy("event_type", "user_id").agg(F.min("event_id").alias("event_id"))


_STATES = "['accepted', 'queued', 'processing', 'uploading', 'cataloging', 'orphaned', 'cancelled']"


@query(f"""WITH a AS (SELECT event_id, ({_STATES})[event_id % 7 + 1] AS current, ({_STATES})[user_id % 7 + 1] AS wanted FROM events),
    t(current, wanted) AS (VALUES {', '.join(f"('{a}', '{b}')" for a, many in catalog.TRANSITIONS.items() for b in many)}), p(s, k) AS (VALUES ('processing', 0), ('uploading', 1), ('cataloging', 2))
    SELECT a.current, a.wanted, CASE WHEN t.current IS NOT NULL THEN 'applied' WHEN a.current = a.wanted OR (SELECT k FROM p WHERE s = a.wanted) <= (SELECT k FROM p WHERE s = a.current) THEN 'no_op' ELSE 'rejected' END AS verdict, count(*) AS n
    FROM a LEFT JOIN t ON a.current = t.current AND a.wanted = t.wanted GROUP BY 1, 2, 3""")
def transition_check(spark: SparkSession, d: str) -> DataFrame:
    states = F.array(*[F.lit(s) for s in ("accepted", "queued", "processing", "uploading", "cataloging", "orphaned", "cancelled")])
    e = table(spark, d, "events").select(F.element_at(states, (F.col("event_id") % 7 + 1).cast("int")).alias("current"), F.element_at(states, (F.col("user_id") % 7 + 1).cast("int")).alias("wanted"))
    return catalog.check_transitions(e).groupBy("current", "wanted", "verdict").agg(F.count("*").alias("n"))


@query("""WITH m AS (SELECT document_id, max_by(sha256, (try_cast(started_at AS TIMESTAMPTZ), sha256)) AS sha FROM (SELECT DISTINCT * FROM runs) WHERE status = 'ok' GROUP BY 1), i AS (SELECT document_id, max_by(sha256, (try_cast(modified_at AS TIMESTAMPTZ), revision_id)) AS sha FROM inventory WHERE status = 'ok' GROUP BY 1)
    SELECT i.document_id, CASE WHEN m.sha IS NULL THEN 'pending' WHEN m.sha = i.sha THEN 'current' ELSE 'stale' END AS state FROM i LEFT JOIN m USING (document_id)""")
def currentness_skip(spark: SparkSession, d: str) -> DataFrame:
    """What an incremental run may skip: documents whose last good run saw the hash the inventory has now."""
    m = table(spark, d, "runs").where("status = 'ok'").groupBy("document_id").agg(F.max_by("sha256", F.struct(F.try_to_timestamp(F.col("started_at")), "sha256")).alias("seen"))
    i = table(spark, d, "inventory").where("status = 'ok'").groupBy("document_id").agg(F.max_by("sha256", F.struct(F.try_to_timestamp(F.col("modified_at")), "revision_id")).alias("sha"))
    return i.join(m, "document_id", "left").select("document_id", F.when(F.col("seen").isNull(), "pending").when(F.col("seen") == F.col("sha"), "current").otherwise("stale").alias("state"))


@query("SELECT l_orderkey AS package, count(*) AS files, CAST(sum(l_quantity) AS DOUBLE) AS size, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS listing FROM lineitem GROUP BY 1")
def package_totals(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("package"))
    return g.agg(F.count("*").alias("files"), F.sum("l_quantity").cast("double").alias("size"), F.array_join(F.transform(F.array_sort(F.collect_list("l_linenumber")), lambda x: x.cast("string")), ",").alias("listing"))


@query("""WITH a AS (SELECT l_orderkey, l_linenumber FROM lineitem), b AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber <> 5 OR l_orderkey % 3 = 0), j AS (SELECT coalesce(a.l_orderkey, b.l_orderkey) AS k, a.l_orderkey IS NULL AS extra, b.l_orderkey IS NULL AS missing FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber)
    SELECT k AS package, CAST(sum(CASE WHEN missing THEN 1 ELSE 0 END) AS BIGINT) AS missing, CAST(sum(CASE WHEN extra THEN 1 ELSE 0 END) AS BIGINT) AS extra FROM j GROUP BY 1 HAVING sum(CASE WHEN missing OR extra THEN 1 ELSE 0 END) > 0""")
def dump_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    b = a.where("l_linenumber <> 5 or l_orderkey % 3 = 0")
    keys = ["l_orderkey", "l_linenumber"]
    j = a.withColumn("a", F.lit(1)).join(b.withColumn("b", F.lit(1)), keys, "full")
    g = j.groupBy(F.col("l_orderkey").alias("package")).agg(F.count_if(F.col("b").isNull()).alias("missing"), F.count_if(F.col("a").isNull()).alias("extra"))
    return g.where("missing + extra > 0")


@query("SELECT o_custkey AS correlation, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS rank FROM orders")
def correlation_newest_first(spark: SparkSession, d: str) -> DataFrame:
    """Every task of each correlation key with its rank, the newest first."""
    return catalog.newest_first(table(spark, d, "orders").select(F.col("o_custkey").alias("correlation"), "o_orderkey", "o_orderdate"), "correlation", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("SELECT sha256, min(document_id) AS document_id FROM (SELECT DISTINCT sha256, document_id FROM inventory WHERE status = 'ok') GROUP BY 1 HAVING count(*) = 1")
def unambiguous_alias(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "inventory").where("status = 'ok'").select("sha256", "document_id").distinct().groupBy("sha256").agg(F.count("*").alias("n"), F.min("document_id").alias("document_id"))
    return g.where("n = 1").select("sha256", "document_id")


@query("""WITH c AS (SELECT o_clerk AS path FROM orders WHERE false), n AS (SELECT r_name || '/' || n_name AS path, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey)
    SELECT path, count(c_custkey) AS documents, round(coalesce(sum(c_acctbal), 0), 2) AS total FROM n LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1""".replace("WITH c AS (SELECT o_clerk AS path FROM orders WHERE false), n", "WITH n"))
def collection_tree(spark: SparkSession, d: str) -> DataFrame:
    """Counts along the tree of collections; leaves are counted before they are joined."""
    per = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("c_custkey").alias("documents"), F.sum("c_acctbal").alias("total"))
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.join(per, "n_nationkey", "left").select(F.concat_ws("/", "r_name", "n_name").alias("path"), F.coalesce("documents", F.lit(0)).alias("documents"), F.round(F.coalesce("total", F.lit(0.0)), 2).alias("total"))
