"""Catalogue state as tables: merges, snapshots, transitions, manifests, outbox, incremental skips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Allowed transitions of a stage run, and the order of progress within a stage.
TRANSITIONS = {
    "accepted": ("queued", "processing", "cancelled"), "queued": ("processing", "cancelled"), "processing": ("uploading", "cancelled", "orphaned"),
    "uploading": ("cataloging", "orphaned"), "cataloging": ("orphaned",), "orphaned": ("processing", "cancelled"),
}
PROGRESS = {"processing": 0, "uploading": 1, "cataloging": 2}
# Kinds of artefacts by exact path, prefix and suffix; canonical ones first.
KINDS = (
    ("= canonical/document.md", "canonical_markdown", True), ("= canonical/document_ir.json", "canonical_document_ir", True), ("= canonical/structure.json", "canonical_structure", True),
    ("= canonical/metadata.json", "canonical_document_metadata", True), ("= canonical/render.json", "canonical_render_manifest", True), ("canonical/chunks/ .jsonl", "canonical_chunks", True),
    ("canonical/ingest/ .json", "canonical_ingest_manifest", True), (" _middle.json", "extraction_json", False), (" _content_list.json", "content_list", False), (" _content_list_v2.json", "content_list", False),
    (" .md", "markdown", False), (" .jpg", "image", False), (" .jpeg", "image", False), (" .png", "image", False), (" .webp", "image", False), (" service.json", "service_manifest", False), (" .pdf", "pdf", False),
)


def kind(path: Column) -> tuple[Column, Column]:
    """Kind of an artefact by the first rule that fits, and whether it is canonical."""
    k = c = None
    for rule, name, canonical in KINDS:
        if rule.startswith("= "):
            fits = path == rule[2:]
        else:
            head, tail = rule.split(" ")
            fits = F.startswith(path, F.lit(head)) & F.endswith(F.lower(path), F.lit(tail))
        k = (F if k is None else k).when(fits, name)
        c = (F if c is None else c).when(fits, canonical)
    return k.otherwise("artifact"), c.otherwise(False)


def is_operational(path: Column) -> Column:
    """Hidden parts, caches, journals, and temporary or lock files."""
    return path.rlike("(^|/)\\.") | F.lower(path).rlike("(^|/)(__pycache__|migration-journal|bootstrap-journal)(/|$)") | F.lower(path).rlike("\\.(tmp|lock|bootstrap)$")


def merge(old: DataFrame, new: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """Upsert: every key once with the new values where there are any, and what happened to it (insert, update, keep)."""
    a, b = old.alias("a"), new.alias("b")
    j = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys], "full")
    there, came = F.col(f"a.{keys[0]}").isNotNull(), F.col(f"b.{keys[0]}").isNotNull()
    same = F.lit(True)
    for c in compare:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    action = F.when(~there, "insert").when(came & ~same, "update").otherwise("keep")
    return j.select(*[F.coalesce(F.col(f"b.{k}"), F.col(f"a.{k}")).alias(k) for k in keys], *[F.when(came, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in compare], action.alias("action"))


def diff(existing: DataFrame, wanted: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """What to do per key to make ``existing`` equal ``wanted``: insert, update, delete, keep. Only keys and a hash are shuffled."""
    h = F.xxhash64(*compare)
    j = existing.select(key, h.alias("a")).join(wanted.select(key, h.alias("b")), key, "full")
    return j.select(key, F.when(F.col("a").isNull(), "insert").when(F.col("b").isNull(), "delete").when(F.col("a") != F.col("b"), "update").otherwise("keep").alias("action"))


def transition_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a, b) for a, many in TRANSITIONS.items() for b in many], "current string, wanted string")


def check_transitions(attempts: DataFrame) -> DataFrame:
    """``verdict`` per attempted transition: applied, no_op for repeated or stale progress, else rejected."""
    allowed = F.broadcast(transition_frame(attempts.sparkSession).withColumn("ok", F.lit(True)))
    order = F.create_map(*[x for k, v in PROGRESS.items() for x in (F.lit(k), F.lit(v))])
    stale = (F.col("current") == F.col("wanted")) | (order[F.col("wanted")] <= order[F.col("current")])
    return attempts.join(allowed, ["current", "wanted"], "left").withColumn("verdict", F.when(F.col("ok"), "applied").when(stale, "no_op").otherwise("rejected")).drop("ok")


def carry_over(new: DataFrame, previous: DataFrame, key: str, same: list[str], carried: list[str]) -> DataFrame:
    """New artefact rows that keep ``carried`` from the previous manifest where key and ``same`` are unchanged."""
    p = previous.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__s_{c}") for c in same], *[F.col(c).alias(f"__c_{c}") for c in carried])
    on = F.col(key) == F.col("__k")
    for c in same:
        on = on & F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    j = new.join(p, on, "left")
    return j.select(*[c for c in new.columns if c not in carried], *[F.coalesce(F.col(f"__c_{c}"), F.col(c)).alias(c) for c in carried])


def snapshot_conflicts(facts: DataFrame, snapshot: DataFrame, by: list[list[str]], immutable: list[str]) -> DataFrame:
    """Pairs that share one of several keys but differ in an immutable fact: a disjunctive join as a union of equi-joins."""
    out = None
    differs = F.lit(False)
    for c in immutable:
        differs = differs | ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    for keys in by:
        j = facts.alias("a").join(snapshot.alias("b"), [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]).where(differs).select(*[F.col(f"a.{c}").alias(c) for c in facts.columns])
        out = j if out is None else out.unionByName(j)
    return out.distinct()


def activation(snapshots: DataFrame, chosen: Column) -> DataFrame:
    """The chosen snapshot becomes active if its declared, listed and stored counts agree; the one active before in its scope is superseded."""
    agree = (F.col("declared") == F.col("listed")) & (F.col("listed") == F.col("stored"))
    marked = snapshots.withColumn("__go", chosen & agree)
    scope = marked.groupBy("scope").agg(F.max(F.col("__go").cast("int")).alias("__any"))
    j = marked.join(scope, "scope")
    status = F.when(F.col("__go"), "active").when((F.col("status") == "active") & (F.col("__any") == 1), "superseded").when(chosen & ~agree, "rejected").otherwise(F.col("status"))
    return j.withColumn("new_status", status).drop("__go", "__any")


def newest_first(records: DataFrame, key: str, order: list[str]) -> DataFrame:
    """All records with their ``rank`` within the key, the greatest of the ordering columns first."""
    return records.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])))
