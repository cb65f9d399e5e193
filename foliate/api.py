"""The pipeline's stages as functions over tables in one folder; each writes a table and returns it."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import identity, tokenizer
from .operators import audit, bibliography, catalog, chunking, inventory, render, runs
from .sources import files, sinks


def _put(df: DataFrame, folder: str, name: str) -> DataFrame:
    sinks.write_table(df, f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def build_inventory(spark: SparkSession, root: str, folder: str, previous: DataFrame | None = None) -> DataFrame:
    """Scan, merge with a previous inventory keeping the last of each document, refuse collisions of paths."""
    new = files.pdf_inventory(spark, root)
    merged = inventory.merge(previous, new) if previous is not None else new
    done = _put(merged, folder, "inventory")
    if not inventory.physical_collisions(done).isEmpty():
        raise inventory.SelectionError("one path stands for several documents")
    return done


def select(inv: DataFrame, collection: str | None = None, path: str | None = None) -> DataFrame:
    chosen = inventory.select(inv, collection, path)
    if chosen.isEmpty():
        raise inventory.SelectionError("nothing is selected")
    return chosen


def sample(inv: DataFrame, size: int, seed: int = 42, stratified: bool = True) -> DataFrame:
    return inventory.stratified_sample(inv, size, seed) if stratified else inventory.seeded_sample(inv, size, seed)


def audit_inventory(inv: DataFrame, folder: str) -> dict:
    _put(inv.where(inventory.is_invalid()), folder, "invalid_documents")
    _put(inventory.duplicates(inv), folder, "duplicate_documents")
    _put(inventory.extraction_manifest(inv), folder, "extraction_manifest")
    summary = inventory.audit(inv).first().asDict()
    sinks.write_json(summary, f"{folder}/summary.json")
    if not summary["unique_documents"]:
        raise RuntimeError("no valid document to extract")
    return summary


def audit_extraction(records: DataFrame, inv: DataFrame, folder: str) -> dict:
    """Metrics and codes per record, and their summary."""
    done = _put(audit.inspection(records, inv), folder, "extraction_audit")
    summary = audit.summary(done).first().asDict()
    sinks.write_json(summary, f"{folder}/extraction_summary.json")
    return summary


def recover(extraction_runs: DataFrame, listing: DataFrame) -> DataFrame:
    """Documents whose last run failed though their results are listed: they are fetched instead of run again."""
    last = runs.last_runs(extraction_runs).where("status <> 'ok'").select("document_id", "output_dir", "error")
    return last.join(listing.select(F.col("path").alias("output_dir")).distinct(), "output_dir", "left_semi")


def review(blocks: DataFrame, inv: DataFrame, overrides: DataFrame, folder: str) -> DataFrame:
    """Documents whose authors a human has to see."""
    return _put(bibliography.bibliography(blocks, inv, overrides).where("review is not null"), folder, "review")


def init(spark: SparkSession, name: str, folder: str) -> dict:
    """The identity of a new collection, written beside its tables; a folder that holds another one is refused."""
    row = spark.range(1).select(identity.slug(F.lit(name)).alias("slug")).select("slug", identity.collection_id(F.col("slug")).alias("id")).first()
    config = {"name": name, "slug": row["slug"], "id": row["id"]}
    path = f"{folder}/collection.json"
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            if json.load(f) != config:
                raise ValueError("the folder belongs to another collection")
    sinks.write_json(config, path)
    return config


def bootstrap(wanted: DataFrame, inv: DataFrame, folder: str) -> DataFrame:
    """A plan of sources by hash for ``document_id, sha256``; documents without a source or with several are marked, and nothing is moved."""
    sources = inv.where("status = 'ok' and sha256 is not null").groupBy("sha256").agg(F.min(F.struct(F.lower("path"), "path"))["path"].alias("source"), F.countDistinct("path").alias("copies"))
    plan = wanted.join(sources, "sha256", "left").withColumn("state", F.when(F.col("source").isNull(), "missing").when(F.col("copies") > 1, "several").otherwise("ready"))
    return _put(plan, folder, "bootstrap")


def pipeline(records: DataFrame, blocks: DataFrame, inv: DataFrame, folder: str, through: str = "ingest") -> dict:
    """The stages one after the other up to ``through``; a stage whose gate fails stops the run."""
    stages = ("inventory", "extract", "render", "ingest")
    done: dict = {}
    for stage in stages[: stages.index(through) + 1]:
        if stage == "inventory":
            done[stage] = audit_inventory(inv, folder)
        elif stage == "extract":
            done[stage] = audit_extraction(records, inv, folder)
            if not done[stage]["passed"] + done[stage]["warnings"]:
                raise RuntimeError("no extraction passed its audit")
        elif stage == "render":
            done[stage] = render_documents(blocks, folder)
        else:
            done[stage] = ingest(blocks, folder)[0]
    return done


def quick(spark: SparkSession, root: str, folder: str) -> dict:
    """Inventory and audit of a tree of PDFs."""
    return audit_inventory(build_inventory(spark, root, folder), folder)


def pending(inv: DataFrame, extraction_runs: DataFrame) -> DataFrame:
    """Documents without a good last run, those that never failed first."""
    last = runs.last_runs(extraction_runs).select("document_id", "status", "generated_files")
    todo = inventory.extraction_manifest(inv).select("document_id", "sha256", "path").join(last, "document_id", "left").where("coalesce(status, '') <> 'ok' or coalesce(generated_files, 0) = 0")
    return todo.withColumn("deferred", F.col("status").isNotNull()).orderBy("deferred", "document_id")


def render_documents(blocks: DataFrame, folder: str) -> DataFrame:
    return _put(render.markdown(blocks), folder, "markdown")


def ingest(blocks: DataFrame, folder: str, existing: DataFrame | None = None, size: int = 700, overlap: int = 100) -> tuple[DataFrame, DataFrame]:
    """Chunks, and what a vector store has to do to hold exactly them."""
    chunks = _put(chunking.recursive_chunks(blocks, size, overlap, tokenizer.token_length).withColumn("content_hash", F.sha2("text", 256)), folder, "chunks")
    held = existing if existing is not None else chunks.limit(0).select("chunk_id", "content_hash")
    return chunks, sinks.vector_actions(held.select("chunk_id", "content_hash"), chunks.select("chunk_id", "content_hash"))


def snapshot(inv: DataFrame, folder: str) -> DataFrame:
    return _put(inventory.fingerprint(inventory.extraction_manifest(inv)), folder, "snapshot")


def status(inv: DataFrame, extraction_runs: DataFrame) -> DataFrame:
    """Per collection: documents, extracted, stage."""
    last = runs.last_runs(extraction_runs).select("document_id", (F.col("status") == "ok").alias("done"))
    g = inventory.extraction_manifest(inv).join(last, "document_id", "left").groupBy("collection_slug").agg(F.count("*").alias("documents"), F.count_if(F.coalesce("done", F.lit(False))).alias("extracted"))
    return g.withColumn("stage", F.when(F.col("extracted") == 0, "inventory").when(F.col("extracted") < F.col("documents"), "extracting").otherwise("extracted"))


def promote(facts: DataFrame, snapshot_facts: DataFrame) -> DataFrame:
    """Facts that contradict the active snapshot; a promotion needs none."""
    return catalog.snapshot_conflicts(facts, snapshot_facts, [["artifact_id"], ["object_key"]], ["sha256", "size"])
