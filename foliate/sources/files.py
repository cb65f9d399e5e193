"""Scans: PDF trees, CSV in two type regimes, JSON lines, extraction payloads, content lists, manifests, listings, logs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity
from ..operators.content_list import content_items

# The inventory's columns in order.
INVENTORY = [
    ("collection", "string"), ("collection_slug", "string"), ("document_id", "string"), ("revision_id", "string"), ("sha256", "string"), ("path", "string"), ("relative_path", "string"),
    ("collection_relative_path", "string"), ("filename", "string"), ("stem", "string"), ("artifact_dir", "string"), ("manifest_path", "string"), ("extension", "string"), ("size_bytes", "bigint"), ("size_mb", "double"),
    ("created_at", "string"), ("modified_at", "string"), ("page_count", "int"), ("encrypted", "boolean"), ("pdf_version", "string"), ("title", "string"), ("author", "string"), ("subject", "string"), ("creator", "string"),
    ("producer", "string"), ("status", "string"), ("error", "string"),
]
INVENTORY_DDL = ", ".join(f"{c} {t}" for c, t in INVENTORY)
MANIFEST = "document.json"


def csv_typed(spark: SparkSession, path: str, schema: str = INVENTORY_DDL) -> DataFrame:
    """CSV with a declared schema; an empty cell is null. The types are never inferred."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def csv_strings(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV in which every cell is a string and an empty cell is the empty string, never null."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).option("header", True).option("nullValue", "\x00").option("emptyValue", "").option("multiLine", True).option("escape", '"').csv(path).na.fill("")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; blank lines are skipped, a line that is no object is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def object_listing(spark: SparkSession, prefix: str, glob: str | None = None) -> DataFrame:
    """``path, modified, size`` of all files below a prefix; contents are pruned from the scan."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return (r.option("pathGlobFilter", glob) if glob else r).load(prefix).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def pdf_facts(content: bytes) -> dict:
    """Version, encryption, pages and document information read from a PDF's plain objects.

    Pages are the page objects, or the greatest /Count where objects are
    compressed. Anything that is no PDF raises ValueError.
    """
    head = re.search(rb"%PDF-(\d\.\d)", content[:1024])
    if not head:
        raise ValueError("not a PDF")
    pages = len(re.findall(rb"/Type\s*/Page(?![s\w])", content)) or max((int(x) for x in re.findall(rb"/Count\s+(\d+)", content)), default=0)
    out = {"pdf_version": head[1].decode(), "encrypted": b"/Encrypt" in content, "page_count": pages or None}
    for key in ("Title", "Author", "Subject", "Creator", "Producer"):
        m = re.search(rb"/" + key.encode() + rb"\s*(\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>)", content)
        value = None
        if m:
            raw = re.sub(rb"\\([()\\])", rb"\1", m[1][1:-1]) if m[1][:1] == b"(" else bytes.fromhex(re.sub(rb"\s", b"", m[1][1:-1]).decode())
            value = raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("latin-1")
        out[key.lower()] = value.strip() or None if value else None
    return out


_FACTS = {"path": pa.string(), "page_count": pa.int32(), "encrypted": pa.bool_(), "pdf_version": pa.string(), "title": pa.string(), "author": pa.string(), "subject": pa.string(), "creator": pa.string(), "producer": pa.string(), "status": pa.string(), "error": pa.string()}


def _inspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            try:
                rows.append({"path": path, "status": "ok", "error": None, **pdf_facts(content)})
            except Exception as e:  # an unreadable file is a row, not a failure
                rows.append({"path": path, "status": "error", "error": f"{type(e).__name__}: {e}"})
        yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in _FACTS.items()], list(_FACTS))


def pdf_inventory(spark: SparkSession, root: str) -> DataFrame:
    """The inventory of all PDFs below ``root``, one collection a first-level folder.

    Files below a folder that already holds a manifest are left out. Hash, size
    and ids are worked out in the JVM; only the facts inside the file need Python.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(root)
    done = object_listing(spark, root, MANIFEST).select(F.regexp_replace("path", "/[^/]*$", "").alias("dir"))
    parents = files.select("path", F.explode(F.expr("transform(sequence(1, size(split(path, '/')) - 1), i -> substring_index(path, '/', i))")).alias("dir"))
    below = parents.join(done, "dir", "left_semi").select("path").distinct()
    files = files.join(below, "path", "left_anti")
    facts = files.select("path", "content").mapInArrow(_inspect, "path string, page_count int, encrypted boolean, pdf_version string, title string, author string, subject string, creator string, producer string, status string, error string")
    base = re.sub(r"^file:/*", "/", root.rstrip("/"))
    plain = F.regexp_replace("path", "^file:/*", "/")
    j = files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"), "modificationTime").join(facts, "path")
    j = j.withColumn("path", plain).withColumn("relative_path", F.expr(f"substr(path, {len(base) + 2})"))
    j = j.withColumn("collection", F.substring_index("relative_path", "/", 1)).withColumn("collection_relative_path", F.regexp_replace("relative_path", "^[^/]*/", "")).withColumn("collection_slug", identity.slug(F.col("collection")))
    stem = F.regexp_replace("path", "\\.[^./]*$", "")
    iso = F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    j = j.withColumn("document_id", identity.document_id(F.col("collection_slug"), F.col("collection_relative_path"))).withColumn("revision_id", identity.revision_id(F.col("document_id"), F.col("sha256")))
    j = j.withColumn("filename", F.substring_index("path", "/", -1)).withColumn("artifact_dir", stem).withColumn("manifest_path", F.concat(stem, F.lit(f"/{MANIFEST}"))).withColumn("size_mb", F.round(F.col("size_bytes") / 1024 / 1024, 4))
    j = j.withColumn("stem", F.regexp_replace("filename", "\\.[^.]*$", "")).withColumn("extension", F.lower(F.regexp_extract("filename", "(\\.[^.]*)$", 1))).withColumn("created_at", iso).withColumn("modified_at", iso)
    return j.select(*[F.col(c).cast(t).alias(c) for c, t in INVENTORY])


def extraction_payloads(spark: SparkSession, prefix: str) -> DataFrame:
    """``record_id, document_id, source_name, payload, received_at`` of extraction JSON files, whole files as they are."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*_middle.json").load(prefix)
    name = F.regexp_replace(F.substring_index("path", "/", -1), "_middle\\.json$", "")
    return f.select(F.xxhash64("path").alias("record_id"), F.element_at(F.split("path", "/"), -2).alias("document_id"), name.alias("source_name"), F.decode("content", "UTF-8").alias("payload"), F.col("modificationTime").alias("received_at"))


def content_list(frame: DataFrame, payload: str = "payload") -> DataFrame:
    """Items of content-list payloads with all other columns of the frame: page, ordinal, order over all pages, item id, type, box, text and its parts, level.

    Pages that are no lists are rows marked ``bad``; items that are no objects keep their positions.
    """
    return content_items(frame, payload, *[c for c in frame.columns if c != payload])


def content_list_files(spark: SparkSession, prefix: str) -> DataFrame:
    """``path, sha256`` and the items of the content-list files below a prefix."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*_content_list_v2.json").load(prefix)
    return content_list(f.select("path", F.sha2("content", 256).alias("sha256"), F.decode("content", "UTF-8").alias("payload")))


def manifests(spark: SparkSession, prefix: str) -> DataFrame:
    """``path, document_id, status``: the last extract run of each manifest, pending where it cannot be read or has none."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", MANIFEST).load(prefix)
    kind = "document_id string, status string, stage_runs array<struct<stage:string,status:string>>"
    m = f.select("path", F.from_json(F.decode("content", "UTF-8"), kind).alias("m"))
    last = F.try_element_at(F.filter("m.stage_runs", lambda s: s["stage"] == "extract"), F.lit(-1))["status"]
    return m.select("path", F.col("m.document_id").alias("document_id"), F.coalesce(last, F.col("m.status"), F.lit("pending")).alias("status"))


def listing_tsv(spark: SparkSession, path: str) -> DataFrame:
    """``path, size, modified, unsafe`` of a tab-separated listing; absolute paths and paths with .. are marked."""
    t = spark.read.schema("path string, size long, modified string").option("sep", "\t").csv(path)
    return t.withColumn("unsafe", F.col("path").isNull() | F.col("path").rlike("^/|(^|/)\\.\\.(/|$)"))


def log_lines(frame: DataFrame, message: str = "message") -> DataFrame:
    """Adds ``kv``: the key=value tokens of a message; the last of equal keys counts."""
    pairs = F.transform(F.regexp_extract_all(message, F.lit("(\\w+=\\S+)"), F.lit(1)), lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.regexp_replace(x, "^\\w+=", "").alias("v")))
    last = F.aggregate(pairs, F.expr("cast(map() as map<string,string>)"), lambda m, x: F.map_concat(F.map_filter(m, lambda k, v: k != x["k"]), F.map_from_arrays(F.array(x["k"]), F.array(x["v"]))))
    return frame.withColumn("kv", last)
