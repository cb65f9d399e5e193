"""Smaller rules of the pipeline: eligibility, histories, packages, plans, listings, dashboards, contextual text."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.window import Window

from ..functions import deepjson
from ..functions.text import collapse
from . import structure

# A marker of metadata blocks, and media types by suffix.
METADATA_MARKER = r"(?i)\b(?:doi|e-?mail|orcid|institui[cç][aã]o|universidade|faculdade|submitted|approved|recebido|aceito|vers[aã]o|doutor(?:a|ando|anda)?|mestre|p[oó]s[- ]graduando)\b"
MEDIA = {".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".webp": "image/webp", ".pdf": "application/pdf", ".json": "application/json", ".md": "text/markdown"}


def media_type(path: Column) -> Column:
    suffix = F.lower(F.regexp_extract(path, "(\\.[^./]*)$", 1))
    out = None
    for k, v in MEDIA.items():
        out = (F if out is None else out).when(suffix == k, v)
    return out.otherwise("application/octet-stream")


def contextual_blocks(blocks: DataFrame, titles: DataFrame) -> DataFrame:
    """``block_id, contextual``: every block with a text below its document's title and heading path, both labelled."""
    b = structure.sections(blocks, texts=True).select("block_id", "document_id", "section", "text").where("text is not null")
    paths = structure.heading_paths(blocks).select("section", "path")
    label = lambda name, c: F.when(F.trim(c) != "", F.concat(F.lit(f"{name}: "), c))
    head = F.nullif(F.concat_ws("\n", label("Documento", F.col("title")), label("Seção", F.col("path"))), F.lit(""))
    j = b.join(paths, "section", "left").join(titles, "document_id", "left")
    return j.select("block_id", F.regexp_replace(F.concat_ws("\n\n", head, "text"), "^[ \t\n\r]+|[ \t\n\r]+$", "").alias("contextual"))


def has_content(columns: list[str]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | (F.coalesce(F.trim(F.col(c)), F.lit("")) != "")
    return out


def normal_url(c: Column) -> Column:
    """Scheme and host in lower case, no query, no trailing slash; null if it has no host."""
    host = F.lower(F.regexp_extract(c, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1))
    scheme = F.lower(F.regexp_extract(c, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    path = F.regexp_replace(F.regexp_extract(c, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1), "/+$", "")
    return F.when(host != "", F.concat(scheme, F.lit("://"), host, path))


def percent_list(c: Column) -> tuple[Column, Column]:
    """Mean and maximum of a slash-separated list of percentages; parts that are no numbers are left out."""
    v = F.filter(F.transform(F.split(c, "/"), lambda x: F.regexp_replace(x, "[%\\s]", "").try_cast("double")), lambda x: x.isNotNull())
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(v), F.lit(0)), F.array_max(v)


def consecutive_missing(probes: DataFrame, key: str, order: str, missing: Column, least: int) -> DataFrame:
    """Keys with at least ``least`` missing probes in a row: gaps and islands."""
    w = Window.partitionBy(key).orderBy(order)
    g = probes.withColumn("__m", F.coalesce(missing, F.lit(False))).withColumn("__g", F.sum((~F.col("__m")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = g.where("__m").groupBy(key, "__g").agg(F.count("*").alias("n"))
    return runs.groupBy(key).agg(F.max("n").alias("longest")).where(F.col("longest") >= least)


def append_history(entries: Column, history: Column) -> Column:
    """A history with entries after it; a null history is empty."""
    return F.concat(F.coalesce(history, F.expr("cast(array() as array<string>)")), entries)


def exactly_one(candidates: DataFrame, key: str, path: str, listing: DataFrame, listed: str) -> DataFrame:
    """Keys for which not exactly one of the candidate paths is in the listing."""
    hit = candidates.join(listing.select(F.col(listed).alias(path)).distinct().withColumn("__hit", F.lit(1)), path, "left")
    return hit.groupBy(key).agg(F.count("__hit").alias("copies")).where("copies <> 1")


def equal_sets(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per key whether both sides list exactly the same rows, as multisets: counts of row hashes are compared, nothing is gathered."""
    h = F.xxhash64(*columns)
    both = a.select(key, h.alias("h"), F.lit(1).alias("d")).unionByName(b.select(key, h.alias("h"), F.lit(-1).alias("d")))
    return both.groupBy(key, "h").agg(F.sum("d").alias("d")).groupBy(key).agg((F.max(F.abs("d")) == 0).alias("equal"))


def multiset_minus(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Counts of ``a`` minus counts of ``b``, what is left below one dropped."""
    both = a.select(*columns, F.lit(1).alias("d")).unionByName(b.select(*columns, F.lit(-1).alias("d")))
    return both.groupBy(*columns).agg(F.sum("d").alias("n")).where("n > 0")


def admission(used: Column, capacity: Column, free: Column, need: Column) -> Column:
    """Reasons against taking more work, empty if there are none."""
    return F.array_compact(F.array(F.when(used >= capacity, "backlog"), F.when(free < need, "disk")))


def _paths(value: object, wanted: str) -> Iterator[tuple[str, str]]:
    """``(path, value)`` of every occurrence of a key, in the order of the text; nesting may have any depth."""
    todo = [("", value)]
    while todo:
        path, v = todo.pop()
        if isinstance(v, dict):
            below = [(f"{path}.{k}" if path else k, k, x) for k, x in v.items()]
        elif isinstance(v, list):
            below = [(f"{path}[{i}]", None, x) for i, x in enumerate(v)]
        else:
            continue
        for at, k, x in below:
            if k == wanted:
                yield at, x if isinstance(x, str) else deepjson.dumps(x)
        todo += [(at, x) for at, _, x in reversed(below)]


def key_paths(frame: DataFrame, key: str, payload: str, wanted: str) -> DataFrame:
    """``key, path, value`` of every occurrence of a field at any depth of JSON payloads; payloads that are not valid give none."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for k, p in zip(pdf.key, pdf.payload):
                try:
                    rows += [(k, a, v) for a, v in _paths(deepjson.loads(p), wanted)]
                except ValueError:
                    continue
            yield pd.DataFrame(rows, columns=["key", "path", "value"])

    return frame.select(F.col(key).cast("string").alias("key"), F.col(payload).alias("payload")).where("payload is not null").mapInPandas(run, "key string, path string, value string")


@udtf(returnType="piece: int, start: int, text: string")
class SplitText:
    """Table function for SQL: pieces of a text of at most ``size`` characters by the recursive splitter."""

    def eval(self, text: str, size: int) -> Iterator[tuple]:
        from .chunking import split_recursively

        at = 0
        for i, piece in enumerate(split_recursively(text or "", size)):
            yield i, at, piece
            at += len(piece)


@udtf(returnType="parent: string, node: string, kind: string, ordinal: int, object_id: string")
class ExplodeDocument:
    """Table function for SQL: the nodes of one extraction payload."""

    def eval(self, payload: str) -> Iterator[tuple]:
        from . import nested

        for row in nested.nodes_of(nested.parse(payload), False):
            yield row[:5]


def register(spark) -> None:
    """Makes the table functions available to SQL under split_text and explode_document."""
    spark.udtf.register("split_text", SplitText)
    spark.udtf.register("explode_document", ExplodeDocument)


def heading_of(text: Column) -> Column:
    return F.lower(collapse(F.regexp_replace(text, "^[\\d.\\s#]+|[.:\\-\\s]+$", "")))
