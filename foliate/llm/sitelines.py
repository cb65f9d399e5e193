"""Problem 1: lines repeated across one site's documents.

Lines of a collection are nodes of a graph, consecutive lines are its edges,
both weighted by the number of documents they stand in. Nodes and edges of high
support are kept; the connected components of what is left are the collection's
boilerplate blocks, and every occurrence of their lines is deleted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import structure
from ..session import checkpointed, spread, written
from .lookalike import fold

MIN_LETTERS = 15
MIN_DOCUMENTS = 3
MIN_SHARE = 0.04
# Rows of one line that meet in one task of a join, at most; lines of more rows are dealt to salts.
SALT_ROWS = 1_000_000
# Nodes that are broadcast, at most; more are joined in a shuffle.
BROADCAST_NODES = 500_000


_LOWER = bytes((c if not 0x41 <= c <= 0xDE or not chr(c).isupper() else ord(chr(c).lower())) for c in range(256))
_NO_LETTER = bytes(c for c in range(256) if not chr(c).isalpha() and c != 10)
_TYPOGRAPHY = re.compile("[\u2013\u2014\u2018-\u201d\u2022\u2026\u2030]")
_DROP = re.compile(r"[^\w\n]+|[\d_]+")


def line_keys(text: str) -> list[bytes | None]:
    """One key per line: its letters in lower case and one form, nothing else; None below MIN_LETTERS.

    Nearly every text is Latin-1 up to a few typographic signs, for which
    bytes.translate does the whole work in one pass.
    """
    if not text.isascii():
        text = fold(text)
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        try:
            raw = _TYPOGRAPHY.sub("", text).encode("latin-1")
        except UnicodeEncodeError:
            return [_encoded(k) if len(k) >= MIN_LETTERS else None for k in _DROP.sub("", text.lower()).split("\n")]
    return [k if len(k) >= MIN_LETTERS else None for k in raw.translate(_LOWER, _NO_LETTER).split(b"\n")]


def _encoded(key: str) -> bytes:
    try:
        return key.encode("latin-1")
    except UnicodeEncodeError:
        return key.encode()


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, split = xxhash.xxh3_128_intdigest, (1 << 64)
    for batch in batches:
        keep, lines, at = [], [], [0]
        slugs, texts = batch.column("slug").to_pylist(), batch.column("text").to_pylist()
        for i, (slug, text) in enumerate(zip(slugs, texts)):
            if len(text) < MIN_LETTERS:
                continue
            n, head = len(lines), f"{slug}\n".encode()
            for k, key in enumerate(line_keys(text)):
                if key is not None:
                    lines.append((k, digest(head + key)))
            if len(lines) > n:
                keep.append(i)
                at.append(len(lines))
        item = pa.StructArray.from_arrays(
            [pa.array([x[0] for x in lines], pa.int32()), pa.array([x[1] // split - (1 << 63) for x in lines], pa.int64()), pa.array([x[1] % split - (1 << 63) for x in lines], pa.int64())],
            ["line_no", "h1", "h2"],
        )
        out = batch.select(["slug", "document_id", "block_id"]).take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([*out.columns, pa.ListArray.from_arrays(pa.array(at, pa.int32()), item)], ["slug", "document_id", "block_id", "lines"])


def keyed_lines(blocks: DataFrame) -> DataFrame:
    """``slug, document_id, block_id, line_no, h1, h2`` of every line that takes part.

    Keys are made in Arrow batches by bytes.translate, which took less than half
    of the time of the same work in JVM regular expressions.
    """
    rows = blocks.where("text is not null and block_id is not null and (role is null or role <> 'title')").select(F.coalesce("collection_slug", F.lit("\0")).alias("slug"), "document_id", "block_id", "text")
    kind = "slug string, document_id string, block_id string, lines array<struct<line_no:int,h1:long,h2:long>>"
    return spread(rows).mapInArrow(_keyed, kind).select("slug", "document_id", "block_id", F.inline("lines"))


def _components(pdf: pd.DataFrame) -> pd.DataFrame:
    """Union-find over one collection's nodes and edges."""
    parent: dict[tuple, tuple] = {}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in zip(pdf.h1, pdf.h2):
        parent.setdefault(a, a)
    for a, b in zip(zip(pdf.h1, pdf.h2), zip(pdf.g1, pdf.g2)):
        if b in parent:
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = pdf[["slug", "h1", "h2", "n_docs"]].drop_duplicates(["h1", "h2"])
    return nodes.assign(component=[root(k)[0] for k in zip(nodes.h1, nodes.h2)])


def site_line_occurrences(blocks: DataFrame, min_documents: int = MIN_DOCUMENTS, min_share: float = MIN_SHARE) -> DataFrame:
    """``slug, document_id, block_id, line_no, component, n_docs`` of every line to remove.

    Support counts documents, so rows sent twice count once. A first pass counts
    occurrences per line with map-side combining, whatever the line's share of
    the rows, and leaves the lines of two or more documents; a second pass keeps
    the occurrences of those and counts their documents exactly. A collection's
    nodes number at most its lines per document divided by ``min_share``, so the
    union-find of one collection is bounded.

    What is deleted is every line of high support, in a block of several or
    alone; the components say which lines stand together.

    Null texts and title blocks do not take part; an empty table gives an empty
    result; thresholds are inclusive. Rows with one ``block_id`` sent twice give
    one row per line.
    """
    slug = F.coalesce("collection_slug", F.lit("\0")).alias("slug")
    docs = blocks.select(slug, "document_id").distinct().groupBy("slug").agg(F.count("document_id").alias("n_collection"))
    # the texts go through Python once; their keys are written and read where they are needed
    spark = blocks.sparkSession
    lines = spark.read.parquet(written(keyed_lines(blocks), "lines"))
    d = F.xxhash64("document_id")
    often = checkpointed(lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(d).alias("a"), F.max(d).alias("b")).where(f"n >= {int(min_documents)} and a <> b").select("h1", "h2", F.ceil(F.col("n") / SALT_ROWS).cast("int").alias("salts")))
    # lines of so many rows number at most all rows / SALT_ROWS, which bounds what is broadcast
    hot = often.where("salts > 1")
    salted = lines.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("block_id", "line_no"), F.col("salts")), F.lit(0)).cast("int")).drop("salts")
    spread_often = often.select("h1", "h2", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    repeated = checkpointed(salted.join(spread_often, ["h1", "h2", "salt"]).drop("salt").dropDuplicates(["block_id", "line_no", "h1", "h2"]))
    support = repeated.groupBy("slug", "h1", "h2", "document_id").count().groupBy("slug", "h1", "h2").agg(F.count("document_id").alias("n_docs"))
    nodes = checkpointed(support.where(F.col("n_docs") >= min_documents).join(docs, "slug").where(F.col("n_docs") >= min_share * F.col("n_collection") - 1e-9))
    small = F.broadcast if nodes.count() <= BROADCAST_NODES else (lambda x: x)
    hits = repeated.join(small(nodes), ["slug", "h1", "h2"])
    # edges: line n and n + 1 of one block, by an equi-join, so that no block or collection is gathered
    nxt = hits.select("block_id", (F.col("line_no") - 1).alias("line_no"), F.col("h1").alias("g1"), F.col("h2").alias("g2"))
    edges = (
        hits.join(nxt, ["block_id", "line_no"])
        .groupBy("slug", "h1", "h2", "g1", "g2", "n_collection", "document_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("slug", "h1", "h2", "g1", "g2", "n_collection")
        .agg(F.count("document_id").alias("w"))
        .where((F.col("w") >= min_documents) & (F.col("w") >= min_share * F.col("n_collection") - 1e-9))
        .select("slug", "h1", "h2", "g1", "g2")
    )
    # a node without an edge is its own neighbour: a null would turn the hashes into floating-point numbers in pandas
    graph = nodes.join(edges, ["slug", "h1", "h2"], "left").select("slug", "h1", "h2", "n_docs", F.coalesce("g1", "h1").alias("g1"), F.when(F.col("g1").isNull(), F.col("h2")).otherwise(F.col("g2")).alias("g2"))
    parts = graph.groupBy("slug").applyInPandas(_components, "slug string, h1 long, h2 long, n_docs long, component long")
    return hits.drop("n_docs", "n_collection").join(small(parts), ["slug", "h1", "h2"]).select("slug", "document_id", "block_id", "line_no", "component", "n_docs")


def found(blocks: DataFrame) -> DataFrame:
    return site_line_occurrences(blocks).select("block_id", F.col("line_no").cast("int").alias("line_no")).distinct()


def without_site_lines(blocks: DataFrame) -> DataFrame:
    """``block_id, text, removed``: every distinct block's text without its collection's site lines."""
    drop = site_line_occurrences(blocks).groupBy("block_id").agg(F.collect_set("line_no").alias("gone"))
    one = structure.distinct_blocks(blocks, "text")
    kept = F.expr("array_join(transform(filter(transform(split(text, '\n'), (x, i) -> struct(x, i)), s -> not array_contains(gone, s.i)), s -> s.x), '\n')")
    return one.join(drop, "block_id", "left").select("block_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("removed"))
