"""Retrieval chunks: offsets, packing into character chunks, recursive splitting, ids, validation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import identity
from . import structure

# The default action per role, and the sizes of the character chunks.
ACTIONS = {
    "body": "embed", "abstract": "embed", "list": "embed", "reference": "embed", "metadata": "embed", "table": "payload", "figure": "payload", "chart": "payload", "equation": "payload",
    "code": "payload", "title": "placeholder", "aside": "exclude", "other": "exclude",
}
TARGET, MOST, LEAST = 2400, 3600, 300
SEPARATORS = ("\n\n", "\n", ". ", " ", "")


def units(blocks: DataFrame) -> DataFrame:
    """Blocks with text in reading order and the section they belong to; positions are dense among them."""
    return structure.reading_order(blocks.where("length(text) > 0"), "section_id", "role", "text").withColumn("section", F.coalesce("section_id", F.concat(F.col("document_id"), F.lit(":none"))))


def section_offsets(blocks: DataFrame) -> DataFrame:
    """Where each block stands in its section's text, units parted by two characters."""
    w = Window.partitionBy("section").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.length("text") + 2).over(w) - 2
    return units(blocks).withColumn("end_offset", end.cast("long")).withColumn("start_offset", (F.col("end_offset") - F.length("text")).cast("long"))


def unit_overlap(blocks: DataFrame, size: int) -> DataFrame:
    """Which blocks stand in which fixed-size window of their section.

    The interval join has one bucket a window, so it is an explode: each block
    lists the windows it reaches into.
    """
    o = section_offsets(blocks)
    first, last = F.floor(F.col("start_offset") / size), F.floor((F.col("end_offset") - 1) / size)
    return o.select("section", F.explode(F.transform(F.sequence(first, last), lambda x: x.cast("int"))).alias("chunk"), "block_id")


def with_actions(blocks: DataFrame, actions: dict[str, str] | None = None) -> DataFrame:
    """Adds the policy's action per role; roles that it does not name are left out of chunks."""
    return blocks.withColumn("action", F.coalesce(structure._lookup(F.col("role"), actions or ACTIONS), F.lit("exclude")))


def chunk_id(document: Column, policy: Column, index: Column, text: Column) -> Column:
    return identity.uuid5(document, F.concat(F.lit("chunk:"), policy, F.lit(":"), index.cast("string"), F.lit(":"), F.sha2(text, 256)))


def chars_of(members: list[tuple[str, int]]) -> int:
    """Length of a chunk's text: its units, parted by two characters."""
    return sum(n for _, n in members) + 2 * max(0, len(members) - 1)


def pack_units(rows: list[tuple[str, int]], target: int = TARGET, most: int = MOST, least: int = LEAST) -> list[list[str]]:
    """Members of the chunks of one section, from its units ``(id, length)`` in order.

    A unit joins the open chunk; that closes when its units reach ``target``, or
    before a unit that would take it beyond ``most``. The last unit of a chunk
    always opens the next one again. A last chunk below ``least`` joins the one
    before, each unit once.
    """
    chunks: list[list[tuple[str, int]]] = []
    held: list[tuple[str, int]] = []
    for unit in rows:
        if held and sum(n for _, n in held) + unit[1] > most:
            chunks.append(held)
            held = held[-1:]
        held = [*held, unit]
        if sum(n for _, n in held) >= target:
            chunks.append(held)
            held = held[-1:]
    if held:
        chunks.append(held)
    if len(chunks) > 1 and chars_of(chunks[-1]) < least:
        tail = chunks.pop()
        chunks[-1] = list(dict.fromkeys(chunks[-1] + tail))
    return [[b for b, _ in c] for c in chunks]


def _streamed(make: Callable, names: list[str]):
    """Runs ``make`` over the groups of partitions sorted by section and position; one section is held at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = None, []
        for pdf in batches:
            out: list[tuple] = []
            for row in pdf.itertuples(index=False):
                if row.section != held:
                    if rows:
                        out += make(held, rows)
                    held, rows = row.section, []
                rows.append(row)
            yield pd.DataFrame(out, columns=names)
        if rows:
            yield pd.DataFrame(make(held, rows), columns=names)

    return run


def char_chunks(blocks: DataFrame) -> DataFrame:
    """``document_id, section, chunk, ordinal, block_id, role, chars``: the blocks of each character chunk in order.

    Only lengths are shuffled. Sections that hold nothing but titles give no chunks.
    """
    u = with_actions(units(blocks)).where("action in ('embed', 'placeholder')").select("document_id", "section", "position", "block_id", "role", F.length("text").alias("chars"))

    def make(section, rows):
        if all(r.role == "title" for r in rows):
            return []
        by = {r.block_id: r for r in rows}
        return [(by[b].document_id, section, k, i, b, by[b].role, by[b].chars) for k, c in enumerate(pack_units([(r.block_id, r.chars) for r in rows])) for i, b in enumerate(c)]

    names = ["document_id", "section", "chunk", "ordinal", "block_id", "role", "chars"]
    return u.repartition("section").sortWithinPartitions("section", "position").mapInPandas(_streamed(make, names), "document_id string, section string, chunk int, ordinal int, block_id string, role string, chars int")


def split_recursively(text: str, size: int, length: Callable[[str], int] = len, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Pieces of at most ``size`` by the first separator that helps, finer ones for pieces that stay too long; nothing is lost."""
    if length(text) <= size or not separators:
        return [text]
    sep = separators[0]
    if sep == "":
        out, rest = [], text
        while rest:  # the longest prefix within the size, a character at least; no length counts less for more
            low, high = 1, min(len(rest), size) if length is len else len(rest)
            while low < high:
                half = (low + high + 1) // 2
                low, high = (half, high) if length(rest[:half]) <= size else (low, half - 1)
            out.append(rest[:low])
            rest = rest[low:]
        return out
    parts = text.split(sep)
    parts = [p + sep for p in parts[:-1]] + parts[-1:]
    out: list[str] = []
    held = ""
    for part in (p for p in parts if p):
        if length(held) + length(part) <= size:
            held += part
            continue
        if held:
            out.append(held)
        held = ""
        if length(part) > size:
            finer = split_recursively(part, size, length, separators[1:])
            out += finer[:-1]
            held = finer[-1]
        else:
            held = part
    return out + [held] if held else out


def split_with_overlap(text: str, size: int, overlap: int, length: Callable[[str], int] = len) -> list[str]:
    """Chunks of consecutive pieces of at most ``size`` together, each beginning with the last pieces of the one before that
    have at most ``overlap`` together and leave room for the next piece.

    Pieces are what the separators give, so a chunk begins and ends at one; the length of a chunk is held to be the sum of its pieces'.
    """
    pieces = [p for p in split_recursively(text, max(1, min(size, max(overlap, size // 8))), length) if p]
    sized = [(p, length(p)) for p in pieces]
    out: list[str] = []
    held: list[tuple[str, int]] = []
    total = 0
    for piece in sized:
        if held and total + piece[1] > size:
            out.append("".join(p for p, _ in held))
            while held and (total > overlap or total + piece[1] > size):
                total -= held.pop(0)[1]
        held.append(piece)
        total += piece[1]
    return out + ["".join(p for p, _ in held)] if held else out


def recursive_chunks(blocks: DataFrame, size: int, overlap: int, length: Callable[[str], int] = len, policy: str = "recursive") -> DataFrame:
    """``document_id, section, chunk, text, length, chunk_id``: each section's text, units joined by blank lines, split at
    paragraphs, lines, sentences, words, and within words at last; ``length`` counts characters, or tokens of a public vocabulary."""
    u = with_actions(units(blocks)).where("action = 'embed'").select("document_id", "section", "position", "text")

    def make(section, rows):
        made = split_with_overlap("\n\n".join(r.text for r in rows), size, overlap, length)
        return [(rows[0].document_id, section, k, t, length(t)) for k, t in enumerate(made)]

    made = u.repartition("section").sortWithinPartitions("section", "position").mapInPandas(_streamed(make, ["document_id", "section", "chunk", "text", "length"]), "document_id string, section string, chunk int, text string, length int")
    return made.withColumn("chunk_id", chunk_id(F.col("document_id"), F.lit(policy), F.col("chunk"), F.col("text")))


BIOGRAPHY = ("dados biográficos", "biografia", "biographical")


def chunk_types(chunks: DataFrame, headings: DataFrame) -> DataFrame:
    """References if all blocks are references or more than the body and abstract ones, biography if the section's heading says so, else body.

    ``headings`` has ``section, heading``, one row a section at most.
    """
    n = lambda *roles: F.count_if(F.col("role").isin(*roles))
    g = chunks.groupBy("document_id", "section", "chunk").agg((F.sum("chars") + 2 * (F.count("*") - 1)).alias("chars"), n("reference").alias("r"), n("body", "abstract").alias("b"), F.count("*").alias("n"))
    text = F.lower(F.coalesce("heading", F.lit("")))
    biography = F.lit(False)
    for word in BIOGRAPHY:
        biography = biography | F.contains(text, F.lit(word))
    kind = F.when(F.col("r") == F.col("n"), "references").when(biography, "biography").when(F.col("r") > F.col("b"), "references").otherwise("body")
    return g.join(headings, "section", "left").select("document_id", "section", "chunk", "chars", kind.alias("type"))


def section_headings(blocks: DataFrame) -> DataFrame:
    """``section, heading``: the first title of each section of ``units``."""
    return units(blocks).where("role = 'title'").groupBy("section").agg(F.min_by("text", "position").alias("heading"))


def validation(blocks: DataFrame) -> DataFrame:
    """``check, n``: blocks of sections with chunks that stand in none, chunks above and below the sizes, repeated blocks that
    no overlap explains; sections that hold nothing but titles give no chunks on purpose."""
    made = char_chunks(blocks)
    want = with_actions(units(blocks)).where("action in ('embed', 'placeholder')").select("section", "block_id", "role")
    text = want.groupBy("section").agg(F.count_if(F.col("role") != "title").alias("n")).where("n > 0")
    missing = want.join(text, "section", "left_semi").join(made.select("block_id"), "block_id", "left_anti")
    sizes = made.groupBy("section", "chunk").agg((F.sum("chars") + 2 * (F.count("*") - 1)).alias("n"))
    repeated = made.groupBy("section", "block_id").agg(F.count("*").alias("n"), F.max("chunk").alias("last"), F.min("chunk").alias("first"))
    unexplained = repeated.where(F.col("n") != F.col("last") - F.col("first") + 1)
    one = lambda name, df, n: df.agg(F.coalesce(n, F.lit(0)).cast("long").alias("n")).select(F.lit(name).alias("check"), "n")
    return (
        one("missing", missing, F.count("*"))
        .unionByName(one("oversized", sizes, F.count_if(F.col("n") > MOST)))
        .unionByName(one("undersized", sizes, F.count_if(F.col("n") < LEAST)))
        .unionByName(one("unexplained_repeats", unexplained, F.count("*")))
    )


def summary(types: DataFrame) -> DataFrame:
    return types.groupBy("type").agg(F.count("*").alias("chunks"), F.avg("chars").alias("chars_mean"), F.min("chars").alias("chars_min"), F.max("chars").alias("chars_max"))


def review_sample(types: DataFrame, size: int, seed: str = "42") -> DataFrame:
    """``document_id, section, chunk, reason``: one chunk a document, the three shortest and the three longest of all, and a
    fill up to ``size`` in order of a seeded hash; each chunk once, the first reason counts."""
    key = F.concat_ws(":", "document_id", "section", F.col("chunk").cast("string"))
    t = types.withColumn("k", key).withColumn("h", F.sha2(F.concat(F.lit(seed), F.lit(":"), key), 256))
    each = t.groupBy("document_id").agg(F.min_by("k", "h").alias("k")).select("k", F.lit(0).alias("rank"), F.lit("document").alias("reason"))
    short = t.orderBy("chars", "k").limit(3).select("k", F.lit(1).alias("rank"), F.lit("shortest").alias("reason"))
    long = t.orderBy(F.desc("chars"), "k").limit(3).select("k", F.lit(2).alias("rank"), F.lit("longest").alias("reason"))
    fill = t.orderBy("h").limit(size).select("k", F.lit(3).alias("rank"), F.lit("random").alias("reason"))
    first = each.unionByName(short).unionByName(long).unionByName(fill).groupBy("k").agg(F.min(F.struct("rank", "reason")).alias("r"))
    picked = t.join(first, "k").select("document_id", "section", "chunk", "r.*", "h")
    chosen = picked.where("rank < 3")
    rest = picked.where("rank = 3").orderBy("h").limit(size)
    n = chosen.agg(F.count("*").alias("n"))
    w = Window.orderBy("h")  # of at most ``size`` rows
    rest = rest.withColumn("i", F.row_number().over(w)).join(F.broadcast(n), F.col("i") + F.col("n") <= size).drop("i", "n")
    return chosen.unionByName(rest).select("document_id", "section", "chunk", "reason")


def overlap_blocks(chunks: DataFrame) -> DataFrame:
    """Blocks of a chunk that an earlier chunk of the section already holds."""
    first = F.min("chunk").over(Window.partitionBy("section", "block_id"))
    return chunks.withColumn("__f", first).where("__f < chunk").select("section", "chunk", "block_id")
