"""Document structure over block tables: order, sections, regions, lists, roles, assets, profiles.

All of it is keyed by document, so one shuffle by document serves the windows
that follow each other. Rows sent twice are dropped by block id, the copy loaded
last wins. Null reading orders come first; ties go by block id.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Roles by block type and by content-list type, and block types outside the primary flow.
ROLE_BY_TYPE = {
    "abstract": "abstract", "algorithm": "code", "aside_text": "aside", "author": "metadata", "authors": "metadata", "chart": "chart", "code": "code", "date": "metadata", "doi": "metadata",
    "image": "figure", "index": "list", "interline_equation": "equation", "list": "list", "page_footnote": "aside", "ref_text": "reference", "table": "table", "text": "body", "title": "title",
}
ROLE_BY_CONTENT_TYPE = {
    "algorithm": "code", "chart": "chart", "code": "code", "equation_interline": "equation", "image": "figure", "index": "list", "list": "list", "page_aside_text": "aside",
    "page_footnote": "aside", "paragraph": "body", "table": "table", "title": "title",
}
FURNITURE = ("header", "footer", "page_number")
ASSET_KIND_BY_ROLE = {"figure": "figure", "chart": "chart", "table": "table", "equation": "equation", "code": "code"}
REFERENCE_HEADINGS = ("references", "referencias", "referencias bibliograficas", "bibliography", "bibliografia")
ABSTRACT_HEADINGS = ("abstract", "resumo", "resumen")
MAX_LEVEL = 6


def in_order() -> tuple[Column, Column]:
    return F.col("reading_order").asc_nulls_first(), F.col("block_id")


def distinct_blocks(blocks: DataFrame, *columns: str) -> DataFrame:
    """One row per block id, the copy loaded last, with the given columns or all; ties, and all copies of a table without ``loaded_at``, go by content.

    Only the columns asked for reach the scan and the shuffle; rows are combined before it.
    """
    rest = list(columns) or [c for c in blocks.columns if c != "block_id"]
    order = (["loaded_at"] if "loaded_at" in blocks.columns else []) + [F.xxhash64(*rest)]
    latest = F.max_by(F.struct(*rest), F.struct(*order)).alias("r")
    return blocks.where("block_id is not null").groupBy("block_id").agg(latest).select("block_id", "r.*")


def _lookup(c: Column, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F if out is None else out).when(c == k, v)
    return out


def role(block_type: Column, item_type: Column | None = None, compatible: Column | None = None) -> Column:
    """A compatible second reading's type decides, else the block's own, else other."""
    own = _lookup(block_type, ROLE_BY_TYPE)
    if item_type is None:
        return F.coalesce(own, F.lit("other"))
    return F.coalesce(F.when(compatible, _lookup(item_type, ROLE_BY_CONTENT_TYPE)), own, F.lit("other"))


def reading_order(blocks: DataFrame, *columns: str) -> DataFrame:
    """Distinct blocks with their ``position`` in the document, and the given columns or all."""
    w = Window.partitionBy("document_id").orderBy(*in_order())
    wanted = [*dict.fromkeys(["document_id", "reading_order", *columns])] if columns else []
    return distinct_blocks(blocks, *wanted).withColumn("position", F.row_number().over(w) - 1)


def merged_order(df: DataFrame, group: list[str], physical: str, ordinal: str) -> DataFrame:
    """Adds ``merged``: matched rows by their ordinal, each unmatched row just before the next matched row that
    physically follows it, trailing ones at the end; groups without matches keep the physical order."""
    g = Window.partitionBy(*group)
    rank = F.when(F.col(ordinal).isNotNull(), F.row_number().over(g.orderBy(F.col(ordinal).asc_nulls_last(), physical)))
    ranked = df.withColumn("__rank", rank)
    anchor = F.first("__rank", ignorenulls=True).over(g.orderBy(physical).rowsBetween(0, Window.unboundedFollowing))
    placed = ranked.withColumn("__anchor", anchor)
    return placed.withColumn("merged", F.row_number().over(g.orderBy(F.col("__anchor").asc_nulls_last(), F.col("__rank").isNotNull(), physical)) - 1).drop("__rank", "__anchor")


def title_levels(blocks: DataFrame, *columns: str, texts: bool = False) -> DataFrame:
    """Blocks in order with ``level`` for titles: the first of a document 1, numbered ones by the depth of their number plus one, others 2.

    Texts of other blocks are dropped before the shuffle unless they are asked for.
    """
    b = blocks if texts else blocks.withColumn("text", F.when(F.col("role") == "title", F.col("text")))
    o = reading_order(b, "role", "text", *columns)
    first = F.row_number().over(Window.partitionBy("document_id", F.col("role") == "title").orderBy("position"))
    number = F.regexp_extract("text", "^(\\d+(?:\\.\\d+)*)\\.?\\s", 1)
    level = F.when(first == 1, 1).when(number != "", F.least(F.lit(MAX_LEVEL), F.size(F.split(number, "\\.")) + 1)).otherwise(2)
    return o.withColumn("level", F.when(F.col("role") == "title", level).cast("int"))


def sections(blocks: DataFrame, *columns: str, texts: bool = False) -> DataFrame:
    """Every block with ``section`` (the last title at or before it, null before the first), and titles with ``parent``.

    A title's parent is the nearest earlier title of a smaller level: the latest
    of the last titles of each smaller level, which takes one window over a
    bounded number of levels instead of a self-join.
    """
    w = Window.partitionBy("document_id").orderBy("position")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    t = title_levels(blocks, *columns, texts=texts).withColumn("section", F.last(F.when(F.col("level").isNotNull(), F.col("block_id")), ignorenulls=True).over(upto))
    lasts = [F.when(F.col("level") > k, F.last(F.when(F.col("level") == k, F.struct("position", "block_id")), ignorenulls=True).over(before)) for k in range(1, MAX_LEVEL)]
    return t.withColumn("parent", F.greatest(*lasts)["block_id"])


def heading_paths(blocks: DataFrame) -> DataFrame:
    """``document_id, section, path``: titles from the root to each section; levels fall along the way, so the joins are few and bounded."""
    s = sections(blocks).where("level is not null").select("document_id", "block_id", "parent", "text")
    out = s.select("document_id", F.col("block_id").alias("section"), F.col("parent").alias("up"), F.coalesce("text", F.lit("")).alias("path"))
    above = s.select("document_id", F.col("block_id").alias("up"), F.col("parent").alias("next"), F.coalesce("text", F.lit("")).alias("t"))
    for _ in range(MAX_LEVEL - 1):
        out = out.join(above, ["document_id", "up"], "left").select("document_id", "section", F.col("next").alias("up"), F.when(F.col("t").isNull(), F.col("path")).otherwise(F.concat_ws(" > ", "t", "path")).alias("path"))
    return out.select("document_id", "section", "path")


def list_groups(blocks: DataFrame) -> DataFrame:
    """Runs of list blocks within one section: gaps and islands."""
    w = Window.partitionBy("document_id").orderBy("position")
    s = sections(blocks)
    is_list = F.col("role") == "list"
    start = is_list & ~(F.coalesce(F.lag(is_list).over(w), F.lit(False)) & F.lag("section").over(w).eqNullSafe(F.col("section")))
    g = s.withColumn("g", F.sum(start.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where(is_list)
    return g.groupBy("document_id", "g").agg(F.min_by("block_id", "position").alias("first_block"), F.count("*").alias("n_blocks"), F.max("section").alias("section")).drop("g")


def _regions(pdf: pd.DataFrame) -> pd.DataFrame:
    """The fold of the region state over one document: a region opens at its heading and closes at the next title of its level or above."""
    pdf = pdf.sort_values("position")
    out, reference, abstract = [], None, None
    for role_, level, heading in zip(pdf.role, pdf.level, pdf.heading):
        if role_ == "title":
            level = int(level)
            if reference is not None and level <= reference:
                reference = None
            if abstract is not None and level <= abstract:
                abstract = None
            if heading in REFERENCE_HEADINGS:
                reference = level
            elif heading in ABSTRACT_HEADINGS:
                abstract = level
            out.append("title")
        else:
            out.append("reference" if reference is not None else "abstract" if abstract is not None else role_)
    return pdf.assign(final_role=out)[["document_id", "block_id", "position", "final_role"]]


def regions(blocks: DataFrame) -> DataFrame:
    """``document_id, block_id, position, final_role`` after reference and abstract regions; a document's blocks without texts are what a task holds."""
    from ..functions.text import plain_heading

    t = title_levels(blocks).withColumn("heading", plain_heading(F.when(F.col("role") == "title", F.col("text"))))
    return t.select("document_id", "block_id", "position", "role", "level", "heading").groupBy("document_id").applyInPandas(_regions, "document_id string, block_id string, position int, final_role string")


def assets(blocks: DataFrame) -> DataFrame:
    """One row per asset of each block with its kind; an asset listed twice counts once."""
    b = distinct_blocks(blocks.where(F.size("asset_ids") > 0), "document_id", "page", "role", "asset_ids").select("document_id", "block_id", "page", "role", F.explode(F.array_distinct("asset_ids")).alias("asset_id"))
    return b.withColumn("kind", F.coalesce(_lookup(F.col("role"), ASSET_KIND_BY_ROLE), F.lit("figure")))


def violations(blocks: DataFrame) -> DataFrame:
    """Structure checks, one row per violation: unknown role, wrong character count, section of another document, asset that repeats across blocks, missing document."""
    b = distinct_blocks(blocks.withColumn("n", F.length("text")), "document_id", "role", "char_count", "section_id", "page", "n")
    known = sorted(set(ROLE_BY_TYPE.values()) | {"other"})
    checks = F.array_compact(
        F.array(
            F.when(~F.col("role").isin(*known), "unknown_role"), F.when(F.coalesce("char_count", F.lit(-1)) != F.coalesce("n", F.lit(-1)), "char_count"), F.when(~F.startswith(F.col("section_id"), F.col("document_id")), "foreign_section"),
            F.when(F.col("document_id").isNull(), "no_document"), F.when(F.col("page").isNull(), "no_page"),
        )
    )
    return b.select("block_id", F.explode(checks).alias("violation"))


SECTION_STARTS = (*ABSTRACT_HEADINGS, "introducao", "introduction", "introduccion")


def front_matter(blocks: DataFrame) -> DataFrame:
    """``block_id, front_matter``: between the document's first title and its first section or abstract, on the first two pages. A title sets the flags before its own test and is no front matter itself."""
    from ..functions.text import plain_heading

    o = reading_order(blocks, "page", "role", "text").where("document_id is not null").withColumn("h", plain_heading(F.when(F.col("role") == "title", F.col("text"))))
    title, starts = F.col("role") == "title", F.col("h").isin(*SECTION_STARTS)
    upto = Window.partitionBy("document_id").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.max(F.coalesce(title & ~starts, F.lit(False))).over(upto)
    over = F.max(F.coalesce((title & starts) | (F.col("role") == "abstract"), F.lit(False))).over(upto)
    return o.select("block_id", F.coalesce(seen & ~over & ~title & (F.coalesce("page", F.lit(0)) <= 1), F.lit(False)).alias("front_matter"))


def summary(blocks: DataFrame) -> DataFrame:
    """``what, key, n``: sections and empty ones by level, roles, source types, and assets by kind."""
    s = sections(blocks, "source_type").select("block_id", "level", "section", "role", "source_type")
    titles = s.where("level is not null").select(F.col("block_id").alias("section"), "level")
    held = s.where("level is null and section is not null").groupBy("section").agg(F.count("*").alias("held"))
    n = titles.join(held, "section", "left")
    count = lambda df, what, key: df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "key", "n")
    out = count(n, "sections", "level").unionByName(count(n.where("held is null"), "empty_sections", "level"))
    return out.unionByName(count(s, "roles", "role")).unionByName(count(s, "source_types", "source_type")).unionByName(count(assets(blocks), "assets", "kind"))


def checks(blocks: DataFrame) -> DataFrame:
    """Per document the counts of its structure and ``failed``, which of its checks do not hold.

    Order is contiguous from 0, every block annotated once and only with a block
    of its own document, sections and parents are titles of the document and
    earlier, list groups are whole, furniture keeps its order outside the flow,
    and every asset of an asset block is registered.
    """
    s = sections(blocks, "source_type", "page", "asset_ids")
    w = Window.partitionBy("document_id").orderBy("position")
    is_list = F.col("role") == "list"
    begins = is_list & ~(F.coalesce(F.lag(is_list).over(w), F.lit(False)) & F.lag("section").over(w).eqNullSafe(F.col("section")))
    s = s.withColumn("begins", begins).withColumn("furniture", F.col("source_type").isin(*FURNITURE))
    per = s.groupBy("document_id").agg(
        F.count("*").alias("blocks"), F.countDistinct("page").alias("pages"), F.count_if("furniture").alias("furniture"), F.count("level").alias("sections"), F.count_if("begins").alias("list_groups"), F.sum(F.coalesce(F.size(F.array_distinct("asset_ids")), F.lit(0))).alias("assets"),
        F.countDistinct("block_id").alias("ids"), F.min("position").alias("first"), F.max("position").alias("last"), F.countDistinct("position").alias("places"), F.count_if(is_list).alias("in_lists"), F.count_if(F.col("parent").isNotNull() & F.col("level").isNull()).alias("loose"),
    )
    titles = s.where("level is not null").select("document_id", F.col("block_id").alias("t"), F.col("position").alias("p"))
    named = s.where("section is not null").select("document_id", F.col("section").alias("t"), "position").unionByName(s.where("parent is not null").select("document_id", F.col("parent").alias("t"), "position"))
    same = F.col("a.document_id").eqNullSafe(F.col("b.document_id")) & (F.col("a.t") == F.col("b.t"))
    lost = named.alias("a").join(titles.alias("b"), same, "left").where("b.p is null or b.p > a.position").groupBy(F.col("a.document_id").alias("d")).agg(F.count("*").alias("lost"))
    registered = assets(blocks).groupBy(F.col("document_id").alias("d")).agg(F.count("*").alias("registered"))
    j = per.join(lost, per["document_id"].eqNullSafe(lost["d"]), "left").drop("d").join(registered, per["document_id"].eqNullSafe(registered["d"]), "left").drop("d")
    bad = {
        "unique_blocks": F.col("ids") != F.col("blocks"), "contiguous_order": (F.col("first") != 0) | (F.col("last") + 1 != F.col("blocks")) | (F.col("places") != F.col("blocks")), "section_references": F.coalesce("lost", F.lit(0)) > 0,
        "parents_of_titles": F.col("loose") > 0, "list_groups": (F.col("list_groups") > F.col("in_lists")) | ((F.col("in_lists") > 0) & (F.col("list_groups") == 0)), "assets_registered": F.coalesce("registered", F.lit(0)) != F.col("assets"),
    }
    failed = F.array_join(F.array_compact(F.array(*[F.when(c, n) for n, c in bad.items()])), ",")
    return j.select("document_id", "blocks", "pages", "furniture", "sections", "list_groups", F.coalesce("assets", F.lit(0)).alias("assets"), failed.alias("failed"))
