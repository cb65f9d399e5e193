"""Bibliographic fields of documents: title, authors, citation, DOI, year, abstracts and keywords, each with source and confidence.

A human decision goes before what the inventory states, that before what the
front matter shows. Everything is keyed by document: one shuffle of blocks, then
conditional aggregates and windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from . import structure

# Headings, keyword prefixes with their language, and the words that end or rule out a name.
ABSTRACT_LANGUAGE = {"abstract": "en", "resumen": "es", "resumo": "pt"}
KEYWORD_LANGUAGE = {"keywords": "en", "palabras clave": "es", "palavras-chave": "pt", "palavras chave": "pt"}
SECTION_STARTS = ("introducao", "introduction", "introduccion")
REFERENCE_TITLES = ("referencias", "references")
NAME_STOP = r"\b(?:doutor(?:a|ando|anda)?|mestre|mestrando|mestranda|p[oó]s[- ]graduando|p[oó]s[- ]graduanda|graduando|graduanda|instituicao|universidade|faculdade|endereco|e-?mail|orcid)\b"
NAME_REJECT = ("approved", "brazilian", "curitiba", "doi", "issn", "journal", "recebido", "regras", "revista", "submitted", "versao", "volume")
NAME_CONNECTORS = ("da", "das", "de", "do", "dos", "e")
# Sources in order of precedence with their confidence.
CONFIDENCE = {"override": 1.0, "explicit": 0.95, "front_matter_title": 0.9, "abstract_heading": 0.9, "doi": 0.85, "abstract_role": 0.8, "first_title": 0.7, "front_matter_authors": 0.6}
FRONT_PAGES = 1
# The blocks of running text that may hold names.
NAME_TYPES = ("index", "list", "paragraph", "text", "author", "authors")


def person_name(value: Column) -> Column:
    """The personal name a text is, cut before titles of office and institutions; null if it is none.

    Two to eight words, at least two of them besides connectors, each of these
    of letters (and ' - .) with a capital first; no digits, colons, addresses, and none of the rejected words.
    """
    trim = lambda c: F.regexp_replace(c, r"^[ ,;|-]+|[ ,;|-]+$", "")
    c = trim(F.regexp_replace(trim(text.strip_tags(value)), f"(?iu){NAME_STOP}.*$", ""))
    tokens = F.split(c, " ")
    plain = F.transform(tokens, lambda t: text.without_accents(F.lower(t)))
    real = F.filter(tokens, lambda t: ~text.without_accents(F.lower(t)).isin(*NAME_CONNECTORS))
    sound = F.forall(real, lambda t: t.rlike(r"^\p{Lu}[\p{L}'.-]*$")) & (F.size(real) >= 2) & F.size(tokens).between(2, 8)
    return F.when(sound & ~c.rlike(r"[:@\d]") & ~F.arrays_overlap(plain, F.array(*map(F.lit, NAME_REJECT))), c)


def names_of(blocks: DataFrame) -> DataFrame:
    """``block_id, name``: distinct names among the parts of each text, parted by semicolons or line ends."""
    b = structure.distinct_blocks(blocks, "text").where("text is not null")
    parts = b.select("block_id", F.explode(F.split("text", "[;\n]")).alias("part"))
    return parts.select("block_id", person_name(F.col("part")).alias("name")).where("name is not null").distinct()


def _ordered(blocks: DataFrame) -> DataFrame:
    o = structure.reading_order(blocks, "page", "role", "source_type", "text").where("document_id is not null and text is not null")
    is_title = F.col("role") == "title"
    return o.withColumn("heading", text.plain_heading(F.when(is_title, F.col("text")))).withColumn("front", F.coalesce(F.col("page"), F.lit(0)) <= FRONT_PAGES)


def front_matter(ordered: DataFrame) -> DataFrame:
    """``document_id, begins, ends``: the positions of the first title on the first pages that is no heading of a section, and of the first heading or abstract after which no author stands."""
    title = (F.col("role") == "title") & F.col("front")
    starts = F.col("heading").isin(*ABSTRACT_LANGUAGE, *SECTION_STARTS)
    g = ordered.groupBy("document_id").agg(
        F.min(F.when(title & ~starts, F.col("position"))).alias("begins"), F.min(F.when(title & starts, F.col("position"))).alias("h"),
        F.array_sort(F.collect_set(F.when((F.col("role") == "abstract") & F.col("front"), F.col("position")))).alias("a"),
    )
    after = F.get(F.filter("a", lambda x: x > F.col("begins")), F.lit(0))
    return g.select("document_id", "begins", F.coalesce(F.least("h", after), F.lit(2**31 - 1)).alias("ends"))


def front_authors(ordered: DataFrame) -> DataFrame:
    """``document_id, names``: distinct names of the front matter in their order; a document's first two pages bound them."""
    lines = ordered.where(F.col("front") & F.col("source_type").isin(*NAME_TYPES) & (F.col("role") != "title"))
    inside = lines.join(front_matter(ordered), "document_id").where("position > begins and position < ends")
    parts = inside.select("document_id", "position", F.posexplode(F.split("text", "[;\n]")).alias("k", "part")).withColumn("name", person_name(F.col("part"))).where("name is not null")
    first = parts.groupBy("document_id", text.without_accents(F.lower("name")).alias("key")).agg(F.min(F.struct("position", "k", "name")).alias("n"))
    return first.groupBy("document_id").agg(F.transform(F.array_sort(F.collect_list("n")), lambda x: x["name"]).alias("names"))


def titles(ordered: DataFrame) -> DataFrame:
    """``document_id, front_title, first_title``: the first real title of the first pages, one of the first page before others, and the first title at all."""
    real = ~F.col("heading").isin(*ABSTRACT_LANGUAGE, *SECTION_STARTS, *REFERENCE_TITLES) & F.col("front") & (F.col("heading") != "")
    page = F.coalesce(F.col("page"), F.lit(0))
    return ordered.where("role = 'title'").groupBy("document_id").agg(
        F.min_by(F.when(real, text.strip_tags(F.col("text"))), F.when(real, F.struct((page > 0).alias("a"), "position"))).alias("front_title"), F.min_by(text.strip_tags(F.col("text")), "position").alias("first_title")
    )


def normal_path(c: Column) -> Column:
    """Slashes forward, none at the ends."""
    return F.regexp_replace(F.translate(c, "\\", "/"), "^/+|/+$", "")


def resolved_overrides(inventory: DataFrame, overrides: DataFrame) -> DataFrame:
    """``document_id`` with the fields of its override, found by normalised path; of several rows of a path the first in order of its fields counts."""
    fields = ["source", *[c for c in overrides.columns if c not in ("path", "source")]]
    o = overrides.select(normal_path(F.col("path")).alias("p"), F.struct(*fields).alias("o")).groupBy("p").agg(F.min("o").alias("o"))
    i = inventory.where("document_id is not null").select("document_id", normal_path(F.col("relative_path")).alias("p")).distinct()
    return i.join(o, "p").groupBy("document_id").agg(F.min_by("o", "p").alias("o")).select("document_id", "o.*")


def bibliography(blocks: DataFrame, inventory: DataFrame, overrides: DataFrame) -> DataFrame:
    """One row per document of the inventory with title, authors, citation, DOI, year, their sources and confidences, and the state of review.

    ``overrides`` has ``path, source, authors, corporate`` (arrays). Review is
    missing without authors, inferred when one is taken from the front matter, and null when a human or the inventory named them.
    """
    o = _ordered(blocks)
    newest = F.struct(F.try_to_timestamp(F.col("modified_at")), "revision_id")
    filled = lambda c: F.when(F.trim(c) != "", text.strip_tags(F.col(c)))
    stated = inventory.where("document_id is not null").groupBy("document_id").agg(F.max_by(filled("title"), F.when(F.trim("title") != "", newest)).alias("t"), F.max_by(filled("author"), F.when(F.trim("author") != "", newest)).alias("a"))
    found = o.groupBy("document_id").agg(F.min_by(text.doi(F.col("text")), F.when(text.doi(F.col("text")).isNotNull(), F.col("position"))).alias("doi"))
    j = stated.join(titles(o), "document_id", "left").join(front_authors(o), "document_id", "left").join(found, "document_id", "left").join(years(o), "document_id", "left")
    j = j.join(resolved_overrides(inventory, overrides), "document_id", "left")
    human = F.col("source").isNotNull()
    authors = F.when(human, F.coalesce("authors", F.array().cast("array<string>"))).when(F.col("a").isNotNull(), F.array("a")).otherwise(F.coalesce("names", F.array().cast("array<string>")))
    source = F.when(human, "override").when(F.col("a").isNotNull(), "explicit").when(F.col("names").isNotNull(), "front_matter")
    c = CONFIDENCE
    return j.withColumn("who", authors).select(
        "document_id", F.coalesce("t", "front_title", "first_title").alias("title"),
        F.when(F.col("t").isNotNull(), c["explicit"]).when(F.col("front_title").isNotNull(), c["front_matter_title"]).when(F.col("first_title").isNotNull(), c["first_title"]).alias("title_confidence"),
        F.array_join("who", "; ").alias("authors"), source.alias("author_source"), F.when(human, c["override"]).when(F.col("a").isNotNull(), c["explicit"]).when(F.col("names").isNotNull(), c["front_matter_authors"]).alias("author_confidence"),
        text.citation_author(F.transform("who", text.family_name), F.get("corporate", F.lit(0))).alias("citation"),
        "doi", F.when(F.col("doi").isNotNull(), c["doi"]).alias("doi_confidence"), F.col("year").cast("int").alias("year"), "year_confidence",
        F.when(human, F.lit(None)).when(F.size("who") == 0, "missing").when(F.col("a").isNull(), "inferred").alias("review"),
    )


def years(ordered: DataFrame) -> DataFrame:
    """``document_id, year, year_confidence``: the year named most often, the first seen of equals."""
    y = ordered.select("document_id", "position", F.posexplode(text.years(F.col("text"))).alias("k", "y"))
    g = y.groupBy("document_id", "y").agg(F.count("*").alias("n"), F.min(F.struct("position", "k")).alias("seen"))
    best = g.groupBy("document_id").agg(F.min_by(F.struct(F.col("y").alias("year"), "n"), F.struct((-F.col("n")).alias("m"), "seen")).alias("b"))
    return best.select("document_id", "b.year", F.least(F.lit(0.8), F.round(F.lit(0.5) + F.lit(0.1) * (F.col("b.n") - 1).cast("double"), 6)).alias("year_confidence"))


def abstracts(blocks: DataFrame) -> DataFrame:
    """``document_id, lang, abstract, keywords, confidence``: abstracts by language.

    A heading of a language opens its region; the next title or a line of
    keywords closes it. Of two regions of one language the first counts. Keywords
    stand with the language of their prefix. A document without such regions has
    its first abstract block under the language und.
    """
    o = _ordered(blocks)
    w = Window.partitionBy("document_id").orderBy("position")
    language = _lookup(F.col("heading"), ABSTRACT_LANGUAGE)
    plain = text.strip_tags(F.col("text"))
    prefix = _keyword_language(plain)
    title = F.col("role") == "title"
    # the region a block stands in: the last title's, if that is a heading of a language and no keywords stand between
    marked = o.withColumn("lang", F.last(F.when(title, F.struct(language.alias("l"), F.col("position").alias("p"))), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("keys", prefix)
    inside = marked.where(~title & F.col("lang.l").isNotNull())
    shut = F.min(F.when(F.col("keys").isNotNull(), F.col("position"))).over(Window.partitionBy("document_id", "lang.p"))
    region = inside.withColumn("shut", shut).where("shut is null or position <= shut")
    body = region.where((F.col("position") < F.coalesce("shut", F.lit(2**31 - 1))) & F.col("role").isin("body", "abstract", "list") & (plain != ""))
    parts = body.groupBy("document_id", F.col("lang.l").alias("lang"), F.col("lang.p").alias("p")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", plain.alias("t")))), lambda x: x["t"]), " ").alias("abstract"))
    texts = parts.groupBy("document_id", "lang").agg(F.min_by("abstract", "p").alias("abstract"))
    words = region.where("keys is not null").groupBy("document_id", F.col("keys").alias("lang")).agg(F.max_by(F.array_join(text.keywords(plain), "|"), "position").alias("keywords"))
    both = texts.join(words, ["document_id", "lang"], "full").withColumn("confidence", F.when(F.col("abstract").isNotNull(), CONFIDENCE["abstract_heading"]))
    und = o.where((F.col("role") == "abstract") & (plain != "")).groupBy("document_id").agg(F.min_by(plain, "position").alias("abstract")).join(texts.select("document_id").distinct(), "document_id", "left_anti")
    return both.unionByName(und.select("document_id", F.lit("und").alias("lang"), "abstract", F.lit(None).cast("string").alias("keywords"), F.lit(CONFIDENCE["abstract_role"]).alias("confidence")))


def _lookup(c: Column, mapping: dict[str, str]) -> Column:
    return structure._lookup(c, mapping)


def _keyword_language(plain: Column) -> Column:
    out = None
    for prefix, language in KEYWORD_LANGUAGE.items():
        hit = F.startswith(text.without_accents(F.lower(plain)), F.lit(prefix))
        out = (F if out is None else out).when(hit, language)
    return out
