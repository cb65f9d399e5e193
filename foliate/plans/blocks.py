"""Queries on the text blocks: profiles, structure, bibliography and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, tokenizer
from ..operators import bibliography, chunking, structure
from ..session import table
from .base import query

_B = """(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY block_id ORDER BY loaded_at DESC) AS rn FROM block_units WHERE block_id IS NOT NULL) WHERE rn = 1)"""
_O = f"(SELECT *, CAST(row_number() OVER (PARTITION BY document_id ORDER BY reading_order NULLS FIRST, block_id) - 1 AS INTEGER) AS position FROM {_B})"
_T = f"""(SELECT *, CASE WHEN role = 'title' THEN CASE WHEN row_number() OVER (PARTITION BY document_id, role = 'title' ORDER BY position) = 1 THEN 1
          WHEN regexp_matches(text, '^\\d+(\\.\\d+)*\\.?\\s') THEN least(6, len(string_split(regexp_extract(text, '^(\\d+(?:\\.\\d+)*)\\.?\\s', 1), '.')) + 1) ELSE 2 END END AS level FROM {_O})"""
_S = f"""(SELECT t.*, last_value(CASE WHEN level IS NOT NULL THEN block_id END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY position ROWS UNBOUNDED PRECEDING) AS section,
          (SELECT max_by(p.block_id, p.position) FROM titles p WHERE p.document_id = t.document_id AND p.position < t.position AND p.level < t.level) AS parent FROM t)"""
_WITH = f"WITH RECURSIVE t AS MATERIALIZED (SELECT * FROM {_T}), titles AS MATERIALIZED (SELECT document_id, block_id, position, level FROM t WHERE level IS NOT NULL), s AS MATERIALIZED (SELECT * FROM {_S})"


def _b(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "block_units")


def _one(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return structure.distinct_blocks(_b(spark, d), *columns)


def _sized(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Distinct blocks with ``chars``, the length of their text, in its place: texts are measured before the shuffle."""
    return structure.distinct_blocks(_b(spark, d).withColumn("chars", F.length("text")), *columns, "chars")


# ---- profiles -------------------------------------------------------------------------------


@query(f"SELECT CASE WHEN source_type IN ('header', 'footer', 'page_number') THEN 'discarded' ELSE 'content' END AS collection, source_type, count(*) AS n FROM {_B} GROUP BY 1, 2")
def block_type_counts(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "source_type").groupBy(F.when(F.col("source_type").isin(*structure.FURNITURE), "discarded").otherwise("content").alias("collection"), "source_type").agg(F.count("*").alias("n"))


_TYPES = ("text", "title", "ref_text", "list", "table", "image", "header", "page_number")


@query(f"SELECT document_id, {', '.join(f'CAST(sum(CASE WHEN source_type = {chr(39)}{t}{chr(39)} THEN 1 ELSE 0 END) AS BIGINT) AS {t}' for t in _TYPES)} FROM {_B} GROUP BY 1")
def block_type_pivot(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "document_id", "source_type").groupBy("document_id").pivot("source_type", list(_TYPES)).count().na.fill(0)


@query(f"""SELECT document_id, count(DISTINCT page) AS pages, count(*) AS blocks, CAST(sum(length(text)) AS BIGINT) AS chars, min(page) AS first_page, max(page) AS last_page, min(length(text)) AS shortest, max(length(text)) AS longest,
    min(reading_order) AS first_order, max(reading_order) AS last_order FROM {_B} GROUP BY 1""")
def page_summary(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("chars")
    return _sized(spark, d, "document_id", "page", "reading_order").groupBy("document_id").agg(
        F.countDistinct("page").alias("pages"), F.count("*").alias("blocks"), F.sum(n).cast("long").alias("chars"), F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.min(n).cast("long").alias("shortest"), F.max(n).cast("long").alias("longest"),
        F.min("reading_order").alias("first_order"), F.max("reading_order").alias("last_order"),
    )


@query(f"""WITH l AS (SELECT document_id, page, block_id, source_type, len(string_split(text, chr(10))) AS n FROM {_B} WHERE text IS NOT NULL), k AS (SELECT DISTINCT document_id, page, block_id, source_type FROM l WHERE n > 1)
    SELECT l.document_id, l.page, l.block_id, l.source_type, l.n AS n_lines FROM l JOIN k ON l.document_id = k.document_id AND l.page = k.page AND l.block_id = k.block_id AND l.source_type = k.source_type""")
def multi_line_detail(spark: SparkSession, d: str) -> DataFrame:
    keys = ["document_id", "page", "block_id", "source_type"]
    return _one(spark, d, "document_id", "page", "source_type", "text").where("text is not null").select(*keys, F.size(F.split("text", "\n")).cast("long").alias("n_lines")).where("n_lines > 1").na.drop(subset=keys)


@query(f"SELECT page, level, count(*) AS n FROM {_T} WHERE level IS NOT NULL GROUP BY 1, 2")
def title_level_counts(spark: SparkSession, d: str) -> DataFrame:
    return structure.title_levels(_b(spark, d), "page").where("level is not null").groupBy("page", F.col("level").cast("long").alias("level")).agg(F.count("*").alias("n"))


@query(f"SELECT role, count(*) AS n, CAST(sum(CASE WHEN length(text) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS filled, CAST(sum(CASE WHEN coalesce(length(text), 0) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS blank, median(length(text)) AS chars_median, quantile_cont(length(text), 0.95) AS chars_p95 FROM {_B} GROUP BY 1")
def role_summary(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("chars")
    return _sized(spark, d, "role").groupBy("role").agg(F.count("*").alias("n"), F.count_if(n > 0).alias("filled"), F.count_if(F.coalesce(n, F.lit(0)) == 0).alias("blank"), F.median(n).alias("chars_median"), F.percentile(n, 0.95).alias("chars_p95"))


@query(f"SELECT block_id, source_type, role FROM {_B} WHERE source_type IN ('header', 'footer', 'page_number') AND role NOT IN ('other', 'aside')")
def noise_leak(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "source_type", "role").where(F.col("source_type").isin(*structure.FURNITURE) & ~F.col("role").isin("other", "aside")).select("block_id", "source_type", "role")


_RULES = (("no_text", "text IS NULL"), ("blank_text", "trim(text) = ''"), ("no_page", "page IS NULL"), ("no_section", "section_id IS NULL"), ("no_type", "source_type IS NULL"), ("wrong_count", "coalesce(char_count, -1) <> length(text)"))


@query(" UNION ALL ".join(f"SELECT document_id, block_id, '{n}' AS anomaly FROM {_B} WHERE {r}" for n, r in _RULES))
def anomalies(spark: SparkSession, d: str) -> DataFrame:
    labels = F.array_compact(F.array(*[F.when(F.expr(r.replace("text IS NULL", "chars IS NULL").replace("trim(text) = ''", "blank").replace("length(text)", "chars")), n) for n, r in _RULES]))
    measured = _b(spark, d).withColumn("chars", F.length("text")).withColumn("blank", F.trim("text") == "")
    return structure.distinct_blocks(measured, "document_id", "chars", "blank", "page", "section_id", "source_type", "char_count").select("document_id", "block_id", F.explode(labels).alias("anomaly"))


@query("SELECT anomaly, count(*) AS n, count(DISTINCT document_id) AS documents FROM (" + " UNION ALL ".join(f"SELECT document_id, block_id, '{n}' AS anomaly FROM {_B} WHERE {r}" for n, r in _RULES) + ") GROUP BY 1")
def anomaly_summary(spark: SparkSession, d: str) -> DataFrame:
    return anomalies(spark, d).groupBy("anomaly").agg(F.count("*").alias("n"), F.countDistinct("document_id").alias("documents"))


@query(f"""
    WITH b AS (SELECT document_id, count(*) AS blocks FROM {_B} GROUP BY 1), t AS (SELECT document_id, count(*) AS titles FROM {_B} WHERE role = 'title' GROUP BY 1), r AS (SELECT document_id, count(*) AS reference_blocks FROM {_B} WHERE role = 'reference' GROUP BY 1)
    SELECT i.document_id, coalesce(blocks, 0) AS blocks, coalesce(titles, 0) AS titles, coalesce(reference_blocks, 0) AS reference_blocks
    FROM (SELECT DISTINCT document_id FROM inventory) i LEFT JOIN b USING (document_id) LEFT JOIN t USING (document_id) LEFT JOIN r USING (document_id)""")
def document_summary(spark: SparkSession, d: str) -> DataFrame:
    """Left chain over one conditional aggregation instead of three joins."""
    per = _one(spark, d, "document_id", "role").groupBy("document_id").agg(F.count("*").alias("blocks"), F.count_if(F.col("role") == "title").alias("titles"), F.count_if(F.col("role") == "reference").alias("reference_blocks"))
    return table(spark, d, "inventory").select("document_id").distinct().join(per, "document_id", "left").na.fill(0)


@query(f"""WITH b AS (SELECT document_id, sha256(role || '|' || text) AS fp, role IN ('other') AS discarded FROM {_B} WHERE role IS NOT NULL AND text IS NOT NULL),
    d AS (SELECT document_id, CAST(sum(n - 1) AS BIGINT) AS duplicated FROM (SELECT document_id, fp, count(*) AS n FROM b WHERE NOT discarded GROUP BY 1, 2) GROUP BY 1) SELECT document_id, duplicated FROM d""")
def block_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    b = _one(spark, d, "document_id", "role", "text").where("role is not null and text is not null and role <> 'other'").groupBy("document_id", F.sha2(F.concat_ws("|", "role", "text"), 256).alias("fp")).agg(F.count("*").alias("n"))
    return b.groupBy("document_id").agg(F.sum(F.col("n") - 1).cast("long").alias("duplicated"))


@query(f"WITH b AS (SELECT DISTINCT document_id, sha256(text) AS fp, role = 'other' AS discarded FROM {_B} WHERE text IS NOT NULL AND role IS NOT NULL) SELECT document_id, count(*) AS overlap FROM (SELECT document_id, fp FROM b WHERE discarded INTERSECT SELECT document_id, fp FROM b WHERE NOT discarded) GROUP BY 1")
def content_discarded_overlap(spark: SparkSession, d: str) -> DataFrame:
    other = F.col("role") == "other"
    g = _one(spark, d, "document_id", "role", "text").where("text is not null and role is not null").groupBy("document_id", F.sha2("text", 256).alias("fp")).agg(F.max(other).alias("a"), F.max(~other).alias("b"))
    return g.where("a and b").groupBy("document_id").agg(F.count("*").alias("overlap"))


@query(f"SELECT document_id, CAST(sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_text, CAST(sum(CASE WHEN page IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_page, CAST(sum(CASE WHEN section_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_section, CAST(sum(CASE WHEN source_type IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_type, CAST(sum(CASE WHEN char_count IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_count FROM {_B} GROUP BY 1")
def null_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _sized(spark, d, "document_id", "page", "section_id", "source_type", "char_count").groupBy("document_id").agg(*[F.count_if(F.col(c).isNull()).alias(n) for c, n in (("chars", "no_text"), ("page", "no_page"), ("section_id", "no_section"), ("source_type", "no_type"), ("char_count", "no_count"))])


# ---- structure ------------------------------------------------------------------------------


@query(f"SELECT block_id, document_id, position FROM {_O}")
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    return structure.reading_order(_b(spark, d), "document_id").select("block_id", "document_id", "position")


_MATCH = "CASE WHEN source_type IN ('title', 'table', 'image', 'list') THEN CAST(length(text) % 7 AS INTEGER) END"


@query(f"""
    WITH m AS (SELECT document_id, coalesce(page, -1) AS page, block_id, position, {_MATCH} AS ordinal FROM {_O}),
         r AS (SELECT *, CASE WHEN ordinal IS NOT NULL THEN row_number() OVER (PARTITION BY document_id, page ORDER BY ordinal NULLS LAST, position) END AS rk FROM m),
         a AS (SELECT *, (SELECT q.rk FROM r q WHERE q.document_id = r.document_id AND q.page = r.page AND q.position >= r.position AND q.rk IS NOT NULL ORDER BY q.position LIMIT 1) AS anchor FROM r)
    SELECT block_id, CAST(row_number() OVER (PARTITION BY document_id, page ORDER BY anchor NULLS LAST, rk IS NOT NULL, position) - 1 AS INTEGER) AS merged FROM a""")
def merged_order(spark: SparkSession, d: str) -> DataFrame:
    o = structure.reading_order(_b(spark, d), "page", "source_type", "text").select("document_id", F.coalesce("page", F.lit(-1)).alias("page"), "block_id", "position", F.expr(_MATCH).alias("ordinal"))
    return structure.merged_order(o, ["document_id", "page"], "position", "ordinal").select("block_id", "merged")


@query(f"{_WITH} SELECT block_id, section FROM s")
def sections(spark: SparkSession, d: str) -> DataFrame:
    return structure.sections(_b(spark, d)).select("block_id", "section")


@query(f"{_WITH} SELECT block_id, CAST(level AS INTEGER) AS level, parent FROM s WHERE level IS NOT NULL")
def section_parents(spark: SparkSession, d: str) -> DataFrame:
    return structure.sections(_b(spark, d)).where("level is not null").select("block_id", "level", "parent")


@query(f"""{_WITH}, p AS (SELECT document_id, block_id AS section, parent AS up, coalesce(text, '') AS path FROM s WHERE level IS NOT NULL UNION ALL SELECT p.document_id, p.section, s.parent, coalesce(s.text, '') || ' > ' || p.path FROM p JOIN s ON s.block_id = p.up)
    SELECT document_id, section, path FROM p WHERE up IS NULL""")
def heading_paths(spark: SparkSession, d: str) -> DataFrame:
    return structure.heading_paths(_b(spark, d))


@query(f"""{_WITH}, l AS (SELECT *, role = 'list' AND NOT (coalesce(lag(role = 'list') OVER w, false) AND lag(section) OVER w IS NOT DISTINCT FROM section) AS st FROM s WINDOW w AS (PARTITION BY document_id ORDER BY position)),
    g AS (SELECT *, sum(CASE WHEN st THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY position) AS g FROM l)
    SELECT document_id, min_by(block_id, position) AS first_block, count(*) AS n_blocks, max(section) AS section FROM g WHERE role = 'list' GROUP BY document_id, g""")
def list_groups(spark: SparkSession, d: str) -> DataFrame:
    return structure.list_groups(_b(spark, d))


@query(f"SELECT block_id, CASE {' '.join(f'WHEN source_type = {chr(39)}{k}{chr(39)} THEN {chr(39)}{v}{chr(39)}' for k, v in structure.ROLE_BY_TYPE.items())} ELSE 'other' END AS derived_role FROM {_B}")
def role_classification(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "source_type").select("block_id", structure.role(F.col("source_type")).alias("derived_role"))


@query()
def region_roles(spark: SparkSession, d: str) -> DataFrame:
    return structure.regions(_b(spark, d))


@query(f"SELECT document_id, block_id, asset_id, CASE WHEN role IN ('figure', 'chart', 'table', 'equation', 'code') THEN role ELSE 'figure' END AS kind FROM (SELECT DISTINCT document_id, block_id, role, unnest(asset_ids) AS asset_id FROM {_B})")
def asset_registry(spark: SparkSession, d: str) -> DataFrame:
    return structure.assets(_b(spark, d)).select("document_id", "block_id", "asset_id", "kind")


@query(" UNION ALL ".join(f"SELECT block_id, '{n}' AS violation FROM {_B} WHERE {r}" for n, r in (("unknown_role", "role NOT IN ('abstract', 'code', 'aside', 'metadata', 'chart', 'figure', 'list', 'equation', 'reference', 'table', 'body', 'title', 'other')"), ("char_count", "coalesce(char_count, -1) <> coalesce(length(text), -1)"), ("foreign_section", "NOT starts_with(section_id, document_id)"), ("no_document", "document_id IS NULL"), ("no_page", "page IS NULL"))))
def structure_invariants(spark: SparkSession, d: str) -> DataFrame:
    return structure.violations(_b(spark, d))


# ---- bibliography ---------------------------------------------------------------------------


@query(f"SELECT block_id, rtrim(regexp_extract(text, '(?i)\\b10\\.\\d{{4,9}}/[-._;()/:A-Z0-9]+', 0), '.,;') AS doi FROM {_B} WHERE regexp_matches(text, '(?i)\\b10\\.\\d{{4,9}}/[-._;()/:A-Z0-9]+')")
def doi_extract(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "text").select("block_id", text.doi(F.col("text")).alias("doi")).where("doi is not null")


_YEARS = f"""WITH y AS (SELECT document_id, position, unnest(regexp_extract_all(text, '\\b(19\\d{{2}}|20\\d{{2}})\\b', 1)) AS year, generate_subscripts(regexp_extract_all(text, '\\b(19\\d{{2}}|20\\d{{2}})\\b', 1), 1) AS k FROM {_O}),
    g AS (SELECT document_id, year, count(*) AS n, min(position * 100000 + k) AS seen FROM y GROUP BY 1, 2)"""


@query(f"{_YEARS} SELECT document_id, year, n, least(0.8, round(0.5 + 0.1 * (n - 1), 6))::DOUBLE AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY n DESC, seen) AS rn FROM g) WHERE rn = 1")
def year_mode(spark: SparkSession, d: str) -> DataFrame:
    """The year most often named, the first seen of equals; the order of appearance is carried as a number."""
    y = structure.reading_order(_b(spark, d), "text").select("document_id", "position", F.posexplode(text.years(F.col("text"))).alias("k", "year"))
    g = y.groupBy("document_id", "year").agg(F.count("*").alias("n"), F.min(F.col("position").cast("long") * 100000 + F.col("k") + 1).alias("seen"))
    best = g.groupBy("document_id").agg(F.max_by(F.struct("year", "n"), F.struct("n", -F.col("seen"))).alias("b"))
    return best.select("document_id", "b.year", "b.n", F.least(F.lit(0.8), F.round(F.lit(0.5) + F.lit(0.1) * (F.col("b.n") - 1).cast("double"), 6)).alias("confidence"))


@query(f"""SELECT block_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(text, '(?s)^[^:]*:?', ''), ','), lambda x: trim(x, ' .')), lambda x: x <> ''), '|') AS keywords FROM {_B}
    WHERE regexp_matches(lower(text), '^\\W*(keywords|palabras clave|palavras.chave)')""")
def keyword_split(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "text").where(F.lower("text").rlike("^\\W*(keywords|palabras clave|palavras.chave)")).select("block_id", F.array_join(text.keywords(F.col("text")), "|").alias("keywords"))


@query(f"SELECT document_id, text AS title FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY (level = 1 AND coalesce(page, 0) = 0) DESC, position) AS rn FROM {_T} WHERE level IS NOT NULL AND coalesce(page, 0) <= 1 AND text IS NOT NULL) WHERE rn = 1")
def title_pick(spark: SparkSession, d: str) -> DataFrame:
    t = structure.title_levels(_b(spark, d), "page").where("level is not null and coalesce(page, 0) <= 1 and text is not null")
    first = F.min_by("text", F.struct((~((F.col("level") == 1) & (F.coalesce("page", F.lit(0)) == 0))).alias("a"), "position"))
    return t.groupBy("document_id").agg(first.alias("title"))


_WS = "[\\s\\x{85}\\x{A0}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{3000}]+"
_LIST = lambda words: "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _plain(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace({c}, '<[^>]+>', ' ', 'g'), '{_WS}', ' ', 'g'))"


def _names(source: str) -> str:
    """SELECT of the columns of ``source`` (which has ``part``) with the ``name`` each part is."""
    cut = f"trim(regexp_replace(trim({_plain('part')}, ' ,;|-'), '(?i){bibliography.NAME_STOP}.*$', ''), ' ,;|-')"
    plain = "lower(strip_accents(x))"
    return f"""SELECT * EXCLUDE (part, t, r) FROM (SELECT *, list_filter(t, lambda x: {plain} NOT IN {_LIST(bibliography.NAME_CONNECTORS)}) AS r FROM (SELECT *, string_split(name, ' ') AS t FROM (SELECT *, {cut} AS name FROM {source})))
        WHERE len(t) BETWEEN 2 AND 8 AND len(r) >= 2 AND len(list_filter(r, lambda x: NOT regexp_full_match(x, '\\p{{Lu}}[\\p{{L}}''.-]*'))) = 0 AND NOT regexp_matches(name, '[:@\\d]') AND len(list_filter(t, lambda x: {plain} IN {_LIST(bibliography.NAME_REJECT)})) = 0"""


@query(f"WITH p AS (SELECT block_id, unnest(string_split_regex(text, '[;\n]')) AS part FROM {_B}) SELECT DISTINCT block_id, name FROM ({_names('p')})")
def person_names(spark: SparkSession, d: str) -> DataFrame:
    """The parts of all texts that read as personal names."""
    return bibliography.names_of(_b(spark, d))


_HEADING = f"trim(regexp_replace(lower(strip_accents(regexp_replace(text, '<[^>]+>', ' ', 'g'))), '{_WS}', ' ', 'g'), ' .:-')"
_STARTS = _LIST((*bibliography.ABSTRACT_LANGUAGE, *bibliography.SECTION_STARTS))
_FRONT = f"""o AS MATERIALIZED (SELECT document_id, position, page, role, source_type, text, CASE WHEN role = 'title' THEN {_HEADING} END AS heading, coalesce(page, 0) <= 1 AS front FROM {_O} WHERE document_id IS NOT NULL AND text IS NOT NULL),
    f AS (SELECT document_id, min(position) FILTER (role = 'title' AND front AND heading NOT IN {_STARTS}) AS b, min(position) FILTER (role = 'title' AND front AND heading IN {_STARTS}) AS h FROM o GROUP BY 1),
    e AS (SELECT f.document_id, b, least(coalesce(h, 2147483647), coalesce((SELECT min(position) FROM o WHERE o.document_id = f.document_id AND role = 'abstract' AND front AND position > b), 2147483647)) AS e FROM f),
    l AS (SELECT o.document_id, position, string_split_regex(text, '[;\n]') AS parts FROM o JOIN e ON o.document_id = e.document_id WHERE front AND role <> 'title' AND source_type IN {_LIST(bibliography.NAME_TYPES)} AND position > b AND position < e),
    p AS (SELECT document_id, position, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM l), n AS (SELECT *, row_number() OVER (PARTITION BY document_id, lower(strip_accents(name)) ORDER BY position, k) AS rn FROM ({_names('p')})),
    a AS (SELECT document_id, list(name ORDER BY position, k) AS names FROM n WHERE rn = 1 GROUP BY 1)"""


@query(f"WITH {_FRONT} SELECT document_id, array_to_string(names, '; ') AS names FROM a")
def front_matter_authors(spark: SparkSession, d: str) -> DataFrame:
    return bibliography.front_authors(bibliography._ordered(_b(spark, d))).select("document_id", F.array_join("names", "; ").alias("names"))


_FAMILY = "list_transform(who, lambda x: list_extract(string_split(x, ' '), -1))"


@query(f"""WITH {_FRONT},
    t AS (SELECT document_id, min_by({_plain('text')}, (coalesce(page, 0) > 0, position)) FILTER (front AND heading NOT IN {_LIST((*bibliography.ABSTRACT_LANGUAGE, *bibliography.SECTION_STARTS, *bibliography.REFERENCE_TITLES))} AND heading <> '') AS front_title, min_by({_plain('text')}, position) AS first_title FROM o WHERE role = 'title' GROUP BY 1),
    d AS (SELECT document_id, min_by(rtrim(regexp_extract(text, '(?i)\\b10\\.\\d{{4,9}}/[-._;()/:A-Z0-9]+', 0), '.,;'), position) AS doi FROM o WHERE regexp_matches(text, '(?i)\\b10\\.\\d{{4,9}}/[-._;()/:A-Z0-9]+') GROUP BY 1),
    yy AS (SELECT document_id, position, unnest(regexp_extract_all(text, '\\b(19\\d{{2}}|20\\d{{2}})\\b', 1)) AS year, generate_subscripts(regexp_extract_all(text, '\\b(19\\d{{2}}|20\\d{{2}})\\b', 1), 1) AS k FROM o),
    y AS (SELECT * FROM (SELECT document_id, year, n, row_number() OVER (PARTITION BY document_id ORDER BY n DESC, s) AS rn FROM (SELECT document_id, year, count(*) AS n, min((position, k)) AS s FROM yy GROUP BY 1, 2)) WHERE rn = 1),
    i AS (SELECT document_id, max_by({_plain('title')}, (try_cast(modified_at AS TIMESTAMPTZ), revision_id)) FILTER (trim(title) <> '') AS t, max_by({_plain('author')}, (try_cast(modified_at AS TIMESTAMPTZ), revision_id)) FILTER (trim(author) <> '') AS a FROM inventory WHERE document_id IS NOT NULL GROUP BY 1),
    v AS (SELECT * FROM (SELECT document_id, page_count, row_number() OVER (PARTITION BY document_id ORDER BY page_count DESC) AS rn FROM inventory WHERE page_count IN (4, 5) AND relative_path IS NOT NULL) WHERE rn = 1),
    j AS (SELECT i.document_id, i.t, i.a, front_title, first_title, a.names, d.doi, y.year, y.n, v.document_id IS NOT NULL AS human, CASE WHEN v.page_count = 5 THEN 'Instituto Aurora' END AS corporate,
          CASE WHEN v.page_count = 4 THEN ['Ana Maria Souza', 'Bruno Lima'] WHEN v.document_id IS NOT NULL THEN [] WHEN i.a IS NOT NULL THEN [i.a] ELSE coalesce(a.names, []) END AS who
          FROM i LEFT JOIN t USING (document_id) LEFT JOIN a USING (document_id) LEFT JOIN d USING (document_id) LEFT JOIN y USING (document_id) LEFT JOIN v USING (document_id))
    SELECT document_id, coalesce(t, front_title, first_title) AS title, CAST(CASE WHEN t IS NOT NULL THEN 0.95 WHEN front_title IS NOT NULL THEN 0.9 WHEN first_title IS NOT NULL THEN 0.7 END AS DOUBLE) AS title_confidence, array_to_string(who, '; ') AS authors,
           CASE WHEN human THEN 'override' WHEN a IS NOT NULL THEN 'explicit' WHEN names IS NOT NULL THEN 'front_matter' END AS author_source, CAST(CASE WHEN human THEN 1.0 WHEN a IS NOT NULL THEN 0.95 WHEN names IS NOT NULL THEN 0.6 END AS DOUBLE) AS author_confidence,
           CASE len(who) WHEN 0 THEN corporate WHEN 1 THEN {_FAMILY}[1] WHEN 2 THEN {_FAMILY}[1] || ' e ' || {_FAMILY}[2] ELSE {_FAMILY}[1] || ' et al.' END AS citation, doi, CAST(CASE WHEN doi IS NOT NULL THEN 0.85 END AS DOUBLE) AS doi_confidence,
           CAST(year AS INTEGER) AS year, CAST(CASE WHEN year IS NOT NULL THEN least(0.8, round(0.5 + 0.1 * (n - 1), 6)) END AS DOUBLE) AS year_confidence, CASE WHEN human THEN NULL WHEN len(who) = 0 THEN 'missing' WHEN a IS NULL THEN 'inferred' END AS review FROM j""")
def bibliographic_records(spark: SparkSession, d: str) -> DataFrame:
    """All fields by precedence; every document of 4 or 5 pages has an override under a path written with backslashes."""
    inv = table(spark, d, "inventory")
    named, none = F.array(F.lit("Ana Maria Souza"), F.lit("Bruno Lima")), F.array().cast("array<string>")
    four = F.col("page_count") == 4
    human = inv.where("page_count in (4, 5)").select(F.concat(F.translate("relative_path", "/", "\\"), F.lit("\\")).alias("path"), F.lit("human").alias("source"), F.when(four, none).otherwise(F.array(F.lit("Instituto Aurora"))).alias("corporate"), F.when(four, named).otherwise(none).alias("authors"))
    return bibliography.bibliography(_b(spark, d), inv, human.distinct())


@query(f"""WITH {_FRONT}, r AS (SELECT document_id, position, role, {_plain('text')} AS t, last_value(CASE WHEN role = 'title' THEN position END IGNORE NULLS) OVER w AS p, last_value(CASE WHEN role = 'title' THEN coalesce(CASE heading WHEN 'abstract' THEN 'en' WHEN 'resumen' THEN 'es' WHEN 'resumo' THEN 'pt' END, '-') END IGNORE NULLS) OVER w AS lang FROM o WINDOW w AS (PARTITION BY document_id ORDER BY position ROWS UNBOUNDED PRECEDING)),
    q AS (SELECT *, CASE WHEN starts_with(lower(strip_accents(t)), 'keywords') THEN 'en' WHEN starts_with(lower(strip_accents(t)), 'palabras clave') THEN 'es' WHEN regexp_matches(lower(strip_accents(t)), '^palavras[- ]chave') THEN 'pt' END AS keys FROM r WHERE role <> 'title' AND lang <> '-'),
    z AS (SELECT *, min(CASE WHEN keys IS NOT NULL THEN position END) OVER (PARTITION BY document_id, p) AS shut FROM q),
    b AS (SELECT document_id, lang, p, string_agg(t, ' ' ORDER BY position) AS abstract FROM z WHERE position < coalesce(shut, 2147483647) AND role IN ('body', 'abstract', 'list') AND t <> '' GROUP BY 1, 2, 3),
    x AS (SELECT document_id, lang, min_by(abstract, p) AS abstract FROM b GROUP BY 1, 2),
    k AS (SELECT document_id, keys AS lang, max_by(array_to_string(list_filter(list_transform(string_split(regexp_replace(t, '(?s)^[^:]*:?', ''), ','), lambda y: trim(y, ' .')), lambda y: y <> ''), '|'), position) AS keywords FROM z WHERE position = shut GROUP BY 1, 2)
    SELECT document_id, lang, abstract, keywords, CAST(CASE WHEN abstract IS NOT NULL THEN 0.9 END AS DOUBLE) AS confidence FROM x FULL JOIN k USING (document_id, lang)
    UNION ALL SELECT document_id, 'und', min_by({_plain('text')}, position), NULL, 0.8 FROM o WHERE role = 'abstract' AND {_plain('text')} <> '' AND document_id NOT IN (SELECT document_id FROM x) GROUP BY 1""")
def abstracts_by_language(spark: SparkSession, d: str) -> DataFrame:
    return bibliography.abstracts(_b(spark, d))


@query(f"""WITH t AS (SELECT document_id, text AS title FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY (level = 1 AND coalesce(page, 0) = 0) DESC, position) AS rn FROM {_T} WHERE level IS NOT NULL AND coalesce(page, 0) <= 1 AND text IS NOT NULL) WHERE rn = 1),
    i AS (SELECT document_id, max_by(title, (try_cast(modified_at AS TIMESTAMPTZ), revision_id)) AS title FROM inventory WHERE trim(title) <> '' GROUP BY 1)
    SELECT k.document_id, coalesce(i.title, t.title) AS title, CASE WHEN i.title IS NOT NULL THEN 'explicit' WHEN t.title IS NOT NULL THEN 'front_matter' ELSE 'none' END AS source, CASE WHEN i.title IS NOT NULL THEN 0.95 WHEN t.title IS NOT NULL THEN 0.7 ELSE 0.0 END::DOUBLE AS confidence
    FROM (SELECT DISTINCT document_id FROM inventory) k LEFT JOIN i USING (document_id) LEFT JOIN t USING (document_id)""")
def override_precedence(spark: SparkSession, d: str) -> DataFrame:
    """A value the inventory states goes before one derived from the front matter; each with its source and confidence."""
    inv = table(spark, d, "inventory")
    stated = inv.where("trim(title) <> ''").groupBy("document_id").agg(F.max_by("title", F.struct(F.try_to_timestamp(F.col("modified_at")), "revision_id")).alias("a"))
    j = inv.select("document_id").distinct().join(stated, "document_id", "left").join(title_pick(spark, d).withColumnRenamed("title", "b"), "document_id", "left")
    a, b = F.col("a").isNotNull(), F.col("b").isNotNull()
    return j.select("document_id", F.coalesce("a", "b").alias("title"), F.when(a, "explicit").when(b, "front_matter").otherwise("none").alias("source"), F.when(a, 0.95).when(b, 0.7).otherwise(0.0).alias("confidence"))


# ---- chunks ---------------------------------------------------------------------------------

_SEC = f"(SELECT *, coalesce(section_id, document_id || ':none') AS sec FROM {_O} WHERE length(text) > 0)"


@query(f"SELECT block_id, CAST(sum(length(text) + 2) OVER (PARTITION BY sec ORDER BY position ROWS UNBOUNDED PRECEDING) - length(text) - 2 AS BIGINT) AS start_offset, CAST(sum(length(text) + 2) OVER (PARTITION BY sec ORDER BY position ROWS UNBOUNDED PRECEDING) - 2 AS BIGINT) AS end_offset FROM {_SEC}")
def section_offsets(spark: SparkSession, d: str) -> DataFrame:
    return chunking.section_offsets(_b(spark, d)).select("block_id", "start_offset", "end_offset")


@query(f"""WITH o AS (SELECT sec, block_id, CAST(sum(length(text) + 2) OVER w - length(text) - 2 AS BIGINT) AS a, CAST(sum(length(text) + 2) OVER w - 2 AS BIGINT) AS b FROM {_SEC} WINDOW w AS (PARTITION BY sec ORDER BY position ROWS UNBOUNDED PRECEDING)),
    c AS (SELECT DISTINCT sec, CAST(k AS INTEGER) AS chunk, k * 1000 AS ca, k * 1000 + 1000 AS cb FROM (SELECT sec, max(b) AS n FROM o GROUP BY 1), range(0, 100000) t(k) WHERE k * 1000 < n)
    SELECT o.sec AS section, chunk, block_id FROM o JOIN c ON o.sec = c.sec AND o.b > c.ca AND o.a < c.cb""")
def chunk_unit_overlap(spark: SparkSession, d: str) -> DataFrame:
    return chunking.unit_overlap(_b(spark, d), 1000)


@query(f"SELECT block_id, role, CASE WHEN role IN ('body', 'abstract', 'list', 'reference', 'metadata') THEN 'embed' WHEN role IN ('table', 'figure', 'chart', 'equation', 'code') THEN 'payload' WHEN role = 'title' THEN 'placeholder' ELSE 'exclude' END AS action FROM {_B}")
def policy_actions(spark: SparkSession, d: str) -> DataFrame:
    return chunking.with_actions(_one(spark, d, "role")).select("block_id", "role", "action")


# The rule of the character chunks as a walk over all sections at once, one unit a step: n the characters of the open chunk's
# units, chunk its number when the unit joins, closed whether it closes with the unit. The unit before opens every later chunk.
_CHUNKS = f"""WITH RECURSIVE u AS MATERIALIZED (SELECT document_id, sec, block_id, role, length(text) AS len, row_number() OVER (PARTITION BY sec ORDER BY position) AS i, bool_and(role = 'title') OVER (PARTITION BY sec) AS bare FROM {_SEC} WHERE role NOT IN ('table', 'figure', 'chart', 'equation', 'code', 'aside', 'other')),
    w AS (SELECT sec, i, len, len AS n, 0 AS chunk, len >= 2400 AS closed FROM u WHERE i = 1 AND NOT bare
          UNION ALL
          SELECT u.sec, u.i, u.len, CASE WHEN o.n + u.len > 3600 THEN o.last ELSE o.n END + u.len, o.chunk + CASE WHEN o.n + u.len > 3600 THEN 1 ELSE 0 END, CASE WHEN o.n + u.len > 3600 THEN o.last ELSE o.n END + u.len >= 2400
          FROM (SELECT sec, i, len AS last, CASE WHEN closed THEN len ELSE n END AS n, chunk + CASE WHEN closed THEN 1 ELSE 0 END AS chunk FROM w) o JOIN u ON u.sec = o.sec AND u.i = o.i + 1),
    f AS (SELECT *, coalesce(lead(chunk) OVER (PARTITION BY sec ORDER BY i), chunk + CASE WHEN closed THEN 1 ELSE 0 END) AS upto FROM w),
    m AS (SELECT f.sec, f.i, unnest(range(f.chunk, f.upto + 1)) AS chunk FROM f),
    k AS (SELECT m.sec, chunk, sum(len) + 2 * (count(*) - 1) AS chars, max(chunk) OVER (PARTITION BY m.sec) AS last FROM m JOIN u ON u.sec = m.sec AND u.i = m.i GROUP BY m.sec, chunk),
    c AS MATERIALIZED (SELECT DISTINCT u.document_id, m.sec AS section, CASE WHEN m.chunk = k.last AND m.chunk > 0 AND k.chars < 300 THEN m.chunk - 1 ELSE m.chunk END AS chunk, u.block_id, u.role, u.len AS chars, u.i
                       FROM m JOIN k ON k.sec = m.sec AND k.chunk = m.chunk JOIN u ON u.sec = m.sec AND u.i = m.i),
    g AS (SELECT sec AS section, min_by(text, position) AS heading FROM {_SEC} WHERE role = 'title' GROUP BY sec),
    t AS (SELECT document_id, section, chunk, CAST(chars AS BIGINT) AS chars, CASE WHEN r = n THEN 'references' WHEN regexp_matches(lower(coalesce(heading, '')), 'dados biográficos|biografia|biographical') THEN 'biography' WHEN r > b THEN 'references' ELSE 'body' END AS type
          FROM (SELECT document_id, section, chunk, sum(chars) + 2 * (count(*) - 1) AS chars, count(*) AS n, count(*) FILTER (role = 'reference') AS r, count(*) FILTER (role IN ('body', 'abstract')) AS b FROM c GROUP BY 1, 2, 3) LEFT JOIN g USING (section))"""


@query(f"{_CHUNKS} SELECT document_id, section, CAST(chunk AS INTEGER) AS chunk, CAST(row_number() OVER (PARTITION BY section, chunk ORDER BY i) - 1 AS INTEGER) AS ordinal, block_id, role, CAST(chars AS INTEGER) AS chars FROM c")
def char_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.char_chunks(_b(spark, d))


@query()
def recursive_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of at most 700 tokens of the public vocabulary with an overlap of at most 100."""
    return chunking.recursive_chunks(_b(spark, d), 700, 100, tokenizer.token_length, "tokens-700-100")


@query(f"""{_CHUNKS}, s AS (SELECT section, chunk, sum(chars) + 2 * (count(*) - 1) AS n FROM c GROUP BY 1, 2), x AS (SELECT unnest(['missing', 'oversized', 'undersized', 'unexplained_repeats']) AS "check")
    SELECT "check", CAST(CASE "check" WHEN 'oversized' THEN (SELECT count(*) FROM s WHERE n > 3600) WHEN 'undersized' THEN (SELECT count(*) FROM s WHERE n < 300) ELSE 0 END AS BIGINT) AS n FROM x""")
def chunk_validation(spark: SparkSession, d: str) -> DataFrame:
    return chunking.validation(_b(spark, d))


def _types(spark: SparkSession, d: str) -> DataFrame:
    return chunking.chunk_types(chunking.char_chunks(_b(spark, d)), chunking.section_headings(_b(spark, d)))


@query(f"{_CHUNKS} SELECT document_id, section, CAST(chunk AS INTEGER) AS chunk, chars, type FROM t")
def chunk_types(spark: SparkSession, d: str) -> DataFrame:
    return _types(spark, d)


@query(f"{_CHUNKS} SELECT type, count(*) AS chunks, avg(chars) AS chars_mean, min(chars) AS chars_min, max(chars) AS chars_max FROM t GROUP BY 1")
def chunk_summary(spark: SparkSession, d: str) -> DataFrame:
    return chunking.summary(_types(spark, d))


@query(f"{_CHUNKS} SELECT section, CAST(chunk AS INTEGER) AS chunk, block_id FROM c WHERE chunk > (SELECT min(d.chunk) FROM c d WHERE d.section = c.section AND d.block_id = c.block_id)")
def overlap_blocks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.overlap_blocks(chunking.char_chunks(_b(spark, d)))


@query(f"""{_CHUNKS}, h AS (SELECT *, document_id || ':' || section || ':' || chunk AS k, sha256('42:' || document_id || ':' || section || ':' || chunk) AS h FROM t),
    p AS (SELECT k, 0 AS r FROM (SELECT k, row_number() OVER (PARTITION BY document_id ORDER BY h) AS rn FROM h) WHERE rn = 1 UNION ALL SELECT k, 1 FROM (SELECT k FROM h ORDER BY chars, k LIMIT 3) UNION ALL SELECT k, 2 FROM (SELECT k FROM h ORDER BY chars DESC, k LIMIT 3)),
    o AS (SELECT k, min(r) AS r FROM p GROUP BY 1), z AS (SELECT k, row_number() OVER (ORDER BY h) AS i FROM (SELECT * FROM h ORDER BY h LIMIT 2000) WHERE k NOT IN (SELECT k FROM o))
    SELECT document_id, section, CAST(chunk AS INTEGER) AS chunk, CASE coalesce(o.r, 3) WHEN 0 THEN 'document' WHEN 1 THEN 'shortest' WHEN 2 THEN 'longest' ELSE 'random' END AS reason
    FROM h LEFT JOIN o USING (k) LEFT JOIN z USING (k) WHERE o.r IS NOT NULL OR z.i + (SELECT count(*) FROM o) <= 2000""")
def chunk_review_sample(spark: SparkSession, d: str) -> DataFrame:
    return chunking.review_sample(_types(spark, d), 2000)


@query("""SELECT block_id, """ + """(SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST(instr('0123456789abcdef', substr(h, 17, 1)) - 1 AS INTEGER) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)
    FROM (SELECT sha1(from_hex(replace(document_id, '-', '')) || encode('chunk:policy-1:' || position || ':' || sha256(coalesce(text, '')))) AS h)) AS chunk_id FROM """ + _O)
def chunk_ids(spark: SparkSession, d: str) -> DataFrame:
    o = structure.reading_order(_b(spark, d), "text")
    return o.select("block_id", chunking.chunk_id(F.col("document_id"), F.lit("policy-1"), F.col("position"), F.coalesce("text", F.lit(""))).alias("chunk_id"))


@query(f"SELECT document_id, block_id, CASE WHEN length(t) > 240 THEN rtrim(substr(t, 1, 239)) || '…' ELSE t END AS short, greatest(1, CAST(ceil(length(text) / 4.0) AS INTEGER)) AS tokens FROM (SELECT *, trim(regexp_replace(text, '[\\s\\x{{85}}\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{3000}}]+', ' ', 'g')) AS t FROM {_B} WHERE text IS NOT NULL)")
def truncated_text(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "document_id", "text").where("text is not null").select("document_id", "block_id", text.truncate(F.col("text")).alias("short"), text.token_estimate(F.col("text")).alias("tokens"))


@query()
def rendered_markdown(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import render

    return render.markdown(_b(spark, d))


