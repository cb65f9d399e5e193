"""The typed document tree: nodes of extraction payloads as tables, their counts, invariants and inspections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import deepjson, geometry
from ..session import checkpointed
from . import content_list, nested

# Block types that are page furniture, and those expected within content.
FURNITURE = ("header", "footer", "page_number")
LOW_SCORE = 0.80


def newest_valid(records: DataFrame) -> DataFrame:
    """One payload per record: of its valid copies the one received last, ties by content."""
    ok = records.where(nested.is_json(F.col("payload")))
    return ok.groupBy("record_id").agg(F.max_by(F.struct("document_id", "source_name", "payload"), F.struct("received_at", "payload")).alias("r")).select("record_id", "r.*")


def root_keys(records: DataFrame) -> DataFrame:
    """``key, occurrences, records`` over all valid payloads."""
    ok = records.where(nested.is_json(F.col("payload")))
    k = ok.select("record_id", F.explode(F.json_object_keys("payload")).alias("key"))
    return k.groupBy("key").agg(F.count("*").alias("occurrences"), F.countDistinct("record_id").alias("records"))


def record_status(records: DataFrame) -> DataFrame:
    """Copies and valid copies per record; a payload that is cut off is pending, none at all is missing."""
    valid = F.col("__valid")
    g = records.withColumn("__valid", nested.is_json(F.col("payload"))).groupBy("record_id").agg(F.count("*").alias("copies"), F.sum(valid.cast("long")).alias("valid_copies"), F.count("payload").alias("__p"))
    return g.select("record_id", "copies", "valid_copies", F.when(F.col("valid_copies") > 0, "ok").when(F.col("__p") == 0, "missing").otherwise("pending").alias("render_status"))


def nodes(records: DataFrame) -> DataFrame:
    return nested.occurrences(newest_valid(records), fields=True)


def _type(f: str = "f") -> Column:
    return F.coalesce(F.col(f"{f}.type"), F.col(f"{f}.block_type"))


def blocks(records: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """Block rows with typed fields, depth, and the list of the page they stand in (content or discarded).

    ``parsed`` is a result of ``nodes`` that several tables are made from.
    """
    n = (nodes(records) if parsed is None else parsed).where("kind = 'block'").withColumn("f", F.from_json("fields", nested.COLUMNS["block"]))
    return n.select(
        "record_id", "parent", "node", "ordinal", "object_id",
        F.when(F.col("node").rlike("^p\\d+:d"), "discarded").otherwise("content").alias("collection"),
        (F.size(F.split("node", ":")) - 1).alias("depth"),
        _type().alias("type"), F.col("f.index").try_cast("int").alias("block_index"), F.col("f.text").alias("text"), F.col("f.content").alias("content"),
        geometry.bbox(F.col("f.bbox")).alias("bbox"), F.col("f.score").alias("score"), F.col("f.level").try_cast("int").alias("level"),
        F.when(F.lower("f.cross_page").isin("true", "1", "yes"), True).when(F.lower("f.cross_page").isin("false", "0", "no"), False).alias("cross_page"),
        F.col("f.image_path").alias("image_path"), F.col("f.latex").alias("latex"), F.col("f.html").alias("html"),
    )


def spans(records: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    n = (nodes(records) if parsed is None else parsed).where("kind = 'span'").withColumn("f", F.from_json("fields", nested.COLUMNS["span"]))
    return n.select("record_id", "parent", "node", "ordinal", F.regexp_extract("node", "^(.*):l\\d+:s\\d+$", 1).alias("block"), "f.*")


def counts(records: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """Per record: pages, content and discarded blocks (roots and all), lines, spans, spans without text."""
    n = nodes(records) if parsed is None else parsed
    block, page = F.col("kind") == "block", F.col("kind") == "page"
    discarded = F.col("node").rlike("^p\\d+:d")
    root = F.col("node").rlike("^p\\d+:[bd]\\d+$")
    silent = (F.col("kind") == "span") & F.coalesce(F.get_json_object("fields", "$.text"), F.get_json_object("fields", "$.content"), F.lit("")).isin("")
    return n.groupBy("record_id").agg(
        F.count_if(page).alias("pages"), F.count_if(block & ~discarded).alias("content_blocks"), F.count_if(block & discarded).alias("discarded_blocks"),
        F.count_if(block & root).alias("root_blocks"), F.count_if(F.col("kind") == "line").alias("lines"), F.count_if(F.col("kind") == "span").alias("spans"), F.count_if(silent).alias("spans_without_text"),
        (F.count("*") - F.countDistinct("object_id")).alias("repeated_objects"),
    )


def invariants(records: DataFrame) -> DataFrame:
    """Violations, none if the tree is sound: keys that repeat, parents that are missing, ordinals that disagree with keys."""
    n = nodes(records).select("record_id", "parent", "node", "ordinal")
    repeated = n.groupBy("record_id", "node").count().where("count > 1").select("record_id", "node", F.lit("repeated_key").alias("violation"))
    orphan = n.where("parent <> 'root'").join(n.select("record_id", F.col("node").alias("parent")), ["record_id", "parent"], "left_anti").select("record_id", "node", F.lit("missing_parent").alias("violation"))
    wrong = n.where(F.regexp_extract("node", "(\\d+)$", 1).cast("int") != F.col("ordinal")).select("record_id", "node", F.lit("ordinal").alias("violation"))
    return repeated.unionByName(orphan).unionByName(wrong)


def inspection(records: DataFrame) -> DataFrame:
    """Per record: metrics with failure and warning codes over root blocks, and the status they give."""
    parsed = checkpointed(nodes(records))
    b = blocks(records, parsed).where(F.col("node").rlike("^p\\d+:[bd]\\d+$"))
    c = counts(records, parsed)
    per = b.groupBy("record_id").agg(
        F.count_if((F.col("collection") == "content") & F.col("type").isNull()).alias("untyped"), F.count_if((F.col("collection") == "content") & F.col("bbox").isNull()).alias("without_bbox"),
        F.count_if((F.col("collection") == "content") & F.col("type").isin(*FURNITURE)).alias("noise_leak"), F.countDistinct(F.when(F.col("collection") == "content", F.regexp_extract("node", "^(p\\d+)", 1))).alias("pages_with_content"),
    )
    j = c.join(per, "record_id", "left").na.fill(0)
    failures = F.array_compact(F.array(F.when(F.col("pages") == 0, "no_pages"), F.when(F.col("content_blocks") == 0, "no_content"), F.when(F.col("spans") == 0, "no_spans")))
    warnings = F.array_compact(F.array(F.when(F.col("pages_with_content") < F.col("pages"), "empty_pages"), F.when(F.col("untyped") > 0, "untyped_blocks"), F.when(F.col("without_bbox") > 0, "blocks_without_bbox"), F.when(F.col("noise_leak") > 0, "noise_in_content"), F.when(F.col("spans_without_text") > 0, "spans_without_text")))
    status = F.when(F.size("failures") > 0, "FAIL").when(F.size("warnings") > 0, "WARN").otherwise("PASS")
    return j.select("*", F.array_join(failures, ",").alias("failure_codes"), F.array_join(warnings, ",").alias("warning_codes"), failures.alias("failures"), warnings.alias("warnings")).withColumn("audit_status", status).drop("failures", "warnings")


def null_metrics(records: DataFrame) -> DataFrame:
    b = blocks(records)
    return b.groupBy("record_id").agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("type", "bbox", "score", "level", "text")])


def _mapped_payloads(records: DataFrame, rows, ddl: str) -> DataFrame:
    """Rows that ``rows(record_id, root)`` gives for the newest valid payload of each record."""
    import pandas as pd

    names = [c.split()[0] for c in ddl.split(", ")]

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame([r for record, payload in zip(pdf.record_id, pdf.payload) for r in rows(record, nested.parse(payload))], columns=names)

    return newest_valid(records).select("record_id", "payload").mapInPandas(run, ddl)


def block_texts(records: DataFrame) -> DataFrame:
    """``record_id, block`` and the text of each root block in four orders of its fields, nested blocks included (see ``nested.texts``)."""

    def rows(record, root):
        for _, _, key, kind, _, obj, _ in nested.walk(root):
            if kind == "block" and key.count(":") == 1:
                yield (record, key, *(nested.block_text(obj, v).encode("utf-8", "replace").decode() for v in nested.VARIANTS))

    return _mapped_payloads(records, rows, "record_id long, block string, " + ", ".join(f"{v} string" for v in nested.VARIANTS))


def pages(records: DataFrame) -> DataFrame:
    """``record_id, page, width, height``; the size is null where it is not stated in full."""

    def rows(record, root):
        for _, _, key, kind, _, obj, _ in nested.walk(root):
            if kind == "page":
                yield (record, key, *(content_list.page_size(obj) or (None, None)))

    return _mapped_payloads(records, rows, "record_id long, page string, width double, height double")


def second_reading(records: DataFrame) -> DataFrame:
    """``record_id, content_list``: the content list that the working copies of a payload's pages are."""

    def rows(record, root):
        made = content_list.working_copies(root)
        if any(made):
            yield record, deepjson.dumps(made).encode("utf-8", "replace").decode()

    return _mapped_payloads(records, rows, "record_id long, content_list string")


def preproc_ratio(records: DataFrame) -> DataFrame:
    """Per page: blocks of the working copies whose text also stands in the content; multiplicity counts on the left only, null without working copies."""

    def texts(page, name):
        made = (" ".join(nested.block_text(b, "profile").lower().split()) for b in nested._entries(page.get(name)) if isinstance(b, dict))
        return [t for t in made if t]

    def rows(record, root):
        for i, page in enumerate(nested.pages_of(root) if isinstance(root, dict) else []):
            if isinstance(page, dict):
                left, right = texts(page, "preproc_blocks"), set(texts(page, "para_blocks"))
                yield record, i, len(left), sum(t in right for t in left)

    made = _mapped_payloads(records, rows, "record_id long, page int, preproc_blocks int, duplicated int")
    return made.withColumn("ratio", F.col("duplicated") / F.nullif("preproc_blocks", F.lit(0)))


def score_summary(records: DataFrame) -> DataFrame:
    """Scores per collection and type: count, non-null, least, mean, median, greatest."""
    s = F.col("score")
    return blocks(records).groupBy("collection", "type").agg(F.count("*").alias("n"), F.count(s).alias("with_score"), F.min(s).alias("score_min"), F.avg(s).alias("score_mean"), F.median(s).alias("score_median"), F.max(s).alias("score_max"))


def low_score(records: DataFrame) -> DataFrame:
    return spans(records).where(F.col("score") < LOW_SCORE).select("record_id", "node", "type", "score")


def cross_page(records: DataFrame) -> DataFrame:
    n = nodes(records).where(F.get_json_object("fields", "$.cross_page") == "true")
    return n.groupBy("record_id").agg(F.count("*").alias("n_cross_page"), F.countDistinct(F.regexp_extract("node", "^(p\\d+)", 1)).alias("n_pages"))
