"""Audits of extraction payloads: metrics with failure and warning codes, loss between source and tree, document metrics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import deepjson
from . import nested

# Types an audit knows, types that are assets, and the thresholds of its warnings.
BLOCK_TYPES = ("abstract", "aside_text", "chart", "code", "footer", "header", "image", "interline_equation", "list", "page_footnote", "page_number", "ref_text", "table", "text", "title")
SPAN_TYPES = ("inline_equation", "interline_equation", "text")
ASSET_TYPES = ("chart", "code", "image", "interline_equation", "table")
TEXTLESS_SHARE, LEAST_BYTES = 0.5, 1024
CONTAINERS = ("para_blocks", "discarded_blocks", "preproc_blocks")
METRICS = "json_valid boolean, extracted_pages long, content_blocks long, discarded_blocks long, preproc_blocks long, line_count long, span_count long, text_chars long, asset_count long, empty_pages long, textless_pages long, unknown_block_types string, unknown_span_types string, failures string, warnings string"


def _objects(value: object) -> list[dict]:
    return [x for x in nested._entries(value) if isinstance(x, dict)]


def inspect(payload: str | None, expected: int | None) -> tuple:
    """The values of ``METRICS`` for one payload. Root blocks only; an object in place of a list counts as a list of one."""
    root = nested.parse(payload)
    nothing = (None,) * 10
    if root is None:
        return (False, *nothing, "", "", "invalid_json", "")
    if not isinstance(root, dict):
        return (False, *nothing, "", "", "invalid_root", "")
    failures, warnings = [], []
    named = [k for k in nested.PAGE_LISTS if root.get(k) is not None]
    if not named and not any(k in root for k in CONTAINERS):
        return (True, *nothing, "", "", "pages_not_found", "")
    pages = [p for p in nested.pages_of(root) if isinstance(p, dict)]
    if not pages:
        failures.append("zero_pages")
    if expected is not None and expected != len(pages):
        failures.append("page_count_mismatch")
    n: Counter = Counter()
    blocks, spans = set(), set()
    for page in pages:
        here = letters = 0
        for key in CONTAINERS:
            value = page.get(key)
            if value is not None and not isinstance(value, (list, dict)):
                failures.append(f"invalid_{key}")
            for b in _objects(value):
                n[key] += 1
                here += 1
                kind = str(b.get("type") or b.get("block_type") or "unknown")
                blocks.add(kind)
                if not isinstance(b.get("lines", []), (list, dict, type(None))):
                    failures.append("invalid_block_structure")
                    continue
                n["assets"] += kind in ASSET_TYPES or any(b.get(k) for k in ("image_path", "html", "latex"))
                for line in _objects(b.get("lines")):
                    n["lines"] += 1
                    for s in _objects(line.get("spans")):
                        n["spans"] += 1
                        spans.add(str(s.get("type") or "unknown"))
                        t = s.get("text") if s.get("text") is not None else s.get("content")
                        letters += len(t) if key != "preproc_blocks" and isinstance(t, str) else 0
        n["empty"] += not here
        n["textless"] += not letters
        n["chars"] += letters
    if not sum(n[k] for k in CONTAINERS):
        failures.append("no_blocks")
    if not n["chars"]:
        (warnings if n["assets"] else failures).append("no_text_with_assets" if n["assets"] else "no_text_or_assets")
    if pages and n["textless"] / len(pages) >= TEXTLESS_SHARE:
        warnings.append("high_textless_page_ratio")
    if len(payload.encode("utf-8", "replace")) < LEAST_BYTES:
        warnings.append("small_middle_json")
    odd_blocks, odd_spans = sorted(blocks - set(BLOCK_TYPES)), sorted(spans - set(SPAN_TYPES))
    warnings += ["unknown_block_types"] * bool(odd_blocks) + ["unknown_span_types"] * bool(odd_spans)
    return (True, len(pages), *(n[k] for k in (*CONTAINERS, "lines", "spans", "chars", "assets", "empty", "textless")), "|".join(odd_blocks), "|".join(odd_spans), ",".join(dict.fromkeys(failures)), ",".join(warnings))


def _per_payload(frame: DataFrame, keys: list[str], row: Callable, ddl: str) -> DataFrame:
    """``keys`` and what ``row`` makes of the other columns, payload first."""
    import pandas as pd

    names = [*keys, *(c.split()[0] for c in ddl.split(", "))]
    others = [c for c in frame.columns if c not in keys]

    def run(batches):
        for pdf in batches:
            made = [(*k, *row(*(None if x is None or x != x else x for x in v))) for k, v in zip(pdf[keys].itertuples(index=False, name=None), pdf[others].itertuples(index=False, name=None))]
            yield pd.DataFrame({c: pd.Series([r[i] for r in made], dtype=object) for i, c in enumerate(names)})

    return frame.mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in frame.select(*keys).dtypes) + ", " + ddl)


def newest(records: DataFrame) -> DataFrame:
    """The copy of each record received last, valid or not; ties by content."""
    return records.groupBy("record_id").agg(F.max_by(F.struct("document_id", "payload"), F.struct("received_at", "payload")).alias("r")).select("record_id", "r.*")


def inspection(records: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per record the metrics, codes and status of its newest copy; the expected pages are the inventory's, of its readable rows."""
    expected = inventory.where("status = 'ok' and document_id is not null").groupBy("document_id").agg(F.max("page_count").alias("expected_pages"))
    j = newest(records).join(expected, "document_id", "left").select("record_id", "document_id", "payload", "expected_pages")
    made = _per_payload(j, ["record_id", "document_id"], lambda payload, pages: (None if pages is None else int(pages), *inspect(payload, None if pages is None else int(pages))), "expected_pages long, " + METRICS)
    return made.withColumn("empty_page_ratio", F.round(F.col("textless_pages") / F.nullif("extracted_pages", F.lit(0)), 6)).withColumn("audit_status", status(F.col("failures"), F.col("warnings")))


def status(failures: Column, warnings: Column) -> Column:
    return F.when(failures != "", "FAIL").when(warnings != "", "WARN").otherwise("PASS")


def summary(inspected: DataFrame) -> DataFrame:
    """Counts per status and the difference in pages, one row."""
    of = lambda s: F.count_if(F.col("audit_status") == s)
    pages = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return inspected.agg(
        F.count("*").alias("audited"), of("PASS").alias("passed"), of("WARN").alias("warnings"), of("FAIL").alias("failed"), pages("expected_pages").alias("expected_pages"), pages("extracted_pages").alias("extracted_pages"), (pages("extracted_pages") - pages("expected_pages")).alias("page_difference")
    )


def source_counts(root: object) -> tuple[int, ...]:
    """Pages, content and discarded root blocks, nested blocks, block nodes, lines and spans, counted on the payload itself without its tree."""
    pages = [p for p in nested.pages_of(root) if isinstance(p, dict)] if isinstance(root, dict) else []
    content = [b for p in pages for b in _objects(p.get("para_blocks"))]
    discarded = [b for p in pages for b in _objects(p.get("discarded_blocks"))]
    todo, every = [*content, *discarded], []
    while todo:
        b = todo.pop()
        every.append(b)
        todo += _objects(b.get("blocks"))
    lines = [x for b in every for x in _objects(b.get("lines"))]
    return len(pages), len(content), len(discarded), len(every) - len(content) - len(discarded), len(every), len(lines), sum(len(_objects(x.get("spans"))) for x in lines)


COUNTS = ("pages", "blocks", "discarded", "nested", "nodes", "lines", "spans")


def tree_validation(records: DataFrame) -> DataFrame:
    """``record_id``, the counts of the source and ``failed``: which of eleven checks between source and tree fail.

    The tree's counts are of its node table; its JSON is rebuilt from that table's objects and read again.
    """
    from . import ir

    valid = ir.newest_valid(records).select("record_id", "payload")
    source = _per_payload(valid.withColumn("h", F.sha2("payload", 256)), ["record_id"], lambda payload, h: (*source_counts(nested.parse(payload)), h), ", ".join(f"s_{c} long" for c in COUNTS) + ", hash string")
    n = nested.occurrences(valid, fields=True)
    block, root, discarded = F.col("kind") == "block", F.col("node").rlike("^p\\d+:[bd]\\d+$"), F.col("node").rlike("^p\\d+:d")
    again = F.try_parse_json(F.col("fields"))
    tree = n.groupBy("record_id").agg(
        F.count_if(F.col("kind") == "page").alias("pages"), F.count_if(block & root & ~discarded).alias("blocks"), F.count_if(block & root & discarded).alias("discarded"), F.count_if(block & ~root).alias("nested"), F.count_if(block).alias("nodes"),
        F.count_if(F.col("kind") == "line").alias("lines"), F.count_if(F.col("kind") == "span").alias("spans"), F.count_if(F.col("node").contains(":w")).alias("working"), F.count_if(again.isNull()).alias("unread"),
        (F.count("*") - F.countDistinct("node")).alias("repeated"),
    )
    stored = valid.select("record_id", F.sha2("payload", 256).alias("stored"))
    j = source.join(tree, "record_id", "left").join(stored, "record_id").na.fill(0)
    checks = [F.when(F.col("hash") != F.col("stored"), "payload_hash")] + [F.when(F.col(f"s_{c}") != F.col(c), f"{c}_count") for c in COUNTS]
    checks += [F.when(F.col("working") > 0, "preproc_not_in_tree"), F.when(F.col("unread") > 0, "round_trip"), F.when(F.col("repeated") > 0, "unique_keys")]
    return j.select("record_id", *[F.col(f"s_{c}").alias(c) for c in COUNTS], F.array_join(F.array_compact(F.array(*checks)), ",").alias("failed"))


DOCUMENT_METRICS = "pages long, content_blocks long, discarded_blocks long, lines long, spans long, text_characters long, images long, tables long, interline_equations long, inline_equations long, nodes_total long, block_types string, span_types string, root_keys string, has_version boolean"


def metrics_of(root: object) -> tuple:
    """The fifteen metrics of a document's tree; tables and equations by the greatest of their counters, as one may be block, span and HTML at once."""
    order = nested.walk(root)
    blocks = [(key, o) for _, _, key, kind, _, o, _ in order if kind == "block"]
    spans = [o for _, _, _, kind, _, o, _ in order if kind == "span"]
    kinds = [Counter(str(o.get("type") or "unknown") for o in side) for side in ([o for _, o in blocks], spans)]
    text = " ".join(" ".join(str(s.get("content") or s.get("text") or "") for s in spans).split())
    both = [*(o for _, o in blocks), *spans]
    html = sum("<table" in str(o.get("html") or "").casefold() for o in both)
    discarded = sum(key.split(":")[1][0] == "d" for key, _ in blocks)
    of = lambda name: (kinds[0][name], kinds[1][name])
    return (
        sum(kind == "page" for _, _, _, kind, _, _, _ in order), len(blocks) - discarded, discarded, sum(kind == "line" for _, _, _, kind, _, _, _ in order), len(spans), len(text), len({str(o["image_path"]) for o in both if o.get("image_path")}),
        max(*of("table"), html), max(of("interline_equation")), sum(of("inline_equation")), len(order), deepjson.dumps(kinds[0]), deepjson.dumps(kinds[1]), "|".join(sorted(root)) if isinstance(root, dict) else "", isinstance(root, dict) and bool(root.get("_version_name")),
    )


def document_metrics(records: DataFrame) -> DataFrame:
    from . import ir

    return _per_payload(ir.newest_valid(records).select("record_id", "payload"), ["record_id"], lambda payload: metrics_of(nested.parse(payload)), DOCUMENT_METRICS)


def metric_deltas(old: DataFrame, new: DataFrame) -> DataFrame:
    """``record_id, metric, old, new, delta`` of every number of two runs, null deltas where a record stands in one only, and the changed counts of block types as ``type:name`` rows."""
    numbers = [c for c, t in new.dtypes if t == "bigint" and c != "record_id"]

    def long(df, name):
        plain = F.map_from_arrays(F.array(*map(F.lit, numbers)), F.array(*numbers))
        types = F.transform_keys(F.from_json("block_types", "map<string,bigint>"), lambda k, _: F.concat(F.lit("type:"), k))
        return df.select("record_id", F.explode(F.map_concat(plain, types)).alias("metric", name))

    j = long(old, "old").join(long(new, "new"), ["record_id", "metric"], "full")
    typed = F.startswith(F.col("metric"), F.lit("type:"))
    filled = j.select("record_id", "metric", *[F.when(typed, F.coalesce(c, F.lit(0))).otherwise(F.col(c)).alias(c) for c in ("old", "new")])
    return filled.withColumn("delta", F.col("new") - F.col("old")).where(~F.startswith(F.col("metric"), F.lit("type:")) | (F.col("delta") != 0))
