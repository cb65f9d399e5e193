"""Markdown of documents from their blocks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import html_to_markdown_of
from . import nested, structure


def block_markdown(blocks: DataFrame) -> DataFrame:
    """Adds ``md``: headings with # up to six, equations between $$, code fenced, lists and tables as they stand."""
    level = F.least(F.lit(6), F.greatest(F.lit(1), F.coalesce("level", F.lit(1))))
    t = F.trim(F.coalesce("text", F.lit("")))
    md = (
        F.when(F.col("role") == "title", F.concat(F.repeat(F.lit("#"), level), F.lit(" "), F.regexp_replace(t, "\\s+", " ")))
        .when(F.col("role") == "equation", F.concat(F.lit("$$\n"), t, F.lit("\n$$")))
        .when(F.col("role") == "code", F.concat(F.lit("```\n"), t, F.lit("\n```")))
        .when(F.col("role").isin("figure", "chart") & (F.size("asset_ids") > 0), F.concat(F.lit("![]("), F.lit("<"), F.col("asset_ids")[0], F.lit(">)\n\n"), t))
        .otherwise(t)
    )
    return blocks.withColumn("md", F.when(t != "", md))


def markdown(blocks: DataFrame) -> DataFrame:
    """``document_id, markdown, n_blocks``: headers first, footers last, the flow joined by blank lines; a document
    without a heading gets its first line as one. Null and blank blocks give nothing."""
    b = block_markdown(structure.title_levels(blocks, "source_type", "asset_ids", texts=True)).where("md is not null")
    place = F.when(F.col("source_type") == "header", 0).when(F.col("source_type") == "footer", 2).otherwise(1)
    g = b.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct(place.alias("place"), "position", "md"))).alias("a"), F.max((F.col("role") == "title").cast("int")).alias("headed"))
    body = F.array_join(F.transform("a", lambda x: x["md"]), "\n\n")
    return g.select("document_id", F.when(F.col("headed") == 1, body).otherwise(F.concat(F.lit("# "), body)).alias("markdown"), F.size("a").alias("n_blocks"))


# ---- Markdown of payload trees --------------------------------------------------------------

INLINE, DISPLAY = ("inline_equation",), ("interline_equation", "equation")


def _filled(obj: dict, name: str) -> str:
    value = obj.get(name)
    return value if isinstance(value, str) else ""


def _own_markdown(block: dict, role: str, images: list[str]) -> str:
    """A block without its children: HTML before LaTeX before image before lines."""
    if _filled(block, "html"):
        out = html_to_markdown_of(block["html"])
    elif _filled(block, "latex"):
        out = f"$$\n{block['latex']}\n$$"
    elif _filled(block, "image_path"):
        images.append(block["image_path"])
        out = f"![](<{block['image_path']}>)"
    else:
        lines = []
        for line in nested._entries(block.get("lines")):
            parts = []
            for s in nested._entries(line.get("spans")) if isinstance(line, dict) else ():
                if not isinstance(s, dict):
                    continue
                kind, body = s.get("type"), _filled(s, "latex") or _filled(s, "content") or _filled(s, "text")
                if _filled(s, "html"):
                    parts.append(html_to_markdown_of(s["html"]))
                elif kind in INLINE and body:
                    parts.append(f"${body}$")
                elif (kind in DISPLAY or _filled(s, "latex")) and body:
                    parts.append(f"$$\n{body}\n$$")
                elif _filled(s, "image_path"):
                    images.append(s["image_path"])
                    parts.append(f"![](<{s['image_path']}>)")
                else:
                    parts.append(_filled(s, "text") or _filled(s, "content"))
            lines.append("".join(parts))
        out = "\n".join(x for x in lines if x) or _filled(block, "text") or _filled(block, "content")
    if out and role == "title":
        level = block.get("level")
        level = max(1, min(6, level)) if isinstance(level, int) and not isinstance(level, bool) else 1
        out = "#" * level + " " + out.replace("\n", "<br>\n")
    return out


def _block_tree(block: dict, images: list[str]) -> list[str]:
    """Parts of a block and its nested blocks in order; nesting may have any depth."""
    out, todo = [], [(block, "")]
    while todo:
        b, above = todo.pop()
        kind = b.get("type") or b.get("block_type")
        role = "title" if kind == "title" else above
        if part := _own_markdown(b, "title" if kind == "title" else "", images):
            out.append(part)
        todo += [(c, role) for c in reversed(nested._entries(b.get("blocks"))) if isinstance(c, dict)]
    return out


def tree_markdown(root: object) -> tuple[str, list[str]]:
    """Markdown of a payload and the images it names: headers first, the flow without page furniture, footers last; a text without a heading gets its first line as one."""
    first, flow, last, images = [], [], [], []
    for page in nested.pages_of(root) if isinstance(root, dict) else []:
        if not isinstance(page, dict):
            continue
        for b in nested._entries(page.get("discarded_blocks")):
            kind = b.get("type") if isinstance(b, dict) else None
            if kind in ("header", "footer"):
                (first if kind == "header" else last).extend(_block_tree(b, images))
        for b in nested._entries(page.get("para_blocks")):
            if isinstance(b, dict) and (b.get("type") or b.get("block_type")) not in structure.FURNITURE:
                flow += _block_tree(b, images)
    text = "\n\n".join([*first, *flow, *last])
    if text and not re.search(r"(?m)^\s{0,3}#{1,6}\s+\S", text):
        text = re.sub(r"(?m)^(?=\S)", "# ", text, count=1)
    return text + ("\n" if text else ""), list(dict.fromkeys(images))


def payload_markdown(records: DataFrame, assets: DataFrame, as_of: str, settle: int = 10) -> DataFrame:
    """``record_id, document_id, markdown, images, missing, render_status`` of the newest valid copy of each record.

    ``assets`` has ``document_id, path``; an image counts as there if its path, or
    its name alone, is. Status: ok; incomplete with missing images; skipped for a
    valid payload without any text; of records without a valid copy pending while the newest was
    received within ``settle`` seconds before ``as_of``, or none has come at all, and failed after that.
    """
    valid = nested.is_json(F.col("payload"))
    newest = F.max_by(F.struct("document_id", "payload"), F.when(valid, F.struct("received_at", "payload")))
    g = records.groupBy("record_id").agg(newest.alias("r"), F.max(F.when(F.col("payload").isNotNull(), F.col("received_at"))).alias("last"), F.max("document_id").alias("d"))

    def run(batches):
        import pandas as pd

        for pdf in batches:
            made = [tree_markdown(nested.parse(p)) for p in pdf.payload]
            yield pd.DataFrame({"record_id": pdf.record_id, "document_id": pdf.document_id, "ok": [isinstance(p, str) for p in pdf.payload], "last": pdf["last"], "markdown": [m.encode("utf-8", "replace").decode() for m, _ in made], "images": [i for _, i in made]})

    rows = g.select("record_id", F.coalesce("r.document_id", "d").alias("document_id"), "r.payload", "last")
    t = records.schema["received_at"].dataType.simpleString()
    made = rows.mapInPandas(run, f"record_id long, document_id string, ok boolean, last {t}, markdown string, images array<string>")
    wanted = made.select("record_id", "document_id", F.explode("images").alias("path"))
    names = assets.select("document_id", F.explode(F.array("path", F.substring_index("path", "/", -1))).alias("k")).distinct()
    held = wanted.withColumn("k", F.explode(F.array("path", F.substring_index("path", "/", -1)))).join(names, ["document_id", "k"], "left_semi").select("record_id", "path").distinct()
    missing = wanted.join(held, ["record_id", "path"], "left_anti").groupBy("record_id").agg(F.count("*").alias("missing"))
    j = made.join(missing, "record_id", "left").withColumn("missing", F.coalesce("missing", F.lit(0)))
    fresh = F.col("last").isNull() | (F.col("last").cast("timestamp") >= F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(settle)))
    status = F.when(~F.col("ok"), F.when(fresh, "pending").otherwise("failed")).when(F.col("missing") > 0, "incomplete").when(F.col("markdown") == "", "skipped").otherwise("ok")
    return j.select("record_id", "document_id", F.when(F.col("ok"), F.col("markdown")).alias("markdown"), "images", "missing", status.alias("render_status"))
