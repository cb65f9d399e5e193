"""Content lists: the second reading of a document, a list of pages, each a list of items."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import nested

# Keys whose values are no content, and what stands for block types in a content list.
NOT_CONTENT = ("attribute", "bbox", "image_path", "image_source", "item_type", "level", "list_type", "path", "score", "type")
ITEM_TYPE = {"text": "paragraph", "ref_text": "paragraph", "abstract": "paragraph", "interline_equation": "equation_interline", "header": "page_header", "footer": "page_footer", "aside_text": "page_aside_text"}
GRID = 1000.0


def content_strings(value: object) -> list[str]:
    """Strings under keys named content at any depth, in the order of the text; keys that hold no content are not entered."""
    out = []
    todo = [("", value)]
    while todo:
        key, v = todo.pop()
        if isinstance(v, str):
            if key == "content":
                out.append(v)
        elif isinstance(v, list):
            todo += [(key, x) for x in reversed(v)]
        elif isinstance(v, dict):
            todo += [(k, x) for k, x in reversed(v.items()) if k not in NOT_CONTENT]
    return out


def _box(value: object) -> list[float] | None:
    if not isinstance(value, list) or len(value) != 4:
        return None
    try:
        return [float(x) for x in value]
    except (TypeError, ValueError):
        return None


def items_of(root: object) -> Iterator[dict]:
    """Items of a content list; a page that is no list is one row with ``bad`` set, an item that is no object gives none but keeps its position."""
    order = 0
    for page, items in enumerate(root if isinstance(root, list) else []):
        if not isinstance(items, list):
            yield {"page": page, "bad": True}
            continue
        for ordinal, item in enumerate(items):
            if not isinstance(item, dict):
                continue
            content = item.get("content") if isinstance(item.get("content"), dict) else {}
            level = content.get("level")
            parts = content_strings(content)
            kind = item.get("type")
            yield {
                "page": page, "ordinal": ordinal, "global_order": order, "item": f"content-list-v2:p{page:04d}:i{ordinal:04d}", "type": kind if isinstance(kind, str) else None, "bbox": _box(item.get("bbox")),
                "text": " ".join(parts).strip(), "text_parts": parts, "level": level if isinstance(level, int) and not isinstance(level, bool) else None, "bad": False,
            }
            order += 1


_FIELDS = {"page": pa.int32(), "ordinal": pa.int32(), "global_order": pa.int32(), "item": pa.string(), "type": pa.string(), "bbox": pa.list_(pa.float64()), "text": pa.string(), "text_parts": pa.list_(pa.string()), "level": pa.int64(), "bad": pa.bool_()}
_DDL = "page int, ordinal int, global_order int, item string, type string, bbox array<double>, text string, text_parts array<string>, level bigint, bad boolean"


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at: list[int] = []
        rows: list[dict] = []
        for i, payload in enumerate(batch.column("__payload").to_pylist()):
            made = list(items_of(nested.parse(payload)))
            at += [i] * len(made)
            rows += made
        keys = [c for c in batch.schema.names if c != "__payload"]
        kept = batch.select(keys).take(pa.array(at, pa.int64()))
        yield pa.RecordBatch.from_arrays([*kept.columns, *(pa.array([r.get(c) for r in rows], t) for c, t in _FIELDS.items())], [*keys, *_FIELDS])


def content_items(frame: DataFrame, payload: str, *keys: str) -> DataFrame:
    """``keys`` and the items of content-list payloads; null payloads and such that are not valid JSON or no list give none."""
    ddl = ", ".join([*(f"`{c}` {t}" for c, t in frame.select(*keys).dtypes), _DDL])
    return frame.select(*keys, frame[payload].alias("__payload")).mapInArrow(_exploded, ddl)


def working_copies(root: object) -> list:
    """The content list that the working copies of a payload's pages are: boxes on the grid of 1000 where the page's size is known."""
    out: list = []
    for page in nested.pages_of(root) if isinstance(root, dict) else []:
        items = []
        if isinstance(page, dict):
            size = page_size(page)
            for b in nested._entries(page.get("preproc_blocks")):
                if not isinstance(b, dict):
                    items.append(None)
                    continue
                box = _box(b.get("bbox"))
                if box and size:
                    box = [round(x * GRID / s, 3) for x, s in zip(box, size * 2)]
                kind = b.get("type") or b.get("block_type")
                level = b.get("level")
                items.append({"type": ITEM_TYPE.get(kind, kind) if isinstance(kind, str) else None, "bbox": box, "content": {"level": level, "parts": [{"content": t} for t in nested.texts(b, "reconcile")]}})
        out.append(items)
    return out


def page_size(page: dict) -> tuple[float, float] | None:
    """Width and height as numbers above zero, from ``page_size`` or from fields of their own."""
    pair = page.get("page_size") if isinstance(page.get("page_size"), list) else [page.get("width"), page.get("height")]
    try:
        w, h = (float(x) for x in pair)
    except (TypeError, ValueError):
        return None
    return (w, h) if w > 0 and h > 0 else None
