"""Two readings of one document: items of the second matched one-to-one with blocks of the first.

Candidates share a page. A candidate's score is 0.55 of the boxes' overlap, 0.35
of the texts' similarity and 0.10 of type compatibility; items take blocks in
their order, a block is taken once, and scores below 0.35 do not match. State
never crosses a page, so each page is folded on its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry
from ..functions.text import normalize_text, sequence_ratio_of

# Weights, thresholds, and block types that fit an item's type.
WEIGHTS, ACCEPT, MARGIN, RIVAL = (0.55, 0.35, 0.10), 0.35, 0.05, 0.5
COMPATIBLE = {
    "algorithm": ("algorithm", "code"), "chart": ("chart", "image"), "code": ("code",), "equation_interline": ("interline_equation", "equation"), "image": ("image",), "index": ("index", "list"), "list": ("list", "index"),
    "page_aside_text": ("aside_text",), "page_footer": ("footer",), "page_footnote": ("page_footnote",), "page_header": ("header",), "page_number": ("page_number",), "paragraph": ("text", "paragraph", "abstract", "ref_text"),
    "table": ("table",), "title": ("title",),
}


def confidence(score: Column) -> Column:
    return F.when(score >= 0.85, "high").when(score >= 0.65, "medium").otherwise("low")


def _iou(a, b) -> float:
    if a is None or b is None:
        return 0.0
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    inter = max(0.0, w) * max(0.0, h)
    size = lambda x: max(0.0, x[2] - x[0]) * max(0.0, x[3] - x[1])
    union = size(a) + size(b) - inter
    return inter / union if union else 0.0


def _most_ratio(a: str, b: str) -> float:
    """An upper bound of the similarity of two texts from the letters they hold."""
    if not a or not b:
        return 0.0
    return 2.0 * sum((Counter(a) & Counter(b)).values()) / (len(a) + len(b))


def box_candidates(box: list[float] | None, size: tuple[float, float] | None) -> list[tuple[str, list[float]]]:
    """The box in page units, and on the grid of 1000 scaled to the page; none if it is not sound."""
    if not box or any(not math.isfinite(x) or x < 0 for x in box) or box[0] > box[2] or box[1] > box[3]:
        return []
    out = [("page_units", list(box))]
    if size and max(box) <= 1000:
        scaled = [x * s / 1000.0 for x, s in zip(box, (*size, *size))]
        if scaled != box:
            out.append(("normalized_0_1000", scaled))
    return out


def overlap(boxes: list[tuple[str, list[float]]], where: list[float] | None) -> tuple[str, float]:
    """Space and overlap of the candidate box that fits best, the first of equals."""
    return max(((space, _iou(b, where)) for space, b in boxes), key=lambda x: x[1], default=("unavailable", 0.0))


class Match(NamedTuple):
    item: str
    block: str | None = None
    score: float | None = None
    margin: float | None = None
    iou: float | None = None
    space: str | None = None
    ratio: float | None = None
    compatible: bool | None = None
    ambiguous: bool = False
    usable: bool = False


def assign(items: list[tuple], blocks: list[tuple]) -> list[Match]:
    """A match for each of the items ``(id, type, candidate boxes, text)`` in order, with blocks ``(id, type, box, text)``.

    Candidates are taken by what they could score at most; texts are compared
    only while one could still be the best or the second, and only if one could be
    accepted at all, so the result is that of comparing all.
    """
    free = dict.fromkeys(range(len(blocks)))
    out = []
    for item, kind, boxes, text in items:
        fits = COMPATIBLE.get(kind, ())
        bounds = []
        for i in free:
            _, own, where, words = blocks[i]
            (space, iou), compatible = overlap(boxes, where), own in fits
            least = WEIGHTS[0] * iou + WEIGHTS[2] * compatible
            most = least + WEIGHTS[1] * (2.0 * min(len(text), len(words)) / (len(text) + len(words)) if text and words else 0.0)
            bounds.append((most, least, iou, space, compatible, i))
        bounds.sort(key=lambda x: (-x[0], x[-1]))
        ranked: list[tuple] = []
        top: list[float] = []  # the two best scores so far
        for most, least, iou, space, compatible, i in bounds if bounds and bounds[0][0] >= ACCEPT - 1e-9 else ():
            floor = top[-1] - 1e-9 if len(top) == 2 else -1.0
            if most < floor:
                break
            block, _, _, words = blocks[i]
            if text and words and least + WEIGHTS[1] * _most_ratio(text, words) < floor:
                continue
            ratio = sequence_ratio_of(text, words) if text and words else 0.0
            score = least + WEIGHTS[1] * ratio
            top = sorted((*top, score), reverse=True)[:2]
            ranked.append((-score, -iou, -ratio, block, i, space, compatible))
        ranked.sort(key=lambda x: x[:4])
        if not ranked or -ranked[0][0] < ACCEPT:
            out.append(Match(item))
            continue
        score, iou, ratio, block, i, space, compatible = ranked[0]
        score, iou, ratio = -score, -iou, -ratio
        margin = score + ranked[1][0] if len(ranked) > 1 else score
        ambiguous = len(ranked) > 1 and margin < MARGIN and -ranked[1][1] >= RIVAL
        usable = not ambiguous and (score >= 0.65 or iou >= 0.8 and compatible)
        del free[i]
        out.append(Match(item, block, round(score, 6), round(margin, 6), round(iou, 6), space, round(ratio, 6), compatible, ambiguous, usable))
    return out


_MATCH = "record_id long, page string, item string, block string, score double, margin double, iou double, space string, ratio double, compatible boolean, ambiguous boolean, usable boolean"


def greedy(items: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row per item: ``record_id, page, item, block, score, margin, iou, space, ratio, compatible, ambiguous, usable``.

    Both sides have ``record_id, page, id, ordinal, type, bbox, text``, blocks in
    the order of ``ordinal``; items may have ``width`` and ``height`` of their page, which
    opens the second space of coordinates. Texts are compared in one form. A
    page's items and blocks are what a task holds.
    Items of pages without blocks come out unmatched; null texts have no similarity.
    """
    cols = ["record_id", "page", "id", "ordinal", "type", "bbox"]
    size = ["width", "height"] if "width" in items.columns else [F.lit(None).cast("double").alias(c) for c in ("width", "height")]
    both = items.select(*cols, normalize_text("text").alias("text"), F.lit(True).alias("item"), *size)
    both = both.unionByName(blocks.select(*cols, normalize_text("text").alias("text"), F.lit(False).alias("item"), *[F.lit(None).cast("double").alias(c) for c in ("width", "height")]))
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.string(), pa.float64(), pa.bool_(), pa.bool_(), pa.bool_()]
    names = [c.split()[0] for c in _MATCH.split(", ")]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages of a sorted partition one after the other; a page may reach across batches."""

        def close(key, rows):
            found = [(r["id"], r["type"], box_candidates(r["bbox"], (r["width"], r["height"]) if r["width"] and r["height"] else None), r["text"]) for r in rows if r["item"]]
            return [(*key, *m) for m in assign(found, [(r["id"], r["type"], r["bbox"], r["text"]) for r in rows if not r["item"]])]

        def batch_of(made):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), kinds)], names)

        held, rows = None, []
        for batch in batches:
            made = []
            for r in batch.to_pylist():
                key = (r["record_id"], r["page"])
                if key != held:
                    made += close(held, rows) if rows else []
                    held, rows = key, []
                rows.append(r)
            if made:
                yield batch_of(made)
        if rows and (made := close(held, rows)):
            yield batch_of(made)

    ordered = both.repartition("record_id", "page").sortWithinPartitions("record_id", "page", "ordinal", "id")
    return ordered.mapInArrow(fold, _MATCH)


def divergences(match: DataFrame, texts: DataFrame) -> DataFrame:
    """Matches with the comma-separated points in which the readings differ; ``texts`` has ``record_id, item, has_text``."""
    marks = F.array_compact(
        F.array(
            F.when(~F.col("compatible"), "type_mismatch"), F.when(F.col("iou") < 0.8, "bbox_iou_below_0_8"), F.when(F.coalesce("has_text", F.lit(False)) & (F.col("ratio") < 0.8), "text_similarity_below_0_8"), F.when(F.col("ambiguous"), "ambiguous_candidate")
        )
    )
    return match.where("block is not null").join(texts, ["record_id", "item"], "left").select(*match.columns, confidence(F.col("score")).alias("label"), F.array_join(marks, ",").alias("divergences"))


def candidates(items: DataFrame, blocks: DataFrame) -> DataFrame:
    """All pairs of one page with their overlap in the better space, in the JVM; a page bounds them.

    ``space`` is 0 for page units, 1 for the grid of 1000, null where the item's box is not sound.
    Boxes go into the join as plain numbers with their area, and what a pair needs more
    than once is a column of its own, so that each is worked out once.
    """
    wide = items if "width" in items.columns else items.withColumn("width", F.lit(None).cast("double")).withColumn("height", F.lit(None).cast("double"))
    a = geometry.candidate_columns(wide.select("record_id", "page", F.col("id").alias("item"), F.col("type").alias("item_type"), "bbox", "width", "height"), "bbox", "width", "height")
    b = geometry.corner_columns(blocks.select("record_id", "page", F.col("id").alias("block"), F.col("type").alias("block_type"), "bbox"), "bbox", "b")
    pairs = a.join(b, ["record_id", "page"])
    kept = ["record_id", "page", "item", "item_type", "block", "block_type"]
    for made in ({"i1": geometry.shared("p", "b"), "i2": geometry.shared("s", "b")}, {"u1": F.col("p_area") + F.col("b_area") - F.col("i1"), "u2": F.col("s_area") + F.col("b_area") - F.col("i2")}):
        pairs = pairs.withColumns(made)
    share = lambda k: F.when(F.col(f"u{k}") > 0, F.col(f"i{k}") / F.col(f"u{k}")).otherwise(0.0)
    pairs = pairs.select(*kept, F.col("p_area").isNotNull().alias("sound"), share(1).alias("first"), share(2).alias("second"))
    return pairs.select(*kept, F.greatest("first", "second").alias("iou"), F.when(F.col("sound"), (F.col("second") > F.col("first")).cast("int")).alias("space"))


def compatible(item_type: Column, block_type: Column) -> Column:
    out = F.lit(False)
    for kind, fits in COMPATIBLE.items():
        out = out | ((item_type == kind) & block_type.isin(*fits))
    return F.coalesce(out, F.lit(False))


def scored(pairs: DataFrame, ratio: Column) -> DataFrame:
    """Candidates with their ``compatible`` flag and ``score``; ``ratio`` is the texts' similarity."""
    fits = compatible(F.col("item_type"), F.col("block_type"))
    score = WEIGHTS[0] * F.col("iou") + WEIGHTS[1] * ratio + F.when(fits, WEIGHTS[2]).otherwise(0.0)
    return pairs.withColumn("ratio", ratio).withColumn("compatible", fits).withColumn("score", score)


def best_and_margin(scores: DataFrame) -> DataFrame:
    """Per item the candidate of the greatest score, its lead over the next, and whether the two are ambiguous: the lead below 0.05 and the next one's boxes overlapping by half. Exact while no block is consumed."""
    w = Window.partitionBy("record_id", "page", "item").orderBy(F.desc("score"), F.desc("iou"), F.desc("ratio"), "block")
    ranked = scores.withColumn("rank", F.row_number().over(w)).withColumn("next", F.lead(F.struct("score", "iou")).over(w))
    lead = F.col("score") - F.coalesce(F.col("next.score"), F.lit(0.0))
    return ranked.where("rank = 1").select("record_id", "page", "item", "block", F.round("score", 6).alias("score"), F.round(lead, 6).alias("margin"), F.coalesce((lead < MARGIN) & (F.col("next.iou") >= RIVAL), F.lit(False)).alias("ambiguous"))


def counts(matches: DataFrame) -> DataFrame:
    hit = F.col("block").isNotNull()
    return matches.groupBy("record_id").agg(
        F.count("*").alias("items"), F.count_if(hit).alias("matched"), F.count_if(hit & F.col("block").rlike(":d\\d+$")).alias("matched_discarded"), F.count_if("ambiguous").alias("ambiguous"), F.count_if("usable").alias("usable"), F.min("score").alias("score_min"), F.round(F.avg("score"), 6).alias("score_mean"),
        *[F.count_if(hit & (confidence(F.col("score")) == label)).alias(label) for label in ("high", "medium", "low")],
    )


def unmatched_items(matches: DataFrame, items: DataFrame) -> DataFrame:
    """Items that took no block, with the hash of their text."""
    left = items.join(matches.where("block is not null").select("record_id", F.col("item").alias("id")), ["record_id", "id"], "left_anti")
    return left.select("record_id", "page", "id", "ordinal", "type", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def unmatched_blocks(matches: DataFrame, blocks: DataFrame) -> DataFrame:
    used = matches.where("block is not null").select("record_id", F.col("block").alias("id"))
    return blocks.select("record_id", "page", "id").join(used, ["record_id", "id"], "left_anti")
