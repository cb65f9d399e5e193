"""Problem 7: splitting oversized items at natural boundaries.

Balanced targets: the least number of pieces that the size and the overlap allow
is computed, targets of equal length are placed, each is snapped to the
strongest boundary nearby, and a piece is added whenever a limit fails.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import structure

# Strength of a boundary: the position after the match, from paragraphs down to words.
_BOUNDARIES = (
    (5, re.compile(r"\n[ \t\r]*\n\s*")),
    (4, re.compile(r"\n+")),
    (3, re.compile(r"[.!?…]+[\"'”’)\]]*\s+")),
    (2, re.compile(r"[;:,–—]\s+")),
    (1, re.compile(r"\s+")),
)


def boundaries(text: str) -> tuple[list[int], dict[int, int]]:
    """Sorted positions where a piece may end naturally, and their strength."""
    strength: dict[int, int] = {}
    for s, pattern in _BOUNDARIES:
        for m in pattern.finditer(text):
            strength.setdefault(m.end(), s)
    strength.pop(len(text), None)
    strength.pop(0, None)
    return sorted(strength), strength


def _best(at: list[int], strength: dict[int, int], low: int, high: int, target: float) -> int | None:
    """The strongest boundary in [low, high], the nearest to the target among equals."""
    window = at[bisect_left(at, low) : bisect_right(at, high)]
    return max(window, key=lambda p: (strength[p], -abs(p - target), -p), default=None)


def _nearest(at: list[int], low: int, high: int, target: int) -> int | None:
    """The boundary in [low, high] nearest to the target, the lower one of two."""
    i = bisect_left(at, target)
    near = [p for p in at[max(0, i - 1) : i + 1] if low <= p <= high]
    if not near:
        window = at[bisect_left(at, low) : bisect_right(at, high)]
        return min(window, key=lambda p: (abs(p - target), p), default=None)
    return min(near, key=lambda p: (abs(p - target), p))


def _attempt(n: int, size: int, overlap: int, k: int, at: list[int], strength: dict[int, int], reach: float, grow: bool = False) -> list[tuple[int, int]] | None:
    """k pieces, or None if a limit fails; with ``grow`` a piece is added where one fails, which always ends, as ends advance."""
    out, start, last, left = [], 0, 0, k
    while left > 1 or grow and n - start > size:
        if grow:
            left = max(2, left, ceil((n - start - overlap) / (size - overlap)))
        goal = (n - start + (left - 1) * overlap) / left  # equal length of the pieces still to come
        if goal > size:
            return None
        target = start + goal
        slack = max(1.0, goal * reach)
        low = max(start, last) + 1  # each piece ends after the one before
        if low > n - 1:
            if grow:
                break
            return None
        end = _best(at, strength, max(low, int(target - slack)), min(start + size, int(target + slack), n - 1), target)
        if end is None:
            end = _nearest(at, low, min(start + size, n - 1), int(target)) or min(max(low, start + int(goal)), n - 1)
        out.append((start, end))
        last = end
        back = end
        if overlap:
            wanted = max(start + 1, end - overlap)
            back = _nearest(at, max(start + 1, end - min(2 * overlap, size - 1)), min(end, wanted + overlap // 2), wanted) or wanted
        start = back
        left -= 1
    if n - start > size:
        return None
    out.append((start, n))
    return out


def split(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """Half-open ranges of the pieces of a text.

    Every piece has at most ``size`` characters, the pieces cover the text
    without gaps, and each starts after the start of the one before. A text
    within the size, also an empty one, is one piece. An overlap of ``size`` or
    more is cut to ``size - 1``, so that pieces advance; a size below 1 is an error.

    When a limit fails, pieces are added: one, two, four and so on, as long as
    that stays below the number that adding each at the place of its failure gives.
    """
    if size < 1:
        raise ValueError("size must be positive")
    n = len(text)
    if n <= size:
        return [(0, n)]
    overlap = max(0, min(overlap, size - 1))
    at, strength = boundaries(text)
    k = max(2, ceil((n - overlap) / (size - overlap)))
    most = extra = 0
    grown = None
    while grown is None or k + extra < most:
        # wide windows find paragraph ends; if a limit fails, narrower ones keep closer to the targets
        for reach in (0.3, 0.15, 0.05):
            made = _attempt(n, size, overlap, k + extra, at, strength, reach)
            if made:
                return made
        if grown is None:
            grown = _attempt(n, size, overlap, k, at, strength, 0.05, grow=True)
            most = len(grown)
        extra = 2 * extra or 1
    return grown


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
    names = ["block_id", "piece", "n_pieces", "start", "length", "text"]
    for batch in batches:
        cols: list[list] = [[] for _ in names]
        for block, text, size, overlap in zip(*(batch.column(c).to_pylist() for c in ("block_id", "text", "chunk_size", "chunk_overlap"))):
            made = split(text, size, overlap)
            for k, (a, b) in enumerate(made):
                for col, x in zip(cols, (block, k, len(made), a, b - a, text[a:b])):
                    col.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)


def split_blocks(blocks: DataFrame, policies: DataFrame, whole: bool = True) -> DataFrame:
    """``block_id, piece, n_pieces, start, length, text`` of every block.

    Blocks within the size pass in the JVM as one piece; only oversized ones go
    to Python. Of the copies of a block the one loaded last counts. Without
    ``whole`` only oversized blocks are read on: the size is compared before
    copies are, so a block counts if any copy is beyond the size. The policies,
    one row a collection, are joined by what AQE finds smallest. Null texts give
    no piece, null overlaps count as 0; blocks of a collection without a policy
    pass whole; null ids give nothing.
    """
    policy = policies.groupBy("collection_slug").agg(F.min("chunk_size").alias("chunk_size"), F.max_by("chunk_overlap", -F.col("chunk_size")).alias("chunk_overlap"))
    loaded = ["loaded_at"] if "loaded_at" in blocks.columns else []
    rows = blocks.select("block_id", "collection_slug", "text", *loaded).where("block_id is not null and text is not null")
    if whole:
        rows = structure.distinct_blocks(rows, "collection_slug", "text")
    rows = rows.join(policy, "collection_slug", "left").withColumn("chunk_overlap", F.coalesce("chunk_overlap", F.lit(0)))
    over = (F.length("text") > F.col("chunk_size")) & (F.col("chunk_size") > 0)
    large = rows.where(over)
    if not whole:  # the size is compared first; only what is beyond it is shuffled
        large = structure.distinct_blocks(large, "text", "chunk_size", "chunk_overlap")
    pieces = large.select("block_id", "text", "chunk_size", "chunk_overlap").mapInArrow(_pieces, "block_id string, piece int, n_pieces int, start int, length int, text string")
    if not whole:
        return pieces
    small = rows.where(~F.coalesce(over, F.lit(False)))
    return pieces.unionByName(small.select("block_id", F.lit(0).alias("piece"), F.lit(1).alias("n_pieces"), F.lit(0).alias("start"), F.length("text").alias("length"), "text"))


def found(blocks: DataFrame, policies: DataFrame) -> DataFrame:
    """``block_id`` of the blocks the splitter had to cut."""
    return split_blocks(blocks, policies, whole=False).where("n_pieces > 1 and piece = 0").select("block_id").distinct()
