"""Boxes ``[x0, y0, x1, y1]`` as arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bbox(c: Column) -> Column:
    """A box of exactly four numbers, else null."""
    a = F.transform(c, lambda x: x.try_cast("double"))
    return F.when((F.size(a) == 4) & F.forall(a, lambda x: x.isNotNull()), a)


def area(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b[2] - b[0]) * F.greatest(F.lit(0.0), b[3] - b[1])


def _size(c: list[Column]) -> Column:
    return F.greatest(F.lit(0.0), c[2] - c[0]) * F.greatest(F.lit(0.0), c[3] - c[1])


def bbox_columns(b: Column) -> list[Column]:
    w, h = F.greatest(F.lit(0.0), b[2] - b[0]), F.greatest(F.lit(0.0), b[3] - b[1])
    return [b[0].alias("x0"), b[1].alias("y0"), b[2].alias("x1"), b[3].alias("y1"), w.alias("width"), h.alias("height"), (w * h).alias("area")]


def iou(a: Column, b: Column) -> Column:
    """Intersection over union, 0 if either box is missing or the union is empty."""
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    union = area(a) + area(b) - w * h
    return F.when(a.isNull() | b.isNull() | (union <= 0), F.lit(0.0)).otherwise(w * h / F.nullif(union, F.lit(0.0)))


def candidate_boxes(b: Column, width: Column, height: Column) -> Column:
    """The box in page units and, where it fits the grid of 1000, scaled to the page; the first wins ties."""
    scaled = F.array(b[0] * width / 1000.0, b[1] * height / 1000.0, b[2] * width / 1000.0, b[3] * height / 1000.0)
    valid = (F.size(b) == 4) & (b[0] <= b[2]) & (b[1] <= b[3]) & (F.array_min(b) >= 0) & (F.array_max(b) < float("inf"))
    both = F.when(width.isNotNull() & height.isNotNull() & (F.array_max(b) <= 1000) & (scaled != b), F.array(b, scaled)).otherwise(F.array(b))
    return F.when(valid, both).otherwise(F.expr("cast(array() as array<array<double>>)"))


def corner_columns(df: DataFrame, box: str, name: str) -> DataFrame:
    """Instead of the box its corners ``name0`` to ``name3`` and ``name_area``, null if it is missing or not of four numbers."""
    out = df.withColumns({f"{name}{k}": F.when(F.size(box) == 4, F.get(box, F.lit(k))) for k in range(4)})
    c = [F.col(f"{name}{k}") for k in range(4)]
    return out.withColumn(f"{name}_area", F.when(F.size(box) == 4, _size(c))).drop(box)


def candidate_columns(df: DataFrame, box: str, width: str, height: str) -> DataFrame:
    """Instead of a box and its page's size the ``candidate_boxes`` as columns: ``p0`` to ``p3`` and ``p_area`` in page units, ``s0`` to ``s3`` and ``s_area`` scaled; null where there is none."""
    p, s = [F.col(f"p{k}") for k in range(4)], [F.col(f"s{k}") for k in range(4)]
    sound = (p[0] <= p[2]) & (p[1] <= p[3]) & (F.least(*p) >= 0) & (F.greatest(*p) < float("inf"))
    scaled = F.col("__ok") & (F.greatest(*p) <= 1000)
    out = df.withColumns({f"p{k}": F.when(F.size(box) == 4, F.get(box, F.lit(k))) for k in range(4)}).withColumn("__ok", F.coalesce(sound, F.lit(False)))
    out = out.withColumns({f"s{k}": F.when(scaled, p[k] * F.col(size) / 1000.0) for k, size in enumerate((width, height) * 2)})
    differs = (s[0] != p[0]) | (s[1] != p[1]) | (s[2] != p[2]) | (s[3] != p[3])
    return out.withColumns({"p_area": F.when(F.col("__ok"), _size(p)), "s_area": F.when(F.col(width).isNotNull() & F.col(height).isNotNull() & differs, _size(s))}).drop("__ok", box, width, height)


def shared(a: str, b: str) -> Column:
    """The area two boxes of corner columns share; of no meaning where one is missing."""
    at = lambda c, k: F.col(f"{c}{k}")
    side = lambda k: F.greatest(F.lit(0.0), F.least(at(a, k + 2), at(b, k + 2)) - F.greatest(at(a, k), at(b, k)))
    return side(0) * side(1)
