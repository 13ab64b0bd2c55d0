"""Box geometry over structs (x1, y1, x2, y2); degenerate boxes have no area."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST_SIDE = 1e-6


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def from_corners(v: Column, first: int) -> Column:
    """A box of four array elements from `first` (0-based), its corners put in order."""
    e = [v[first + i].cast("double") for i in range(4)]
    return box(F.least(e[0], e[2]), F.least(e[1], e[3]), F.greatest(e[0], e[2]), F.greatest(e[1], e[3]))


def width(b: Column) -> Column:
    return F.greatest(b["x2"] - b["x1"], F.lit(LEAST_SIDE))


def height(b: Column) -> Column:
    return F.greatest(b["y2"] - b["y1"], F.lit(LEAST_SIDE))


def area(b: Column) -> Column:
    return width(b) * height(b)


def aspect(b: Column) -> Column:
    return width(b) / height(b)


def center(b: Column) -> tuple[Column, Column]:
    return (b["x1"] + b["x2"]) / 2, (b["y1"] + b["y2"]) / 2


def intersection(a: Column, b: Column) -> Column:
    w = F.greatest(F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]), F.lit(0.0))
    h = F.greatest(F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]), F.lit(0.0))
    return w * h


def raw_area(b: Column) -> Column:
    return F.greatest(b["x2"] - b["x1"], F.lit(0.0)) * F.greatest(b["y2"] - b["y1"], F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    i = intersection(a, b)
    return F.coalesce(F.try_divide(i, raw_area(a) + raw_area(b) - i), F.lit(0.0))


def containment(a: Column, b: Column) -> Column:
    """Intersection over the smaller area."""
    return F.coalesce(F.try_divide(intersection(a, b), F.least(raw_area(a), raw_area(b))), F.lit(0.0))


def union_box(a: Column, b: Column) -> Column:
    return box(F.least(a["x1"], b["x1"]), F.least(a["y1"], b["y1"]), F.greatest(a["x2"], b["x2"]), F.greatest(a["y2"], b["y2"]))


def duplicate(a: Column, b: Column) -> Column:
    """Two boxes of one thing: IoU 0.65, or containment 0.80 with an area ratio of 0.20."""
    ratio = F.coalesce(F.try_divide(F.least(raw_area(a), raw_area(b)), F.greatest(raw_area(a), raw_area(b))), F.lit(0.0))
    return (iou(a, b) >= 0.65) | ((containment(a, b) >= 0.80) & (ratio >= 0.20))


def center_distance(a: Column, b: Column) -> Column:
    (ax, ay), (bx, by) = center(a), center(b)
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def occludes(target: Column, other: Column) -> Column:
    return (iou(target, other) >= 0.05) | (containment(target, other) >= 0.15) | (center_distance(target, other) <= 0.65 * F.sqrt(area(target)))


# The weights of overlap, centre, area and aspect.
AFFINITY = {"overlap": 0.50, "centre": 0.25, "area": 0.15, "aspect": 0.10}


def affinity(previous: Column, current: Column, gap: Column) -> Column:
    """How well a normalised box continues a track after gap frames: overlap, centre, area and aspect, the centre's scale
    growing with the gap and the whole decaying with it. 0 where the boxes are apart or differ too much in area."""
    more = F.greatest(gap - 1, F.lit(0))
    shift, overlap = center_distance(previous, current), iou(previous, current)
    area_change = F.abs(F.ln(F.greatest(area(current), F.lit(1e-9)) / F.greatest(area(previous), F.lit(1e-9))))
    aspect_change = F.abs(F.ln(F.greatest(aspect(current), F.lit(1e-9)) / F.greatest(aspect(previous), F.lit(1e-9))))
    reach = shift / (0.10 + 0.04 * gap)
    value = AFFINITY["overlap"] * overlap + AFFINITY["centre"] * F.exp(-reach * reach) + AFFINITY["area"] * F.exp(-area_change / 0.50) + AFFINITY["aspect"] * F.exp(-aspect_change / 0.55)
    apart = (overlap < 0.005) & (shift > 0.16 + 0.06 * more)
    return F.when(apart | (area_change > 1.35 + 0.15 * more), F.lit(0.0)).otherwise(value * F.exp(-0.12 * more))
