"""Scalar geometry as Catalyst expressions.

Boxes are passed as four columns (x1, y1, x2, y2) with exclusive extents (width = x2 - x1).
Polygons are ARRAY<STRUCT<x, y>>. Only the text of coordinates is a Python function at run time.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlens.functions.numbers import six_decimals

# Fixed values of the data format.
STRIDE_PX = 320
FRAME_STEM = r"^(\d+)_(\d+)$"
SPLIT_NAMES = ("train", "val", "test")

Box = tuple[Column, Column, Column, Column]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def box_cols(prefix: str = "") -> Box:
    return tuple(F.col(prefix + n) for n in ("x1", "y1", "x2", "y2"))


# -- frame keys and coordinate spaces ---------------------------------------


def frame_key(stem: Column | str) -> tuple[Column, Column]:
    """(board, frame) of a stem like ``12_345``; both null when the stem does not match."""
    stem = col(stem)
    ok = stem.rlike(FRAME_STEM)
    board = F.regexp_extract(stem, FRAME_STEM, 1).try_cast("int")
    frame = F.regexp_extract(stem, FRAME_STEM, 2).try_cast("int")
    ok = ok & board.isNotNull() & frame.isNotNull()
    return F.when(ok, board), F.when(ok, frame)


def file_stem(path: Column | str) -> Column:
    """File name without directory and last extension."""
    return F.regexp_extract(col(path), r"([^/]+?)(\.[^./]*)?$", 1)


def to_board_x(x: Column | str, frame: Column | str, stride: int = STRIDE_PX) -> Column:
    return col(x) + col(frame) * F.lit(stride)


def shift_polygon(polygon: Column | str, dx: Column) -> Column:
    return F.transform(
        col(polygon),
        lambda p: F.struct((p["x"] + dx).cast("int").alias("x"), p["y"].cast("int").alias("y")),
    )


# -- boxes -------------------------------------------------------------------


def yolo_corners(cx: Column, cy: Column, bw: Column, bh: Column, w: Column, h: Column) -> Box:
    """Normalised centre/size to pixel corners, in the type of the inputs."""
    px, py, pw, ph = cx * w, cy * h, bw * w, bh * h
    return px - pw / 2, py - ph / 2, px + pw / 2, py + ph / 2


def round_half_even(c: Column) -> Column:
    return F.rint(c).cast("int")


def round_half_away(c: Column) -> Column:
    """Half away from zero, for values of float32 precision (adding a half is then exact)."""
    d = c.cast("double")
    return (F.signum(d) * F.floor(F.abs(d) + 0.5)).cast("int")


def clip_box(box: Box, w: Column, h: Column) -> Box:
    x1, y1, x2, y2 = box
    zero = F.lit(0)
    return F.greatest(zero, x1), F.greatest(zero, y1), F.least(w, x2), F.least(h, y2)


def has_extent(box: Box) -> Column:
    x1, y1, x2, y2 = box
    return (x2 > x1) & (y2 > y1)


def bbox_iou(a: Box, b: Box) -> Column:
    """Float32 IoU. Touching or empty boxes give 0; the divisor is guarded for ANSI mode."""
    iw = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    ih = F.least(a[3], b[3]) - F.greatest(a[1], b[1])

    def area(w: Column, h: Column) -> Column:
        return w.cast("float") * h.cast("float")

    inter = area(iw, ih)
    union = area(a[2] - a[0], a[3] - a[1]) + area(b[2] - b[0], b[3] - b[1]) - inter
    ratio = F.try_divide(inter.cast("double"), union.cast("double")).cast("float")
    return F.when((iw > 0) & (ih > 0) & (union > 0), ratio).otherwise(F.lit(0.0).cast("float"))


def axial_gap(a: Box, b: Box) -> Column:
    zero = F.lit(0.0)
    gx = F.greatest(zero, F.greatest(a[0], b[0]) - F.least(a[2], b[2]))
    gy = F.greatest(zero, F.greatest(a[1], b[1]) - F.least(a[3], b[3]))
    return F.sqrt(gx * gx + gy * gy)


def min_side(box: Box) -> Column:
    return F.least(box[2] - box[0], box[3] - box[1])


def is_near(a: Box, b: Box, min_px: float = 5.0, rel: float = 0.25) -> Column:
    reach = F.greatest(F.lit(float(min_px)), F.lit(float(rel)) * F.least(min_side(a), min_side(b)))
    return axial_gap(a, b) <= reach


def edge_touch(box: Box, w: Column, h: Column, tol: float = 1.0) -> Column:
    t = F.lit(float(tol))
    return (box[0] <= t) | ((w - box[2]) <= t) | (box[1] <= t) | ((h - box[3]) <= t)


# -- polygons ----------------------------------------------------------------


def polygon_bbox(polygon: Column | str) -> Column:
    """STRUCT<x1, y1, x2, y2> of the vertex extremes."""
    xs, ys = col(polygon)["x"], col(polygon)["y"]
    return F.struct(
        F.array_min(xs).alias("x1"),
        F.array_min(ys).alias("y1"),
        F.array_max(xs).alias("x2"),
        F.array_max(ys).alias("y2"),
    )


def box_polygon(box: Box) -> Column:
    """Four vertices, clockwise from the top left."""
    x1, y1, x2, y2 = (c.cast("int") for c in box)

    def point(x: Column, y: Column) -> Column:
        return F.struct(x.alias("x"), y.alias("y"))

    return F.array(point(x1, y1), point(x2, y1), point(x2, y2), point(x1, y2))


def polygon_area(polygon: Column | str) -> Column:
    """Shoelace area of the vertex outline."""
    p = col(polygon)
    n = F.size(p)

    def cross(v: Column, i: Column) -> Column:
        nxt = F.element_at(p, F.pmod(i + 1, n).cast("int") + 1)
        return v["x"].cast("double") * nxt["y"] - nxt["x"].cast("double") * v["y"]

    total = F.aggregate(F.transform(p, cross), F.lit(0.0), lambda acc, v: acc + v)
    return F.when(n >= 3, F.abs(total) / 2).otherwise(F.lit(0.0))


@F.pandas_udf(T.StringType())
def _points_text(points: pd.Series, w: pd.Series, h: pd.Series) -> pd.Series:
    return pd.Series([None if p is None else six_decimals(p, x, y) for p, x, y in zip(points, w, h)], dtype=object)


def seg_text(polygon: Column | str, w: Column, h: Column, cls: Column | None = None) -> Column:
    """Normalised polygon label line, six decimals per coordinate."""
    flat = F.flatten(F.transform(col(polygon), lambda p: F.array(p["x"], p["y"])))
    head = (cls if cls is not None else F.lit(0)).cast("string")
    return F.concat_ws(" ", head, _points_text(flat, w, h))


# -- metrics -----------------------------------------------------------------


def safe_div(num: Column, den: Column) -> Column:
    """Float32 quotient, null unless the divisor is positive."""
    d = den.cast("double")
    return F.when(d > 0, (num.cast("double") / F.nullif(d, F.lit(0.0))).cast("float"))


def f1_score(p: Column, r: Column) -> Column:
    s = p + r
    value = (F.lit(2.0).cast("float") * p * r).cast("double") / F.nullif(s.cast("double"), F.lit(0.0))
    return F.when(s > 0, value.cast("float"))


# -- letterbox ----------------------------------------------------------------


def letterbox_params(w: Column, h: Column, target: int = 640) -> Column:
    """STRUCT<scale, pad_x, pad_y, net_size> of fitting (w, h) into a square."""
    t = F.lit(float(target)).cast("double")
    scale = F.least((t / h).cast("float"), (t / w).cast("float"))
    new_h = round_half_away(h.cast("float") * scale)
    new_w = round_half_away(w.cast("float") * scale)
    half = lambda side: F.floor((F.lit(target) - side) / 2).cast("int")
    return F.struct(
        scale.alias("scale"),
        half(new_w).alias("pad_x"),
        half(new_h).alias("pad_y"),
        F.lit(target).alias("net_size"),
    )


def inverse_letterbox(polygon: Column | str, lb: Column, w: Column, h: Column) -> Column:
    """Net pixels back to source pixels, rounded half away and clamped into the frame."""

    def back(v: Column, pad: Column, size: Column) -> Column:
        src = ((v - pad).cast("float").cast("double") / lb["scale"].cast("double")).cast("float")
        return F.least(F.greatest(round_half_away(src), F.lit(0)), size - 1)

    return F.transform(
        col(polygon),
        lambda p: F.struct(back(p["x"], lb["pad_x"], w).alias("x"), back(p["y"], lb["pad_y"], h).alias("y")),
    )


# -- tiers and quotas ----------------------------------------------------------


def tier_labels(cuts: list[float]) -> list[str]:
    """The bracket texts of ascending cuts, e.g. [-inf,10] (10,23] (23,inf]."""
    edges = ["-inf", *(f"{c:g}" for c in cuts), "inf"]
    return [f"{'[' if i == 0 else '('}{lo},{hi}]" for i, (lo, hi) in enumerate(zip(edges, edges[1:]))]


def tier_label(value: Column, cuts: list[float]) -> Column:
    labels = tier_labels(cuts)
    branches = list(zip(cuts, labels))
    first_cut, first_label = branches[0]
    expr = F.when(value <= first_cut, first_label)
    expr = reduce(lambda e, b: e.when(value <= b[0], b[1]), branches[1:], expr)
    return expr.otherwise(labels[-1])


def largest_remainder(n: Column, ratios: tuple[float, ...]) -> Column:
    """ARRAY<INT> quota per ratio: floors, then one more for the largest fractions."""
    raw = [n.cast("double") * F.lit(float(r)) for r in ratios]
    floors = [F.floor(r).cast("int") for r in raw]
    left = n.cast("int") - reduce(lambda a, b: a + b, floors)
    order = F.array_sort(
        F.array(*[F.struct((f - r).alias("neg"), F.lit(i).alias("i")) for i, (r, f) in enumerate(zip(raw, floors))])
    )
    lucky = F.slice(F.transform(order, lambda s: s["i"]), F.lit(1), left)
    return F.array(*[f + F.array_contains(lucky, F.lit(i)).cast("int") for i, f in enumerate(floors)])


# -- colour ----------------------------------------------------------------------

# The ITU-R 601-2 luma weights in 16-bit fixed point, and the rounding term.
LUMA_R, LUMA_G, LUMA_B, LUMA_HALF = 19595, 38470, 7471, 0x8000


def luminance(r: Column, g: Column, b: Column) -> Column:
    return F.shiftright(r * LUMA_R + g * LUMA_G + b * LUMA_B + LUMA_HALF, 16)


def chroma(r: Column, g: Column, b: Column) -> Column:
    return F.greatest(r, g, b) - F.least(r, g, b)
