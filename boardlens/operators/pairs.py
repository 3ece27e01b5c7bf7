"""Box pairs that overlap or lie near each other, through a grid of cells.

A box is copied to the grid cells it touches and joined per cell, so a long board or a busy frame
is spread over many keys. A pair is reported only by the cell that holds the lower corner of its
intersection, which makes a distinct step unnecessary. Equal boxes are collapsed with a count
before any join: a pile of copies is one row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlens.functions.geometry import bbox_iou, box_cols, is_near, min_side
from boardlens.operators.batches import Work, whole_groups
from boardlens.operators.components import connected_components
from boardlens.operators.grouped import iou_of, linked_boxes, near_of, reach_of
from boardlens.operators.lineage import cut
from boardlens.operators.ranking import rank_by_id

BOX = ["x1", "y1", "x2", "y2"]
CELL_PX = 128
GROUP_BOXES = 1 << 12  # larger groups are spread over the grid


def distinct_boxes(boxes: DataFrame, on: list[str], id_col: str) -> DataFrame:
    """One row per distinct box and group: the smallest id and the number of copies."""
    return boxes.groupBy(*on, *BOX).agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("copies"))


def pile_members(boxes: DataFrame, on: list[str], id_col: str) -> DataFrame:
    """Equal boxes: on, first_id (the smallest of the pile), rank, id, for every box of a pile of two or more.

    Pairs name the first of equal boxes; joined with this table they name them all.
    """
    piles = distinct_boxes(boxes, on, id_col).filter("copies > 1").select(*on, *BOX, F.col(id_col).alias("first_id"))
    members = boxes.select(*on, *BOX, F.col(id_col).alias(id_col)).join(piles, [*on, *BOX])
    return rank_by_id(members, [*on, "first_id"], id_col, "rank").select(*on, "first_id", "rank", id_col)


def _cells(df: DataFrame, on: list[str], side: str, cell: int, pad: Column | None) -> DataFrame:
    x1, y1, x2, y2 = box_cols()
    payload = [F.col(c).alias(side + c) for c in df.columns if c not in on]
    extent = _extent(side, pad)
    if pad is not None:
        payload += [c.alias(n) for c, n in zip((x1 - pad, y1 - pad, x2 + pad, y2 + pad), extent)]
    cells = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell)))
    out = df.select(*on, *payload).withColumn("_cx", cells(extent[0], extent[2]))
    return out.withColumn("_cy", cells(extent[1], extent[3]))


def _extent(side: str, pad: Column | None) -> list[str]:
    """Columns that bound what a box reaches; its own corners if it is not grown."""
    return [side + c for c in (BOX if pad is None else ("lo_x", "lo_y", "hi_x", "hi_y"))]


def overlap_pairs(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    cell: int = CELL_PX,
    pad: Column | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """Pairs whose boxes, grown by ``pad`` on each side, touch or overlap.

    Columns of the two sides come back with prefixes ``a_`` and ``b_``; ``keep`` is an extra
    condition over them.
    """
    a, b = _cells(left, on, "a_", cell, pad), _cells(right, on, "b_", cell, pad)
    (ax1, ay1, ax2, ay2), (bx1, by1, bx2, by2) = _extent("a_", pad), _extent("b_", pad)
    lo_x, hi_x = F.greatest(ax1, bx1), F.least(ax2, bx2)
    lo_y, hi_y = F.greatest(ay1, by1), F.least(ay2, by2)
    hit = (hi_x >= lo_x) & (hi_y >= lo_y)
    home = (F.floor(lo_x / cell) == F.col("_cx")) & (F.floor(lo_y / cell) == F.col("_cy"))
    cond = hit & home if keep is None else hit & home & keep
    grown = [] if pad is None else [*_extent("a_", pad), *_extent("b_", pad)]
    return a.join(b, [*on, "_cx", "_cy"]).filter(cond).drop("_cx", "_cy", *grown)


def iou_pairs(boxes: DataFrame, threshold: float, on: list[str], id_col: str, cell: int = CELL_PX) -> DataFrame:
    """Pairs of distinct boxes with IoU >= threshold (> 0): on, a_<id>, b_<id>, copies, iou."""
    unique = distinct_boxes(boxes, on, id_col)
    pairs = overlap_pairs(unique, unique, on, cell, keep=F.col("a_" + id_col) < F.col("b_" + id_col))
    iou = bbox_iou(box_cols("a_"), box_cols("b_"))
    return (
        pairs.withColumn("iou", iou)
        .filter((F.col("iou") >= F.lit(float(threshold)).cast("float")) & (F.col("iou") > 0))
        .select(*on, "a_" + id_col, "b_" + id_col, "a_copies", "b_copies", "iou")
    )


def near_pairs(
    boxes: DataFrame,
    on: list[str],
    id_col: str,
    min_px: float = 5.0,
    rel: float = 0.25,
    cell: int = CELL_PX,
) -> DataFrame:
    """Pairs of distinct boxes whose gap is within reach: on, a_<id>, b_<id>, copies.

    The reach of a pair is at most the own reach of either box, so growing both by half their own
    reach makes every near pair touch.
    """
    unique = distinct_boxes(boxes, on, id_col)
    pad = F.greatest(F.lit(float(min_px)), F.lit(float(rel)) * min_side(box_cols())) / 2 + F.lit(1e-6)
    near = is_near(box_cols("a_"), box_cols("b_"), min_px, rel)
    pairs = overlap_pairs(unique, unique, on, cell, pad, keep=(F.col("a_" + id_col) < F.col("b_" + id_col)) & near)
    return pairs.select(*on, "a_" + id_col, "b_" + id_col, "a_copies", "b_copies")


def _level(size: Column) -> Column:
    """Whole powers of two in a size of 1 or more, else -1."""
    return F.when(size >= 1, F.floor(F.log2(size.cast("double")))).otherwise(F.lit(-1)).cast("int")


def _linked_groups(unique: DataFrame, on: list[str], id_col: str, alike: list[Column], linked: Column, cell: int, pad: Column | None = None) -> DataFrame:
    """``unique`` with ``comp``, the smallest id of the group that links connect a box to; crowds are never paired.

    Boxes that agree on ``alike`` are surely ``linked`` (a condition over columns ``a_`` and ``b_``), so they are tied to the first of
    them. The firsts are paired over the grid: at most one for each key, however many boxes share it. What may be left are links
    of other boxes between different groups found so; only grid cells with several groups are looked at, and there the boxes
    of all groups but the largest.
    """
    unique = cut(unique)
    keys = [f"_k{i}" for i in range(len(alike))]
    keyed = unique.withColumns(dict(zip(keys, alike, strict=True)))
    box = F.struct(id_col, *BOX)
    lows = keyed.groupBy(*on, *keys).agg(F.min_by(box, id_col).alias("_low"), F.count(F.lit(1)).alias("_n"))
    a_id, b_id = "a_" + id_col, "b_" + id_col
    firsts = lows.select(*on, "_low.*")
    ties = cut(
        keyed.join(lows.filter("_n > 1").select(*on, *keys, F.col("_low")[id_col].alias("_first")), [*on, *keys])
        .filter(F.col(id_col) != F.col("_first")).select(*on, F.col("_first").alias(a_id), F.col(id_col).alias(b_id))
    )
    pairs = overlap_pairs(firsts, firsts, on, cell, pad, keep=(F.col(a_id) < F.col(b_id)) & linked).select(*on, a_id, b_id)
    groups = connected_components(unique, ties.unionByName(pairs), on, id_col, a_id, b_id)
    if ties.isEmpty():
        return groups
    groups = cut(groups.join(ties.select(*on, F.col(b_id).alias(id_col), F.lit(True).alias("_tied")), [*on, id_col], "left"))
    at = [*on, "_cx", "_cy"]
    side = lambda s: _cells(groups.select(*on, id_col, *BOX, "comp", "_tied"), on, s, cell, pad)
    held = side("a_").groupBy(*at, "a_comp").agg(F.count(F.lit(1)).alias("_n"))
    mixed = held.groupBy(*at).agg(F.max_by("a_comp", F.struct("_n", "a_comp")).alias("_most"), F.count(F.lit(1)).alias("_groups"))
    mixed = cut(mixed.filter("_groups > 1").drop("_groups"))
    minor = side("a_").join(mixed, at).filter("a_comp <> _most")
    others = side("b_").join(mixed.drop("_most"), at, "left_semi")
    (ax1, ay1, ax2, ay2), (bx1, by1, bx2, by2) = _extent("a_", pad), _extent("b_", pad)
    hit = (F.least(ax2, bx2) >= F.greatest(ax1, bx1)) & (F.least(ay2, by2) >= F.greatest(ay1, by1))
    unseen = F.coalesce("a__tied", "b__tied", F.lit(False))  # two firsts have been compared
    met = minor.join(others, at).filter((F.col("a_comp") != F.col("b_comp")) & unseen & hit & linked)
    more = cut(met.select(*on, F.least("a_comp", "b_comp").alias("_a"), F.greatest("a_comp", "b_comp").alias("_b")).distinct())
    groups = groups.drop("_tied")
    if more.isEmpty():
        return groups
    groups = groups.withColumnRenamed("comp", "_a")
    joined = connected_components(groups.select(*on, "_a").distinct(), more, on, "_a", "_a", "_b")
    return groups.join(joined, [*on, "_a"]).select(*unique.columns, "comp")


def large_groups(boxes: DataFrame, on: list[str]) -> DataFrame | None:
    """The groups of more boxes than one task looks at together, none if there are none."""
    large = cut(boxes.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > GROUP_BOXES).select(*on))
    return None if large.isEmpty() else large


def _grouped(
    boxes: DataFrame, on: list[str], id_col: str, work: Work, spread: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Groups of linked boxes: small groups a batch at a time inside tasks, large ones by ``spread`` over the whole cluster."""
    boxes = cut(boxes.select(*on, id_col, *BOX))
    large = large_groups(boxes, on)
    small = boxes if large is None else boxes.join(large, on, "left_anti")
    ids = T.StructType([T.StructField(c, T.LongType()) for c in ("copies", "comp")])
    schema = T.StructType([*(boxes.schema[c] for c in (*on, *BOX, id_col)), *ids])
    found = whole_groups(small, on, [*BOX, id_col], work, schema)
    return found if large is None else found.unionByName(spread(boxes.join(large, on, "left_semi")).select(*found.columns))


def near_groups(boxes: DataFrame, on: list[str], id_col: str, min_px: float = 5.0, rel: float = 0.25, cell: int = CELL_PX) -> DataFrame:
    """Distinct boxes with the group that near boxes connect them to: on, id, box, copies, comp.

    Boxes of one size level (powers of two of the shorter side) whose corners share a cell of half the level's reach are
    surely near. The work is linear in the boxes of a crowded frame.
    """
    side = min_side(box_cols())
    level = _level(side)
    fine = F.greatest(F.lit(float(min_px)), F.when(level >= 0, F.lit(float(rel)) * F.pow(F.lit(2.0), level)).otherwise(F.lit(0.0))) / 2
    place = lambda c: F.when(fine > 0, F.floor(F.col(c) / fine)).otherwise(F.col(id_col).cast("bigint"))
    pad = F.greatest(F.lit(float(min_px)), F.lit(float(rel)) * side) / 2 + F.lit(1e-6)
    near = is_near(box_cols("a_"), box_cols("b_"), min_px, rel)
    spread = lambda df: _linked_groups(distinct_boxes(df, on, id_col), on, id_col, [level, place("x1"), place("y1")], near, cell, pad)
    work = linked_boxes(on, id_col, lambda a, b: near_of(a, b, min_px, rel), lambda box: reach_of(box, min_px, rel))
    return _grouped(boxes, on, id_col, work, spread)


def iou_groups(boxes: DataFrame, threshold: float, on: list[str], id_col: str, cell: int = CELL_PX) -> DataFrame:
    """Distinct boxes with the group that IoU >= threshold (> 0) connects them to: on, id, box, copies, comp.

    Boxes of one size level whose edges agree to a share of their width and height, chosen by the threshold, surely have that IoU.
    """
    x1, y1, x2, y2 = box_cols()
    share = (1 - (min(threshold, 1.0) * (1 + 1e-5)) ** 0.5) / 2
    keys = []
    for low, high in ((x1, x2), (y1, y2)):
        level = _level(high - low)
        step = F.lit(share) * F.pow(F.lit(2.0), level)
        keys.append(level)
        keys += [F.when((level >= 0) & F.lit(share > 0), F.floor(e / step)).otherwise(F.col(id_col).cast("bigint")) for e in (low, high)]
    iou = bbox_iou(box_cols("a_"), box_cols("b_"))
    linked = (iou >= F.lit(float(threshold)).cast("float")) & (iou > 0)
    least = np.float32(threshold)
    alike = lambda a, b: (lambda v: (v >= least) & (v > 0))(iou_of(a, b))
    spread = lambda df: _linked_groups(distinct_boxes(df, on, id_col), on, id_col, keys, linked, cell)
    return _grouped(boxes, on, id_col, linked_boxes(on, id_col, alike, lambda box: 0), spread)


def frames_with_cluster(
    boxes: DataFrame, on: list[str], id_col: str, min_px: float = 5.0, rel: float = 0.25
) -> DataFrame:
    """Groups that hold at least two near boxes.

    Tasks look at small groups whole, a batch at a time. Of large ones, two boxes whose top-left corners share a cell of side min_px / 2 are
    near whatever their size, so crowded groups are settled by counting, and only groups with at most one box per such cell go
    on to the pair join, which bounds the population of a join cell by its area.
    """
    spread = lambda df: _spread_clusters(df, on, id_col, min_px, rel).select(*on, *[F.lit(None).alias(c) for c in (*BOX, id_col)], F.lit(2).alias("copies"), F.lit(0).alias("comp"))
    work = linked_boxes(on, id_col, lambda a, b: near_of(a, b, min_px, rel), lambda box: reach_of(box, min_px, rel))
    return _grouped(boxes, on, id_col, work, spread).filter((F.col("copies") > 1) | (F.col("comp") != F.col(id_col))).select(*on).distinct()


def _spread_clusters(boxes: DataFrame, on: list[str], id_col: str, min_px: float, rel: float) -> DataFrame:
    """The same for groups of any size."""
    if min_px <= 0:
        return near_pairs(boxes, on, id_col, min_px, rel).select(*on).distinct()
    fine = float(min_px) / 2
    by_corner = boxes.groupBy(
        *on, F.floor(F.col("x1") / fine).alias("_fx"), F.floor(F.col("y1") / fine).alias("_fy")
    ).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(id_col, *BOX)).alias("_box"))
    crowd = F.max("_n").over(Window.partitionBy(*on))  # one row per occupied cell of the group
    cells = by_corner.withColumn("_crowd", crowd)
    crowded = cells.filter("_crowd > 1").select(*on)
    sparse = cells.filter("_crowd = 1").select(*on, "_box.*")
    paired = near_pairs(sparse, on, id_col, min_px, rel).select(*on)
    return crowded.unionByName(paired).distinct()
