"""Board and dataset statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlens.functions.geometry import STRIDE_PX, bbox_iou, box_cols, edge_touch, to_board_x
from boardlens.operators.pairs import (
    distinct_boxes,
    frames_with_cluster,
    iou_groups,
    near_groups,
    overlap_pairs,
)
from boardlens.operators.ranking import with_next

FRAME = ["board", "frame"]
BOARD_SORT_KEYS = ("board", "frames", "gaps", "span", "first", "last", "annots")
DUPLICATE_IOU = 0.5
SMALL_STRATUM = 10


def board_features(
    frames: DataFrame, boxes: DataFrame, near_gap_min_px: float = 5.0, near_gap_rel: float = 0.25, id_col: str = "ann_id"
) -> DataFrame:
    """board, frames, cluster_frac: the share of image frames with a group of near boxes."""
    flags = frames_with_cluster(boxes, FRAME, id_col, near_gap_min_px, near_gap_rel).withColumn("_hit", F.lit(1))
    return (
        frames.select(*FRAME)
        .join(flags, FRAME, "left")
        .groupBy("board")
        .agg(
            F.count(F.lit(1)).cast("int").alias("frames"),
            (F.count("_hit") / F.count(F.lit(1))).alias("cluster_frac"),
        )
    )


def board_stats(frames: DataFrame, label_files: DataFrame) -> DataFrame:
    """Per board over image and label files: board, first, last, frames, gaps, span, annots.

    ``label_files`` has one row per label file: board, frame, annots (its non-blank lines).
    """
    seen = frames.select(*FRAME, F.lit(0).cast("bigint").alias("annots")).unionByName(
        label_files.select(*FRAME, F.col("annots").cast("bigint").alias("annots"))
    )
    per_frame = seen.groupBy(*FRAME).agg(F.sum("annots").alias("annots"))
    span = F.max("frame") - F.min("frame") + 1
    return per_frame.groupBy("board").agg(
        F.min("frame").alias("first"),
        F.max("frame").alias("last"),
        F.count(F.lit(1)).cast("int").alias("frames"),
        (span - F.count(F.lit(1))).cast("int").alias("gaps"),
        span.cast("int").alias("span"),
        F.sum("annots").alias("annots"),
    )


def dataset_totals(frames: DataFrame, label_files: DataFrame) -> DataFrame:
    """One row: boards, images, labels, annots."""
    rows = frames.select("board", F.lit(1).alias("i"), F.lit(0).alias("l"), F.lit(0).cast("bigint").alias("a")).unionByName(
        label_files.select("board", F.lit(0).alias("i"), F.lit(1).alias("l"), F.col("annots").cast("bigint").alias("a"))
    )
    per_board = rows.groupBy("board").agg(F.sum("i").alias("i"), F.sum("l").alias("l"), F.sum("a").alias("a"))
    return per_board.agg(
        F.count(F.lit(1)).alias("boards"), F.sum("i").alias("images"), F.sum("l").alias("labels"), F.sum("a").alias("annots")
    )


def top_boards(stats: DataFrame, sort: str = "frames", order: str = "asc", limit: int = 20) -> DataFrame:
    """Boards by one statistic, ties by board; limit 0 returns all."""
    if sort not in BOARD_SORT_KEYS or order not in ("asc", "desc"):
        raise ValueError(f"cannot sort boards by {sort!r} {order!r}")
    key = F.col(sort).asc() if order == "asc" else F.col(sort).desc()
    ranked = stats.orderBy(key, F.col("board").asc())
    return ranked.limit(limit) if limit > 0 else ranked


def frame_gaps(frames: DataFrame) -> DataFrame:
    """Missing index ranges: board, gap_from, gap_to, missing."""
    present = frames.select(*FRAME).distinct()
    return (
        with_next(present, ["board"], "frame", "_next")
        .filter(F.col("_next") - F.col("frame") > 1)
        .select(
            "board",
            (F.col("frame") + 1).alias("gap_from"),
            (F.col("_next") - 1).alias("gap_to"),
            (F.col("_next") - F.col("frame") - 1).alias("missing"),
        )
    )


def board_canvas(dims: DataFrame, stride: int = STRIDE_PX) -> DataFrame:
    """board, board_width, board_height, frames, height_mismatches (frames below the canvas height)."""
    per_height = dims.groupBy("board", "img_h").agg(
        F.count(F.lit(1)).alias("n"), F.max(to_board_x("img_w", "frame", stride)).alias("right")
    )
    return per_height.groupBy("board").agg(
        F.max("right").cast("int").alias("board_width"),
        F.max("img_h").cast("int").alias("board_height"),
        F.sum("n").alias("frames"),
        (F.sum("n") - F.max_by("n", "img_h")).alias("height_mismatches"),
    )


def mosaic_canvas(dims: DataFrame, stride: int = STRIDE_PX) -> DataFrame:
    """Canvas of the inspection mosaic: height of the first frame, right edge of the last one."""
    return dims.groupBy("board").agg(
        F.max_by(to_board_x("img_w", "frame", stride), "frame").cast("int").alias("board_width"),
        F.min_by("img_h", "frame").cast("int").alias("board_height"),
    )


def cluster_count(
    boxes: DataFrame, on: list[str] | None = None, min_px: float = 5.0, rel: float = 0.25, id_col: str = "ann_id"
) -> DataFrame:
    """Connected groups of two or more near boxes: on, clusters (groups without one are absent)."""
    on = on or FRAME
    comps = near_groups(boxes, on, id_col, min_px, rel)
    sizes = comps.groupBy(*on, "comp").agg(F.sum("copies").alias("n"))
    return sizes.filter("n >= 2").groupBy(*on).agg(F.count(F.lit(1)).alias("clusters"))


def count_instances(
    boxes: DataFrame, iou: float = DUPLICATE_IOU, on: list[str] | None = None, id_col: str = "ann_id"
) -> DataFrame:
    """Distinct objects per group when boxes with IoU >= iou are the same one: on, raw, distinct."""
    on = on or ["board"]
    if iou <= 0:
        return boxes.groupBy(*on).agg(F.count(F.lit(1)).alias("raw"), F.lit(1).cast("bigint").alias("distinct"))
    solid = (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))
    alone = F.lit(iou > 1) | ~solid  # boxes that match nothing, their own copies included
    comps = iou_groups(boxes, iou, on, id_col).withColumn("weight", F.when(alone, F.col("copies")).otherwise(1))
    per_comp = comps.groupBy(*on, "comp").agg(F.sum("copies").alias("copies"), F.max("weight").alias("weight"))
    return per_comp.groupBy(*on).agg(F.sum("copies").alias("raw"), F.sum("weight").cast("bigint").alias("distinct"))


def to_board_boxes(boxes: DataFrame, stride: int = STRIDE_PX) -> DataFrame:
    """Frame boxes shifted to board coordinates."""
    return boxes.withColumns({"x1": to_board_x("x1", "frame", stride), "x2": to_board_x("x2", "frame", stride)})


def gt_stats(boxes: DataFrame, stride: int = STRIDE_PX, iou: float = DUPLICATE_IOU, id_col: str = "ann_id") -> DataFrame:
    """board, raw_annotations, distinct_estimate from frame boxes."""
    counted = count_instances(to_board_boxes(boxes, stride), iou, ["board"], id_col)
    return counted.select("board", F.col("raw").alias("raw_annotations"), F.col("distinct").alias("distinct_estimate"))


def cross_frame_duplicates(boxes: DataFrame, stride: int = STRIDE_PX, iou: float = DUPLICATE_IOU, id_col: str = "ann_id") -> DataFrame:
    """The same object seen in adjacent frames: board, frame, a_<id>, next-frame b_<id>, copies, iou."""
    unique = distinct_boxes(to_board_boxes(boxes, stride), FRAME, id_col)
    later = unique.withColumn("frame", F.col("frame") - 1)
    pairs = overlap_pairs(unique, later, FRAME).withColumn("iou", bbox_iou(box_cols("a_"), box_cols("b_")))
    return pairs.filter((F.col("iou") >= F.lit(iou).cast("float")) & (F.col("iou") > 0)).select(
        *FRAME, "a_" + id_col, "b_" + id_col, "a_copies", "b_copies", "iou"
    )


def edge_touch_counts(boxes: DataFrame, tol: float = 1.0, w: str = "img_w", h: str = "img_h") -> DataFrame:
    """Boxes within tol of a frame edge: board, frame, annot, edge."""
    touch = edge_touch(box_cols(), F.col(w), F.col(h), tol).cast("int")
    return boxes.groupBy(*FRAME).agg(F.count(F.lit(1)).alias("annot"), F.sum(touch).alias("edge"))


def annotation_histogram(frames: DataFrame, boxes: DataFrame) -> DataFrame:
    """How many image frames carry how many annotations: annot, frames."""
    per_frame = boxes.groupBy(*FRAME).agg(F.count(F.lit(1)).alias("annot"))
    counts = frames.select(*FRAME).join(per_frame, FRAME, "left").select(F.coalesce("annot", F.lit(0)).alias("annot"))
    return counts.groupBy("annot").agg(F.count(F.lit(1)).alias("frames"))


def split_totals(assignment: DataFrame, features: DataFrame) -> DataFrame:
    """Boards and frames per split plus a total row (split null)."""
    joined = assignment.join(features.select("board", "frames"), "board")
    return joined.rollup("split").agg(F.count(F.lit(1)).alias("boards"), F.sum("frames").alias("frames"))


def assignment_reasons(assignment: DataFrame) -> DataFrame:
    """How boards came to their split: reason, split, boards."""
    return assignment.groupBy("reason", "split").agg(F.count(F.lit(1)).alias("boards"))


def pseudo_label_quality(frame_status: DataFrame, polygons: DataFrame) -> DataFrame:
    """One row of counters for a polygon-labelling run.

    ``frame_status``: board, frame, status (processed, skipped, empty, unreadable), raw_lines,
    boxes. ``polygons``: one row per box with the flag ``fallback``.
    """
    rows = frame_status.select("status", "raw_lines", "boxes", F.lit(None).cast("boolean").alias("fallback")).unionByName(
        polygons.select(F.lit("polygon").alias("status"), F.lit(0).alias("raw_lines"), F.lit(0).alias("boxes"), "fallback")
    )

    def having(s: str) -> Column:
        return F.coalesce(F.sum((F.col("status") == s).cast("bigint")), F.lit(0))

    dropped = F.when(F.col("status").isin("processed", "empty"), F.col("raw_lines") - F.col("boxes"))
    counted = rows.agg(
        *[having(s).alias(s) for s in ("processed", "skipped", "empty")],
        F.coalesce(F.sum(dropped), F.lit(0)).cast("bigint").alias("degenerate_boxes_skipped"),
        having("polygon").alias("boxes_total"),
        F.coalesce(F.sum(F.col("fallback").cast("bigint")), F.lit(0)).alias("fallback_polygons"),
    )
    share = F.lit(100.0) * F.col("fallback_polygons") / F.nullif(F.col("boxes_total"), F.lit(0))
    return counted.withColumn("fallback_pct", F.coalesce(share, F.lit(0.0)))
