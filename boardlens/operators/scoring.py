"""Counters and boards of scored frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.functions.geometry import STRIDE_PX
from boardlens.operators.stitching import Stitched, stitch_boards

FRAME = ["board", "frame"]



def _expand(scored: DataFrame) -> DataFrame:
    each = scored.select(*FRAME, F.posexplode("detections").alias("det_id", "d"))
    return each.select(*FRAME, F.col("det_id").cast("bigint").alias("det_id"), "d.*")


def scored_detections(scored: DataFrame) -> DataFrame:
    """board, frame, det_id, bbox, confidence, cls, polygon."""
    return _expand(scored)


def job_counters(scored: DataFrame) -> DataFrame:
    """One row: processed, unread, failed, inference_sec."""
    n = lambda s: F.coalesce(F.sum((F.col("status") == s).cast("bigint")), F.lit(0)).alias(s)
    return scored.agg(n("processed"), n("unread"), n("failed"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("inference_sec"))


def run_boards(scored: DataFrame, stride: int = STRIDE_PX, eps: float = 1.0) -> Stitched:
    """Merged board polygons of scored (or cached) frames: frames with status processed count."""
    done = scored.filter("status = 'processed'") if "status" in scored.columns else scored
    return stitch_boards(_expand(done), done.select(*FRAME, "img_w", "img_h"), stride, eps)
