"""Refresh of merged boards as frame detections arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boardlens.functions.geometry import STRIDE_PX
from boardlens.operators.lineage import cut
from boardlens.operators.scoring import run_boards

FRAME_TABLE = (
    "board int, frame int, img_w int, img_h int, detections array<struct<bbox:struct<x1:float,y1:float,x2:float,y2:float>,"
    "confidence:float,cls:int,polygon:array<struct<x:int,y:int>>>>, delivered timestamp, board_group int"
)


def board_group(boards_per_folder: int) -> Column:
    return F.floor(F.col("board") / boards_per_folder).cast("int").alias("board_group")


def write_frame_table(scored: DataFrame, path: str, boards_per_folder: int = 1, delivered: Column | None = None) -> None:
    """Append frames to the detection table. A folder holds a range of boards that can be read alone.

    ``delivered`` orders the deliveries of one frame; it is the time of the write unless given.
    """
    when = (F.current_timestamp() if delivered is None else delivered).alias("delivered")
    rows = scored.select("board", "frame", "img_w", "img_h", "detections", when, board_group(boards_per_folder))
    spread = rows.repartition(F.col("board_group"), F.floor(F.col("frame") / 4096))
    spread.write.mode("append").partitionBy("board_group").parquet(path)


def newest_frames(history: DataFrame) -> DataFrame:
    """The latest delivery of every frame. Deliveries of one time are ordered by a hash of their content, so the choice never depends on files.

    Only frames delivered more than once, which their keys tell, are shuffled with their content.
    """
    key, content = ["board", "frame"], ["img_w", "img_h", "detections"]
    again = cut(history.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*key))
    if again.isEmpty():
        return history.select(*key, *content)
    latest = F.max_by(F.struct(*content), F.struct("delivered", F.xxhash64(*content)))
    chosen = history.join(again, key, "left_semi").groupBy(*key).agg(latest.alias("_f")).select(*key, "_f.*")
    return history.join(again, key, "left_anti").select(*key, *content).unionByName(chosen)


def refresh_boards(batch: DataFrame, frame_table: str, out_table: str, stride: int, eps: float, boards_per_folder: int) -> None:
    """Rebuild the folders a batch touches from all their frames and replace their polygons.

    The folder ids of the batch meet the partition column of the table, so other folders are not
    opened. The write replaces only the folders it produces and can be repeated safely; every
    rebuilt board has a row, with a null polygon if none is left.
    """
    spark = batch.sparkSession
    touched = cut(batch.select("board_group").distinct())
    history = spark.read.schema(FRAME_TABLE).parquet(frame_table)
    frames = newest_frames(history.join(touched, "board_group", "left_semi"))
    merged = run_boards(frames, stride, eps)
    whole = merged.boards.join(merged.polygons, "board", "left").withColumn("board_group", board_group(boards_per_folder))
    spread = whole.repartition(F.col("board_group"), F.floor(F.col("x1") / (1 << 20)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("board_group").parquet(out_table)


def incremental_boards(
    spark: SparkSession, frame_table: str, out_table: str, checkpoint: str, stride: int = STRIDE_PX, eps: float = 1.0,
    boards_per_folder: int = 1, trigger: dict | None = None, on_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start the refresh job. The stream's checkpoint replaces skip-if-exists bookkeeping."""
    stream = spark.readStream.schema(FRAME_TABLE).parquet(frame_table)

    def handle(batch: DataFrame, epoch: int) -> None:
        refresh_boards(batch, frame_table, out_table, stride, eps, boards_per_folder)
        if on_batch:
            on_batch(epoch)

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
