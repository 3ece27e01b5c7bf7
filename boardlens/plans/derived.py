"""Board tables derived from ``lineitem``: the input of the registered queries.

Every order line group (order, line number) becomes one object on a board of eight neighbouring
orders. An object is seen in every frame that covers its left edge, mostly two, with a small
jitter. Boards divisible by three hold well separated objects. Detections are jittered boxes, some
displaced; all rows of ``lineitem`` take part and nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlens.operators.ranking import global_rank

FRAME_W, FRAME_H, STRIDE = 640, 220, 320
FRAME = ["board", "frame"]


def whole(a: Column, b: int) -> Column:
    """Integer quotient of non-negative integers."""
    return F.floor(a / F.lit(b)).cast("bigint")


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """board, nf (frames), obj_id, kx, ky, kw, kh in board pixels."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_partkey").alias("pk"), F.max("l_suppkey").alias("sk")
    )
    board = whole(F.col("l_orderkey"), 8)
    placed = lines.select(
        board.alias("board"),
        (2 + board * 7 % 35).alias("nf"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("obj_id"),
        (F.col("l_orderkey") % 8 * 7 + F.col("l_linenumber") - 1).alias("slot"),
        (8 + F.col("pk") % 33).alias("kw"),
        (6 + F.col("sk") % 15).alias("kh"),
    ).withColumn("span", F.col("nf") * STRIDE + 260)
    apart = F.col("board") % 3 == 0
    return placed.select(
        F.col("board").cast("int").alias("board"),
        F.col("nf").cast("int").alias("nf"),
        "obj_id",
        F.when(apart, F.col("slot") * whole(F.col("span"), 56)).otherwise(F.col("obj_id") * 7919 % F.col("span")).alias("kx"),
        F.when(apart, 15 + F.col("slot") % 4 * 50).otherwise(F.col("obj_id") * 104729 % 195).alias("ky"),
        "kw",
        "kh",
    )


def all_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frame index of every board, whether its image exists or not."""
    board = whole(F.col("l_orderkey"), 8)
    boards = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(board.alias("board")).distinct()
    sized = boards.select(F.col("board").cast("int").alias("board"), (2 + F.col("board") * 7 % 35).cast("int").alias("nf"))
    return sized.select("board", F.explode(F.sequence(F.lit(0), F.col("nf") - 1)).alias("frame"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with an image: board, frame, stem, img_w, img_h. Some indices are missing, some images are lower."""
    present = (F.col("board") * 31 + F.col("frame") * 17) % 29 != 0
    low = (F.col("board") + F.col("frame")) % 37 == 0
    return all_frames(spark, sf_dir).filter(present).select(
        "board",
        "frame",
        F.concat_ws("_", "board", "frame").alias("stem"),
        F.lit(FRAME_W).alias("img_w"),
        F.when(low, 200).otherwise(FRAME_H).alias("img_h"),
    )


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes as drawn: board, frame, ann_id, x0, y0, w0, h0 in frame pixels."""
    seen = objects(spark, sf_dir).withColumn("off", F.explode(F.array(F.lit(0), F.lit(1)).cast("array<bigint>")))
    frame = whole(F.col("kx"), STRIDE) - F.col("off")
    ann = F.col("obj_id") * 2 + F.col("off")
    x0 = F.col("kx") - frame * STRIDE + F.col("off") * (ann % 3)
    rows = seen.filter((frame >= 0) & (frame < F.col("nf"))).select(
        "board",
        frame.cast("int").alias("frame"),
        ann.alias("ann_id"),
        x0.cast("int").alias("x0"),
        F.col("ky").cast("int").alias("y0"),
        F.least(F.col("kw"), FRAME_W - x0).cast("int").alias("w0"),
        F.col("kh").cast("int").alias("h0"),
    )
    return rows.filter("w0 > 0")


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label text per annotation: board, frame, line_no, line. A few lines are malformed on purpose."""

    def micro(num: Column, den: int) -> Column:
        return F.concat(F.lit("0."), F.lpad(whole(num.cast("bigint") * 1_000_000, den).cast("string"), 6, "0"))

    cx, cy = micro(F.col("x0") * 2 + F.col("w0"), 2 * FRAME_W), micro(F.col("y0") * 2 + F.col("h0"), 2 * FRAME_H)
    bw, bh = micro(F.col("w0"), FRAME_W), micro(F.col("h0"), FRAME_H)
    a = F.col("ann_id")
    line = (
        F.when(a % 97 == 0, F.concat_ws(" ", F.lit("0"), cx, cy, bw, bh, F.lit("0.5"), F.lit("0.5")))
        .when(a % 101 == 0, F.concat_ws(" ", F.lit("0"), cx, cy, bw))
        .when(a % 103 == 0, F.concat_ws(" ", F.lit("0"), cx, F.lit("n/a"), bw, bh))
        .when(a % 89 == 0, F.concat_ws("  ", F.lit("0"), F.lit("0.501953125"), cy, F.lit("0.00390625"), bh))
        .when(a % 83 == 0, F.concat_ws(" ", F.lit("0"), cx, cy, F.lit("0.0"), bh))
        .otherwise(F.concat_ws(" ", F.lit("0"), cx, cy, bw, bh))
    )
    return annotations(spark, sf_dir).select("board", "frame", F.col("ann_id").alias("line_no"), line.alias("line"))


def label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per label file: board, frame, annots."""
    return label_lines(spark, sf_dir).groupBy(*FRAME).agg(F.count(F.lit(1)).alias("annots"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact integer boxes of the annotations: board, frame, ann_id, x1, y1, x2, y2."""
    x2, y2 = F.col("x0") + F.col("w0"), F.col("y0") + F.col("h0")
    return annotations(spark, sf_dir).select(
        "board", "frame", "ann_id", F.col("x0").alias("x1"), F.col("y0").alias("y1"), x2.alias("x2"), y2.alias("y2")
    )


def crowd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boxes of 16 boards in one frame each: board, frame, ann_id, x1, y1, x2, y2."""
    return boxes(spark, sf_dir).withColumns({"board": F.floor(F.col("board") / 16).cast("int"), "frame": F.lit(0)})


def ringed_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four bars around every object, an island in the middle and a dot beside: board, frame, ann_id, x1, y1, x2, y2.

    Every third ring is open on its right side, so its island is not enclosed. Objects of a board stand 200 px apart.
    """
    slot = objects(spark, sf_dir).select("board", "obj_id", (F.col("obj_id") % 80).alias("slot"))
    left = F.col("slot") * 200
    bars = [(10, 10, 130, 16), (10, 90, 130, 96), (10, 10, 16, 96), (124, 10, 130, 96), (60, 40, 80, 60), (150, 40, 160, 50)]
    each = F.array(*[F.struct(F.lit(i).alias("i"), *[F.lit(v).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), bar)]) for i, bar in enumerate(bars)])
    rows = slot.select("board", "obj_id", left.alias("left"), F.explode(each).alias("b"))
    rows = rows.filter((F.col("b.i") != 3) | (F.col("obj_id") % 3 != 0))
    return rows.select(
        "board", F.lit(0).alias("frame"), (F.col("obj_id") * 6 + F.col("b.i")).alias("ann_id"), (F.col("left") + F.col("b.x1")).cast("int").alias("x1"),
        "b.y1", (F.col("left") + F.col("b.x2")).cast("int").alias("x2"), "b.y2",
    )


def row_of_boxes(spark: SparkSession, sf_dir: str, shift: int, id_col: str) -> DataFrame:
    """Equal boxes 20 px apart on one board, one for each object in their order: board, id, x1, y1, x2, y2."""
    ranked = global_rank(objects(spark, sf_dir).select("obj_id"), [F.col("obj_id")], id_col)
    left = F.col(id_col) * 20 + shift
    return ranked.select(F.lit(0).alias("board"), id_col, left.alias("x1"), F.lit(0).alias("y1"), (left + 30).alias("x2"), F.lit(9).alias("y2"))


def detections(spark: SparkSession, sf_dir: str, missed: bool = True) -> DataFrame:
    """Detector output: board, frame, det_id, cls, conf, x1, y1, x2, y2, some displaced.

    Every eleventh object is missed, which matching and evaluation have to cope with; without ``missed`` all are there.
    """
    a = F.col("ann_id")
    away = F.when(a % 13 == 0, 90).otherwise(0)
    rows = annotations(spark, sf_dir).filter((a % 11 != 0) | F.lit(not missed)).select(
        "board",
        "frame",
        a.alias("det_id"),
        F.lit(0).alias("cls"),
        ((20 + a % 80).cast("double") / 100).alias("conf"),
        F.greatest(F.lit(0), F.col("x0") + a % 5 - 2 + away).cast("int").alias("x1"),
        F.col("y0").alias("y1"),
        F.least(F.lit(FRAME_W), F.col("x0") + F.col("w0") + a % 7 - 2 + away).cast("int").alias("x2"),
        F.least(F.lit(FRAME_H), F.col("y0") + F.col("h0") + a % 4 - 1).cast("int").alias("y2"),
    )
    return rows.filter("x2 > x1")


def octagon(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """A box with its corners cut."""
    point = lambda x, y: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"))
    c = F.least(F.lit(3), whole(F.least(x2 - x1, y2 - y1).cast("bigint"), 3)).cast("int")
    return F.array(
        point(x1 + c, y1), point(x2 - c, y1), point(x2, y1 + c), point(x2, y2 - c),
        point(x2 - c, y2), point(x1 + c, y2), point(x1, y2 - c), point(x1, y1 + c),
    )


def detection_polygons(spark: SparkSession, sf_dir: str, missed: bool = True) -> DataFrame:
    """Detections with octagonal outlines: their columns and polygon."""
    return detections(spark, sf_dir, missed).withColumn("polygon", octagon(*(F.col(c) for c in ("x1", "y1", "x2", "y2"))))
