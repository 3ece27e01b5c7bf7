"""Frame images: listing, sizes from the PNG header, decoded pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlens.functions.geometry import file_stem, frame_key
from boardlens.operators.joins import keep_boards
from boardlens.sources.listing import list_files, with_content

PNG_SIGNATURE = "89504E470D0A1A0A"  # fixed value of the PNG format
HEADER = 24  # bytes up to the end of width and height in a PNG file


def keyed_by_stem(df: DataFrame, path: str = "path") -> DataFrame:
    """Adds stem, board and frame of a file path and drops names that are not ``<board>_<frame>``."""
    board, frame = frame_key("stem")
    return df.withColumn("stem", file_stem(path)).withColumns({"board": board, "frame": frame}).filter("board is not null")


def scan_frames(
    spark: SparkSession, images_dir: str, boards: DataFrame | list[int] | None = None, stems: DataFrame | None = None
) -> DataFrame:
    """board, frame, stem, path of the images that are not empty. Only the listing is read, no file is opened."""
    listed = list_files(spark, images_dir, ".png").filter("length > 0")
    found = keyed_by_stem(listed).select("board", "frame", "stem", "path")
    if stems is not None:
        found = found.join(stems.select("stem").distinct(), "stem", "left_semi").select("board", "frame", "stem", "path")
    return keep_boards(found, boards)


def _header_int(content: Column, at: int) -> Column:
    return F.conv(F.hex(F.substring(content, at, 4)), 16, 10).try_cast("int")


def frame_dims(spark: SparkSession, images_dir: str, boards: DataFrame | list[int] | None = None) -> DataFrame:
    """board, frame, img_w, img_h from the header bytes; files without a PNG header are dropped.

    HEADER bytes are read of each file, and none of files of other boards.
    """
    files = with_content(scan_frames(spark, images_dir, boards).select("board", "frame", "path"), HEADER)
    png = F.hex(F.substring("content", 1, 8)) == PNG_SIGNATURE
    sized = files.filter(png).select(
        "board", "frame", _header_int(F.col("content"), 17).alias("img_w"), _header_int(F.col("content"), 21).alias("img_h")
    )
    return sized.filter("img_w > 0 and img_h > 0")


def decode_frames(spark: SparkSession, images_dir: str, boards: DataFrame | list[int] | None = None) -> DataFrame:
    """board, frame, img_w, img_h, channels, pixels (row-major, BGR order), ok.

    Unreadable files stay as rows with ok = false, so a job can count them. Files of boards other than a given list are
    not opened; boards given as a table are kept after decoding, as Spark's image source reads what its folder and glob name.
    """
    numbers = None if boards is None or isinstance(boards, DataFrame) else sorted({int(b) for b in boards})
    glob = "*.png" if not numbers else "*{" + ",".join(map(str, numbers)) + "}_*.png"  # numbers may have leading zeros
    raw = spark.read.format("image").option("dropInvalid", False).option("pathGlobFilter", glob).load(images_dir)
    decoded = keyed_by_stem(raw.select("image.*"), "origin").select(
        "board",
        "frame",
        F.col("width").alias("img_w"),
        F.col("height").alias("img_h"),
        F.col("nChannels").alias("channels"),
        F.col("data").alias("pixels"),
        (F.col("width") > 0).alias("ok"),
    )
    return keep_boards(decoded, boards)
