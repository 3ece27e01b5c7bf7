"""Label text files and the three box parsers.

The parsers differ on purpose, as their callers do:
  float   at least five tokens, no rounding, no clipping, empty boxes kept
  int     at least five tokens, half-even rounding, clipped, empty boxes dropped
  strict  exactly five tokens, float32 arithmetic, half-away rounding, clipped, empty boxes dropped
Lines that cannot be used come back as a second table with a reason.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlens.functions.geometry import (
    Box,
    clip_box,
    has_extent,
    round_half_away,
    round_half_even,
    yolo_corners,
)
from boardlens.operators.joins import keep_boards
from boardlens.sources.frames import keyed_by_stem
from boardlens.sources.listing import list_files, with_content

FRAME = ["board", "frame"]
_NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_BOX_LINE = rf"^\s*\S+(?:\s+{_NUMBER}){{4}}(?:\s|$)"
_SEG_LINE = rf"^\s*\S+(?:\s+{_NUMBER})+\s*$"


class Labels(NamedTuple):
    boxes: DataFrame
    rejects: DataFrame  # board, frame, line_no, line, reason


def scan_label_files(spark: SparkSession, labels_dir: str, boards: DataFrame | list[int] | None = None) -> DataFrame:
    """One row per ``<board>_<frame>.txt``: board, frame, text, annots (non-blank lines); no file of another board is opened.

    Empty files count here, which the file sources of Spark SQL leave out; the listing has them. Bytes that are no
    UTF-8 are replaced.
    """
    keyed = keep_boards(keyed_by_stem(list_files(spark, labels_dir, ".txt")).select(*FRAME, "path"), boards)
    texts = with_content(keyed).select(*FRAME, F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
    lines = F.filter(F.split("text", "\r?\n"), lambda v: v.rlike(r"\S"))
    return texts.select(*FRAME, "text", F.size(lines).cast("bigint").alias("annots"))


def label_lines(files: DataFrame) -> DataFrame:
    """board, frame, line_no (0-based position in the file), line; blank lines are left out."""
    numbered = files.select(*FRAME, F.posexplode(F.split("text", "\r?\n")).alias("line_no", "line"))
    return numbered.filter(F.col("line").rlike(r"\S"))


def scan_label_lines(spark: SparkSession, labels_dir: str, boards: DataFrame | list[int] | None = None) -> DataFrame:
    return label_lines(scan_label_files(spark, labels_dir, boards))


def _tokens() -> Column:
    """What white space separates; plain replacement and a split at one character cost far less than patterns do."""
    return F.array_remove(F.split(F.translate("line", "\t\n\x0b\f\r", "     "), " "), "")


def _read(lines: DataFrame, dims: DataFrame) -> DataFrame:
    """Lines with frame size and tokens. The one-element explode keeps the optimizer from copying
    the split into every use of a token."""
    sized = lines.join(dims.select(*FRAME, "img_w", "img_h"), FRAME)
    return sized.select("*", F.explode(F.array(_tokens())).alias("_t"))


def _numbers(kind: str) -> list[Column]:
    return [F.get("_t", F.lit(i)).try_cast(kind) for i in range(1, 5)]


def _result(read: DataFrame, reason: Column, box: Box, keep_empty: bool, cls: Column) -> Labels:
    base = [*FRAME, "line_no"]
    tagged = read.withColumn("reason", reason)
    parsed = tagged.filter("reason is null").select(
        *base, "line", cls.alias("cls"), "img_w", "img_h", *[c.alias(n) for c, n in zip(box, ("x1", "y1", "x2", "y2"))]
    )
    rejects = tagged.filter("reason is not null").select(*base, "line", "reason")
    if keep_empty:
        return Labels(parsed.drop("line"), rejects)
    solid = has_extent(tuple(F.col(n) for n in ("x1", "y1", "x2", "y2")))
    empty = parsed.filter(~solid).select(*base, "line", F.lit("degenerate").alias("reason"))
    return Labels(parsed.filter(solid).drop("line"), rejects.unionByName(empty))


def _class() -> Column:
    return F.get("_t", F.lit(0)).try_cast("int")


def labels_float(lines: DataFrame, dims: DataFrame) -> Labels:
    reason = F.when(F.size("_t") < 5, "few_tokens").when(~F.col("line").rlike(_BOX_LINE), "not_numeric")
    box = yolo_corners(*_numbers("double"), F.col("img_w"), F.col("img_h"))
    return _result(_read(lines, dims), reason, box, True, _class())


def labels_int(lines: DataFrame, dims: DataFrame) -> Labels:
    reason = F.when(F.size("_t") < 5, "few_tokens").when(~F.col("line").rlike(_BOX_LINE), "not_numeric")
    w, h = F.col("img_w"), F.col("img_h")
    corners = yolo_corners(*_numbers("double"), w, h)
    box = clip_box(tuple(round_half_even(c) for c in corners), w, h)
    return _result(_read(lines, dims), reason, box, False, _class())


def labels_strict(lines: DataFrame, dims: DataFrame) -> Labels:
    reason = (
        F.when(F.size("_t") < 5, "few_tokens")
        .when(~F.col("line").rlike(_BOX_LINE) | _class().isNull(), "not_numeric")
        .when(F.size("_t") > 5, "extra_tokens")
    )
    w, h = F.col("img_w"), F.col("img_h")
    cx, cy, bw, bh = _numbers("float")
    fw, fh, half = w.cast("float"), h.cast("float"), F.lit(0.5).cast("float")
    px, py, dx, dy = cx * fw, cy * fh, bw * fw * half, bh * fh * half
    box = clip_box(tuple(round_half_away(c) for c in (px - dx, py - dy, px + dx, py + dy)), w, h)
    return _result(_read(lines, dims), reason, box, False, _class())


def labels_seg(lines: DataFrame, dims: DataFrame) -> Labels:
    """Polygon lines: class and at least three coordinate pairs, rounded half-even to pixels."""
    read = _read(lines, dims)
    n = F.size("_t")
    reason = (
        F.when(n < 7, "few_tokens")
        .when((n - 1) % 2 != 0, "odd_coordinates")
        .when(~F.col("line").rlike(_SEG_LINE), "not_numeric")
    )
    at = lambda i: F.get("_t", i.cast("int")).try_cast("double")
    pairs = F.sequence(F.lit(0), F.greatest(F.floor((n - 1) / 2).cast("int") - 1, F.lit(0)))
    polygon = F.transform(
        pairs,
        lambda k: F.struct(
            round_half_even(at(k * 2 + 1) * F.col("img_w")).alias("x"), round_half_even(at(k * 2 + 2) * F.col("img_h")).alias("y")
        ),
    )
    tagged = read.withColumn("reason", reason)
    good = tagged.filter("reason is null").select(*FRAME, "line_no", _class().alias("cls"), "img_w", "img_h", polygon.alias("polygon"))
    return Labels(good, tagged.filter("reason is not null").select(*FRAME, "line_no", "line", "reason"))
