"""Frame inspection, mosaics and overlays on pixel tables.

A pixel table has one row per frame: board, frame, img_w, img_h, channels, pixels (row-major, BGR).
Boxes and outlines reach a frame or tile as merged runs, so what is joined to an image never
exceeds its own pixel count, however many shapes lie on it.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlens.functions.geometry import (
    LUMA_B,
    LUMA_G,
    LUMA_HALF,
    LUMA_R,
    STRIDE_PX,
    box_cols,
    box_polygon,
    shift_polygon,
)
from boardlens.operators import outline, raster
from boardlens.operators.pairs import BOX
from boardlens.operators.stats import cluster_count, edge_touch_counts, to_board_boxes

FRAME = ["board", "frame"]
TILES_PER_IMAGE = 64


def bgr_array(raw: bytes, h: int, w: int, channels: int) -> np.ndarray:
    """(h, w, 3) view of a frame; grey and alpha frames are brought to three channels."""
    image = np.frombuffer(raw, dtype=np.uint8).reshape(h, w, channels)
    return image[:, :, :3] if channels >= 3 else np.repeat(image[:, :, :1], 3, axis=2)


def encode_png(bgr: np.ndarray) -> bytes:
    """8-bit RGB PNG."""
    h, w = bgr.shape[:2]
    rows = np.zeros((h, 1 + w * 3), dtype=np.uint8)
    rows[:, 1:] = bgr[:, :, ::-1].reshape(h, w * 3)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    header = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def _paint(mask: np.ndarray, ys, starts, ends, x0: int = 0) -> None:
    for y, a, b in zip(ys, starts, ends):
        mask[y, a - x0 : b - x0 + 1] = True


# -- inspection -----------------------------------------------------------------------


def box_runs(boxes: DataFrame, dims: DataFrame) -> DataFrame:
    """Pixels under the boxes of a frame as merged runs in one row: board, frame, ys, starts, ends."""
    sized = boxes.select(*FRAME, *BOX).join(dims.select(*FRAME, "img_w", "img_h"), FRAME)
    whole = sized.select(
        *FRAME,
        F.greatest(F.floor("x1"), F.lit(0)).cast("int").alias("x1"),
        F.greatest(F.floor("y1"), F.lit(0)).cast("int").alias("y1"),
        (F.least(F.ceil("x2"), F.col("img_w")) - 1).cast("int").alias("x2"),
        (F.least(F.ceil("y2"), F.col("img_h")) - 1).cast("int").alias("y2"),
    ).filter("x1 <= x2 and y1 <= y2").distinct()
    runs = raster.merge_spans(raster.rasterize_boxes(whole), FRAME)
    packed = runs.groupBy(*FRAME).agg(F.collect_list(F.struct("y", "xs", "xe")).alias("r"))
    part = lambda k, n: F.transform("r", lambda s: s[k]).alias(n)
    return packed.select(*FRAME, part("y", "ys"), part("xs", "starts"), part("xe", "ends"))


def strip_report(image: np.ndarray, runs: tuple, bg_max: int, row_frac: float, dark_max: int, min_chroma: int) -> tuple[int, int, float]:
    """Rows above and below the strip of lit rows (-1 without one) and the dark share of its pixels outside the runs (y, start, end).

    The runs are disjoint, so what lies under them is taken off the totals by running sums instead of a mask.
    """
    height, width = image.shape[:2]
    blue, green, red = (image[:, :, k].astype(np.int32) for k in range(3))
    luma = (LUMA_R * red + LUMA_G * green + LUMA_B * blue + LUMA_HALF) >> 16
    lit = np.count_nonzero(luma > bg_max, axis=1) / width >= row_frac
    if not lit.any():
        return -1, -1, 0.0
    top, bottom = int(lit.argmax()), int(lit[::-1].argmax())
    chroma = np.ptp(image, axis=2)
    dark = (luma > bg_max) & (luma <= dark_max) & (chroma >= min_chroma)
    upto = np.zeros((height, width + 1), np.int64)
    np.cumsum(dark, axis=1, out=upto[:, 1:])
    y, start, end = (np.asarray(v, np.int64) for v in runs)
    inside = (y >= top) & (y < height - bottom)
    y, start, end = y[inside], start[inside], end[inside] + 1
    pixels = (height - top - bottom) * width - int((end - start).sum())
    left = int(upto[top : height - bottom, -1].sum() - (upto[y, end] - upto[y, start]).sum())
    return top, bottom, left / pixels if pixels else 0.0


def _report_udf(*limits: float):
    @F.pandas_udf("top int, bot int, dark double")
    def report(raw: pd.Series, w: pd.Series, h: pd.Series, channels: pd.Series, y: pd.Series, start: pd.Series, end: pd.Series) -> pd.DataFrame:
        frames = zip(raw, h, w, channels, zip(y, start, end, strict=True), strict=True)
        return pd.DataFrame([strip_report(bgr_array(*f[:4]), f[4], *limits) for f in frames], columns=["top", "bot", "dark"])

    return report


def inspect_pixels(
    frames: DataFrame, boxes: DataFrame, bg_max: int = 30, row_frac: float = 0.5, dark_max: int = 120, min_chroma: int = 15
) -> DataFrame:
    """board, frame, img_w, img_h, top, bot, dark: the strip margins and the dark share outside boxes."""
    none = F.array().cast("array<int>")
    joined = frames.join(box_runs(boxes, frames), FRAME, "left")
    runs = [F.coalesce(c, none) for c in ("ys", "starts", "ends")]
    found = _report_udf(bg_max, row_frac, dark_max, min_chroma)("pixels", "img_w", "img_h", "channels", *runs)
    return joined.select(*FRAME, "img_w", "img_h", found.alias("_f")).select(*FRAME, "img_w", "img_h", "_f.*")


def inspect_frames(
    frames: DataFrame, boxes: DataFrame, bg_max: int = 30, row_frac: float = 0.5, dark_max: int = 120, min_chroma: int = 15,
    edge_tol: float = 1.0, near_gap_min_px: float = 5.0, near_gap_rel: float = 0.25, id_col: str = "ann_id",
) -> DataFrame:
    """One row per frame: size, strip margins, dark share, annotations, clusters, edge touches."""
    dims = frames.select(*FRAME, "img_w", "img_h")
    boxes = boxes.select(*FRAME, id_col, *BOX)
    sized = boxes.join(dims, FRAME)
    edges = edge_touch_counts(sized, edge_tol)
    clusters = cluster_count(boxes.join(dims.select(*FRAME), FRAME, "left_semi"), FRAME, near_gap_min_px, near_gap_rel, id_col)
    pixels = inspect_pixels(frames, boxes, bg_max, row_frac, dark_max, min_chroma)
    return pixels.join(edges, FRAME, "left").join(clusters, FRAME, "left").fillna(0, ["annot", "edge", "clusters"])


# -- mosaics ---------------------------------------------------------------------------


def mosaic_ownership(dims: DataFrame, stride: int = STRIDE_PX) -> DataFrame:
    """Which frame shows which board columns when later frames cover earlier ones.

    board, slot, x_from, x_to (inclusive), frame. A slot is one stride of columns; only the few
    frames that reach it compete there, so no board is ordered as a whole.
    """
    last = F.col("frame") + F.ceil(F.col("img_w") / stride) - 1
    slots = dims.select("board", "frame", "img_w", F.explode(F.sequence(F.col("frame"), last.cast("int"))).alias("slot"))
    reach = F.least(F.lit(stride), (F.col("frame") - F.col("slot")) * stride + F.col("img_w"))
    later = Window.partitionBy("board", "slot").orderBy(F.col("frame").desc()).rowsBetween(Window.unboundedPreceding, -1)
    shown = slots.withColumn("_n", reach).withColumn("_taken", F.coalesce(F.max("_n").over(later), F.lit(0)))
    base = F.col("slot") * stride
    return shown.filter("_n > _taken").select(
        "board",
        "slot",
        (base + F.col("_taken")).cast("int").alias("x_from"),
        (base + F.col("_n") - 1).cast("int").alias("x_to"),
        "frame",
    )


@F.pandas_udf(T.BinaryType())
def _crop(pixels: pd.Series, w: pd.Series, h: pd.Series, ch: pd.Series, x1: pd.Series, x2: pd.Series) -> pd.Series:
    return pd.Series(
        [bgr_array(r, hh, ww, c)[:, a : b + 1].tobytes() for r, ww, hh, c, a, b in zip(pixels, w, h, ch, x1, x2)]
    )


@F.pandas_udf(T.BinaryType())
def _assemble(width: pd.Series, height: pd.Series, at: pd.Series, widths: pd.Series, heights: pd.Series, data: pd.Series) -> pd.Series:
    out = []
    for w, h, xs, ws, hs, parts in zip(width, height, at, widths, heights, data):
        canvas = np.zeros((h, w, 3), dtype=np.uint8)
        for x, pw, ph, raw in zip(xs, ws, hs, parts):
            piece = np.frombuffer(raw, dtype=np.uint8).reshape(ph, pw, 3)
            rows, cols = min(ph, h), min(pw, w - x)
            if cols > 0:
                canvas[:rows, x : x + cols] = piece[:rows, :cols]
        out.append(canvas.tobytes())
    return pd.Series(out)


def _stack(pieces: DataFrame, keys: list[str], width: Column, height: Column, at: str) -> DataFrame:
    part = F.struct(F.col(at).alias("x"), "pw", "ph", "piece")
    packed = pieces.groupBy(*keys).agg(F.collect_list(part).alias("p"), F.max(width).alias("width"), F.max(height).alias("height"))
    item = lambda k: F.transform("p", lambda s: s[k])
    body = _assemble("width", "height", item("x"), item("pw"), item("ph"), item("piece"))
    return packed.select(*keys, "width", "height", body.alias("bgr"))


def board_mosaic(frames: DataFrame, boards: DataFrame, stride: int = STRIDE_PX) -> DataFrame:
    """Mosaic tiles, one per slot: board, slot, x0, width, height, bgr.

    A frame is cropped to the columns it shows before anything is shuffled.
    """
    own = mosaic_ownership(frames.select(*FRAME, "img_w"), stride)
    shown = frames.join(own, FRAME).join(boards.select("board", "board_width", "board_height"), "board")
    left = F.col("x_from") - F.col("frame") * stride
    right = F.col("x_to") - F.col("frame") * stride
    pieces = shown.select(
        "board", "slot", "board_width", "board_height", (F.col("x_from") - F.col("slot") * stride).alias("_at"),
        (F.col("x_to") - F.col("x_from") + 1).alias("pw"), F.col("img_h").alias("ph"),
        _crop("pixels", "img_w", "img_h", "channels", left, right).alias("piece"),
    )
    width = F.least(F.lit(stride), F.col("board_width") - F.col("slot") * stride)
    tiles = _stack(pieces, ["board", "slot"], width, F.col("board_height"), "_at").filter("width > 0")
    return tiles.select("board", "slot", (F.col("slot") * stride).alias("x0"), "width", "height", "bgr")


def _brush_fn(width: int):
    @F.pandas_udf(raster.INTS)
    def fn(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series(outline.brushed_outlines(list(xs), list(ys), width))

    return fn


def outline_runs(layers: DataFrame, boards: DataFrame, stride: int = STRIDE_PX, width: int = 3) -> DataFrame:
    """Outline pixels per board, layer and slot as merged runs: board, layer, slot, y, xs, xe."""
    xs, ys = raster.vertex_arrays("polygon")
    shapes = layers.select("board", "layer", "polygon").distinct()
    drawn = shapes.withColumn("_flat", _brush_fn(width)(xs, ys)).withColumn("_s", F.explode(raster._triples(F.col("_flat"))))
    spans = drawn.select("board", "layer", "_s.*").join(boards.select("board", "board_width", "board_height"), "board")
    zero = F.lit(0)
    clipped = raster.clip_spans(spans, zero, zero, F.col("board_width") - 1, F.col("board_height") - 1)
    runs = raster.merge_spans(clipped.select("board", "layer", "y", "xs", "xe"), ["board", "layer"], chunk=stride)
    return runs.withColumnRenamed("chunk", "slot")


def _overlay_fn(colors: dict[str, tuple[int, int, int]]):
    order = {name: i for i, name in enumerate(colors)}

    @F.pandas_udf(T.BinaryType())
    def fn(
        bgr: pd.Series, w: pd.Series, h: pd.Series, x0: pd.Series, layer: pd.Series, ys: pd.Series, starts: pd.Series, ends: pd.Series
    ) -> pd.Series:
        out = []
        for raw, ww, hh, left, names, y, a, b in zip(bgr, w, h, x0, layer, ys, starts, ends):
            image = np.frombuffer(raw, dtype=np.uint8).reshape(hh, ww, 3).copy()
            for i in sorted(range(len(names)), key=lambda k: order[names[k]]):
                image[y[i], a[i] - left : b[i] - left + 1] = colors[names[i]][::-1]
            out.append(image.tobytes())
        return pd.Series(out)

    return fn


DEFAULT_COLORS = {"gt": (255, 0, 0), "pred": (0, 255, 0)}  # drawn in this order, RGB


def overlay_outlines(
    tiles: DataFrame, layers: DataFrame, boards: DataFrame, colors: dict[str, tuple[int, int, int]] | None = None,
    width: int = 3, stride: int = STRIDE_PX,
) -> DataFrame:
    """Tiles with polygon outlines (board, layer, polygon) drawn on them, layers in the order of ``colors``."""
    colors = colors or DEFAULT_COLORS
    runs = outline_runs(layers.filter(F.col("layer").isin(*colors)), boards, stride, width)
    packed = runs.groupBy("board", "slot").agg(F.collect_list(F.struct("layer", "y", "xs", "xe")).alias("r"))
    item = lambda k, t: F.coalesce(F.transform("r", lambda s: s[k]), F.array().cast(t))
    body = _overlay_fn(colors)(
        "bgr", "width", "height", "x0", item("layer", "array<string>"), item("y", "array<int>"), item("xs", "array<int>"), item("xe", "array<int>")
    )
    joined = tiles.join(packed.withColumn("slot", F.col("slot").cast("int")), ["board", "slot"], "left")
    return joined.select("board", "slot", "x0", "width", "height", body.alias("bgr"))


@F.pandas_udf(T.BinaryType())
def _png(bgr: pd.Series, w: pd.Series, h: pd.Series) -> pd.Series:
    return pd.Series([encode_png(np.frombuffer(r, dtype=np.uint8).reshape(hh, ww, 3)) for r, ww, hh in zip(bgr, w, h)])


def tile_images(tiles: DataFrame) -> DataFrame:
    """PNG bytes per tile: board, slot, png."""
    return tiles.select("board", "slot", _png("bgr", "width", "height").alias("png"))


def board_images(tiles: DataFrame, boards: DataFrame, tiles_per_image: int = TILES_PER_IMAGE) -> DataFrame:
    """board, part, x0, width, height, png: every board as images of ``tiles_per_image`` tiles, so an image's size is bounded whatever the board's."""
    part = F.floor(F.col("slot") / tiles_per_image).cast("int").alias("part")
    spans = tiles.groupBy("board", part).agg(F.min("x0").alias("from"), F.max(F.col("x0") + F.col("width")).alias("to"))
    sized = spans.join(boards.select("board", "board_height"), "board")
    pieces = tiles.withColumn("part", part).join(sized, ["board", "part"]).select(
        "board", "part", "from", (F.col("to") - F.col("from")).alias("image_width"), "board_height", (F.col("x0") - F.col("from")).alias("_at"),
        F.col("width").alias("pw"), F.col("height").alias("ph"), F.col("bgr").alias("piece"),
    )
    whole = _stack(pieces, ["board", "part", "from"], F.col("image_width"), F.col("board_height"), "_at")
    return whole.select("board", "part", F.col("from").alias("x0"), "width", "height", _png("bgr", "width", "height").alias("png"))


def collect_overlays(
    boxes: DataFrame | None = None, seg: DataFrame | None = None, predictions: DataFrame | None = None,
    scope: str = "board", stride: int = STRIDE_PX,
) -> DataFrame:
    """All shapes to draw as one table in canvas coordinates.

    scope 'frame': boxes, seg polygons and frame predictions stay in frame pixels (board, frame, layer,
    polygon). scope 'board': boxes are shifted and predictions are board polygons (board, layer, polygon).
    """
    if scope not in ("frame", "board"):
        raise ValueError(f"unknown scope {scope!r}")
    keys = FRAME if scope == "frame" else ["board"]
    parts: list[DataFrame] = []
    if boxes is not None:
        placed = boxes if scope == "frame" else to_board_boxes(boxes, stride)
        parts.append(placed.select(*keys, F.lit("boxes").alias("layer"), box_polygon(box_cols()).alias("polygon")))
    if seg is not None:
        shape = F.col("polygon") if scope == "frame" else shift_polygon("polygon", F.col("frame") * stride)
        parts.append(seg.select(*keys, F.lit("seg").alias("layer"), shape.alias("polygon")))
    if predictions is not None:
        parts.append(predictions.filter(F.size("polygon") >= 3).select(*keys, F.lit("predictions").alias("layer"), "polygon"))
    if not parts:
        raise ValueError("no layer given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
