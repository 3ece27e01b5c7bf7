"""Raster union as blocks of equal runs: (group, y1, y2, x1, x2) with inclusive ends.

Masks never exist as whole boards. Boards are cut into tiles of CHUNK_PX columns, so a very long
board is many small keys. Shapes are shuffled to the tiles they touch, not their rows of pixels, and
a tile's union is put together by the task that holds it.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlens.functions.geometry import polygon_bbox
from boardlens.operators import outline
from boardlens.operators.batches import Work, column, whole_groups
from boardlens.operators.components import connected_components, smallest_reachable
from boardlens.operators.lineage import cut
from boardlens.operators.pairs import BOX

CHUNK_PX = 1024
HOLE_ROWS = 64
DRAWN_ROWS = 1 << 19  # spans a task draws at once
OUTLINE_PX = 1 << 16  # pairs of shapes with longer outlines are compared as tables
INTS = T.ArrayType(T.IntegerType())
_ROW = 1 << 32  # run ids are y * 2**32 + xs


def vertex_arrays(polygon: Column | str) -> tuple[Column, Column]:
    p = F.col(polygon) if isinstance(polygon, str) else polygon
    return p["x"], p["y"]


@F.pandas_udf(INTS)
def _scan_lines(xs: pd.Series, ys: pd.Series) -> pd.Series:
    return pd.Series(outline.filled_spans(list(xs), list(ys)))


def _triples(flat: Column) -> Column:
    """[y, xs, xe, y, xs, xe, ...] to an array of structs."""
    at = lambda i, k: F.get(flat, (i * 3 + k).cast("int"))
    return F.when(F.size(flat) > 0, F.transform(
        F.sequence(F.lit(0), (F.size(flat) / 3).cast("int") - 1),
        lambda i: F.struct(at(i, 0).alias("y"), at(i, 1).alias("xs"), at(i, 2).alias("xe")),
    ))


def rasterize(polys: DataFrame, polygon: str = "polygon") -> DataFrame:
    """One row per scan-line span of each polygon; other columns are kept."""
    xs, ys = vertex_arrays(polygon)
    spans = polys.withColumn("_flat", _scan_lines(xs, ys))
    lines = spans.withColumn("_span", F.explode_outer(_triples(F.col("_flat")))).filter("_span is not null")
    return lines.select(*[c for c in polys.columns if c != polygon], "_span.*")


def rasterize_boxes(boxes: DataFrame) -> DataFrame:
    """Spans of axis-parallel rectangles, corner pixels included; no Python involved."""
    keep = [c for c in boxes.columns if c not in ("x1", "y1", "x2", "y2")]
    return boxes.select(*keep, F.explode(F.sequence("y1", "y2")).alias("y"), F.col("x1").alias("xs"), F.col("x2").alias("xe"))


def clip_spans(spans: DataFrame, x1: Column, y1: Column, x2: Column, y2: Column) -> DataFrame:
    """Cut spans to the inclusive window and drop what falls outside."""
    return (
        spans.filter((F.col("y") >= y1) & (F.col("y") <= y2))
        .withColumns({"xs": F.greatest("xs", x1), "xe": F.least("xe", x2)})
        .filter("xs <= xe")
    )


def _windows(shapes: DataFrame, on: list[str], chunk: int) -> DataFrame:
    """Shapes dealt to chunks of columns: on, chunk, y1, y2, x1, x2 and, for polygons, the ring that is drawn inside this window.

    Shapes are spans (y, xs, xe), rectangles (x1, y1, x2, y2) or rectangles that cut what a flat ``ring`` of vertices (x, y, x, y, ...) draws;
    beside a column ``dx`` the ring is a ``flat_ring`` that lies so far to the right.
    """
    if "xs" in shapes.columns:
        shapes = shapes.withColumns({"x1": F.col("xs"), "x2": F.col("xe"), "y1": F.col("y"), "y2": F.col("y")})
    ring = [c for c in ("ring", "dx") if c in shapes.columns]
    c = F.col("chunk")
    cells = F.explode(F.sequence(F.floor(F.col("x1") / chunk), F.floor(F.col("x2") / chunk))).alias("chunk")
    return shapes.select(*on, "x1", "y1", "x2", "y2", *ring, cells).select(
        *on, "chunk", F.col("y1").cast("int").alias("y1"), F.col("y2").cast("int").alias("y2"),
        F.greatest(F.col("x1"), c * chunk).cast("int").alias("x1"), F.least(F.col("x2"), c * chunk + (chunk - 1)).cast("int").alias("x2"), *ring,
    )


def _rings(table: pa.Table) -> tuple[np.ndarray, outline.Shapes]:
    """Which rows have a ring, and those rings."""
    ring = table["ring"].combine_chunks()
    has = ring.is_valid().to_numpy(zero_copy_only=False)
    if "dx" in table.column_names:
        x, y, size = rings_of(ring)
        return has, (x + np.repeat(table["dx"].fill_null(0).to_numpy(), size), y, size[has])
    flat, _, size = shapes_of(ring, ring)
    return has, (flat[0::2], flat[1::2], size[has] // 2)


def _pixel_rows(table: pa.Table) -> np.ndarray:
    """How many spans the rows of a table of windows draw, about."""
    rows = (column(table, "y2").astype(np.int64) - column(table, "y1") + 1).clip(0)
    if "ring" in table.column_names and table["ring"].null_count < table.num_rows:
        has, rings = _rings(table)
        rows[has] += outline.outline_px(rings)
    return rows


def _tile_runs(table: pa.Table, starts: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, outline.Slabs]:
    """Sorted disjoint runs of each tile (group and chunk): slab, first and last column in the chunk."""
    tile = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
    left = column(table, "chunk").astype(np.int64) * chunk
    y1, y2, x1, x2 = (column(table, c).astype(np.int64) for c in ("y1", "y2", "x1", "x2"))
    x1, x2 = x1 - left, x2 - left
    plain = y1 <= y2
    parts = []
    if "ring" in table.column_names:
        has, rings = _rings(table)
        plain &= ~has
        at = np.flatnonzero(has)
        if len(at):
            poly, blocks = outline.drawn_blocks(*rings)
            of = at[poly]
            top, low = np.maximum(blocks[:, 0], y1[of]), np.minimum(blocks[:, 1], y2[of])
            a, b = np.maximum(blocks[:, 2] - left[of], x1[of]), np.minimum(blocks[:, 3] - left[of], x2[of])
            inside = (a <= b) & (top <= low)
            parts.append(tuple(v[inside] for v in (tile[of], top, low, a, b)))
    parts.append((tile[plain], y1[plain], y2[plain], x1[plain], x2[plain]))
    return outline.slab_runs(*(np.concatenate(p) for p in zip(*parts)))


def _of_tiles(table: pa.Table, starts: np.ndarray, tile: np.ndarray, keys: list[str], values: dict) -> pa.Table:
    """A table with the keys of the given tiles beside further columns."""
    named = table.select(keys).take(pa.array(starts[tile]))
    for name, value in values.items():
        named = named.append_column(name, value if isinstance(value, pa.Array) else pa.array(value))
    return named


def _lists(blocks: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return _list_array(blocks.ravel(), sizes * 4)


def _list_array(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def _tile_blocks(keys: list[str], chunk: int) -> Work:
    """The union of each tile as disjoint blocks: keys, y1, y2, x1, x2."""

    def work(table: pa.Table, starts: np.ndarray) -> pa.Table:
        slab, a, b, slabs = _tile_runs(table, starts, chunk)
        blocks = outline.blocks_of(slab, a, b)
        tile = slabs.group[blocks[:, 0]]
        left = column(table, "chunk").astype(np.int64)[starts[tile]] * chunk
        y1, y2 = slabs.rows(blocks[:, 0], blocks[:, 1])
        values = {"y1": y1, "y2": y2, "x1": blocks[:, 2] + left, "x2": blocks[:, 3] + left}
        return _of_tiles(table, starts, tile, keys, {k: v.astype(np.int32) for k, v in values.items()})

    return work


def _shrink(keys: list[str], chunk: int) -> Callable[[pa.Table], pa.Table]:
    """The rows of one tile as the blocks of their union."""
    work = _tile_blocks(keys, chunk)

    def shrink(table: pa.Table) -> pa.Table:
        out = work(table, np.array([0]))
        for name in table.column_names[out.num_columns :]:
            out = out.append_column(table.schema.field(name), pa.nulls(out.num_rows, table.schema.field(name).type))
        return out

    return shrink


def _by_tile(shapes: DataFrame, on: list[str], chunk: int, work: Work, schema: T.StructType) -> DataFrame:
    """``work`` on the tiles (group and chunk) of shapes.

    Shapes travel as they are and are drawn where their tile is put together; of a tile a task keeps the union so far, at most
    the blocks that fit into a chunk, whatever is drawn on it.
    """
    keys = [*on, "chunk"]
    return whole_groups(_windows(shapes, on, chunk), keys, [], work, schema, DRAWN_ROWS, _pixel_rows, _shrink(keys, chunk))


def _tile_schema(shapes: DataFrame, on: list[str], more: str) -> T.StructType:
    return T.StructType([*(shapes.schema[c] for c in on), *T.StructType.fromDDL("chunk bigint, " + more)])


def merge_spans(spans: DataFrame, on: list[str], chunk: int = CHUNK_PX) -> DataFrame:
    """Disjoint runs per group and row, cut at multiples of ``chunk``: on, chunk, y, xs, xe. Rectangles and polygons do as well as spans."""
    blocks = merged_blocks(spans, on, chunk)
    return blocks.select(*on, "chunk", F.explode(F.sequence("y1", "y2")).alias("y"), F.col("x1").alias("xs"), F.col("x2").alias("xe"))


def merged_blocks(shapes: DataFrame, on: list[str], chunk: int = CHUNK_PX) -> DataFrame:
    """The same runs with equal ones in rows that follow each other as one block: on, chunk, y1, y2, x1, x2."""
    schema = _tile_schema(shapes, on, "y1 int, y2 int, x1 int, x2 int")
    return _by_tile(shapes, on, chunk, _tile_blocks([*on, "chunk"], chunk), schema)


def join_chunks(runs: DataFrame, on: list[str], chunk: int = CHUNK_PX) -> DataFrame:
    """Runs of ``merge_spans`` with the cuts at chunk borders removed: on, y, xs, xe.

    A run that crosses borders is a chain of pieces; only pieces that touch a border take part.
    """
    at_start, at_end = F.col("xs") % chunk == 0, F.col("xe") % chunk == chunk - 1
    inner = runs.filter(~at_start & ~at_end).select(*on, "y", "xs", "xe")
    in_row = Window.partitionBy(*on, "y").orderBy("xs")  # two pieces for each chunk of the row at most
    pieces = runs.filter(at_start | at_end).withColumn("_new", (F.coalesce(F.lag("xe").over(in_row), F.lit(-2)) + 1 < F.col("xs")).cast("int"))
    fused = pieces.withColumn("_run", F.sum("_new").over(in_row)).groupBy(*on, "y", "_run").agg(F.min("xs").alias("xs"), F.max("xe").alias("xe"))
    return inner.unionByName(fused.select(*on, "y", "xs", "xe"))


def _tile_parts(keys: list[str], chunk: int, outlines: bool) -> Work:
    """The connected parts of the union inside each tile, with all their blocks or only those at the border of the tile."""

    def work(table: pa.Table, starts: np.ndarray) -> pa.Table:
        slab, a, b, slabs = _tile_runs(table, starts, chunk)
        if not len(slab):
            return _of_tiles(table, starts, slab, keys, {
                **{c: np.empty(0, np.int64) for c in ("first", "area")}, **{c: np.empty(0, np.int32) for c in BOX}, "open": np.empty(0, bool), "blocks": _lists(np.empty(0), np.empty(0)),
            })
        head = outline.stacked(slab, a, b)
        first = np.flatnonzero(head == np.arange(len(head)))
        number = np.zeros(len(head), np.int64)
        number[first] = np.arange(len(first))
        of = number[head]
        upper, lower = outline.touching(slab, a, b)
        upper, lower = of[upper], of[lower]
        apart = upper != lower
        label = smallest_reachable(len(first), upper[apart], lower[apart])
        order = np.argsort(label, kind="stable")
        top, x1, x2 = slab[first][order], a[first][order], b[first][order]
        tile = slabs.group[top]
        top, low = slabs.rows(top, top + np.bincount(of, minlength=len(first))[order] - 1)
        begins = np.flatnonzero(np.diff(label[order], prepend=-1))
        outer = (x1 == 0) | (x2 == chunk - 1)
        left = column(table, "chunk").astype(np.int64)[starts[tile]] * chunk
        x1, x2 = x1 + left, x2 + left
        kept = np.ones(len(top), bool) if outlines else outer
        values = {
            "first": top[begins] * _ROW + x1[begins], "area": np.add.reduceat((low - top + 1) * (x2 - x1 + 1), begins),
            "x1": np.minimum.reduceat(x1, begins).astype(np.int32), "y1": top[begins].astype(np.int32),
            "x2": np.maximum.reduceat(x2, begins).astype(np.int32), "y2": np.maximum.reduceat(low, begins).astype(np.int32),
            "open": np.logical_or.reduceat(outer, begins), "blocks": _lists(np.column_stack([top, low, x1, x2])[kept], np.add.reduceat(kept.astype(np.int64), begins)),
        }
        return _of_tiles(table, starts, tile[begins], keys, values)

    return work


def _quads(flat: Column) -> Column:
    """[first y, last y, first x, last x, ...] to an array of structs y1, y2, x1, x2."""
    at = lambda i, k: F.get(flat, (i * 4 + k).cast("int"))
    return F.when(F.size(flat) > 0, F.transform(
        F.sequence(F.lit(0), (F.size(flat) / 4).cast("int") - 1),
        lambda i: F.struct(*[at(i, k).alias(n) for k, n in enumerate(("y1", "y2", "x1", "x2"))]),
    ))


def part_links(parts: DataFrame, on: list[str], chunk: int = CHUNK_PX) -> DataFrame:
    """Parts that touch across a border of chunks, diagonals included: on, a_first, b_first."""
    blocks = parts.select(*on, "chunk", "first", F.explode_outer(_quads(F.col("blocks"))).alias("_b")).select(*on, "chunk", "first", "_b.*")
    ends = blocks.filter(F.pmod("x2", F.lit(chunk)) == chunk - 1).select(
        *on, (F.col("chunk") + 1).alias("chunk"), F.explode(F.sequence(F.col("y1") - 1, F.col("y2") + 1)).alias("y"), F.col("first").alias("a_first")
    )
    starts = blocks.filter(F.pmod("x1", F.lit(chunk)) == 0).select(*on, "chunk", F.explode(F.sequence("y1", "y2")).alias("y"), F.col("first").alias("b_first"))
    return ends.join(starts, [*on, "chunk", "y"]).select(*on, "a_first", "b_first").distinct()


def union_components(shapes: DataFrame, on: list[str], chunk: int = CHUNK_PX, outlines: bool = True) -> DataFrame:
    """8-connected regions of the union of all shapes of a group: spans (y, xs, xe), rectangles (x1, y1, x2, y2) or cut rings.

    Returns one row a region: on, comp, area, x1, y1, x2, y2 and, if ``outlines`` are wanted, blocks (flat first y, last y, first x, last x). ``comp`` is the id of the
    region's first run in reading order, so it also orders regions by (top, left).

    A tile of a group is drawn and taken apart by the task that holds it. Only parts that touch the border of their tile go on: links
    between those of neighbouring tiles join them to regions. All others are whole regions.
    """
    schema = _tile_schema(shapes, on, "first bigint, area bigint, x1 int, y1 int, x2 int, y2 int, open boolean, blocks array<int>")
    parts = cut(_by_tile(shapes, on, chunk, _tile_parts([*on, "chunk"], chunk, outlines), schema))
    blocks = [F.flatten(F.collect_list("blocks")).alias("blocks")] if outlines else []
    columns = [*on, "comp", "area", *BOX, *(["blocks"] if outlines else [])]
    inner = parts.filter("not open").withColumnRenamed("first", "comp").select(*columns)
    border = parts.filter("open")
    if border.isEmpty():
        return inner
    linked = connected_components(border, part_links(border, on, chunk), on, "first", "a_first", "b_first")
    joined = linked.groupBy(*on, "comp").agg(
        F.sum("area").alias("area"), F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), *blocks,
    )
    return inner.unionByName(joined.select(*columns))


def region_stats(regions: DataFrame, on: list[str]) -> DataFrame:
    """Area and inclusive bounding box per region."""
    return regions.select(*on, "comp", "area", *BOX)


def union_area(spans: DataFrame, on: list[str], chunk: int = CHUNK_PX) -> DataFrame:
    """Pixels covered per group; sums leave the tiles, no run is collected."""
    rows = (F.col("y2") - F.col("y1") + 1).cast("bigint")
    return merged_blocks(spans, on, chunk).groupBy(*on).agg(F.sum(rows * (F.col("x2") - F.col("x1") + 1)).alias("area"))


def _outline_fn(eps: float):
    @F.arrow_udf(T.StructType([T.StructField("polygon", INTS), T.StructField("holes", INTS)]))
    def fn(blocks: pa.Array) -> pa.Array:
        sizes = blocks.value_lengths().to_numpy(zero_copy_only=False)
        found = outline.region_outlines(blocks.flatten().to_numpy(zero_copy_only=False), sizes, eps)
        return pa.StructArray.from_arrays([_list_array(*part) for part in found], ["polygon", "holes"])

    return fn


def _points(flat: Column) -> Column:
    at = lambda i, k: F.get(flat, (i * 2 + k).cast("int"))
    return F.when(F.size(flat) > 0, F.transform(
        F.sequence(F.lit(0), (F.size(flat) / 2).cast("int") - 1),
        lambda i: F.struct(at(i, 0).alias("x"), at(i, 1).alias("y")),
    )).otherwise(F.array().cast("array<struct<x:int,y:int>>"))


def trace_regions(regions: DataFrame, on: list[str], eps: float = 1.0) -> DataFrame:
    """Outer polygons of regions: on, comp, area, x1, y1, x2, y2, polygon.

    Plain rectangles need only their corners and skip Python. Regions inside a hole of another one are dropped, as are outlines of
    fewer than three points. Holes are blocks of background, and a region lies in one if its first pixel does, which a join on
    cells of the board finds.
    """
    w, h = F.col("x2") - F.col("x1") + 1, F.col("y2") - F.col("y1") + 1
    full = F.col("area") == w.cast("bigint") * h
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    corners = F.array(corner("x1", "y1"), corner("x2", "y1"), corner("x2", "y2"), corner("x1", "y2"))
    empty = F.array().cast("array<int>")
    plain = regions.filter(full & (w > 1) & (h > 1)).withColumns({"polygon": corners, "holes": empty}).drop("blocks")
    odd = regions.filter(~full).withColumn("_o", _outline_fn(eps)("blocks"))
    odd = odd.withColumns({"polygon": _points(F.col("_o.polygon")), "holes": F.col("_o.holes")}).drop("_o", "blocks")
    traced = cut(plain.unionByName(odd))
    kept = traced.filter(F.size("polygon") >= 3).select(*on, "comp", "area", *BOX, "polygon")
    gaps = traced.filter(F.size("holes") > 0).select(*on, F.explode_outer(_quads(F.col("holes"))).alias("_gap")).select(*on, "_gap.*")
    if gaps.isEmpty():
        return kept
    cell = lambda x, size: F.floor(x / size)
    gaps = gaps.withColumn("_cx", F.explode_outer(F.sequence(cell(F.col("x1"), CHUNK_PX), cell(F.col("x2"), CHUNK_PX))))
    gaps = gaps.withColumn("_cy", F.explode_outer(F.sequence(cell(F.col("y1"), HOLE_ROWS), cell(F.col("y2"), HOLE_ROWS))))
    y = F.shiftright("comp", 32)  # comp is the id of the first pixel
    heads = kept.select(*on, "comp", y.cast("int").alias("_y"), (F.col("comp") - y * _ROW).alias("_x"))
    heads = heads.withColumns({"_cx": cell(F.col("_x"), CHUNK_PX), "_cy": cell(F.col("_y"), HOLE_ROWS)})
    enclosed = heads.join(gaps, [*on, "_cx", "_cy"]).filter("_x between x1 and x2 and _y between y1 and y2").select(*on, "comp").distinct()
    enclosed = cut(enclosed)  # mostly few, so that the polygons need no shuffle to lose them
    return kept.join(enclosed, [*on, "comp"], "left_anti")


def shapes_of(x: pa.Array, y: pa.Array) -> outline.Shapes:
    """Lists of coordinates as flat arrays; null lists are empty."""
    flat = lambda v: v.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat(x), flat(y), x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def rings_of(ring: pa.Array) -> outline.Shapes:
    """Flat rings, x before y, taken apart."""
    flat, _, size = shapes_of(ring, ring)
    owner, at = outline.counter(size)
    half = (size // 2)[owner]
    return flat[at < half], flat[(at >= half) & (at < 2 * half)], size // 2


def box_or_ring(table: pa.Table) -> outline.Shapes:
    """The rings that ``ring_unless_box`` gave the rows of a table; rows with an empty one draw their box."""
    ring = table["ring"].combine_chunks()
    x, y, size = rings_of(ring)
    none = ring.value_lengths().to_numpy(zero_copy_only=False) == 0
    x1, y1, x2, y2 = (column(table, c).astype(np.int64)[none] for c in BOX)
    whole = np.where(none, 4, size)
    own = np.repeat(none, whole)
    out = np.empty((2, len(own)), np.int64)
    out[:, ~own] = x, y
    out[:, own] = np.column_stack([x1, x2, x2, x1]).ravel(), np.column_stack([y1, y1, y2, y2]).ravel()
    return out[0], out[1], whole


@F.arrow_udf(T.FloatType())
def _mask_iou(ax: pa.Array, ay: pa.Array, bx: pa.Array, by: pa.Array) -> pa.Array:
    return pa.array(outline.mask_ious_in_parts(shapes_of(ax, ay), shapes_of(bx, by)))


@F.arrow_udf(T.FloatType())
def _ring_iou(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(outline.mask_ious_in_parts(rings_of(a), rings_of(b)))


def mask_iou(a: Column | str, b: Column | str) -> Column:
    """Raster IoU of two polygon columns, row by row and without a shuffle; null polygons have 0."""
    return _mask_iou(*vertex_arrays(a), *vertex_arrays(b))


def flat_ring(polygon: Column | str) -> Column:
    """A polygon as one array, its x before its y."""
    return F.concat(*vertex_arrays(polygon))


def ring_unless_box(polygon: Column | str, box: tuple[Column, Column, Column, Column]) -> Column:
    """The flat ring of a polygon, empty if that is the box itself and [0] if there are no points; never null, as long lists of nulls are slow to send to Python."""
    flat = flat_ring(polygon)
    missing = F.coalesce(F.size(flat), F.lit(0)) <= 0
    return F.when(missing, F.array(F.lit(0))).when(flat == _box_ring(box), F.array().cast("array<int>")).otherwise(flat)


def whole_ring(ring: str, box: tuple[Column, Column, Column, Column]) -> Column:
    """The flat ring that ``ring_unless_box`` has left out."""
    return F.when(F.size(ring) == 0, _box_ring(box)).otherwise(F.col(ring))


def _box_ring(box: tuple[Column, Column, Column, Column]) -> Column:
    x1, y1, x2, y2 = (c.cast("int") for c in box)
    return F.array(x1, x2, x2, x1, y1, y1, y2, y2)


def ring_iou(a: Column | str, b: Column | str) -> Column:
    """The same of two columns of ``flat_ring``."""
    return _ring_iou(a, b)


def is_rectangle(polygon: Column | str) -> Column:
    """Whether a polygon has the four corners of an axis-parallel rectangle, in either direction."""
    x, y = vertex_arrays(polygon)
    corner = lambda i, k: (F.get(x, F.lit(i)) == F.get(x, F.lit(k))) & (F.get(y, F.lit(i)) != F.get(y, F.lit(k)))
    level = lambda i, k: (F.get(y, F.lit(i)) == F.get(y, F.lit(k))) & (F.get(x, F.lit(i)) != F.get(x, F.lit(k)))
    turns = (level(0, 1) & corner(1, 2) & level(2, 3) & corner(3, 0)) | (corner(0, 1) & level(1, 2) & corner(2, 3) & level(3, 0))
    return F.coalesce((F.size(x) == 4) & turns, F.lit(False))


def _runs_of(pairs: DataFrame, polygon: str, side: str) -> DataFrame:
    """The rows of a polygon as disjoint runs: _pair, y, <side>s, <side>e."""
    spans = rasterize(pairs.select("_pair", F.col(polygon).alias("polygon")))
    return spans.select("_pair", "y", F.col("xs").alias(side + "s"), F.col("xe").alias(side + "e"))


def _drawn_pixels(polygon: str) -> Column:
    """No fewer pixels than the outline of a polygon has, about."""
    box = polygon_bbox(polygon)
    return F.size(polygon).cast("bigint") * (F.greatest(box["x2"] - box["x1"], box["y2"] - box["y1"]).cast("bigint") + 1)


def has_large(polys: DataFrame, polygon: str = "polygon", at_once: int = OUTLINE_PX) -> bool:
    """Whether a pair with one of the polygons may have outlines too long to be compared in a row."""
    return not polys.filter(_drawn_pixels(polygon) * 2 > at_once).isEmpty()


def with_mask_iou(pairs: DataFrame, a: str, b: str, name: str = "mask_iou", at_once: int = OUTLINE_PX, any_large: bool = True) -> DataFrame:
    """Add the raster IoU of two polygon columns; polygons of fewer than three points have 0.

    Two rectangles are compared by their corners, other pairs by what is drawn, a batch of rows at a time. Of pairs whose outlines are longer than ``at_once`` pixels the
    runs of both shapes meet as tables, so a pair of very large shapes is many small rows and nothing is held whole. A caller that knows
    that there are none says so, which saves a pass over the pairs.
    """
    drawn = lambda rows: rows.withColumn(name, mask_iou(a, b))
    if not any_large:
        return drawn(pairs)
    shaped = (F.size(a) >= 3) & (F.size(b) >= 3)
    large = F.coalesce(shaped & (_drawn_pixels(a) + _drawn_pixels(b) > at_once) & ~(is_rectangle(a) & is_rectangle(b)), F.lit(False))
    small = drawn(pairs.filter(~large))
    big = cut(pairs.filter(large).withColumn("_pair", F.monotonically_increasing_id()))
    if big.isEmpty():
        return small
    left, right = _runs_of(big, a, "a"), _runs_of(big, b, "b")
    met = left.join(right, ["_pair", "y"]).filter((F.col("as") <= F.col("be")) & (F.col("bs") <= F.col("ae")))
    sizes = (
        met.select("_pair", (F.least("ae", "be") - F.greatest("as", "bs") + 1).alias("_both"), F.lit(0).alias("_area"))
        .unionByName(left.select("_pair", F.lit(0).alias("_both"), (F.col("ae") - F.col("as") + 1).alias("_area")))
        .unionByName(right.select("_pair", F.lit(0).alias("_both"), (F.col("be") - F.col("bs") + 1).alias("_area")))
        .groupBy("_pair").agg(F.sum("_both").alias("_both"), F.sum("_area").alias("_area"))
    )
    ratio = (F.col("_both") / F.nullif(F.col("_area") - F.col("_both"), F.lit(0)).cast("double")).cast("float")
    joined = big.join(sizes, "_pair", "left").withColumn(name, F.coalesce(ratio, F.lit(0.0).cast("float")))
    return small.unionByName(joined.select(*small.columns))
