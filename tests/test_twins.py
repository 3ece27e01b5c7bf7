"""Operators against small brute-force twins, on both their usual and their hot-group paths."""

import random
from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from boardlens.functions.geometry import box_polygon
from boardlens.operators import components, matching, outline, pairs, pixels, ranking, raster, splitting, stats, stitching

BOX = "x1 int, y1 int, x2 int, y2 int"


def random_boxes(n, boards=3, seed=1, wide=600, high=120):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        x, y = rnd.randrange(wide), rnd.randrange(high)
        out.append((rnd.randrange(boards), i, x, y, x + rnd.randint(1, 40), y + rnd.randint(1, 30)))
    return out


def flood(mask):
    """8-connected regions as sorted pixel lists."""
    seen, out = np.zeros_like(mask), []
    for y, x in zip(*np.nonzero(mask)):
        if seen[y, x]:
            continue
        todo, region = deque([(y, x)]), []
        seen[y, x] = True
        while todo:
            cy, cx = todo.popleft()
            region.append((cy, cx))
            for ny in range(max(cy - 1, 0), min(cy + 2, mask.shape[0])):
                for nx in range(max(cx - 1, 0), min(cx + 2, mask.shape[1])):
                    if mask[ny, nx] and not seen[ny, nx]:
                        seen[ny, nx] = True
                        todo.append((ny, nx))
        out.append(sorted(region))
    return out


@pytest.mark.parametrize("chunk", [1024, 32])
def test_union_equals_flood_fill(spark, chunk):
    rows = random_boxes(150)
    df = spark.createDataFrame(rows, f"board int, id bigint, {BOX}")
    regions = raster.union_components(raster.rasterize_boxes(df), ["board"], chunk)
    got = {(r.board, r.comp): r for r in raster.region_stats(regions, ["board"]).collect()}
    want = {}
    for b in range(3):
        mask = np.zeros((200, 700), dtype=bool)
        for board, _, x1, y1, x2, y2 in rows:
            if board == b:
                mask[y1 : y2 + 1, x1 : x2 + 1] = True
        for region in flood(mask):
            y, x = region[0]
            want[(b, int(y) * 2**32 + int(x))] = (len(region), min(p[1] for p in region), max(p[1] for p in region))
    assert {k: (r.area, r.x1, r.x2) for k, r in got.items()} == want


@pytest.mark.parametrize("budget", [1 << 19, 40])
def test_union_of_shapes_equals_union_of_their_spans(spark, monkeypatch, budget):
    """Rectangles and cut rings go to tiles whole; a task with little room puts a crowded tile together bit by bit."""
    monkeypatch.setattr(raster, "DRAWN_ROWS", budget)
    rows = [(b, *r) for b, _, *r in random_boxes(150)]
    boxes = spark.createDataFrame(rows, "board int, x1 int, y1 int, x2 int, y2 int")
    ring = F.array("x1", "y1", "x2", "y1", "x2", "y2", "x1", "y2")
    none = F.lit(None).cast("array<int>")
    mixed = boxes.withColumn("ring", F.when(F.col("x1") % 2 == 0, ring).otherwise(none))
    key = lambda df: sorted((r.board, r.comp, r.area, r.x1, r.y1, r.x2, r.y2) for r in raster.region_stats(df, ["board"]).collect())
    want = key(raster.union_components(raster.rasterize_boxes(boxes), ["board"], 64))
    assert key(raster.union_components(boxes, ["board"], 64)) == want
    assert key(raster.union_components(mixed, ["board"], 64)) == want
    area = {r.board: r.area for r in raster.union_area(boxes, ["board"], 64).collect()}
    assert area == {b: sum(w[2] for w in want if w[0] == b) for b in area} and len(area) == 3


def test_tall_shapes_stay_few_rows(spark):
    """The union of a rectangle of 200,000 rows is one block, its outline four corners."""
    boxes = spark.createDataFrame([(1, 3, 0, 90, 199_999), (1, 40, 100, 120, 150_000)], "board int, x1 int, y1 int, x2 int, y2 int")
    assert [tuple(r) for r in raster.merged_blocks(boxes.limit(1), ["board"]).drop("board", "chunk").collect()] == [(0, 199_999, 3, 90)]
    got = raster.trace_regions(raster.union_components(boxes, ["board"]), ["board"]).first()
    assert (got.area, len(got.polygon)) == (88 * 200_000 + 30 * 149_901, 8)


def test_hole_and_island_are_dropped(spark):
    ring = [(0, 0, 60, 5), (0, 55, 60, 60), (0, 0, 5, 60), (55, 0, 60, 60), (25, 25, 30, 30), (100, 10, 110, 20)]
    df = spark.createDataFrame([(1, i, *r) for i, r in enumerate(ring)], f"board int, id bigint, {BOX}")
    out = raster.trace_regions(raster.union_components(raster.rasterize_boxes(df), ["board"], 16), ["board"]).collect()
    assert sorted((r.x1, r.y1, r.x2, r.y2) for r in out) == [(0, 0, 60, 60), (100, 10, 110, 20)]


def test_diagonal_contact_and_gaps(spark):
    def count(*rects):
        df = spark.createDataFrame([(1, i, *r) for i, r in enumerate(rects)], f"board int, id bigint, {BOX}")
        return raster.region_stats(raster.union_components(raster.rasterize_boxes(df), ["board"], 8), ["board"]).count()

    assert count((0, 0, 7, 7), (8, 8, 12, 12)) == 1
    assert count((0, 0, 7, 7), (8, 0, 12, 7)) == 1
    assert count((0, 0, 7, 7), (9, 0, 12, 7)) == 2
    assert count((0, 0, 7, 7), (0, 9, 7, 12)) == 2


def ellipse(cx, cy, rx, ry, n=24):
    t = np.linspace(0, 2 * np.pi, n, endpoint=False)
    return np.rint(cx + rx * np.cos(t)).astype(int), np.rint(cy + ry * np.sin(t)).astype(int)


def test_outline_redraws_exactly():
    rnd = random.Random(5)
    shapes = [ellipse(50, 40, rnd.randint(3, 30), rnd.randint(3, 25)) for _ in range(30)]
    comb = (np.array([0, 9, 9, 6, 6, 3, 3, 0]), np.array([0, 0, 12, 12, 4, 4, 12, 12]))
    for xs, ys in [*shapes, comb]:
        spans = outline.filled_spans([xs], [ys])[0].reshape(-1, 3)
        y, a, b = spans.T
        ring, _ = outline.region_ring(y, a, b)
        px, py = np.array(ring).T
        assert np.array_equal(outline.filled_spans([px], [py])[0].reshape(-1, 3), spans)


STEPS = ((1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1))  # clockwise on screen from east


def followed_border(pixels):
    """Every outer border pixel of a region, clockwise from its first one, by looking at the eight neighbours of each."""
    start = min(pixels, key=lambda p: (p[1], p[0]))
    chain, here, heading, first = [start], start, 0, None
    while True:
        for turn in range(6, 14):
            d = (heading + turn) % 8
            if (here[0] + STEPS[d][0], here[1] + STEPS[d][1]) in pixels:
                break
        else:
            return chain
        if here == start and d == first:
            return chain[:-1]
        first = d if first is None else first
        here, heading = (here[0] + STEPS[d][0], here[1] + STEPS[d][1]), d
        chain.append(here)


def test_border_of_run_ends_equals_followed_pixels():
    rng = np.random.default_rng(3)
    for _ in range(400):
        h, w = rng.integers(2, 10, 2)
        mask = rng.random((h, w)) < rng.choice([0.5, 0.6, 0.7, 0.85])
        for region in flood(mask):
            pixels = {(int(x), int(y)) for y, x in region}
            runs = sorted((y, x) for x, y in pixels if (x - 1, y) not in pixels)
            ends = [next(e for e in range(x, 99) if (e + 1, y) not in pixels) for y, x in runs]
            y, a = np.array(runs).T
            if len(set(y)) == len(y):
                continue  # one run a row has its own shorter way
            ring, holes = outline.region_ring(y, a, np.array(ends))
            assert outline.simplify_closed(ring, 1.0) == outline.simplify_closed(followed_border(pixels), 1.0)
            outside, todo = set(), [(-1, -1)]
            while todo:
                p = todo.pop()
                if p not in outside and p not in pixels and -1 <= p[0] <= w and -1 <= p[1] <= h:
                    outside.add(p)
                    todo += [(p[0] + 1, p[1]), (p[0] - 1, p[1]), (p[0], p[1] + 1), (p[0], p[1] - 1)]
            inner = {(x, y) for y in range(h) for x in range(w)} - pixels - outside
            assert {(x, r) for r, u, v in np.array(holes, int).reshape(-1, 3) for x in range(u, v + 1)} == inner


def test_border_of_a_very_long_board():
    """2,000,000 x 220 px with teeth: memory follows the runs."""
    import tracemalloc

    rows = [[(0, 1_999_999)] if r % 40 == 0 else [(x, x + 3 + r % 3) for x in range(0, 2_000_000, 8000)] for r in range(220)]
    y = np.concatenate([np.full(len(r), k) for k, r in enumerate(rows)])
    a, b = np.array([run for r in rows for run in r]).T
    tracemalloc.start()
    ring, holes = outline.region_ring(y, a, b)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    assert ring[0] == (0, 0) and max(p[0] for p in ring) == 1_999_999 and len(holes) // 3 == 249 * 39 * 5


def test_regions_clipped_apart(spark):
    """A polygon that leaves the canvas falls into two regions."""
    dims = spark.createDataFrame([(1, 0, 64, 40)], "board int, frame int, img_w int, img_h int")
    arch = [(10, 30), (10, 50), (40, 50), (40, 30), (36, 30), (36, 46), (14, 46), (14, 30)]
    polys = spark.createDataFrame([(1, 0, arch)], "board int, frame int, polygon array<struct<x:int,y:int>>")
    got = stitching.stitch_boards(polys, dims).polygons.collect()
    assert sorted((r.x1, r.y1, r.x2, r.y2) for r in got) == [(10, 30, 14, 39), (36, 30, 40, 39)]


def test_filled_spans_cover_even_odd_pixels():
    rnd = random.Random(9)
    polys = []
    for _ in range(20):
        n = rnd.randint(3, 7)
        polys.append((np.array([rnd.randrange(40) for _ in range(n)]), np.array([rnd.randrange(30) for _ in range(n)])))
    for (xs, ys), flat in zip(polys, outline.filled_spans([p[0] for p in polys], [p[1] for p in polys])):
        got = {(x, y) for y, a, b in flat.reshape(-1, 3) for x in range(a, b + 1)}
        inside = {(x, y) for x in range(40) for y in range(30) if outline.point_inside(x + 1e-6, y + 1e-6, xs, ys) and outline.point_inside(x - 1e-6, y - 1e-6, xs, ys)}
        assert inside <= got
        assert {(int(x), int(y)) for x, y in zip(xs, ys)} <= got


def test_mask_iou_equals_pixel_count():
    a, b = ellipse(40, 40, 20, 15), ellipse(50, 45, 18, 22)
    pixels_of = lambda p: {(x, y) for y, u, v in outline.filled_spans([p[0]], [p[1]])[0].reshape(-1, 3) for x in range(u, v + 1)}
    p, q = pixels_of(a), pixels_of(b)
    got = outline.mask_ious([a[0], b[0]], [a[1], b[1]], [b[0], b[0]], [b[1], b[1]])
    assert got[0] == pytest.approx(len(p & q) / len(p | q)) and got[1] == 1


def test_mask_iou_table_equals_pixel_count(spark):
    rnd = random.Random(4)
    box = lambda x, y, w, h: [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    shape = lambda: rnd.choice([
        [(int(x), int(y)) for x, y in zip(*ellipse(rnd.randint(20, 60), rnd.randint(20, 50), rnd.randint(2, 25), rnd.randint(2, 20), 9))],
        box(rnd.randint(0, 40), rnd.randint(0, 30), rnd.randint(1, 30), rnd.randint(1, 30)), box(10, 10, 30, 20)[::-1], [(5, 5), (9, 9)], [(5, 5), (25, 25), (25, 5), (5, 25)],
    ])
    rows = [(i, shape(), shape()) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, a array<struct<x:int,y:int>>, b array<struct<x:int,y:int>>")
    got = {r.id: r.mask_iou for r in raster.with_mask_iou(df, "a", "b").collect()}
    flat = lambda k, c: [np.array([p[c] for p in r[k]]) for r in rows]
    want = outline.mask_ious(flat(1, 0), flat(1, 1), flat(2, 0), flat(2, 1))
    assert [got[i] for i in range(120)] == want.tolist() and 0 < sum(want > 0) < 120


def test_mask_iou_of_long_outlines_equals_that_of_short_ones(spark):
    rnd = random.Random(14)
    shape = lambda: [(int(x), int(y)) for x, y in zip(*ellipse(rnd.randint(20, 60), rnd.randint(20, 50), rnd.randint(2, 25), rnd.randint(2, 20), 9))]
    df = spark.createDataFrame([(i, shape(), shape()) for i in range(40)], "id int, a array<struct<x:int,y:int>>, b array<struct<x:int,y:int>>")
    each = [{r.id: r.mask_iou for r in raster.with_mask_iou(df, "a", "b", at_once=n).collect()} for n in (1 << 16, 300, 0)]
    assert each[0] == each[1] == each[2] and len(each[0]) == 40


def test_stitch_merges_neighbouring_frames(spark):
    """An object seen in two frames becomes one polygon; a frame-edge box is clipped to the canvas."""
    dims = spark.createDataFrame([(7, f, 640, 220) for f in range(3)], "board int, frame int, img_w int, img_h int")
    rows = [(7, 0, 1, 400, 10, 430, 40), (7, 1, 2, 80, 10, 110, 40), (7, 2, 3, 600, 100, 640, 220)]
    df = spark.createDataFrame(rows, f"board int, frame int, ann_id bigint, {BOX}")
    gt = stitching.stitch_gt(df, dims)
    got = sorted((r.x1, r.y1, r.x2, r.y2) for r in gt.polygons.collect())
    assert got == [(400, 10, 430, 40), (1240, 100, 1279, 219)]
    assert gt.stats.first().asDict() == {"board": 7, "raw_annotations": 3, "distinct_estimate": 2}
    polys = df.withColumn("polygon", box_polygon(tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))))
    again = stitching.stitch_boards(polys, dims).polygons.collect()
    assert sorted((r.x1, r.y1, r.x2, r.y2) for r in again) == got


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return np.float32(0)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
    return np.float32(w * h / union)


@pytest.mark.parametrize("t", [0.1, 0.0])
def test_greedy_equals_sequential_loop(spark, t):
    pred = random_boxes(120, 2, seed=3, wide=150, high=60)
    gt = random_boxes(120, 2, seed=4, wide=150, high=60)
    pred += [(b, i + 1000, *r) for b, i, *r in pred[:30]] + [(b, i + 2000, *r) for b, i, *r in pred[:10]]
    gt += [(b, i + 1000, *r) for b, i, *r in gt[:30]] + [(b, i + 500, *r) for b, i, *r in pred[:20]]
    first = lambda rows: {(b, *r): min(i for c, i, *q in rows if (c, *q) == (b, *r)) for b, _, *r in rows}
    p0, g0 = first(pred), first(gt)
    want = set()
    for board in range(2):
        cand = [
            (-iou(p, g), p0[(board, *p)], g0[(board, *g)], i, j)
            for b, i, *p in pred if b == board for c, j, *g in gt if c == board and iou(p, g) >= np.float32(t)
        ]
        zero = sorted((i, j, n) for n, _, _, i, j in cand if n == 0)
        used_p, used_g = set(), set()
        for i, j in [c[3:] for c in sorted(c for c in cand if c[0] != 0)] + [z[:2] for z in zero]:
            if i not in used_p and j not in used_g:
                used_p.add(i)
                used_g.add(j)
                want.add((board, i, j))
    to_df = lambda rows, name: spark.createDataFrame(rows, f"board int, {name} bigint, {BOX}")
    got = matching.greedy_match(to_df(pred, "pred_id"), to_df(gt, "gt_id"), t)
    assert {(r.board, r.pred_id, r.gt_id) for r in got.collect()} == want


@pytest.mark.parametrize("batch", [10**6, 20, 1])
def test_components(spark, batch):
    rnd = random.Random(2)
    edges = [(g, rnd.randrange(80), rnd.randrange(80)) for g in range(3) for _ in range(55)] + [(3, i, i + 1) for i in range(99)]
    nodes = [(g, i) for g in range(4) for i in range(100)]
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for g, a, b in edges:
        lo, hi = sorted((find((g, a)), find((g, b))))
        parent[hi] = lo
    got = components.connected_components(
        spark.createDataFrame(nodes, "g int, id bigint"), spark.createDataFrame(edges, "g int, a bigint, b bigint"), ["g"], "id", "a", "b", batch
    )
    assert {(r.g, r.id): r.comp for r in got.collect()} == {n: find(n)[1] for n in nodes}


def test_streamed_groups_survive_batch_borders(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        test_components(spark, 10**6)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


@pytest.mark.parametrize("backwards", [False, True])
def test_greedy_settles_a_long_chain(spark, monkeypatch, backwards):
    """Evenly spaced equal boxes: every candidate waits for the one before it, 10,000 times over."""
    n = 5000
    tables = []
    monkeypatch.setattr(matching, "cut", lambda df, cut=matching.cut: tables.append(1) or cut(df))
    rows = lambda shift, name: spark.range(n).selectExpr("0 board", f"{'4999 - id' if backwards and name == 'pred_id' else 'id'} {name}", f"20 * id + {shift} x1", "0L y1", f"20 * id + {shift} + 30 x2", "9L y2")
    got = {(r.pred_id, r.gt_id) for r in matching.greedy_match(rows(0, "pred_id"), rows(10, "gt_id"), 0.5).collect()}
    assert got == ({(n - 1 - i, i - 1) for i in range(1, n)} if backwards else {(i, i) for i in range(n)})
    assert len(tables) < 40


@pytest.mark.parametrize("backwards", [False, True])
def test_greedy_follows_a_chain_through_many_ranges(spark, monkeypatch, backwards):
    """A large group spread over tables: tasks follow pointers inside ranges of ids, and only their last steps are doubled."""
    monkeypatch.setattr(pairs, "GROUP_BOXES", 100)
    monkeypatch.setattr(matching, "NEAR_BITS", 5)
    n = 1000
    tables = []
    monkeypatch.setattr(matching, "cut", lambda df, cut=matching.cut: tables.append(1) or cut(df))
    rows = lambda shift, name: spark.range(n).selectExpr("0 board", f"{'999 - id' if backwards and name == 'pred_id' else 'id'} {name}", f"20 * id + {shift} x1", "0L y1", f"20 * id + {shift} + 30 x2", "9L y2")
    got = {(r.pred_id, r.gt_id) for r in matching.greedy_match(rows(0, "pred_id"), rows(10, "gt_id"), 0.5).collect()}
    assert got == ({(n - 1 - i, i - 1) for i in range(1, n)} if backwards else {(i, i) for i in range(n)})
    assert len(tables) < 18


def test_greedy_with_crowded_nodes(spark):
    """Random candidates over few boxes with copies, in the order of a sequential pass."""
    rnd = random.Random(12)
    pred = [(0, i, *rnd.choice([(x, y, x + 40, y + 30) for x in range(0, 60, 4) for y in (0, 5, 9)])) for i in range(150)]
    gt = [(0, i, *rnd.choice([(x, y, x + 36, y + 34) for x in range(0, 60, 3) for y in (0, 4, 8)])) for i in range(170)]
    first = lambda rows: {r[2:]: min(q[1] for q in rows if q[2:] == r[2:]) for r in rows}
    p0, g0, used_p, used_g, want = first(pred), first(gt), set(), set(), set()
    cand = sorted((-iou(p[2:], g[2:]), p0[p[2:]], g0[g[2:]], p[1], g[1]) for p in pred for g in gt if iou(p[2:], g[2:]) >= np.float32(0.1))
    for *_, i, j in cand:
        if i not in used_p and j not in used_g:
            used_p.add(i), used_g.add(j), want.add((i, j))
    to_df = lambda rows, name: spark.createDataFrame(rows, f"board int, {name} bigint, {BOX}")
    got = matching.greedy_match(to_df(pred, "pred_id"), to_df(gt, "gt_id"), 0.1).collect()
    assert {(r.pred_id, r.gt_id) for r in got} == want


def crowds(seed):
    """Piles, dense spots next to each other, long and large boxes, single ones."""
    rnd = random.Random(seed)
    rows = []
    for frame in range(3):
        for _ in range(90):
            x, y = rnd.choice([(20, 20), (52, 20), (20, 47), (300, 100), (420, 100)])
            x, y = x + rnd.random() * 9, y + rnd.random() * 9
            rows.append((frame, len(rows), x, y, x + rnd.choice([3, 12, 20, 75]), y + rnd.choice([0.5, 11, 17, 60])))
        rows += [(frame, len(rows) + i, *rows[-1 - i][2:]) for i in range(15)]
        rows += [(frame, len(rows) + i, x := rnd.random() * 1500, y := rnd.random() * 400, x + 14, y + 12) for i in range(60)]
    return rows


def grouped_by(rows, linked):
    parent = list(range(len(rows)))

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if a[0] == b[0] and linked(a[2:], b[2:]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {(r[0], r[1]): find(i) for i, r in enumerate(rows)}


@pytest.mark.parametrize("min_px, rel", [(5.0, 0.25), (0.0, 0.25), (3.0, 0.0), (0.0, 0.0)])
def test_near_groups_of_crowds(spark, min_px, rel):
    def near(a, b):
        gx, gy = max(0, max(a[0], b[0]) - min(a[2], b[2])), max(0, max(a[1], b[1]) - min(a[3], b[3]))
        return (gx * gx + gy * gy) ** 0.5 <= max(min_px, rel * min(a[2] - a[0], a[3] - a[1], b[2] - b[0], b[3] - b[1]))

    rows = crowds(5)
    want = grouped_by(rows, near)
    df = spark.createDataFrame(rows, "frame int, ann_id bigint, x1 double, y1 double, x2 double, y2 double")
    got = {(r.frame, r.ann_id): r.comp for r in pairs.near_groups(df, ["frame"], "ann_id", min_px, rel).collect()}
    assert got == {k: want[k] for k in got} and len(got) > 400


@pytest.mark.parametrize("t", [0.2, 0.5, 0.8, 1.0])
def test_iou_groups_of_crowds(spark, t):
    rows = crowds(6)
    want = grouped_by(rows, lambda a, b: a == b or iou([np.float32(x) for x in a], [np.float32(x) for x in b]) >= np.float32(t))
    df = spark.createDataFrame(rows, "frame int, ann_id bigint, x1 double, y1 double, x2 double, y2 double")
    got = {(r.frame, r.ann_id): r.comp for r in pairs.iou_groups(df, t, ["frame"], "ann_id").collect()}
    assert got == {k: want[k] for k in got} and len(got) > 400


@pytest.mark.parametrize("at_once", [10, 1 << 12])
def test_small_and_large_groups_agree(spark, monkeypatch, at_once):
    """Groups tasks look at whole and groups spread over the grid give the same; few pairs fit at once."""
    monkeypatch.setattr(pairs, "GROUP_BOXES", at_once)
    rows = crowds(7)
    df = spark.createDataFrame(rows, "frame int, ann_id bigint, x1 double, y1 double, x2 double, y2 double")
    same = lambda a, b: a == b or iou([np.float32(x) for x in a], [np.float32(x) for x in b]) >= np.float32(0.4)
    want = grouped_by(rows, same)
    got = {(r.frame, r.ann_id): r.comp for r in pairs.iou_groups(df, 0.4, ["frame"], "ann_id").collect()}
    assert got == {k: want[k] for k in got} and len(got) > 400
    box = lambda name, shift: df.select(F.col("frame").alias("board"), F.col("ann_id").alias(name), (F.col("x1") + shift).alias("x1"), "y1", (F.col("x2") + shift).alias("x2"), "y2")
    found = [(r.board, r.pred_id, r.gt_id, r.bbox_iou) for r in matching.greedy_match(box("pred_id", 1), box("gt_id", 0), 0.2).collect()]
    first = lambda dx: {(f, x1 + dx, y1, x2 + dx, y2): min(r[1] for r in rows if (r[0], *r[2:]) == (f, x1, y1, x2, y2)) for f, _, x1, y1, x2, y2 in rows}
    p0, g0 = first(1), first(0)
    moved = [(f, i, x1 + 1, y1, x2 + 1, y2) for f, i, x1, y1, x2, y2 in rows]
    f32 = lambda r: [np.float32(x) for x in r[2:]]
    cand = sorted(
        (p[0], -v, p0[(p[0], *p[2:])], g0[(g[0], *g[2:])], p[1], g[1])
        for p in moved for g in rows if p[0] == g[0] and (v := iou(f32(p), f32(g))) >= np.float32(0.2)
    )
    used, pairs_wanted = set(), set()
    for f, _, _, _, i, j in cand:
        if ("p", f, i) not in used and ("g", f, j) not in used:
            used |= {("p", f, i), ("g", f, j)}
            pairs_wanted.add((f, i, j))
    assert {m[:3] for m in found} == pairs_wanted and len(found) > 100


def test_near_pairs_and_clusters(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(160):
        x, y = rnd.uniform(0, 600), rnd.uniform(0, 200)
        rows.append((1, rnd.randrange(12), i, x, y, x + rnd.uniform(0, 120), y + rnd.uniform(0, 60)))
    rows.append((1, rows[0][1], 999, *rows[0][3:]))
    df = spark.createDataFrame(rows, "board int, frame int, ann_id bigint, x1 double, y1 double, x2 double, y2 double")

    def near(a, b):
        gx, gy = max(0, max(a[0], b[0]) - min(a[2], b[2])), max(0, max(a[1], b[1]) - min(a[3], b[3]))
        side = min(a[2] - a[0], a[3] - a[1], b[2] - b[0], b[3] - b[1])
        return (gx * gx + gy * gy) ** 0.5 <= max(5.0, 0.25 * side)

    want = {(p[1], p[2], q[2]) for p in rows for q in rows if p[1] == q[1] and p[2] < q[2] and p[3:] != q[3:] and near(p[3:], q[3:])}
    want = {w for w in want if 999 not in w}
    got = {(r.frame, r.a_ann_id, r.b_ann_id) for r in pairs.near_pairs(df, ["board", "frame"], "ann_id").collect()}
    assert got == want
    flagged = {r.frame for r in pairs.frames_with_cluster(df, ["board", "frame"], "ann_id").collect()}
    assert flagged == {w[0] for w in want} | {rows[0][1]}


def test_ranks_over_wide_id_ranges(spark):
    ids = [0, 5, 1 << 20, (1 << 20) + 1, 1 << 33, 7, (1 << 40) + 3]
    df = spark.createDataFrame([(g, i) for g in (1, 2) for i in ids], "g int, id bigint")
    got = {(r.g, r.id): r["rank"] for r in ranking.rank_by_id(df, ["g"], "id").collect()}
    assert got == {(g, i): k for g in (1, 2) for k, i in enumerate(sorted(ids))}
    nxt = {(r.g, r.id): r["next"] for r in ranking.with_next(df, ["g"], "id").collect()}
    order = sorted(ids)
    assert nxt == {(g, i): n for g in (1, 2) for i, n in zip(order, [*order[1:], None])}


def test_running_sums_of_crowded_values(spark):
    rng = np.random.default_rng(5)
    # nearly all values of the hot group lie within a millionth of 1
    conf = np.unique(np.concatenate([1 - rng.random(6000) * 1e-6, rng.random(40)]))
    rows = [("hot", float(c), int(rng.integers(5))) for c in conf] + [(None, 0.25, 2), (None, 0.5, 3), ("b", 0.5, 7)]
    df = spark.createDataFrame(rows, "g string, conf double, n bigint").repartition(7)
    got = {(r.g, r.conf): r.n for r in ranking.running_sums(df, ["g"], F.col("conf").desc(), ["n"], ranges=6).collect()}
    assert len(got) == len(rows)
    for g in ("hot", "b", None):
        own = sorted(((c, n) for k, c, n in rows if k == g), reverse=True)
        assert [got[g, c] for c, _ in own] == np.cumsum([n for _, n in own]).tolist()
    shares = ranking.ranges_of(df, ["g"], F.col("conf").desc(), 6).groupBy("_part").count().collect()
    assert len(shares) >= 5 and max(r["count"] for r in shares) < 2 * len(rows) / 6
    assert ranking.running_sums(df.limit(0), ["g"], F.col("conf").desc(), ["n"]).count() == 0


def test_split_is_independent_of_partitioning(spark):
    feats = [(b, 4 + b * 7 % 30, 0.0 if b % 3 else 0.4) for b in range(60)]
    df = spark.createDataFrame(feats, "board int, frames int, cluster_frac double")
    one = {tuple(r) for r in splitting.stratified_split(df)[0].collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    two = {tuple(r) for r in splitting.stratified_split(df.orderBy(F.rand(3)).repartition(5))[0].collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert one == two and len(one) == 60


def test_split_arguments(spark):
    feats = spark.createDataFrame([(5, 9, 0.0)], "board int, frames int, cluster_frac double")
    for cuts in ([], [2.0, 1.0], [1.0, 1.0]):
        with pytest.raises(ValueError):
            splitting.stratified_split(feats, [("frames", cuts)])
    table = lambda *rows: spark.createDataFrame(rows, "board int, split string")
    for rows in ([(5, "val"), (5, "test")], [(5, "bogus")], [(5, None)]):
        with pytest.raises(Exception, match="is forced to"):
            splitting.stratified_split(feats, forced=table(*rows))
    assert splitting.stratified_split(feats, forced=table((5, "val"), (5, "val")))[0].first().split == "val"
    with pytest.raises(ValueError):
        splitting.normal_ratios((1, 2))
    with pytest.raises(ValueError):
        splitting.normal_ratios((0, 0, 0))
    with pytest.raises(ValueError):
        splitting.forced_table(spark, {"val": [1], "test": [1]})


def test_mosaic_ownership_with_mixed_widths(spark):
    frames = [(1, 0, 640), (1, 1, 1000), (1, 2, 400), (1, 5, 640), (2, 3, 100)]
    df = spark.createDataFrame(frames, "board int, frame int, img_w int")
    owner = {}
    for b, f, w in frames:
        owner.update({(b, x): f for x in range(f * 320, f * 320 + w)})
    got = {(r.board, x): r.frame for r in pixels.mosaic_ownership(df).collect() for x in range(r.x_from, r.x_to + 1)}
    assert got == owner


def test_hot_group_keeps_every_row(spark):
    """One pile of copies and one long board next to ordinary ones."""
    rows = [(0, i, 10, 10, 40, 40) for i in range(400)] + [(0, 1000 + i, i * 30, 60, i * 30 + 29, 80) for i in range(300)]
    rows += [(b, 5000 + b, 0, 0, 9, 9) for b in range(1, 20)]
    df = spark.createDataFrame(rows, f"board int, ann_id bigint, {BOX}")
    got = {r.board: (r.raw, r.distinct) for r in stats.count_instances(df, 0.5).collect()}
    assert got[0] == (700, 301) and all(got[b] == (1, 1) for b in range(1, 20))
    m = matching.greedy_match(df.withColumnRenamed("ann_id", "pred_id"), df.withColumnRenamed("ann_id", "gt_id"), 0.5)
    assert {(r.board, r.pred_id) for r in m.collect()} == {(r[0], r[1]) for r in rows}
    assert m.filter("pred_id <> gt_id").count() == 0
