"""What keeps the board queries cheap on large tables, and that results stay what they were."""

from __future__ import annotations

import numpy as np

from boardlens.operators import outline, raster


def _flat(polygons):
    xs, ys = zip(*[(np.array([p[0] for p in q]), np.array([p[1] for p in q])) for q in polygons])
    return np.concatenate(xs), np.concatenate(ys), np.array([len(x) for x in xs])


def test_mask_iou_of_rectangles_is_that_of_what_is_drawn():
    box = [(2, 3), (9, 3), (9, 8), (2, 8)]
    a = [box, box[::-1], box[1:] + box[:1], box, [(0, 0), (4, 0), (4, 4), (0, 4)], [(0, 0), (4, 4), (4, 0), (0, 4)], box, [(0, 0), (0, 0), (0, 0), (0, 0)]]
    b = [box, [(4, 4), (4, 12), (20, 12), (20, 4)], [(9, 8), (12, 8), (12, 9), (9, 9)], [(10, 3), (12, 3), (12, 8), (10, 8)], [(1, 1), (5, 2), (3, 6)], box, box[:2], box]
    got = outline.mask_ious_in_parts(_flat(a), _flat(b))
    each = lambda side, k: [np.array([p[k] for p in q]) for q in side]
    assert got.tolist() == outline.mask_ious(each(a, 0), each(a, 1), each(b, 0), each(b, 1)).tolist()


def test_mask_iou_names_a_polygon_once(spark):
    polygon = "array<struct<x:int,y:int>>"
    box = [(0, 0), (4, 0), (4, 4), (0, 4)]
    df = spark.createDataFrame([(1, box, box), (2, None, box), (3, box, [])], f"id int, a {polygon}, b {polygon}")
    found = raster.with_mask_iou(df, "a", "b", any_large=False)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_mask_iou(") == 1 and plan.count("array_max") == 0  # long expressions are not compiled
    assert {r.id: r.mask_iou for r in found.collect()} == {1: 1.0, 2: 0.0, 3: 0.0}


def test_rows_between_edges_are_drawn_once():
    """Tall shapes are a few slabs, not a run for each of their rows."""
    import pyarrow as pa

    boxes = [(0, 9_999, 3, 90), (100, 5_000, 40, 120), (100, 5_000, 300, 310)]
    table = pa.table({"board": pa.array([1] * 3, pa.int32()), "chunk": [0] * 3, **{c: pa.array(v, pa.int32()) for c, v in zip(("y1", "y2", "x1", "x2"), zip(*boxes))}})
    slab, *_ = raster._tile_runs(table, np.array([0]), 1024)
    assert len(slab) == 4
    found = raster._tile_parts(["board", "chunk"], 1024, True)(table, np.array([0])).to_pylist()
    assert [(r["area"], r["y2"], list(r["blocks"])) for r in found] == [
        (88 * 10_000 + 30 * 4_901, 9_999, [0, 99, 3, 90, 100, 5_000, 3, 120, 5_001, 9_999, 3, 90]),
        (11 * 4_901, 5_000, [100, 5_000, 300, 310]),
    ]


def test_equal_shapes_are_drawn_once_and_alike():
    rnd = np.random.default_rng(3)
    kinds = [[(0, 0), (9, 2), (4, 8)], [(2, 0), (6, 0), (8, 2), (8, 5), (6, 7), (2, 7), (0, 5), (0, 2)], [(0, 0), (7, 7), (7, 0), (0, 7)], [(3, 3)], []]
    shapes = [[(x + dx, y + dy) for x, y in kinds[k]] for k, dx, dy in zip(rnd.integers(0, 5, 60), rnd.integers(-40, 4000, 60), rnd.integers(-9, 200, 60))]
    xs, ys = ([np.array([p[k] for p in s], np.int64) for s in shapes] for k in (0, 1))
    polygon, blocks = outline.drawn_blocks(np.concatenate(xs), np.concatenate(ys), np.array([len(s) for s in shapes]))
    got = {(p, y, x) for p, (y1, y2, x1, x2) in zip(polygon.tolist(), blocks.tolist()) for y in range(y1, y2 + 1) for x in range(x1, x2 + 1)}
    want = {(p, y, x) for p, spans in enumerate(outline.filled_spans(xs, ys)) for y, a, b in spans.reshape(-1, 3).tolist() for x in range(a, b + 1)}
    assert got == want


def test_borders_of_a_batch_are_those_of_each_region(monkeypatch):
    monkeypatch.setattr(outline, "_traced", {})
    square, hollow = [0, 4, 0, 4, 2, 2, 5, 6], [0, 0, 0, 9, 1, 5, 0, 0, 1, 5, 9, 9, 6, 6, 0, 9]
    dot, line = [0, 0, 0, 0], [0, 0, 0, 5]
    upwards = [9, 9, 4, 8, 0, 8, 7, 9]  # of two tiles, the lower part first
    moved = lambda flat, dx, dy: [v + (dy if k % 4 < 2 else dx) for k, v in enumerate(flat)]
    regions = [moved(f, 7 * k, 3 * k) for k, f in enumerate([square, hollow, dot, square, upwards, line, upwards, hollow])]
    (flat, sizes), (gaps, holes) = outline.region_outlines(np.concatenate([np.array(r, np.int32) for r in regions]), np.array([len(r) for r in regions]), 1.0)
    split = lambda v, n: [part.tolist() for part in np.split(v, np.cumsum(n)[:-1])]
    for region, polygon, inner in zip(regions, split(flat, sizes), split(gaps, holes)):
        ring, gap = outline.region_ring(*outline.merge_rows(*outline.rows_of(np.array(region).reshape(-1, 4))))
        assert [tuple(p) for p in np.array(polygon).reshape(-1, 2).tolist()] == outline.simplify_closed(ring, 1.0)
        assert inner == outline.blocks_of(*np.array(gap, np.int64).reshape(-1, 3).T).ravel().tolist()


def test_statistics_of_regions_need_no_inner_blocks(spark):
    rows = [(1, 10, 10, 20, 20), (1, 1000, 5, 1100, 9), (1, 1020, 9, 1030, 30), (2, 1023, 0, 1023, 0), (2, 1024, 1, 1024, 1)]
    df = spark.createDataFrame(rows, "board int, x1 int, y1 int, x2 int, y2 int")
    short = raster.union_components(df, ["board"], outlines=False)
    key = lambda regions: sorted(tuple(r) for r in raster.region_stats(regions, ["board"]).collect())
    assert "blocks" not in short.columns and key(short) == key(raster.union_components(df, ["board"])) and len(key(short)) == 3


def test_frames_delivered_once_are_not_shuffled(spark):
    from boardlens.streaming import incremental

    rows = spark.createDataFrame([(1, 0, 640, 220, "2024-01-01"), (1, 1, 640, 200, "2024-01-01"), (1, 1, 640, 210, "2024-01-02")], "board int, frame int, img_w int, img_h int, delivered string")
    history = rows.selectExpr("board", "frame", "img_w", "img_h", "cast(null as array<int>) as detections", "cast(delivered as timestamp) as delivered", "0 as board_group")
    once = incremental.newest_frames(history.filter("img_h <> 200"))
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString() and once.count() == 2
    assert sorted((r.frame, r.img_h) for r in incremental.newest_frames(history).collect()) == [(0, 220), (1, 210)]


def test_enclosed_regions_leave_without_a_shuffle_of_the_others(spark):
    ring = [(0, 0, 60, 5), (0, 55, 60, 60), (0, 0, 5, 60), (55, 0, 60, 60), (25, 25, 30, 30), (100, 10, 110, 20)]
    df = spark.createDataFrame([(1, *r) for r in ring], "board int, x1 int, y1 int, x2 int, y2 int")
    traced = raster.trace_regions(raster.union_components(df, ["board"]), ["board"])
    assert "hashpartitioning" not in traced._jdf.queryExecution().executedPlan().toString() and traced.count() == 2


def test_iou_of_candidates_is_worked_out_once(spark):
    from boardlens.operators import matching

    boxes = lambda c, rows: spark.createDataFrame(rows, f"board int, {c} bigint, x1 int, y1 int, x2 int, y2 int")
    p, g = boxes("pred_id", [(0, 1, 0, 0, 10, 10), (0, 2, 50, 0, 60, 10)]), boxes("gt_id", [(0, 7, 2, 0, 12, 10), (0, 8, 60, 0, 70, 10), (0, 9, 3, 3, 3, 9)])
    found = matching.match_candidates(p, g, 0.5, ["board"], "pred_id", "gt_id")
    join = next(line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line)
    assert join.count("CASE WHEN") == 1  # two of them make the join's code too long to be compiled
    assert [(r.pred_id, r.gt_id, round(r.iou, 4)) for r in found.collect()] == [(1, 7, 0.6667)]
    assert matching.match_candidates(p, g, 0.0, ["board"], "pred_id", "gt_id").count() == 1


def _some_shapes(seed: int):
    rnd = np.random.default_rng(seed)
    rows = []
    for k in range(160):
        x, y, w, h = (int(v) for v in (rnd.integers(0, 60), rnd.integers(0, 30), rnd.integers(1, 20), rnd.integers(1, 12)))
        box = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
        polygon = [box, [(x, y), (x + w, y + h // 2), (x, y + h)], [(x + w // 2, y), (x + w, y + h), (x, y + h)], None][int(rnd.integers(0, 4))]
        rows.append((int(rnd.integers(0, 3)), k, float(rnd.integers(1, 9)) / 10, x, y, x + w, y + h, polygon))
    return rows + [(b, k + 200, c, *more) for b, k, c, *more in rows[:40]] + [(1, 999, 0.5, None, 0, 3, 3, None)]


def test_best_hits_of_small_groups_are_those_of_large_ones(spark, monkeypatch):
    from boardlens.operators import evaluation, pairs

    schema = "board int, id bigint, conf double, x1 int, y1 int, x2 int, y2 int, polygon array<struct<x:int,y:int>>"
    dets = spark.createDataFrame(_some_shapes(1), schema).withColumnRenamed("id", "det_id")
    gts = spark.createDataFrame(_some_shapes(2), schema).withColumnRenamed("id", "gt_id").drop("conf")
    for kind in ("box", "mask"):
        both = evaluation._shapes_of_both(dets, gts, ["board"], kind)
        small = sorted(tuple(r) for r in evaluation._detection_hits(both, ["board"]).collect())
        with monkeypatch.context() as m:
            m.setattr(pairs, "GROUP_BOXES", 10)
            large = sorted(tuple(r) for r in evaluation._detection_hits(both, ["board"]).collect())
        assert small == large and len(small) > 100


def test_shapes_of_small_groups_are_shuffled_once(spark):
    from boardlens.operators import evaluation

    schema = "board int, frame int, cls int, id bigint, conf double, x1 int, y1 int, x2 int, y2 int"
    df = spark.createDataFrame([(0, 0, 0, 1, 0.5, 0, 0, 9, 9)], schema)
    key = ["board", "frame", "cls"]
    both = evaluation._shapes_of_both(df.withColumnRenamed("id", "det_id"), df.withColumnRenamed("id", "gt_id"), key, "box")
    plan = evaluation._detection_hits(both, key)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_matches_get_their_mask_iou_where_they_are_found(spark, monkeypatch):
    """In small groups, in large ones and by joins afterwards, as for very long outlines, matches are the same."""
    from boardlens.operators import evaluation, pairs

    schema = "board int, poly_id bigint, conf double, x1 int, y1 int, x2 int, y2 int, polygon array<struct<x:int,y:int>>"
    pred, gt = (spark.createDataFrame(_some_shapes(k), schema).select("board", "poly_id", "polygon") for k in (5, 6))
    run = lambda: sorted(tuple(r) for r in evaluation.match_polygons(pred, gt, 0.2).collect())
    small = run()
    with monkeypatch.context() as m:
        m.setattr(pairs, "GROUP_BOXES", 10)
        large = run()
    with monkeypatch.context() as m:
        m.setattr(evaluation, "has_large", lambda *_: True)
        joined = run()
    assert small == large == joined and len(small) > 50 and len({r[4] for r in small}) > 5


def test_labelled_frames_of_documents_are_derived_once(spark, monkeypatch):
    from boardlens.plans import catalog

    seen = []
    real = catalog.stitching.stitch_gt
    monkeypatch.setattr(catalog.stitching, "stitch_gt", lambda boxes, dims, **more: seen.append(dims.inputFiles()) or real(boxes, dims, **more))
    catalog.board_documents(spark, "/root/testdata/sf0.001")
    assert seen and not any("lineitem" in f for f in seen[0])
