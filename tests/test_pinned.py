"""Pinned expectations of the geometry and matching operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from boardlens.functions import geometry as G
from boardlens.functions.sqlfuncs import register_sql
from boardlens.operators import evaluation, matching, outline, raster, stats


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def poly(*pts):
    return F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in pts])


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]


def box(*v):
    return tuple(F.lit(c) for c in v)


def test_polygon_bbox_is_exclusive(spark):
    got = one(spark, *[G.polygon_bbox(poly(*p)) for p in (square(0, 0, 10), [(2, 3), (7, 5), (4, 9)], [(4, 4)])])
    assert [(b.x2 - b.x1, b.y2 - b.y1) for b in got] == [(10, 10), (5, 6), (0, 0)]


def test_bbox_iou(spark):
    a = box(0, 0, 10, 10)
    others = [a, box(20, 20, 30, 30), box(10, 0, 20, 10), box(5, 0, 15, 10), box(0, 0, 5, 5), box(3, 3, 3, 9)]
    got = list(one(spark, *[G.bbox_iou(a, b) for b in others]))
    assert got == pytest.approx([1, 0, 0, 1 / 3, 0.25, 0])


def test_mask_iou(spark):
    sq = square(0, 0, 100)
    cases = [(sq, sq), (sq, square(300, 0, 10)), (sq, sq[:2]), (sq, [(x + 50, y) for x, y in sq])]
    got = list(one(spark, *[raster.mask_iou(poly(*a), poly(*b)) for a, b in cases]))
    assert got[:3] == [1, 0, 0]
    assert got[3] == pytest.approx(1 / 3, abs=0.02)


def boxes(spark, name, rows):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], f"board int, {name} bigint, x1 int, y1 int, x2 int, y2 int")


def test_greedy_match(spark):
    def run(p, g, t):
        got = matching.greedy_match(boxes(spark, "pred_id", p), boxes(spark, "gt_id", g), t)
        return sorted((r.pred_id, r.gt_id) for r in got.collect())

    a, far, half = (0, 0, 10, 10), (50, 50, 60, 60), (5, 0, 15, 10)
    assert run([], [a], 0.5) == []
    assert run([a, far], [a, far], 0.5) == [(0, 0), (1, 1)]
    assert run([a], [half], 0.5) == []
    assert run([half, (1, 0, 11, 10)], [a], 0.1) == [(1, 0)]
    assert run([a, a, a], [a, a], 0.5) == [(0, 0), (1, 1)]
    assert run([a, far], [half, (90, 90, 95, 95)], 0.0) == [(0, 0), (1, 1)]


def test_safe_div_and_f1(spark):
    f = lambda v: F.lit(v).cast("float")
    got = one(
        spark, G.safe_div(F.lit(3), F.lit(0)), G.safe_div(F.lit(3), F.lit(-1)), G.safe_div(F.lit(3), F.lit(4)),
        G.f1_score(f(None), f(0.5)), G.f1_score(f(0.0), f(0.0)), G.f1_score(f(0.5), f(0.5)), G.f1_score(f(0.8), f(0.6)),
    )
    assert list(got) == [None, None, 0.75, None, None, 0.5, pytest.approx(0.6857, abs=1e-4)]


@pytest.mark.parametrize(
    "shapes, expected",
    [
        ([(0, 0, 10, 10)], 1),
        ([(0, 0, 10, 10)] * 2, 1),
        ([(0, 0, 10, 10), (50, 50, 60, 60)], 2),
        ([(0, 0, 10, 10), (5, 0, 15, 10)], 2),
        ([(0, 0, 10, 10), (1, 0, 11, 10)], 1),
        ([(0, 0, 10, 10), (0, 0, 10, 10), (50, 50, 60, 60)], 2),
        ([(0, 0, 10, 10), (3, 0, 13, 10), (6, 0, 16, 10)], 1),
        ([(4, 4, 4, 9)] * 3, 3),
    ],
)
def test_count_instances(spark, shapes, expected):
    row = stats.count_instances(boxes(spark, "ann_id", shapes), 0.5).first()
    assert (row.raw, row.distinct) == (len(shapes), expected)


def test_frame_key(spark):
    names = ["12_345", "0_0", "abc", "5_a", "_5", "5_5_5", "", "99999999999_1"]
    b, f = G.frame_key("s")
    got = spark.createDataFrame([(n,) for n in names], "s string").select(b, f).collect()
    assert [tuple(r) for r in got] == [(12, 345), (0, 0)] + [(None, None)] * 6


def test_rounding_modes(spark):
    v = F.array(*[F.lit(x) for x in (0.5, 1.5, 2.5, -0.5, -2.5, 2.4999999)])
    got = one(spark, F.transform(v, G.round_half_even), F.transform(v, G.round_half_away))
    assert got[0] == [0, 2, 2, 0, -2, 2]
    assert got[1] == [1, 2, 3, -1, -3, 2]


def test_tiers_and_quota(spark):
    got = one(
        spark, *[G.tier_label(F.lit(v), [10.0, 23.0]) for v in (10.0, 10.5, 23.0, 24.0)],
        *[G.largest_remainder(F.lit(n), (0.8, 0.1, 0.1)) for n in (1, 2, 3, 5, 10)],
    )
    assert list(got[:4]) == ["[-inf,10]", "(10,23]", "(10,23]", "(23,inf]"]
    assert list(got[4:]) == [[1, 0, 0], [2, 0, 0], [3, 0, 0], [4, 1, 0], [8, 1, 1]]


def test_seg_text_matches_printf(spark):
    points = [(x, y) for x in range(0, 641, 7) for y in (0, 1, 33, 219)]
    got = one(spark, G.seg_text(poly(*points), F.lit(640), F.lit(220), F.lit(0)))[0]
    assert got == "0 " + " ".join(f"{x / 640:.6f} {y / 220:.6f}" for x, y in points)


def test_luminance(spark):
    got = one(spark, G.luminance(F.lit(255), F.lit(255), F.lit(255)), G.luminance(F.lit(10), F.lit(200), F.lit(30)), G.chroma(F.lit(10), F.lit(200), F.lit(30)))
    assert list(got) == [255, 124, 190]


def test_sql_functions(spark):
    register_sql(spark, {"frames": [10.0, 23.0]})
    got = spark.sql(
        """SELECT box_iou(a, b) AS iou, axial_gap(a, c) AS gap, is_near(a, c, 5D, 0.25D) AS near, tier_frames(11D) AS tier FROM (
           SELECT named_struct('x1', 0D, 'y1', 0D, 'x2', 10D, 'y2', 10D) AS a, named_struct('x1', 5D, 'y1', 0D, 'x2', 15D, 'y2', 10D) AS b,
                  named_struct('x1', 13D, 'y1', 14D, 'x2', 20D, 'y2', 20D) AS c)"""
    ).first()
    assert got.iou == pytest.approx(1 / 3) and got.gap == 5 and got.near and got.tier == "(10,23]"


def test_average_precision_by_hand(spark):
    gts = spark.createDataFrame([(1, 0, 0, i, i * 50, 0, i * 50 + 10, 10) for i in range(2)], "board int, frame int, cls int, gt_id bigint, x1 int, y1 int, x2 int, y2 int")
    dets = spark.createDataFrame(
        [(1, 0, 0, 0, 0.9, 0, 0, 10, 10), (1, 0, 0, 1, 0.8, 200, 0, 210, 10), (1, 0, 0, 2, 0.7, 50, 0, 60, 10)],
        "board int, frame int, cls int, det_id bigint, conf double, x1 int, y1 int, x2 int, y2 int",
    )
    got = evaluation.evaluate_detections(dets, gts, thresholds=[0.5])
    assert got.per_class.first().ap == pytest.approx((51 * 1.0 + 50 * 2 / 3) / 101)
    s = got.summary.first()
    assert (s.precision, s.recall) == (pytest.approx(2 / 3), 1.0)


def test_simplify_keeps_dropped_points_close():
    ring = outline.row_ring(list(range(9)), [4, 3, 2, 1, 0, 1, 2, 3, 4], [4, 5, 6, 7, 8, 7, 6, 5, 4])
    assert set(outline.simplify_closed(ring, 1.0)) <= set(ring)
    assert sorted(outline.simplify_closed(ring, 0.5)) == [(0, 4), (4, 0), (4, 8), (8, 4)]


def test_seg_text_of_ties_and_large_sizes(spark):
    """Quotients on a decimal tie and beyond one go as printf sends them; one size does not leak into another."""
    rows = [(x, y, w, h) for w, h in ((640, 220), (640, 64), (3, 7)) for x, y in ((1, 33), (5, 11), (639, 219), (1290, 700), (-5, 0))]
    df = spark.createDataFrame([([(x, y)], w, h) for x, y, w, h in rows], "p array<struct<x:int,y:int>>, w int, h int")
    got = [r[0] for r in df.select(G.seg_text("p", F.col("w"), F.col("h"))).collect()]
    assert got == ["0 %.6f %.6f" % (x / w, y / h) for x, y, w, h in rows]
    from boardlens.functions import numbers

    assert numbers.six_decimals(np.array([1, 33]), 640, 220) == "%.6f 0.150000" % (1 / 640)  # looked up, not built by Catalyst
