"""Numpy on the boxes of many small groups at once: sweeps along x, groups of linked boxes, greedy matching."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from boardlens.operators import outline
from boardlens.operators.batches import Work, column, group_starts
from boardlens.operators.components import smallest_reachable
from boardlens.operators.outline import counter

PAIRS_AT_ONCE = 1 << 20
SHAPES_AT_ONCE = 1 << 15  # pairs whose polygons are copied at once
Boxes = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def boxes_of(table: pa.Table, at: np.ndarray | slice) -> Boxes:
    return tuple(column(table, c)[at] for c in ("x1", "y1", "x2", "y2"))


def iou_of(a: Boxes, b: Boxes) -> np.ndarray:
    """``geometry.bbox_iou``: float32 areas, a double quotient, a float32 result."""
    iw, ih = np.minimum(a[2], b[2]) - np.maximum(a[0], b[0]), np.minimum(a[3], b[3]) - np.maximum(a[1], b[1])
    area = lambda w, h: w.astype(np.float32) * h.astype(np.float32)
    inter = area(iw, ih)
    union = area(a[2] - a[0], a[3] - a[1]) + area(b[2] - b[0], b[3] - b[1]) - inter
    hit = (iw > 0) & (ih > 0) & (union > 0)
    return np.divide(inter, union, out=np.zeros(len(hit)), where=hit, dtype=np.float64).astype(np.float32)


def near_of(a: Boxes, b: Boxes, min_px: float, rel: float) -> np.ndarray:
    """``geometry.is_near``."""
    side = lambda r: np.minimum(r[2] - r[0], r[3] - r[1])
    gap = lambda lo, hi: np.maximum(0.0, (np.maximum(a[lo], b[lo]) - np.minimum(a[hi], b[hi])).astype(np.float64))
    gx, gy = gap(0, 2), gap(1, 3)
    return np.sqrt(gx * gx + gy * gy) <= np.maximum(float(min_px), float(rel) * np.minimum(side(a), side(b)))


def reach_of(box: Boxes, min_px: float, rel: float) -> np.ndarray:
    return np.maximum(float(min_px), float(rel) * np.minimum(box[2] - box[0], box[3] - box[1]))


class Places:
    """x coordinates of groups on one axis, for binary searches; what a search finds may be too much by a little, never too few."""

    def __init__(self, group: np.ndarray, x: np.ndarray):
        begins = np.flatnonzero(np.diff(group, prepend=-1))
        self.low = np.zeros(int(group[-1]) + 1)
        self.low[group[begins]] = np.minimum.reduceat(x.astype(np.float64), begins)
        self.wide = float((x - self.low[group]).max()) + 4
        self.slack = 1e-3 + self.wide * len(self.low) * 1e-15

    def key(self, group: np.ndarray, x: np.ndarray) -> np.ndarray:
        return group * self.wide + np.clip(x - self.low[group], -1, self.wide - 3) + 1


def expanded(begin: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a row and each of its range of rows, some at a time."""
    upto = np.cumsum(count)
    start = 0
    while start < len(upto):
        before = int(upto[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + PAIRS_AT_ONCE, side="right")))
        owner, k = counter(count[start:end])
        yield owner + start, begin[start:end][owner] + k
        start = end


def _groups(starts: np.ndarray, rows: int) -> np.ndarray:
    return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, rows)))


def linked_boxes(on: list[str], id_col: str, linked: Callable[[Boxes, Boxes], np.ndarray], reach: Callable[[Boxes], np.ndarray]) -> Work:
    """Distinct boxes of groups with copies and ``comp``, the smallest id that links connect a box to; rows come by (on, box, id).

    ``reach`` is how far right of a box another one may begin that is still ``linked``.
    """

    def work(table: pa.Table, starts: np.ndarray) -> pa.Table:
        heads = group_starts(table, [*on, "x1", "y1", "x2", "y2"])
        group = _groups(starts, table.num_rows)[heads]
        ids = column(table, id_col)[heads].astype(np.int64)
        box = boxes_of(table, heads)
        n = len(heads)
        at = Places(group, box[0])
        keys = at.key(group, box[0])
        ends = np.append(np.flatnonzero(np.diff(group)) + 1, n)[group]
        last = np.minimum(np.searchsorted(keys, at.key(group, box[2] + reach(box) + at.slack) + at.slack, side="right"), ends)
        begin = np.arange(n) + 1
        label = np.arange(n)
        for i, j in expanded(begin, np.maximum(last - begin, 0)):
            met = linked(tuple(c[i] for c in box), tuple(c[j] for c in box))
            label = smallest_reachable(n, np.concatenate([i[met], np.arange(n)]), np.concatenate([j[met], label]))
        low = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(low, label, ids)
        out = table.select([*on, "x1", "y1", "x2", "y2", id_col]).take(pa.array(heads))
        copies = np.diff(np.append(heads, table.num_rows))
        return out.append_column("copies", pa.array(copies.astype(np.int64))).append_column("comp", pa.array(low[label]))

    return work


def _mask_ious(polygons: outline.Shapes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Raster IoU of polygons a with polygons b."""
    parts = [outline.mask_ious_in_parts(*(outline.taken(polygons, side[k : k + SHAPES_AT_ONCE]) for side in (a, b))) for k in range(0, len(a), SHAPES_AT_ONCE)]
    return np.concatenate([np.empty(0, np.float32), *parts])


def greedy_pairs(on: list[str], threshold: float, pred_id: str, gt_id: str, shapes: Callable[[pa.Table], outline.Shapes] | None = None) -> Work:
    """Greedy matches of the predictions (side 0) and ground truths (side 1) of groups; rows come by (on, side, box, id).

    If ``shapes`` reads polygons, matches have their mask IoU too.
    """
    least = np.float32(threshold)

    def work(table: pa.Table, starts: np.ndarray) -> pa.Table:
        heads = group_starts(table, [*on, "side", "x1", "y1", "x2", "y2"])
        group = _groups(starts, table.num_rows)[heads]
        ids, side = column(table, "id"), column(table, "side")[heads]
        copies = np.diff(np.append(heads, table.num_rows))
        box = boxes_of(table, heads)
        p, g = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        pairs, ious = [(np.empty(0, np.int64),) * 2], [np.empty(0, np.float32)]
        if len(p) and len(g):
            at = Places(group, box[0])
            keys = at.key(group[g], box[0][g])
            widest = np.zeros(int(group[-1]) + 1)
            np.maximum.at(widest, group[g], (box[2] - box[0])[g])
            of = group[p]
            lower = np.searchsorted(keys, at.key(of, box[0][p] - widest[of] - at.slack) - at.slack, side="left")
            upper = np.searchsorted(keys, at.key(of, box[2][p] + at.slack) + at.slack, side="right")
            lower = np.maximum(lower, np.searchsorted(group[g], of, side="left"))
            upper = np.minimum(upper, np.searchsorted(group[g], of, side="right"))
            for i, j in expanded(lower, np.maximum(upper - lower, 0)):
                i, j = p[i], g[j]
                iou = iou_of(tuple(c[i] for c in box), tuple(c[j] for c in box))
                hit = (iou >= least) & (iou > 0)
                pairs.append((i[hit], j[hit]))
                ious.append(iou[hit])
        a, b = (np.concatenate(c) for c in zip(*pairs))
        iou = np.concatenate(ious)
        order = np.lexsort((ids[heads[b]], ids[heads[a]], -iou, group[a]))
        a, b, iou = a[order], b[order], iou[order]
        room = copies.tolist()
        taken = []
        for k, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
            m = min(room[i], room[j])
            if m:
                taken.append((k, m, room[i], room[j]))
                room[i] -= m
                room[j] -= m
        k, m, left_p, left_g = np.array(taken, np.int64).reshape(-1, 4).T
        owner, step = counter(m)
        first = lambda end, left: heads[end[k]][owner] + (copies[end[k]] - left)[owner] + step
        rows, others = first(a, left_p), first(b, left_g)
        out = table.select(on).take(pa.array(rows))
        for name, value in ((pred_id, ids[rows]), (gt_id, ids[others]), ("bbox_iou", iou[k][owner])):
            out = out.append_column(name, pa.array(value))
        return out.append_column("mask_iou", pa.array(_mask_ious(shapes(table), rows, others))) if shapes else out

    return work


def best_hits(on: list[str], shapes: Callable[[pa.Table], outline.Shapes] | None) -> Work:
    """For each detection shape (side 0) of groups the ground truth (side 1) it overlaps most: on, det_id, conf, gt_id, iou.

    Of equal shapes the most confident detection and the ground truth with the smallest id stand for all. Shapes are the boxes or, if
    ``shapes`` reads polygons, what these draw. Ties go to smaller ids.
    """

    def work(table: pa.Table, starts: np.ndarray) -> pa.Table:
        n = table.num_rows
        group, side, ids, box = _groups(starts, n), column(table, "side"), column(table, "id").astype(np.int64), boxes_of(table, slice(None))
        conf = table["conf"].fill_null(float("-inf")).to_numpy()  # a null is less than any number
        ring = np.zeros(n, np.int64)
        if shapes:
            polygons = shapes(table)
            x, y, size = polygons
            points = np.column_stack([x, y])
            ring = outline.numbered(points.tobytes(), (np.cumsum(size) - size) * 16, size * 16, {})
        keys = [group, side, *box, ring]
        order = np.lexsort((ids, -conf, *keys[::-1]))
        ordered = np.column_stack(keys)[order]
        head = order[np.append(True, (ordered[1:] != ordered[:-1]).any(1))] if n else order
        group, side, ids, box = group[head], side[head], ids[head], tuple(c[head] for c in box)
        d, g = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32))]
        if len(d) and len(g):
            g = g[np.lexsort((box[0][g], group[g]))]
            at = Places(group, box[0])
            keys = at.key(group[g], box[0][g])
            widest = np.zeros(int(group.max()) + 1)
            np.maximum.at(widest, group[g], (box[2] - box[0])[g])
            of = group[d]
            lower = np.searchsorted(keys, at.key(of, box[0][d] - widest[of] - at.slack) - at.slack, side="left")
            upper = np.searchsorted(keys, at.key(of, box[2][d] + at.slack) + at.slack, side="right")
            lower = np.maximum(lower, np.searchsorted(group[g], of, side="left"))
            upper = np.minimum(upper, np.searchsorted(group[g], of, side="right"))
            for i, j in expanded(lower, np.maximum(upper - lower, 0)):
                i, j = d[i], g[j]
                a, b = tuple(c[i] for c in box), tuple(c[j] for c in box)
                met = (np.minimum(a[2], b[2]) >= np.maximum(a[0], b[0])) & (np.minimum(a[3], b[3]) >= np.maximum(a[1], b[1]))
                i, j = i[met], j[met]
                if shapes:
                    iou = _mask_ious(polygons, head[i], head[j])
                else:
                    iou = iou_of(tuple(c[i] for c in box), tuple(c[j] for c in box))
                hit = iou > 0
                found.append((i[hit], j[hit], iou[hit]))
        i, j, iou = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((ids[j], -iou, i))
        first = order[np.append(True, np.diff(i[order]) != 0)] if len(order) else order
        rows = head[i[first]]
        out = table.select(on).take(pa.array(rows))
        out = out.append_column("det_id", pa.array(ids[i[first]])).append_column("conf", table["conf"].combine_chunks().take(pa.array(rows)))
        return out.append_column("gt_id", pa.array(ids[j[first]])).append_column("iou", pa.array(iou[first]))

    return work
