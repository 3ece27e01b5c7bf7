"""Small numpy helpers on one shape at a time: scan lines, border tracing, simplification.

They run inside Arrow-batched column functions; every shape is one row of a Spark table.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

Spans = tuple[np.ndarray, np.ndarray, np.ndarray]
Shapes = tuple[np.ndarray, np.ndarray, np.ndarray]  # x and y of all vertices, vertices of each polygon


def merge_rows(row: np.ndarray, a: np.ndarray, b: np.ndarray) -> Spans:
    """Union of intervals per row number; touching intervals fuse."""
    if len(row) == 0:
        return row, a, b
    base = int(a.min())
    wide = int(b.max()) - base + 4
    start = row.astype(np.int64) * wide + (a - base)
    order = np.argsort(start, kind="stable")
    start = start[order]
    reach = np.maximum.accumulate((row.astype(np.int64) * wide + (b - base))[order])
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = start[1:] > reach[:-1] + 1
    heads = np.flatnonzero(fresh)
    tails = np.append(heads[1:], len(start)) - 1
    out = start[heads] // wide
    return out, start[heads] - out * wide + base, reach[tails] - out * wide + base


def counter(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and position of every element of consecutive blocks of the given lengths."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


class Slabs(NamedTuple):
    """Where the slabs lie that runs are numbered by: slab i are the rows from y[i] up to y[i + 1] of its group."""

    group: np.ndarray
    y: np.ndarray

    def rows(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.y[first], self.y[last + 1] - 1


def slab_runs(group: np.ndarray, y1: np.ndarray, y2: np.ndarray, x1: np.ndarray, x2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Slabs]:
    """The union of blocks of each group as sorted disjoint runs: slab, first and last column.

    Rows between two that any block of the group begins at or ends before are equal, so they are one slab and drawn once. The last edge
    of a group begins no slab with runs, so slabs of two groups are no neighbours.
    """
    if not len(group):
        return group, x1, x2, Slabs(group, y1)
    top, tall = int(y1.min()), int(y2.max()) - int(y1.min()) + 2
    begin = group * tall + (y1 - top)
    end = begin + (y2 - y1 + 1)
    edges = np.unique(np.concatenate([begin, end]))
    low = np.searchsorted(edges, begin)
    owner, k = counter(np.searchsorted(edges, end) - low)
    slab, a, b = merge_rows(low[owner] + k, x1[owner], x2[owner])
    return slab, a, b, Slabs(edges // tall, edges % tall + top)


class Rings:
    """The edges of a batch of closed polygons in flat arrays."""

    def __init__(self, xs: list[np.ndarray], ys: list[np.ndarray]):
        size = np.array([len(x) for x in xs], dtype=np.int64)
        flat = lambda parts: np.concatenate(parts).astype(np.int64) if len(parts) else np.empty(0, np.int64)
        self._set(flat(xs), flat(ys), size)

    @classmethod
    def of(cls, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> Rings:
        """Polygons of the given numbers of vertices, one after another."""
        rings = cls.__new__(cls)
        rings._set(x.astype(np.int64), y.astype(np.int64), size)
        return rings

    def _set(self, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> None:
        self.x0, self.y0 = x, y
        self.poly = np.repeat(np.arange(len(size)), size)
        following = np.arange(len(self.x0)) + 1
        ends = np.cumsum(size)[size > 0]
        following[ends - 1] = ends - size[size > 0]
        self.x1, self.y1 = self.x0[following], self.y0[following]
        self.top = int(self.y0.min()) if len(self.y0) else 0
        self.height = (int(self.y0.max()) - self.top + 1) if len(self.y0) else 1

    def row(self, poly: np.ndarray, y: np.ndarray) -> np.ndarray:
        return poly * self.height + (y - self.top)

    def unrow(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        poly = row // self.height
        return poly, row - poly * self.height + self.top

    def border(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns of the 8-connected lines between consecutive vertices."""
        dx, dy = self.x1 - self.x0, self.y1 - self.y0
        steps = np.maximum(np.maximum(np.abs(dx), np.abs(dy)), 1)
        edge, t = counter(steps + 1)
        x = np.floor(self.x0[edge] + t * dx[edge] / steps[edge] + 0.5).astype(np.int64)
        y = np.floor(self.y0[edge] + t * dy[edge] / steps[edge] + 0.5).astype(np.int64)
        return self.row(self.poly[edge], y), x

    def interior(self) -> Spans:
        """Even-odd scan lines through the pixel centres."""
        top, rows = np.minimum(self.y0, self.y1), np.abs(self.y1 - self.y0)
        edge, t = counter(rows)
        y = top[edge] + t
        dx, dy = self.x1 - self.x0, self.y1 - self.y0
        at = self.x0[edge] + (y - self.y0[edge]) * dx[edge] / dy[edge]
        row = self.row(self.poly[edge], y)
        order = np.lexsort((at, row))
        row, at = row[order], at[order]
        left, right = np.ceil(at[0::2] - 1e-9).astype(np.int64), np.floor(at[1::2] + 1e-9).astype(np.int64)
        solid = left <= right
        return row[0::2][solid], left[solid], right[solid]

    def filled(self) -> Spans:
        row, x = self.border()
        inner = self.interior()
        return merge_rows(np.concatenate([row, inner[0]]), np.concatenate([x, inner[1]]), np.concatenate([x, inner[2]]))


def numbered(raw: bytes, begin: np.ndarray, size: np.ndarray, seen: dict[bytes, int]) -> np.ndarray:
    """Numbers of pieces of bytes, equal for equal pieces, in the order they are seen first."""
    return np.array([seen.setdefault(raw[i : i + n], len(seen)) for i, n in zip(begin.tolist(), size.tolist())], np.int64)


def drawn_blocks(x: np.ndarray, y: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Filled polygons as blocks of equal runs: polygon, and rows of first y, last y, first x, last x. Equal shapes are drawn once."""
    owner = np.repeat(np.arange(len(size)), size)
    begin = np.cumsum(size) - size
    some = size > 0
    corner = np.zeros((len(size), 2), np.int64)
    if some.any():
        corner[some] = np.column_stack([np.minimum.reduceat(v, begin[some]) for v in (y, x)])
    points = np.column_stack([x, y]) - corner[owner][:, ::-1]
    raw = points.tobytes()
    seen: dict[bytes, int] = {}
    shape = numbered(raw, begin * 16, size * 16, seen)
    flat = np.frombuffer(b"".join(seen), np.int64).reshape(-1, 2)
    rings = Rings.of(flat[:, 0], flat[:, 1], np.array([len(k) // 16 for k in seen], np.int64))
    row, a, b = rings.filled()
    of, row = rings.unrow(row)
    tall = rings.height + 1  # rows of two shapes are no neighbours
    blocks = blocks_of(of * tall + row - rings.top, a, b)
    of = blocks[:, 0] // tall
    blocks[:, :2] -= (of * tall - rings.top)[:, None]
    order = np.argsort(of, kind="stable")
    blocks, per_shape = blocks[order], np.bincount(of, minlength=len(seen))
    polygon, k = counter(per_shape[shape])
    found = blocks[(np.cumsum(per_shape) - per_shape)[shape][polygon] + k]
    return polygon, found + corner[polygon][:, [0, 0, 1, 1]]


def filled_spans(xs: list[np.ndarray], ys: list[np.ndarray]) -> list[np.ndarray]:
    """Row spans of each filled polygon, its outline included, as flat y, first x, last x triples."""
    rings = Rings(xs, ys)
    row, a, b = rings.filled()
    return _per_polygon(rings, row, a, b, len(xs))


def brushed_outlines(xs: list[np.ndarray], ys: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Row spans of each outline drawn with a square brush, as flat triples."""
    rings = Rings(xs, ys)
    row, x = rings.border()
    poly, y = rings.unrow(row)
    lo, hi = (width - 1) // 2, width // 2
    rings.top, rings.height = rings.top - lo, rings.height + lo + hi
    grown = np.concatenate([rings.row(poly, y + dy) for dy in range(-lo, hi + 1)])
    row, a, b = merge_rows(grown, np.tile(x - lo, lo + hi + 1), np.tile(x + hi, lo + hi + 1))
    return _per_polygon(rings, row, a, b, len(xs))


def _per_polygon(rings: Rings, row: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> list[np.ndarray]:
    poly, y = rings.unrow(row)
    triples = np.column_stack([y, a, b]).astype(np.int32)
    cuts = np.searchsorted(poly, np.arange(1, n))
    return [part.ravel() for part in np.split(triples, cuts)]


def mask_ious(ax: list[np.ndarray], ay: list[np.ndarray], bx: list[np.ndarray], by: list[np.ndarray]) -> np.ndarray:
    """Raster IoU of polygon pairs, all pairs of a batch at once; fewer than three vertices give 0."""
    flat = lambda parts: np.concatenate(parts).astype(np.int64) if len(parts) else np.empty(0, np.int64)
    return _drawn_ious(flat([*ax, *bx]), flat([*ay, *by]), np.array([len(x) for x in (*ax, *bx)], np.int64))


def _drawn_ious(x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The same of n polygons followed by their n partners, in flat arrays."""
    n = len(size) // 2
    polygon, blocks = drawn_blocks(x, y, size)
    area = np.bincount(polygon, weights=(blocks[:, 1] - blocks[:, 0] + 1) * (blocks[:, 3] - blocks[:, 2] + 1), minlength=2 * n)
    slab, a, b, slabs = slab_runs(polygon % n if n else polygon, *blocks.T)
    top, low = slabs.rows(slab, slab)
    union = np.bincount(slabs.group[slab], weights=(low - top + 1) * (b - a + 1), minlength=n)
    shared = area[:n] + area[n:] - union
    shaped = (size[:n] >= 3) & (size[n:] >= 3)
    return np.divide(shared, union, out=np.zeros(n), where=(union > 0) & shaped).astype(np.float32)


def outline_px(shapes: Shapes) -> np.ndarray:
    """About how many pixels the outline of each polygon has."""
    x, y, size = shapes
    px = np.zeros(len(size), np.int64)
    some = np.flatnonzero(size)
    if len(some):
        begins = (np.cumsum(size) - size)[some]
        wide, tall = (np.maximum.reduceat(v, begins) - np.minimum.reduceat(v, begins) for v in (x, y))
        px[some] = size[some] * (np.maximum(wide, tall) + 1)
    return px


def _corners(shapes: Shapes) -> tuple[np.ndarray, np.ndarray]:
    """Which polygons have the four corners of an axis-parallel rectangle, and x1, y1, x2, y2 of polygons with four vertices."""
    x, y, size = shapes
    four = np.flatnonzero(size == 4)
    at = (np.cumsum(size) - size)[four][:, None] + np.arange(4)
    x, y = x[at], y[at]
    flat, steep = ((v == np.roll(v, -1, 1)) & (w != np.roll(w, -1, 1)) for v, w in ((y, x), (x, y)))
    turns = [one[:, 0] & other[:, 1] & one[:, 2] & other[:, 3] for one, other in ((flat, steep), (steep, flat))]
    rect, box = np.zeros(len(size), bool), np.zeros((len(size), 4), np.int64)
    rect[four] = turns[0] | turns[1]
    box[four] = np.column_stack([x.min(1), y.min(1), x.max(1), y.max(1)]) if len(four) else box[four]
    return rect, box


def _only(shapes: Shapes, some: np.ndarray) -> Shapes:
    x, y, size = shapes
    kept = np.repeat(some, size)
    return x[kept], y[kept], size[some]


def taken(shapes: Shapes, rows: np.ndarray) -> Shapes:
    """The polygons of the given rows, repeats allowed."""
    x, y, size = shapes
    owner, k = counter(size[rows])
    at = (np.cumsum(size) - size)[rows][owner] + k
    return x[at], y[at], size[rows]


def mask_ious_in_parts(a: Shapes, b: Shapes, pixels: int = 1 << 18) -> np.ndarray:
    """``mask_ious`` of polygons in flat arrays: rectangles by their corners, others with about that many outline pixels drawn at once."""
    (rect, p), (other, q) = _corners(a), _corners(b)
    rect &= other
    if rect.any():
        out = np.zeros(len(rect), np.float32)
        p, q = p[rect], q[rect]
        area = lambda r: (r[:, 2] - r[:, 0] + 1) * (r[:, 3] - r[:, 1] + 1)
        both = area(np.column_stack([np.maximum(p[:, :2], q[:, :2]), np.maximum(np.minimum(p[:, 2:], q[:, 2:]), np.maximum(p[:, :2], q[:, :2]) - 1)]))
        out[rect] = both / (area(p) + area(q) - both)
        if not rect.all():
            out[~rect] = mask_ious_in_parts(_only(a, ~rect), _only(b, ~rect), pixels)
        return out
    n = len(a[2])
    upto = np.cumsum(outline_px(a) + outline_px(b))
    cuts = [0, *(np.flatnonzero(np.diff(upto // pixels)) + 1).tolist(), n] if n else [0]
    ends = [np.append(0, np.cumsum(side[2])) for side in (a, b)]
    parts = []
    for i, j in zip(cuts, cuts[1:]):
        x, y = (np.concatenate([side[k][end[i] : end[j]] for side, end in zip((a, b), ends)]) for k in (0, 1))
        sizes = [side[2][i:j] for side in (a, b)]
        parts.append(_drawn_ious(x, y, np.concatenate(sizes)))
    return np.concatenate(parts) if parts else np.empty(0, np.float32)


def simplify_closed(points: list[tuple[int, int]], eps: float) -> list[tuple[int, int]]:
    """Douglas-Peucker on a closed ring, split at two far points."""
    return [tuple(p) for p in simplified([points], eps)[0].tolist()]


def _first_best(value: np.ndarray, begins: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest value of each of consecutive blocks and the first place that has it."""
    best = np.maximum.reduceat(value, begins)
    return best, np.minimum.reduceat(np.where(value == best[owner], np.arange(len(value)), len(value)), begins)


def simplified(rings: list[list[tuple[int, int]]], eps: float) -> list[np.ndarray]:
    """Douglas-Peucker on closed rings, each split at two far points; all open segments of a level of all rings are measured at once."""
    given = [np.array(r, np.int64).reshape(-1, 2) for r in rings]
    long = [k for k, r in enumerate(given) if len(r) >= 3]
    if not long:
        return given
    size = np.array([len(given[k]) for k in long])
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(size)), size)
    own = np.concatenate([given[k] for k in long])
    far = lambda at: _first_best(((own - own[at][owner]) ** 2).sum(1), begin, owner)[1]
    a = far(begin)
    b = far(a)
    flat = (own[a] == own[b]).all(1)
    keep = np.zeros(len(own), bool)
    keep[begin[flat]] = True  # all points are equal
    first, second = np.minimum(a, b)[~flat], np.maximum(a, b)[~flat]
    keep[first], keep[second] = True, True
    n, start = size[~flat], begin[~flat]
    ring = lambda at, of: own[start[of] + (at - start[of]) % n[of]]  # places behind a ring's end go round
    of = np.tile(np.arange(len(n)), 2)
    i, j = np.concatenate([first, second]), np.concatenate([second, first + n])
    while True:
        open_ = j - i >= 2
        i, j, of = i[open_], j[open_], of[open_]
        if not len(i):
            break
        sizes = j - i - 1
        begins = np.cumsum(sizes) - sizes
        segment, at = counter(sizes)
        at = at + i[segment] + 1
        here = ring(i, of)
        dx, dy = (ring(j, of) - here).T
        x, y = (ring(at, of[segment]) - here[segment]).T
        point = (dx == 0) & (dy == 0)
        off = np.where(point[segment], x * x + y * y, np.abs(x * dy[segment] - y * dx[segment]))
        best, place = _first_best(off, begins, segment)
        over = np.array([
            m > eps * eps if f else m * m > eps * eps * (u * u + v * v)  # exact integers
            for m, f, u, v in zip(best.tolist(), point.tolist(), dx.tolist(), dy.tolist())
        ])
        i, j, of, mid = i[over], j[over], of[over], at[place][over]
        keep[start[of] + (mid - start[of]) % n[of]] = True
        i, j, of = np.concatenate([i, mid]), np.concatenate([mid, j]), np.tile(of, 2)
    left = np.split(own[keep], np.cumsum(np.bincount(owner[keep], minlength=len(size)))[:-1])
    for k, points in zip(long, left):
        given[k] = points
    return given


def row_ring(y: list[int], a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Outer border of a region with one run per row, corner pixels only, clockwise from the top left."""
    ring = [(a[0], y[0]), (b[0], y[0])]
    for i in range(1, len(y)):
        p, q = b[i - 1], b[i]
        if q > p + 1:
            ring.append((p + 1, y[i]))
        elif q < p - 1:
            ring.append((q + 1, y[i - 1]))
        ring.append((q, y[i]))
    ring.append((a[-1], y[-1]))
    for i in range(len(y) - 1, 0, -1):
        p, q = a[i], a[i - 1]
        if q < p - 1:
            ring.append((p - 1, y[i - 1]))
        elif q > p + 1:
            ring.append((q - 1, y[i]))
        ring.append((q, y[i - 1]))
    return ring[:1] + [pt for pt, prev in zip(ring[1:], ring) if pt not in (prev, ring[0])]


def linked_ends(y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The end of a run that follows each end clockwise along the borders of sorted disjoint runs.

    Ends are numbered 2 i for the left and 2 i + 1 for the right end of run i. Borders run down right ends and up left ends; where a run
    below reaches on to a further run of the same row, the border turns up at that one, and likewise above. A border that
    ends on a last row turns back at the same run. The links are a permutation; each of its cycles is an outer border or a hole's.
    """
    n = len(y)
    wide = int(b.max()) - int(a.min()) + 8
    base = int(a.min()) - 4
    row = (y - int(y.min())).astype(np.int64) * wide
    start, end = row + (a - base), row + (b - base)
    at = np.arange(n)
    low = np.searchsorted(start, end + wide + 1, side="right") - 1  # the last run below that may touch
    touches_low = (low >= 0) & (end[low] >= start + wide - 1) & (start[low] <= end + wide + 1) & (low > at)
    high = np.searchsorted(end, start - wide - 1, side="left")  # the first run above that may touch
    known = np.minimum(high, n - 1)
    touches_high = (high < at) & (start[known] <= end - wide + 1) & (end[known] >= start - wide - 1)
    after = np.minimum(at + 1, n - 1)
    turns_up = touches_low & (at + 1 < n) & (y[after] == y) & (start[after] + wide - 1 <= end[low])
    before = np.maximum(at - 1, 0)
    turns_down = touches_high & (at > 0) & (y[before] == y) & (end[before] - wide + 1 >= start[known])
    links = np.empty(2 * n, np.int64)
    links[1::2] = np.where(turns_up, 2 * after, np.where(touches_low, 2 * low + 1, 2 * at))
    links[0::2] = np.where(turns_down, 2 * before + 1, np.where(touches_high, 2 * known, 2 * at + 1))
    return links


def region_ring(y: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[list[tuple[int, int]], list[int]]:
    """Outer border of one region given by sorted runs, corner pixels only, and its holes as flat y, first x, last x triples.

    The border is the cycle of run ends through the first run; memory follows the runs, not the pixels. A gap
    between two runs of a row belongs to a hole if the run end before it lies on another cycle.
    """
    rows = y.tolist()
    if rows[-1] - rows[0] + 1 == len(rows):
        return row_ring(rows, a.tolist(), b.tolist()), []
    links = linked_ends(y, a, b)
    follow, left, right = links.tolist(), a.tolist(), b.tolist()
    outer = np.zeros(len(links), bool)
    ring, end = [(left[0], rows[0])], 1
    while True:
        outer[end] = True
        i, following = end >> 1, follow[end]
        k = following >> 1
        if end & 1:
            ring.append((right[i], rows[i]))
            if following & 1:  # down to the right end of a run below
                p, q = right[i], right[k]
                if q > p + 1:
                    ring.append((p + 1, rows[k]))
                elif q < p - 1:
                    ring.append((q + 1, rows[i]))
            elif k != i:  # along the top of a run below, up to the next run of this row
                ring += [(right[i] + 1, rows[i] + 1), (left[k] - 1, rows[i] + 1)]
        else:
            ring.append((left[i], rows[i]))
            if not following & 1:  # up to the left end of a run above
                p, q = left[i], left[k]
                if q < p - 1:
                    ring.append((p - 1, rows[k]))
                elif q > p + 1:
                    ring.append((q - 1, rows[i]))
            elif k != i:  # along the bottom of a run above, down to the run before in this row
                ring += [(left[i] - 1, rows[i] - 1), (right[k] + 1, rows[i] - 1)]
        end = following
        if end == 1:
            break
    gap = np.flatnonzero((y[1:] == y[:-1]) & ~outer[1:-1:2])
    holes = np.column_stack([y[gap], b[gap] + 1, a[gap + 1] - 1]).ravel().tolist()
    if ring[-1] == ring[0]:
        ring.pop()
    return ring[:1] + [p for p, before in zip(ring[1:], ring) if p != before], holes


def touching(row: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sorted disjoint runs of neighbouring rows that touch, diagonals included: upper run, lower run."""
    wide = int(b.max()) - int(a.min()) + 8
    base = int(a.min()) - 2
    start, end = row * wide + (a - base), row * wide + (b - base)
    first = np.searchsorted(end, start + wide - 1, side="left")
    after = np.searchsorted(start, end + wide + 1, side="right")
    owner, k = counter(np.maximum(after - first, 0))
    return owner, first[owner] + k


def stacked(row: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of sorted disjoint runs the first run of its block, equal runs in rows that follow each other."""
    wide = int(b.max()) - int(a.min()) + 8
    start = row * wide + (a - int(a.min()))
    at = np.arange(len(row))
    low = np.minimum(np.searchsorted(start, start + wide), len(row) - 1)
    same = (start[low] == start + wide) & (b[low] == b)
    head = at.copy()
    head[low[same]] = at[same]
    while True:
        jumped = head[head]
        if np.array_equal(jumped, head):
            return head
        head = jumped


def blocks_of(y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sorted disjoint runs as blocks: rows of first y, last y, first x, last x."""
    if not len(y):
        return np.empty((0, 4), np.int64)
    head = stacked(y.astype(np.int64), a, b)
    first = np.flatnonzero(head == np.arange(len(y)))
    return np.column_stack([y[first], y[first] + np.bincount(head, minlength=len(y))[first] - 1, a[first], b[first]])


def rows_of(blocks: np.ndarray) -> Spans:
    """The runs of blocks, row by row."""
    owner, k = counter(blocks[:, 1] - blocks[:, 0] + 1)
    return blocks[owner, 0] + k, blocks[owner, 2], blocks[owner, 3]


_traced: dict[float, dict[bytes, tuple[np.ndarray, np.ndarray]]] = {}
TRACED_SHAPES, TRACED_BYTES = 1 << 16, 1 << 12


def _trace(shapes: list[np.ndarray], eps: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Simplified outer borders as flat x, y and holes as flat blocks of regions given as blocks that begin at row 0."""
    sizes = np.array([len(s) for s in shapes])
    blocks = np.concatenate(shapes)
    tall = int(blocks[:, 1].max()) + 1
    blocks[:, :2] += np.repeat(np.arange(len(shapes)) * tall, sizes)[:, None]
    row, a, b = merge_rows(*rows_of(blocks))
    cuts = np.searchsorted(row, np.arange(1, len(shapes)) * tall)
    parts = [np.split(v, cuts) for v in (row % tall, a, b)]
    found = [region_ring(*part) for part in zip(*parts)]
    holes = [blocks_of(*np.array(inner, np.int64).reshape(-1, 3).T) for _, inner in found]
    return list(zip([p.ravel() for p in simplified([ring for ring, _ in found], eps)], holes))


def region_outlines(flat: np.ndarray, sizes: np.ndarray, eps: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Simplified outer borders as flat x, y and holes as flat blocks, both with their sizes, of regions given as flat blocks.

    Borders do not depend on where a region lies, so a worker follows the border of a small shape once for all regions of that shape.
    """
    known = _traced.setdefault(eps, {})
    blocks = flat.astype(np.int64).reshape(-1, 4)
    counts = sizes // 4
    ends = np.cumsum(counts)
    corner = np.minimum.reduceat(blocks, ends - counts)[:, [0, 2]] if len(sizes) else np.empty((0, 2), np.int64)  # the first block need not be the highest
    blocks -= np.repeat(corner, counts, axis=0)[:, [0, 0, 1, 1]]
    raw = blocks.tobytes()
    shapes, large, missed = [None] * len(sizes), [], {}
    for k, (i, j) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
        if (j - i) * 32 > TRACED_BYTES:
            large.append((k, i, j))
            continue
        key = raw[32 * i : 32 * j]
        shapes[k] = known.get(key)
        if shapes[k] is None:
            missed.setdefault(key, []).append(k)
    for k, i, j in large:
        shapes[k] = _trace([blocks[i:j].copy()], eps)[0]
    if missed:
        fresh = dict(zip(missed, _trace([np.frombuffer(key, np.int64).reshape(-1, 4) for key in missed], eps)))
        for key, regions in missed.items():
            for k in regions:
                shapes[k] = fresh[key]
        if len(known) + len(fresh) > TRACED_SHAPES:
            known.clear()
        known.update(fresh)
    out = []
    for part, shift in ((0, corner[:, ::-1]), (1, corner[:, [0, 0, 1, 1]])):
        lengths = np.array([shape[part].size for shape in shapes], np.int64)
        each = np.concatenate([shape[part].ravel() for shape in shapes]) if shapes else np.empty(0, np.int64)
        out.append(((each.reshape(-1, shift.shape[1]) + np.repeat(shift, lengths // shift.shape[1], axis=0)).ravel(), lengths))
    return out


def point_inside(x: float, y: float, px: np.ndarray, py: np.ndarray) -> bool:
    """Even-odd test against a closed ring."""
    qx, qy = np.roll(px, -1), np.roll(py, -1)
    spans = (py <= y) != (qy <= y)
    if not spans.any():
        return False
    px, py, qx, qy = px[spans], py[spans], qx[spans], qy[spans]
    return bool(((px + (y - py) * (qx - px) / (qy - py)) > x).sum() % 2)
