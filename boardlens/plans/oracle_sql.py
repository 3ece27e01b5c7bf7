"""The registered queries in ANSI SQL, written against the same source tables for comparison."""

from __future__ import annotations

import re

_TABLES = """
lines_g AS (
  SELECT l_orderkey, l_linenumber, min(l_partkey) AS pk, max(l_suppkey) AS sk FROM lineitem GROUP BY l_orderkey, l_linenumber),
placed AS (
  SELECT l_orderkey // 8 AS board, 2 + (l_orderkey // 8) * 7 % 35 AS nf, l_orderkey * 10 + l_linenumber AS obj_id,
         l_orderkey % 8 * 7 + l_linenumber - 1 AS slot, 8 + pk % 33 AS kw, 6 + sk % 15 AS kh FROM lines_g),
objects AS (
  SELECT CAST(board AS INTEGER) AS board, CAST(nf AS INTEGER) AS nf, obj_id, kw, kh,
         CASE WHEN board % 3 = 0 THEN slot * ((nf * 320 + 260) // 56) ELSE obj_id * 7919 % (nf * 320 + 260) END AS kx,
         CASE WHEN board % 3 = 0 THEN 15 + slot % 4 * 50 ELSE obj_id * 104729 % 195 END AS ky FROM placed),
all_frames AS (
  SELECT board, CAST(unnest(range(0, nf)) AS INTEGER) AS frame FROM (SELECT DISTINCT board, nf FROM objects)),
frames AS (
  SELECT board, frame, board || '_' || frame AS stem, 640 AS img_w, CASE WHEN (board + frame) % 37 = 0 THEN 200 ELSE 220 END AS img_h
  FROM all_frames WHERE (board * 31 + frame * 17) % 29 <> 0),
seen AS (
  SELECT o.*, f.off, o.kx // 320 - f.off AS fr, obj_id * 2 + f.off AS ann_id
  FROM objects o CROSS JOIN (SELECT 0 AS off UNION ALL SELECT 1) f),
ann AS (
  SELECT board, CAST(fr AS INTEGER) AS frame, ann_id, CAST(x0 AS INTEGER) AS x0, CAST(ky AS INTEGER) AS y0,
         CAST(least(kw, 640 - x0) AS INTEGER) AS w0, CAST(kh AS INTEGER) AS h0
  FROM (SELECT *, kx - fr * 320 + off * (ann_id % 3) AS x0 FROM seen WHERE fr >= 0 AND fr < nf)
  WHERE least(kw, 640 - x0) > 0),
micro AS (
  SELECT *, '0.' || lpad(CAST((x0 * 2 + w0) * 1000000::BIGINT // 1280 AS VARCHAR), 6, '0') AS cx,
         '0.' || lpad(CAST((y0 * 2 + h0) * 1000000::BIGINT // 440 AS VARCHAR), 6, '0') AS cy,
         '0.' || lpad(CAST(w0 * 1000000::BIGINT // 640 AS VARCHAR), 6, '0') AS bw,
         '0.' || lpad(CAST(h0 * 1000000::BIGINT // 220 AS VARCHAR), 6, '0') AS bh FROM ann),
label_lines AS (
  SELECT board, frame, ann_id AS line_no,
    CASE WHEN ann_id % 97 = 0 THEN concat_ws(' ', '0', cx, cy, bw, bh, '0.5', '0.5')
         WHEN ann_id % 101 = 0 THEN concat_ws(' ', '0', cx, cy, bw)
         WHEN ann_id % 103 = 0 THEN concat_ws(' ', '0', cx, 'n/a', bw, bh)
         WHEN ann_id % 89 = 0 THEN concat_ws('  ', '0', '0.501953125', cy, '0.00390625', bh)
         WHEN ann_id % 83 = 0 THEN concat_ws(' ', '0', cx, cy, '0.0', bh)
         ELSE concat_ws(' ', '0', cx, cy, bw, bh) END AS line FROM micro),
label_files AS (SELECT board, frame, count(*) AS annots FROM label_lines GROUP BY board, frame),
boxes AS (SELECT board, frame, ann_id, x0 AS x1, y0 AS y1, x0 + w0 AS x2, y0 + h0 AS y2 FROM ann),
all_dets AS (
  SELECT * FROM (
    SELECT board, frame, ann_id AS det_id, 0 AS cls, CAST(20 + ann_id % 80 AS DOUBLE) / 100 AS conf,
      CAST(greatest(0, x0 + ann_id % 5 - 2 + CASE WHEN ann_id % 13 = 0 THEN 90 ELSE 0 END) AS INTEGER) AS x1, y0 AS y1,
      CAST(least(640, x0 + w0 + ann_id % 7 - 2 + CASE WHEN ann_id % 13 = 0 THEN 90 ELSE 0 END) AS INTEGER) AS x2,
      CAST(least(220, y0 + h0 + ann_id % 4 - 1) AS INTEGER) AS y2
    FROM ann) WHERE x2 > x1),
dets AS (SELECT * FROM all_dets WHERE det_id % 11 <> 0)"""

# Parsed label lines: t holds the tokens, numeric tells whether tokens 2-5 are numbers.
_TOKENS = """
tok AS (
  SELECT l.*, f.img_w, f.img_h, string_split_regex(trim(line), '\\s+') AS t FROM label_lines l JOIN frames f USING (board, frame)),
num AS (SELECT *, len(t) AS n, TRY_CAST(t[2] AS DOUBLE) AS cx, TRY_CAST(t[3] AS DOUBLE) AS cy,
  TRY_CAST(t[4] AS DOUBLE) AS bw, TRY_CAST(t[5] AS DOUBLE) AS bh FROM tok),
ok AS (SELECT * FROM num WHERE n >= 5 AND cx IS NOT NULL AND cy IS NOT NULL AND bw IS NOT NULL AND bh IS NOT NULL)"""

_STRICT = (
    _TOKENS
    + """,
strict AS (
  SELECT board, frame, line_no, 0 AS cls, img_w, img_h,
    greatest(0, CAST(round(px - dx) AS INTEGER)) AS x1, greatest(0, CAST(round(py - dy) AS INTEGER)) AS y1,
    least(img_w, CAST(round(px + dx) AS INTEGER)) AS x2, least(img_h, CAST(round(py + dy) AS INTEGER)) AS y2
  FROM (SELECT *, CAST(t[2] AS FLOAT) * CAST(img_w AS FLOAT) AS px, CAST(t[3] AS FLOAT) * CAST(img_h AS FLOAT) AS py,
          CAST(t[4] AS FLOAT) * CAST(img_w AS FLOAT) * 0.5::FLOAT AS dx, CAST(t[5] AS FLOAT) * CAST(img_h AS FLOAT) * 0.5::FLOAT AS dy
        FROM ok WHERE n = 5)),
strict_ok AS MATERIALIZED (SELECT * FROM strict WHERE x2 > x1 AND y2 > y1)"""
)

_FLOATS = (
    _TOKENS
    + """,
floats AS (
  SELECT board, frame, line_no AS ann_id, img_w, img_h, cx * img_w - bw * img_w / 2 AS x1, cy * img_h - bh * img_h / 2 AS y1,
         cx * img_w + bw * img_w / 2 AS x2, cy * img_h + bh * img_h / 2 AS y2 FROM ok)"""
)


def _iou(a: str, b: str) -> str:
    iw = f"(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1))"
    ih = f"(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))"
    area = lambda t: f"CAST(({t}.x2 - {t}.x1) * ({t}.y2 - {t}.y1) AS DOUBLE)"
    inter = f"CAST({iw} * {ih} AS DOUBLE)"
    return (
        f"CASE WHEN {iw} > 0 AND {ih} > 0 THEN CAST({inter} / nullif({area(a)} + {area(b)} - {inter}, 0) AS FLOAT) ELSE 0::FLOAT END"
    )


def _near(a: str, b: str) -> str:
    gx = f"greatest(0, greatest({a}.x1, {b}.x1) - least({a}.x2, {b}.x2))"
    gy = f"greatest(0, greatest({a}.y1, {b}.y1) - least({a}.y2, {b}.y2))"
    side = ", ".join(f"{t}.{c}2 - {t}.{c}1" for t in (a, b) for c in "xy")
    return f"sqrt({gx} * {gx} + {gy} * {gy}) <= greatest(5.0::DOUBLE, 0.25::DOUBLE * least({side}))"


_UNIQ_FLOATS = """uniq AS MATERIALIZED (
  SELECT board, frame, x1, y1, x2, y2, min(ann_id) AS ann_id, count(*) AS copies FROM floats GROUP BY ALL)"""
_NEAR = f"""{_UNIQ_FLOATS},
near AS (SELECT a.board, a.frame, a.ann_id AS a_ann_id, b.ann_id AS b_ann_id, a.copies AS a_copies, b.copies AS b_copies
  FROM uniq a JOIN uniq b ON a.board = b.board AND a.frame = b.frame AND a.ann_id < b.ann_id AND {_near("a", "b")}),
clustered AS (SELECT board, frame FROM near UNION SELECT board, frame FROM uniq WHERE copies > 1)"""
_FEATURES = f"""{_NEAR},
features AS (SELECT f.board, CAST(count(*) AS INTEGER) AS frames, CAST(count(c.board) AS DOUBLE) / count(*) AS cluster_frac
  FROM frames f LEFT JOIN clustered c USING (board, frame) GROUP BY f.board)"""

_SPLIT = f"""{_FEATURES},
forced(board, f) AS (VALUES (3, 'val'), (4, 'test'), (999999999, 'val')),
tagged AS (SELECT s.*, f.f, CASE WHEN f.f IS NOT NULL THEN 'forced' WHEN frames <= 3 THEN 'short' ELSE 'stratum' END AS reason
  FROM features s LEFT JOIN forced f USING (board)),
pool AS (SELECT board, 'frames' || CASE WHEN frames <= 10 THEN '[-inf,10]' WHEN frames <= 23 THEN '(10,23]' ELSE '(23,inf]' END
  || '|cluster_frac' || CASE WHEN cluster_frac <= 0 THEN '[-inf,0]' ELSE '(0,inf]' END AS stratum FROM tagged WHERE reason = 'stratum'),
sizes AS (SELECT stratum, CAST(count(*) AS INTEGER) AS total FROM pool GROUP BY stratum),
parts AS (SELECT stratum, total, i, total * r AS raw, floor(total * r) AS fl
  FROM sizes CROSS JOIN (VALUES (0, 80.0::DOUBLE / 100.0::DOUBLE), (1, 10.0::DOUBLE / 100.0::DOUBLE), (2, 10.0::DOUBLE / 100.0::DOUBLE)) v(i, r)),
lucky AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY raw - fl DESC, i) AS k,
  total - sum(fl) OVER (PARTITION BY stratum) AS rest FROM parts),
quota AS (SELECT stratum, total, i, CAST(fl + CASE WHEN k <= rest THEN 1 ELSE 0 END AS INTEGER) AS q FROM lucky),
alloc AS (SELECT stratum, total, max(CASE WHEN i = 0 THEN q END) AS train, max(CASE WHEN i = 1 THEN q END) AS val,
  max(CASE WHEN i = 2 THEN q END) AS test, total < 10 AS small FROM quota GROUP BY stratum, total),
ranked AS (SELECT p.*, row_number() OVER (PARTITION BY stratum ORDER BY md5('42|' || stratum || '|' || board), board) - 1 AS rk FROM pool p),
assignment AS (
  SELECT board, CASE WHEN rk < train THEN 'train' WHEN rk < train + val THEN 'val' ELSE 'test' END AS split, 'stratum' AS reason, stratum
  FROM ranked JOIN alloc USING (stratum)
  UNION ALL SELECT board, coalesce(f, 'train'), reason, NULL FROM tagged WHERE reason <> 'stratum')"""

_MATCH = f"""
pb AS (SELECT board, det_id AS pred_id, x1 + frame * 320 AS x1, y1, x2 + frame * 320 AS x2, y2 FROM dets WHERE conf >= 0.25),
gb AS (SELECT board, ann_id AS gt_id, x1 + frame * 320 AS x1, y1, x2 + frame * 320 AS x2, y2 FROM boxes),
pr AS (SELECT *, min(pred_id) OVER (PARTITION BY board, x1, y1, x2, y2) AS p0 FROM pb),
gr AS (SELECT *, min(gt_id) OVER (PARTITION BY board, x1, y1, x2, y2) AS g0 FROM gb),
cand AS (SELECT p.board, p.pred_id, g.gt_id, p.p0, g.g0, {_iou("p", "g")} AS iou FROM pr p JOIN gr g USING (board)
  WHERE least(p.x2, g.x2) > greatest(p.x1, g.x1) AND {_iou("p", "g")} >= 0.1::FLOAT)"""


def _greedy(cand: str, name: str = "matched") -> str:
    """Rank-ordered recursion per board; carries the ids already used."""
    return f"""
{name}_r AS MATERIALIZED (SELECT board, pred_id, gt_id, iou, row_number() OVER (PARTITION BY board ORDER BY iou DESC, p0, g0, pred_id, gt_id) AS rn
  FROM {cand}),
{name}_w AS (
  SELECT board, 0::BIGINT AS rn, []::BIGINT[] AS ps, []::BIGINT[] AS gs, NULL::BIGINT AS pred_id, NULL::BIGINT AS gt_id, NULL::FLOAT AS iou
  FROM (SELECT DISTINCT board FROM {name}_r)
  UNION ALL
  SELECT w.board, r.rn, CASE WHEN z.ok THEN list_append(w.ps, r.pred_id) ELSE w.ps END,
         CASE WHEN z.ok THEN list_append(w.gs, r.gt_id) ELSE w.gs END,
         CASE WHEN z.ok THEN r.pred_id END, CASE WHEN z.ok THEN r.gt_id END, CASE WHEN z.ok THEN r.iou END
  FROM {name}_w w JOIN {name}_r r ON r.board = w.board AND r.rn = w.rn + 1,
       LATERAL (SELECT NOT list_contains(w.ps, r.pred_id) AND NOT list_contains(w.gs, r.gt_id) AS ok) z),
{name} AS (SELECT board, pred_id, gt_id, iou FROM {name}_w WHERE pred_id IS NOT NULL)"""


def _components(rects: str, name: str) -> str:
    """Touching-rectangle components (gap of at most one pixel); comp = smallest y1 * 2^32 + x1."""
    return f"""
{name}_n AS MATERIALIZED (SELECT DISTINCT board, x1, y1, x2, y2, y1::BIGINT * 4294967296 + x1 AS corner,
  row_number() OVER (ORDER BY board, x1, y1, x2, y2) AS id FROM (SELECT DISTINCT board, x1, y1, x2, y2 FROM {rects})),
{name}_e AS MATERIALIZED (SELECT a.id AS s, b.id AS d FROM {name}_n a JOIN {name}_n b ON a.board = b.board
  AND a.x1 <= b.x2 + 1 AND b.x1 <= a.x2 + 1 AND a.y1 <= b.y2 + 1 AND b.y1 <= a.y2 + 1),
{name}_r AS (SELECT id AS root, id FROM {name}_n UNION SELECT r.root, e.d FROM {name}_r r JOIN {name}_e e ON e.s = r.id),
{name}_c AS (SELECT r.id, min(n.corner) AS comp FROM {name}_r r JOIN {name}_n n ON n.id = r.root GROUP BY r.id),
{name} AS (SELECT n.*, c.comp FROM {name}_n n JOIN {name}_c c USING (id))"""


_CANVAS = """canvas AS (SELECT board, CAST(max(frame * 320 + img_w) AS INTEGER) AS board_width, max(img_h) AS board_height,
  count(*) AS frames FROM frames GROUP BY board)"""

# Union regions of the detections (clipped to the canvas), with pixels counted over rows.
_REGIONS = f"""{_CANVAS},
rects AS (SELECT board, greatest(x1 + frame * 320, 0) AS x1, greatest(y1, 0) AS y1,
    least(x2 + frame * 320, board_width - 1) AS x2, least(y2, board_height - 1) AS y2
  FROM dets JOIN canvas USING (board) WHERE conf >= 0.25),
rects_ok AS (SELECT DISTINCT * FROM rects WHERE x1 <= x2 AND y1 <= y2)"""

_ROWS = """rows_ AS (SELECT board, CAST(unnest(range(y1, y2 + 1)) AS INTEGER) AS y, x1 AS xs, x2 AS xe FROM rects_ok),
lead_ AS (SELECT *, max(xe) OVER (PARTITION BY board, y ORDER BY xs, xe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM rows_),
isl AS (SELECT *, sum(CASE WHEN reach IS NULL OR xs > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY board, y ORDER BY xs, xe) AS island FROM lead_),
merged AS (SELECT board, y, min(xs) AS xs, max(xe) AS xe FROM isl GROUP BY board, y, island)"""

_EVAL = (
    _CANVAS
    + """,
p_rect AS (SELECT board, greatest(x1 + frame * 320, 0) AS x1, greatest(y1, 0) AS y1, least(x2 + frame * 320, board_width - 1) AS x2,
    least(y2, board_height - 1) AS y2 FROM dets JOIN canvas USING (board) WHERE conf >= 0.25),
g_rect AS (SELECT board, greatest(x1 + frame * 320, 0) AS x1, greatest(y1, 0) AS y1, least(x2 + frame * 320, board_width - 1) AS x2,
    least(y2, board_height - 1) AS y2 FROM boxes JOIN canvas USING (board)),
p_ok AS (SELECT * FROM p_rect WHERE x1 <= x2 AND y1 <= y2), g_ok AS (SELECT * FROM g_rect WHERE x1 <= x2 AND y1 <= y2),"""
    + _components("p_ok", "pc")
    + ","
    + _components("g_ok", "gc")
    + f""",
pbox AS (SELECT board, comp AS pred_id, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM pc GROUP BY board, comp),
gbox AS (SELECT board, comp AS gt_id, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM gc GROUP BY board, comp),
pbr AS (SELECT *, min(pred_id) OVER (PARTITION BY board, x1, y1, x2, y2) AS p0 FROM pbox),
gbr AS (SELECT *, min(gt_id) OVER (PARTITION BY board, x1, y1, x2, y2) AS g0 FROM gbox),
ecand AS (SELECT p.board, p.pred_id, g.gt_id, p.p0, g.g0, {_iou("p", "g")} AS iou FROM pbr p JOIN gbr g USING (board)
  WHERE {_iou("p", "g")} >= 0.5::FLOAT),"""
    + _greedy("ecand", "em")
    + """,
miou AS (SELECT em.board, em.pred_id, em.gt_id, CAST(inter / CAST(pa + ga - inter AS DOUBLE) AS FLOAT) AS iou FROM (
  SELECT em.*, CAST((least(p.x2, g.x2) - greatest(p.x1, g.x1) + 1) * (least(p.y2, g.y2) - greatest(p.y1, g.y1) + 1) AS DOUBLE) AS inter,
    (p.x2 - p.x1 + 1) * (p.y2 - p.y1 + 1) AS pa, (g.x2 - g.x1 + 1) * (g.y2 - g.y1 + 1) AS ga
  FROM em JOIN pbox p ON em.board = p.board AND em.pred_id = p.pred_id JOIN gbox g ON em.board = g.board AND em.gt_id = g.gt_id) em),
common AS (SELECT board FROM pbox INTERSECT SELECT board FROM gbox),
np AS (SELECT board, count(*) AS n FROM pbox GROUP BY board), ng AS (SELECT board, count(*) AS n FROM gbox GROUP BY board),
nm AS (SELECT board, count(*) AS n, avg(CAST(iou AS DOUBLE)) AS m, sum(CAST(iou AS DOUBLE)) AS s FROM miou GROUP BY board),
per_board AS (SELECT board, np.n AS pred_count, ng.n AS gt_count, coalesce(nm.n, 0) AS tp, np.n - coalesce(nm.n, 0) AS fp,
    ng.n - coalesce(nm.n, 0) AS fn, coalesce(m, 0) AS mean_iou, coalesce(s, 0) AS iou_sum,
    CAST(coalesce(nm.n, 0) / CAST(np.n AS DOUBLE) AS FLOAT) AS p, CAST(coalesce(nm.n, 0) / CAST(ng.n AS DOUBLE) AS FLOAT) AS r
  FROM common JOIN np USING (board) JOIN ng USING (board) LEFT JOIN nm USING (board))"""
)


def _instances(name: str = "inst") -> str:
    """Components of annotation boxes with IoU >= 0.5 in board space."""
    return f"""
{name}_n AS MATERIALIZED (SELECT board, frame, ann_id, x1 + frame * 320 AS x1, y1, x2 + frame * 320 AS x2, y2 FROM boxes),
{name}_e AS MATERIALIZED (SELECT a.board, a.ann_id AS s, b.ann_id AS d FROM {name}_n a JOIN {name}_n b ON a.board = b.board
  WHERE {_iou("a", "b")} >= 0.5::FLOAT),
{name}_r AS (SELECT ann_id AS root, ann_id AS id FROM {name}_n UNION SELECT r.root, e.d FROM {name}_r r JOIN {name}_e e ON e.s = r.id),
{name} AS (SELECT n.board, n.ann_id, c.comp FROM {name}_n n JOIN (SELECT id, min(root) AS comp FROM {name}_r GROUP BY id) c ON c.id = n.ann_id)"""


_FRAME_CLUSTERS = f"""{_NEAR},
fc_e AS MATERIALIZED (SELECT a_ann_id AS s, b_ann_id AS d FROM near UNION ALL SELECT b_ann_id, a_ann_id FROM near),
fc_r AS (SELECT ann_id AS root, ann_id AS id FROM uniq UNION SELECT r.root, e.d FROM fc_r r JOIN fc_e e ON e.s = r.id),
fc AS (SELECT u.board, u.frame, u.copies, c.comp FROM uniq u JOIN (SELECT id, min(root) AS comp FROM fc_r GROUP BY id) c ON c.id = u.ann_id)"""

_AP = f"""
ag AS (SELECT board, frame, x1, y1, x2, y2, min(ann_id) AS gt_id FROM boxes GROUP BY ALL),
ad AS (SELECT board, frame, x1, y1, x2, y2, max(conf) AS conf, arg_max(det_id, conf * 1e9 - det_id * 1e-9) AS det_id
  FROM dets GROUP BY board, frame, x1, y1, x2, y2),
ah AS (SELECT d.board, d.frame, d.det_id, d.conf, g.gt_id, {_iou("d", "g")} AS iou,
    row_number() OVER (PARTITION BY d.board, d.frame, d.x1, d.y1, d.x2, d.y2 ORDER BY {_iou("d", "g")} DESC, g.gt_id) AS rn
  FROM ad d JOIN ag g USING (board, frame) WHERE {_iou("d", "g")} > 0),
lv AS (SELECT CAST(t AS FLOAT) AS threshold FROM (SELECT unnest([0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]) AS t)),
credit AS (SELECT threshold, gt_id, max(conf) AS conf FROM ah, lv WHERE rn = 1 AND iou >= threshold GROUP BY threshold, board, frame, gt_id),
pts AS (SELECT threshold, conf, sum(n) AS n, sum(tp) AS tp FROM (
    SELECT threshold, conf, count(*) AS n, 0 AS tp FROM dets, lv GROUP BY threshold, conf
    UNION ALL SELECT threshold, conf, 0, count(*) FROM credit GROUP BY threshold, conf) GROUP BY threshold, conf),
tot AS (SELECT count(*) AS gt FROM boxes),
curve AS (SELECT threshold, conf, sum(tp) OVER w / CAST(sum(n) OVER w AS DOUBLE) AS p, sum(tp) OVER w AS ctp, gt,
    sum(tp) OVER w / CAST(gt AS DOUBLE) AS r
  FROM pts, tot WINDOW w AS (PARTITION BY threshold ORDER BY conf DESC)),
grid AS (SELECT threshold, k, coalesce(max(p), 0) AS best FROM (
    SELECT lv.threshold, ks.k, c.p FROM lv CROSS JOIN (SELECT unnest(range(0, 101)) AS k) ks
    LEFT JOIN curve c ON c.threshold = lv.threshold AND c.ctp * 100 >= ks.k * c.gt) GROUP BY threshold, k),
ap AS (SELECT threshold, sum(best) / 101 AS ap FROM grid GROUP BY threshold)"""


def _q(body: str, *ctes: str, recursive: bool = False) -> str:
    base = re.sub(r"(\n\w+ AS )\(", r"\1MATERIALIZED (", _TABLES)  # several parts of a statement read the derived tables
    parts = ",".join([base, *ctes])
    return f"WITH {'RECURSIVE ' if recursive else ''}{parts}\n{body}"


def statements() -> dict[str, str]:
    px = lambda e: f"printf('%.6f', CAST({e} AS DOUBLE) / 640)"
    py = lambda e: f"printf('%.6f', CAST({e} AS DOUBLE) / 220)"
    corners = ["x1 + c,y1", "x2 - c,y1", "x2,y1 + c", "x2,y2 - c", "x2 - c,y2", "x1 + c,y2", "x1,y2 - c", "x1,y1 + c"]
    ring = ", ".join(f"{px(x)}, {py(y)}" for x, y in (v.split(",") for v in corners))
    r6 = lambda *cols: ", ".join(f"round({c}, 6) AS {c}" for c in cols)
    return {
        "frame_keys": _q(
            """SELECT s AS stem, CAST(CASE WHEN regexp_full_match(s, '[0-9]+_[0-9]+') THEN split_part(s, '_', 1) END AS INTEGER) AS board,
               CAST(CASE WHEN regexp_full_match(s, '[0-9]+_[0-9]+') THEN split_part(s, '_', 2) END AS INTEGER) AS frame FROM (
               SELECT CASE board % 5 WHEN 0 THEN '_' || frame WHEN 1 THEN board || '_a' WHEN 2 THEN stem || '_5' ELSE stem END AS s FROM frames)"""
        ),
        "labels_float": _q(f"SELECT board, frame, line_no, 0 AS cls, img_w, img_h, {r6('x1', 'y1', 'x2', 'y2')} FROM (SELECT ann_id AS line_no, * FROM floats)", _FLOATS),
        "labels_int": _q(
            """SELECT board, frame, line_no, 0 AS cls, img_w, img_h, x1, y1, x2, y2 FROM (
               SELECT *, greatest(0, CAST(round_even(cx * img_w - bw * img_w / 2, 0) AS INTEGER)) AS x1,
                 greatest(0, CAST(round_even(cy * img_h - bh * img_h / 2, 0) AS INTEGER)) AS y1,
                 least(img_w, CAST(round_even(cx * img_w + bw * img_w / 2, 0) AS INTEGER)) AS x2,
                 least(img_h, CAST(round_even(cy * img_h + bh * img_h / 2, 0) AS INTEGER)) AS y2 FROM ok) WHERE x2 > x1 AND y2 > y1""",
            _TOKENS,
        ),
        "labels_strict": _q("SELECT * FROM strict_ok", _STRICT),
        "label_rejects": _q(
            """SELECT board, frame, line_no, line, reason FROM (
               SELECT num.*, CASE WHEN n < 5 THEN 'few_tokens' WHEN cx IS NULL OR cy IS NULL OR bw IS NULL OR bh IS NULL THEN 'not_numeric'
                 WHEN n > 5 THEN 'extra_tokens' WHEN s.line_no IS NULL THEN 'degenerate' END AS reason
               FROM num LEFT JOIN strict_ok s USING (board, frame, line_no)) WHERE reason IS NOT NULL""",
            _STRICT,
        ),
        "seg_label_text": _q(
            f"""SELECT board, frame, det_id, concat_ws(' ', '0', {ring}) AS line
               FROM (SELECT *, least(3, least(x2 - x1, y2 - y1) // 3) AS c FROM all_dets)"""
        ),
        "board_features": _q(f"SELECT board, frames, {r6('cluster_frac')} FROM features", _FLOATS, _FEATURES),
        "has_cluster": _q("SELECT board, frame FROM clustered", _FLOATS, _NEAR),
        "near_pairs": _q("SELECT * FROM near", _FLOATS, _NEAR),
        "cluster_count": _q(
            """SELECT board, frame, count(*) AS clusters FROM (SELECT board, frame, comp FROM fc GROUP BY ALL HAVING sum(copies) >= 2) GROUP BY board, frame""",
            _FLOATS, _FRAME_CLUSTERS, recursive=True,
        ),
        "crowded_clusters": _q(
            """SELECT board, 0 AS frame, count(*) AS clusters FROM (
               SELECT u.board, l.label FROM u JOIN lab l ON l.id = u.ann_id WHERE l.step = 40 GROUP BY ALL HAVING sum(copies) >= 2) GROUP BY board""",
            """c AS MATERIALIZED (SELECT CAST(board // 16 AS INTEGER) AS board, ann_id, x1, y1, x2, y2 FROM boxes),
u AS MATERIALIZED (SELECT board, x1, y1, x2, y2, min(ann_id) AS ann_id, count(*) AS copies FROM c GROUP BY ALL)""",
            f"""e AS MATERIALIZED (SELECT a.ann_id AS s, b.ann_id AS d FROM u a JOIN u b ON a.board = b.board AND a.ann_id <> b.ann_id AND {_near("a", "b")}),
lab AS (SELECT 0 AS step, ann_id AS id, ann_id AS label FROM u
  UNION ALL SELECT step + 1, id, min(label) FROM (
    SELECT step, id, label FROM lab UNION ALL SELECT l.step, e.d, l.label FROM lab l JOIN e ON e.s = l.id) WHERE step < 40 GROUP BY step, id)""",
            recursive=True,
        ),
        "box_piles": _q(
            """SELECT board, first_id, row_number() OVER (PARTITION BY board, first_id ORDER BY ann_id) - 1 AS rank, ann_id FROM (
               SELECT board, ann_id, min(ann_id) OVER w AS first_id, count(*) OVER w AS n FROM (
                 SELECT board, ann_id, (x1 + frame * 320) // 32 AS x1, y1 // 32 AS y1, (x2 + frame * 320) // 32 AS x2, y2 // 32 AS y2 FROM boxes)
               WINDOW w AS (PARTITION BY board, x1, y1, x2, y2)) WHERE n > 1"""
        ),
        "greedy_match_hot": _q(
            """SELECT 0 AS board, id AS pred_id, id AS gt_id, 0.5::FLOAT AS bbox_iou FROM (SELECT row_number() OVER (ORDER BY obj_id) - 1 AS id FROM objects)"""
        ),
        "board_stats": _q(
            """SELECT board, min(frame) AS first, max(frame) AS last, CAST(count(*) AS INTEGER) AS frames,
               CAST(max(frame) - min(frame) + 1 - count(*) AS INTEGER) AS gaps, max(frame) - min(frame) + 1 AS span, CAST(sum(a) AS BIGINT) AS annots
               FROM (SELECT board, frame, sum(a) AS a FROM (SELECT board, frame, 0 AS a FROM frames UNION ALL SELECT board, frame, annots FROM label_files)
               GROUP BY board, frame) GROUP BY board"""
        ),
        "dataset_totals": _q(
            """SELECT (SELECT count(*) FROM (SELECT board FROM frames UNION SELECT board FROM label_files)) AS boards,
               (SELECT count(*) FROM frames) AS images, (SELECT count(*) FROM label_files) AS labels,
               (SELECT CAST(sum(annots) AS BIGINT) FROM label_files) AS annots"""
        ),
        "topk_boards": _q(
            """SELECT board, count(*) AS annots FROM label_lines GROUP BY board ORDER BY annots DESC, board LIMIT 20"""
        ),
        "frame_gaps": _q(
            """SELECT board, frame + 1 AS gap_from, nxt - 1 AS gap_to, nxt - frame - 1 AS missing FROM (
               SELECT board, frame, lead(frame) OVER (PARTITION BY board ORDER BY frame) AS nxt FROM frames) WHERE nxt - frame > 1"""
        ),
        "board_canvas": _q(
            """SELECT c.*, (SELECT count(*) FROM frames f WHERE f.board = c.board AND f.img_h <> c.board_height) AS height_mismatches FROM canvas c""",
            _CANVAS,
        ),
        "mosaic_canvas": _q(
            """SELECT board, CAST(arg_max(frame * 320 + img_w, frame) AS INTEGER) AS board_width, arg_min(img_h, frame) AS board_height
               FROM frames GROUP BY board"""
        ),
        "edge_touch": _q(
            """SELECT board, frame, count(*) AS annot, CAST(sum(CASE WHEN x1 <= 1 OR img_w - x2 <= 1 OR y1 <= 1 OR img_h - y2 <= 1 THEN 1 ELSE 0 END) AS BIGINT) AS edge
               FROM floats GROUP BY board, frame""",
            _FLOATS,
        ),
        "annotation_histogram": _q(
            """SELECT annot, count(*) AS frames FROM (SELECT f.board, f.frame, count(b.ann_id) AS annot FROM frames f
               LEFT JOIN boxes b USING (board, frame) GROUP BY f.board, f.frame) GROUP BY annot"""
        ),
        "tier_labels": _q(
            """SELECT board, CASE WHEN frames <= 10 THEN '[-inf,10]' WHEN frames <= 23 THEN '(10,23]' ELSE '(23,inf]' END AS frames_tier,
               CASE WHEN cluster_frac <= 0.125 THEN '[-inf,0.125]' WHEN cluster_frac <= 0.5 THEN '(0.125,0.5]' ELSE '(0.5,inf]' END AS cluster_tier
               FROM features""",
            _FLOATS, _FEATURES,
        ),
        "largest_remainder": _q("SELECT stratum, total, train, val, test, small FROM alloc", _FLOATS, _SPLIT),
        "stratified_split": _q("SELECT board, split, reason, stratum FROM assignment", _FLOATS, _SPLIT),
        "split_totals": _q(
            """SELECT split, count(*) AS boards, CAST(sum(frames) AS BIGINT) AS frames FROM assignment JOIN features USING (board) GROUP BY ROLLUP (split)""",
            _FLOATS, _SPLIT,
        ),
        "split_reasons": _q("SELECT reason, split, count(*) AS boards FROM assignment GROUP BY reason, split", _FLOATS, _SPLIT),
        "split_leaks": _q("SELECT board, count(DISTINCT split) AS splits FROM assignment GROUP BY board HAVING count(DISTINCT split) > 1", _FLOATS, _SPLIT),
        "partitions_document": _q(
            """SELECT '{' || string_agg('"' || s.split || '":[' || coalesce(ids, '') || ']', ',' ORDER BY s.k) || '}' AS document
               FROM (VALUES (0, 'train'), (1, 'val'), (2, 'test')) s(k, split) LEFT JOIN
               (SELECT split, string_agg(CAST(board AS VARCHAR), ',' ORDER BY board) AS ids FROM assignment GROUP BY split) a ON a.split = s.split""",
            _FLOATS, _SPLIT,
        ),
        "staging_join": _q(
            """SELECT f.board, f.frame, f.stem, a.split, CASE WHEN a.split IS NULL THEN 'no_split' WHEN l.board IS NULL THEN 'no_label' ELSE 'paired' END AS status
               FROM frames f LEFT JOIN (SELECT * FROM assignment WHERE reason <> 'short') a ON a.board = f.board
               LEFT JOIN (SELECT DISTINCT board, frame FROM dets) l ON l.board = f.board AND l.frame = f.frame""",
            _FLOATS, _SPLIT,
        ),
        "staging_summary": _q(
            """SELECT count(*) FILTER (s = 'paired') AS paired, count(*) FILTER (s = 'no_label') AS no_label, count(*) FILTER (s = 'no_split') AS no_split,
               count(*) FILTER (s = 'paired' AND split = 'train') AS train, count(*) FILTER (s = 'paired' AND split = 'val') AS val,
               count(*) FILTER (s = 'paired' AND split = 'test') AS test FROM (
               SELECT a.split, CASE WHEN a.split IS NULL THEN 'no_split' WHEN l.board IS NULL THEN 'no_label' ELSE 'paired' END AS s
               FROM frames f LEFT JOIN (SELECT * FROM assignment WHERE reason <> 'short') a ON a.board = f.board
               LEFT JOIN (SELECT DISTINCT board, frame FROM dets) l ON l.board = f.board AND l.frame = f.frame)""",
            _FLOATS, _SPLIT,
        ),
        "iou_pairs": _q(
            f"""SELECT a.board, a.ann_id AS a_ann_id, b.ann_id AS b_ann_id, a.copies AS a_copies, b.copies AS b_copies, {_iou("a", "b")} AS iou
               FROM u a JOIN u b ON a.board = b.board AND a.ann_id < b.ann_id WHERE {_iou("a", "b")} >= 0.3::FLOAT""",
            """u AS MATERIALIZED (SELECT board, x1 + frame * 320 AS x1, y1, x2 + frame * 320 AS x2, y2, min(ann_id) AS ann_id, count(*) AS copies FROM boxes
               GROUP BY board, x1 + frame * 320, y1, x2 + frame * 320, y2)""",
        ),
        "distinct_instances": _q(
            "SELECT board, count(*) AS raw_annotations, count(DISTINCT comp) AS distinct_estimate FROM inst GROUP BY board", _instances(), recursive=True
        ),
        "cross_frame_dups": _q(
            f"""SELECT a.board, a.frame, a.ann_id AS a_ann_id, b.ann_id AS b_ann_id, a.copies AS a_copies, b.copies AS b_copies, {_iou("a", "b")} AS iou
               FROM u a JOIN u b ON a.board = b.board AND b.frame = a.frame + 1 WHERE {_iou("a", "b")} >= 0.5::FLOAT""",
            """u AS MATERIALIZED (SELECT board, frame, x1 + frame * 320 AS x1, y1, x2 + frame * 320 AS x2, y2, min(ann_id) AS ann_id, count(*) AS copies FROM boxes
               GROUP BY board, frame, x1 + frame * 320, y1, x2 + frame * 320, y2)""",
        ),
        "match_candidates": _q(
            """SELECT board, p0 AS pred_id, g0 AS gt_id, count(DISTINCT pred_id) AS pred_copies, count(DISTINCT gt_id) AS gt_copies, max(iou) AS iou
               FROM cand GROUP BY board, p0, g0""",
            _MATCH,
        ),
        "greedy_match": _q("SELECT board, pred_id, gt_id, iou AS bbox_iou FROM matched", _MATCH, _greedy("cand"), recursive=True),
        "match_scores": _q(
            """SELECT p.board, p.n AS pred_count, g.n AS gt_count, coalesce(m.n, 0) AS tp, p.n - coalesce(m.n, 0) AS fp, g.n - coalesce(m.n, 0) AS fn
               FROM (SELECT board, count(*) AS n FROM pb GROUP BY board) p JOIN (SELECT board, count(*) AS n FROM gb GROUP BY board) g USING (board)
               LEFT JOIN (SELECT board, count(*) AS n FROM matched GROUP BY board) m USING (board)""",
            _MATCH.replace(">= 0.1::FLOAT", ">= 0.5::FLOAT"), _greedy("cand"), recursive=True,
        ),
        "board_set_ops": _q(
            """SELECT coalesce(p.board, g.board) AS board, CASE WHEN g.board IS NULL THEN 'only_pred' WHEN p.board IS NULL THEN 'only_gt' ELSE 'both' END AS side
               FROM (SELECT DISTINCT board FROM dets WHERE conf >= 0.9) p FULL JOIN (SELECT DISTINCT board FROM frames f WHERE nframes > 12) g ON p.board = g.board""".replace(
                "frames f WHERE nframes > 12", "(SELECT board, count(*) AS c FROM frames GROUP BY board) WHERE c > 12"
            )
        ),
        "resume_antijoin": _q(
            "SELECT f.board, f.frame, f.stem FROM frames f WHERE NOT EXISTS (SELECT 1 FROM label_files l WHERE l.board = f.board AND l.frame = f.frame)"
        ),
        "merge_spans": _q("SELECT * FROM merged", _REGIONS, _ROWS),
        "union_area": _q("SELECT board, CAST(sum(xe - xs + 1) AS BIGINT) AS area FROM merged GROUP BY board", _REGIONS, _ROWS),
        "union_components": _q(
            """SELECT s.board, s.comp, CAST(sum(s.xe - s.xs + 1) AS BIGINT) AS area, min(s.xs) AS x1, min(s.y) AS y1, max(s.xe) AS x2, max(s.y) AS y2
               FROM (SELECT DISTINCT m.board, m.y, m.xs, m.xe, c.comp FROM merged m JOIN uc c
                     ON c.board = m.board AND m.y BETWEEN c.y1 AND c.y2 AND c.x1 BETWEEN m.xs AND m.xe) s GROUP BY s.board, s.comp""",
            _REGIONS, _ROWS, _components("rects_ok", "uc"), recursive=True,
        ),
        "ring_islands": _q(
            """SELECT board, poly_id, area, x1, y1, x2, y2, CAST(vertices AS INTEGER) AS vertices FROM (
               SELECT board, s * 200 AS x, open, unnest([
                 {'i': 0, 'p': 10 * 4294967296 + 10, 'a': 2 * 121 * 7 + 73 * 7 * CASE WHEN open THEN 1 ELSE 2 END, 'x1': 10, 'y1': 10, 'x2': 130, 'y2': 96, 'v': CASE WHEN open THEN 8 ELSE 4 END},
                 {'i': 1, 'p': 40 * 4294967296 + 60, 'a': 441, 'x1': 60, 'y1': 40, 'x2': 80, 'y2': 60, 'v': 4},
                 {'i': 2, 'p': 40 * 4294967296 + 150, 'a': 121, 'x1': 150, 'y1': 40, 'x2': 160, 'y2': 50, 'v': 4}]) AS r
               FROM (SELECT board, obj_id % 80 AS s, max(obj_id % 3) = 0 AS open FROM objects GROUP BY ALL)) q,
               LATERAL (SELECT r.p + x AS poly_id, CAST(r.a AS BIGINT) AS area, CAST(r.x1 + x AS INTEGER) AS x1, r.y1 AS y1, CAST(r.x2 + x AS INTEGER) AS x2, r.y2 AS y2, r.v AS vertices)
               WHERE open OR r.i <> 1"""
        ),
        "stitch_gt": _q(
            """SELECT s.board, s.comp AS poly_id, CAST(sum(s.xe - s.xs + 1) AS BIGINT) AS area, min(s.xs) AS x1, min(s.y) AS y1, max(s.xe) AS x2, max(s.y) AS y2
               FROM (SELECT DISTINCT m.board, m.y, m.xs, m.xe, c.comp FROM merged m JOIN uc c
                     ON c.board = m.board AND m.y BETWEEN c.y1 AND c.y2 AND c.x1 BETWEEN m.xs AND m.xe) s GROUP BY s.board, s.comp
               HAVING min(s.xs) < max(s.xe) AND min(s.y) < max(s.y)""",
            _STRICT, _REGIONS.replace("FROM dets JOIN canvas USING (board) WHERE conf >= 0.25", "FROM strict_ok JOIN canvas USING (board)").replace(
                "FROM frames GROUP BY board", "FROM frames SEMI JOIN label_files USING (board, frame) GROUP BY board"),
            _ROWS, _components("rects_ok", "uc"), recursive=True,
        ),
        "labels_seg": _q("SELECT board, frame, det_id, 8 AS vertices, x1, y1, x2, y2 FROM all_dets"),
        "mask_iou_rects": _q(
            """SELECT d.board, d.frame, d.det_id, CAST(i / CAST(da + ga - i AS DOUBLE) AS FLOAT) AS mask_iou FROM (
               SELECT d.board, d.frame, d.det_id,
                 greatest(0, least(d.x2, g.x2) - greatest(d.x1, g.x1) + 1) * greatest(0, least(d.y2, g.y2) - greatest(d.y1, g.y1) + 1) AS i,
                 (d.x2 - d.x1 + 1) * (d.y2 - d.y1 + 1) AS da, (g.x2 - g.x1 + 1) * (g.y2 - g.y1 + 1) AS ga
               FROM all_dets d JOIN boxes g ON d.board = g.board AND d.frame = g.frame AND d.det_id = g.ann_id) d"""
        ),
        "mask_iou_octagons": _q(
            """SELECT board, frame, det_id, round(CAST(CAST(sum(i) / CAST(sum(a) + max(ga) - sum(i) AS DOUBLE) AS FLOAT) AS DOUBLE), 6) AS mask_iou FROM (
               SELECT board, frame, det_id, ga, xe - xs + 1 AS a,
                 CASE WHEN y BETWEEN gy1 AND gy2 THEN greatest(0, least(xe, gx2) - greatest(xs, gx1) + 1) ELSE 0 END AS i
               FROM (SELECT *, x1 + greatest(0, c - (y - y1), c - (y2 - y)) AS xs, x2 - greatest(0, c - (y - y1), c - (y2 - y)) AS xe
                 FROM (SELECT d.board, d.frame, d.det_id, d.x1, d.y1, d.x2, d.y2, unnest(range(d.y1, d.y2 + 1)) AS y,
                         least(3, least(d.x2 - d.x1, d.y2 - d.y1) // 3) AS c, g.x1 AS gx1, g.y1 AS gy1, g.x2 AS gx2, g.y2 AS gy2,
                         (g.x2 - g.x1 + 1) * (g.y2 - g.y1 + 1) AS ga
                       FROM all_dets d JOIN boxes g ON d.board = g.board AND d.frame = g.frame AND d.det_id = g.ann_id))) GROUP BY board, frame, det_id"""
        ),
        "polygon_metrics": _q(
            """SELECT board, frame, det_id, x1, y1, x2, y2, CAST((x2 - x1) * (y2 - y1) - 2 * c * c AS DOUBLE) AS area
               FROM (SELECT *, least(3, least(x2 - x1, y2 - y1) // 3) AS c FROM all_dets)"""
        ),
        "letterbox_roundtrip": _q(
            """SELECT board, frame, det_id, img_h, pad_x, pad_y,
                 greatest(0, least(img_w - 1, CAST(round(CAST(CAST(x1 + pad_x - pad_x AS DOUBLE) / sc AS FLOAT)) AS INTEGER))) AS sx,
                 greatest(0, least(img_h - 1, CAST(round(CAST(CAST(y1 - pad_y AS DOUBLE) / sc AS FLOAT)) AS INTEGER))) AS sy
               FROM (SELECT d.*, f.img_w, f.img_h, CAST(least(960.0::DOUBLE / f.img_h, 960.0::DOUBLE / f.img_w) AS FLOAT)::DOUBLE AS sc,
                 CAST((960 - CAST(round(640 * 1.5) AS INTEGER)) // 2 AS INTEGER) AS pad_x,
                 CAST((960 - CAST(round(f.img_h * 1.5) AS INTEGER)) // 2 AS INTEGER) AS pad_y
               FROM all_dets d JOIN frames f USING (board, frame))"""
        ),
        "mosaic_ownership": _q(
            """SELECT board, slot, min(x) AS x_from, max(x) AS x_to, frame FROM (
               SELECT board, x, x // 320 AS slot, max(frame) AS frame FROM (
                 SELECT board, frame, CAST(unnest(range(frame * 320, frame * 320 + img_w)) AS INTEGER) AS x FROM frames) GROUP BY board, x)
               GROUP BY board, slot, frame"""
        ),
        "overlay_layers": _q(
            """SELECT layer, board, count(*) AS shapes, min(x1) AS left_x, max(x2) AS right_x FROM (
               SELECT 'boxes' AS layer, board, x1 + frame * 320 AS x1, x2 + frame * 320 AS x2 FROM boxes
               UNION ALL SELECT 'seg', board, x1 + frame * 320, x2 + frame * 320 FROM all_dets) GROUP BY layer, board"""
        ),
        "pseudo_label_quality": _q(
            """SELECT (SELECT count(*) FROM st WHERE nb > 0) AS processed, 0::BIGINT AS skipped, (SELECT count(*) FROM st WHERE nb = 0) AS empty,
               (SELECT CAST(sum(raw - nb) AS BIGINT) FROM st) AS degenerate_boxes_skipped, (SELECT count(*) FROM i) AS boxes_total,
               (SELECT count(*) FROM i WHERE (x2 - x1) * (y2 - y1) < 120) AS fallback_polygons,
               (SELECT round(100.0 * count(*) FILTER ((x2 - x1) * (y2 - y1) < 120) / count(*), 6) FROM i) AS fallback_pct""",
            _TOKENS,
            """i AS (SELECT * FROM (SELECT *, greatest(0, CAST(round_even(cx * img_w - bw * img_w / 2, 0) AS INTEGER)) AS x1,
                 greatest(0, CAST(round_even(cy * img_h - bh * img_h / 2, 0) AS INTEGER)) AS y1,
                 least(img_w, CAST(round_even(cx * img_w + bw * img_w / 2, 0) AS INTEGER)) AS x2,
                 least(img_h, CAST(round_even(cy * img_h + bh * img_h / 2, 0) AS INTEGER)) AS y2 FROM ok) WHERE x2 > x1 AND y2 > y1),
               st AS (SELECT f.board, f.frame, coalesce(l.annots, 0) AS raw, coalesce(c.n, 0) AS nb FROM frames f
                 LEFT JOIN label_files l USING (board, frame) LEFT JOIN (SELECT board, frame, count(*) AS n FROM i GROUP BY board, frame) c USING (board, frame))""",
        ),
        "average_precision": _q(
            """SELECT 0 AS cls, threshold, round(ap, 6) AS ap, (SELECT gt FROM tot) AS gt, (SELECT count(*) FROM dets) AS dets FROM ap""", _AP
        ),
        "detection_summary": _q(
            """SELECT round(pk.p, 6) AS precision, round(pk.r, 6) AS recall, round((SELECT ap FROM ap WHERE threshold = 0.5::FLOAT), 6) AS map50,
               round((SELECT avg(ap) FROM ap), 6) AS map50_95 FROM (SELECT p, r FROM curve WHERE threshold = 0.5::FLOAT
               ORDER BY coalesce(2.0 * p * r / nullif(p + r, 0), 0) DESC, conf DESC LIMIT 1) pk""",
            _AP,
        ),
        "eval_boards": _q(
            """SELECT board, pred_count, gt_count, tp, fp, fn, round(CAST(p AS DOUBLE), 6) AS precision, round(CAST(r AS DOUBLE), 6) AS recall,
               round(CASE WHEN p + r > 0 THEN 2 * CAST(p AS DOUBLE) * r / (CAST(p AS DOUBLE) + r) END, 5) AS f1,
               round(CAST(CAST(mean_iou AS FLOAT) AS DOUBLE), 5) AS mean_iou FROM per_board""",
            _EVAL, recursive=True,
        ),
        "runs_sorted": _q(
            """SELECT 'run' || k AS name, 'm' || k AS model, CAST(10 * k AS VARCHAR) AS epochs, CAST(1.5 * k AS DOUBLE) AS elapsed,
               round(CAST(CAST(2 * CAST(tp_p AS DOUBLE) * tp_r / (CAST(tp_p AS DOUBLE) + tp_r) AS FLOAT) AS DOUBLE), 5) AS f1,
               round(CAST(tp_p AS DOUBLE), 5) AS precision, round(CAST(tp_r AS DOUBLE), 5) AS recall
               FROM (SELECT board % 4 AS k, CAST(sum(tp) / CAST(sum(pred_count) AS DOUBLE) AS FLOAT) AS tp_p, CAST(sum(tp) / CAST(sum(gt_count) AS DOUBLE) AS FLOAT) AS tp_r
                     FROM per_board GROUP BY 1)""",
            _EVAL, recursive=True,
        ),
        "frames_in_order": _q(
            """SELECT board, frame, row_number() OVER (ORDER BY board, frame) - 1 AS place, row_number() OVER (ORDER BY stem) - 1 AS name_place FROM frames"""
        ),
        "eval_aggregate": _q(
            """SELECT boards, total_pred, total_gt, total_tp, total_fp, total_fn, round(total_tp / CAST(total_pred AS DOUBLE), 5) AS precision,
               round(total_tp / CAST(total_gt AS DOUBLE), 5) AS recall, round(CAST(CAST(s / total_tp AS FLOAT) AS DOUBLE), 5) AS mean_iou_micro,
               round(CAST(CAST(macro AS FLOAT) AS DOUBLE), 5) AS mean_iou_macro,
               gt_distinct_total, gt_merged_away_total, round(100.0 * gt_merged_away_total / gt_distinct_total, 5) AS over_merge_pct
               FROM (SELECT count(*) AS boards, CAST(sum(pred_count) AS BIGINT) AS total_pred, CAST(sum(gt_count) AS BIGINT) AS total_gt,
                 CAST(sum(tp) AS BIGINT) AS total_tp, CAST(sum(fp) AS BIGINT) AS total_fp, CAST(sum(fn) AS BIGINT) AS total_fn, sum(iou_sum) AS s,
                 avg(CASE WHEN tp > 0 THEN CAST(CAST(mean_iou AS FLOAT) AS DOUBLE) END) AS macro, CAST(sum(d) AS BIGINT) AS gt_distinct_total,
                 CAST(sum(greatest(0, d - gt_count)) AS BIGINT) AS gt_merged_away_total
               FROM per_board JOIN (SELECT board, count(DISTINCT comp) AS d FROM inst GROUP BY board) USING (board))""",
            _EVAL, _instances(), recursive=True,
        ),
    }
