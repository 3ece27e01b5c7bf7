"""Sources and sinks as round trips through files."""

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from boardlens.functions.geometry import box_polygon
from boardlens.operators import evaluation, joins, pixels, scoring, splitting, stitching
from boardlens.sources import documents, frames, labels, listing, writers
from boardlens.streaming import incremental


def png(path, rgb):
    path.write_bytes(pixels.encode_png(rgb[:, :, ::-1]))


def strip_image(w=64, h=32):
    """Dark borders, a brown strip, one dark brown and one dark grey patch (RGB)."""
    img = np.zeros((h, w, 3), dtype=np.uint8)
    img[4 : h - 3] = (200, 150, 90)
    img[10:14, 8:16] = (90, 60, 30)
    img[20:24, 8:16] = (70, 70, 70)
    return img


@pytest.fixture()
def data(tmp_path):
    images, texts = tmp_path / "images", tmp_path / "labels"
    images.mkdir()
    texts.mkdir()
    img = strip_image()
    for name in ("1_0", "1_1", "1_3", "2_0"):
        png(images / f"{name}.png", img)
    png(images / "2_1.png", np.zeros((32, 64, 3), dtype=np.uint8))
    whole = pixels.encode_png(img)
    (images / "3_0.png").write_bytes(whole[:40])
    png(images / "notes_x.png", img)
    (images / "1_0.jpg").write_bytes(b"x")
    (texts / "1_0.txt").write_text("0 0.5 0.5 0.25 0.25\n\n0 0.1 0.1\n0 x 0.5 0.1 0.1\n")
    (texts / "1_1.txt").write_text("0 0.5 0.5 0.25 0.25 0.9 0.9\n0 0.99 0.5 0.1 0.2\n0 0.5 0.5 0.0 0.1\n")
    (texts / "1_9.txt").write_text("")
    (texts / "3_0.txt").write_text("0 0.5 0.5 0.2 0.2\n")
    (texts / "readme.txt").write_text("nothing")
    return tmp_path


def test_scan_and_decode(spark, data):
    listed = frames.scan_frames(spark, str(data / "images"))
    assert sorted((r.board, r.frame) for r in listed.collect()) == [(1, 0), (1, 1), (1, 3), (2, 0), (2, 1), (3, 0)]
    assert frames.scan_frames(spark, str(data / "images"), boards=[2]).count() == 2
    assert frames.scan_frames(spark, str(data / "images"), boards=[]).count() == 0
    dims = frames.frame_dims(spark, str(data / "images"))
    assert {(r.img_w, r.img_h) for r in dims.collect()} == {(64, 32)}
    px = frames.decode_frames(spark, str(data / "images"))
    assert {(r.board, r.frame): r.ok for r in px.collect()}[(3, 0)] is False
    first = px.filter("board = 1 and frame = 0").first()
    assert np.array_equal(pixels.bgr_array(first.pixels, 32, 64, first.channels)[:, :, ::-1], strip_image())


def test_headers_and_boards_are_read_alone(spark, data):
    images, texts = data / "images", data / "labels"
    with open(images / "4_0.png", "wb") as f:  # as large as no job could read: only its header is there
        f.write(pixels.encode_png(strip_image())[: frames.HEADER])
        f.truncate(1 << 40)
    (images / "5_0.png").write_bytes(b"")
    (images / "007_2.png").write_bytes((images / "1_0.png").read_bytes())
    (texts / "007_2.txt").write_bytes(b"0 0.5 0.5 0.25 0.25 \xff\r\n")
    for other in (images / "8_0.png", texts / "8_0.txt"):  # would fill the memory of whatever opens it
        with open(other, "wb") as f:
            f.truncate(1 << 40)
    boards = [1, 2, 3, 4, 5, 7]
    table = spark.createDataFrame([(b,) for b in boards], "board int")
    expected = [(1, 0), (1, 1), (1, 3), (2, 0), (2, 1), (3, 0), (4, 0), (7, 2)]
    for chosen in (boards, table):
        dims = frames.frame_dims(spark, str(images), boards=chosen)
        assert sorted((r.board, r.frame) for r in dims.filter("img_w = 64 and img_h = 32").collect()) == expected
        files = labels.scan_label_files(spark, str(texts), boards=chosen)
        assert {(r.board, r.frame): r.annots for r in files.collect()} == {(1, 0): 3, (1, 1): 3, (1, 9): 0, (3, 0): 1, (7, 2): 1}
        assert files.filter("board = 7").first().text.endswith("\ufffd\r\n")
    assert labels.scan_label_files(spark, str(texts), boards=[]).count() == 0
    assert sorted({r.board for r in frames.decode_frames(spark, str(images), boards=[2, 7]).collect()}) == [2, 7]
    assert listing.storage("file:/a/b c%20.png")[1:] == ("/a/b c%20.png", "") == listing.storage("file:///a/b c%20.png")[1:]


def test_label_variants(spark, data):
    files = labels.scan_label_files(spark, str(data / "labels"))
    assert {(r.board, r.frame): r.annots for r in files.collect()} == {(1, 0): 3, (1, 1): 3, (1, 9): 0, (3, 0): 1}
    lines = labels.label_lines(files)
    dims = spark.createDataFrame([(1, 0, 64, 32), (1, 1, 64, 32)], "board int, frame int, img_w int, img_h int")
    rows = lambda df: sorted((r.frame, r.line_no, r.x1, r.y1, r.x2, r.y2) for r in df.collect())
    why = lambda df: sorted((r.frame, r.line_no, r.reason) for r in df.collect())
    strict = labels.labels_strict(lines, dims)
    assert rows(strict.boxes) == [(0, 0, 24, 12, 40, 20), (1, 1, 60, 13, 64, 19)]
    assert why(strict.rejects) == [(0, 2, "few_tokens"), (0, 3, "not_numeric"), (1, 0, "extra_tokens"), (1, 2, "degenerate")]
    whole = labels.labels_int(lines, dims)
    assert rows(whole.boxes) == [(0, 0, 24, 12, 40, 20), (1, 0, 24, 12, 40, 20), (1, 1, 60, 13, 64, 19)]
    loose = labels.labels_float(lines, dims)
    assert [r[:2] for r in rows(loose.boxes)] == [(0, 0), (1, 0), (1, 1), (1, 2)]
    assert max(r[4] for r in rows(loose.boxes)) > 64


def test_half_pixels_differ_by_variant(spark):
    lines = spark.createDataFrame([(1, 0, 0, "0 0.501953125 0.5 0.00390625 0.1")], "board int, frame int, line_no int, line string")
    dims = spark.createDataFrame([(1, 0, 640, 220)], "board int, frame int, img_w int, img_h int")
    assert labels.labels_int(lines, dims).boxes.first().x2 == 322
    assert labels.labels_strict(lines, dims).boxes.first().x2 == 323


def test_seg_lines(spark):
    text = ["0 0.1 0.1 0.5 0.1 0.5 0.5", "0 0.1 0.1 0.5 0.1", "0 0.1 0.1 0.5 0.1 0.5 0.5 0.7", "0 0.1 0.1 a 0.1 0.5 0.5"]
    lines = spark.createDataFrame([(1, 0, i, t) for i, t in enumerate(text)], "board int, frame int, line_no int, line string")
    dims = spark.createDataFrame([(1, 0, 100, 50)], "board int, frame int, img_w int, img_h int")
    got = labels.labels_seg(lines, dims)
    assert [[tuple(p) for p in r.polygon] for r in got.boxes.collect()] == [[(10, 5), (50, 5), (50, 25)]]
    assert {r.line_no: r.reason for r in got.rejects.collect()} == {1: "few_tokens", 2: "odd_coordinates", 3: "not_numeric"}


def test_tokens_are_split_at_any_white_space(spark):
    text = ["  0 0.5\t0.5  0.1 \x0b 0.1\r", "0\f0.5 0.5 0.1 0.1 ", "   ", "0 0.5 0.5 0.1", "0\u00a00.5 0.5 0.1 0.1"]
    lines = spark.createDataFrame([(1, 0, i, t) for i, t in enumerate(text)], "board int, frame int, line_no int, line string")
    dims = spark.createDataFrame([(1, 0, 100, 50)], "board int, frame int, img_w int, img_h int")
    got = labels.labels_float(lines, dims)
    assert sorted(r.line_no for r in got.boxes.collect()) == [0, 1]
    assert {r.line_no: r.reason for r in got.rejects.collect()} == {2: "few_tokens", 3: "few_tokens", 4: "few_tokens"}
    plan = got.boxes._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan  # two patterns a line took most of the time


def test_board_documents_round_trip(spark, tmp_path):
    dims = spark.createDataFrame([(b, f, 640, 220) for b in (1, 2) for f in range(2)], "board int, frame int, img_w int, img_h int")
    boxes = spark.createDataFrame(
        [(1, 0, 1, 10, 10, 40, 40), (1, 1, 2, 100, 50, 130, 80)], "board int, frame int, ann_id bigint, x1 int, y1 int, x2 int, y2 int"
    )
    gt = stitching.stitch_gt(boxes, dims)
    docs = writers.board_documents(gt.boards, gt.polygons, gt.stats, objects_key="shapes")
    assert writers.write_boards(docs, str(tmp_path / "gt")) == 2
    (tmp_path / "gt" / "run_meta_x.json").write_text("{}")
    text = json.loads((tmp_path / "gt" / "1.json").read_text())
    assert text["board_width"] == 960 and text["shapes"][0]["polygon"] == [[10, 10], [40, 10], [40, 40], [10, 40]]
    back = documents.scan_board_polygons(spark, str(tmp_path / "gt"), "shapes")
    assert sorted(r.board for r in back.boards.collect()) == [1, 2]
    assert back.polygons.count() == 2
    assert {r.board: r.distinct_estimate for r in back.gt_stats.collect()} == {1: 2, 2: 0}
    ev = evaluation.evaluate_boards(back.polygons, back.polygons, back.gt_stats, pred_boards=back.boards, gt_boards=back.boards)
    rows = {r.board: r for r in ev.per_board.collect()}
    assert (rows[1].tp, rows[1].mean_iou, rows[1].f1) == (2, 1.0, 1.0)
    assert (rows[2].tp, rows[2].precision, rows[2].f1, rows[2].mean_iou) == (0, None, None, 0.0)
    total = ev.aggregate.first()
    assert (total.boards, total.total_tp, total.mean_iou_macro, total.over_merge_pct) == (2, 2, 1.0, 0.0)
    writers.write_eval_report(ev, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report" / "per_board")).count() == 2
    report = json.loads((tmp_path / "report" / "eval_boards.json").read_text())
    assert report["aggregate"]["total_tp"] == 2 and [b["matched_ious"] for b in report["per_board"]] == [[1.0, 1.0], []]


def test_written_runs_are_listed(spark, tmp_path):
    """Records and reports come back through the lister; a retried task leaves one whole file of each name."""
    boards = spark.createDataFrame([(b, 0, [(0, 0), (9 + b, 0), (9 + b, 9), (0, 9)]) for b in range(3)], "board int, poly_id bigint, polygon array<struct<x:int,y:int>>")
    for k, kept in enumerate(([0, 1, 2], [0], [])):
        pred = boards.filter(F.col("board").isin(kept)) if kept else boards.filter("false")
        ev = evaluation.evaluate_boards(pred, boards, pred_boards=boards)
        writers.write_eval_report(ev, str(tmp_path / f"r{k}"))
        writers.write_eval_report(ev, str(tmp_path / f"r{k}"))
        writers.write_run_meta(spark, str(tmp_path / f"r{k}"), "train_yolo", {"model": "m", "epochs": k}, k + 0.12345, extra={"note": 1})
    got = documents.sort_runs(documents.scan_runs(spark, str(tmp_path)), "f1").collect()
    assert [(r.name, r.f1, r.epochs, r.elapsed) for r in got] == [("r0", 1.0, "0", 0.123), ("r1", 0.5, "1", 1.123), ("r2", None, "2", 2.123)]
    assert [p.name for p in (tmp_path / "r0").iterdir() if p.name.startswith(".")] == []


def test_first_frames_in_order(spark):
    df = spark.createDataFrame([(b, f, f"{b}_{f}") for b in (2, 10, 1) for f in (0, 11, 2)], "board int, frame int, stem string")
    listed = lambda **a: [r.stem for r in joins.frames_in_order(df, **a).orderBy("place").collect()]
    assert listed(first=4) == ["1_0", "1_2", "1_11", "2_0"]
    assert listed(by_name=True) == sorted(r.stem for r in df.collect())


def test_splits_round_trip(spark, tmp_path):
    feats = spark.createDataFrame([(b, 5 + b, 0.0) for b in range(30)], "board int, frames int, cluster_frac double")
    assignment, _ = splitting.stratified_split(feats)
    writers.write_partitions(assignment, str(tmp_path))
    path = str(tmp_path / "partitions.json")
    back = documents.scan_partitions(spark, path)
    assert {tuple(r) for r in back.select("board", "split").collect()} == {tuple(r) for r in assignment.select("board", "split").collect()}
    (tmp_path / "p.json").write_text('{"train":[1],"val":[],"test":[2,3]}')
    members = lambda s: sorted(r.board for r in documents.boards_in_split(spark, str(tmp_path / "p.json"), s).collect())
    assert (members("test"), members("val"), members("unknown")) == ([2, 3], [], [])
    (tmp_path / "bad.json").write_text('{"holdout":[1]}')
    with pytest.raises(Exception, match="unexpected split"):
        documents.scan_partitions(spark, str(tmp_path / "bad.json")).collect()
    with pytest.raises(Exception):
        documents.boards_in_split(spark, str(tmp_path / "absent.json"), "test").collect()


def test_lists_and_stems(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# boards\n 12\n\n7 extra\nabc\n12\n")
    assert sorted(r.board for r in documents.scan_board_list(spark, str(tmp_path / "ids.txt")).collect()) == [7, 12]
    (tmp_path / "stems.txt").write_text("1_2 \n#x\n3_4\n")
    inline = spark.createDataFrame([("1_2",), ("9_9",)], "stem string")
    merged = joins.merge_stems(inline, documents.scan_stem_list(spark, str(tmp_path / "stems.txt")))
    assert sorted(r.stem for r in merged.collect()) == ["1_2", "3_4", "9_9"]


def test_runs(spark, tmp_path):
    for name, f1, epochs in (("a", 0.5, 50), ("b", None, 9), ("c", 0.9, 100)):
        run = tmp_path / name
        run.mkdir()
        (run / "run_meta_train_yolo.json").write_text(json.dumps({"stage": "train_yolo", "args": {"model": "m", "epochs": epochs}, "elapsed_sec": 1.5}))
        if f1:
            (run / "eval_boards.json").write_text(json.dumps({"aggregate": {"f1": f1, "mean_iou_micro": f1}}))
    runs = documents.scan_runs(spark, str(tmp_path))
    names = lambda *a: [r.name for r in documents.sort_runs(runs, *a).collect()]
    assert names("f1", "desc") == ["c", "a", "b"] and names("f1", "asc") == ["a", "c", "b"]
    assert names("epochs", "asc") == ["b", "a", "c"] and names("name", "desc", 1) == ["c"]
    writers.write_run_meta(spark, str(tmp_path / "meta"), "prepare", {"seed": 42}, 1.23456)
    writers.write_run_meta(spark, str(tmp_path / "meta"), "eval", {}, None, "abc")
    assert spark.read.json(str(tmp_path / "meta")).count() == 2
    assert documents.newest_file(spark, str(tmp_path), "run_meta_*.json").first().path.endswith(".json")


def test_seg_label_files_and_manifests(spark, tmp_path, data):
    dims = frames.frame_dims(spark, str(data / "images"))
    px = frames.decode_frames(spark, str(data / "images")).filter("ok")
    boxes = labels.labels_int(labels.scan_label_lines(spark, str(data / "labels")), dims).boxes
    made = boxes.withColumn("polygon", box_polygon(tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))))
    texts = writers.seg_label_files(px, made)
    assert writers.write_seg_labels(texts, str(tmp_path / "seg")) == 5
    assert (tmp_path / "seg" / "2_0.txt").read_text() == ""
    assert (tmp_path / "seg" / "1_0.txt").read_text().startswith("0 0.375000 0.375000 ")
    files = labels.scan_label_files(spark, str(tmp_path / "seg"))
    splits = spark.createDataFrame([(1, "train")], "board int, split string")
    listed = frames.scan_frames(spark, str(data / "images"))
    staged = joins.staging_join(listed, files, splits)
    assert joins.staging_summary(staged).first().asDict() == {"paired": 3, "no_label": 0, "no_split": 3, "train": 3, "val": 0, "test": 0}
    writers.write_split_manifests(staged, str(tmp_path / "lists"), "stem")
    assert [r.value for r in spark.read.text(str(tmp_path / "lists")).orderBy("value").collect()] == ["1_0", "1_1", "1_3"]
    todo = joins.resume(listed, files, ["board", "frame"])
    assert [(r.board, r.frame) for r in todo.collect()] == [(3, 0)]
    assert joins.resume(listed, files, ["board", "frame"], force=True).count() == 6


def test_inspect_frames(spark, data):
    px = frames.decode_frames(spark, str(data / "images")).filter("ok")
    dims = px.select("board", "frame", "img_w", "img_h")
    boxes = labels.labels_float(labels.scan_label_lines(spark, str(data / "labels")), dims).boxes.withColumnRenamed("line_no", "ann_id")
    got = {(r.board, r.frame): r for r in pixels.inspect_frames(px, boxes).collect()}
    strip, dark = 25 * 64, 4 * 8
    assert (got[(1, 3)].top, got[(1, 3)].bot) == (4, 3)
    assert got[(1, 3)].dark == pytest.approx(dark / strip)
    assert got[(1, 0)].dark == pytest.approx(dark / (strip - 16 * 8)) and got[(1, 0)].annot == 1
    assert (got[(2, 1)].top, got[(2, 1)].bot, got[(2, 1)].dark) == (-1, -1, 0.0)
    assert got[(1, 1)].edge == 1 and got[(1, 1)].clusters == 1


def test_mosaic_and_overlay(spark):
    rows = [(1, f, 40, 8, 3, bytes([f * 50 + 10] * 40 * 8 * 3), True) for f in range(3)]
    px = spark.createDataFrame(rows, "board int, frame int, img_w int, img_h int, channels int, pixels binary, ok boolean")
    canvas = spark.createDataFrame([(1, 80, 8)], "board int, board_width int, board_height int")
    tiles = pixels.board_mosaic(px, canvas, 20)
    shape = [(25, 1), (55, 1), (55, 6), (25, 6)]
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in shape])
    layers = canvas.select("board", F.lit("gt").alias("layer"), ring.alias("polygon"))
    layers = layers.unionByName(layers.withColumn("layer", F.lit("pred")).limit(1))
    drawn = pixels.overlay_outlines(tiles, layers, canvas, width=1, stride=20)
    want = np.zeros((8, 80, 3), dtype=np.uint8)
    for f in range(3):
        want[:, f * 20 : f * 20 + 40] = f * 50 + 10
    want[1, 25:56] = want[6, 25:56] = want[1:7, 25] = want[1:7, 55] = (0, 255, 0)
    for t in drawn.collect():
        got = np.frombuffer(t.bgr, dtype=np.uint8).reshape(t.height, t.width, 3)
        assert np.array_equal(got, want[:, t.x0 : t.x0 + t.width])
    image = pixels.board_images(drawn, canvas).first()
    assert image.png == pixels.encode_png(want) and pixels.tile_images(drawn).count() == 4


def test_job_counters(spark):
    rows = spark.createDataFrame([("processed", 1.5), ("processed", 0.5), ("failed", 0.0), ("unread", 0.0)], "status string, seconds double")
    assert scoring.job_counters(rows).first().asDict() == {"processed": 2, "unread": 1, "failed": 1, "inference_sec": 2.0}


def test_blank_label_lines(spark, tmp_path):
    (tmp_path / "1_0.txt").write_text("0 0.5 0.5 0.1 0.1\n\t\n \t \n")
    assert labels.scan_label_files(spark, str(tmp_path)).first().annots == 1 and labels.scan_label_lines(spark, str(tmp_path)).count() == 1


def test_wide_boards_become_images(spark):
    rows = [(1, i, i * 1000, 1000, 1, bytes([i]) * 3000) for i in range(70)]
    tiles = spark.createDataFrame(rows, "board int, slot int, x0 int, width int, height int, bgr binary")
    boards = spark.createDataFrame([(1, 70_000, 1)], "board int, board_width int, board_height int")
    got = {r.part: (r.x0, r.width, r.png) for r in pixels.board_images(tiles, boards).collect()}
    for part, lo, hi in ((0, 0, 64), (1, 64, 70)):
        want = np.repeat(np.arange(lo, hi, dtype=np.uint8), 1000)[None, :, None].repeat(3, axis=2)
        assert got[part] == (lo * 1000, (hi - lo) * 1000, pixels.encode_png(want))


def test_frame_documents_round_trip(spark, tmp_path):
    dims = spark.createDataFrame([(1, 0, 640, 220), (1, 1, 640, 220)], "board int, frame int, img_w int, img_h int")
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((1, 1), (9, 1), (9, 9))])
    det = dims.filter("frame = 0").select(
        "board", "frame", F.lit(0).cast("bigint").alias("det_id"),
        F.struct(*[F.lit(float(v)).cast("float").alias(n) for v, n in zip((1, 1, 9, 9), ("x1", "y1", "x2", "y2"))]).alias("bbox"),
        F.lit(0.5).cast("float").alias("confidence"), F.lit(0).alias("cls"), ring.alias("polygon"),
    )
    assert writers.write_frame_detections(writers.frame_documents(dims, det, "CPU"), str(tmp_path / "d")) == 2
    (tmp_path / "d" / "1_2.json").write_text("{broken")
    back = documents.scan_frame_detections(spark, str(tmp_path / "d"))
    assert sorted(r.frame for r in back.frames.collect()) == [0, 1]
    got = back.detections.first()
    assert (got.frame, got.confidence, [tuple(p) for p in got.polygon], tuple(got.bbox)) == (0, 0.5, [(1, 1), (9, 1), (9, 9)], (1, 1, 9, 9))
    assert [r.stem for r in back.corrupt.collect()] == ["1_2"]


def test_incremental_refresh(spark, tmp_path):
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((400, 5), (430, 5), (430, 20), (400, 20))])
    box = F.struct(*[F.lit(0.0).cast("float").alias(n) for n in ("x1", "y1", "x2", "y2")])
    each = F.struct(box.alias("bbox"), F.lit(0.5).cast("float").alias("confidence"), F.lit(0).alias("cls"), ring.alias("polygon"))
    rows = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "board int, frame int").select(
        "board", "frame", F.lit(640).alias("img_w"), F.lit(220).alias("img_h"), F.array(each).alias("detections")
    )
    table, out, state = (str(tmp_path / n) for n in ("frames", "boards", "state"))

    def deliver(cond):
        incremental.write_frame_table(rows.filter(cond), table)
        incremental.incremental_boards(spark, table, out, state).awaitTermination()
        return {(r.board, r.x1) for r in spark.read.parquet(out).collect()}

    assert deliver("frame = 0") == {(1, 400), (2, 400)}
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "boards" / "board_group=2").glob("*.parquet")}
    assert deliver("frame = 1") == {(1, 400), (1, 720), (2, 400)}
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "boards" / "board_group=2").glob("*.parquet")}
    assert before == after  # the other board was not rewritten
    merged = spark.read.parquet(out).filter("board = 1").orderBy("x1").collect()
    direct = scoring.run_boards(rows.filter("board = 1")).polygons.orderBy("x1").collect()
    assert [(r.poly_id, r.area) for r in merged] == [(r.poly_id, r.area) for r in direct]


def test_newest_delivery_of_a_frame_wins(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, 640), (1, 1, 640)], "board int, frame int, img_w int")
    none = F.array().cast("array<struct<bbox:struct<x1:float,y1:float,x2:float,y2:float>,confidence:float,cls:int,polygon:array<struct<x:int,y:int>>>>")
    rows = rows.select("board", "frame", "img_w", F.lit(220).alias("img_h"), none.alias("detections"))
    table = str(tmp_path / "frames")
    for day, width in ((2, 700), (3, 800), (1, 900)):  # the latest time wins, whatever was written last
        again = rows.filter("frame = 1").withColumn("img_w", F.lit(width))
        incremental.write_frame_table(again, table, delivered=F.lit(f"2024-01-0{day}").cast("timestamp"))
    incremental.write_frame_table(rows.filter("frame = 0"), table)
    got = incremental.newest_frames(spark.read.schema(incremental.FRAME_TABLE).parquet(table)).collect()
    assert sorted((r.frame, r.img_w) for r in got) == [(0, 640), (1, 800)]


def test_png_layout():
    raw = pixels.encode_png(np.arange(24, dtype=np.uint8).reshape(2, 4, 3))
    assert struct.unpack(">II", raw[16:24]) == (4, 2)
    size = struct.unpack(">I", raw[33:37])[0]
    assert zlib.decompress(raw[41 : 41 + size])[1:4] == bytes([2, 1, 0])
