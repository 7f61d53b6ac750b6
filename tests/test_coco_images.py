"""Detections and truths of an image meet in one sort, batch by batch."""

import pyarrow as pa
from pyspark.sql import functions as F

from crownframe.functions.batches import changes
from crownframe.operators import coco_eval


def image_rows(spark):
    dets = [(i, 0, 10 * i + k, 1 - k / 10, 0.0, 0.0, 10.0, 10.0 - k) for i in range(3) for k in range(4)]
    truths = [(i, 0, 100 + i, 0.0, 0.0, 10.0, 10.0, 100.0, False) for i in range(3)] + [(0, 0, 200, 0.0, 0.0, 10.0, 8.0, 80.0, True)]
    box = "x0 double, y0 double, x1 double, y1 double"
    return (spark.createDataFrame(dets, f"image_id long, category_id int, det_id long, score double, {box}"),
            spark.createDataFrame(truths, f"image_id long, category_id int, gt_id long, {box}, area double, iscrowd boolean"))


def test_boxes_of_an_image_meet_without_a_join(spark):
    dets, truths = image_rows(spark)
    out = coco_eval.coco_match(dets, truths, {"all": (0.0, 1e9), "small": (0.0, 75.0)}, [0.5, 0.95], 3)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["det_id"], r["area_label"]): (r["rank"], r["tp_mask"], r["fp_mask"]) for r in out.collect()}
    assert len(got) == 3 * 3 * 2
    assert got[10, "all"] == (1, 3, 0) and got[11, "all"] == (2, 0, 3)     # the truth is taken once
    assert got[1, "all"] == (2, 0, 2) or got[1, "all"] == (2, 0, 0)        # the crowd takes what it covers
    assert got[10, "small"] == (1, 0, 0)                                    # ignored truth, detection out of range


def test_ranks_go_on_over_batches(spark):
    """Rows behind the strongest go out as they come, also if an image lies in several batches."""
    dets, truths = image_rows(spark)
    ranges = {"all": (0.0, 1e9)}
    settle = coco_eval._settle_images(["image_id", "category_id"], ranges, [0.5], 2)
    both = dets.selectExpr("image_id", "category_id", "1 as _side", "det_id as id", "score", "x0", "y0", "x1", "y1").unionByName(
        truths.selectExpr("image_id", "category_id", "0 as _side", "gt_id as id", "x0", "y0", "x1", "y1", "area", "iscrowd"), allowMissingColumns=True)
    table = both.orderBy("image_id", "_side", both["score"].desc(), "id").toArrow()
    want = None
    for size in (1, 2, 3, 100):
        rows = [r for b in settle(iter(table.combine_chunks().to_batches(max_chunksize=size))) for r in b.to_pylist()]
        assert [(r["det_id"], r["rank"]) for r in rows] == [(10 * i + k, k + 1) for i in range(3) for k in range(2)]
        assert want in (None, rows)
        want = rows


def test_large_ids_beside_nulls_stay_apart():
    ids = pa.array([2 ** 60, 2 ** 60 + 1, None, None], pa.int64())
    assert changes(pa.RecordBatch.from_arrays([ids], names=["k"]), ["k"]).tolist() == [False, True, True, False]


def test_masks_of_an_image_meet_in_one_sort(spark):
    """Detections, truths and runs are shuffled once, without a join; what lies behind `max_dets` is left out."""
    dets, truths = image_rows(spark)
    runs = []
    for df, ident in ((dets, "det_id"), (truths, "gt_id")):
        lines = F.explode(F.sequence(F.lit(0), F.col("y1").cast("int") - 1))
        runs.append(df.select("image_id", "category_id", ident, lines.alias("line"), F.lit(0).alias("c0"), F.lit(10).alias("c1")))
    ranges, steps = {"all": (0.0, 1e9), "small": (0.0, 75.0)}, [0.5, 0.85, 0.95]
    wanted = sorted(map(tuple, coco_eval.coco_match(dets, truths, ranges, steps, 3).collect()))
    out = coco_eval.coco_match(dets.drop("x0", "y0", "x1", "y1"), truths.drop("x0", "y0", "x1", "y1"), ranges, steps, 3, runs=tuple(runs))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("RepartitionByExpression") == 1
    assert sorted(map(tuple, out.collect())) == wanted
    both = coco_eval._match(dets, truths, ["image_id", "category_id"], ranges, steps, 3, tuple(runs))
    assert both.count() == 9


def test_curves_go_on_over_chunks(spark, monkeypatch):
    """A key in many chunks and blocks has the curve of one chunk; a key without truths none, one without detections zeros."""
    rows = [(k % 2, "all", float(k % 7), k, 1 + k % 3, k, (k * 5) % 4, ((k * 5) % 4) ^ 3) for k in range(300)]
    rows.append((9, "all", 1.0, 1, 1, 1, 3, 0))
    outcomes = spark.createDataFrame(rows, "category_id int, area_label string, score double, image_id long, rank int, det_id long, tp_mask long, fp_mask long")
    npig = spark.createDataFrame([(0, "all", 200), (1, "all", 90), (2, "all", 4), (3, "all", 0)], "category_id int, area_label string, npig long")

    def curves():
        out = coco_eval.coco_accumulate(outcomes, npig, (1, 3), (0.5, 0.75))
        return {(r["category_id"], r["max_dets"], r["iou_threshold"]): (r["npig"], r["precision"], r["recall"]) for r in out.collect()}

    whole = curves()
    small = spark.conf.get("spark.sql.shuffle.partitions")
    plain = coco_eval._chunks
    monkeypatch.setattr(coco_eval, "_chunks", lambda keys, limits, n, most=3: plain(keys, limits, n, most))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        assert curves() == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", small)
    assert len(whole) == 4 * 2 * 2
    assert whole[2, 3, 0.5] == (4, [0.0] * 101, 0.0) and whole[3, 3, 0.5] == (0, [-1.0] * 101, -1.0)
    order = sorted((r for r in rows if r[0] == 0 and r[4] <= 3), key=lambda r: (-r[2], r[3], r[4], r[5]))
    tp = fp = 0
    best = [0.0] * 101
    for r in order:
        tp, fp = tp + (r[6] & 1), fp + (r[7] & 1)
        if r[6] & 1:
            best = [max(p, tp / (tp + fp)) if i * (1.0 / 100) <= tp / 200 else p for i, p in enumerate(best)]
    assert whole[0, 3, 0.5] == (200, best, tp / 200)
