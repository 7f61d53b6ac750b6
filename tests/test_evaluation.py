"""Hand-computed evaluation results and a plain version of the COCO protocol."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crownframe.functions import boxes as B
from crownframe.operators import coco_eval, metrics
from crownframe.plans import grid_search, raster_level
from tests import brute

BOX = "x0 double, y0 double, x1 double, y1 double"


def objects(spark, boxes, scores=None, ident="object_id"):
    rows = [(0, i, *map(float, b), scores[i] if scores else 1.0) for i, b in enumerate(boxes)]
    name = "aggregator_score" if scores else "unused"
    return spark.createDataFrame(rows, f"product_id int, {ident} bigint, {BOX}, {name} double")


def evaluate(spark, preds, scores, truths, **options):
    out = raster_level.raster_level(objects(spark, preds, scores), objects(spark, truths, None, "truth_id"),
                                    1.0, **options)
    return out.collect()[0]


def row_of_squares(n, side, gap=3.0, y=5.0):
    return [(i * (side + gap), y, i * (side + gap) + side, y + side) for i in range(n)]


A = (0, 0, 10, 10)


@pytest.mark.parametrize(("hits", "extra", "missed"), [(5, 0, 0), (0, 4, 6), (7, 2, 1), (3, 0, 9)])
def test_counts_of_hits_extras_and_misses(spark, hits, extra, missed):
    """Squares of side 7: some in both tables, some only predicted (far above), some only true (far below)."""
    same = row_of_squares(hits, 7.0)
    preds = same + row_of_squares(extra, 7.0, y=900.0)
    truths = same[::-1] + row_of_squares(missed, 7.0, y=-900.0)
    r = evaluate(spark, preds, [0.95 - 0.01 * i for i in range(len(preds))], truths)
    assert (r["tp"], r["fp"], r["fn"]) == (hits, extra, missed)
    assert r["precision"] == pytest.approx(hits / (hits + extra)) and r["recall"] == pytest.approx(hits / (hits + missed))
    assert r["f1"] == pytest.approx(2 * hits / (2 * hits + extra + missed))


def test_means_over_three_thresholds(spark):
    """Strips of 12 by 4 moved along by 0, 1, 2 and 4: IoU 1, 11/13, 5/7 and 1/2."""
    truths = [(40.0 * i, 0.0, 40.0 * i + 12.0, 4.0) for i in range(4)]
    preds = [(x0 + d, y0, x1 + d, y1) for (x0, y0, x1, y1), d in zip(truths, (0.0, 1.0, 2.0, 4.0))]
    r = evaluate(spark, preds, [0.3, 0.6, 0.4, 0.5], truths, thresholds=(0.8, 0.45, 0.7, 0.45))
    assert list(r["iou_thresholds"]) == [0.45, 0.7, 0.8]
    assert r["recall_per_iou"] == [1.0, 0.75, 0.5] and r["recall"] == pytest.approx(0.75)


def test_polygons_and_their_boxes(spark):
    """An L against its box: equal as boxes, three quarters as polygons."""
    ell = [[0.0, 0.0, 10.0, 0.0, 10.0, 5.0, 5.0, 5.0, 5.0, 10.0, 0.0, 10.0]]
    box = [[0.0, 0.0, 10.0, 0.0, 10.0, 10.0, 0.0, 10.0]]
    p = spark.createDataFrame([(0, 1, 0.9, ell)], "product_id int, object_id bigint, score double, rings array<array<double>>")
    t = spark.createDataFrame([(0, 1, box)], "product_id int, truth_id bigint, rings array<array<double>>")
    got = raster_level.raster_level(p, t, 1.0, thresholds=(0.7, 0.8), iou_type="segm").collect()[0]
    assert got["f1_per_iou"] == [1.0, 0.0]
    env = [df.withColumns(raster_level.R.envelope(F.col("rings"))) for df in (p, t)]
    assert raster_level.raster_level(*env, 1.0, thresholds=(0.99,)).collect()[0]["f1"] == 1.0


def test_polygons_are_clipped_to_the_aoi(spark):
    box = [[0.0, 0.0, 10.0, 0.0, 10.0, 10.0, 0.0, 10.0]]
    far = [[0.0, 0.0, 20.0, 0.0, 20.0, 10.0, 0.0, 10.0]]
    p = spark.createDataFrame([(0, 1, 0.9, far)], "product_id int, object_id bigint, score double, rings array<array<double>>")
    t = spark.createDataFrame([(0, 1, box)], "product_id int, truth_id bigint, rings array<array<double>>")
    aoi = spark.createDataFrame([(0, 0.0, 0.0, 10.0, 10.0)], f"product_id int, {BOX}")
    got = raster_level.raster_level(p, t, 1.0, thresholds=(0.99,), iou_type="segm", aoi=aoi).collect()[0]
    assert got["f1"] == 1.0


def test_object_in_two_aoi_rows_counts_twice(spark):
    aoi = spark.createDataFrame([(0, 0.0, 0.0, 5.0, 10.0), (0, 6.0, 0.0, 20.0, 10.0)], f"product_id int, {BOX}")
    r = evaluate(spark, [A], [0.9], [A], aoi=aoi)
    assert (r["num_preds"], r["num_truths"], r["tp"]) == (2, 2, 2)


def test_size_classes_have_inclusive_lower_bounds(spark):
    rows = spark.createDataFrame([(v,) for v in (0.0, 8.99, 9.0, 25.0, 49.0, 99.9, 100.0, 1e11)], "a double")
    got = [r[0] for r in rows.select(B.size_label(F.col("a"), 1.0)).collect()]
    assert got == ["tiny", "tiny", "small", "medium", "large", "large", "giant", "giant"]
    assert B.area_ranges(0.5)["small"] == (36.0, 100.0)


def test_score_column_order(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "segmenter_score double, aggregator_score double")
    assert metrics.pick_score(df) == "aggregator_score"
    with pytest.raises(ValueError):
        metrics.pick_score(df.select(F.lit(1).alias("x")))


# --- COCO protocol ------------------------------------------------------------------------------

def protocol(dets, gts, ranges, thresholds, limits):
    """Plain version: dets (img, id, box, score), gts (img, id, box, area, crowd)."""
    images = sorted({d[0] for d in dets} | {g[0] for g in gts})
    out = {}
    for label, (lo, hi) in ranges.items():
        npig = sum(1 for g in gts if not g[4] and lo <= g[3] <= hi)
        for limit in limits:
            for t in thresholds:
                flags = []
                for img in images:
                    ds = sorted([d for d in dets if d[0] == img], key=lambda d: (-d[3], d[1]))[:max(limits)]
                    gs = sorted([(g[4] or g[3] < lo or g[3] > hi, g) for g in gts if g[0] == img],
                                key=lambda v: (v[0], v[1][1]))
                    taken = set()
                    for rank, d in enumerate(ds):
                        best, pick = min(t, 1 - 1e-10), None
                        for ignored, g in gs:
                            if g[1] in taken and not g[4]:
                                continue
                            if pick is not None and not pick[0] and ignored:
                                break
                            i = brute.iou(d[2], g[2])
                            if g[4]:
                                w = max(min(d[2][2], g[2][2]) - max(d[2][0], g[2][0]), 0)
                                h = max(min(d[2][3], g[2][3]) - max(d[2][1], g[2][1]), 0)
                                i = w * h / ((d[2][2] - d[2][0]) * (d[2][3] - d[2][1]))
                            if i < best:
                                continue
                            best, pick = i, (ignored, g)
                        size = (d[2][2] - d[2][0]) * (d[2][3] - d[2][1])
                        if pick is None:
                            kind = "fp" if lo <= size <= hi else "ignored"
                        else:
                            taken.add(pick[1][1])
                            kind = "ignored" if pick[0] else "tp"
                        if rank < limit:
                            flags.append((-d[3], img, rank, kind))
                flags = [f[3] for f in sorted(flags) if f[3] != "ignored"]
                tp = np.cumsum([f == "tp" for f in flags]) if flags else np.array([])
                if npig == 0:
                    out[label, limit, t] = (-1, [-1] * 101)
                    continue
                pr = [tp[i] / (i + 1) for i in range(len(flags))]
                rc = [v / npig for v in tp]
                curve = [max([p for p, r in zip(pr, rc) if r >= k * 0.01], default=0.0) for k in range(101)]
                out[label, limit, t] = (rc[-1] if rc else 0.0, curve)
    return out


@pytest.mark.parametrize("limits", [(1, 3, 20), (2,)])
def test_coco_metrics_equal_the_protocol(spark, limits):
    rng = random.Random(4)
    dets = [(i % 4, i, b, s) for i, _, b, s in brute.boxes(120, seed=41, span=15, sizes=(2, 6))]
    gts = []
    for i, _, b, _ in brute.boxes(60, seed=42, span=15, sizes=(2, 6)):
        gts.append((i % 5, i, b, (b[2] - b[0]) * (b[3] - b[1]), rng.random() < 0.15))
    ranges = {"all": (0.0, 1e10), "small": (0.0, 12.0), "huge": (1e6, 1e7)}
    thresholds = (0.3, 0.5, 0.75)
    d = spark.createDataFrame([(r[0], 1, r[1], r[3], *r[2]) for r in dets],
                              f"image_id bigint, category_id int, det_id bigint, score double, {BOX}")
    g = spark.createDataFrame([(r[0], 1, r[1], *map(float, r[2]), r[3], r[4]) for r in gts],
                              f"image_id bigint, category_id int, gt_id bigint, {BOX}, area double, iscrowd boolean")
    outcomes = coco_eval.coco_match(d, g, ranges, thresholds, max(limits))
    acc = coco_eval.coco_accumulate(outcomes, coco_eval.countable_truths(g, ranges), limits, thresholds)
    got = {(r["area_label"], r["max_dets"], r["iou_threshold"]): (r["recall"], list(r["precision"]))
           for r in acc.collect()}
    want = protocol(dets, gts, ranges, thresholds, limits)
    assert set(got) == set(want)
    for key in want:
        assert got[key][0] == pytest.approx(want[key][0]), key
        assert got[key][1] == pytest.approx(want[key][1]), key


def test_coco_summary_without_truth_is_minus_one(spark):
    g = spark.createDataFrame([(0, 1, 0, 0.0, 0.0, 2.0, 2.0, 4.0, False)],
                              f"image_id bigint, category_id int, gt_id bigint, {BOX}, area double, iscrowd boolean")
    d = spark.createDataFrame([(0, 1, 0, 0.9, 0.0, 0.0, 2.0, 2.0)],
                              f"image_id bigint, category_id int, det_id bigint, score double, {BOX}")
    r = coco_eval.tile_level(d, g, (1, 10, 100, 400), gsd=1.0).collect()[0]
    assert r["AP"] == 1.0 and r["AR"] == 1.0 and r["AP_tiny"] == 1.0 and r["AP_giant"] == -1.0
    assert (r["num_images"], r["num_truths"], r["num_preds"]) == (1, 1, 1)


def test_tile_level_goes_by_the_images_of_the_truth(spark):
    """Raster 1: a hit on image 1, a prediction on image 7, which the truth doesn't have, and image 2 without
    truths. Raster 2: predictions only."""
    truths = spark.createDataFrame([(1, 1, 1, 0, 0.0, 0.0, 2.0, 2.0, 4.0, False)],
                                   f"product_id int, image_id bigint, category_id int, gt_id bigint, {BOX}, area double, iscrowd boolean")
    dets = spark.createDataFrame([(1, 1, 1, 0, 0.9, 0.0, 0.0, 2.0, 2.0), (1, 7, 1, 1, 0.95, 0.0, 0.0, 2.0, 2.0),
                                  (2, 4, 1, 2, 0.5, 0.0, 0.0, 2.0, 2.0)],
                                 f"product_id int, image_id bigint, category_id int, det_id bigint, score double, {BOX}")
    images = spark.createDataFrame([(1, 1), (1, 2), (2, 4)], "product_id int, image_id bigint")
    rows = {r["product_id"]: r for r in coco_eval.tile_level(dets, truths, (1, 10, 100), group=["product_id"], images=images).collect()}
    assert (rows[1]["AP"], rows[1]["num_images"], rows[1]["num_truths"], rows[1]["num_preds"]) == (1.0, 2, 1, 1)
    assert (rows[2]["AP"], rows[2]["AR"], rows[2]["num_images"], rows[2]["num_truths"], rows[2]["num_preds"]) == (-1.0, -1.0, 1, 0, 1)
    alone = coco_eval.tile_level(dets, truths, (1, 10, 100)).collect()[0]
    assert (alone["AP"], alone["num_images"], alone["num_preds"]) == (1.0, 1, 1)


def test_coco_puts_null_scores_last(spark):
    truths = spark.createDataFrame([(1, 1, 0, 0.0, 0.0, 2.0, 2.0, 4.0, False)],
                                   f"image_id bigint, category_id int, gt_id bigint, {BOX}, area double, iscrowd boolean")
    dets = spark.createDataFrame([(1, 1, 10, None, 0.0, 0.0, 2.0, 2.0), (1, 1, 11, 0.1, 0.0, 0.0, 2.0, 2.0)],
                                 f"image_id bigint, category_id int, det_id bigint, score double, {BOX}")
    got = coco_eval.coco_match(dets, truths, {"all": (0.0, 1e10)}, (0.5,), 10).collect()
    assert {(r["det_id"], r["rank"], r["tp_mask"], r["fp_mask"]) for r in got} == {(11, 1, 1, 0), (10, 2, 0, 1)}


# --- search -----------------------------------------------------------------------------------

def test_grid_search_equals_running_every_pair(spark):
    preds, truths = brute.boxes(120, seed=51), brute.boxes(80, seed=52)
    p, t = brute.frame(spark, preds), brute.frame(spark, truths, "truth_id", "unused")
    got = {(r["raster_name"], r["nms_iou"], r["nms_score"]): r for r in grid_search.nms_grid_search(
        p, t, 1.0, nms_ious=(0.3, 0.7), nms_scores=(0.0, 0.5), eval_thresholds=(0.3, 0.6)).collect()}
    for (name, ti, ts), r in got.items():
        mine = [x for x in preds if x[1] == int(name) and x[3] >= ts]
        kept = brute.nms(mine, ti)
        mine = [x for x in mine if x[0] in kept]
        real = [x for x in truths if x[1] == int(name)]
        f1 = []
        for th in (0.3, 0.6):
            tp = len(brute.match(mine, real, th))
            f1.append(2 * tp / (len(mine) + len(real)) if mine or real else 0)
        assert r["num_preds"] == len(mine) and r["f1"] == pytest.approx(sum(f1) / 2)
    assert len(got) == 8
