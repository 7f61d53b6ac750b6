"""Polygons, masks and coordinates."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crownframe.functions import boxes as B
from crownframe.functions import geodesy, polygons, rle
from crownframe.functions import rings as R
from crownframe.operators import dissolve, masks, pixels


def flat(*points):
    return [float(v) for p in points for v in p]


def test_slab_area_of_known_shapes():
    square = [flat((0, 0), (4, 0), (4, 4), (0, 4))]
    triangle = [flat((0, 0), (4, 0), (0, 4))]
    hole = [square[0], flat((1, 1), (3, 1), (3, 3), (1, 3))]
    diamond = [flat((2, -1), (5, 2), (2, 5), (-1, 2))]
    assert polygons.shared_area(square) == 16 and polygons.shared_area(triangle) == 8
    assert polygons.shared_area(hole) == 12 and polygons.shared_area(square, triangle) == 8
    assert polygons.shared_area(square, diamond) == pytest.approx(14)
    assert polygons.shared_area(hole, diamond) == pytest.approx(10)
    assert polygons.shared_area(square, [flat((9, 9), (10, 9), (10, 10))]) == 0


def test_slab_area_equals_box_formula_and_counts_union():
    rng = random.Random(1)
    for _ in range(100):
        a, b = ([rng.uniform(0, 5), rng.uniform(0, 5)] for _ in range(2))
        a += [a[0] + rng.uniform(1, 4), a[1] + rng.uniform(1, 4)]
        b += [b[0] + rng.uniform(1, 4), b[1] + rng.uniform(1, 4)]
        ring = lambda v: [flat((v[0], v[1]), (v[2], v[1]), (v[2], v[3]), (v[0], v[3]))]
        want = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
        assert polygons.shared_area(ring(a), ring(b)) == pytest.approx(want)


def test_polygon_mask_agrees_with_area():
    rng = random.Random(2)
    for _ in range(20):
        ring = [flat(*[(rng.uniform(5, 95), rng.uniform(5, 95)) for _ in range(6)])]
        lines = polygons.scan_lines(polygons._array([ring]), np.array([100]), np.array([100]))
        assert (lines[3] - lines[2]).sum() == pytest.approx(polygons.shared_area(ring), rel=0.1, abs=60)


def test_repair_of_a_bow_tie_and_of_lines(spark):
    df = spark.createDataFrame([(1, [flat((0, 0), (10, 10), (10, 0), (0, 10))]), (2, [flat((0, 0), (1, 1), (2, 2))]),
                                (3, [flat((20, 20), (30, 20), (30, 30), (20, 30))])], "id int, rings array<array<double>>")
    fixed = df.withColumn("parts", polygons.repair("rings"))
    got = {r["id"]: (len(r["parts"]), r["top"]) for r in fixed.withColumn(
        "top", R.polygon_area(polygons.largest_part("parts"))).collect()}
    assert got[1] == (2, pytest.approx(25)) and got[2][0] == 0 and got[3] == (1, pytest.approx(100))


def test_counts_text_round_trip():
    rng = random.Random(3)
    for _ in range(200):
        counts = [rng.randrange(0, 3000) for _ in range(rng.randrange(1, 30))]
        assert rle.decode_text(rle.encode_text(counts)) == counts
    assert rle.encode_text([0, 4, 12]) == "04<"


def test_rle_and_runs_are_inverse_for_uneven_masks(spark):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for i in range(20):
        h, w = int(rng.integers(2, 9)), int(rng.integers(2, 9))
        mask = rng.random((h, w)) < 0.5
        line = mask.T.ravel().astype(int)   # column by column
        change = np.flatnonzero(np.diff(np.r_[0, line, 1 - line[-1]]))
        counts = np.diff(np.r_[0, change]).tolist()
        rows.append((i, h, w, counts))
        want[i] = (mask, counts)
    df = spark.createDataFrame(rows, "id int, height int, width int, counts array<int>")
    runs = masks.rle_to_runs(df, ["id"])
    back = {i: np.zeros(m.shape, bool) for i, (m, _) in want.items()}
    for r in runs.collect():
        back[r["id"]][r["c0"]:r["c1"], r["line"]] = True
    assert all((back[i] == m).all() for i, (m, _) in want.items())
    again = masks.runs_to_rle(runs, df.select("id", "height", "width"), ["id"])
    for r in again.collect():
        line = want[r["id"]][0].T.ravel()
        got = np.repeat(np.arange(len(r["counts"])) % 2, r["counts"]).astype(bool)
        assert (got == line).all()


def random_masks(n, seed, side=24):
    rng = np.random.default_rng(seed)
    out = {}
    for i in range(n):
        m = np.zeros((side, side), bool)
        for _ in range(2):
            y, x = rng.integers(0, side - 4, 2)
            m[y:y + rng.integers(1, 5), x:x + rng.integers(1, 5)] = True
        out[i] = m
    return out


def run_rows(spark, pixel_masks, name):
    rows = []
    for i, m in pixel_masks.items():
        for y, line in enumerate(m):
            edge = np.diff(np.r_[0, line.astype(int), 0])
            rows += [(0, i, y, int(a), int(b)) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
    return spark.createDataFrame(rows, f"product_id int, {name} bigint, line int, c0 int, c1 int")


def test_mask_pairs_subtraction_and_overlay(spark):
    a, b = random_masks(12, 5), random_masks(12, 6)
    pairs = masks.mask_pairs(run_rows(spark, a, "a"), run_rows(spark, b, "b"), "a", "b")
    got = {(r["a_id"], r["b_id"]): (r["inter"], r["iou"]) for r in pairs.collect()}
    want = {(i, j): ((m & n).sum(), (m & n).sum() / (m | n).sum()) for i, m in a.items() for j, n in b.items() if (m & n).any()}
    assert got == {k: (v[0], pytest.approx(v[1])) for k, v in want.items()}


def test_mask_pairs_over_blocks_and_in_crowds(spark, monkeypatch):
    """Few pairs at a time, masks over several blocks, and masks against themselves."""
    monkeypatch.setattr(masks, "SIDE", 8)
    shapes = random_masks(10, 8)
    shapes |= {100 + k: shapes[3].copy() for k in range(20)}
    runs = run_rows(spark, shapes, "a")
    for many in (5, 1 << 20):
        pieces = [r for side, d in ((0, runs), (1, runs)) for r in masks._blocks(d, "a", ["product_id"], side).sort("_by", "_bx").toArrow().to_pylist()]
        pieces.sort(key=lambda r: (r["_by"], r["_bx"]))
        schema = masks._blocks(runs, "a", ["product_id"], 0).toArrow().schema
        batches = [pa.RecordBatch.from_pylist(pieces[k:k + 7], schema) for k in range(0, len(pieces), 7)]
        monkeypatch.setattr(masks, "MANY", many)
        got = {}
        for b in masks._meet(["product_id"], False)(iter(batches)):
            for r in b.to_pylist():
                assert (r["area_a"], r["area_b"]) == (shapes[r["a_id"]].sum(), shapes[r["b_id"]].sum())
                got[r["a_id"], r["b_id"]] = got.get((r["a_id"], r["b_id"]), 0) + r["inter"]
        assert got == {(i, j): (m & n).sum() for i, m in shapes.items() for j, n in shapes.items() if (m & n).any()}
    own = masks.overlap_area(runs, runs, "a", "a", extra=F.col("a_id") < F.col("b_id")).collect()
    assert {(r["a_id"], r["b_id"]): r["inter"] for r in own} == {k: v for k, v in got.items() if k[0] < k[1]}


def test_mask_pairs_shuffle_no_row_per_pair_and_line(spark):
    """One row per mask and block goes to the pairing: no join is left."""
    shapes = run_rows(spark, random_masks(3, 9), "a")
    assert "Join" not in plan_of(masks.mask_pairs(shapes, shapes.withColumnRenamed("a", "b"), "a", "b"))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_run_lengths_of_cut_and_unordered_runs_without_windows(spark):
    shapes = random_masks(40, 10)
    rows = [r for i, m in shapes.items() for r in (
        (i, int(x), int(y), int(y) + 1) for x, y in np.random.default_rng(1).permutation(np.argwhere(m.T)).tolist())]
    runs = spark.createDataFrame(rows, "id long, line int, c0 int, c1 int").repartition(3)      # single pixels, by columns
    sizes = spark.createDataFrame([(i, *m.shape) for i, m in [*shapes.items(), (77, np.zeros((3, 2), bool))]], "id long, height int, width int")
    coded = masks.runs_to_rle(runs, sizes, ["id"])
    got = {r["id"]: r["counts"] for r in coded.collect()}
    for i, m in shapes.items():
        flat_mask = np.repeat(np.arange(len(got[i])) % 2 == 1, got[i])
        assert 0 not in got[i][1:] and (flat_mask.reshape(m.T.shape) == m.T).all()
    assert got[77] == [6]
    back = masks.rle_to_runs(coded, ["id"])
    seen = {i: np.zeros(m.shape, bool) for i, m in shapes.items()}
    for r in back.collect():
        seen[r["id"]][r["c0"]:r["c1"], r["line"]] = True
    assert all((seen[i] == m).all() for i, m in shapes.items())
    assert not any(w in plan_of(d) for d in (coded, back) for w in ("Window", "Join", "Aggregate"))


def test_coarse_masks_without_a_row_per_cell(spark):
    shapes = random_masks(40, 11)
    coarse = masks.downscale_runs(run_rows(spark, shapes, "a"), 3, ["product_id", "a"])
    got = {}
    for r in coarse.collect():
        got.setdefault(r["a"], np.zeros((8, 8), bool))[r["line"], r["c0"]:r["c1"]] = True
    for i, m in shapes.items():
        want = m.reshape(8, 3, 8, 3).sum(axis=(1, 3)) * 2 >= 9
        assert (got.get(i, np.zeros((8, 8), bool)) == want).all()
    assert "Generate" not in plan_of(coarse) and "Aggregate" not in plan_of(coarse)


def test_dissolve_gives_connected_parts_with_all_pixels(spark):
    shapes = random_masks(14, 7)
    shapes[99] = shapes[3].copy()   # a copy changes nothing
    old, dissolve.BLOCK = dissolve.BLOCK, 8   # several blocks per line
    try:
        got = dissolve.dissolve(run_rows(spark, shapes, "id"), "id").collect()
    finally:
        dissolve.BLOCK = old
    union = np.zeros((24, 24), bool)
    for m in shapes.values():
        union |= m
    label = np.full(union.shape, -1)
    for y, x in zip(*np.nonzero(union)):
        if label[y, x] < 0:
            todo, n = [(y, x)], y * 100 + x
            label[y, x] = n
            while todo:
                i, j = todo.pop()
                for p, q in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)):
                    if 0 <= p < 24 and 0 <= q < 24 and union[p, q] and label[p, q] < 0:
                        label[p, q] = n
                        todo.append((p, q))
    want = {}
    for n in set(label[label >= 0]):
        part = label == n
        want[min(i for i, m in shapes.items() if (m & part).any())] = None
    names = {n: min(i for i, m in shapes.items() if (m & (label == n)).any()) for n in set(label[label >= 0])}
    cells = {(r["component"], r["line"], x) for r in got for x in range(r["c0"], r["c1"])}
    assert cells == {(names[label[y, x]], y, x) for y, x in zip(*np.nonzero(union))}


def plain_disambiguation(shapes, score, threshold, keep_ratio):
    """Pixels that stay, by comparing every mask with every stronger one."""
    out = set()
    for i, m in shapes.items():
        above = [n for j, n in shapes.items() if (score[j], -j) > (score[i], -i)]
        left = m & ~np.logical_or.reduce([np.zeros_like(m), *above])
        worst = max([(m & n).sum() for n in above], default=0)
        if left.any() and (worst <= threshold * m.sum() or left.sum() >= keep_ratio * m.sum()):
            out |= {(i, int(y), int(x)) for y, x in zip(*np.nonzero(left))}
    return out


@pytest.mark.parametrize("seed, threshold, keep_ratio", [(8, 0.3, 0.5), (9, 0.5, 0.9), (10, 0.1, 0.2), (11, 0.45, 1.0)])
def test_disambiguation_is_that_of_all_pairs(spark, seed, threshold, keep_ratio):
    shapes = random_masks(25, seed)
    shapes[50] = shapes[2].copy()
    score = {i: (i * 7 % 11) / 11 for i in shapes}
    scores = spark.createDataFrame([(0, i, s) for i, s in score.items()], "product_id int, object_id bigint, segmenter_score double")
    rest = masks.nms_ioa_disambiguate(run_rows(spark, shapes, "object_id"), scores, threshold, keep_ratio)
    cells = [(r["object_id"], r["line"], x) for r in rest.collect() for x in range(r["c0"], r["c1"])]
    assert len(cells) == len(set(cells)) and set(cells) == plain_disambiguation(shapes, score, threshold, keep_ratio)


@pytest.mark.parametrize("seed", [8, 10])
def test_disambiguation_of_small_keys_is_settled_in_one_task(spark, monkeypatch, seed):
    shapes = random_masks(25, seed)
    score = {i: None if i % 6 == 0 else float("nan") if i % 6 == 1 else (i * 7 % 5) / 5 for i in shapes}
    scores = spark.createDataFrame([(0, i, s) for i, s in score.items()], "product_id int, object_id bigint, segmenter_score double")
    runs = run_rows(spark, shapes, "object_id")
    runs = runs.unionByName(runs.withColumn("c1", F.col("c1") + 1).filter("object_id % 5 = 0"))      # some masks overlap themselves

    def run(**options):
        rest = masks.nms_ioa_disambiguate(runs, scores, 0.1, 0.9, **options)
        return {(r["object_id"], r["line"], x) for r in rest.collect() for x in range(r["c0"], r["c1"])}

    lines = run(few_runs=0)
    monkeypatch.setattr(masks, "_disambiguate_lines", None)
    assert lines and run() == lines


def test_a_crowd_of_near_copies_makes_no_pairs(spark):
    """Thousands of masks on one spot: the strongest stays, and what each line hands on follows its runs."""
    n = 5000
    ids = spark.range(n).select(F.lit(0).alias("product_id"), F.col("id").alias("object_id"))
    runs = ids.select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("line"), (F.col("object_id") % 7).cast("int").alias("c0"),
                      (F.lit(90) + F.col("object_id") % 5).cast("int").alias("c1"))
    scores = ids.select("*", (F.lit(1.0) / (F.col("object_id") + 1)).alias("segmenter_score"))
    rest = masks.nms_ioa_disambiguate(runs, scores)
    assert {(r["object_id"], r["n"]) for r in masks.mask_area(rest, ["object_id"]).withColumnRenamed("area", "n").collect()} == {(0, 360)}


def test_overlapping_aoi_boxes_become_disjoint(spark):
    aoi = spark.createDataFrame([(0, 0.0, 0.0, 10.0, 10.0), (0, 5.0, 5.0, 15.0, 15.0)],
                                "product_id int, x0 double, y0 double, x1 double, y1 double")
    out = dissolve.disjoint_boxes(aoi)
    assert out.agg(F.sum(B.area(B.box()))).first()[0] == 175


def test_utm_of_a_known_point(spark):
    """The published example point of the zone 31 standard: 3 E on the equator is 500 km, 0 m."""
    df = spark.createDataFrame([(3.0, 0.0), (3.0, 45.0)], "lon double, lat double")
    epsg = geodesy.utm_epsg(F.col("lon"), F.col("lat"))
    e, n = geodesy.to_utm(F.col("lon"), F.col("lat"), epsg)
    got = df.select(epsg.alias("z"), e.alias("e"), n.alias("n")).collect()
    assert got[0]["z"] == 32631 and got[0]["e"] == pytest.approx(500000) and got[0]["n"] == pytest.approx(0, abs=1e-6)
    assert got[1]["n"] == pytest.approx(4982950.40, abs=0.02)   # 0.9996 times the meridian arc to 45 degrees


def test_rgb_rules(spark):
    good = bytes(3 * 4)
    rows = [("ok", good, 3, "uint8", ["red", "green", "blue"]), ("grey", bytes(4), 1, "uint8", ["gray"]),
            ("odd", good, 3, "uint8", None)]
    df = spark.createDataFrame(rows, "tile_path string, pixels binary, bands int, dtype string, colors array<string>").withColumns(
        {"height": F.lit(2), "width": F.lit(2)})
    got = {(r["tile_path"], r["severity"]) for r in pixels.validate_rgb(df).collect()}
    assert got == {("grey", "error"), ("odd", "error")}
    assert {r["severity"] for r in pixels.validate_rgb(df, strict=False).filter("tile_path = 'odd'").collect()} == {"warning"}


def test_repair_keeps_holes_of_split_polygons(spark):
    """A bow tie with a hole in each wing, and one hole outside."""
    bow = [0.0, 0.0, 10.0, 10.0, 10.0, 0.0, 0.0, 10.0]
    left, right = [1.0, 4.0, 2.0, 4.0, 2.0, 6.0, 1.0, 6.0], [8.0, 4.0, 9.0, 4.0, 9.0, 6.0, 8.0, 6.0]
    away = [50.0, 50.0, 51.0, 50.0, 51.0, 51.0]
    df = spark.createDataFrame([([bow, left, right, away],)], "rings array<array<double>>")
    parts = df.select(polygons.repair("rings").alias("p")).first()["p"]
    assert sorted(len(p) for p in parts) == [2, 2]
    for part in parts:
        wing = 0 if min(part[0][::2]) < 1 else 1
        assert part[1] == (left, right)[wing]


def masked(spark, rows):
    """Runs of boxes on whole numbers: (id, product, box, score)."""
    runs = [(i, p, y, int(b[0]), int(b[2])) for i, p, b, _ in rows for y in range(int(b[1]), int(b[3]))]
    return spark.createDataFrame(runs, "object_id bigint, product_id int, line int, c0 int, c1 int")


def whole(rows):
    return [(i, p, tuple(float(int(v)) for v in b), s) for i, p, b, s in rows]


def test_suppression_and_matching_by_masks(spark):
    """Masks that are boxes of whole pixels give what the boxes give; equal masks and empty ones are among them."""
    from crownframe.operators import matching, suppression
    from tests import brute
    rows = whole(brute.boxes(120, seed=71, sizes=(2, 9)))
    truths = whole(brute.boxes(80, seed=72, sizes=(2, 9)))
    df, t = brute.frame(spark, rows), brute.frame(spark, truths, "truth_id", "s")
    runs, t_runs = masked(spark, rows), masked(spark, truths).withColumnRenamed("object_id", "truth_id")
    got = {r["object_id"] for r in suppression.nms(df, 0.3, runs=runs).collect()}
    assert got == brute.nms(rows, 0.3)
    kept = suppression.nms_grid(df, [0.2, 0.6, 1.0], runs=runs).collect()
    for step in (0.2, 0.6, 1.0):
        assert {r["object_id"] for r in kept if r["nms_iou"] == step} == (brute.nms(rows, step) if step < 1 else {r[0] for r in rows})
    pairs = matching.greedy_match(df, t, [0.3], runs=(runs, t_runs)).collect()
    assert {(r["object_id"], r["truth_id"]) for r in pairs} == set(brute.match(rows, truths, 0.3).items())


def dense(rings, size=24):
    """Pixels whose middle has an odd number of edges on it or on its left."""
    mask = np.zeros((size, size), bool)
    for y in range(size):
        for x in range(size):
            odd = 0
            for r in rings:
                p = list(zip(r[0::2], r[1::2]))
                for (ax, ay), (bx, by) in zip(p, p[1:] + p[:1]):
                    if ay > by:
                        ax, ay, bx, by = bx, by, ax, ay
                    if ay < y + 0.5 < by:
                        odd += ax + (y + 0.5 - ay) * (bx - ax) / (by - ay) <= x + 0.5
            mask[y, x] = odd % 2
    return mask


def test_runs_and_outlines_of_many_shapes_at_once(spark):
    """Polygons to runs against a dense mask, and runs to outlines and back, holes and diagonal pixels included."""
    rng = np.random.default_rng(5)
    shapes = [[[float(v) for v in rng.integers(-2, 26, 2 * n)] for n in rng.integers(3, 8, rng.integers(1, 3))] for _ in range(60)] + [None, []]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], "id int, rings array<array<double>>")
    runs = df.select("id", polygons.polygon_to_runs("rings", F.lit(24), F.lit(24)).alias("runs"))
    got = {r["id"]: r["runs"] for r in runs.collect()}
    for i, s in enumerate(shapes):
        mask = np.zeros((24, 24), bool)
        for r in got[i]:
            assert not mask[r["line"], max(r["c0"] - 1, 0):r["c1"]][(r["c0"] > 0):].any()
            mask[r["line"], r["c0"]:r["c1"]] = True
        inside = [[min(max(v, -2), 26) for v in r] for r in s or []]
        assert (mask == dense(inside)).all()
    again = runs.select("id", "runs", polygons.runs_to_polygon("runs").alias("rings"))
    again = again.select("id", "runs", "rings", polygons.polygon_to_runs("rings", F.lit(24), F.lit(24)).alias("back"))
    for r in again.collect():
        assert r["back"] == r["runs"]
        areas = [abs(polygons._turned_area(ring)) for ring in r["rings"]]
        assert areas == sorted(areas, reverse=True)


def test_outlines_take_memory_by_their_runs(spark):
    far = spark.createDataFrame([(1, [(0, 0, 2), (10**6, 10**6, 10**6 + 3)])], "id int, runs array<struct<line:int,c0:int,c1:int>>")
    rings = far.select(polygons.runs_to_polygon("runs").alias("r")).first()["r"]
    assert [abs(polygons._turned_area(x)) for x in rings] == [3.0, 2.0]


def test_labels_of_masks_are_not_broadcast(spark):
    """Tables of masks and labels shuffle small, but are large in memory."""
    from crownframe.operators import tiling

    runs = run_rows(spark, random_masks(12, 12), "object_id")
    rasters = spark.createDataFrame([(0, 24, 24)], "product_id int, width int, height int")
    plain = tiling._numbered
    tiling._numbered = lambda tiles, labels, *rest: (tiles, labels)
    try:
        _, labels = tiling.labeled_tile_masks(runs, rasters, 16, 0.5)
    finally:
        tiling._numbered = plain
    assert "rightHint=(strategy=merge)" in plan_of(labels) and "rightHint=(strategy=broadcast)" in plan_of(labels)
