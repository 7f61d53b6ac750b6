"""Bounded work: small keys are settled in one task without pairs or rounds, rows of a batch are measured together."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from crownframe import session
from crownframe.functions import boxes as B
from crownframe.functions import faces, geodesy, polygons, sweep
from crownframe.functions import rings as R
from crownframe.operators import dissolve, masks, matching, scoring, suppression
from crownframe.operators.box_pairs import overlapping
from crownframe.plans import grid_search, raster_level, stages
from crownframe.sources import geotables
from tests import brute


def forbidden(*_, **__):
    raise AssertionError("not for small keys")


def test_nms_of_small_keys_makes_no_pairs(spark, monkeypatch):
    rows = brute.boxes(250, seed=4)
    monkeypatch.setattr(suppression, "_edges", forbidden)
    got = suppression.nms(brute.frame(spark, rows), 0.4)
    assert {r[0] for r in got.select("object_id").collect()} == brute.nms(rows, 0.4)


def test_matching_of_small_keys_makes_no_pairs(spark, monkeypatch):
    preds, truths = (brute.boxes(n, seed=s) for n, s in ((200, 1), (60, 2)))
    p, t = brute.frame(spark, preds), brute.frame(spark, truths, "truth_id", "s")
    p, t = (df.withColumn("size_label", F.when(F.col("x1") - F.col("x0") > 3, "large").otherwise("small")) for df in (p, t))

    def run(**options):
        found = matching.greedy_match(p, t, [0.1, 0.3], size_col="size_label", **options)
        return sorted(map(tuple, found.select("product_id", "iou_threshold", "size_label", "object_id", "truth_id", "iou").collect()))

    rounds = run(tail_pairs=0)
    assert rounds and {r[2] for r in rounds} == {"all", "large", "small"}
    monkeypatch.setattr(matching, "candidate_pairs", forbidden)
    monkeypatch.setattr(matching, "match_rounds", forbidden)
    assert run() == rounds


def test_polygons_of_small_keys_make_no_pairs(spark, monkeypatch):
    def shapes(n, seed, name):
        rng = np.random.default_rng(seed)
        rows = [(int(i % 3), i, [(c + rng.normal(0, 1, 10)).round(2).tolist()], clip, float(rng.random()), "ab"[i % 2]) for i in range(n)
                for c in [np.tile(rng.integers(0, 8, 2), 5)] for clip in [None if i % 4 else [[0.0, 0.0, 5.0, 0.0, 5.0, 5.0, 0.0, 5.0]]]]
        df = spark.createDataFrame(rows, f"product_id int, {name} long, rings array<array<double>>, clip array<array<double>>, score double, size_label string")
        whole = F.array(F.array(*[F.lit(v) for v in (-99.0, -99.0, 99.0, -99.0, 99.0, 99.0, -99.0, 99.0)]))
        return df.withColumns(R.envelope(F.col("rings"))).withColumn("_own_area", polygons.polygon_inter_area("rings", F.coalesce("clip", whole)))

    p, t = shapes(150, 1, "object_id"), shapes(60, 2, "truth_id")

    def run(**options):
        found = matching.greedy_match(p, t, [0.1, 0.3], "score", size_col="size_label", shape_cols=("rings", "clip", "_own_area"), **options)
        return sorted((r[0], r[1], r[2], r[3], r[4], round(r[5], 9)) for r in found.select(
            "product_id", "iou_threshold", "size_label", "object_id", "truth_id", "iou").collect())

    rounds = run(tail_pairs=0)
    assert rounds and {r[2] for r in rounds} == {"all", "a", "b"}
    monkeypatch.setattr(matching, "candidate_pairs", forbidden)
    monkeypatch.setattr(matching, "SWEPT", 7)
    assert run() == rounds


def test_points_of_a_batch_move_together(spark):
    """Rings with a null point, an odd number, a single one or none, by arrays and by the expressions of a point."""
    rows = [(1, [[3.0, 48.0, 3.1, 48.1, 3.2]], 32631), (2, [[3.0], [], [3.0, None, 3.5, 48.5]], 32631), (3, None, 32631),
            (4, [[-60.0, -3.0]], 32720), (5, [[-60.0, -3.0], None], None), (6, [], 32631)]
    df = spark.createDataFrame(rows, "id int, rings array<array<double>>, epsg int").coalesce(1)
    got = {r.id: r.rings for r in df.select("id", geodesy.rings_to_utm(F.col("rings"), F.col("epsg")).alias("rings")).collect()}
    east, north = df.filter("id = 4").select(*geodesy.to_utm(F.lit(-60.0), F.lit(-3.0), F.col("epsg"))).first()
    assert np.allclose(got[4], [[east, north]], atol=1e-6) and len(got[1][0]) == 4
    assert got[2][:2] == [[3.0], []] and got[2][2][:2] == [None, None] and got[2][2][2] is not None
    assert got[3] is None and got[5] == [[None, None], None] and got[6] == []
    back = df.filter("id = 1").select(geodesy.rings_from_utm(geodesy.rings_to_utm(F.col("rings"), F.col("epsg")), F.col("epsg"))).first()[0]
    assert np.allclose(back, [[3.0, 48.0, 3.1, 48.1]], atol=1e-8)
    assert "sinh" not in df.select(geodesy.rings_to_utm(F.col("rings"), F.col("epsg")))._jdf.queryExecution().toString().lower()


def test_overlapping_boxes_of_odd_widths():
    rng = np.random.default_rng(3)
    low = rng.integers(0, 20, (80, 2))
    boxes = np.hstack([low, low + rng.integers(0, 6, (80, 2))]).astype(float)
    boxes[:3] = [[0, 0, 100, 100], [np.nan, 0, 1, 1], [0, 0, np.inf, 1]]
    met = [(i, j) for part in overlapping(boxes, boxes, 7) for i, j in zip(*map(np.ndarray.tolist, part))]
    plain = {(i, j) for i, a in enumerate(boxes) for j, b in enumerate(boxes) if np.isfinite([*a, *b]).all()
             and a[0] < b[2] and a[2] > b[0] and a[1] < b[3] and a[3] > b[1]}
    assert len(met) == len(set(met)) and set(met) == plain


def test_dissolve_of_small_keys_takes_no_rounds(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(int(i % 3), int(i), int(line), int(c), int(c + w)) for i in range(120)
            for line, c, w in [(rng.integers(-5, 25), rng.integers(-10, 40), rng.integers(1, 9))]]
    runs = spark.createDataFrame(rows, "product_id int, id long, line int, c0 int, c1 int")
    monkeypatch.setattr(dissolve, "BLOCK", 8)

    def run(**options):
        return sorted(map(tuple, dissolve.dissolve(runs, "id", **options).select("product_id", "component", "line", "c0", "c1").collect()))

    rounds = run(few_runs=0)
    monkeypatch.setattr(dissolve, "connected", forbidden)
    assert rounds and run() == rounds


def test_links_of_small_keys_take_no_rounds(spark, monkeypatch):
    rng = np.random.default_rng(7)
    nodes = spark.createDataFrame([(k, i) for k in range(3) for i in range(70)], "k int, id long")
    edges = spark.createDataFrame([(int(k), int(u), int(v)) for k, u, v in rng.integers(0, [3, 60, 60], (110, 3))], "k int, u long, v long")

    def run(**options):
        return sorted(map(tuple, dissolve.connected(nodes, edges, ["k"], **options).select("k", "id", "component").collect()))

    rounds = run(few_links=0)
    monkeypatch.setattr(dissolve, "_connected_rounds", forbidden)
    assert len(rounds) == 210 and run() == rounds


def test_a_face_of_a_cell_has_one_area():
    box = pa.array([[[x, y, x + 3.0, y, x + 3.0, y + 3.5, x, y + 3.5]] for x, y in ((1.0, 1.0), (2.0, 2.0), (3.0, 4.0), (8.0, 1.0))],
                   pa.list_(pa.list_(pa.float64())))
    s = sweep.segments(box, 0)
    found = faces.faces(sweep.Segments(np.zeros(len(s.row), np.int64), s.row, s.xy), np.zeros(4, int), np.array([[0.0, 0.0, 16.0, 16.0]]), True)
    assert sorted(zip(found.areas[2].tolist(), found.areas[3].tolist())) == [(0, 23.5), (3, 10.5)]
    assert sorted(map(tuple, found.pairs.tolist())) == [(1, 0), (2, 0)]


def test_a_raster_is_written_to_one_file(spark, tmp_path):
    objects = spark.range(400, numPartitions=4).selectExpr("id as object_id", "cast(id % 3 as int) as product_id")
    path = geotables.write_objects(objects, str(tmp_path), "final", 32618)
    assert {len(list(d.glob("*.parquet"))) for d in (tmp_path / "final").glob("product_id=*")} == {1}
    assert geotables.read_objects(spark, path).count() == 400


def test_repair_measures_all_rows_together(monkeypatch):
    bows = pa.array([[[0.0, 0.0, 4.0, k, 4.0, 0.0, 0.0, k]] for k in range(1, 41)], pa.list_(pa.list_(pa.float64())))
    calls = []
    plain = sweep.shared_areas
    monkeypatch.setattr(sweep, "shared_areas", lambda *a, **k: (calls.append(1), plain(*a, **k))[1])
    assert [len(parts) for parts in polygons.repair.func(bows).to_pylist()] == [2] * 40
    assert len(calls) < 5


def test_a_model_sees_few_prompts_at_a_time(spark):
    def load():
        def predict(pdf):
            ids = [[p["object_id"] for p in each] for each in pdf["prompts"]]
            return pd.DataFrame({"tile_path": pdf["tile_path"], "object_ids": ids, "masks": [[[] for _ in i] for i in ids],
                                 "scores": [[float(len(pdf))] * len(i) for i in ids]})
        return predict

    prompts = spark.range(300).selectExpr("concat('t', id % 40) as tile_path", "id as object_id", *[f"cast(id as double) as {c}" for c in B.BOX])
    out = scoring.score_prompts(prompts, prompts.select("tile_path").distinct(), load, batch=256).collect()
    assert sorted(i for r in out for i in r["object_ids"]) == list(range(300))
    assert max(s for r in out for s in r["scores"]) <= 4
    assert "MapInArrow" in scoring.score_prompts(prompts, prompts.select("tile_path").distinct(), load)._jdf.queryExecution().toString()


def run_table(df, ident):
    """Boxes as row runs on a grid of halves."""
    at = lambda c: F.floor(F.col(c) * 2).cast("int")
    solid = df.filter("x1 - x0 >= 0.5 and y1 - y0 >= 0.5")
    return solid.select("product_id", ident, F.explode(F.sequence(at("y0"), at("y1") - 1)).alias("line"), at("x0").alias("c0"), at("x1").alias("c1"))


def test_masks_of_small_keys_make_no_pairs(spark, monkeypatch):
    df = brute.frame(spark, brute.boxes(200, seed=8))
    df = df.unionByName(df.limit(20).withColumn("object_id", F.col("object_id") + 5000))      # copies
    runs = run_table(df, "object_id")

    def run(**options):
        return {r[0] for r in suppression.nms(df, 0.3, runs=runs, **options).select("object_id").collect()}

    rounds = run(tail_edges=0)
    assert 0 < len(rounds) < 220
    monkeypatch.setattr(suppression, "_kept_by_blocks", forbidden)
    assert run() == rounds


def test_search_of_small_rasters_makes_no_pairs(spark, monkeypatch):
    p = brute.frame(spark, brute.boxes(150, seed=51))
    t = brute.frame(spark, brute.boxes(70, seed=52), "truth_id", "unused")
    p = p.unionByName(p.limit(1).withColumns({"product_id": F.lit(77), "object_id": F.lit(9000).cast("long")}))       # no truths there
    runs = run_table(p, "object_id"), run_table(t, "truth_id")

    def run(by_masks, **options):
        out = grid_search.nms_grid_search(p, t, 0.7, (0.2, 0.6, 1.0), (0.1, 0.4, 0.8), (0.2, 0.5), runs=runs if by_masks else None, **options)
        return sorted(map(tuple, out.select("raster_name", "nms_iou", "nms_score", "num_truths", "num_preds", F.round("f1", 9)).collect()))

    rounds = [run(masks, tail_pairs=0) for masks in (False, True)]
    assert all(rounds) and rounds[0] != rounds[1] and "77" in {r[0] for r in rounds[0]}
    assert [run(masks, tail_pairs=60) for masks in (False, True)] == rounds         # some rasters are larger than that
    monkeypatch.setattr(grid_search, "_search_pairs", forbidden)
    assert [run(masks) for masks in (False, True)] == rounds


def test_prompts_of_small_tiles_make_no_pairs(spark, monkeypatch):
    p = brute.frame(spark, brute.boxes(200, seed=5)).withColumns({"tile_path": F.concat(F.lit("t"), "product_id"), "position": (F.col("object_id") * 7) % 11})
    t = brute.frame(spark, brute.boxes(80, seed=6), "truth_id", "s").withColumns({"tile_path": F.concat(F.lit("t"), "product_id"), "has_mask": F.col("truth_id") % 5 != 0})
    p = p.withColumn("position", F.when(F.col("object_id") % 13 != 0, F.col("position")))       # some have no place: they come last

    def run(**options):
        return sorted(map(tuple, matching.prompt_match(p, t, 0.1, **options).select("tile_path", "object_id", "truth_id", *B.BOX, "iou").collect()))

    rounds = run(tail_pairs=0)
    assert len(rounds) > 20
    assert run(tail_pairs=130) == rounds            # one tile is larger than that
    monkeypatch.setattr(matching, "candidate_pairs", forbidden)
    assert run() == rounds


def test_polygons_are_written_once(spark, monkeypatch):
    """With all of a raster in degrees, only what is read of the polygons is written, and only before they are matched."""
    rows = [(1, i, 0.9 - i / 10, [[-75.0 + i / 1e4, 45.0, -74.9999 + i / 1e4, 45.0, -74.9999 + i / 1e4, 45.0001, -75.0 + i / 1e4, 45.0001]]) for i in range(4)]
    p = spark.createDataFrame(rows, "product_id int, object_id long, detector_score double, rings array<array<double>>")
    t = p.select("product_id", F.col("object_id").alias("truth_id"), "rings")
    written = []

    def cut(df, label="stage"):
        written.append((label, set(df.columns)))
        return session.cut(df, label)

    for module in (raster_level, matching):
        monkeypatch.setattr(module, "cut", cut)
    got = raster_level.raster_counts(p, t, 1.0, [0.5], iou_type="segm", geographic=True).filter("size_label = 'all'").collect()
    assert [(r["tp"], r["fp"], r["fn"]) for r in got] == [(4, 0, 0)]
    assert [(n, c) for n, c in written if "rings" in c] == [
        ("predictions", {"product_id", "object_id", "detector_score", "rings", "_own_area"}), ("truths", {"product_id", "truth_id", "rings", "_own_area"})]
    assert not [n for n, c in written if "shape" in c]


def test_owners_by_intervals_equal_the_sweep(monkeypatch):
    rng = np.random.default_rng(3)
    n = 400
    c0 = rng.integers(-20, 60, n)
    columns = {"_key": ["k"] * n, "line": np.sort(rng.integers(0, 9, n)).astype(np.int32), "id": rng.integers(0, 50, n), "score": rng.integers(0, 4, n) / 4,
               "c0": c0.astype(np.int32), "c1": (c0 + rng.integers(1, 30, n)).astype(np.int32)}
    columns["score"] = [None if k % 17 == 0 else v for k, v in enumerate(columns["score"])]
    b = pa.table(columns).to_batches()

    def run(most):
        return [r for x in masks._owned(iter(b), most) for r in x.to_pylist()]

    got = run(10 ** 6)
    monkeypatch.setattr(masks, "CELLS", 0)
    assert got == run(-1) and len(got) > 50


def test_masks_of_a_stage_stay_packed(spark, monkeypatch):
    """Masks are not taken apart into rows for the suppression, and come back as they were, empty ones too."""
    rows = [(0, k, float(x), 0.0, float(x + 4), 4.0, 0.9 - k / 10, [(y, x, x + 4) for y in range(4)] if k < 4 else []) for k, x in enumerate((0, 1, 10, 2, 30))]
    df = spark.createDataFrame(rows, "product_id int, object_id long, x0 double, y0 double, x1 double, y1 double, segmenter_score double, runs array<struct<line:int,c0:int,c1:int>>")
    monkeypatch.setattr(stages, "explode_runs", forbidden)
    out = stages.run_stages([stages.aggregator_stage(0.1, 0.5, {"segmenter_score": 1.0})], stages.State(objects=df, product_name="x")).objects
    got = {r["object_id"]: [tuple(x) for x in r["runs"]] for r in out.collect()}
    assert got == {r[1]: r[-1] for r in rows if r[1] != 1}
