"""Merging rules, metric tables, staged runs, numbering and files."""

import json
import sqlite3
import struct

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownframe.operators import augment, filters, merging, metrics, numbering, scoring, tiling
from crownframe.plans import stages
from crownframe.sources import coco, files, geotables
from workload import models

BOX = "x0 double, y0 double, x1 double, y1 double"


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


# --- numbering: one key with nearly all rows --------------------------------------------------

def test_row_index_on_a_hot_key(spark):
    df = spark.range(3000).select(F.col("id").alias("v"), F.when(F.col("id") % 50 == 0, F.col("id"))
                                  .otherwise(-1).alias("k")).repartition(7)
    got = numbering.row_index(df, ["k"], [F.col("v").desc()], "n")
    hot = [r for r in got.filter("k = -1").orderBy("n").collect()]
    assert [r["n"] for r in hot] == list(range(len(hot)))
    assert [r["v"] for r in hot] == sorted((r["v"] for r in hot), reverse=True)
    assert got.filter("k <> -1 and n <> 0").count() == 0


def test_running_totals(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"), "id").repartition(5)
    got = numbering.running_totals(df, ["k"], [F.col("id")], {"s": F.col("id")})
    assert got.filter("s <> (case when k = 0 then (id / 2) * (id / 2 + 1) else (id + 1) * (id + 1) / 4 end)").count() == 0


def test_reassign_duplicates_keeps_the_first(spark):
    df = spark.createDataFrame([(5, 1), (5, 2), (7, 3), (5, 4)], "object_id bigint, pos int")
    got = rows(numbering.reassign_duplicates(df, [F.col("pos")]), "pos", "object_id")
    assert got == [(1, 5), (2, 8), (3, 7), (4, 9)]


# --- merge rules ---------------------------------------------------------------------------------

@pytest.fixture
def existing(spark):
    return spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0, 0.9), (2, 2.0, 2.0, 3.0, 3.0, 0.8)],
                                 f"object_id bigint, {BOX}, detector_score double")


def test_new_objects_replace(spark, existing):
    new = spark.createDataFrame([(0.0, 0.0, 5.0, 5.0)], BOX)
    assert rows(merging.merge_results(existing, new), "object_id", "x1") == [(0, 5.0)]


def test_empty_result_replaces_with_a_warning(existing):
    with pytest.warns(UserWarning):
        assert merging.merge_results(existing, existing.limit(0), False).count() == 0


def test_geometry_result_takes_missing_columns(spark, existing):
    new = spark.createDataFrame([(1, 0.0, 0.0, 9.0, 9.0, 0.7)], f"object_id bigint, {BOX}, segmenter_score double")
    got = merging.merge_results(existing, new, objects_are_new=False)
    assert rows(got, "object_id", "x1", "segmenter_score", "detector_score") == [(1, 9.0, 0.7, 0.9)]


def test_attributes_join_by_id(spark, existing):
    new = spark.createDataFrame([(1, 3)], "object_id bigint, classifier_class int")
    got = merging.merge_results(existing, new, objects_are_new=False)
    assert rows(got.fillna(-1), "object_id", "x1", "classifier_class") == [(1, 1.0, 3), (2, 3.0, -1)]


def test_geometry_without_key_replaces_and_attributes_without_key_fail(spark, existing):
    new = spark.createDataFrame([(0.0, 0.0, 5.0, 5.0)], BOX)
    assert merging.merge_results(existing, new, objects_are_new=False).count() == 1
    with pytest.raises(merging.MergeError):
        merging.merge_results(existing, spark.createDataFrame([(1,)], "other int"), objects_are_new=False)


def test_repeated_tile_path_is_an_error(spark):
    a = spark.createDataFrame([("t", 1)], "tile_path string, n int")
    b = spark.createDataFrame([("t", 0.0), ("t", 1.0)], "tile_path string, x0 double")
    with pytest.raises(merging.MergeError):
        merging.geometry_merge(b, a, "tile_path")


def test_a_merge_works_its_result_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    result = spark.range(40).select((F.col("id") % 10).alias("object_id"), "id", counted(F.col("id").cast("double")).alias("x0"))
    a = spark.createDataFrame([(1, 0.5), (3, 0.7)], "object_id bigint, detector_score double")
    got = merging.geometry_merge(result, a, order=[F.col("id").desc()])
    assert {r.id: (r.object_id, r.detector_score) for r in got.collect()} == {
        i: (i % 10 if i >= 30 else 39 - i, {1: 0.5, 3: 0.7}.get(i % 10)) for i in range(40)}
    assert seen.value == 40


def test_an_aggregation_works_its_objects_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    objects = spark.range(30).select(F.lit(1).alias("product_id"), F.col("id").alias("object_id"), *[
        (F.col("id") * 5 + d).cast("double").alias(c) for c, d in zip(("x0", "y0", "x1", "y1"), (0, 0, 4, 4))],
        counted(F.col("id") / 30).alias("segmenter_score"))
    out = stages.aggregator_stage(0.0, 0.5, {"segmenter_score": 1.0}).run(stages.State(objects=objects)).objects
    assert out.count() == 30 and seen.value == 30


# --- metric tables -------------------------------------------------------------------------------

RUN = "location string, product_name string, f1 double, f1_per_iou array<double>, num_truths int, tp int"


def test_mean_and_std_over_runs(spark):
    runs = [spark.createDataFrame([("a", "p", v, [v, 1.0], 10, 3)], RUN) for v in (0.2, 0.4, 0.6)]
    got = metrics.mean_std_over_runs(runs).collect()[0]
    assert got["f1_mean"] == pytest.approx(0.4) and got["f1_std"] == pytest.approx(0.1632993)
    assert got["f1_per_iou_mean"] == pytest.approx([0.4, 1.0]) and got["num_truths"] == 10
    assert "tp_mean" not in got.asDict()


def test_runs_must_have_the_same_rows(spark):
    a = spark.createDataFrame([("a", "p", 0.1, [0.1], 1, 1)], RUN)
    b = spark.createDataFrame([("a", "q", 0.1, [0.1], 1, 1)], RUN)
    with pytest.raises(ValueError):
        metrics.mean_std_over_runs([a, b])
    with pytest.raises(ValueError):
        metrics.mean_std_over_runs([a.drop("location"), b])
    with pytest.raises(ValueError):
        metrics.mean_std_over_runs([])


def test_join_summaries_keeps_rows_without_raster_metrics(spark):
    t = spark.createDataFrame([("a", "p", 0.5, 3), ("b", "q", 0.6, 4)], "location string, product_name string, AP double, num_images int")
    r = spark.createDataFrame([("a", "p", 0.7, 3)], "location string, product_name string, f1 double, num_images int")
    got = metrics.join_summaries(t, r, "tile", "raster")
    assert got.columns == ["location", "product_name", "tile_AP", "num_images", "raster_f1"]
    assert got.filter("raster_f1 is null").count() == 1
    with pytest.raises(ValueError):
        metrics.join_summaries(t.drop("location"), r)


def test_average_rows_and_best_pair(spark):
    df = spark.createDataFrame(
        [("a", 0.5, 0.1, 1.0, 1.0, 1.0, 1, 1, 1), ("b", 0.5, 0.1, 0.0, 0.0, 0.0, 3, 1, 1), ("a", 0.7, 0.1, 0.5, 0.5, 0.5, 1, 1, 1)],
        "raster_name string, nms_iou double, nms_score double, precision double, recall double, f1 double, "
        "num_truths bigint, num_preds bigint, num_images bigint")
    out = metrics.avg_by_params(df)
    assert rows(out.filter("raster_name = 'average_over_rasters'"), "nms_iou", "f1", "num_truths") == [(0.5, 0.25, 4), (0.7, 0.5, 1)]
    assert metrics.best_params(out).collect()[0]["nms_iou"] == 0.7
    assert metrics.best_params(df).collect()[0]["nms_iou"] == 0.5


# --- stages --------------------------------------------------------------------------------------

def test_check_lists_every_problem_before_running():
    plan = [stages.aggregator_stage(weights={"detector_score": 1.0, "segmenter_score": 1.0})]
    found = stages.check(plan, stages.State())
    assert any("'objects'" in p for p in found) and any("'segmenter_score'" in p for p in found)
    with pytest.raises(stages.StageError):
        stages.run_stages(plan, stages.State())


def test_order_of_stages_matters():
    detector = stages.detector_stage(models.load_detector)
    tiling_first = [stages.tiling_stage(), detector]
    state = stages.State(rasters=object())
    assert stages.check(tiling_first, state) == []
    assert stages.check(tiling_first[::-1], state) != []


def test_weight_zero_needs_no_column():
    stage = stages.aggregator_stage(weights=filters.weights_from(listed={"detector_score": 1.0}))
    assert "segmenter_score" not in stage.needs_columns and "detector_score" in stage.needs_columns


def test_detector_prompted_segmenter_and_classifier(spark, tmp_path):
    tiles = spark.createDataFrame([("t0", [1, 40]), ("t1", [5])], "tile_path string, seen array<bigint>")
    plan = [stages.tiling_stage(), stages.detector_stage(models.load_detector),
            stages.segmenter_stage(models.load_segmenter, batch=2),
            stages.aggregator_stage(0.0, 0.9, {"segmenter_score": 1.0}, keys=("tile_path",))]
    out = stages.run_stages(plan, stages.State(tiles=tiles)).objects
    assert out.count() == 6 and {"detector_score", "segmenter_score", "aggregator_score", "mask"} <= set(out.columns)


def test_plain_tiles_take_no_objects(spark, existing):
    rasters = spark.createDataFrame([(0, 300, 300)], "product_id int, width int, height int")
    with pytest.raises(stages.StageError):
        stages.run_stage(stages.tiling_stage("tile", 100), stages.State(rasters=rasters, objects=existing))


# --- tiling and augmentation -------------------------------------------------------------------

def test_synthetic_raster_with_four_boxes(spark):
    """256 pixels, tile 128, overlap 0.25: step 96, three tiles per side, the last at the edge."""
    rasters = spark.createDataFrame([(0, 256, 256)], "product_id int, width int, height int")
    grid = tiling.tile_grid(rasters, 128, 0.25)
    assert sorted({r["px0"] for r in grid.collect()}) == [0.0, 96.0, 128.0]
    boxes = [(10, 30), (50, 80), (100, 140), (180, 220)]
    objects = spark.createDataFrame([(0, i, *map(float, (a, a, b, b))) for i, (a, b) in enumerate(boxes)],
                                    f"product_id int, object_id bigint, {BOX}")
    tiles, labels = tiling.labeled_tiles(objects, grid)
    assert {r["object_id"] for r in labels.collect()} == {0, 1, 2, 3}
    assert sorted(r["tile_id"] for r in tiles.collect()) == list(range(1, tiles.count() + 1))


def test_tile_options_are_checked():
    with pytest.raises(ValueError):
        tiling.grid_step(100, 1.0)
    with pytest.raises(ValueError):
        tiling.resample_window(None, 1.0)
    with pytest.raises(ValueError):
        tiling.aoi_split(None, "other")


def test_square_crop_stays_inside_and_discards(spark):
    tiles = spark.createDataFrame([(f"t{i}", 100, 80) for i in range(40)], "tile_path string, width int, height int")
    boxes = tiles.select("tile_path", F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(100.0).alias("x1"), F.lit(80.0).alias("y1"))
    windows, kept = augment.random_square_crop(boxes, tiles, 20, 500, min_ratio=0.3, seed=1)
    for r in windows.collect():
        assert 20 <= r["crop_w"] == r["crop_h"] <= 80
        assert r["crop_x"] >= 0 and r["crop_x"] + r["crop_w"] <= 100 and r["crop_y"] + r["crop_h"] <= 80
    big = {r["tile_path"] for r in windows.collect() if r["crop_w"] ** 2 >= 0.3 * 8000}
    assert {r["tile_path"] for r in kept.collect()} == big


def test_jitter_is_close_to_the_asked_spread(spark):
    df = spark.range(4000).select(F.col("id").alias("object_id"), F.lit(100.0).alias("x0"), F.lit(100.0).alias("y0"),
                                  F.lit(200.0).alias("x1"), F.lit(200.0).alias("y1"))
    out = augment.jitter_boxes(df, 0.1, F.lit(1000.0), F.lit(1000.0), seed=1)
    mean, std = out.select(F.avg("x0"), F.stddev("x0")).first()
    assert abs(mean - 100) < 1 and abs(std - 10) < 0.6


# --- files ---------------------------------------------------------------------------------------

DOC = {"images": [{"id": 1, "file_name": "a.tif", "width": 4, "height": 4}],
       "annotations": [
           {"id": 1, "image_id": 1, "category_id": 1, "bbox": [0, 0, 2, 2], "segmentation": [[0, 0, 2, 0, 2, 2]], "area": 4},
           {"id": 2, "image_id": 1, "category_id": 1, "bbox": [0, 0, 2, 2], "segmentation": [0, 0, 2, 0, 2, 2], "area": "x"},
           {"id": 3, "image_id": 1, "category_id": 1, "bbox": [0, 0, 2, 2], "segmentation": {"counts": [0, 4, 12], "size": [4, 4]}},
           {"id": 4, "image_id": 1, "category_id": 1, "bbox": [0, 0, 2, 2], "segmentation": {"counts": "04<", "size": [4, 4]}},
           {"id": 5, "image_id": 1, "category_id": 1, "bbox": [0, 0, 2, 2], "segmentation": []}],
       "categories": [{"id": 1, "name": "tree", "supercategory": None}]}


def test_read_coco_understands_all_encodings(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps(DOC, indent=1))
    got = {r["id"]: r for r in coco.read_coco(spark, str(tmp_path)).annotations.collect()}
    assert got[1]["rings"] == got[2]["rings"] == [[0, 0, 2, 0, 2, 2]]
    assert got[3]["counts"] == [0, 4, 12] and got[3]["size"] == [4, 4]
    assert got[4]["counts_text"] == "04<" and got[5]["rings"] == []


def test_written_documents_are_json(spark, tmp_path):
    images = spark.createDataFrame([("s1", 1, "a.tif"), ("s2", 1, "b.tif")], "source_id string, id bigint, file_name string")
    annotations = spark.createDataFrame([("s1", 1, 1, 1), ("s1", 2, 1, 1), ("s2", 1, 1, 1)],
                                        "source_id string, id bigint, image_id bigint, category_id int")
    cats = spark.createDataFrame([("s1", 1, "tree", "x"), ("s2", 1, "tree", "x")], "source_id string, id int, name string, supercategory string")
    path = str(tmp_path / "out")
    coco.write_coco(coco.Coco(images, annotations, cats), path, by_source=True)
    for source, n in (("s1", 2), ("s2", 1)):
        parts = sorted((tmp_path / "out" / f"source_id={source}").glob("*.txt"))
        doc = json.loads("".join(p.read_text() for p in parts))
        assert len(doc["annotations"]) == n and len(doc["images"]) == 1
    back = coco.read_coco_parts(spark, path)
    assert rows(back.annotations, "source_id", "id") == [("s1", 1), ("s1", 2), ("s2", 1)]


def test_union_of_documents_rejects_dangling_images(spark):
    images = spark.createDataFrame([("a", 1)], "source_id string, id bigint")
    annotations = spark.createDataFrame([("a", 1, 9, 1)], "source_id string, id bigint, image_id bigint, category_id int")
    with pytest.raises(ValueError):
        coco.coco_union(images, annotations, images)


def test_geopackage(spark, tmp_path):
    def ring(points):
        return struct.pack("<I", len(points)) + b"".join(struct.pack("<2d", *p) for p in points)

    square = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    polygon = b"\x01" + struct.pack("<II", 3, 1) + ring(square)
    multi = b"\x01" + struct.pack("<II", 6, 2) + polygon + polygon
    head = b"GP\x00" + bytes([1 | (1 << 1)]) + struct.pack("<i", 32618) + struct.pack("<4d", 0, 4, 0, 4)
    con = sqlite3.connect(tmp_path / "a.gpkg")
    con.execute("create table gpkg_geometry_columns (table_name text, column_name text)")
    con.execute("insert into gpkg_geometry_columns values ('trees', 'geom')")
    con.execute("create table trees (fid integer, geom blob, species text)")
    con.executemany("insert into trees values (?, ?, ?)", [(1, head + polygon, "oak"), (2, head + multi, None)])
    con.commit()
    con.close()
    got = geotables.import_geopackage(spark, str(tmp_path)).orderBy("position").collect()
    assert [r["kind"] for r in got] == ["polygon", "multipolygon"] and got[0]["crs_epsg"] == 32618
    assert got[0]["parts"] == [[[0, 0, 4, 0, 4, 4, 0, 4]]] and len(got[1]["parts"]) == 2
    assert got[0]["attributes"]["species"] == "oak"


def test_tile_listing(spark, tmp_path):
    (tmp_path / "b.tif").write_bytes(b"1")
    (tmp_path / "a.tiff").write_bytes(b"12")
    (tmp_path / "c.txt").write_bytes(b"1")
    assert [r["file_name"] for r in files.list_tiles(spark, str(tmp_path)).collect()] == ["a.tiff", "b.tif"]
    with pytest.warns(UserWarning):
        files.list_tiles(spark, str(tmp_path), ["jpg"])


def test_empty_objects_are_not_written(spark, existing, tmp_path):
    with pytest.warns(UserWarning):
        assert geotables.write_objects(existing.limit(0), str(tmp_path), "final") is None
    with pytest.raises(ValueError):
        geotables.write_objects(existing, str(tmp_path), "other")


def test_coco_parts_with_nulls_and_extra_attributes(spark, tmp_path):
    """Sections are told apart by keys: a category without supercategory, an image without a name, an
    annotation with an attribute called file_name."""
    images = spark.createDataFrame([(1, "a.tif"), (2, None)], "id bigint, file_name string")
    annotations = spark.createDataFrame(
        [(5, 1, 7, [0.0, 0.0, 1.0, 1.0], 1.0, 0, "x")],
        "id bigint, image_id bigint, category_id int, bbox array<double>, area double, iscrowd int, file_name string")
    categories = spark.createDataFrame([(7, "oak", None), (8, None, "tree")], "id int, name string, supercategory string")
    path = str(tmp_path / "doc")
    coco.write_coco(coco.Coco(images, annotations, categories), path)
    back = coco.read_coco_parts(spark, path)
    assert sorted(r["id"] for r in back.images.collect()) == [1, 2]
    assert [r["id"] for r in back.annotations.collect()] == [5]
    assert sorted(r["id"] for r in back.categories.collect()) == [7, 8]


def test_category_is_removed_by_each_document_s_own_id(spark):
    cats = spark.createDataFrame([("p", 1, "oak"), ("p", 2, "elm"), ("q", 1, "elm"), ("q", 2, "oak"), ("r", 1, "fir")],
                                 "source_id string, id int, name string")
    ann = spark.createDataFrame([("p", 10, 1, 1), ("p", 11, 1, 2), ("q", 12, 1, 1), ("q", 13, 1, 2), ("r", 14, 1, 1)],
                                "source_id string, id int, image_id int, category_id int")
    images = ann.select("source_id", F.col("image_id").alias("id")).distinct()
    _, rest, left = filters.remove_category(images, ann, cats, "oak", source=["source_id"])
    assert {(r["id"], r["category_id"]) for r in rest.collect()} == {(11, 1), (12, 1), (14, 1)}
    assert {(r["source_id"], r["id"], r["name"]) for r in left.collect()} == {("p", 1, "elm"), ("q", 1, "elm"), ("r", 1, "fir")}


@pytest.mark.parametrize("values", [[3.0], [1.0, 4.0], [5.0, 1.0, 2.0], [1.0, 1.0, 9.0, 2.0, None]])
def test_median_by_rank(spark, values):
    from crownframe.operators import metrics
    df = spark.createDataFrame([(v, "k") for v in values], "iou double, k string")
    real = sorted(v for v in values if v is not None)
    want = (real[(len(real) - 1) // 2] + real[len(real) // 2]) / 2
    for keys in ([], ["k"]):
        got = metrics.iou_stats(df, keys=keys).collect()
        assert [(r["median_iou"], r["num_masks"]) for r in got] == [(want, len(real))]


def test_stages_count_in_their_own_writes_and_leave_documents(spark, tmp_path):
    tiles = spark.createDataFrame([(f"t{i}", [8 * i + k for k in range(3)]) for i in range(4)], "tile_path string, seen array<long>")
    half = stages.Stage("classifier", lambda state: stages.Result(
        objects=state.objects.filter("object_id % 2 = 0").select("object_id", F.when(F.col("object_id") % 4 == 0, 7).alias("classifier_class"),
                                                                 F.lit(0.5).alias("classifier_score")),
        objects_are_new=False, coco=("classifier_score", "classifier_class"), counts={"unclassified": F.count_if(F.col("classifier_class").isNull())}))
    plan = [stages.detector_stage(models.load_detector), half, stages.aggregator_stage(0.2, 0.3, {"detector_score": 1.0}, keys=("tile_path",))]
    done = stages.run_stages(plan, stages.State(tiles=tiles), output=str(tmp_path / "out"), documents=True)
    n = done.outputs["0_detector"].count()
    assert done.counts["0_detector"] == {"objects": n} and n == 24
    assert done.counts["1_classifier"] == {"objects": n, "unclassified": n - 6, "unmatched": n - 12, "dropped": 0} or \
        done.counts["1_classifier"]["unclassified"] == n - 6
    left = done.objects.count()
    assert done.counts["2_aggregator"]["objects"] == left and done.counts["2_aggregator"]["dropped"] == n - left > 0
    assert sorted(done.documents) == ["0_detector", "1_classifier", "2_aggregator"]
    for name, path in done.documents.items():
        tables = coco.read_coco_parts(spark, path)
        assert tables.annotations.count() == done.outputs[name].count()
        assert tables.images.count() == done.outputs[name].select("tile_path").distinct().count()
    kept = coco.read_coco_parts(spark, done.documents["2_aggregator"]).annotations
    assert kept.agg(F.round(F.sum("score"), 6)).first()[0] == done.objects.agg(F.round(F.sum("aggregator_score"), 6)).first()[0]


def test_models_are_given_bounded_frames(spark):
    """Tiles and prompts of one Arrow batch go to the model some at a time."""
    def load():
        def predict(pdf):
            n = len(pdf)
            most = sum(map(len, pdf["prompts"])) if "prompts" in pdf else n
            return pd.DataFrame({"tile_path": pdf["tile_path"], "object_ids": [[i["object_id"] for i in p] for p in pdf["prompts"]],
                                 "masks": [[[] for _ in p] for p in pdf["prompts"]], "scores": [[float(most)] * len(p) for p in pdf["prompts"]]})
        return predict

    prompts = spark.range(5000).select((F.col("id") % 1000).cast("string").alias("tile_path"), F.col("id").alias("object_id"), *[
        F.lit(1.0).alias(c) for c in ("x0", "y0", "x1", "y1")])
    tiles = prompts.select("tile_path").distinct().coalesce(1)
    got = scoring.score_prompts(prompts, tiles, load, batch=64).select(F.explode("scores").alias("most"), "tile_path").agg(
        F.max("most"), F.count("most")).first()
    assert got[0] <= scoring.PROMPTS / 64 * 5 and got[1] == 5000


def test_numbering_broadcasts_blocks_not_rows(spark):
    numbered = numbering.row_index(spark.range(50), [], [F.col("id")], "n")
    assert "rightHint=(strategy=broadcast)" in numbered._jdf.queryExecution().optimizedPlan().toString()
    assert [r["n"] for r in numbered.orderBy("id").collect()] == list(range(50))


def test_rows_and_their_groups_are_numbered_in_one_sort(spark):
    rows = [(i // 40, i % 2, i) for i in range(200)] + [(9, 1, 5000), (7, 0, 5001)]
    df = spark.createDataFrame(rows, "a int, b int, id int").repartition(5)
    got = numbering.dense_index(df, ["a", "b"], [F.col("id")], "n", "g").collect()
    order = sorted(rows)
    groups = {k: i for i, k in enumerate(sorted({r[:2] for r in rows}), 1)}
    assert sorted((r["a"], r["b"], r["id"], r["n"], r["g"]) for r in got) == [(*r, i, groups[r[:2]]) for i, r in enumerate(order, 1)]
    one = spark.createDataFrame([(1, 1, i) for i in range(500)], df.schema).repartition(7)       # one group over all blocks
    got = numbering.dense_index(one, ["a", "b"], [F.col("id")], "n", "g", start=0).collect()
    assert sorted((r["id"], r["n"], r["g"]) for r in got) == [(i, i, 0) for i in range(500)]


def test_labels_are_numbered_without_a_join_to_their_tiles(spark, monkeypatch):
    """Mask labels are shuffled packed: once by mask and once in order, with their numbers from one sort."""
    runs = spark.createDataFrame([(0, k, y, 10 * k, 10 * k + 9) for k in range(6) for y in range(4 * k, 4 * k + 9)],
                                 "product_id int, object_id long, line int, c0 int, c1 int")
    rasters = spark.createDataFrame([(0, 60, 50)], "product_id int, width int, height int")
    monkeypatch.setattr(tiling, "row_index", None)
    tiles, labels = tiling.labeled_tile_masks(runs, rasters, 16, 0.5)
    got = labels.orderBy("label_id").collect()
    assert [r["label_id"] for r in got] == list(range(1, len(got) + 1)) and len(got) > 10
    assert [(r["row"], r["col"], r["object_id"]) for r in got] == sorted((r["row"], r["col"], r["object_id"]) for r in got)
    names = {(r["row"], r["col"]): r["tile_id"] for r in tiles.collect()}
    assert sorted(names.values()) == list(range(1, len(names) + 1)) and all(names[r["row"], r["col"]] == r["tile_id"] for r in got)
    assert all(r["area"] == sum(c1 - c0 for _, c0, c1 in r["runs"]) and r["y1"] - r["y0"] == len(r["runs"]) for r in got)
