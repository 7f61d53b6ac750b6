"""AOI polygons cut into cells, against sweeps of the whole shapes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from crownframe.functions import rings as R
from crownframe.functions.polygons import even_odd_area, shared_area
from crownframe.operators import fragments
from crownframe.plans import raster_level


def star(rng, x, y, size, n=9):
    """A ring of n corners round a point."""
    out = []
    for k in range(n):
        r, at = size * rng.uniform(0.3, 1), 2 * math.pi * (k + rng.uniform(0, 0.8)) / n
        out += [x + r * math.cos(at), y + r * math.sin(at)]
    return out


def square(x0, y0, x1, y1):
    return [float(v) for v in (x0, y0, x1, y0, x1, y1, x0, y1)]


def aois():
    """A star with a hole, a shape of many corners, whole cells, a bow tie and one of no ground."""
    rng = random.Random(6)
    zigzag = [v for k in range(300) for v in (400 + k, 50 + 20 * (k % 2))] + [700.0, 120.0, 400.0, 120.0]
    return [(1, 1, [star(rng, 100, 100, 90, 30), star(rng, 100, 100, 20)]), (1, 2, [[float(v) for v in zigzag]]),
            (1, 3, [square(256, 256, 512, 512)]), (2, 4, [[0.0, 0.0, 64.0, 64.0, 64.0, 0.0, 0.0, 64.0]]),
            (2, 5, [[5.0, 5.0, 9.0, 5.0]]), (3, 6, None), (3, 7, [])]


AOI = "product_id int, aoi int, rings array<array<double>>"


@pytest.mark.parametrize("edges, depth", [(32, 3), (4, 1), (10**6, 0)])
def test_pieces_cover_the_shape_once(spark, monkeypatch, edges, depth):
    monkeypatch.setattr(fragments, "EDGES", edges)
    shapes = spark.createDataFrame(aois(), AOI)
    found = fragments.pieces(shapes, ["product_id", "aoi"], depth).collect()
    for _, ident, rings in aois():
        mine = [r for r in found if r.aoi == ident]
        boxed = [(r.rings, [square(r.x0, r.y0, r.x1, r.y1)]) for r in mine]
        area = sum(shared_area(part or box) for part, box in boxed)
        assert area == pytest.approx(shared_area(rings) if rings else 0)
        assert sum(shared_area(part or box, rings) for part, box in boxed) == pytest.approx(area)
        assert all(part is None or shared_area(part, box) == pytest.approx(shared_area(part)) for part, box in boxed)
        corners = sorted((r.x0, r.y0, r.x1) for r in mine)
        assert len(set(corners)) == len(corners)
    if depth == 3:
        assert any(r.rings is None for r in found)


def objects(rng, n=250):
    return [(rng.choice([1, 1, 1, 2, 3]), i, x, y, x + rng.uniform(1, 40), y + rng.uniform(1, 40))
            for i in range(n) for x, y in [(rng.uniform(-20, 720), rng.uniform(-20, 540))]] + [(1, -1, 300.0, 300.0, 300.0, 310.0)]


BOXES = "product_id int, object_id int, x0 double, y0 double, x1 double, y1 double"


@pytest.mark.parametrize("shaped", [False, True])
def test_filter_keeps_what_has_enough_inside(spark, shaped):
    rng = random.Random(8)
    rows = objects(rng)
    rings = {i: [star(rng, (x0 + x1) / 2, (y0 + y1) / 2, 15)] if shaped else [square(x0, y0, x1, y1)] for _, i, x0, y0, x1, y1 in rows}
    df = spark.createDataFrame(rows, BOXES)
    if shaped:
        table = spark.createDataFrame(list(rings.items()), "object_id int, rings array<array<double>>")
        df = df.drop("x0", "y0", "x1", "y1").join(table, "object_id").withColumns(R.envelope(F.col("rings")))
    got = fragments.aoi_polygon_filter(df, spark.createDataFrame(aois(), AOI), "object_id").collect()
    want = {}
    for key, i, *_ in rows:
        own = shared_area(rings[i])
        parts = {a: shared_area(rings[i], s) for k, a, s in aois() if k == key and s}
        if own > 0 and sum(parts.values()) / own >= 0.4:
            want |= {(i, a): v for a, v in parts.items() if v > 0}
    assert {(r.object_id, r.aoi): pytest.approx(r._area) for r in got} == want and len(got) == len(want) > 30
    for r in got:
        assert shared_area(rings[r.object_id], r.clip) == pytest.approx(r._area)
        box = [square(r.x0, r.y0, r.x1, r.y1)]
        assert shared_area(rings[r.object_id], r.clip, box) == pytest.approx(r._area)


def test_exactly_the_share_stays(spark):
    aoi = spark.createDataFrame([(1, 1, [[0.0, 0.0, 8.0, 0.0, 0.0, 8.0]])], AOI)
    rows = spark.createDataFrame([(1, 1, 0.0, 0.0, 4.0, 4.0), (1, 2, 4.0, 0.0, 8.0, 4.0), (1, 3, 4.0, 2.0, 8.0, 6.0)], BOXES)
    got = fragments.aoi_polygon_filter(rows, aoi, "object_id", min_frac=0.5).collect()
    assert {r.object_id: r._area for r in got} == {1: 16.0, 2: 8.0}


def test_tiles_of_a_package(spark):
    tiles = spark.createDataFrame([(1, c, r, 50.0 * c, 50.0 * r, 50.0 * c + 50, 50.0 * r + 50) for c in range(14) for r in range(11)],
                                  "product_id int, col int, row int, px0 double, py0 double, px1 double, py1 double")
    got = {(r.col, r.row, r.aoi) for r in fragments.aoi_package(tiles, spark.createDataFrame(aois(), AOI)).collect()}
    want = {(c, r, a) for c in range(14) for r in range(11) for k, a, s in aois()
            if k == 1 and shared_area(s, [square(50 * c, 50 * r, 50 * c + 50, 50 * r + 50)]) > 0}
    assert got == want


@pytest.mark.parametrize("kind", ["bbox", "segm"])
def test_raster_level_inside_polygons(spark, kind):
    """A polygon AOI that is a box gives the counts of the box; a triangle only those of what it holds."""
    rows = [(1, i, 10.0 * i, 10.0 * (i % 3), 10.0 * i + 8, 10.0 * (i % 3) + 8) for i in range(12)]
    p = spark.createDataFrame([(*r, 0.5 + r[1] / 100) for r in rows], BOXES + ", score double")
    t = spark.createDataFrame([(k, i, x0 + 1, y0, x1 + 1, y1) for k, i, x0, y0, x1, y1 in rows], BOXES.replace("object_id", "truth_id"))
    if kind == "segm":
        p, t = (df.withColumn("rings", R.box_ring(*map(F.col, ("x0", "y0", "x1", "y1")))) for df in (p, t))
    box = spark.createDataFrame([(1, 3.0, -5.0, 60.0, 40.0)], "product_id int, x0 double, y0 double, x1 double, y1 double")
    ring = box.select("product_id", F.lit(1).alias("aoi"), R.box_ring(*map(F.col, ("x0", "y0", "x1", "y1"))).alias("rings"))
    got = [sorted(map(str, raster_level.raster_counts(p, t, 1.0, aoi=a, iou_type=kind).collect())) for a in (box, ring)]
    assert got[0] == got[1]
    corner = spark.createDataFrame([(1, 1, [[0.0, 0.0, 40.0, 0.0, 0.0, 40.0]])], AOI)
    counts = raster_level.raster_counts(p, t, 1.0, aoi=corner, iou_type=kind).filter("size_label = 'all'").first()
    assert counts["tp"] + counts["fp"] == 3


def test_degrees_give_the_counts_of_metres(spark):
    """Boxes and an AOI in degrees near two zones and on the south, against their outlines in metres."""
    from crownframe.functions import geodesy

    rng = random.Random(4)
    places = {1: (2.0, 48.0), 2: (-60.0, -3.0)}
    rows = [(k, 100 * k + i, lon + x, lat + y, lon + x + rng.uniform(2e-5, 9e-5), lat + y + rng.uniform(2e-5, 9e-5))
            for k, (lon, lat) in places.items() for i in range(60) for x, y in [(rng.uniform(0, 1e-3), rng.uniform(0, 1e-3))]]
    p = spark.createDataFrame([(*r, rng.random()) for r in rows], BOXES + ", score double")
    t = spark.createDataFrame([(k, i, x0 + 1e-5, y0, x1 + 1e-5, y1) for k, i, x0, y0, x1, y1 in rows], BOXES.replace("object_id", "truth_id"))
    aoi = spark.createDataFrame([(k, lon, lat, lon + 6e-4, lat + 8e-4) for k, (lon, lat) in places.items()],
                                "product_id int, x0 double, y0 double, x1 double, y1 double")
    zones = {r.product_id: r.epsg for r in raster_level.utm_zones(t, p).collect()}
    assert zones == {1: 32631, 2: 32721}
    got = raster_level.raster_counts(p, t, 1.0, [0.4], aoi=aoi, geographic=True)
    box = R.box_ring(*map(F.col, ("x0", "y0", "x1", "y1")))
    epsg = F.when(F.col("product_id") == 1, 32631).otherwise(32721)
    flat = [df.withColumn("rings", geodesy.rings_to_utm(box, epsg)).drop("x0", "y0", "x1", "y1") for df in (p, t, aoi.withColumn("aoi", F.lit(1)))]
    want = raster_level.raster_counts(flat[0], flat[1], 1.0, [0.4], aoi=flat[2], iou_type="segm")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r.product_id for r in got.filter("size_label = 'all' and tp > 0").collect()} == {1, 2}
