"""Benchmark of predictions over datasets: tile-level and raster-level tables with their averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownframe.operators import coco_eval, metrics
from crownframe.plans.raster_level import KEY, raster_level
from crownframe.sources.metric_files import write_metrics


def tile_table(detections: DataFrame, truths: DataFrame, products: DataFrame,
               max_dets: Sequence[int], gsd: float) -> DataFrame:
    """COCO metrics per raster and per dataset over all its rasters together.

    `products` has `dataset, location, product_name, product_id`. Every image is matched once and
    counted twice, under its raster and under its dataset.
    """
    unit = products.select(KEY, F.explode(F.array(
        F.struct(F.col("location").alias("location"), F.col("product_name").alias("product_name")),
        F.struct(F.col("dataset").alias("location"),
                 F.lit(metrics.AVERAGE_ROW).alias("product_name")))).alias("_u"))
    unit = unit.select(KEY, "_u.location", "_u.product_name")
    return coco_eval.tile_level(detections, truths, max_dets, gsd,
                                group=["location", "product_name"], units=unit, unit_key=KEY)


def raster_table(predictions: DataFrame, truths: DataFrame, products: DataFrame, gsd: float,
                 thresholds: Sequence[float], aoi: DataFrame | None = None) -> DataFrame:
    """Raster metrics per product and their truth-weighted mean per dataset."""
    per = raster_level(predictions, truths, gsd, thresholds=thresholds, aoi=aoi).withColumn(
        "iou_thresholds", metrics.threshold_label(F.col("iou_thresholds")))
    named = per.join(products, KEY).drop(KEY)
    mean = metrics.weighted_dataset_avg(
        named.drop("location", "product_name", "iou_thresholds"), ["dataset"])
    label = ",".join(f"{t:.2f}" for t in sorted({float(t) for t in thresholds}))
    mean = mean.withColumns({
        "location": F.col("dataset"), "product_name": F.lit(metrics.AVERAGE_ROW),
        "iou_thresholds": F.lit(label)})
    return named.unionByName(mean, allowMissingColumns=True).drop("dataset")


def _by_settings(products: DataFrame, gsd: float, max_dets: Sequence[int]) -> list[tuple]:
    """(products, gsd, max_dets) for each pair of settings in use. `products` may have columns `gsd` and
    `max_dets` (an array), which belong to the dataset; a missing column or null means the given default."""
    named = products.withColumns({
        "_g": F.coalesce("gsd", F.lit(float(gsd))) if "gsd" in products.columns else F.lit(float(gsd)),
        "_m": F.coalesce("max_dets", F.array(*map(F.lit, max_dets))) if "max_dets" in products.columns
        else F.array(*map(F.lit, max_dets))})
    settings = named.select("_g", "_m").distinct().collect()           # a few, chosen by hand per dataset
    plain = products.drop("gsd", "max_dets").columns
    return [(named.filter((F.col("_g") == g) & (F.col("_m") == F.array(*map(F.lit, m)))).select(*plain), g, list(m))
            for g, m in sorted((r["_g"], tuple(r["_m"])) for r in settings)]


def _stacked(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def benchmark(detections: DataFrame, aggregated: DataFrame, tile_truths: DataFrame,
              raster_truths: DataFrame, products: DataFrame, gsd: float,
              max_dets: Sequence[int] = (1, 10, 100, 400),
              thresholds: Sequence[float] = coco_eval.IOU_THRESHOLDS,
              aoi: DataFrame | None = None, output: str | None = None) -> tuple:
    """(tile table, raster table); with `output` also as two CSV folders.

    `detections` are scored per tile, `aggregated` are the merged objects of a raster. Ground resolution
    and detection limits may differ by dataset (`gsd` and `max_dets` on `products`). Rasters
    without truth, or with an `aoi` table without AOI, are absent from the raster table.
    """
    measured = raster_truths.select(KEY).distinct()
    if aoi is not None:
        measured = measured.join(aoi.select(KEY).distinct(), KEY, "left_semi")
    tiles, rasters = [], []
    for some, size, limits in _by_settings(products, gsd, max_dets):
        ours = some.select(KEY).distinct()
        tiles.append(tile_table(*(df.join(ours, KEY, "left_semi") for df in (detections, tile_truths)), some, limits, size))
        there = ours.join(measured, KEY, "left_semi")
        rasters.append(raster_table(*(df.join(there, KEY, "left_semi") for df in (aggregated, raster_truths)),
                                    some, size, thresholds, aoi))
    tile, raster = _stacked(tiles), _stacked(rasters)
    if output:
        write_metrics(tile, f"{output}/tile_level_metrics")
        write_metrics(raster, f"{output}/raster_level_metrics")
    return tile, raster
