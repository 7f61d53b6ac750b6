"""Raster-level evaluation: predictions against truths over IoU thresholds and size classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownframe.functions import boxes as B
from crownframe.functions import geodesy
from crownframe.functions import rings as R
from crownframe.functions.polygons import even_odd_area, polygon_inter_area
from crownframe.operators import metrics
from crownframe.operators.dissolve import disjoint_boxes
from crownframe.operators.fragments import aoi_polygon_filter
from crownframe.operators.matching import greedy_match
from crownframe.operators.numbering import reassign_duplicates, row_index
from crownframe.operators.spatial_join import aoi_filter, bbox_join, to_pixel_space
from crownframe.session import cut, on_file

KEY = "product_id"
SHAPE = ("rings", "clip", "_own_area")


def _unique_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Pieces of one object in several AOI rows count on their own, so they get their own ids."""
    if df.groupBy(KEY, id_col).count().filter("count > 1").limit(1).count() == 0:
        return df
    return reassign_duplicates(df, [F.col(KEY), F.col("y0"), F.col("x0")], id_col)


def _clip_polygons(objects: DataFrame, aoi: DataFrame, id_col: str, min_frac: float) -> DataFrame:
    """`aoi_filter` for polygons: the AOI box becomes a clip ring, geometry is not rewritten."""
    thin = objects.select(KEY, id_col, *B.BOX, "rings")
    parts = bbox_join(thin, aoi.select(KEY, *B.BOX), [KEY])
    a, b = B.box("a_"), B.box("b_")
    parts = parts.select(
        KEY, F.col(f"a_{id_col}").alias(id_col), R.box_ring(*b).alias("clip"),
        F.col("a_rings").alias("_rings"), *[c.alias(f"_{n}") for n, c in B.clip(a, b).items()])
    parts = parts.withColumns({"_in": polygon_inter_area("_rings", "clip"),
                               "_all": even_odd_area("_rings")})
    inside = parts.groupBy(KEY, id_col).agg(
        F.sum("_in").alias("_in"), F.first("_all").alias("_all")).filter(
        (F.col("_all") > 0) & (B.zero_div(F.col("_in"), F.col("_all")) >= min_frac))
    kept = parts.filter("_in > 0").join(inside.select(KEY, id_col), [KEY, id_col], "left_semi")
    rest = objects.drop(*B.BOX)
    return kept.select(KEY, id_col, "clip", "_in", *[F.col(f"_{n}").alias(n) for n in B.BOX]).join(
        rest, [KEY, id_col]).withColumnRenamed("_in", "_area")


def utm_zones(truths: DataFrame, predictions: DataFrame) -> DataFrame:
    """(product_id, epsg): the UTM zone of the middle of a raster's truths, or of its predictions if it has no truths."""
    def middle(df, name):
        return df.groupBy(KEY).agg(F.struct(((F.min("x0") + F.max("x1")) / 2).alias("lon"),
                                            ((F.min("y0") + F.max("y1")) / 2).alias("lat")).alias(name))

    at = F.coalesce("_t", "_p")
    zones = middle(truths, "_t").join(middle(predictions, "_p"), KEY, "full")
    return zones.select(KEY, geodesy.utm_epsg(at["lon"], at["lat"]).alias("epsg"))


def to_utm(predictions: DataFrame, truths: DataFrame, aoi: DataFrame | None,
           iou_type: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Geographic tables in metres, all shapes of a raster in one UTM zone. Boxes become rings, as a box in degrees is no box in
    metres; an AOI gets `rings` and `aoi` numbers."""
    if iou_type == "bbox":
        predictions, truths = (df.withColumn("rings", R.box_ring(*B.box())) for df in (predictions, truths))
    else:
        predictions, truths = (df.withColumns(R.envelope(F.col("rings"))) for df in (predictions, truths))
    zones = cut(utm_zones(truths, predictions), "zones")

    def moved(df):
        with_zone = df.join(zones, KEY)
        return with_zone.withColumn("rings", geodesy.rings_to_utm(F.col("rings"), F.col("epsg"))).drop("epsg")

    if aoi is not None:
        if "rings" not in aoi.columns:
            aoi = row_index(disjoint_boxes(aoi).withColumn("rings", R.box_ring(*B.box())).drop(*B.BOX), [], [F.col(KEY), F.col("rings")], "aoi")
        aoi = cut(moved(aoi), "utm-aoi")
    predictions, truths = (moved(df).drop(*B.BOX) for df in (predictions, truths))
    if aoi is not None:         # read more than once then
        predictions, truths = cut(predictions, "utm"), cut(truths, "utm")
    return predictions, truths, aoi


def prepare(predictions: DataFrame, truths: DataFrame, gsd: float, aoi: DataFrame | None = None,
            iou_type: str = "bbox", min_frac: float = 0.4, pred_id: str = "object_id",
            truth_id: str = "truth_id", geographic: bool = False) -> tuple[DataFrame, DataFrame]:
    """Both tables inside the AOI, in pixels, with `_area` and a `size_label`.

    `aoi` has boxes, or `aoi` and `rings`, polygons that don't overlap each other. `geographic` tables are in degrees
    (x: longitude, y: latitude) and are moved to the UTM zone of each raster's truths first.
    """
    if iou_type not in ("bbox", "segm"):
        raise ValueError(f"unknown IoU type {iou_type!r}, expected 'bbox' or 'segm'")
    if geographic:
        predictions, truths, aoi = to_utm(predictions, truths, aoi, iou_type)
        iou_type = "segm"
    polygons = aoi is not None and "rings" in aoi.columns
    if polygons and iou_type == "bbox":
        # A box inside an irregular AOI is no box any more.
        predictions, truths = (df.withColumn("rings", R.box_ring(*B.box())) for df in (predictions, truths))
        iou_type = "segm"
    if aoi is not None and not polygons:
        aoi = disjoint_boxes(aoi)
    out = []
    for df, ident in ((predictions, pred_id), (truths, truth_id)):
        if iou_type == "segm":
            df = df.withColumns(R.envelope(F.col("rings")))
            if polygons:
                df = _unique_ids(cut(aoi_polygon_filter(df, aoi, ident, min_frac, [KEY]), "aoi"), ident)
            elif aoi is not None:
                df = _unique_ids(cut(_clip_polygons(df, aoi, ident, min_frac), "aoi"), ident)
            else:
                df = df.withColumns({"clip": F.lit(None).cast(R.RINGS),
                                     "_area": even_odd_area("rings")})
        elif aoi is not None:
            df = _unique_ids(cut(aoi_filter(df, aoi, ident, min_frac), "aoi"), ident)
        out.append(df)
    predictions, truths = out
    if iou_type == "segm":
        # IoU does not change with scale and shift, so only the area goes to pixels.
        sized = [df.withColumns({"_own_area": F.col("_area"), "_area": F.col("_area") / (gsd * gsd)})
                 for df in (predictions, truths)]
    else:
        truths, predictions = to_pixel_space(truths, predictions, gsd, KEY)
        sized = [df.withColumn("_area", B.area(B.box())) for df in (predictions, truths)]
    predictions, truths = (
        df.withColumn("size_label", B.size_label(F.col("_area"), gsd)) for df in sized)
    return predictions, truths


def _written(df: DataFrame, columns: Sequence[str], gsd: float, whole: bool, name: str) -> DataFrame:
    """A table of `prepare` on files, with what is read of it. What follows from whole polygons is worked out when it is read."""
    if "clip" not in df.columns:
        return cut(df.select(KEY, *columns, *B.BOX, "size_label"), name)
    if not whole:
        return cut(df.select(KEY, *columns, *B.BOX, *SHAPE, "size_label"), name)
    kept = cut(df.select(KEY, *columns, "rings", "_own_area"), name)
    out = kept.withColumns({**R.envelope(F.col("rings")), "clip": F.lit(None).cast(R.RINGS),
                            "size_label": B.size_label(F.col("_own_area") / (gsd * gsd), gsd)})
    on_file(out, now=True)
    return out


def raster_counts(predictions: DataFrame, truths: DataFrame, gsd: float,
                  thresholds: Sequence[float] = (0.5,), aoi: DataFrame | None = None,
                  iou_type: str = "bbox", score_col: str | None = None,
                  pred_id: str = "object_id", truth_id: str = "truth_id", geographic: bool = False) -> DataFrame:
    """tp, fp, fn, precision, recall, f1 per raster, threshold and size bin."""
    score = score_col or metrics.pick_score(predictions)
    p, t = prepare(predictions, truths, gsd, aoi, iou_type, pred_id=pred_id, truth_id=truth_id, geographic=geographic)
    p, t = (_written(df, [ident, *more], gsd, aoi is None, name) for df, ident, more, name in (
        (p, pred_id, [score], "predictions"), (t, truth_id, [], "truths")))
    matches = greedy_match(p, t, thresholds, score, [KEY], "size_label", pred_id, truth_id,
                           shape_cols=SHAPE if "clip" in p.columns else ())
    return metrics.count_matches(matches, p, t, thresholds, [KEY], "size_label")


def raster_level(predictions: DataFrame, truths: DataFrame, gsd: float, **options) -> DataFrame:
    """One row of raster-level metrics per raster; options as in `raster_counts`."""
    return metrics.rf1_sweep(raster_counts(predictions, truths, gsd, **options), [KEY])
