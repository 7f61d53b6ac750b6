"""Row filters and projections over objects, images and annotations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownframe.functions import boxes as B
from crownframe.functions import rings as R
from crownframe.operators.numbering import in_batches, row_index, top_per_group


# --- flattening of model output ------------------------------------------------------------

def flatten_detections(tiles: DataFrame, tile_col: str = "tile_path") -> DataFrame:
    """One row per box from `boxes, scores, classes` arrays, with a running `object_id`.

    `boxes` holds structs x0, y0, x1, y1. Boxes without area are dropped before numbering.
    """
    rows = tiles.select(tile_col, F.posexplode(F.arrays_zip("boxes", "scores", "classes"))
                        .alias("position", "_d"))
    flat = rows.select(
        tile_col, "position", *[F.col(f"_d.boxes.{c}").alias(c) for c in B.BOX],
        F.col("_d.scores").alias("detector_score"), F.col("_d.classes").alias("detector_class"))
    solid = flat.filter((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0")))
    return row_index(solid, [], [F.col(tile_col), F.col("position")], "object_id").drop("position")


def flatten_masks(tiles: DataFrame, tile_col: str = "tile_path") -> DataFrame:
    """One row per mask from `masks, scores` and, with prompts, `object_ids` arrays.

    The prompt's object id is kept; without prompts ids are numbered from 0.
    """
    prompted = "object_ids" in tiles.columns
    arrays = ["masks", "scores", *(["object_ids"] if prompted else [])]
    rows = tiles.select(tile_col, F.posexplode(F.arrays_zip(*arrays)).alias("position", "_m"))
    flat = rows.select(tile_col, "position", F.col("_m.masks").alias("mask"),
                       F.col("_m.scores").alias("segmenter_score"),
                       *([F.col("_m.object_ids").alias("object_id")] if prompted else []))
    if prompted:
        return flat.drop("position")
    return row_index(flat, [], [F.col(tile_col), F.col("position")], "object_id").drop("position")


def flatten_classes(rows: DataFrame, scores: str = "scores",
                    predicted: str = "predicted") -> DataFrame:
    """Object id, tile, predicted class with its score, and all scores."""
    return rows.select(
        "object_id", "tile_path", F.col(predicted).alias("classifier_class"),
        F.try_element_at(F.col(scores), F.col(predicted) + 1).alias("classifier_score"),
        F.col(scores).alias("classifier_scores"))


def unclassified(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count_if(F.col("classifier_class").isNull()).alias("num_unclassified"),
        F.count(F.lit(1)).alias("num_rows"))


def argmax_class(rows: DataFrame, logits: str = "logits") -> DataFrame:
    """Softmax scores, best class (first among equals) and its score."""
    top = F.array_max(logits)
    exps = F.transform(logits, lambda v: F.exp(v - F.array_max(logits)))
    total = F.aggregate(exps, F.lit(0.0), lambda s, v: s + v)
    return rows.withColumn("classifier_scores", F.transform(exps, lambda v: v / total)).withColumns({
        "classifier_class": (F.array_position(F.col(logits), top) - 1).cast("int"),
        "classifier_score": F.array_max("classifier_scores")})


def best_candidate(masks: DataFrame, keys: Sequence[str], score: str = "predicted_iou",
                   candidate: str = "candidate") -> DataFrame:
    """The mask with the highest predicted IoU per prompt; ties take the first candidate."""
    rest = [c for c in masks.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.col(score), -F.col(candidate))).alias("_b")
    return masks.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest])


# --- filters ----------------------------------------------------------------------------------

def score_filter(df: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    return df.filter(F.col(score) >= threshold)


def visible_box_filter(annotations: DataFrame, images: DataFrame, bbox: str = "bbox") -> DataFrame:
    """Four-number boxes with positive width and height that reach into their image."""
    sized = annotations.join(images.select(F.col("id").alias("image_id"), "width", "height"),
                             "image_id")
    x, y, w, h = [F.try_element_at(F.col(bbox), F.lit(i)) for i in range(1, 5)]
    good = ((F.size(bbox) == 4) & (w > 0) & (h > 0) & (x + w > 0) & (y + h > 0)
            & (x < F.col("width")) & (y < F.col("height")))
    return sized.filter(good).select(*annotations.columns)


def prefix_filter(annotations: DataFrame, rasters: DataFrame, image: str = "image_name",
                  raster: str = "raster_name", length: int | None = None) -> DataFrame:
    """Annotations whose image name starts with the name of a raster in the list, once per such name.

    A name is cut to each length that the raster names have (`length` saves the look at the list) and all
    cuts are joined in one equality join, so the annotations are read once and no nested loop is needed.
    """
    lengths = ([length] if length is not None else
               [r[0] for r in rasters.select(F.length(raster)).distinct().collect()])
    cuts = F.array(*[F.substring(image, 1, n) for n in sorted({v for v in lengths if v is not None})])
    wanted = rasters.select(raster).filter(F.col(raster).isNotNull()).distinct()
    return annotations.withColumn(raster, F.explode(F.array_distinct(cuts.cast("array<string>")))).join(
        wanted, raster).select(*annotations.columns, raster)


def drop_degenerate_boxes(df: DataFrame, width: Column, height: Column) -> DataFrame:
    """Clip to the image and drop boxes that have no width or height left."""
    zero = F.lit(0.0)
    b = B.box()
    clipped = df.withColumns({
        "x0": F.least(F.greatest(b[0], zero), width), "y0": F.least(F.greatest(b[1], zero), height),
        "x1": F.least(F.greatest(b[2], zero), width), "y1": F.least(F.greatest(b[3], zero), height)})
    return clipped.filter((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0")))


def drop_stage_columns(df: DataFrame) -> DataFrame:
    """Columns of an earlier aggregation that must not enter the next one."""
    return df.drop("aggregator_score", "tile_id")


def pass_columns(df: DataFrame, extra: Sequence[str] = (),
                 skip: Sequence[str] = (*B.BOX, "rings", "tile_path")) -> list[str]:
    """Non-geometry columns carried forward, plus configured label columns."""
    names = [c for c in df.columns if c not in skip]
    return names + [c for c in extra if c not in names and c not in skip]


def remove_category(images: DataFrame, annotations: DataFrame, categories: DataFrame, name: str,
                    drop_empty: bool = False, source: Sequence[str] = ()) -> tuple:
    """Drop one category by name and close the gap in the ids: (images, annotations, categories).

    With `source` (the column of the document) each document has its own ids; else all share them. Only images
    with annotations are visited, so images without any are lost; with `drop_empty` also those left
    without annotations.
    """
    source = list(source)
    ids = categories.filter(F.col("name") == name).groupBy(*source).agg(F.min("id").alias("_gone"))
    found = ids.filter("_gone is not null").limit(1).collect()
    if not found:
        raise ValueError(f"category {name!r} not found")

    def known(df):
        """With the removed id of the row's own document (null: it has none)."""
        return df.join(ids, source, "left") if source else df.withColumn("_gone", F.lit(found[0]["_gone"]))

    def closed(df, column):
        kept = df.filter(F.col("_gone").isNull() | (F.col(column) != F.col("_gone")))
        return kept.withColumn(column, F.when(F.col(column) > F.col("_gone"), F.col(column) - 1)
                               .otherwise(F.col(column))).drop("_gone")

    rest = closed(known(annotations), "category_id").select(*annotations.columns)
    visited = rest if drop_empty else annotations
    used = visited.select(*source, F.col("image_id").alias("id")).distinct()
    kept = images.join(used, [*source, "id"], "left_semi")
    return kept, rest, closed(known(categories), "id").select(*categories.columns)


def min_area_filter(annotations: DataFrame, min_area: float, area: str = "area",
                    source: str = "source_id") -> tuple[DataFrame, DataFrame]:
    """Drop small annotations; text that is no number counts as 0, NaN is dropped as well.

    Returns (kept, per-file counts of removed and all).
    """
    text = F.col(area).cast("string").try_cast("double")
    value = F.coalesce(text, F.lit(0.0))
    big = (value >= min_area) & ~F.isnan(value)
    report = annotations.groupBy(source).agg(
        F.count_if(~big).alias("removed"), F.count(F.lit(1)).alias("total"))
    return annotations.filter(big), report


def valid_segmentation_filter(annotations: DataFrame, rings: str = "rings", counts: str = "counts",
                              source: str = "source_id") -> DataFrame:
    """Drop empty segmentations, but only in files where any annotation has one.

    A file of plain boxes stays as it is.
    """
    filled = (F.coalesce(F.size(counts) > 0, F.lit(False))
              | F.coalesce(F.size(rings) > 0, F.lit(False)))
    valid = F.coalesce(F.size(counts) > 0, F.lit(False)) | R.has_valid_ring(F.col(rings))
    with_masks = annotations.filter(filled).select(source, F.lit(True).alias("_masks")).distinct()
    marked = annotations.join(with_masks, source, "left")
    return marked.filter(F.col("_masks").isNull() | valid).select(*annotations.columns)


def all_segmented_images(images: DataFrame, annotations: DataFrame,
                         rings: str = "rings") -> DataFrame:
    """Images on which every annotation has a segmentation."""
    bad = annotations.filter(~R.has_valid_ring(F.col(rings))).select(
        F.col("image_id").alias("id")).distinct()
    return images.join(bad, "id", "left_anti")


def detector_records(annotations: DataFrame, rings: str = "rings") -> DataFrame:
    """Training records: corner boxes, category from 0, rings with at least three points."""
    x, y, w, h = [F.element_at("bbox", i) for i in range(1, 5)]
    out = annotations.withColumns({**B.xywh_to_xyxy(x, y, w, h), rings: R.clean_rings(F.col(rings))})
    return out.withColumn("category_id", F.col("category_id") - 1).drop("bbox")


def fold_assign(rows: DataFrame, metadata: DataFrame, image: str = "image_id",
                valid_fold: int = 4) -> DataFrame:
    """`fold` from the cross-validation number of the image: one number is `valid`, others train."""
    folds = metadata.select(F.col("image_id").alias(image), F.when(
        F.col("validation_fold") == valid_fold, "valid").otherwise("train").alias("fold"))
    return rows.join(folds, image)


def cap_per_tile(df: DataFrame, limit: int, seed: int = 0, tile_col: str = "tile_path",
                 id_col: str = "object_id") -> DataFrame:
    """At most `limit` rows per tile, a random sample that depends only on id and seed."""
    order = [F.xxhash64(F.col(id_col), F.lit(seed)), F.col(id_col)]
    return top_per_group(df, [tile_col], order, limit)


def prompt_batches(df: DataFrame, size: int, tile_col: str = "tile_path",
                   order: str = "object_id") -> DataFrame:
    """Number the prompts of a tile in batches of `size`."""
    return in_batches(df, [tile_col], [F.col(order)], size)


def missing_files(expected: DataFrame, present: DataFrame, name: str = "file_name") -> DataFrame:
    return expected.join(present.select(name).distinct(), name, "left_anti")


def map_categories(labels: DataFrame, categories: DataFrame | None = None,
                   column: str = "species", default: int = 1) -> DataFrame:
    """Category id by name from the list; without a list everything is the one class."""
    if categories is None:
        return labels.withColumn("category_id", F.lit(default))
    ids = categories.select(F.col("name").alias(column), F.col("id").alias("category_id"))
    joined = labels.join(ids, column, "left")
    return joined.withColumn("category_id", F.coalesce("category_id", F.lit(default)))


def annotations_by_image(annotations: DataFrame, columns: Sequence[str], image: str = "image_id",
                         order: str = "id") -> DataFrame:
    """Annotations as one ordered array per image."""
    return annotations.groupBy(image).agg(F.array_sort(F.collect_list(F.struct(
        order, *[c for c in columns if c != order]))).alias("annotations"))


# --- scores -----------------------------------------------------------------------------------

def fuse_scores(df: DataFrame, weights: dict[str, float], method: str = "weighted_geometric_mean",
                name: str = "aggregator_score") -> DataFrame:
    """One score from several columns; only weights above 0 count."""
    used = {c: float(w) for c, w in weights.items() if w and w > 0}
    if not used:
        raise ValueError("at least one score weight must be above 0")
    missing = [c for c in used if c not in df.columns]
    if missing:
        raise ValueError(f"score columns missing: {', '.join(missing)}")
    total = sum(used.values())
    if method == "weighted_geometric_mean":
        logs = None
        for c, w in used.items():
            term = F.lit(w) * F.ln(F.when(F.col(c) > 0, F.col(c)))
            logs = term if logs is None else logs + term
        fused = F.coalesce(F.exp(logs / total), F.lit(0.0))
    elif method == "weighted_arithmetic_mean":
        fused = None
        for c, w in used.items():
            fused = F.lit(w) * F.col(c) if fused is None else fused + F.lit(w) * F.col(c)
        fused = fused / total
    else:
        raise ValueError(f"unknown weighting method {method!r}")
    return df.withColumn(name, fused)


def weights_from(detector: float = 0.5, segmenter: float = 0.5,
                 listed: dict[str, float] | None = None) -> dict[str, float]:
    """Weights by column; with a dict, columns it does not list get 0."""
    if listed is not None:
        detector = listed.get("detector_score", 0.0)
        segmenter = listed.get("segmenter_score", 0.0)
    return {"detector_score": detector, "segmenter_score": segmenter}


def edge_band_filter(df: DataFrame, percentage: float) -> DataFrame:
    """Drop objects whose centre lies in the outer band of their tile (`px0..py1`)."""
    cx, cy = B.center(B.box())
    w = (F.col("px1") - F.col("px0")) * percentage
    h = (F.col("py1") - F.col("py0")) * percentage
    return df.filter((cx >= F.col("px0") + w) & (cx <= F.col("px1") - w)
                     & (cy >= F.col("py0") + h) & (cy <= F.col("py1") - h))


def centroid_distance_weight(df: DataFrame, least: float, score: str) -> DataFrame:
    """Scale a score from 1 at the tile centre down to `least` at its corners."""
    cx, cy = B.center(B.box())
    tx, ty = (F.col("px0") + F.col("px1")) / 2, (F.col("py0") + F.col("py1")) / 2
    far = F.sqrt(F.pow(F.col("px1") - tx, 2) + F.pow(F.col("py1") - ty, 2))
    away = F.least(F.sqrt(F.pow(cx - tx, 2) + F.pow(cy - ty, 2)) / far, F.lit(1.0))
    return df.withColumn(score, F.col(score) * (1 - (1 - least) * away))
