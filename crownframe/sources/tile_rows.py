"""Tile rows with nested annotation arrays, as exchanged through dataset hubs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crownframe.operators.numbering import row_index

# Our fold name and the name used for it outside.
FOLD_NAMES = {"valid": "validation"}
GROUP = ("location", "raster_name", "fold")


def write_tile_rows(tiles: DataFrame, labels: DataFrame, path: str | None = None,
                    category: str = "tree") -> DataFrame:
    """One row per tile with `annotations {bbox, segmentation, area, iscrowd, category}` arrays.

    With `path` also written as JSON lines, one folder per fold. Tiles without labels get empty arrays.
    A row holds the labels of one tile, as the exchange format has it.
    """
    has_rings = "rings" in labels.columns
    grouped = labels.groupBy("tile_name").agg(F.array_sort(F.collect_list(F.struct(
        "id", "bbox", *(["rings"] if has_rings else []), "area", "iscrowd"))).alias("_l"))
    joined = tiles.join(grouped, "tile_name", "left")
    empty = F.coalesce(F.size("_l"), F.lit(0)) == 0

    def values(field, kind):
        return F.when(empty, F.array().cast(f"array<{kind}>")).otherwise(
            F.transform("_l", lambda s: s[field].cast(kind)))

    segmentation = (values("rings", "array<array<double>>") if has_rings
                    else F.lit(None).cast("array<array<array<double>>>"))
    annotations = F.struct(
        values("bbox", "array<double>").alias("bbox"), segmentation.alias("segmentation"),
        values("area", "double").alias("area"), values("iscrowd", "int").alias("iscrowd"),
        F.transform(values("iscrowd", "int"), lambda _: F.lit(category)).alias("category"))
    rows = joined.withColumn("annotations", annotations).drop("_l")
    if path:
        rows.write.mode("errorifexists").partitionBy("fold").json(path)
    return rows


def read_tile_rows(source: DataFrame | str, spark: SparkSession | None = None,
                   folds: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(tiles, annotations) with ids from 1 per (location, raster, fold).

    The image bytes are never read. Outside fold names are mapped to ours.
    """
    rows = spark.read.parquet(source) if isinstance(source, str) else source
    rows = rows.drop("image")
    fold = F.col("fold")
    for ours, theirs in FOLD_NAMES.items():
        fold = F.when(F.col("fold") == theirs, ours).otherwise(fold)
    rows = rows.withColumn("fold", fold)
    if folds is not None:
        rows = rows.filter(F.col("fold").isin(*folds))
    keys = list(GROUP)
    numbered = row_index(rows.drop("annotations"), keys, [F.col("tile_name")], "id", start=1)
    zipped = F.arrays_zip(F.col("annotations.bbox").alias("bbox"),
                          F.col("annotations.area").alias("area"),
                          F.col("annotations.iscrowd").alias("iscrowd"))
    cells = rows.select(*keys, "tile_name", F.posexplode(zipped).alias("pos", "_a"),
                        F.col("annotations.segmentation").alias("_s"))
    cells = cells.select(*keys, "tile_name", "pos", F.col("_a.bbox").alias("bbox"),
                         F.col("_a.area").alias("area"), F.col("_a.iscrowd").alias("iscrowd"),
                         F.try_element_at("_s", F.col("pos") + 1).alias("rings"))
    with_image = cells.join(numbered.select(*keys, "tile_name", F.col("id").alias("image_id")),
                            [*keys, "tile_name"])
    order = [F.col("image_id"), F.col("pos")]
    annotations = row_index(with_image, keys, order, "id", start=1)
    return numbered, annotations.select(*keys, "id", "image_id", F.lit(1).alias("category_id"),
                                        "bbox", "rings", "area", "iscrowd")
