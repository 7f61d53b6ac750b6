"""Object tables derived from the given tables; the same rules as SQL in `workload.oracle`.

Coordinates are multiples of 0.25, so areas are exact doubles on both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. One that comes as fewer splits than there are cores (here: a single row group)
    is spread over them by its first column, so the rest of the plan does not run in one task."""
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    large = name in ("orders", "lineitem")
    return df.repartition(cores, df.columns[0]) if large and df.rdd.getNumPartitions() < cores else df


def _truth_columns(key, cust):
    col = (key % 32).cast("double") * 8
    row = (F.floor(key / 32) % 32).cast("double") * 8
    return {
        "truth_id": key,
        "product_id": F.floor(key / 1024).cast("int"),
        "x0": col,
        "y0": row,
        "x1": col + 2 + (cust % 41).cast("double") / 4,
        "y1": row + 2 + ((key * 7) % 41).cast("double") / 4,
        "category_id": (key % 3).cast("int"),
        "image_id": (F.floor(key / 1024) * 16 + F.floor((F.floor(key / 32) % 32) / 8) * 4
                     + F.floor((key % 32) / 8)).cast("long"),
    }


def truths(spark: SparkSession, sf: str) -> DataFrame:
    """One box per order; 1 024 boxes per raster, 64 per image."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf, "orders").select(
        *[c.alias(n) for n, c in _truth_columns(key, cust).items()])


def detections(spark: SparkSession, sf: str) -> DataFrame:
    """About four jittered boxes per truth."""
    t = truths(spark, sf).drop("category_id")
    shift = F.when(F.col("l_returnflag") == "R", 5.0).otherwise(0.0)
    item = table(spark, sf, "lineitem").join(t, F.col("l_orderkey") == F.col("truth_id"))
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    quantity = F.col("l_quantity").cast("long")
    ident = (((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 32768 + part % 32768) * 1024
             + supp % 1024) * 64 + quantity
    return item.select(
        ident.cast("long").alias("object_id"),
        "product_id", "image_id",
        (F.col("x0") + (part % 7 - 3).cast("double") / 4 + shift).alias("x0"),
        (F.col("y0") + (supp % 7 - 3).cast("double") / 4).alias("y0"),
        (F.col("x1") + (part % 5 - 2).cast("double") / 4 + shift).alias("x1"),
        (F.col("y1") + (supp % 5 - 2).cast("double") / 4).alias("y1"),
        ((F.col("l_quantity") * 2 - 1) / 100).alias("detector_score"),
        ((100 - F.col("l_quantity")) / 100).alias("segmenter_score"),
        (F.col("l_linenumber") % 3).cast("int").alias("detector_class"))


def with_tile(df: DataFrame) -> DataFrame:
    return df.withColumn("tile_path", F.concat(F.lit("tile_"), F.col("image_id").cast("string")))


TILE_SIZE, TILE_STEP, TILES_PER_SIDE = 128, 64, 4


def tiles(spark: SparkSession, sf: str) -> DataFrame:
    """A 4 x 4 grid of overlapping tiles per raster."""
    products = truths(spark, sf).select("product_id").distinct()
    steps = F.sequence(F.lit(0), F.lit(TILES_PER_SIDE - 1))
    grid = products.withColumn("col", F.explode(steps)).withColumn("row", F.explode(steps))
    x, y = F.col("col") * F.lit(float(TILE_STEP)), F.col("row") * F.lit(float(TILE_STEP))
    return grid.select("product_id", "col", "row", x.alias("px0"), y.alias("py0"),
                       (x + TILE_SIZE).alias("px1"), (y + TILE_SIZE).alias("py1"))


def runs(spark: SparkSession, sf: str, ids=("truth_id",)) -> DataFrame:
    """Row runs of the truth boxes on the integer grid, with the columns `ids` of their truth."""
    t = truths(spark, sf)
    rows = F.sequence(F.floor("y0"), F.ceil("y1") - 1)
    return t.select(*ids, "product_id", F.explode(rows.cast("array<int>")).alias("y"),
                    F.floor("x0").cast("int").alias("c0"), F.ceil("x1").cast("int").alias("c1"))


def detection_runs(spark: SparkSession, sf: str, ids=("object_id",)) -> DataFrame:
    """Row runs of the detection boxes on the integer grid, with the columns `ids` of their detection."""
    d = detections(spark, sf)
    rows = F.sequence(F.floor("y0"), F.ceil("y1") - 1)
    return d.filter("x1 > x0 and y1 > y0").select(
        *ids, "product_id", F.explode(rows.cast("array<int>")).alias("y"),
        F.floor("x0").cast("int").alias("c0"), F.ceil("x1").cast("int").alias("c1"))


def logits(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("object_id"), F.col("label").alias("true_class"),
        F.col("embedding").cast("array<double>").alias("logits"))


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metric rows per raster and run; the detection class plays the training run."""
    return detections(spark, sf).groupBy("product_id", "detector_class").agg(
        F.count(F.lit(1)).alias("num_preds"),
        F.round(F.avg("detector_score"), 6).alias("f1"),
        F.round(F.avg("segmenter_score"), 6).alias("recall"),
    ).select(
        F.concat(F.lit("loc_"), (F.col("product_id") % 3).cast("string")).alias("location"),
        F.concat(F.lit("raster_"), F.col("product_id").cast("string")).alias("product_name"),
        F.col("detector_class").alias("run_id"), "num_preds", "f1", "recall")
