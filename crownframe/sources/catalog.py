"""Dataset catalog as three tables.

datasets:    dataset, license, ground_resolution, scale_factor, max_dets
products:    dataset, location, product_name
eval_inputs: dataset, fold, product_name, ground_truth, aoi (file names, may be null)

The catalog is data the user brings; nothing about particular datasets is built in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownframe.functions import names


def dataset_catalog(datasets: DataFrame, products: DataFrame, eval_inputs: DataFrame) -> DataFrame:
    """One row per dataset, location, product and fold with its evaluation inputs."""
    return products.join(datasets, "dataset").join(
        eval_inputs, ["dataset", "product_name"], "left")


def iter_fold(catalog: DataFrame, fold: str, files: DataFrame | None = None) -> DataFrame:
    """Products listed for the fold with tile folder, document name, truth and AOI file.

    Truth and AOI count only together. With `files` (`file_name`), a name that is not there is null,
    and the document name falls back from ground resolution to scale factor.
    """
    rows = catalog.filter(F.col("fold") == fold)
    both = F.col("ground_truth").isNotNull() & F.col("aoi").isNotNull()
    by_gsd = names.make_doc_name(F.col("product_name"), F.col("fold"),
                                 names.size_code(gsd=F.col("ground_resolution")))
    by_scale = names.make_doc_name(F.col("product_name"), F.col("fold"),
                                   names.size_code(scale=F.col("scale_factor")))
    out = rows.select(
        "dataset", "location", "product_name", "fold", "max_dets", "ground_resolution",
        F.concat_ws("/", "location", "product_name", F.lit("tiles"), "fold").alias("tile_dir"),
        by_gsd.alias("_gsd_doc"), by_scale.alias("_scale_doc"),
        F.when(both, F.col("ground_truth")).alias("ground_truth"),
        F.when(both, F.col("aoi")).alias("aoi"))
    if files is None:
        return out.withColumn("doc", F.coalesce("_gsd_doc", "_scale_doc")).drop(
            "_gsd_doc", "_scale_doc")
    present = files.select("file_name").distinct()

    def there(df, column):
        mark = present.select(F.col("file_name").alias(column), F.lit(True).alias(f"_has_{column}"))
        return df.join(mark, column, "left")

    for column in ("_gsd_doc", "ground_truth", "aoi"):
        out = there(out, column)
    paired = F.col("_has_ground_truth") & F.col("_has_aoi")
    return out.withColumns({
        "doc": F.when(F.col("_has__gsd_doc"), F.col("_gsd_doc")).otherwise(F.col("_scale_doc")),
        "ground_truth": F.when(paired, F.col("ground_truth")),
        "aoi": F.when(paired, F.col("aoi"))}).drop(
        "_gsd_doc", "_scale_doc", "_has__gsd_doc", "_has_ground_truth", "_has_aoi")


def verify_dataset(catalog: DataFrame, found: DataFrame) -> DataFrame:
    """Expected (location, product) pairs that are not there; empty when complete."""
    return catalog.select("location", "product_name").distinct().join(
        found.select("location", "product_name").distinct(),
        ["location", "product_name"], "left_anti")
