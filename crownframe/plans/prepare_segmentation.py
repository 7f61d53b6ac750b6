"""Cleaning of annotation documents: all masks as polygons, small and empty ones removed."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownframe.functions import rle
from crownframe.functions.polygons import runs_to_polygon
from crownframe.operators import filters, masks
from crownframe.session import cut
from crownframe.sources import coco


def rle_to_polygons(annotations: DataFrame, ids=("source_id", "id")) -> DataFrame:
    """Fill `rings` of annotations given as run lengths, in either spelling; others stay."""
    ids = list(ids)
    counts = F.col("counts")
    if "counts_text" in annotations.columns:
        counts = F.coalesce(counts, F.when(F.col("counts_text").isNotNull(),
                                           rle.text_to_counts("counts_text")))
    coded = annotations.filter(F.col("counts").isNotNull() | (
        F.col("counts_text").isNotNull() if "counts_text" in annotations.columns else F.lit(False)))
    coded = coded.select(*ids, counts.alias("counts"), F.element_at("size", 1).alias("height"))
    columns = masks.rle_to_runs(coded, ids)   # lines are image columns here
    rows = masks.collect_runs(columns, ids)
    outlines = rows.withColumn("_p", runs_to_polygon("runs"))
    # The outline of column runs has x and y swapped.
    swapped = F.transform("_p", lambda r: F.transform(
        r, lambda v, i: F.when(i % 2 == 0, F.element_at(r, i + 2)).otherwise(F.element_at(r, i))))
    outlines = outlines.select(*ids, swapped.alias("_rings"))
    joined = annotations.join(outlines, ids, "left")
    return joined.withColumn("rings", F.coalesce("_rings", "rings")).drop("_rings")


def prepare_segmentation(annotations: DataFrame, min_area: float | None = 10.0,
                         convert: bool = True) -> tuple[DataFrame, DataFrame]:
    """(kept annotations, removed and total per file).

    Order: run lengths to polygons, minimum area, then empty segmentations in files that have any.
    """
    convert = convert and "size" in annotations.columns
    rows = rle_to_polygons(annotations) if convert else annotations
    kept = rows
    if min_area is not None:
        kept, _ = filters.min_area_filter(rows, min_area)
    # Whether a file has masks at all is decided on the file as it came.
    filled = (F.coalesce(F.size("rings") > 0, F.lit(False))
              | F.coalesce(F.size("counts") > 0, F.lit(False)))
    masked = rows.filter(filled).select("source_id", F.lit(True).alias("_masks")).distinct()
    valid = filters.R.has_valid_ring(F.col("rings"))
    if not convert:
        valid = valid | F.coalesce(F.size("counts") > 0, F.lit(False))
    clean = kept.join(masked, "source_id", "left").filter(F.col("_masks").isNull() | valid).drop(
        "_masks")
    before = rows.groupBy("source_id").agg(F.count(F.lit(1)).alias("total"))
    after = clean.groupBy("source_id").agg(F.count(F.lit(1)).alias("_kept"))
    report = before.join(after, "source_id", "left").select(
        "source_id", "total", (F.col("total") - F.coalesce("_kept", F.lit(0))).alias("removed"))
    return clean, report


@F.arrow_udf(T.StringType())
def with_segmentation(element: pa.Array, segmentation: pa.Array) -> pa.Array:
    """The JSON text of an annotation with another segmentation, all other keys as they are; null leaves the text."""
    out = []
    for text, new in zip(element.to_pylist(), segmentation.to_pylist()):
        if new is not None:
            fields = json.loads(text)
            fields["segmentation"] = json.loads(new)
            text = json.dumps(fields, ensure_ascii=False)
        out.append(text)
    return pa.array(out, pa.string())


def prepare_documents(spark: SparkSession, path: str | Sequence[str], target: str | None = None,
                      min_area: float | None = 10.0, convert: bool = True) -> DataFrame:
    """`prepare_segmentation` on COCO documents, which are rewritten in their place or under their names in `target`.

    Documents are read in pieces. Run lengths become polygons, annotations that go are left out, and every other
    character of an element and every other key of a document stays, but for blanks between elements. A second run
    changes nothing. Returns removed and total per file.
    """
    groups = cut(coco.coco_groups(spark, path), "groups")
    elements = groups.filter("section = 'annotations'")
    rows = elements.select("source_id", F.col("_e").alias("id"), F.from_json("t", coco.ANNOTATION).alias("a")).select(
        "source_id", "id", "a.area", *[c.alias(n) for n, c in coco.segmentation_columns(F.col("a.segmentation")).items()])
    kept, report = prepare_segmentation(cut(rows, "annotations"), min_area, convert)
    coded = (F.col("counts").isNotNull() | F.col("counts_text").isNotNull()) & F.lit(convert)
    kept = cut(kept.select("source_id", F.col("id").alias("_e"), F.when(coded, F.to_json("rings")).alias("_new")), "kept")
    stays = cut(elements.join(kept, ["source_id", "_e"]).select("source_id", "_h", "_e", "t", "_new"), "stays")
    first = stays.groupBy("source_id", "_h").agg(F.min("_e").alias("_first"))
    comma = F.when(F.col("_e") == F.col("_first"), "").otherwise(",")
    lines = stays.join(first, ["source_id", "_h"]).select("source_id", "_h", "_e", F.lit(1).alias("_p"), F.concat(
        comma, F.when(F.col("_new").isNull(), F.col("t")).otherwise(with_segmentation("t", "_new"))).alias("text"))
    heads = elements.filter("starts").select("source_id", "_h", "_e", F.lit(0).alias("_p"), F.col("lead").alias("text"))
    others = groups.filter("section is null or section <> 'annotations'").select(
        "source_id", "_h", "_e", F.lit(0).alias("_p"), F.concat("lead", "t").alias("text"))
    whole = lines.unionByName(heads).unionByName(others).withColumn("text", F.regexp_replace("text", r"^\s+|\s+$", ""))
    coco.write_files(cut(whole.filter("text <> ''"), "lines"), ["_h", "_e", "_p"], target)
    return cut(report, "report")
