"""Plain files: tile folders, box labels in XML and CSV, metadata lines, renaming plans."""

from __future__ import annotations

import os
import uuid
import warnings
from collections.abc import Sequence
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crownframe.functions.names import leaf


class Replacement:
    """A file written whole under another name, and then moved to the place of `source` or under its name into `target`."""

    def __init__(self, source: str, target: str | None = None):
        folder, name = source.rsplit("/", 1)
        plain = target or folder
        if plain.startswith("file:/") and not plain.startswith("file://"):
            plain = "file://" + plain[5:]
        self.fs, base = fs.FileSystem.from_uri(plain if target is None or "://" in plain else os.path.abspath(plain))
        name = unquote(name)                            # Spark gives the names of files as parts of a URI
        self.fs.create_dir(base, recursive=True)
        self.end, self.fresh = f"{base}/{name}", f"{base}/.{name}.{uuid.uuid4().hex}.new"
        self.stream = self.fs.open_output_stream(self.fresh)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def finish(self) -> None:
        self.stream.close()
        local = isinstance(self.fs, fs.LocalFileSystem)
        base, name = self.end.rsplit("/", 1)
        # A local file may have a checksum by its side; other stores may not move onto a file.
        self._delete(f"{base}/.{name}.crc" if local else self.end)
        self.fs.move(self.fresh, self.end)

    def drop(self) -> None:
        self.stream.close()
        self._delete(self.fresh)

    def _delete(self, path: str) -> None:
        if self.fs.get_file_info(path).type != fs.FileType.NotFound:
            self.fs.delete_file(path)


def list_tiles(spark: SparkSession, path: str, suffixes: Sequence[str] = ("tif", "tiff")) -> DataFrame:
    """Tile files below a folder, sorted, with a warning when there are none."""
    found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.{%s}" % ",".join(suffixes))
             .option("recursiveFileLookup", True).load(path)
             .select("path", "length", "modificationTime").withColumn("file_name", leaf(F.col("path"))))
    if found.limit(1).count() == 0:
        warnings.warn(f"no tiles found in {path}", stacklevel=2)
    return found.orderBy("path")


VOC = "name string, bndbox struct<xmin:double,ymin:double,xmax:double,ymax:double>"


def read_voc_xml(spark: SparkSession, path: str) -> DataFrame:
    """Box labels of per-raster XML files: source, name and corners."""
    rows = spark.read.format("xml").option("rowTag", "object").schema(VOC).load(path)
    return rows.select(
        F.col("_metadata.file_path").alias("source_id"), "name",
        *[F.col(f"bndbox.{old}").alias(new) for old, new in
          (("xmin", "x0"), ("ymin", "y0"), ("xmax", "x1"), ("ymax", "y1"))])


BOX_CSV = "image_path string, xmin double, ymin double, xmax double, ymax double, label string"


def read_box_csv(spark: SparkSession, path: str) -> DataFrame:
    """Boxes of a CSV file as annotation rows with layout x, y, w, h."""
    rows = spark.read.schema(BOX_CSV).option("header", True).option("enforceSchema", False).csv(path)
    w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    return rows.select("image_path", "label", F.array("xmin", "ymin", w, h).alias("bbox"),
                       (w * h).alias("area"))


def boxes_per_image(boxes: DataFrame) -> DataFrame:
    """Number and joint area of the boxes of each image."""
    return boxes.groupBy("image_path").agg(
        F.count(F.lit(1)).alias("num_boxes"), F.sum("area").alias("total_area"))


def read_jsonl_tolerant(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines) of a file with one JSON object per line."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    rows = spark.read.text(path).select(
        "value", F.from_json("value", f"{schema}, _bad string", options).alias("_r"))
    bad = rows.filter("_r._bad is not null").select(F.col("value").alias("line"))
    return rows.filter("_r._bad is null").select("_r.*").drop("_bad"), bad


def rename_tiles(images: DataFrame, plan: DataFrame, present: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Image rows under their new names, and the planned renames whose file is missing.

    `plan` has `file_name, new_name`, `present` the existing `file_name`s. Copying the files is a
    job over the plan table and not part of this.
    """
    there = plan.join(present.select("file_name").distinct(), "file_name", "left_semi")
    missing = plan.join(present.select("file_name").distinct(), "file_name", "left_anti")
    renamed = images.join(there, "file_name", "left").withColumn(
        "file_name", F.coalesce("new_name", "file_name"))
    return renamed.select(*images.columns), missing
