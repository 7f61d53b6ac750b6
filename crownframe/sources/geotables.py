"""Object tables with geometry: Parquet per stage, and import of GeoPackage vector files."""

from __future__ import annotations

import sqlite3
import struct
import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The stages an objects table is kept for.
STAGES = ("notaggregated", "aggregated", "final")


def write_objects(objects: DataFrame, root: str, stage: str, crs_epsg: int | None = None,
                  partition: str = "product_id") -> str | None:
    """Write the table below `root/stage`, split by raster if it knows them; an empty table is skipped.

    Rows of a raster come together first, so there is a file or a few per raster, not one per raster and task.
    """
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}")
    if objects.limit(1).count() == 0:
        warnings.warn(f"nothing to write for stage {stage}", stacklevel=2)
        return None
    path = f"{root}/{stage}"
    if "crs_epsg" not in objects.columns:
        objects = objects.withColumn("crs_epsg", F.lit(crs_epsg).cast("int"))
    if partition in objects.columns:      # a large raster is dealt to several tasks again by the hint
        writer = objects.hint("rebalance", partition).write.mode("errorifexists").partitionBy(partition)
    else:
        writer = objects.write.mode("errorifexists")
    writer.parquet(path)
    return path


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _wkb(blob: bytes, at: int = 0):
    """(kind, polygons, next offset) of a WKB geometry; only surfaces give polygons."""
    order = "<" if blob[at] == 1 else ">"
    kind = struct.unpack_from(order + "I", blob, at + 1)[0] % 1000
    at += 5
    if kind == 3:
        n, at = struct.unpack_from(order + "I", blob, at)[0], at + 4
        rings = []
        for _ in range(n):
            points = struct.unpack_from(order + "I", blob, at)[0]
            flat = struct.unpack_from(f"{order}{2 * points}d", blob, at + 4)
            at += 4 + 16 * points
            closed = points > 1 and flat[:2] == flat[-2:]
            rings.append(list(flat[:-2] if closed else flat))
        return "polygon", [rings], at
    if kind in (6, 7):
        n, at = struct.unpack_from(order + "I", blob, at)[0], at + 4
        parts = []
        for _ in range(n):
            _, more, at = _wkb(blob, at)
            parts += more
        return "multipolygon" if kind == 6 else "collection", parts, at
    if kind == 1:
        return "point", [], at + 16
    if kind == 2:
        return "line", [], at + 4 + 16 * struct.unpack_from(order + "I", blob, at)[0]
    raise ValueError(f"geometry type {kind} is not supported")


# Bytes of the envelope for each envelope code of a GeoPackage geometry header.
_ENVELOPE = (0, 32, 48, 48, 64)


def parse_geometry(blob: bytes):
    """(srs id, kind, polygons) of a GeoPackage geometry blob."""
    if blob[:2] != b"GP":
        raise ValueError("not a GeoPackage geometry")
    flags = blob[3]
    srs = struct.unpack_from("<i" if flags & 1 else ">i", blob, 4)[0]
    if flags & 16:
        return srs, "empty", []
    kind, parts, _ = _wkb(blob, 8 + _ENVELOPE[(flags >> 1) & 7])
    return srs, kind, parts


def _features(content: bytes) -> Iterator[tuple]:
    con = sqlite3.connect(":memory:")
    con.deserialize(bytes(content))
    layers = con.execute("select table_name, column_name from gpkg_geometry_columns").fetchall()
    for table, column in layers:
        cursor = con.execute(f'select * from "{table}"')
        names = [d[0] for d in cursor.description]
        for i, row in enumerate(cursor):
            values = dict(zip(names, row))
            blob = values.pop(column)
            srs, kind, parts = parse_geometry(blob) if blob else (None, "empty", [])
            text = {k: None if v is None else str(v) for k, v in values.items()}
            yield table, i, srs, kind, parts, text


def import_geopackage(spark: SparkSession, path: str, batch: int = 5_000) -> DataFrame:
    """Features of GeoPackage files, one task per file, rows handed on in batches.

    `parts` is a list of polygons, each a list of flat rings without the closing point.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gpkg").load(path)
    schema = ("path string, layer string, position bigint, crs_epsg int, kind string, "
              "parts array<array<array<double>>>, attributes map<string,string>")
    names = ["path", "layer", "position", "crs_epsg", "kind", "parts", "attributes"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for where, content in zip(pdf["path"], pdf["content"]):
                rows = []
                for feature in _features(content):
                    rows.append((where, *feature))
                    if len(rows) >= batch:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return files.select("path", "content").mapInPandas(run, schema)
