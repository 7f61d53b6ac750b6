"""Pixel work on tile rows: `pixels binary` (bands x height x width, row-major) with its shape.

Spark moves the rows; numpy touches one tile at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownframe.operators.masks import merge_intervals


def _array(raw, bands: int, height: int, width: int, dtype: str = "uint8") -> np.ndarray:
    return np.frombuffer(raw, dtype=dtype).reshape(bands, height, width)


def _doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


@F.pandas_udf(_doubles("black", "white"))
def blank_shares(pixels: pd.Series, bands: pd.Series, height: pd.Series,
                 width: pd.Series) -> pd.DataFrame:
    """Share of all-zero and of all-255 pixels over the colour bands."""
    rows = []
    for raw, b, h, w in zip(pixels, bands, height, width):
        a = _array(raw, b, h, w)[:3]
        rows.append(((a == 0).all(axis=0).mean(), (a == 255).all(axis=0).mean()))
    return pd.DataFrame(rows, columns=["black", "white"])


def blank_tile_filter(tiles: DataFrame, limit: float = 0.8) -> DataFrame:
    """Drop tiles that are black on more than `limit` of their area or white everywhere."""
    marked = tiles.withColumn("_b", blank_shares("pixels", "bands", "height", "width"))
    return marked.filter((F.col("_b.black") <= limit) & (F.col("_b.white") < 1)).drop("_b")


@F.pandas_udf(_doubles("low", "high"))
def centre_range(pixels: pd.Series, bands: pd.Series, height: pd.Series, width: pd.Series,
                 dtype: pd.Series) -> pd.DataFrame:
    """Value range in the middle window of at most 512 pixels."""
    rows = []
    for raw, b, h, w, kind in zip(pixels, bands, height, width, dtype):
        a = _array(raw, b, h, w, kind)
        top, left = max(0, (h - 512) // 2), max(0, (w - 512) // 2)
        part = a[:3, top:top + 512, left:left + 512]
        rows.append((float(part.min()), float(part.max())))
    return pd.DataFrame(rows, columns=["low", "high"])


def validate_rgb(tiles: DataFrame, strict: bool = True, id_col: str = "tile_path") -> DataFrame:
    """Violations `(tile, severity, problem)`; an empty table means the tiles are fine.

    Checked: at least three bands, colour meaning red/green/blue in `colors`, `dtype` uint8, values
    0..255 in the middle. A missing or other colour meaning is an error when `strict`, else a
    warning.
    """
    colors = F.slice("colors", 1, 3)
    rgb = F.array(F.lit("red"), F.lit("green"), F.lit("blue"))
    severity = F.lit("error" if strict else "warning")
    error = F.lit("error")
    spread = centre_range("pixels", "bands", "height", "width", "dtype")

    def problem(condition: Column, level: Column, text: str) -> Column:
        return F.when(condition, F.struct(level.alias("severity"), F.lit(text).alias("problem")))

    checked = tiles.withColumn("_r", spread)
    found = F.array(
        problem(F.col("bands") < 3, error, "fewer than three bands"),
        problem(F.coalesce(~colors.eqNullSafe(rgb), F.lit(True)), severity,
                "bands are not red, green, blue"),
        problem(F.col("dtype") != "uint8", error, "type is not uint8"),
        problem((F.col("_r.low") < 0) | (F.col("_r.high") > 255), error, "values outside 0 to 255"))
    return checked.select(id_col, F.explode(F.array_compact(found)).alias("_p")).select(
        id_col, "_p.severity", "_p.problem")


@F.pandas_udf(T.BinaryType())
def float_to_uint8(pixels: pd.Series, bands: pd.Series, height: pd.Series,
                   width: pd.Series) -> pd.Series:
    """32-bit float values divided by 256, held to 0..255 and cut to whole numbers."""
    def convert(raw):
        return np.clip(np.frombuffer(raw, dtype="float32") / 256, 0, 255).astype("uint8").tobytes()

    return pixels.map(convert)


def crop_pixels(tiles: DataFrame, windows: DataFrame, key: str = "tile_path") -> DataFrame:
    """Pixel windows `(key, wx, wy, ww, wh)` of parent tiles, with the shifted transform.

    Each parent row is paired with its windows by a join, so a window never waits for the others.
    """
    joined = windows.join(tiles, key)
    schema = joined.schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                a = _array(row.pixels, row.bands, row.height, row.width)
                part = a[:, row.wy:row.wy + row.wh, row.wx:row.wx + row.ww]
                t = list(row.transform)
                shifted = [t[0], t[1], t[2] + t[0] * row.wx + t[1] * row.wy,
                           t[3], t[4], t[5] + t[3] * row.wx + t[4] * row.wy]
                out.append(row._replace(pixels=np.ascontiguousarray(part).tobytes(),
                                        height=part.shape[1], width=part.shape[2],
                                        transform=shifted))
            yield pd.DataFrame(out, columns=pdf.columns)

    return joined.mapInPandas(run, schema)


def black_out(tiles: DataFrame, runs: DataFrame, key: str = "tile_path") -> DataFrame:
    """Set the pixels under the given row runs to zero in every band.

    Runs that overlap are joined first, so those of one tile are bounded by its pixels; they travel as one
    array next to the tile.
    """
    merged = merge_intervals(runs.select(key, "line", "c0", "c1"), [key, "line"], "c0", "c1")
    lists = merged.groupBy(key).agg(F.collect_list(F.struct("line", "c0", "c1")).alias("_runs"))

    @F.pandas_udf(T.BinaryType())
    def erase(pixels: pd.Series, bands: pd.Series, height: pd.Series, width: pd.Series,
              holes: pd.Series) -> pd.Series:
        out = []
        for raw, b, h, w, items in zip(pixels, bands, height, width, holes):
            if items is None or len(items) == 0:
                out.append(raw)
                continue
            a = _array(raw, b, h, w).copy()
            for r in items:
                a[:, r["line"], r["c0"]:r["c1"]] = 0
            out.append(a.tobytes())
        return pd.Series(out)

    joined = tiles.join(lists, key, "left")
    return joined.withColumn("pixels", erase("pixels", "bands", "height", "width", "_runs")).drop(
        "_runs").select(*tiles.columns)


# Leading bytes of the image formats that are accepted.
MAGIC = ("49492A00", "4D4D002A", "49492B00", "4D4D002B", "89504E47", "FFD8FF")


def readable_images(files: DataFrame, least_bytes: int = 100, bands: str | None = None) -> DataFrame:
    """Rows of a `binaryFile` table that are not corrupt: long enough, known header, three bands.

    `bands` names a column with the band count when one is known.
    """
    head = F.hex(F.substring("content", 1, 4))
    known = F.lit(False)
    for magic in MAGIC:
        known = known | head.startswith(magic)
    good = (F.col("length") >= least_bytes) & known
    if bands:
        good = good & (F.col(bands) >= 3)
    return files.filter(good)


def corrupt_image_filter(images: DataFrame, annotations: DataFrame,
                         readable: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Images that are readable, and the annotations on them."""
    kept = images.join(readable.select("file_name").distinct(), "file_name", "left_semi")
    ids = kept.select(F.col("id").alias("image_id"))
    return kept, annotations.join(ids, "image_id", "left_semi")
