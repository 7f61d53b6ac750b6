"""Changes to box tables for training; every random draw depends only on ids and a seed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownframe.functions import boxes as B


DIGITS = 13     # hexadecimal digits of the md5 of ids and seed that make a number: 52 bits


def draw(seed: int, *ids: Column | str) -> Column:
    """Uniform number in (0, 1), the same on every run, in any partitioning and on any engine with md5."""
    text = F.concat_ws(":", *[(F.col(i) if isinstance(i, str) else i).cast("string") for i in ids], F.lit(str(seed)))
    bits = F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10)
    return (bits.cast("double") + 0.5) / float(1 << 4 * DIGITS)


def normal(seed: int, *ids: Column | str) -> Column:
    """Standard normal number from two uniform ones."""
    radius = F.sqrt(-2 * F.ln(draw(seed, *ids)))
    return radius * F.cos(2 * math.pi * draw(seed + 1_000_003, *ids))


def jitter_boxes(df: DataFrame, scale: float, width: Column, height: Column, seed: int = 0,
                 id_col: str = "object_id") -> DataFrame:
    """Gaussian noise on every side relative to the box size, clipped to the image."""
    b = B.box()
    w, h = b[2] - b[0], b[3] - b[1]
    moved = {}
    for i, (name, size, limit) in enumerate(zip(B.BOX, (w, h, w, h), (width, height) * 2)):
        value = F.col(name) + normal(seed * 8 + i, id_col) * scale * size
        moved[name] = F.least(F.greatest(value, F.lit(0.0)), limit)
    return df.withColumns(moved)


def drop_boxes(df: DataFrame, probability: float, seed: int = 0,
               id_col: str = "object_id") -> DataFrame:
    return df.filter(draw(seed, id_col) >= probability)


def random_square_crop(boxes: DataFrame, tiles: DataFrame, min_side: int, max_side: int,
                       min_ratio: float = 0.0, seed: int = 0,
                       tile_col: str = "tile_path") -> tuple[DataFrame, DataFrame]:
    """One square crop per tile; boxes are shifted and clipped, those with less than `min_ratio` of
    their area inside are discarded.

    The side is drawn between the bounds, the upper one held to the shorter tile side; a tile shorter
    than `min_side` stays whole. `tiles` has `width, height`. Returns (tiles, boxes).
    """
    short = F.least("width", "height")
    high = F.least(F.lit(max_side), short)
    fits = short >= min_side

    def pick(low, span, n):
        return (low + F.floor(draw(seed * 8 + n, tile_col) * (span + 1))).cast("long")

    drawn = tiles.withColumn("_side", pick(F.lit(min_side), high - min_side, 0))
    drawn = drawn.withColumns({
        "crop_x": F.when(fits, pick(F.lit(0), F.col("width") - F.col("_side"), 1)).otherwise(0),
        "crop_y": F.when(fits, pick(F.lit(0), F.col("height") - F.col("_side"), 2)).otherwise(0),
        "crop_w": F.when(fits, F.col("_side")).otherwise(F.col("width")),
        "crop_h": F.when(fits, F.col("_side")).otherwise(F.col("height"))}).drop("_side")
    windows = drawn.select(tile_col, "crop_x", "crop_y", "crop_w", "crop_h")
    placed = boxes.join(windows, tile_col)
    b = B.box()
    w = (F.col("crop_x").cast("double"), F.col("crop_y").cast("double"),
         (F.col("crop_x") + F.col("crop_w")).cast("double"),
         (F.col("crop_y") + F.col("crop_h")).cast("double"))
    inside = placed.filter((B.area(b) > 0) & (B.inter_area(b, w) > 0) & (B.ioa(b, w) >= min_ratio))
    c = B.clip(b, w)
    moved = inside.withColumns({
        "x0": c["x0"] - w[0], "y0": c["y0"] - w[1], "x1": c["x1"] - w[0], "y1": c["y1"] - w[1]})
    return drawn, moved.select(*boxes.columns)


def resize_up(df: DataFrame, min_size: int) -> DataFrame:
    """New size of an image whose shorter side must reach `min_size`; larger ones stay."""
    short = F.least("width", "height")
    scale = F.greatest(F.lit(1.0), F.lit(float(min_size)) / short)
    return df.withColumns({
        "new_width": F.when(scale == 1.0, F.col("width")).otherwise(
            F.floor(F.col("width") * scale)).cast("int"),
        "new_height": F.when(scale == 1.0, F.col("height")).otherwise(
            F.floor(F.col("height") * scale)).cast("int")})


def resize_within(df: DataFrame, min_size: int, max_size: int) -> DataFrame:
    """New size with the shorter side at least `min_size` and the longer at most `max_size`.

    When both cannot hold, the longer side decides. Halves are rounded to even.
    """
    short, long = F.least("width", "height"), F.greatest("width", "height")
    up, down = F.lit(float(min_size)) / short, F.lit(float(max_size)) / long
    scale = (F.when((short < min_size) & (long * up <= max_size), up)
             .when((short < min_size) | (long > max_size), down).otherwise(1.0))
    return df.withColumns({
        "new_width": F.rint(F.col("width") * scale).cast("int"),
        "new_height": F.rint(F.col("height") * scale).cast("int")})
