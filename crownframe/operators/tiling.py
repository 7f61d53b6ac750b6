"""Tile grids and the assignment of objects to tiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownframe.functions import boxes as B
from crownframe.operators.fragments import aoi_package
from crownframe.operators.masks import CELLS, _coded, _decoded, _pieces, _spread, plain_arrays, whole_masks
from crownframe.operators.numbering import dense_index, row_index
from crownframe.operators.spatial_join import bbox_join


def grid_step(size: int, overlap: float) -> int:
    step = int(size * (1 - overlap))
    if step <= 0:
        raise ValueError("the overlap must be below 1")
    return step


def tile_grid(rasters: DataFrame, size: int, overlap: float, width: str = "width",
              height: str = "height") -> DataFrame:
    """Overlapping square tiles `col, row, px0, py0, px1, py1` per raster.

    The last tile of a row or column is moved back to the raster's edge; a raster smaller than one
    tile gets a single tile from the origin.
    """
    step = grid_step(size, overlap)

    def steps(length):
        n = F.greatest(F.ceil((F.col(length) - size) / step), F.lit(0))
        return F.sequence(F.lit(0).cast("long"), n)

    def start(index, length):
        return F.greatest(F.least(F.col(index) * step, F.col(length) - size), F.lit(0)).cast("double")

    grid = rasters.withColumn("col", F.explode(steps(width))).withColumn(
        "row", F.explode(steps(height)))
    placed = grid.withColumns({"px0": start("col", width), "py0": start("row", height)})
    return placed.withColumns({
        "col": F.col("col").cast("int"), "row": F.col("row").cast("int"),
        "px1": F.col("px0") + size, "py1": F.col("py0") + size})


def resample_window(tiles: DataFrame, raster_gsd: Column | float,
                    ground_resolution: float | None = None,
                    scale_factor: float | None = None) -> DataFrame:
    """Source window `sx0..sy1` of tiles cut on a resampled raster.

    Exactly one of the two targets: a ground resolution per pixel or a factor on the pixel count.
    """
    if (ground_resolution is None) == (scale_factor is None):
        raise ValueError("give either a ground resolution or a scale factor")
    gsd = raster_gsd if isinstance(raster_gsd, Column) else F.lit(float(raster_gsd))
    ratio = (F.lit(float(ground_resolution)) / gsd if ground_resolution is not None
             else F.lit(1.0 / scale_factor))
    return tiles.withColumns({f"s{c[1:]}": F.col(c) * ratio for c in ("px0", "py0", "px1", "py1")})


def _tile_boxes(tiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    return tiles.select(*keys, "col", "row", *[
        F.col(p).alias(b) for p, b in zip(("px0", "py0", "px1", "py1"), B.BOX)])


def labeled_tiles(objects: DataFrame, tiles: DataFrame, id_col: str = "object_id",
                  min_ratio: float = 0.4, keys: Sequence[str] = ("product_id",),
                  keep_unlabeled: bool = False) -> tuple[DataFrame, DataFrame]:
    """Labels per tile with at least `min_ratio` of the object inside, cropped and shifted.

    Returns (tiles, labels). Tiles without a label are dropped unless `keep_unlabeled`; tiles get
    `tile_id` and labels `label_id`, both dense from 1 in (raster, row, col) order.
    """
    keys = list(keys)
    pairs = bbox_join(objects.select(*keys, id_col, *B.BOX), _tile_boxes(tiles, keys), keys)
    a, b = B.box("a_"), B.box("b_")
    crop = B.clip(a, b)
    labels = pairs.filter(B.ioa(a, b) >= min_ratio).select(
        *keys, F.col("b_col").alias("col"), F.col("b_row").alias("row"),
        F.col(f"a_{id_col}").alias(id_col),
        (crop["x0"] - b[0]).alias("x0"), (crop["y0"] - b[1]).alias("y0"),
        (crop["x1"] - b[0]).alias("x1"), (crop["y1"] - b[1]).alias("y1"),
        B.inter_area(a, b).alias("area"))
    return _numbered(tiles, labels, id_col, keys, keep_unlabeled)


def _numbered(tiles: DataFrame, labels: DataFrame, id_col: str, keys: list[str],
              keep_unlabeled: bool) -> tuple[DataFrame, DataFrame]:
    place = [*keys, "row", "col"]
    if not keep_unlabeled:      # the tiles are those of the labels, so both numbers come from one sort
        labels = dense_index(labels, place, [F.col(id_col)], "label_id", "tile_id")
        named = labels.select(*place, "tile_id").distinct()
        return tiles.join(named, place).select(*tiles.columns, "tile_id"), labels
    kept = row_index(tiles, [], [F.col(c) for c in place], "tile_id", start=1)
    labels = labels.join(kept.select(*place, "tile_id").hint("merge"), place)
    labels = row_index(labels, [], [F.col(c) for c in (*place, id_col)], "label_id", start=1)
    return kept, labels


def _tiles_of(low: np.ndarray, high: np.ndarray, length: np.ndarray, size: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The tiles of `tile_grid` along one axis that share pixels low to high (excluded): the position of a range, and a tile's index."""
    last = np.maximum(-((size - length) // step), 0)
    first = np.maximum((low - size) // step + 1, 0)
    upto = np.minimum((high - 1) // step, last - 1)
    end = np.maximum(length - size, 0)                          # where the last tile starts
    regular = np.maximum(upto - first + 1, 0)
    count = regular + ((high > end) & (low < end + size))
    i, k = _spread(count)
    return i, np.where(k < regular[i], first[i] + k, last[i])


def _cropped(ids: Sequence[str], size: int, step: int, min_ratio: float):
    """From whole masks with `width, height` of their raster: a row per tile that holds enough of the mask, with what is in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, (line, c0, wide) = _decoded(b.column("shape"), 3, "<i4") if b.num_rows else (np.zeros(0, np.int64), [np.zeros(0, np.int64)] * 3)
            width, height, whole = (np.asarray(b.column(c)) for c in ("width", "height", "area"))
            inside = (c0 >= 0) & (line >= 0) & (line < height[of]) & (c0 < width[of])
            of, line, c0, wide = (v[inside] for v in (of, line, c0, wide))
            c1 = np.minimum(c0 + wide, width[of])
            ends = np.searchsorted(of, np.arange(b.num_rows + 1))
            # A run lies in no more tiles than this; masks are worked on whole.
            most = np.append((size // step + 2) * ((c1 - c0) // step + size // step + 2), 0)
            for first, last in _pieces(np.add.reduceat(most, ends[:-1]) * (np.diff(ends) > 0) if b.num_rows else np.zeros(0, np.int64), CELLS):
                some = slice(ends[first], ends[last])
                i, row = _tiles_of(line[some], line[some] + 1, height[of[some]], size, step)
                i += ends[first]
                j, col = _tiles_of(c0[i], c1[i], width[of[i]], size, step)
                i, row = i[j], row[j]
                left, top = (np.maximum(np.minimum(k * step, n[of[i]] - size), 0) for k, n in ((col, width), (row, height)))
                y, x0, x1, mask = line[i] - top, np.maximum(c0[i] - left, 0), np.minimum(c1[i] - left, size), of[i]
                order = np.lexsort((x1, x0, y, col, row, mask))
                mask, row, col, y, x0, x1 = (v[order] for v in (mask, row, col, y, x0, x1))
                heads = np.flatnonzero((np.diff(mask, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0) | (np.diff(col, prepend=-1) != 0))
                if not len(heads):
                    continue
                area = np.add.reduceat(x1 - x0, heads)
                keep = pa.array(area >= min_ratio * whole[mask[heads]])
                at = pa.array(mask[heads])
                box = (np.minimum.reduceat(x0, heads), y[heads], np.maximum.reduceat(x1, heads), np.maximum.reduceat(y, heads) + 1)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c).take(at) for c in ids], *[pa.array(v[heads].astype(np.int32)) for v in (row, col)], pa.array(area),
                     *[pa.array(v.astype(np.int32)) for v in box], _coded([y, x0, x1 - x0], heads, "<i4")],
                    names=[*ids, "row", "col", "area", *B.BOX, "runs"]).filter(keep)

    return run


def labeled_tile_masks(runs: DataFrame, rasters: DataFrame, size: int, overlap: float,
                       id_col: str = "object_id", min_ratio: float = 0.4, keys: Sequence[str] = ("product_id",),
                       keep_unlabeled: bool = False) -> tuple[DataFrame, DataFrame]:
    """`labeled_tiles` for masks: labels where at least `min_ratio` of the mask's pixels are in the tile.

    `runs` are keys, id, line, c0, c1 without overlap within a mask; `rasters` have keys, width and height. The tiles are
    those of `tile_grid`. Runs come together by mask, packed, and each mask finds its tiles by arithmetic, so nothing is joined in space. Labels have the mask
    cropped and shifted (`runs`: line, c0, c1 in order), its tight box x0..y1 and its pixels as `area`.
    """
    keys = list(keys)
    step = grid_step(size, overlap)
    ids = [*keys, id_col]
    # All pixels of a mask count, also those of runs that are on no line. Packed masks shuffle so small that Spark would
    # broadcast a side by its shuffled bytes, many times that in memory.
    whole = runs.filter("c1 > c0").groupBy(*ids).agg(F.sum(F.col("c1") - F.col("c0")).alias("area"))
    masks = whole_masks(runs.select(*ids, "line", "c0", "c1"), ids).drop("area").join(whole.hint("merge"), ids)
    # A row per raster. Without the hint Spark may broadcast the masks, whose size it takes from before they were exploded.
    masks = masks.join(F.broadcast(rasters.select(*keys, F.col("width").cast("long"), F.col("height").cast("long"))), keys)
    number = T.IntegerType()
    kind = T.StructType([*[masks.schema[c] for c in ids], *[T.StructField(c, number) for c in ("row", "col")], T.StructField("area", T.LongType()),
                         *[T.StructField(c, number) for c in B.BOX], T.StructField("runs", T.BinaryType())])
    labels = masks.select(*ids, "area", "shape", "width", "height").mapInArrow(_cropped(ids, size, step, min_ratio), kind)
    tiles, labels = _numbered(tile_grid(rasters, size, overlap), labels, id_col, keys, keep_unlabeled)
    return tiles, plain_arrays(labels)


def polygon_tiles(objects: DataFrame, size: int | None = None, buffer: int = 5) -> DataFrame:
    """One square window per object, centred on its box.

    With `size` the window has that side; without, its side is the longer box side plus `buffer`
    pixels on both ends. Corners are whole pixels.
    """
    b = B.box()
    cx, cy = B.center(b)
    if size is not None:
        side = F.lit(float(size))
    else:
        side = F.ceil(F.greatest(b[2] - b[0], b[3] - b[1])) + 2 * buffer
    left, top = F.floor(cx - side / 2), F.floor(cy - side / 2)
    return objects.withColumns({
        "px0": left.cast("double"), "py0": top.cast("double"),
        "px1": (left + side).cast("double"), "py1": (top + side).cast("double")})


def aoi_split(tiles: DataFrame, mode: str | None = None, aoi: DataFrame | None = None,
              bands: Sequence[tuple[str, float, int]] = (("infer", 1.0, 1),),
              height: str = "height", keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """Name the AOI of each tile in a column `aoi`.

    No mode: the whole raster is `infer`. `generate`: horizontal bands as (name, share, position),
    a tile belongs to the band that holds its centre. `package`: `aoi` has keys, `aoi` and a box or
    `rings`; a tile gets one row per AOI that it shares ground with.
    """
    if mode is None:
        return tiles.withColumn("aoi", F.lit("infer"))
    if mode == "generate":
        at = (F.col("py0") + F.col("py1")) / 2 / F.col(height)
        name, reach = F.lit(None).cast("string"), 0.0
        edges = []
        for label, share, _ in sorted(bands, key=lambda v: v[2]):
            reach = round(reach + share, 12)
            edges.append((label, reach))
        for label, edge in reversed(edges):
            inside = at <= edge if label == edges[-1][0] else at < edge
            name = F.when(inside, label).otherwise(name)
        return tiles.withColumn("aoi", name).filter(F.col("aoi").isNotNull())
    if mode == "package":
        if aoi is None:
            raise ValueError("mode 'package' needs AOI boxes or polygons")
        keys = list(keys)
        if "rings" in aoi.columns:
            return aoi_package(tiles, aoi, keys)
        hits = bbox_join(_tile_boxes(tiles, keys), aoi.select(*keys, "aoi", *B.BOX), keys)
        names = hits.select(*keys, F.col("a_col").alias("col"), F.col("a_row").alias("row"),
                            F.col("b_aoi").alias("aoi")).distinct()
        return tiles.join(names, [*keys, "col", "row"])
    raise ValueError(f"unknown AOI mode {mode!r}")


def crs_check(raster_epsg: int | None, objects: DataFrame, crs_col: str = "crs_epsg") -> None:
    """Raise when only one of raster and objects has a coordinate system."""
    epsg = objects.agg(F.max(crs_col)).first()[0] if crs_col in objects.columns else None
    if raster_epsg is not None and epsg is None:
        raise ValueError("the raster has a CRS but the objects do not")
    if raster_epsg is None and epsg is not None:
        raise ValueError("the raster has no CRS but the objects do")


def crs_mismatches(rasters: DataFrame, objects: DataFrame, key: str = "product_id",
                   crs_col: str = "crs_epsg") -> DataFrame:
    """Rasters where exactly one side has a coordinate system: `(key, problem)`."""
    have = objects.groupBy(key).agg(F.max(crs_col).alias("_objects"))
    both = rasters.select(key, F.col(crs_col).alias("_raster")).join(have, key)
    problem = F.when(F.col("_raster").isNotNull() & F.col("_objects").isNull(),
                     "objects have no CRS").when(
        F.col("_raster").isNull() & F.col("_objects").isNotNull(), "raster has no CRS")
    return both.select(key, problem.alias("problem")).filter("problem is not null")
