"""Polygons cut into grid cells.

A polygon's part in a cell is kept as its edges there: what lies beside the cell is moved onto its left or right
border, so parity still tells inside from outside. A cell that no edge crosses is wholly inside and needs no geometry, or
wholly outside and is dropped. Cells are squares of 4**level whose corners are multiples of their side.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownframe.functions import boxes as B
from crownframe.functions import rings as R
from crownframe.functions import sweep
from crownframe.functions.polygons import even_odd_area
from crownframe.operators.spatial_join import LOWEST, bbox_join, cell_side, grid_level
from crownframe.session import cut

#: Edges that a cell may hold before it is cut again, and levels a cell of a polygon's border is cut in any case.
EDGES, DEPTH = 32, 3
#: A share this little below the least one counts as equal to it: shares of polygons are sums of rounded parts.
ROUNDING = 1e-9
_EDGES = T.ArrayType(T.DoubleType())


@F.arrow_udf(_EDGES)
def edges_of(rings: pa.Array) -> pa.Array:
    """The upward edges of rings, four numbers each."""
    return sweep.flat(len(rings), sweep.segments(rings, 0))


@F.arrow_udf(_EDGES)
def edges_in(edges: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    """The edges of a shape's part in a cell."""
    cell = np.stack([np.asarray(c, float) for c in (x0, y0, x1, y1)], 1)
    return sweep.flat(len(edges), sweep.without_pairs(sweep.clamped(sweep.from_flat(edges), cell)))


# A filter on what it gives must not work it out a second time, below the projection.
edges_in = edges_in.asNondeterministic()


def is_whole(b) -> Column:
    """Whether `edges` bound the whole cell: its left and right border and nothing else."""
    e = F.col("edges")
    upright = lambda at, x: (e[at] == x) & (e[at + 1] == b[1]) & (e[at + 2] == x) & (e[at + 3] == b[3])
    return (F.size(e) == 8) & ((upright(0, b[0]) & upright(4, b[2])) | (upright(4, b[0]) & upright(0, b[2])))


def edge_rings(edges: Column, x0: Column) -> Column:
    """Rings that bound the same ground by the even-odd rule: each edge with its shadow on the left border of the cell."""
    at = F.sequence(F.lit(0), (F.size(edges) / 4 - 1).cast("int"))
    quad = F.transform(at, lambda i: F.array(
        edges[4 * i], edges[4 * i + 1], edges[4 * i + 2], edges[4 * i + 3], x0, edges[4 * i + 3], x0, edges[4 * i + 1]))
    return F.filter(quad, lambda q: (q[0] != x0) | (q[2] != x0))


def cell_box(level: Column, cx: Column, cy: Column) -> dict[str, Column]:
    side = cell_side(level)
    return {"x0": cx * side, "y0": cy * side, "x1": (cx + 1) * side, "y1": (cy + 1) * side}


def pieces(shapes: DataFrame, columns: Sequence[str], depth: int = DEPTH) -> DataFrame:
    """Disjoint pieces of each polygon (`columns`, `rings`): `columns`, a box, and `rings`, null where the box is whole.

    A polygon starts in the one to four cells that are as long as it is. Cells on its border are cut into 16, `depth` times
    and then on as long as they hold more than `EDGES` edges, all of them in one step per level.
    """
    columns = list(columns)
    placed = shapes.filter(F.size("rings") > 0).select(*columns, "rings", *[c.alias(n) for n, c in R.envelope(F.col("rings")).items()])
    level = grid_level(B.box())
    side = cell_side(F.col("level"))
    span = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / side), F.floor(F.col(hi) / side)))
    start = (placed.filter("x0 is not null").select(*columns, level.alias("level"), level.alias("top"), edges_of("rings").alias("edges"), *B.BOX)
             .withColumn("cx", span("x0", "x1")).withColumn("cy", span("y0", "y1")))
    held = [*columns, "level", "top", "cx", "cy", "edges"]

    def clipped(cells: DataFrame) -> DataFrame:
        boxed = cells.select(*held).withColumns(cell_box(F.col("level"), F.col("cx"), F.col("cy")))
        part = boxed.withColumn("edges", edges_in("edges", *B.BOX)).filter(F.size("edges") > 0)
        return part.withColumn("whole", is_whole(B.box()))

    now, done = cut(clipped(start), "cells"), None
    n = F.size("edges") / 4
    while True:
        open_ = ~F.col("whole") & (F.col("level") > LOWEST) & ((F.col("level") > F.col("top") - depth) | (n > EDGES))
        ready = now.filter(~open_).select(*columns, *B.BOX, F.when(~F.col("whole"), edge_rings(F.col("edges"), F.col("x0"))).alias("rings"))
        done = ready if done is None else done.unionByName(ready)
        rest = now.filter(open_)
        if rest.isEmpty():
            return done
        four = F.array(*[F.lit(i) for i in range(4)])
        finer = rest.select(*columns, (F.col("level") - 1).alias("level"), "top", F.col("cx") * 4, F.col("cy") * 4, "edges").toDF(
            *held).withColumn("_i", F.explode(four)).withColumn("_j", F.explode(four))
        now = cut(clipped(finer.withColumns({"cx": F.col("cx") + F.col("_i"), "cy": F.col("cy") + F.col("_j")})), "cells")


_PART = T.StructType([T.StructField(c, T.DoubleType()) for c in ("area", *B.BOX)])


@F.arrow_udf(_PART)
def common_part(a: pa.Array, b: pa.Array) -> pa.Array:
    """Area and bounds of what two shapes share; bounds are null without area."""
    area, bounds = sweep.shared_parts(len(a), [a, b])
    none = pa.array(area <= 0)
    return pa.StructArray.from_arrays(
        [pa.array(area), *[pc.if_else(none, None, pa.array(c)) for c in bounds.T]], names=["area", *B.BOX])


def aoi_parts(objects: DataFrame, aoi: DataFrame, id_col: str, keys: Sequence[str] = ("product_id",),
              aoi_id: str = "aoi") -> DataFrame:
    """What each object has in each AOI polygon: keys, id, AOI id, `area`, its bounds and `clip`, the polygon's rings there.

    `objects` have boxes, or `rings` with their envelope. `aoi` has keys, `aoi_id` and `rings`.
    """
    keys = list(keys)
    shaped = "rings" in objects.columns
    thin = objects.select(*keys, id_col, *B.BOX, *(["rings"] if shaped else []))
    found = bbox_join(thin, cut(pieces(aoi.select(*keys, aoi_id, "rings"), [*keys, aoi_id]), "aoi-pieces"), keys)
    a, b = B.box("a_"), B.box("b_")
    inner = B.clip(a, b)
    native = F.col("b_rings").isNull() & F.lit(not shaped)     # two boxes need no sweep
    own = F.when(~native, F.col("a_rings") if shaped else R.box_ring(*a))
    there = F.when(~native, F.coalesce("b_rings", R.box_ring(*b)))
    swept = found.withColumns({"_own": own, "_there": there}).withColumn("_p", common_part("_own", "_there"))
    parts = swept.select(
        *keys, F.col(f"a_{id_col}").alias(id_col), F.col(f"b_{aoi_id}").alias(aoi_id),
        F.when(native, B.inter_area(a, b)).otherwise(F.col("_p.area")).alias("area"),
        *[F.when(native, inner[c]).otherwise(F.col(f"_p.{c}")).alias(c) for c in B.BOX],
        F.coalesce("b_rings", R.box_ring(*b)).alias("clip")).filter("area > 0")
    return parts.groupBy(*keys, id_col, aoi_id).agg(
        F.sum("area").alias("area"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"),
        F.max("y1").alias("y1"), F.flatten(F.collect_list("clip")).alias("clip"))


def aoi_polygon_filter(objects: DataFrame, aoi: DataFrame, id_col: str, min_frac: float = 0.4,
                       keys: Sequence[str] = ("product_id",), aoi_id: str = "aoi") -> DataFrame:
    """`aoi_filter` for AOI polygons: objects with at least `min_frac` of their area inside all AOI polygons, a row per
    polygon they reach into. The box becomes that of the part inside, `_area` its area and `clip` the polygon around it.

    AOI polygons of a key don't overlap each other; those that do go through `polygon_layers.dissolve_polygons` first.
    """
    keys = list(keys)
    if "rings" in objects.columns:
        objects = cut(objects, "objects")        # outlines are read twice, and by Python functions that take plain columns
    parts = cut(aoi_parts(objects, aoi, id_col, keys, aoi_id), "aoi-parts")
    size = even_odd_area("rings") if "rings" in objects.columns else B.area(B.box())
    whole = objects.select(*keys, id_col, size.alias("_own")).filter("_own > 0")
    inside = parts.groupBy(*keys, id_col).agg(F.sum("area").alias("_in")).join(whole, [*keys, id_col]).filter(
        F.col("_in") / F.col("_own") >= min_frac - ROUNDING).select(*keys, id_col)
    kept = parts.join(inside, [*keys, id_col], "left_semi").withColumnRenamed("area", "_area")
    rest = objects.drop(*B.BOX, aoi_id)
    return kept.join(rest, [*keys, id_col])


def aoi_package(tiles: DataFrame, aoi: DataFrame, keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """One row per tile and AOI polygon (keys, `aoi`, `rings`) that share some ground."""
    keys = list(keys)
    place = [*keys, "col", "row"]
    boxes = tiles.select(*keys, F.struct("col", "row").alias("_tile"), *[
        F.col(p).alias(b) for p, b in zip(("px0", "py0", "px1", "py1"), B.BOX)])
    hits = aoi_parts(boxes, aoi, "_tile", keys).select(*keys, "_tile.col", "_tile.row", "aoi")
    return tiles.join(hits, place)
