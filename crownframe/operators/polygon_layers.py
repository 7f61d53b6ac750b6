"""Dissolve and overlay of polygon layers.

Polygons are cut into the cells of one grid (`fragments`), the faces of each cell are found in the task that holds it, and
what it hands on are areas, open paths of face borders and sides on the cell's own border. Sides of two neighbouring cells
that lie on each other go out, paths meet over the cells' borders, and each face's rings are put together in its own row.
No task holds more than a cell's polygons, two cells' common border or one resulting face.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownframe.functions import boxes as B
from crownframe.functions import faces as P
from crownframe.functions import rings as R
from crownframe.functions import sweep
from crownframe.functions.batches import whole_groups
from crownframe.operators.dissolve import connected
from crownframe.operators.fragments import cell_box, edges_in, edges_of
from crownframe.operators.spatial_join import HIGHEST, LOWEST, cell_side, grid_level
from crownframe.session import cut, release

PATH, SIDE, AREA, LINK = 0, 1, 2, 3
_RINGS = T.ArrayType(T.ArrayType(T.DoubleType()))
_FOUND = T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("_key", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in ("a", "b", "at")], T.StructField("axis", T.IntegerType()),
    T.StructField("side", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in ("line", "p0", "p1", "area")],
    T.StructField("path", T.ArrayType(T.DoubleType()))])
_ARROW = pa.schema([("kind", pa.int32()), ("_key", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("at", pa.int64()),
                    ("axis", pa.int32()), ("side", pa.int32()), ("line", pa.float64()), ("p0", pa.float64()),
                    ("p1", pa.float64()), ("area", pa.float64()), ("path", pa.list_(pa.float64()))])


def default_level(shapes: DataFrame) -> int:
    """The grid level whose cells hold about a dozen shapes of middling size beside each other."""
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    middling = shapes.select(F.percentile_approx(side, 0.5).alias("m")).first()["m"] or 1.0
    return int(min(max(np.ceil(np.log(4 * middling) / np.log(4)), LOWEST), HIGHEST))


def cells(shapes: DataFrame, columns: Sequence[str], level: int | None = None) -> DataFrame:
    """The edges of each polygon (`columns`, `rings`) in each cell it reaches: `columns`, cx, cy, edges and the cell's box.

    A polygon larger than a cell is cut into 16 parts at a time, so no step carries all its edges to all its cells.
    """
    columns = list(columns)
    placed = shapes.filter(F.size("rings") > 0).select(*columns, "rings", *[c.alias(n) for n, c in R.envelope(F.col("rings")).items()])
    placed = placed.filter("x0 is not null")
    level = default_level(placed) if level is None else level
    start = placed.select(*columns, F.greatest(grid_level(B.box()), F.lit(level)).alias("level"), edges_of("rings").alias("edges"), *B.BOX)
    side = cell_side(F.col("level"))
    span = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / side), F.floor(F.col(hi) / side)))
    start = start.withColumn("cx", span("x0", "x1")).withColumn("cy", span("y0", "y1"))
    held = [*columns, "level", "cx", "cy", "edges"]

    def clipped(some: DataFrame) -> DataFrame:
        boxed = some.select(*held).withColumns(cell_box(F.col("level"), F.col("cx"), F.col("cy")))
        return boxed.withColumn("edges", edges_in("edges", *B.BOX)).filter(F.size("edges") > 0)

    now, done = cut(clipped(start), "cells"), None
    four = F.array(*[F.lit(i) for i in range(4)])
    while True:
        ready = now.filter(F.col("level") == level).drop("level")
        done = ready if done is None else done.unionByName(ready)
        rest = now.filter(F.col("level") > level)
        if rest.isEmpty():
            return done
        finer = rest.select(*columns, (F.col("level") - 1).alias("level"), F.col("cx") * 4, F.col("cy") * 4, "edges").toDF(
            *held).withColumn("_i", F.explode(four)).withColumn("_j", F.explode(four))
        now = cut(clipped(finer.withColumns({"cx": F.col("cx") + F.col("_i"), "cy": F.col("cy") + F.col("_j")})), "cells")


def _found(kind: int, n: int, **columns) -> pa.RecordBatch:
    made = {"kind": pa.array(np.full(n, kind), pa.int32()), **columns}
    return pa.RecordBatch.from_arrays([
        made[f.name].cast(f.type) if f.name in made else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)


def _paths(key: Sequence, a: Sequence, b: Sequence, paths: Sequence) -> pa.RecordBatch:
    return _found(PATH, len(key), _key=pa.array(key, pa.string()), a=pa.array(a, pa.int64()), b=pa.array(b, pa.int64()),
                  path=pa.array([[v for p in path for v in p] for path in paths], pa.list_(pa.float64())))


def _faces(merge: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, group in whole_groups(batches, ("_key", "cx", "cy"), 512):
            s = sweep.from_flat(b.column("edges"))
            ids, layer = (np.asarray(b.column(c)) for c in ("id", "layer"))
            s = sweep.Segments(group[s.row], s.row, s.xy)           # a shape is a row
            first = np.flatnonzero(np.diff(group, prepend=-1))      # a row of each cell
            box = np.stack([np.asarray(b.column(c)) for c in B.BOX], 1)[first]
            found = P.faces(s, layer[s.shape], box, merge)
            keys = np.asarray(b.column("_key").to_numpy(zero_copy_only=False))[first]
            cx, cy = (np.asarray(b.column(c))[first] for c in ("cx", "cy"))

            def names(label, name):
                if merge:
                    return pa.array(ids[name]), pa.nulls(len(name), pa.int64())
                many = int(s.shape.max(initial=0)) + 2
                parts = [label // many - 1, label % many - 1]
                return tuple(pa.array(ids[np.maximum(v, 0)], mask=v < 0) for v in parts)

            cell, label, name, area = found.areas
            a, c = names(label, name)
            yield _found(AREA, len(area), _key=pa.array(keys[cell]), a=a, b=c, area=pa.array(area))
            cell, label, name, axis, line, p0, p1, side = found.borders
            a, c = names(label, name)
            yield _found(SIDE, len(cell), _key=pa.array(keys[cell]), a=a, b=c, at=pa.array(np.where(axis == P.UPRIGHT, cy[cell], cx[cell])),
                         axis=pa.array(axis), side=pa.array(side), line=pa.array(line), p0=pa.array(p0), p1=pa.array(p1))
            if len(found.pairs):
                yield _found(LINK, len(found.pairs), _key=pa.array(keys[group[found.pairs[:, 0]]]),
                             a=pa.array(ids[found.pairs[:, 0]]), b=pa.array(ids[found.pairs[:, 1]]))
            cell, label, name, xy = found.edges
            a, c = (x.to_pylist() for x in names(label, name))
            order = np.lexsort((label, cell))
            ends = np.flatnonzero(np.append((np.diff(cell[order]) != 0) | (np.diff(label[order]) != 0), True)) + 1 if len(order) else []
            out, start = ([], [], [], []), 0
            for end in ends:
                mine = order[start:end]
                start = end
                for path, closed in [(p, c_) for c_, ps in zip((True, False), P.chained(
                        [((x0, y0), (x1, y1)) for x0, y0, x1, y1 in xy[mine].tolist()])) for p in ps]:
                    for column, v in zip(out, (keys[cell[mine[0]]], a[mine[0]], c[mine[0]], [*path, path[0]] if closed else path)):
                        column.append(v)
            yield _paths(*out)

    return run


def _netted(columns: Sequence[str], merge: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, group in whole_groups(batches, columns, 4096):
            c = {n: b.column(n).to_numpy(zero_copy_only=False) for n in ("_key", "axis", "line", "p0", "p1", "side")}
            left, pairs = P.netted(P.Sides(group, c["p0"], c["p1"], c["side"], np.arange(b.num_rows)))
            ids, other = b.column("a"), b.column("b")
            edges = P.directed(c["axis"][left.name], c["line"][left.name], left.p0.tolist(), left.p1.tolist(), left.side)
            yield _paths(c["_key"][left.name], ids.take(pa.array(left.name)), other.take(pa.array(left.name)), edges)
            if merge and len(pairs):
                yield _found(LINK, len(pairs), _key=pa.array(c["_key"][pairs[:, 0]]), a=ids.take(pa.array(pairs[:, 0])),
                             b=ids.take(pa.array(pairs[:, 1])))

    return run


@F.arrow_udf(_RINGS)
def joined_paths(paths: pa.Array) -> pa.Array:
    """The rings that a face's paths make."""
    out = []
    for some in paths.to_pylist():
        rings, _ = P.chained([list(zip(p[0::2], p[1::2])) for p in some])
        out.append([[v for p in r for v in p] for r in rings])
    return pa.array(out, pa.list_(pa.list_(pa.float64())))


def _subdivided(layers: DataFrame, level: int | None, merge: bool) -> DataFrame:
    """All rows the cells hand on, sides already netted, from (_key, layer, id, rings)."""
    parts = cells(layers, ["_key", "layer", "id"], level)
    near = parts.repartition("_key", "cx", "cy").sortWithinPartitions("_key", "cx", "cy")
    found = cut(near.mapInArrow(_faces(merge), _FOUND), "faces")
    by = ["_key", "axis", "line", "at", *([] if merge else ["a", "b"])]
    sides = found.filter(F.col("kind") == SIDE)
    if not merge:      # a missing id is a value of its own here
        sides = sides.withColumns({c: F.coalesce(c, F.lit(-1 << 62)) for c in "ab"})
    sides = sides.repartition(*by).sortWithinPartitions(*by).mapInArrow(_netted(by, merge), _FOUND)
    if not merge:
        sides = sides.withColumns({c: F.nullif(F.col(c), F.lit(-1 << 62)) for c in "ab"})
    return cut(found.filter(F.col("kind") != SIDE).unionByName(sides), "faces")


def _keyed(df: DataFrame, keys: Sequence[str], id_col: str, layer: int) -> DataFrame:
    return df.select(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("_key"), F.lit(layer).alias("layer"),
                     F.col(id_col).cast("long").alias("id"), "rings")


def _assembled(found: DataFrame, by: Sequence[str], like: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per face: keys, `by`, area and rings."""
    faces = found.groupBy("_key", *by).agg(F.sum("area").alias("area"), F.collect_list("path").alias("_paths"))
    kind = T.StructType([like.schema[k] for k in keys])
    return faces.withColumn("rings", joined_paths("_paths")).select(
        *[F.from_json("_key", kind)[k].alias(k) for k in keys], *by, "area", "rings")


def dissolve_polygons(shapes: DataFrame, id_col: str, keys: Sequence[str] = ("product_id",), level: int | None = None) -> DataFrame:
    """Union of all polygons, split into connected parts: keys, `component` (the lowest id in it), area, rings.

    Shapes (keys, id, `rings`) are connected if they share ground or part of a border; a shape of several rings is one
    shape, read by the even-odd rule. Shapes without area are left out. `level` sets the grid's cells.
    """
    keys = list(keys)
    found = _subdivided(_keyed(shapes, keys, id_col, 0), level, True)
    names = found.filter(F.col("kind") == AREA).select("_key", F.col("a").alias("id")).unionByName(
        found.filter(F.col("kind") == LINK).select("_key", F.col("a").alias("id"))).distinct()
    links = found.filter(F.col("kind") == LINK).select("_key", F.col("a").alias("u"), F.col("b").alias("v"))
    parts = cut(connected(names, links, ["_key"]).withColumnRenamed("id", "a"), "components")
    rows = found.filter(F.col("kind").isin(AREA, PATH)).join(parts, ["_key", "a"])
    out = cut(_assembled(rows, ["component"], shapes, keys), "dissolved")
    release(found, parts)
    return out


def overlay_polygons(a: DataFrame, b: DataFrame, a_id: str = "a_id", b_id: str = "b_id",
                     keys: Sequence[str] = ("product_id",), level: int | None = None) -> DataFrame:
    """Pieces of two polygon layers: keys, both ids (null where a layer has nothing), area, rings.

    Shapes of one layer are taken not to share ground with each other. Pieces are disjoint and cover both layers.
    """
    keys = list(keys)
    both = _keyed(a, keys, a_id, 0).unionByName(_keyed(b, keys, b_id, 1))
    found = _subdivided(both, level, False)
    pieces = _assembled(found.filter(F.col("kind").isin(AREA, PATH)), ["a", "b"], a, keys)
    return pieces.select(*keys, F.col("a").alias(a_id), F.col("b").alias(b_id), "area", "rings")
