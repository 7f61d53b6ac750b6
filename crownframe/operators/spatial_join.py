"""Box joins through a multi-level grid.

A box lives on the grid level whose cell is at least as long as its longer side (cells grow by a
factor of four per level), so it covers at most four cells there. Boxes of different levels meet on
the grid of the larger one. A pair is reported only in the cell that holds the lower corner of the
intersection, so no `distinct` is needed, and one huge box never multiplies the small ones.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownframe.functions import boxes as B
from crownframe.session import cut

LOWEST, HIGHEST = -8, 24


def grid_level(b) -> Column:
    """Level whose cell side 4**level is at least the longer box side."""
    side = F.greatest(b[2] - b[0], b[3] - b[1], F.lit(4.0 ** LOWEST))
    level = F.ceil(F.log(side) / F.lit(math.log(4.0)))
    return F.least(F.greatest(level, F.lit(LOWEST)), F.lit(HIGHEST)).cast("int")


def levels_of(df: DataFrame) -> list[int]:
    """Grid levels in use: a set of at most 33 small integers."""
    found = df.select(grid_level(B.box()).alias("l")).agg(F.collect_set("l")).first()[0]
    return sorted(found) or [0]


def _levels_of_both(left: DataFrame, right: DataFrame) -> tuple[list[int], list[int]]:
    """The grid levels of two tables, in one pass."""
    sides = [df.select(grid_level(B.box()).alias("l"), F.lit(i).alias("side")) for i, df in enumerate((left, right))]
    rows = sides[0].unionByName(sides[1]).groupBy("side").agg(F.collect_set("l").alias("l")).collect()
    found = {r["side"]: sorted(r["l"]) for r in rows}
    return found.get(0) or [0], found.get(1) or [0]


def cell_side(level: Column) -> Column:
    return F.pow(F.lit(4.0), level)


# Left boxes on their own or a higher level meet right boxes on their own level in role SAME; left
# boxes on their own level meet right boxes on a higher one in role A_LARGER. Two boxes that are both
# on a higher level never meet, so a large box does not bring the small ones together.
SAME, A_LARGER = 0, 1


def place(df: DataFrame, visit_levels: Sequence[int], home: Sequence[int] = (),
          visit: Sequence[int] = ()) -> DataFrame:
    """One row per (box, grid cell): on its own level and on each higher one in `visit_levels`.

    Adds `_level, _cx, _cy, _role` and `_fx, _fy`, which tell whether the cell is the box's first
    one in either direction. `home` and `visit` are the roles given on the own and higher levels.
    """
    b = B.box()

    def slot(level, role):
        return F.struct(level.cast("int").alias("l"), F.lit(role).alias("r"))

    slots = [F.array(slot(F.col("_own"), role)) for role in home]
    for role in visit:
        slots += [F.when(F.col("_own") < v, F.array(slot(F.lit(v), role)))
                  .otherwise(F.array().cast("array<struct<l:int,r:int>>"))
                  for v in sorted(visit_levels)]
    placed = df.withColumn("_own", grid_level(b)).withColumn("_slot", F.explode(F.concat(*slots)))
    side = cell_side(F.col("_slot.l"))
    placed = placed.withColumns({
        "_x0": F.floor(b[0] / side), "_y0": F.floor(b[1] / side),
        "_x1": F.floor(b[2] / side), "_y1": F.floor(b[3] / side)})
    placed = placed.withColumn("_cx", F.explode(F.sequence("_x0", "_x1")))
    placed = placed.withColumn("_cy", F.explode(F.sequence("_y0", "_y1")))
    return placed.select(
        *df.columns, F.col("_slot.l").alias("_level"), "_cx", "_cy", F.col("_slot.r").alias("_role"),
        (F.col("_cx") == F.col("_x0")).alias("_fx"), (F.col("_cy") == F.col("_y0")).alias("_fy"))


def bbox_join(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("product_id",),
              touching: bool = False, extra: Column | None = None,
              left_levels: Sequence[int] | None = None,
              right_levels: Sequence[int] | None = None) -> DataFrame:
    """Pairs of boxes that overlap (or, with `touching`, share a border point).

    Columns come back as `a_*` and `b_*`, the join keys under their own names. `extra` is one more
    condition over those names. Pass thin tables: what they hold is what gets shuffled.
    """
    keys = list(keys)
    if left_levels is None or right_levels is None:
        # What comes before is worked out once; the levels are then read from thin files.
        same = left is right
        left = cut(left, "left")
        right = left if same else cut(right, "right")
        found = _levels_of_both(left, right)
        left_levels, right_levels = (given or own for given, own in zip((left_levels, right_levels), found))
    left_levels, right_levels = list(left_levels), list(right_levels)
    if set(left_levels) == set(right_levels) and len(set(left_levels)) == 1:
        a, b = place(left, [], home=[SAME]), place(right, [], home=[SAME])
    else:
        a = place(left, right_levels, home=[SAME, A_LARGER], visit=[SAME])
        b = place(right, left_levels, home=[SAME], visit=[A_LARGER])
    cell = ["_level", "_cx", "_cy", "_role"]
    firsts = ["_fx", "_fy"]
    a = a.select(*keys, *cell, *[F.col(c).alias(f"a_{c}")
                                 for c in [*left.columns, *firsts] if c not in keys])
    b = b.select(*keys, *cell, *[F.col(c).alias(f"b_{c}")
                                 for c in [*right.columns, *firsts] if c not in keys])
    ba, bb = B.box("a_"), B.box("b_")
    # The cell of the intersection's lower corner is the first cell of one of the two boxes.
    owner = ((F.col("a__fx") | F.col("b__fx")) & (F.col("a__fy") | F.col("b__fy")))
    wanted = (B.touches(ba, bb) if touching else B.overlaps(ba, bb)) & owner
    if extra is not None:
        wanted = wanted & extra
    # The size Spark estimates for an exploded side is the one before the explode, so a broadcast
    # by estimate would not be safe; a sort-merge join spills and lets AQE split a crowded cell.
    pairs = a.join(b.hint("merge"), [*keys, *cell]).filter(wanted)
    return pairs.drop(*cell, *[f"{s}_{f}" for s in "ab" for f in firsts])


def cell_crowds(nodes: DataFrame, keys: Sequence[str], most: int) -> tuple[DataFrame, list[int]]:
    """Grid cells with more than `most` boxes (`keys, _level, _cx, _cy, n`), and the grid levels in use."""
    homes = place(nodes.select(*keys, *B.BOX), [], home=[SAME])
    counts = cut(homes.groupBy(*keys, "_level", "_cx", "_cy").agg(F.count(F.lit(1)).alias("n")), "cells")
    levels = counts.agg(F.collect_set("_level")).first()[0]     # at most 33 small integers
    return counts.filter(F.col("n") > most), sorted(levels) or [0]


def iou_join(left: DataFrame, right: DataFrame, threshold: float,
             keys: Sequence[str] = ("product_id",), epsilon: float = 0.0, **levels) -> DataFrame:
    """Overlapping pairs with `iou >= threshold` (threshold above 0)."""
    pairs = bbox_join(left, right, keys, **levels)
    value = B.iou(B.box("a_"), B.box("b_"), epsilon)
    return pairs.withColumn("iou", value).filter(F.col("iou") >= threshold)


def aoi_filter(objects: DataFrame, aoi: DataFrame, id_col: str, min_frac: float = 0.4,
               keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """Keep objects with at least `min_frac` of their area inside the AOI, then clip to AOI rows.

    `aoi` holds disjoint boxes (overlapping ones go through `dissolve.disjoint_boxes` first). An
    object reaching into two AOI rows comes back as two rows; one without area is dropped.
    """
    keys = list(keys)
    thin = objects.select(*keys, id_col, *B.BOX)
    parts = bbox_join(thin, aoi.select(*keys, *B.BOX), keys)
    a, b = B.box("a_"), B.box("b_")
    parts = parts.select(
        *keys, F.col(f"a_{id_col}").alias(id_col), B.inter_area(a, b).alias("_in"),
        B.area(a).alias("_area"), *[c.alias(f"_{n}") for n, c in B.clip(a, b).items()])
    inside = (parts.groupBy(*keys, id_col)
              .agg(F.sum("_in").alias("_in"), F.first("_area").alias("_area"))
              .filter((F.col("_area") > 0)
                      & (B.zero_div(F.col("_in"), F.col("_area")) >= min_frac))
              .select(*keys, id_col))
    clipped = parts.join(inside, [*keys, id_col], "left_semi").select(
        *keys, id_col, *[F.col(f"_{n}").alias(n) for n in B.BOX])
    rest = objects.drop(*B.BOX)
    return clipped.join(rest, [*keys, id_col]).select(*objects.columns)


def to_pixel_space(truths: DataFrame, predictions: DataFrame, gsd: float,
                   key: str = "product_id") -> tuple[DataFrame, DataFrame]:
    """Shift both tables to their joint lower corner per raster and divide by the resolution."""
    both = truths.select(key, "x0", "y0").unionByName(predictions.select(key, "x0", "y0"))
    corner = both.groupBy(key).agg(F.min("x0").alias("_mx"), F.min("y0").alias("_my"))

    def shifted(df):
        x, y = F.col("_mx"), F.col("_my")
        moved = df.join(corner, key).withColumns({
            "x0": (F.col("x0") - x) / gsd, "y0": (F.col("y0") - y) / gsd,
            "x1": (F.col("x1") - x) / gsd, "y1": (F.col("y1") - y) / gsd})
        return moved.select(*df.columns)

    return shifted(truths), shifted(predictions)
