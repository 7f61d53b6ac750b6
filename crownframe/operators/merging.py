"""Merging a stage's result into the objects table."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crownframe.functions.boxes import BOX
from crownframe.operators.numbering import renumbered, row_index
from crownframe.session import cut

GEOMETRY = (*BOX, "rings")
OBJECT_ID, TILE_PATH = "object_id", "tile_path"


class MergeError(ValueError):
    """The result cannot be merged."""


def has_geometry(df: DataFrame) -> bool:
    return all(c in df.columns for c in BOX) or "rings" in df.columns


def attribute_merge(objects: DataFrame, attributes: DataFrame, key: str = OBJECT_ID) -> DataFrame:
    """Objects with the attribute columns added; geometry and shared columns stay the objects' own."""
    new = [c for c in attributes.columns if c not in objects.columns and c not in GEOMETRY]
    return objects.join(attributes.select(key, *new), key, "left")


def unmatched(objects: DataFrame, attributes: DataFrame, key: str = OBJECT_ID) -> DataFrame:
    """Objects the attributes say nothing about."""
    return objects.join(attributes.select(key), key, "left_anti")


def _repeated(df: DataFrame, key: str) -> bool:
    return not df.dropna(subset=[key]).groupBy(key).count().filter("count > 1").isEmpty()


def geometry_merge(result: DataFrame, existing: DataFrame, key: str = OBJECT_ID,
                   order: Sequence[Column] = ()) -> DataFrame:
    """Result with the existing columns it lacks; its geometry wins.

    A repeated object id gets new ids from max+1 (the first row keeps its id); a repeated tile path
    is an error.
    """
    lacking = [c for c in existing.columns if c not in result.columns and c not in GEOMETRY]
    if not lacking and not any(_repeated(df, key) for df in (result, existing)):
        return result               # no column to bring, and no row that the join would repeat
    merged = result.join(existing.select(key, *lacking), key, "left")
    order = list(order) or _full_order(merged)
    # The join has brought the rows of an id together; they are numbered there, and all is worked out and written once.
    nth = cut(merged.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))), "merged")
    if nth.filter("_nth > 1").isEmpty():
        return nth.drop("_nth")
    if key != OBJECT_ID:
        raise MergeError(f"repeated {key} after the merge, it must be unique")
    warnings.warn("repeated object ids after the merge get new ids", stacklevel=2)
    return renumbered(nth, F.col("_nth") > 1, order, key).drop("_nth")


def _full_order(df: DataFrame) -> list[Column]:
    """A fixed order over everything that can be compared."""
    return [F.col(f.name) for f in df.schema.fields
            if f.dataType.simpleString().split("(")[0].split("<")[0] not in ("map", "variant")]


def merge_key(result: DataFrame, existing: DataFrame) -> str | None:
    """`object_id` if all of them are set, else `tile_path` if unique in the result, else none."""
    both = [c for c in result.columns if c in existing.columns]
    if OBJECT_ID in both and result.filter(F.col(OBJECT_ID).isNull()).limit(1).count() == 0:
        return OBJECT_ID
    if TILE_PATH in both:
        if result.groupBy(TILE_PATH).count().filter("count > 1").limit(1).count() == 0:
            return TILE_PATH
    return None


def as_new(result: DataFrame, order: Sequence[Column] = ()) -> DataFrame:
    """Take the result as the objects table, numbering it when it has no ids."""
    if OBJECT_ID in result.columns:
        return result
    return row_index(result, [], list(order) or _full_order(result), OBJECT_ID)


def merge_results(existing: DataFrame | None, result: DataFrame, objects_are_new: bool = True,
                  order: Sequence[Column] = ()) -> DataFrame:
    """The objects table after a stage.

    An empty result replaces the table with a warning; new objects replace it; without an existing
    table the result becomes it; a result with geometry takes over missing columns by key, or
    replaces the table when there is no key; a result without geometry adds its columns by key.
    """
    if result.limit(1).count() == 0:
        warnings.warn("the stage returned no rows", stacklevel=2)
        return result
    if objects_are_new or existing is None:
        return as_new(result, order)
    key = merge_key(result, existing)
    if has_geometry(result):
        return geometry_merge(result, existing, key, order) if key else as_new(result, order)
    if key is None:
        raise MergeError("the result has neither geometry nor a usable key")
    return attribute_merge(existing, result, key)
