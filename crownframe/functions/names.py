"""File names of tiles, annotation documents and object tables, and small text conventions.

Tile: `{product}_tile_{fold}_{size}_{col}_{row}.tif`, document: `{product}_coco_{fold}_{size}.json`,
object table: `{product}_{fold}_{size}.parquet`. `{size}` is `gr0p045` for a ground resolution or
`sf1p0` for a scale factor, with `p` for the decimal point. This layout is our own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SIZE = r"(gr|sf)([0-9]+p[0-9]+)"
TILE_PATTERN = rf"^(.+)_tile_([a-z]+)_{_SIZE}_([0-9]+)_([0-9]+)\.tif$"
DOC_PATTERN = rf"^(.+)_coco_([a-z]+)_{_SIZE}\.json$"


def point_to_p(text: Column) -> Column:
    return F.replace(text, F.lit("."), F.lit("p"))


def p_to_point(text: Column) -> Column:
    return F.replace(text, F.lit("p"), F.lit("."))


def size_code(gsd: Column | None = None, scale: Column | None = None) -> Column:
    """`gr...` when a ground resolution is given, else `sf...`."""
    from_gsd = F.concat(F.lit("gr"), point_to_p(gsd.cast("string"))) if gsd is not None else None
    from_scale = F.concat(F.lit("sf"), point_to_p(scale.cast("string"))) if scale is not None else None
    parts = [p for p in (from_gsd, from_scale) if p is not None]
    if not parts:
        raise ValueError("a ground resolution or a scale factor is needed")
    return F.coalesce(*parts)


def make_tile_name(product: Column, fold: Column, size: Column, col: Column, row: Column) -> Column:
    return F.concat(product, F.lit("_tile_"), fold, F.lit("_"), size, F.lit("_"),
                    col.cast("string"), F.lit("_"), row.cast("string"), F.lit(".tif"))


def make_doc_name(product: Column, fold: Column, size: Column) -> Column:
    return F.concat(product, F.lit("_coco_"), fold, F.lit("_"), size, F.lit(".json"))


def _number(kind: Column, digits: Column, wanted: str) -> Column:
    return F.when(kind == wanted, p_to_point(digits).try_cast("double"))


def parse_tile_name(name: Column) -> dict[str, Column]:
    """Parts of a tile name. A name that does not fit gives product `images`, scale 1.0, fold `infer`."""
    def part(i):
        return F.regexp_extract(name, TILE_PATTERN, i)

    fits = name.rlike(TILE_PATTERN)
    return {
        "product_name": F.when(fits, part(1)).otherwise("images"),
        "fold": F.when(fits, part(2)).otherwise("infer"),
        "ground_resolution": F.when(fits, _number(part(3), part(4), "gr")),
        "scale_factor": F.when(fits, _number(part(3), part(4), "sf")).otherwise(1.0),
        "col": F.when(fits, part(5).try_cast("int")),
        "row": F.when(fits, part(6).try_cast("int")),
    }


def leaf(path: Column) -> Column:
    """Last part of a path."""
    return F.element_at(F.split(path, "/"), -1)


def parent(path: Column, up: int = 1) -> Column:
    """Name of the folder `up` levels above the file."""
    return F.element_at(F.split(path, "/"), -1 - up)


def parse_iou_spec(spec: Column) -> Column:
    """`"0.75"`, `"0.5,0.65"` or `"50:95"` (percent, steps of 5) as an array of thresholds."""
    bounds = F.split(spec, ":")
    steps = F.sequence(bounds[0].try_cast("int"), bounds[1].try_cast("int"), F.lit(5))
    listed = F.transform(F.split(spec, ","), lambda s: F.trim(s).try_cast("double"))
    return F.when(spec.contains(":"), F.transform(steps, lambda v: v / 100.0)).otherwise(listed)
