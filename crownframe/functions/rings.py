"""Polygons as `rings array<array<double>>`: flat x0, y0, x1, y1, ... per ring, outer ring first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS = "array<array<double>>"


def _axis(ring: Column, offset: int) -> Column:
    """Every second number of a flat ring."""
    return F.filter(ring, lambda v, i: i % 2 == offset)


def envelope(rings: Column) -> dict[str, Column]:
    """Bounding box of a polygon."""
    flat_x = F.flatten(F.transform(rings, lambda r: _axis(r, 0)))
    flat_y = F.flatten(F.transform(rings, lambda r: _axis(r, 1)))
    return {"x0": F.array_min(flat_x), "y0": F.array_min(flat_y),
            "x1": F.array_max(flat_x), "y1": F.array_max(flat_y)}


def ring_area(ring: Column) -> Column:
    """Absolute shoelace area of one flat ring."""
    n = F.size(ring)
    turn = F.transform(F.sequence(F.lit(0), n - 2, F.lit(2)), lambda i: (
        ring[i] * ring[(i + 3) % n] - ring[(i + 2) % n] * ring[i + 1]))
    total = F.aggregate(turn, F.lit(0.0), lambda s, v: s + v)
    return F.when(n >= 6, F.abs(total) / 2).otherwise(0.0)


def polygon_area(rings: Column) -> Column:
    """Outer ring minus holes."""
    areas = F.transform(rings, ring_area)
    holes = F.aggregate(F.slice(areas, 2, F.greatest(F.size(areas) - 1, F.lit(0))), F.lit(0.0),
                        lambda s, v: s + v)
    return F.when(F.size(areas) > 0, F.element_at(areas, 1) - holes).otherwise(0.0)


def clean_rings(rings: Column) -> Column:
    """Drop rings with fewer than three points."""
    return F.filter(rings, lambda r: F.size(r) >= 6)


def has_valid_ring(rings: Column) -> Column:
    return F.coalesce(F.exists(rings, lambda r: F.size(r) >= 6), F.lit(False))


def remove_holes(rings: Column) -> Column:
    return F.slice(rings, 1, 1)


def drop_small_parts(parts: Column, least_area: float) -> Column:
    """Parts of a multipolygon with at least `least_area`; the largest one always stays."""
    areas = F.transform(parts, polygon_area)
    top = F.array_max(areas)
    return F.filter(parts, lambda p: (polygon_area(p) >= least_area) | (polygon_area(p) == top))


def scale_rings(rings: Column, fx: Column, fy: Column) -> Column:
    return F.transform(rings, lambda r: F.transform(
        r, lambda v, i: F.when(i % 2 == 0, v * fx).otherwise(v * fy)))


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(F.array(x0, y0, x1, y0, x1, y1, x0, y1))


def bad_to_dummy(rings: Column, score: Column, valid: Column) -> dict[str, Column]:
    """An unusable mask becomes the unit square with score 0, so rows stay aligned."""
    one, zero = F.lit(1.0), F.lit(0.0)
    ok = valid & rings.isNotNull() & has_valid_ring(rings)
    return {"rings": F.when(ok, rings).otherwise(box_ring(zero, zero, one, one)),
            "score": F.when(ok, score).otherwise(zero)}
