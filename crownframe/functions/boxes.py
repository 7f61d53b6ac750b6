"""Axis-aligned boxes as four double columns `x0, y0, x1, y1`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = ("x0", "y0", "x1", "y1")


def box(prefix: str = "") -> tuple[Column, Column, Column, Column]:
    """The four columns of the box whose names start with `prefix`."""
    return tuple(F.col(f"{prefix}{name}") for name in BOX)


def zero_div(num: Column, den: Column) -> Column:
    """num / den, 0.0 where den is 0."""
    return F.when(den != 0, num / den).otherwise(F.lit(0.0))


def area(b) -> Column:
    x0, y0, x1, y1 = b
    return (x1 - x0) * (y1 - y0)


def inter_area(a, b) -> Column:
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    return w * h


def union_area(a, b) -> Column:
    return area(a) + area(b) - inter_area(a, b)


def iou(a, b, epsilon: float = 0.0) -> Column:
    """Intersection over union; an empty union gives 0. `epsilon` is added to the union."""
    union = union_area(a, b)
    return zero_div(inter_area(a, b), union + F.lit(epsilon) if epsilon else union)


def ioa(a, b) -> Column:
    """Share of `a` covered by `b`."""
    return zero_div(inter_area(a, b), area(a))


def touches(a, b) -> Column:
    """Boxes share at least a border point."""
    return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])


def overlaps(a, b) -> Column:
    """Boxes share some area."""
    return (a[0] < b[2]) & (a[2] > b[0]) & (a[1] < b[3]) & (a[3] > b[1])


def clip(a, b) -> dict[str, Column]:
    """The part of `a` inside `b`, as named columns."""
    return {
        "x0": F.greatest(a[0], b[0]), "y0": F.greatest(a[1], b[1]),
        "x1": F.least(a[2], b[2]), "y1": F.least(a[3], b[3]),
    }


def xywh_to_xyxy(x, y, w, h) -> dict[str, Column]:
    return {"x0": x, "y0": y, "x1": x + w, "y1": y + h}


def xyxy_to_xywh(b) -> dict[str, Column]:
    return {"x": b[0], "y": b[1], "w": b[2] - b[0], "h": b[3] - b[1]}


def rescale(b, fx, fy) -> dict[str, Column]:
    """Scale about the origin, e.g. by original over resized tile size."""
    return {"x0": b[0] * fx, "y0": b[1] * fy, "x1": b[2] * fx, "y1": b[3] * fy}


def pad(b, percentage: float) -> dict[str, Column]:
    """Grow each side by `percentage` of the box size."""
    w, h = (b[2] - b[0]) * percentage, (b[3] - b[1]) * percentage
    return {"x0": b[0] - w, "y0": b[1] - h, "x1": b[2] + w, "y1": b[3] + h}


def pixel_to_world(b, transform: Column) -> dict[str, Column]:
    """Apply `[a, b, c, d, e, f]` (x = a*col + b*row + c, y = d*col + e*row + f) to both corners.

    The result is ordered again, because a north-up raster has a negative row step.
    """
    t = [F.element_at(transform, i) for i in range(1, 7)]

    def at(col, row):
        return t[0] * col + t[1] * row + t[2], t[3] * col + t[4] * row + t[5]

    (xa, ya), (xb, yb) = at(b[0], b[1]), at(b[2], b[3])
    return {"x0": F.least(xa, xb), "y0": F.least(ya, yb),
            "x1": F.greatest(xa, xb), "y1": F.greatest(ya, yb)}


def center(b) -> tuple[Column, Column]:
    return (b[0] + b[2]) / 2, (b[1] + b[3]) / 2


# Size classes in square metres, lower bound inclusive, upper bound exclusive.
SIZE_CLASSES = (
    ("tiny", 0.0, 9.0),
    ("small", 9.0, 25.0),
    ("medium", 25.0, 49.0),
    ("large", 49.0, 100.0),
    ("giant", 100.0, None),
)
SIZE_LABELS = tuple(name for name, _, _ in SIZE_CLASSES)
OPEN_END = 1e10


def area_ranges(gsd: float) -> dict[str, tuple[float, float]]:
    """Size classes in pixels for a ground resolution in metres per pixel."""
    px = 1 / gsd ** 2
    return {name: (lo * px, OPEN_END if hi is None else hi * px) for name, lo, hi in SIZE_CLASSES}


def size_label(pixel_area: Column, gsd: float) -> Column:
    """Name of the size class; anything outside all of them is the last one."""
    label = F.lit(SIZE_LABELS[-1])
    for name, (lo, hi) in reversed(area_ranges(gsd).items()):
        label = F.when((pixel_area >= lo) & (pixel_area < hi), name).otherwise(label)
    return label
