"""Polygon arithmetic that has no Column expression: Arrow functions over pairs and single rows.

All shapes are read by the even-odd rule, which also gives self-crossing rings a meaning.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownframe.functions import faces, sweep

# Types as objects, so workers can import this module without a session.
_RINGS = T.ArrayType(T.ArrayType(T.DoubleType()))


def _segments(rings) -> np.ndarray:
    """Non-horizontal edges as rows (x_low, y_low, x_high, y_high)."""
    return sweep.segments(_array([rings]), 0).xy


def _array(shapes) -> pa.Array:
    return pa.array([None if s is None else [np.asarray(r, float) for r in s] for s in shapes],
                    pa.list_(pa.list_(pa.float64())))


def shared_area(*shapes) -> float:
    """Area common to all shapes."""
    return float(sweep.shared_areas(1, [_array([s]) for s in shapes])[0])


@F.arrow_udf(T.DoubleType())
def polygon_inter_area(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(sweep.shared_areas(len(a), [a, b]))


@F.arrow_udf(T.DoubleType())
def even_odd_area(a: pa.Array) -> pa.Array:
    return pa.array(sweep.shared_areas(len(a), [a]))


@F.arrow_udf(T.DoubleType())
def clipped_inter_area(a: pa.Array, b: pa.Array, clip_a: pa.Array, clip_b: pa.Array) -> pa.Array:
    """Common area of two polygons, each inside its own clip ring (null: not clipped)."""
    return pa.array(sweep.shared_areas(len(a), [a, b, clip_a, clip_b], optional=(2, 3)))


def iou_from(inter: Column, area_a: Column, area_b: Column) -> Column:
    """IoU of two shapes from their areas, which are measured once per shape and not per pair."""
    union = area_a + area_b - inter
    return F.when(union > 0, inter / F.when(union > 0, union)).otherwise(0.0)


def _loops(pts: list[tuple[float, float]], hits: dict[int, list]) -> list[list[float]]:
    """Loops of a ring, cut at the crossings `hits` of its edges; some may have no area."""
    path: list[tuple[float, float]] = []
    for i, p in enumerate(pts):
        path.append(p)
        path += [at for _, at in sorted(hits.get(i, ()))]
    loops, stack, seen = [], [], {}
    for p in [*path, path[0]]:
        if p in seen:
            start = seen[p]
            loop = stack[start:]
            for q in loop:
                seen.pop(q, None)
            stack = stack[:start]
            if len(loop) >= 3:
                loops.append([c for q in loop for c in q])
        seen[p] = len(stack)
        stack.append(p)
    return loops


def _shared_areas(*shapes: list) -> np.ndarray:
    """`shared_area` of many shapes in one sweep; each list holds one shape per row."""
    kind = pa.list_(pa.list_(pa.float64()))
    return sweep.shared_areas(len(shapes[0]), [pa.array(s, kind) for s in shapes])


def _crossings_of(rings: pa.Array) -> dict[int, dict[int, list]]:
    """Per row and edge of the outer rings: (share, point) of each crossing."""
    row, _, s = sweep.ring_edges(rings)
    first = np.searchsorted(row, row)                    # rows are in order
    found: dict[int, dict[int, list]] = {}
    for i, j, t, u in sweep.crossings(row, s):
        at = s[i, :2] + t[:, None] * (s[i, 2:] - s[i, :2])
        for k, a, b, p, v, w in zip(row[i].tolist(), (i - first[i]).tolist(), (j - first[j]).tolist(),
                                    map(tuple, at.tolist()), t.tolist(), u.tolist()):
            hits = found.setdefault(k, {})
            hits.setdefault(a, []).append((v, p))
            hits.setdefault(b, []).append((w, p))
    return found


@F.arrow_udf(T.ArrayType(_RINGS))
def repair(rings: pa.Array) -> pa.Array:
    """Valid parts of a polygon (a list of polygons); empty when nothing with area is left.

    A crossing outer ring is taken apart at its crossings; each hole stays with the part that holds most of it,
    and holes outside all parts are dropped. All crossings of a batch are found in one sweep.
    """
    shapes = rings.to_pylist()
    outer = pa.array([s[:1] if s and len(s[0]) >= 6 else [] for s in shapes], pa.list_(pa.list_(pa.float64())))
    crossed, whole = _crossings_of(outer), sweep.shared_areas(len(shapes), [outer])
    parts: list[list] = []
    for k, shape in enumerate(shapes):
        if not shape or len(shape[0]) < 6:
            parts.append([])
            continue
        pts = list(zip(shape[0][0::2], shape[0][1::2]))
        if k in crossed or len(set(pts)) < len(pts):
            parts.append(_loops(pts, crossed.get(k, {})))
        else:
            parts.append([shape[0]] if whole[k] > 0 else [])
    # The loops of all rows are measured together, and so are the parts against the holes.
    sizes = iter((_shared_areas([[p] for each in parts for p in each]) > 0).tolist() if any(parts) else ())
    parts = [[p for p in each if next(sizes)] for each in parts]
    holes = [[h for h in shape[1:] if len(h) >= 6] if each else [] for each, shape in zip(parts, shapes)]
    pairs = [(p, h) for each, inner in zip(parts, holes) if len(each) > 1 for h in inner for p in each]
    common = iter(_shared_areas([[p] for p, _ in pairs], [[h] for _, h in pairs]).tolist() if pairs else ())
    out = []
    for each, inner in zip(parts, holes):
        fixed = [[p] for p in each]
        if len(each) == 1:
            fixed[0] += inner
        else:
            for h in inner:
                held = [next(common) for _ in each]
                if max(held) > 0:
                    fixed[held.index(max(held))].append(h)
        out.append(fixed)
    return pa.array(out, pa.list_(pa.list_(pa.list_(pa.float64()))))


@F.arrow_udf(_RINGS)
def largest_part(parts: pa.Array) -> pa.Array:
    """The part with the largest area, null when there is none."""
    row = np.asarray(pc.list_parent_indices(parts))
    shapes = parts.flatten()
    area = sweep.shared_areas(len(shapes), [shapes])
    best = np.lexsort((-np.arange(len(row)), area, row))       # of equal ones the first
    last = np.flatnonzero(np.append(row[best][1:] != row[best][:-1], True))[:len(row)]
    chosen = np.full(len(parts), -1)
    chosen[row[best[last]]] = best[last]
    return shapes.take(pa.array(chosen, mask=chosen < 0))


def _simplify_ring(ring, tolerance: float) -> list[float]:
    p = np.asarray(ring, dtype=float).reshape(-1, 2)
    if len(p) < 4:
        return p.ravel().tolist()
    far = int(np.argmax(((p - p[0]) ** 2).sum(axis=1)))
    keep = {0, far}
    todo = [(0, far), (far, len(p))]
    closed = np.vstack([p, p[:1]])
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        base = closed[b] - closed[a]
        inner = closed[a + 1:b] - closed[a]
        length = float(np.hypot(*base))
        if length == 0:
            dist = np.hypot(inner[:, 0], inner[:, 1])
        else:
            dist = np.abs(base[0] * inner[:, 1] - base[1] * inner[:, 0]) / length
        k = int(np.argmax(dist))
        if dist[k] > tolerance:
            keep.add(a + 1 + k)
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return p[sorted(keep)].ravel().tolist()


def simplify(rings, tolerance: float):
    """Column: rings without points closer than `tolerance` to the simplified outline."""
    @F.pandas_udf(_RINGS)
    def run(shapes: pd.Series) -> pd.Series:
        return shapes.map(lambda s: None if s is None else
                          [r for r in (_simplify_ring(x, tolerance) for x in s) if len(r) >= 6])

    return run(rings)


_RUNS = T.ArrayType(T.StructType([
    T.StructField(c, T.IntegerType()) for c in ("line", "c0", "c1")]))


def scan_lines(rings: pa.Array, height: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, line, c0 and c1 of the pixels whose centre is inside, for all rows of a batch, in order."""
    s = sweep.segments(rings, 0)
    first = np.maximum(np.ceil(s.xy[:, 1] - 0.5), 0).astype(np.int64)          # lines whose middle the segment passes
    stop = np.minimum(np.ceil(s.xy[:, 3] - 0.5), height[s.row]).astype(np.int64)
    count = np.maximum(stop - first, 0)
    at = np.repeat(np.arange(len(count)), count)
    line = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + first[at]
    x0, y0, x1, y1 = s.xy[at].T
    x = x0 + (line + 0.5 - y0) * (x1 - x0) / (y1 - y0)
    row = s.row[at]
    order = np.lexsort((x, line, row))
    row, line, x = row[order][0::2], line[order][0::2], x[order]               # by pairs: in, out
    c0, c1 = (np.clip(np.ceil(v - 0.5), 0, width[row]).astype(np.int64) for v in (x[0::2], x[1::2]))
    some = c1 > c0
    row, line, c0, c1 = row[some], line[some], c0[some], c1[some]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1]) | (c0[1:] > c1[:-1])
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(row)) - 1 if len(row) else starts
    return row[starts], line[starts], c0[starts], c1[ends]


@F.arrow_udf(_RUNS)
def polygon_to_runs(rings: pa.Array, height: pa.Array, width: pa.Array) -> pa.Array:
    """Row runs of a polygon whose corners are rounded to whole pixels first."""
    lists = rings.flatten()
    points = pa.array(np.round(np.asarray(lists.flatten(), dtype=float)))
    ends = lambda x: np.concatenate(([0], np.cumsum(np.asarray(x.value_lengths().fill_null(0))))).astype(np.int32)
    whole = pa.ListArray.from_arrays(pa.array(ends(rings)), pa.ListArray.from_arrays(pa.array(ends(lists)), points))
    row, *columns = scan_lines(whole, np.asarray(height), np.asarray(width))
    items = pa.StructArray.from_arrays([pa.array(c.astype(np.int32)) for c in columns], names=["line", "c0", "c1"])
    counts = np.bincount(row, minlength=len(rings))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), items)


@F.arrow_udf(_RINGS)
def runs_to_polygon(runs: pa.Array) -> pa.Array:
    """Rectilinear outline of row runs; every closed border is one ring, largest first. Diagonal pixels stay apart.

    Borders are made from the runs alone: both ends of each run, and what is left of its upper and lower side where no run
    of the next line lies on it.
    """
    row = np.asarray(pc.list_parent_indices(runs)).astype(np.int64)
    items = runs.flatten()
    line, c0, c1 = (np.asarray(items.field(c)).astype(np.int64) for c in ("line", "c0", "c1"))
    n, deep = len(row), int(line.max(initial=0)) + 2
    # One group per mask and line border; the mask lies above it, or below.
    group = np.concatenate([row * deep + line, row * deep + line + 1])
    left, _ = faces.netted(faces.Sides(group, np.tile(c0, 2).astype(float), np.tile(c1, 2).astype(float), np.repeat([0, 1], n), np.zeros(2 * n, np.int64)))
    level, back = left.group % deep, left.side == 1
    ends = np.stack([np.where(back, left.p1, left.p0), level, np.where(back, left.p0, left.p1), level], 1)
    down, up = (np.stack(c, 1).astype(float) for c in ((c0, line + 1, c0, line), (c1, line, c1, line + 1)))
    edges = np.concatenate([ends, down, up])
    owner = np.concatenate([left.group // deep, row, row])
    order = np.argsort(owner, kind="stable")
    stops = np.searchsorted(owner[order], np.arange(len(runs)), "right")
    out, start = [], 0
    for stop in stops.tolist():
        rings, _ = faces.chained([((x0, y0), (x1, y1)) for x0, y0, x1, y1 in edges[order[start:stop]].tolist()])
        out.append(sorted(([v for p in r for v in p] for r in rings), key=lambda r: -abs(_turned_area(r))))
        start = stop
    return pa.array(out, pa.list_(pa.list_(pa.float64())))


def _turned_area(ring: list[float]) -> float:
    x, y = np.asarray(ring[0::2]), np.asarray(ring[1::2])
    return float(x @ np.roll(y, -1) - y @ np.roll(x, -1)) / 2
