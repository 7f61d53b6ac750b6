"""One slab sweep over all rows of an Arrow batch, on arrays of segments.

Shapes are read by the even-odd rule. Heights of all corners and crossings cut a row's shapes into slabs; in a slab
segments don't cross, so they have one order from left to right, and running parities tell what lies between two.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Segments of the rows that are swept together, and pairs of segments looked at together.
BLOCK, PAIRS = 1 << 15, 1 << 20


class Segments(NamedTuple):
    """`xy` has rows (x0, y0, x1, y1); `row`, `ring` and `shape` say where a segment comes from."""
    row: np.ndarray
    shape: np.ndarray
    xy: np.ndarray

    def take(self, at) -> Segments:
        return Segments(*(c[at] for c in self))


def _joined(parts: Sequence[Segments]) -> Segments:
    return Segments(*(np.concatenate(c) for c in zip(*parts)))


def ring_edges(rings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, ring and (x0, y0, x1, y1) of all edges of an array of ring lists, in order; rings of under three points have none."""
    row_of = np.asarray(pc.list_parent_indices(rings))
    lists = rings.flatten()
    ring = np.asarray(pc.list_parent_indices(lists))[::2]
    p = np.asarray(lists.flatten(), dtype=float).reshape(-1, 2)
    size = np.bincount(ring, minlength=len(row_of))
    after = np.arange(1, len(p) + 1)
    ends = np.cumsum(size)
    some = size > 0
    after[ends[some] - 1] = (ends - size)[some]
    keep = size[ring] >= 3
    return row_of[ring][keep].astype(np.int64), ring[keep].astype(np.int64), np.hstack([p, p[after]])[keep]


def segments(rings: pa.Array, shape: int) -> Segments:
    """Edges that aren't horizontal, turned upwards."""
    row, _, s = ring_edges(rings)
    keep = s[:, 1] != s[:, 3]
    s, row = s[keep], row[keep]
    down = s[:, 1] > s[:, 3]
    s[down] = s[down][:, [2, 3, 0, 1]]
    return Segments(row, np.full(len(row), shape, np.int8), s)


def crossings(row: np.ndarray, s: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(i, j, t, u): segments of one row that cross at a share t of i and u of j, neither of them an end.

    Segments are sorted by row and lower end, so those that one may cross follow it up to its upper end.
    """
    low, high = np.minimum(s[:, 1], s[:, 3]), np.maximum(s[:, 1], s[:, 3])
    both = np.lexsort((np.concatenate([low, high]), np.concatenate([row, row])))
    rank = np.empty(len(both), np.int64)
    values, rows = np.concatenate([low, high])[both], np.concatenate([row, row])[both]
    fresh = np.ones(len(both), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    rank[both] = np.cumsum(fresh)
    first, last = rank[:len(s)], rank[len(s):]
    order = np.argsort(first, kind="stable")
    left, right = np.minimum(s[:, 0], s[:, 2])[order], np.maximum(s[:, 0], s[:, 2])[order]
    count = np.searchsorted(first[order], last[order], "right") - np.arange(1, len(s) + 1)
    done, total = 0, np.concatenate(([0], np.cumsum(count)))
    while done < len(s):
        upto = max(done + 1, int(np.searchsorted(total, total[done] + PAIRS, "right")) - 1)
        i = np.repeat(np.arange(done, upto), count[done:upto])
        j = np.arange(len(i)) - np.repeat(total[done:upto] - total[done], count[done:upto]) + i + 1
        done = upto
        meet = (left[i] <= right[j]) & (left[j] <= right[i])
        i, j = order[i[meet]], order[j[meet]]
        d, e, p = s[i, 2:] - s[i, :2], s[j, 2:] - s[j, :2], s[i, :2] - s[j, :2]
        cross = d[:, 0] * e[:, 1] - d[:, 1] * e[:, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (e[:, 0] * p[:, 1] - e[:, 1] * p[:, 0]) / cross
            u = (d[:, 0] * p[:, 1] - d[:, 1] * p[:, 0]) / cross
        hit = (cross != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        yield i[hit], j[hit], t[hit], u[hit]


class Slabs(NamedTuple):
    """Segments per slab from left to right: the slab's row and heights, the segment and its x at both heights."""
    row: np.ndarray
    slab: np.ndarray
    low: np.ndarray
    high: np.ndarray
    segment: np.ndarray
    a: np.ndarray
    b: np.ndarray


def slabs(s: Segments, cuts: tuple[np.ndarray, np.ndarray] | None = None) -> Slabs:
    """All slabs of upward segments; `cuts` are further (row, height)."""
    rows, heights = [s.row, s.row], [s.xy[:, 1], s.xy[:, 3]]
    for i, _, t, _ in crossings(s.row, s.xy):
        rows.append(s.row[i])
        heights.append(s.xy[i, 1] + t * (s.xy[i, 3] - s.xy[i, 1]))
    if cuts is not None:
        rows.append(cuts[0])
        heights.append(cuts[1])
    rows, heights = np.concatenate(rows), np.concatenate(heights)
    order = np.lexsort((heights, rows))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(heights[order]) != 0) | (np.diff(rows[order]) != 0)
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(fresh) - 1
    y = heights[order][fresh]
    n = len(s.row)
    count = at[n:2 * n] - at[:n]
    segment = np.repeat(np.arange(n), count)
    slab = np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(at[:n], count)
    xy = s.xy[segment]
    slope = (xy[:, 2] - xy[:, 0]) / (xy[:, 3] - xy[:, 1])
    low, high = y[slab], y[slab + 1] if len(slab) else y[slab]
    a = np.where(low == xy[:, 1], xy[:, 0], xy[:, 0] + (low - xy[:, 1]) * slope)
    b = np.where(high == xy[:, 3], xy[:, 2], xy[:, 0] + (high - xy[:, 1]) * slope)
    order = np.lexsort((a + b, slab))
    return Slabs(s.row[segment][order], *(c[order] for c in (slab, low, high, segment, a, b)))


def starts_of(slab: np.ndarray) -> np.ndarray:
    """For each row of slabs the first row of its slab."""
    new = np.ones(len(slab), bool)
    new[1:] = slab[1:] != slab[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(slab)), 0))


def parity(mine: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether an odd number of `mine` come up to and with each row, from the start of its slab."""
    seen = np.cumsum(mine)
    before = seen[start] - mine[start]
    return (seen - before) % 2 == 1


def shared_parts(n: int, shapes: Sequence[pa.Array], optional: Sequence[int] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Area and bounds (x0, y0, x1, y1; infinite without area) of what all shapes of each of n rows share.

    A null shape has no area; one of `optional` has no bounds.
    """
    s = _joined([segments(rings, k) for k, rings in enumerate(shapes)])
    s = s.take(np.argsort(s.row, kind="stable"))
    free = {k: np.asarray(pc.is_null(shapes[k])) for k in optional}
    area, sizes = np.zeros(n), np.bincount(s.row, minlength=n)
    bounds = np.tile([np.inf, np.inf, -np.inf, -np.inf], (n, 1))
    ends = np.cumsum(sizes)
    at = 0
    while at < n:                                        # whole rows, BLOCK segments or one row at a time
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + BLOCK, "right")))
        part = s.take(slice(ends[at] - sizes[at], ends[upto - 1]))
        at = upto
        if not len(part.row):
            continue
        z = slabs(part)
        start, inside = starts_of(z.slab), np.ones(len(z.row), bool)
        for k in range(len(shapes)):
            own = parity(part.shape[z.segment] == k, start)
            inside &= own | free[k][z.row] if k in free else own
        inside[:-1] &= z.slab[1:] == z.slab[:-1]
        inside[-1:] = False
        i = np.flatnonzero(inside)
        width = z.a[i + 1] - z.a[i] + z.b[i + 1] - z.b[i]
        i, width = i[width > 0], width[width > 0]
        row = z.row[i]
        area += np.bincount(row, width * (z.high[i] - z.low[i]) / 2, n)
        np.minimum.at(bounds[:, 0], row, np.minimum(z.a[i], z.b[i]))
        np.minimum.at(bounds[:, 1], row, z.low[i])
        np.maximum.at(bounds[:, 2], row, np.maximum(z.a[i + 1], z.b[i + 1]))
        np.maximum.at(bounds[:, 3], row, z.high[i])
    return area, bounds


def shared_areas(n: int, shapes: Sequence[pa.Array], optional: Sequence[int] = ()) -> np.ndarray:
    """The area common to all shapes of each of n rows."""
    return shared_parts(n, shapes, optional)[0]


def clamped(s: Segments, cell: np.ndarray) -> Segments:
    """The parts of upward segments within the height of their row's cell (rows x0, y0, x1, y1), moved onto its left or right
    border where they lie beside it. By the even-odd rule they bound the shape's part in the cell."""
    box = cell[s.row]
    low, high = np.maximum(s.xy[:, 1], box[:, 1]), np.minimum(s.xy[:, 3], box[:, 3])
    keep = low < high
    s, box, low, high = s.take(keep), box[keep], low[keep], high[keep]
    x0, y0, x1, y1 = s.xy.T
    slope = (x1 - x0) / (y1 - y0)
    a = np.where(low == y0, x0, x0 + (low - y0) * slope)
    b = np.where(high == y1, x1, x0 + (high - y0) * slope)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = [np.where((a - e) * (b - e) < 0, low + (e - a) * (high - low) / (b - a), high) for e in (box[:, 0], box[:, 2])]
    first, second = (np.clip(f(*at), low, high) for f in (np.minimum, np.maximum))
    on_left = at[0] <= at[1]
    mid = np.clip((a, b), box[:, 0], box[:, 2])
    x_first = np.where(first == high, mid[1], np.where(on_left, box[:, 0], box[:, 2]))
    x_second = np.where(second == high, mid[1], np.where(on_left, box[:, 2], box[:, 0]))
    pieces = [(mid[0], low, x_first, first), (x_first, first, x_second, second), (x_second, second, mid[1], high)]
    out = []
    for p in pieces:
        xy = np.stack(p, 1)
        some = xy[:, 1] < xy[:, 3]
        out.append(Segments(s.row[some], s.shape[some], xy[some]))
    return _joined(out)


def without_pairs(s: Segments) -> Segments:
    """The same shapes with each upright border line cut down to what an odd number of segments cover."""
    upright = s.xy[:, 0] == s.xy[:, 2]
    v = s.take(upright)
    row, shape, x = (np.repeat(c, 2) for c in (v.row, v.shape, v.xy[:, 0]))
    y = v.xy[:, 1::2].ravel()
    order = np.lexsort((y, x, shape, row))
    row, shape, x, y = (c[order] for c in (row, shape, x, y))
    same = lambda c: c[1:] == c[:-1]
    new = np.ones(len(y), bool)
    new[1:] = ~(same(row) & same(shape) & same(x) & same(y))
    starts = np.flatnonzero(new)
    odd = starts[np.diff(np.append(starts, len(y))) % 2 == 1]
    low, high = odd[0::2], odd[1::2]
    borders = Segments(row[low], shape[low], np.stack([x[low], y[low], x[high], y[high]], 1))
    return _joined([s.take(~upright), borders])


def flat(n: int, s: Segments) -> pa.ListArray:
    """Four numbers per segment in one list per row."""
    s = s.take(np.argsort(s.row, kind="stable"))
    ends = np.concatenate(([0], 4 * np.cumsum(np.bincount(s.row, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(s.xy.ravel()))


def from_flat(edges: pa.Array, shape: int = 0) -> Segments:
    row = np.asarray(pc.list_parent_indices(edges))[::4].astype(np.int64)
    xy = np.asarray(edges.flatten(), dtype=float).reshape(-1, 4)
    return Segments(row, np.full(len(row), shape, np.int8), xy)
