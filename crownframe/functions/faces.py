"""Faces of polygon layers within grid cells, for whole batches of cells at once.

The edges in a cell are swept in slabs (`sweep`). Between two neighbouring edges of a slab the ground has one label; runs
of one label are spans. A face's border is what is left of the sides of its spans once sides of two spans of the face that
lie on each other are taken out. Sides on a cell's border are handed on, as the neighbouring cell may hold the other one.
Borders have the face on their left.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np

from crownframe.functions import sweep

ACROSS, UPRIGHT = 0, 1


class Sides(NamedTuple):
    """Parts p0 to p1 of lines; `side` is 0 if the face lies on the line's upper or right side, else 1."""
    group: np.ndarray
    p0: np.ndarray
    p1: np.ndarray
    side: np.ndarray
    name: np.ndarray


def netted(s: Sides) -> tuple[Sides, np.ndarray]:
    """The parts of each group's lines that have a face on one side only, and pairs of names that meet on the others."""
    n = len(s.group)
    group, at = np.tile(s.group, 2), np.concatenate([s.p0, s.p1])
    step = np.repeat([1, -1], n)
    side, mine = np.tile(s.side, 2), np.tile(np.arange(n), 2)
    order = np.lexsort((step, at, group))
    group, at, step, side, mine = (c[order] for c in (group, at, step, side, mine))
    on, last = [], []
    for k in (0, 1):
        own = side == k
        on.append(np.cumsum(np.where(own, step, 0)) > 0)
        last.append(mine[np.maximum.accumulate(np.where(own & (step > 0), np.arange(2 * n), 0))])
    part = np.zeros(2 * n, bool)
    part[:-1] = (group[1:] == group[:-1]) & (at[1:] > at[:-1])
    both = part & on[0] & on[1]
    pairs = np.unique(np.stack([s.name[last[0][both]], s.name[last[1][both]]], 1), axis=0)
    out = []
    for k in (0, 1):
        i = np.flatnonzero(part & on[k] & ~on[1 - k])
        out.append(Sides(group[i], at[i], at[i + 1], np.full(len(i), k), s.name[last[k][i]]))
    return Sides(*(np.concatenate(c) for c in zip(*out))), pairs


class Spans(NamedTuple):
    cell: np.ndarray
    label: np.ndarray
    name: np.ndarray
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray      # x at both heights
    right: np.ndarray


def spans(s: sweep.Segments, layer: np.ndarray, merge: bool) -> tuple[Spans, np.ndarray]:
    """Spans of a batch, and pairs of shapes that share one. `s.row` is the cell and `s.shape` a number per shape.

    With `merge` all shapes are one face, named by one of its shapes. Else the label is the shape of layer 0 and that of
    layer 1 (-1: none) as one number.
    """
    z = sweep.slabs(s)
    n = len(z.slab)
    shape = s.shape[z.segment]
    order = np.lexsort((np.arange(n), shape, z.slab))
    nth = np.empty(n, np.int64)
    new = np.ones(n, bool)
    new[1:] = (z.slab[order][1:] != z.slab[order][:-1]) | (shape[order][1:] != shape[order][:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    nth[order] = np.arange(n) - first
    enters = nth % 2 == 0
    order = np.lexsort((enters, z.a + z.b, z.slab))        # of edges on one spot those that leave come first
    z = sweep.Slabs(*(c[order] for c in z))
    for x in (z.a, z.b):                       # rounding at a crossing must not turn the order round
        while True:
            back = np.flatnonzero((z.slab[1:] == z.slab[:-1]) & (x[1:] < x[:-1]))
            if not len(back):
                break
            x[back + 1] = x[back]
    shape, enters = shape[order], enters[order]
    step = np.where(enters, 1, -1)
    if merge:
        label = np.where(np.cumsum(step) > 0, 0, -1)
    else:
        code, none = np.int64(0), np.ones(n, bool)
        many = int(s.shape.max(initial=0)) + 2
        for k in (0, 1):
            own = layer[z.segment] == k
            inside = np.cumsum(np.where(own, step, 0)) > 0
            now = shape[np.maximum.accumulate(np.where(own & enters, np.arange(n), 0))]
            code = code * many + np.where(inside, now + 1, 0)
            none &= ~inside
        label = np.where(none, -1, code)
    i = np.arange(n - 1) if n else np.arange(0)
    j = i + 1
    wide = (z.a[j] > z.a[i]) | (z.b[j] > z.b[i])
    keep = (z.slab[i] == z.slab[j]) & (label[i] >= 0) & wide
    i, j = i[keep], j[keep]
    fresh = np.ones(len(i), bool)
    if len(i):
        fresh[1:] = ~((z.slab[i[1:]] == z.slab[i[:-1]]) & (label[i[1:]] == label[i[:-1]])
                      & (z.a[i[1:]] == z.a[j[:-1]]) & (z.b[i[1:]] == z.b[j[:-1]]))
    begin = np.flatnonzero(fresh)
    left, right = i[begin], j[np.append(begin[1:], len(i)) - 1] if len(i) else j[begin]
    found = Spans(z.row[left], label[left], shape[left], z.low[left], z.high[left],
                  np.stack([z.a[left], z.b[left]], 1), np.stack([z.a[right], z.b[right]], 1))
    held = np.repeat(np.arange(len(left)), right - left + 1)
    events = np.arange(len(held)) - np.repeat(np.cumsum(right - left + 1) - (right - left + 1), right - left + 1) + np.repeat(left, right - left + 1)
    pairs = np.unique(np.stack([shape[events], found.name[held]], 1), axis=0) if merge else np.empty((0, 2), np.int64)
    return found, pairs


def roots(n: int, pairs: np.ndarray) -> np.ndarray:
    """The smallest number that each of n is connected with."""
    root = np.arange(n)
    while True:
        a, b = root[pairs[:, 0]], root[pairs[:, 1]]
        if (a == b).all():
            return root
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != root[root]).any():
            root = root[root]


class Faces(NamedTuple):
    """`edges` (cell, label, name and x0, y0, x1, y1 in the order of the border), sides on cell borders (cell, label, name,
    axis, line, p0, p1, side), areas (cell, label, name and area of a face there) and pairs of names that are one face."""
    edges: tuple
    borders: tuple
    areas: tuple
    pairs: np.ndarray


def faces(s: sweep.Segments, layer: np.ndarray, cell: np.ndarray, merge: bool) -> Faces:
    """The faces of a batch; `cell` has the box of each cell number."""
    f, pairs = spans(s, layer, merge)
    box = cell[f.cell]
    edges, borders = [], []
    for side, x in ((0, f.left), (1, f.right)):
        upright = (x[:, 0] == x[:, 1]) & ((x[:, 0] == box[:, 0]) | (x[:, 0] == box[:, 2]))
        b, e = np.flatnonzero(upright), np.flatnonzero(~upright)
        borders.append((f.cell[b], f.label[b], f.name[b], np.full(len(b), UPRIGHT), x[b, 0], f.low[b], f.high[b], np.full(len(b), side)))
        down = (x[e, 1], f.high[e], x[e, 0], f.low[e])
        edges.append((f.cell[e], f.label[e], f.name[e], np.stack(down if side == 0 else (down[2], down[3], down[0], down[1]), 1)))
    m = len(f.cell)
    where = np.stack([np.tile(f.cell, 2), np.tile(f.label, 2)], 1)
    y = np.concatenate([f.low, f.high])
    key = np.lexsort((y, where[:, 1], where[:, 0]))
    fresh = np.ones(2 * m, bool)
    fresh[1:] = (where[key][1:] != where[key][:-1]).any(1) | (y[key][1:] != y[key][:-1])
    group = np.empty(2 * m, np.int64)
    group[key] = np.cumsum(fresh) - 1
    of = key[fresh]                                        # a row of each group
    flat = Sides(group, np.concatenate([f.left[:, 0], f.left[:, 1]]), np.concatenate([f.right[:, 0], f.right[:, 1]]),
                 np.repeat([0, 1], m), np.tile(f.name, 2))
    flat = Sides(*(c[flat.p1 > flat.p0] for c in flat))
    left, met = netted(flat)
    c, lab, line = where[of, 0][left.group], where[of, 1][left.group], y[of][left.group]
    edge = (line == cell[c, 1]) | (line == cell[c, 3])
    borders.append((c[edge], lab[edge], left.name[edge], np.full(int(edge.sum()), ACROSS), line[edge], left.p0[edge], left.p1[edge], left.side[edge]))
    inner = ~edge
    x0, x1 = (np.where(left.side == 0, a, b)[inner] for a, b in ((left.p0, left.p1), (left.p1, left.p0)))
    edges.append((c[inner], lab[inner], left.name[inner], np.stack([x0, line[inner], x1, line[inner]], 1)))
    area = (f.right - f.left).sum(1) * (f.high - f.low) / 2
    edges, borders = tuple(map(np.concatenate, zip(*edges))), tuple(map(np.concatenate, zip(*borders)))
    name, links = f.name, np.empty((0, 2), np.int64)
    if merge:                                              # faces that are apart as far as the batch tells
        links = np.concatenate([pairs, met])
        root = roots(int(s.shape.max(initial=0)) + 1, links)
        name, edges, borders = root[name], (edges[0], root[edges[2]], root[edges[2]], *edges[3:]), (*borders[:2], root[borders[2]], *borders[3:])
        some = np.unique(links)
        links = np.stack([some, root[some]], 1)            # each shape with one of its face says as much as all pairs
        links = links[links[:, 0] != links[:, 1]]
    # One area per face and cell.
    by = name if merge else f.label
    order = np.lexsort((by, f.cell))
    fresh = np.flatnonzero(np.append(True, (np.diff(f.cell[order]) != 0) | (np.diff(by[order]) != 0))[:m])
    of = order[fresh]
    total = np.add.reduceat(area[order], fresh) if m else area
    return Faces(edges, borders, (f.cell[of], f.label[of], name[of], total), links)


def directed(axis, line, p0, p1, side) -> list[tuple[tuple[float, float], tuple[float, float]]]:
    """Netted sides as edges with the face on their left."""
    out = []
    for k, at, a, b, s in zip(axis, line, p0, p1, side):
        if k == ACROSS:
            out.append(((a, at), (b, at)) if s == 0 else ((b, at), (a, at)))
        else:
            out.append(((at, b), (at, a)) if s == 0 else ((at, a), (at, b)))
    return out


def _turn(before: tuple, at: tuple, after: tuple) -> float:
    x0, y0, x1, y1 = at[0] - before[0], at[1] - before[1], after[0] - at[0], after[1] - at[1]
    return math.atan2(x0 * y1 - y0 * x1, x0 * x1 + y0 * y1)


def thinned(path: list[tuple], closed: bool) -> list[tuple]:
    """The path without points on a straight line between their neighbours."""
    out: list[tuple] = []
    for p in path:
        while len(out) > 1 and abs(_turn(out[-2], out[-1], p)) < 1e-12:
            out.pop()
        out.append(p)
    if closed:
        while len(out) > 3 and abs(_turn(out[-2], out[-1], out[0])) < 1e-12:
            out.pop()
        while len(out) > 3 and abs(_turn(out[-1], out[0], out[1])) < 1e-12:
            out.pop(0)
    return out


def chained(parts: Sequence[Sequence[tuple]]) -> tuple[list[list[tuple]], list[list[tuple]]]:
    """Closed rings and open paths from parts that end where others start. Where several start, the one furthest to the
    left goes on, so rings that share a corner stay apart."""
    parts = [[(x + 0.0, y + 0.0) for x, y in p] for p in parts]
    starts: dict[tuple, list[int]] = {}
    for k, p in enumerate(parts):
        starts.setdefault(p[0], []).append(k)
    ends = {p[-1] for p in parts}
    heads = [k for k, p in enumerate(parts) if p[0] not in ends] + list(range(len(parts)))
    done, rings, paths = [False] * len(parts), [], []
    for head in heads:
        if done[head]:
            continue
        done[head] = True
        path = list(parts[head])
        while True:
            next_ = [k for k in starts.get(path[-1], ()) if k == head or not done[k]]
            if not next_:
                paths.append(thinned(path, False))
                break
            k = next_[0] if len(next_) == 1 else max(next_, key=lambda k: _turn(path[-2], path[-1], parts[k][1]))
            if k == head:
                rings.append(thinned(path[:-1], True))
                break
            done[k] = True
            path += parts[k][1:]
    return rings, paths
