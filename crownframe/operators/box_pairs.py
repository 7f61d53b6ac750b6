"""Overlapping boxes within one task, for keys with a bounded number of boxes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from crownframe.operators.masks import _pieces, _spread

CANDIDATES = 1 << 20   # pairs looked at together


def overlapping(a: np.ndarray, b: np.ndarray, most: int = CANDIDATES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of the boxes (rows x0, y0, x1, y1) of `a` and `b` that share area, each pair once.

    Of two boxes that meet in x one starts within the other, so sorted starts give every pair, whatever the widths. Boxes
    with null or non-finite corners meet nothing.
    """
    whole_a, whole_b = (m[np.isfinite(m).all(1)] for m in (a, b))
    at_a, at_b = (np.flatnonzero(np.isfinite(m).all(1)) for m in (a, b))
    order_a, order_b = (np.argsort(m[:, 0], kind="stable") for m in (whole_a, whole_b))
    sides = ((whole_a[order_a], whole_b[order_b], at_a[order_a], at_b[order_b], "left"),
             (whole_b[order_b], whole_a[order_a], at_b[order_b], at_a[order_a], "right"))
    for turn, (own, other, at_own, at_other, side) in enumerate(sides):
        first = np.searchsorted(other[:, 0], own[:, 0], side)
        count = np.maximum(np.searchsorted(other[:, 0], own[:, 2], "left") - first, 0)
        for begin, end in _pieces(count, most):
            i, k = _spread(count[begin:end])
            i += begin
            j = first[i] + k
            x, y = own[i], other[j]
            met = (x[:, 1] < y[:, 3]) & (x[:, 3] > y[:, 1]) & (x[:, 0] < y[:, 2]) & (x[:, 2] > y[:, 0])
            i, j = at_own[i[met]], at_other[j[met]]
            yield (j, i) if turn else (i, j)


def iou(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union row by row, with the steps of `functions.boxes.iou`."""
    w = np.maximum(np.minimum(a[:, 2], b[:, 2]) - np.maximum(a[:, 0], b[:, 0]), 0.0)
    h = np.maximum(np.minimum(a[:, 3], b[:, 3]) - np.maximum(a[:, 1], b[:, 1]), 0.0)
    inter = w * h
    area_a, area_b = ((m[:, 2] - m[:, 0]) * (m[:, 3] - m[:, 1]) for m in (a, b))
    union = area_a + area_b - inter
    return np.divide(inter, union, out=np.zeros(len(inter)), where=union != 0)
