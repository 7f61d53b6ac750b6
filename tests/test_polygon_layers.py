"""Dissolve and overlay of polygons against pixel counts and areas of single shapes."""

import random

import pytest

from crownframe.functions import faces
from crownframe.functions.polygons import shared_area
from crownframe.operators import polygon_layers
from tests.test_fragments import square, star

SHAPES = "product_id int, {} long, rings array<array<double>>"


def frame(spark, rows, ident="id"):
    return spark.createDataFrame(rows, SHAPES.format(ident))


def corners(rng):
    """A shape on the whole grid: a box, an L, a box with a hole or two boxes that meet at a corner."""
    x, y, w, h = rng.randrange(40), rng.randrange(40), rng.randrange(2, 9), rng.randrange(2, 9)
    kind = rng.randrange(4)
    if kind == 0:
        return [square(x, y, x + w, y + h)]
    if kind == 1:
        return [[float(v) for v in (x, y, x + w, y, x + w, y + 1, x + 1, y + 1, x + 1, y + h, x, y + h)]]
    if kind == 2 and w > 3 and h > 3:
        return [square(x, y, x + w, y + h), square(x + 1, y + 1, x + w - 2, y + h - 1)]
    return [square(x, y, x + 2, y + 2), square(x + 2, y + 2, x + 5, y + 4)]


def pixels(rings):
    """Unit squares inside, by parity of the edges left of the middle."""
    out = set()
    for px in range(60):
        for py in range(60):
            odd = 0
            for r in rings:
                for i in range(0, len(r), 2):
                    x0, y0, x1, y1 = r[i], r[i + 1], r[(i + 2) % len(r)], r[(i + 3) % len(r)]
                    odd += x0 == x1 and x0 < px + 0.5 and min(y0, y1) < py + 0.5 < max(y0, y1)
            if odd % 2:
                out.add((px, py))
    return out


def components(shapes):
    """Lowest id and pixels of each group of shapes that share pixels or sides."""
    groups = []
    for i, p in sorted(shapes.items()):
        around = p | {(x + a, y + b) for x, y in p for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))}
        touched = [g for g in groups if g[1] & around]
        groups = [g for g in groups if g not in touched]
        groups.append((min([i, *(g[0] for g in touched)]), set().union(p, *(g[1] for g in touched))))
    return {i: p for i, p in groups}


@pytest.mark.parametrize("level", [None, 0, 1, 3])
def test_dissolve_is_the_union_of_pixels(spark, level):
    rng = random.Random(11)
    shapes = {i: corners(rng) for i in range(45)}
    got = polygon_layers.dissolve_polygons(frame(spark, [(1, i, s) for i, s in shapes.items()]), "id", level=level).collect()
    want = components({i: pixels(s) for i, s in shapes.items()})
    assert {r.component: r.area for r in got} == {i: len(p) for i, p in want.items()} and len(got) == len(want)
    for r in got:
        assert pixels(r.rings) == want[r.component]
        for ring in r.rings:                          # corners only, and no ring crosses itself
            assert len(set(zip(ring[0::2], ring[1::2]))) == len(ring) // 2


def test_dissolve_of_crossing_outlines(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for k in range(25):
        a, b = [star(rng, 100.0 * k, 50, 30)], [star(rng, 100.0 * k + rng.uniform(-30, 30), 60, 30)]
        rows += [(k % 2, 2 * k, a), (k % 2, 2 * k + 1, b)]
        both = shared_area(a, b)
        parts = [(2 * k, shared_area(a) + shared_area(b) - both)] if both else [(2 * k, shared_area(a)), (2 * k + 1, shared_area(b))]
        want |= dict(parts)
    rows += [(0, 900, None), (0, 901, []), (0, 902, [[1.0, 1.0, 5.0, 5.0]]), (0, 903, rows[0][2])]
    got = {}
    for level in (1, 2, 4):
        out = polygon_layers.dissolve_polygons(frame(spark, rows), "id", level=level).collect()
        got[level] = {r.component: r.area for r in out}
        assert got[level] == pytest.approx(want)
        for r in out:
            assert shared_area(r.rings) == pytest.approx(r.area)


def test_overlay_pieces_are_disjoint_and_whole(spark):
    rng = random.Random(5)
    a = [(1, i, [star(rng, 60.0 * (i % 5), 60.0 * (i // 5), 28)]) for i in range(20)]
    b = [(1, i, [star(rng, 60.0 * (i % 5) + 20, 60.0 * (i // 5) + 15, 29)]) for i in range(20)] + [(2, 77, [square(0, 0, 4, 4)])]
    got = polygon_layers.overlay_polygons(frame(spark, a, "a_id"), frame(spark, b, "b_id"), level=2).collect()
    want = {}
    for _, i, s in a:
        for k, j, t in b:
            v = shared_area(s, t) if k == 1 else 0
            if v > 0:
                want[1, i, j] = v
        want[1, i, None] = shared_area(s) - sum(v for (_, p, q), v in want.items() if p == i and q is not None)
    for k, j, t in b:
        want[k, None, j] = shared_area(t) - sum(v for (_, p, q), v in want.items() if q == j and p is not None)
    want = {k: v for k, v in want.items() if v > 1e-9}
    found = {(r.product_id, r.a_id, r.b_id): r.area for r in got if r.area > 1e-9}
    assert found == {k: pytest.approx(v) for k, v in want.items()} and sum(1 for k in want if None not in k) > 20
    rings = {(r.product_id, r.a_id, r.b_id): r.rings for r in got}
    for k, s in rings.items():
        assert shared_area(s) == pytest.approx(found.get(k, 0), abs=1e-6)
    for (_, p, q), s in list(rings.items())[:15]:
        inside = [shared_area(s, x[2]) for x in a if x[1] == p] + [shared_area(s, x[2]) for x in b if x[1] == q and q != 77]
        assert all(v == pytest.approx(shared_area(s), abs=1e-6) for v in inside)


def test_overlay_of_layers_that_share_borders(spark):
    """Grids of squares in two layers, one shifted by half a square: all borders meet or coincide."""
    a = [(1, 10 * x + y, [square(4 * x, 4 * y, 4 * x + 4, 4 * y + 4)]) for x in range(4) for y in range(4)]
    b = [(1, 10 * x + y, [square(4 * x + 2, 4 * y, 4 * x + 6, 4 * y + 4)]) for x in range(4) for y in range(4)]
    got = polygon_layers.overlay_polygons(frame(spark, a, "a_id"), frame(spark, b, "b_id"), level=1).collect()
    assert {r.area for r in got} == {8.0} and sum(r.area for r in got) == 18 * 16 and all(len(r.rings) == 1 and len(r.rings[0]) == 8 for r in got)


def test_empty_layers(spark):
    none = frame(spark, [], "a_id")
    assert polygon_layers.overlay_polygons(none, frame(spark, [], "b_id")).count() == 0
    assert polygon_layers.dissolve_polygons(none, "a_id").count() == 0


def test_rings_that_share_a_corner_stay_apart():
    parts = [[(0, 0), (2, 0)], [(2, 0), (2, 2)], [(2, 2), (0, 2)], [(0, 2), (0, 0)],
             [(2, 2), (4, 2)], [(4, 2), (4, 4)], [(4, 4), (2, 4)], [(2, 4), (2, 2)]]
    rings, paths = faces.chained(parts[3:] + parts[:3])
    assert not paths and sorted(map(sorted, rings)) == [[(0, 0), (0, 2), (2, 0), (2, 2)], [(2, 2), (2, 4), (4, 2), (4, 4)]]
    rings, paths = faces.chained(parts[:3])
    assert not rings and paths == [[(0, 0), (2, 0), (2, 2), (0, 2)]]
