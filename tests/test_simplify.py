"""Simplified outlines: shared borders stay shared, nothing crosses, nothing changes sides; by brute force over all pairs of edges."""

from __future__ import annotations

import itertools
import os

import numpy as np
import pytest

from geomill.operators.simplify import POLYGONS, douglas_peucker, limit_chars, simplify
from geomill.plans import q_geometry, registry

SF_DIR = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame(rows, f"asdf_id long, polygons {POLYGONS}")


def shapes_of(df):
    return {r.asdf_id: r.polygons and [[[(p.x, p.y) for p in ring] for ring in part] for part in r.polygons] for r in df.collect()}


def edges(shape):
    return [(a, b) for part in shape for ring in part for a, b in itertools.pairwise(ring)]


def undirected(shapes):
    return sorted({(min(e), max(e)) for s in shapes.values() for e in edges(s)})


def turn(a, b, c):
    return np.sign((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))


def meets(e, f):
    """Whether two different edges share more than a common end."""
    (a, b), (c, d) = e, f
    box = all(min(a[k], b[k]) <= max(c[k], d[k]) and min(c[k], d[k]) <= max(a[k], b[k]) for k in (0, 1))
    if not box or turn(a, b, c) * turn(a, b, d) > 0 or turn(c, d, a) * turn(c, d, b) > 0:
        return False
    common = {a, b} & {c, d}
    if not common:
        return True
    v = common.pop()
    p, q = (b if a == v else a), (d if c == v else c)
    return turn(p, v, q) == 0 and (p[0] - v[0]) * (q[0] - v[0]) + (p[1] - v[1]) * (q[1] - v[1]) > 0


def crossings(shapes):
    return [(e, f) for e, f in itertools.combinations(undirected(shapes), 2) if meets(e, f)]


def inside(shape, x, y):
    return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in edges(shape)) % 2 == 1


def area(shape):
    return sum(sum(a[0] * b[1] - b[0] * a[1] for a, b in itertools.pairwise(ring)) / 2 for part in shape for ring in part)


def coverage(n, steps, wobble, seed):
    """n * n cells with crooked borders that neighbours share."""
    rng = np.random.default_rng(seed)
    sides = {}

    def side(a, b):
        if (a, b) not in sides:
            t = np.linspace(0, 1, steps)[1:-1]
            p = np.array(a) + np.outer(t, np.subtract(b, a)) + rng.uniform(-wobble, wobble, (steps - 2, 2))
            way = [tuple(map(float, a)), *map(tuple, p.tolist()), tuple(map(float, b))]
            sides[a, b], sides[b, a] = way, way[::-1]
        return sides[a, b]

    out = []
    for i, j in itertools.product(range(n), range(n)):
        corners = [(i * 10, j * 10), (i * 10 + 10, j * 10), (i * 10 + 10, j * 10 + 10), (i * 10, j * 10 + 10)]
        shift = (i + 2 * j) % 4
        corners = corners[shift:] + corners[:shift]
        ring = [p for a, b in zip(corners, corners[1:] + corners[:1], strict=True) for p in side(a, b)[:-1]]
        out.append((i * n + j, [[[*ring, ring[0]]]]))
    return out


@pytest.mark.parametrize("most", [32, 3])
def test_coverage_keeps_its_borders(spark, most):
    rows = coverage(3, 40, 0.1, 1)
    done = shapes_of(simplify(table(spark, rows).repartition(3), 0.4, most=most))
    assert sum(len(edges(s)) for s in done.values()) < 0.3 * sum(len(edges(s)) for _, s in rows)
    count = {}
    for s in done.values():
        for e in edges(s):
            count[min(e), max(e)] = count.get((min(e), max(e)), 0) + 1
    outer = [e for e, k in count.items() if k == 1]
    assert max(count.values()) == 2
    # what only one cell has is the outer border: one closed line, so there are no gaps between neighbours
    ends = [p for e in outer for p in e]
    assert all(ends.count(p) == 2 for p in ends)
    assert all(min(min(p) for p in e) < 1 or max(max(p) for p in e) > 29 for e in outer)
    assert not crossings(done)
    before = dict(rows)
    for k, s in done.items():
        assert set(s[0][0]) <= set(before[k][0][0]) and s[0][0][0] == s[0][0][-1]
        assert np.sign(area(s)) == np.sign(area(before[k]))
        for p in before[k][0][0]:
            far = min(np.hypot(*(np.subtract(p, a) - np.clip(np.dot(np.subtract(p, a), np.subtract(b, a)) / np.dot(np.subtract(b, a), np.subtract(b, a)), 0, 1) * np.subtract(b, a))) for a, b in edges(s))
            assert far <= 0.4 + 1e-9


def test_strips_islands_and_holes_stay_on_their_side(spark):
    """A tolerance wider than the strip between two lines, than an island in a bay, and than a hole by the border."""
    bay = [(0, 0), (20, 0), (20, 10), (11, 10), (10.5, 8), (9.5, 8), (9, 10), (0, 10), (0, 0)]
    island = [(9.9, 9.0), (10.1, 9.0), (10.0, 9.4), (9.9, 9.0)]
    cape = [(30, 0), (50, 0), (50, 10), (41, 10), (40, 12), (39, 10), (30, 10), (30, 0)]
    hole = [(39.9, 10.8), (40.1, 10.8), (40.0, 11.2), (39.9, 10.8)]
    x = np.linspace(60, 80, 41)
    wave = np.sin(x)
    strip = [*zip(x.tolist(), wave.tolist(), strict=True), *zip(x[::-1].tolist(), (wave[::-1] + 0.3).tolist(), strict=True)]
    rows = [(1, [[bay]]), (2, [[island]]), (3, [[cape, hole]]), (4, [[[*strip, strip[0]]]])]
    rows = [(k, [[[(float(a), float(b)) for a, b in ring] for ring in part] for part in s]) for k, s in rows]
    done = shapes_of(simplify(table(spark, rows), 3.0))
    assert not crossings(done)
    assert not inside(done[1], 10.0, 9.1) and len(done[2][0][0]) == 4
    assert inside([done[3][0][:1]], 40.0, 10.9) and len(done[3][0]) == 2
    assert area(done[4]) > 0 and len(done[4][0][0]) < len(strip)
    # without a neighbour the same bay and cape go
    alone = shapes_of(simplify(table(spark, [(1, rows[0][1]), (3, [rows[2][1][0][:1]])]), 3.0))
    assert inside(alone[1], 10.0, 9.1) and not inside(alone[3], 40.0, 10.9)
    # and features of other coverages are no neighbours
    apart = simplify(table(spark, rows[:2]).withColumnRenamed("asdf_id", "own").selectExpr("own as asdf_id", "own % 2 as layer", "polygons"), 3.0, on=("layer",))
    assert apart.columns == ["asdf_id", "layer", "polygons"] and inside(shapes_of(apart)[1], 10.0, 9.1)


def test_random_stars_against_brute_force(spark):
    """Rings round each other and side by side, closer than the tolerance."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(6):
        angle = np.sort(rng.uniform(0, 2 * np.pi, 60))
        cx, cy, r = (k % 3) * 12.0, (k // 3) * 12.0, 5 * (1 + 0.15 * rng.uniform(-1, 1, 60))
        ring = lambda f: [(float(cx + f * a * np.cos(t)), float(cy + f * a * np.sin(t))) for a, t in zip(r, angle, strict=True)]  # noqa: B023, E731
        closed = [[*ring(f), ring(f)[0]] for f in (1.0, 0.96)]
        rows.append((k, [closed]))
    assert not crossings(dict(rows))
    done = shapes_of(simplify(table(spark, rows), 1.0))
    assert not crossings(done)
    for k, s in done.items():
        assert len(s[0]) == 2 and all(inside([s[0][:1]], *p) for p in s[0][1])
    assert sum(len(edges(s)) for s in done.values()) < sum(len(edges(s)) for _, s in rows)


def test_odd_inputs(spark):
    square = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0), (0.0, 0.0)]
    doubled = [p for p in square for _ in (0, 1)]
    broken = [(5.0, 5.0), (float("inf"), 6.0), (6.0, 6.0), (5.0, 5.0)]
    spike = [(20.0, 0.0), (21.0, 0.0), (20.0, 0.0), (20.0, 0.0)]
    rows = [(0, None), (1, []), (2, [[]]), (3, [[square[:4]]]), (4, [[square]]), (5, [[[(a + 9, b) for a, b in doubled]]]), (6, [[broken]]), (None, [[square]]), (7, [[spike]]), (8, [[[]], [square]])]
    done = shapes_of(simplify(table(spark, rows), 0.1))
    assert done[0] is None and done[1] == [] and done[2] == [[]] and done[3] == [[square[:4]]] and done[6] == [[broken]] and done[None] == [[square]]
    assert sorted(undirected({4: done[4]})) == sorted(undirected({4: [[square]]})) and done[5] == [[[(a + 9, b) for a, b in square]]]
    assert len(done) == 10 and simplify(table(spark, []), 0.1).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")
def test_countries_still_fill_the_world(spark):
    rows = registry.queries()["geo_simplify_shared"](spark, SF_DIR).filter("layer = 'country'").collect()
    before = q_geometry.countries(registry.Views(spark, SF_DIR)).collect()
    size = lambda p: area([[[(c.x, c.y) for c in ring] for ring in part] for part in p])
    vertices = sum(len(ring) for r in before for part in r.polygons for ring in part)
    assert len(rows) == len(before) and sum(r.n_vertices for r in rows) < vertices
    # a hole counts less, an enclave more, and what is no country's has three corners at least
    assert sum(abs(r.area) for r in rows) == pytest.approx(sum(abs(size(r.polygons)) for r in before), rel=0.01)


def test_limited_features_against_plain_loops(spark):
    """Features with holes, parts, nothing and null, in tasks that make no Python object of a vertex."""
    rng = np.random.default_rng(4)
    ring = lambda n: [(float(x), float(y)) for x, y in rng.uniform(-90, 90, (n, 2)).round(3)]
    shapes = [[[ring(40), ring(3)], [ring(25)]], None, [], [[]], [[ring(4)]], [[ring(300)], [ring(7), []]], [[ring(2)]]] * 50
    chars = lambda shape: sum(len(repr(x)) + len(repr(y)) + 6 for part in shape for r in part for x, y in r)
    wanted = {}
    for nth, shape in enumerate(shapes):
        now, k = shape, 0
        while shape and chars(now) > 600 and k * 5.0 < 90:
            k += 1
            stay = lambda r: [p for p, yes in zip(r, douglas_peucker(np.array(r), k * 5.0), strict=True) if yes] if len(r) > 3 else r  # noqa: B023, E731
            now = [[kept if len(kept := stay(r)) >= 4 else r for r in part] for part in shape]
            if sum(len(r) for part in now for r in part) <= 4 * sum(map(len, now)):
                break
        wanted[nth] = (now, k * 5.0)
    done = limit_chars(table(spark, list(enumerate(shapes))), limit=600, step=5.0)
    tolerances = {r.asdf_id: r.tolerance for r in done.collect()}
    assert {k: (shape, tolerances[k]) for k, shape in shapes_of(done).items()} == wanted
    assert "MapInArrow" in done._jdf.queryExecution().executedPlan().toString()
