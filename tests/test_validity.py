"""Rings that cross, touch and fold back, against all pairs of edges."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from geomill.operators import rasterize, validity

BOX = [(0, 0), (0, 8), (8, 8), (8, 0), (0, 0)]
CASES = [
    ([[BOX]], []), ([[BOX, [(1, 1), (1, 2), (2, 2), (1, 1)]]], []), ([[[(0, 0), (8, 8), (8, 0), (0, 5), (0, 0)]]], ["crossing"]),
    ([[[(0, 0), (4, 0), (4, -3), (4, 0), (8, 0), (8, 8), (0, 0)]]], ["spike", "touching"]), ([[[(0, 0), (0, 8), (0, 4), (8, 4), (0, 0)]]], ["spike", "touching"]),
    ([[BOX, [(0, 4), (2, 5), (2, 3), (0, 4)]]], ["touching rings"]), ([[BOX, [(7, 4), (9, 5), (7, 3), (7, 4)]]], ["crossing"]), ([[BOX, [(0, 1), (0, 5), (2, 3), (0, 1)]]], ["crossing", "touching rings"]),
    ([[BOX], [[(8, 8), (8, 9), (9, 9), (8, 8)]]], []), ([[BOX], [[(7, 7), (7, 9), (9, 9), (9, 7), (7, 7)]]], ["crossing"]), ([[BOX], [[(8, 1), (8, 3), (9, 2), (8, 1)]]], ["crossing"]),
    ([[[(0, 0), (0, 0), (0, 8), (8, 8), (8, 8), (8, 0), (0, 0)]]], []), ([[[(0, 0), (3, 3), (6, 0), (6, 6), (3, 3), (0, 6), (0, 0)]]], ["touching"]), (None, []), ([], []), ([[]], []), ([[[(1, 1)]]], []), ([[[(0, 0), (0, float("nan")), (1, 1), (0, 0)]]], []),
    ([[[(0, 0), (5, 0), (0, 0)]]], ["spike"]),
]


def table(spark, shapes):
    rows = [(k, shape and [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in shape] if shape is not None else None) for k, shape in enumerate(shapes)]
    return spark.createDataFrame(rows, f"asdf_id long, polygons {rasterize.POLYGONS}")


@pytest.mark.parametrize(("level", "most"), [(0, 32), (2, 32), (0, 1)])
def test_named_cases(spark, level, most):
    got = {r.asdf_id: r.issues for r in validity.crossing_issues(table(spark, [s for s, _ in CASES]), level=level, most=most).collect()}
    assert got == {k: names for k, (_, names) in enumerate(CASES) if names}


def test_against_all_pairs(spark):
    """Walks of many steps cross themselves now and then."""
    rng = np.random.default_rng(6)
    shapes = []
    for k in range(12):
        n = 12 + 40 * k
        angle = np.sort(rng.uniform(0, 2 * np.pi, n))
        far = rng.uniform(3, 5, n)
        if k % 3 == 1:
            i = rng.integers(0, n - 3)
            angle[[i, i + 2]] = angle[[i + 2, i]]
        points = np.stack([far * np.cos(angle), far * np.sin(angle)], axis=1)
        shapes.append([[[*map(tuple, points.tolist()), tuple(points[0].tolist())]]])

    def crosses(ring):
        edges = list(itertools.pairwise(ring))
        side = lambda a, b, c: np.sign((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))
        return any(j - i not in (1, len(edges) - 1) and side(*e, f[0]) * side(*e, f[1]) < 0 and side(*f, e[0]) * side(*f, e[1]) < 0 for (i, e), (j, f) in itertools.combinations(enumerate(edges), 2))

    want = {k for k, shape in enumerate(shapes) if crosses(shape[0][0])}
    got = {r.asdf_id: r.issues for r in validity.crossing_issues(table(spark, shapes)).collect()}
    assert set(got) == want and want and len(want) < len(shapes) and all(names == ["crossing"] for names in got.values())


def test_all_issues_has_every_feature(spark):
    got = {r.asdf_id: r.issues for r in validity.all_issues(table(spark, [s for s, _ in CASES])).collect()}
    assert len(got) == len(CASES) and got[0] == [] and got[2] == ["crossing"] and got[14] == ["empty"] and got[17] == ["non-finite"] and got[18] == ["few points", "spike", "zero area"]


def test_no_exploded_edges_are_broadcast(spark):
    """However small Spark takes the file of the features for: cells of edges are many times as many."""
    plan = validity.all_issues(table(spark, [s for s, _ in CASES]))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 2
