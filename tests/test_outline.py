"""Polygons in cells: points held, circles clipped, outlines that touch, and one form for every way to write a shape."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from geomill.functions import geometry as G
from geomill.operators import outline, rasterize, surface

GRID = {"minx": -10.0, "maxy": 10.0, "px": 1.0, "nrows": 20, "ncols": 20}


def table(spark, *shapes, names=None):
    rows = [(names[k] if names else k, [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in shape]) for k, shape in enumerate(shapes)]
    return spark.createDataFrame(rows, f"{'iso3 string' if names else 'asdf_id long'}, polygons {rasterize.POLYGONS}")


def box(x0, y0, x1, y1):
    return [(x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0)]


def star(rng, n, cx, cy, r, wobble):
    angle = np.sort(rng.uniform(0, 2 * np.pi, n))
    far = r * (1 + wobble * rng.uniform(-1, 1, n))
    points = list(zip((cx + far * np.cos(angle)).tolist(), (cy + far * np.sin(angle)).tolist(), strict=True))
    return [*points, points[0]]


def edges_of(shape):
    return np.array([(*a, *b) for part in shape for ring in part for a, b in itertools.pairwise(ring)], float)


def inside(edges, x, y):
    x0, y0, x1, y1 = edges.T
    hit = (y0 > y) != (y1 > y)
    return (x < (x1 - x0)[hit] * (y - y0[hit]) / (y1 - y0)[hit] + x0[hit]).sum() % 2 == 1


def test_point_in_polygon_against_brute_force(spark):
    rng = np.random.default_rng(0)
    shapes = [
        [[star(rng, 9, 0, 0, 20, 0.5), star(rng, 7, 0, 0, 5, 0.2)]], [[star(rng, 400, 3, 2, 8, 0.3)], [star(rng, 50, 30, 5, 3, 0.4)]], [[box(0, 0, 8, 8)]], [[star(rng, 3000, -40, 10, 17, 0.02)]],
        [[box(-180, -90, 180, 90)]], [[box(8, 0, 16, 16), box(10, 2, 12, 4)]], [[[(0, 0), (16, 16), (16, 0), (0, 0)]]],
    ]
    places = [*zip(rng.uniform(-60, 40, 400).tolist(), rng.uniform(-10, 30, 400).tolist(), strict=True), *itertools.product((0.0, 4.0, 8.0, 12.0, 16.0), repeat=2), *shapes[0][0][0], *shapes[3][0][0][:50]]
    points = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(places)], "id long, lon double, lat double")
    want = {(k, i) for i, shape in enumerate(shapes) for k, p in enumerate(places) if inside(edges_of(shape), *p)}
    for most in (4, 32):
        tree = outline.border_index(table(spark, *shapes), most)
        assert tree.filter(F.size("tree_edges") > most).count() == 0
        assert {(r.id, r.asdf_id) for r in outline.point_in_polygon(points, table(spark, *shapes), most=most).collect()} == want


def test_a_ring_of_a_million_vertices(spark):
    n = 1_000_000
    angle = lambda i: i * (2 * np.pi / n)
    far = lambda i: F.lit(20.0) + 3 * F.sin(angle(i) * 7) + 0.001 * F.sin(angle(i) * 50_000)
    point = lambda i: F.struct((far(i) * F.cos(angle(i)) + 5).alias("x"), (far(i) * F.sin(angle(i))).alias("y"))
    ring = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), point)
    df = spark.range(1).select(F.col("id").alias("asdf_id"), ring.alias("r")).select("asdf_id", F.array(F.array(F.concat("r", F.slice("r", 1, 1)))).alias("polygons"))
    df = outline.staged(df, "ring")
    flat = df.select("polygons").toArrow()["polygons"].combine_chunks().flatten().flatten().flatten()
    x, y = flat.field("x").to_numpy(), flat.field("y").to_numpy()
    edges = np.stack([x[:-1], y[:-1], x[1:], y[1:]], axis=1)
    rng = np.random.default_rng(1)
    near = rng.integers(0, n, 150)
    places = np.concatenate([rng.uniform(-20, 30, (100, 2)), np.stack([x[near] + rng.normal(0, 1e-4, 150), y[near] + rng.normal(0, 1e-4, 150)], axis=1)])
    points = spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(places)], "id long, lon double, lat double")
    tree = outline.staged(outline.border_index(df), "tree")
    assert tree.agg(F.max(F.size("tree_edges"))).first()[0] <= outline.MOST
    assert {r.id for r in outline.held_by(points, tree).collect()} == {k for k, p in enumerate(places) if inside(edges, *p)}


def test_null_and_broken_outlines_hold_nothing(spark):
    df = spark.createDataFrame([(0, None), (1, []), (2, [[]]), (3, [[[]]]), (4, [[[(1.0, 1.0)]]]), (5, [[[(0.0, 0.0), (0.0, float("nan")), (5.0, 5.0), (0.0, 0.0)]]])], f"asdf_id long, polygons {rasterize.POLYGONS}")
    points = spark.createDataFrame([(1.0, 1.0), (0.5, 0.7)], "lon double, lat double")
    assert outline.point_in_polygon(points, df).filter("asdf_id < 5").count() == 0
    assert outline.point_in_polygon(points, df.limit(0)).count() == 0


# ---- touching ----

LEFT = {
    "square": [[box(0, 0, 4, 4)]], "with a hole": [[box(-9, -9, -1, -1), box(-7, -7, -3, -3)]], "two parts": [[box(6, 6, 8, 8)], [box(-8, 6, -6, 8)]],
    "large": [[box(-30, -40, 60, -20)]], "sharp": [[[(20, 20), (40, 21), (20, 22), (20, 20)]]],
}
RIGHT = {
    "shares a border": ([[box(4, 1, 6, 2)]], {"square"}), "shares a corner": ([[box(4, 4, 5, 5)]], {"square"}), "holds it": ([[box(-1, -1, 5, 5)]], {"square", "with a hole"}),
    "in the hole": ([[box(-6, -6, -4, -4)]], set()), "in the ring": ([[box(-8.5, -8.5, -8, -8)]], {"with a hole"}), "on the hole": ([[box(-7, -6, -6, -5)]], {"with a hole"}),
    "in a part": ([[box(-7.5, 6.5, -7, 7)]], {"two parts"}), "far": ([[box(100, 50, 101, 51)]], set()), "point inside": ([[[(1, 1), (1, 1)]]], {"square"}), "point on a border": ([[[(4, 2), (4, 2)]]], {"square"}),
    "point in the hole": ([[[(-5, -5), (-5, -5)]]], set()), "parts far apart": ([[box(-20, -30, -19, -29)], [box(7, 7, 70, 7.5)]], {"large", "two parts"}), "a hair off": ([[box(4.0000001, 1, 5, 2)]], set()),
    "crosses": ([[[(19, 20.9), (19, 21.1), (50, 21.1), (50, 20.9), (19, 20.9)]]], {"sharp"}),
}


def test_touching(spark):
    left, right = table(spark, *LEFT.values()), table(spark, *(shape for shape, _ in RIGHT.values())).withColumnRenamed("asdf_id", "other")
    want = {(name, other) for other, (_, names) in RIGHT.items() for name in names}
    for level in (0, 2, 4):
        found = outline.touching(left, right, "asdf_id", "other", level).collect()
        assert {(list(LEFT)[r.asdf_id], list(RIGHT)[r.other]) for r in found} == want and len(found) == len(want)


def test_touching_of_dense_outlines(spark):
    """Against all pairs of edges, where cells must be cut finer."""
    rng = np.random.default_rng(2)
    a = [[[star(rng, 700, *rng.uniform(-3, 3, 2), 1, 0.1)]] for _ in range(6)]
    b = [[[star(rng, 400, *rng.uniform(-3, 3, 2), 0.5, 0.2)]] for _ in range(8)]

    def cross(one, two):
        e, f = edges_of(one)[:, None], edges_of(two)[None]
        side = lambda s, x, y: np.sign((s[..., 2] - s[..., 0]) * (y - s[..., 1]) - (s[..., 3] - s[..., 1]) * (x - s[..., 0]))
        met = (side(e, f[..., 0], f[..., 1]) * side(e, f[..., 2], f[..., 3]) <= 0) & (side(f, e[..., 0], e[..., 1]) * side(f, e[..., 2], e[..., 3]) <= 0)
        return met.any() or inside(edges_of(one), *two[0][0][0]) or inside(edges_of(two), *one[0][0][0])

    found = outline.touching(table(spark, *a), table(spark, *b).withColumnRenamed("asdf_id", "other"), "asdf_id", "other").collect()
    assert {(r.asdf_id, r.other) for r in found} == {(i, j) for i, one in enumerate(a) for j, two in enumerate(b) if cross(one, two)}


# ---- circles clipped to a country ----


def test_clipped_circles_against_brute_force(spark):
    rng = np.random.default_rng(3)
    crooked = [[[(-9, -9), (-8, 9), (0.3, 8), (1.7, 3.3), (-0.6, 0.2), (2.1, -3.7), (0.4, -8.8), (-9, -9)], star(rng, 40, -4, -4, 1.5, 0.3)], [star(rng, 12, 6, 6, 1.5, 0.2)]]
    places = [(-4.03, -4.02, 60_000.0), (0.11, 2.07, 90_000.0), (-6.5, 2.5, 40_000.0), (6.1, 6.05, 300_000.0), (8.02, -8.03, 50_000.0), (-5.51, -4.03, 200_000.0), (-7.03, 7.02, 900.0), (5.03, 0.02, 900.0), (1.71, 3.31, 120_000.0)]
    buffers = spark.createDataFrame([(f"g{k}", "AAA", *p) for k, p in enumerate(places)] + [("other", "BBB", 0.0, 0.0, 90_000.0)], "geom string, iso3 string, lon double, lat double, metres double")
    got = {}
    for r in rasterize.clip_buffers(buffers, table(spark, crooked, names=["AAA"]), **GRID).collect():
        got.setdefault(r.geom, {})[r.grid_row, r.grid_col] = r.cover
    border = edges_of(crooked)
    for k, (lon, lat, metres) in enumerate(places):
        x, y = rasterize.buffer_rings(np.array([lon]), np.array([lat]), np.array([metres]))
        ring = np.stack([x[0, :-1], y[0, :-1], x[0, 1:], y[0, 1:]], axis=1)
        want = {}
        for i, j in itertools.product(range(200), range(200)):
            cx, cy = -10 + (j + 0.5) * 0.1, 10 - (i + 0.5) * 0.1
            if x.min() <= cx <= x.max() and y.min() <= cy <= y.max() and inside(ring, cx, cy) and inside(border, cx, cy):
                want[i // 10, j // 10] = want.get((i // 10, j // 10), 0) + 1
        if not want:
            want = {(int(10 - lat), int(lon + 10)): 100} if inside(border, lon, lat) else {(None, None): None}
        assert got[f"g{k}"] == want, k
    assert got["other"] == {(None, None): None}
    assert got["g4"] == {(None, None): None} and got["g7"] == {(None, None): None}  # no overlap


def test_rasterised_bands_add_up(spark):
    """A polygon over many bands, and bands of other sizes."""
    rng = np.random.default_rng(4)
    shape = table(spark, [[star(rng, 200, 0, 0, 8, 0.3), star(rng, 30, 0, 0, 2, 0.3)]])
    cells = {(r.grid_row, r.grid_col): r.cover for r in rasterize.rasterize(shape, -10.0, 10.0, 0.1, 200, 200, 1).collect()}
    edges = edges_of([[[tuple(p) for p in ring] for ring in part] for part in shape.first().polygons])
    assert cells == {(i, j): 1 for i in range(200) for j in range(200) if inside(edges, -10 + (j + 0.5) * 0.1, 10 - (i + 0.5) * 0.1)}


# ---- one form for every way to write a shape ----


def test_equal_shapes_have_one_hash(spark):
    outer, hole, other = box(0, 0, 5, 5), box(1, 1, 2, 2), box(7, 7, 9, 8)
    turn = lambda ring, k: [*ring[k:-1], *ring[:k], ring[k]]
    same = [
        [[outer, hole, box(3, 3, 4, 4)], [other]], [[other[::-1]], [turn(outer, 2), box(3, 3, 4, 4), turn(hole, 3)[::-1]]], [[turn(outer, 3)[::-1], box(3, 3, 4, 4), hole], [turn(other, 1)]],
        [[[(0, 0), (0, 0), *outer[1:]], hole, turn(box(3, 3, 4.0000000004, 4), 1)], [other[:-1]]],
    ]
    apart = [[[outer, hole], [other]], [[outer], [hole], [box(3, 3, 4, 4)], [other]], [[outer, hole, box(3, 3, 4, 4.00001)], [other]]]
    hashes = [r.h for r in table(spark, *same, *apart).select("asdf_id", G.geometry_hash(F.col("polygons")).alias("h")).orderBy("asdf_id").collect()]
    assert len(set(hashes[:4])) == 1 and len(set(hashes)) == 1 + len(apart)
    eight = [[[(0, 0), (2, 2), (2, 0), (0, 0), (-2, 1), (-2, 0), (0, 0)]]]  # its smallest vertices come once, another twice
    again = [[[(0, 0), (-2, 1), (-2, 0), (0, 0), (2, 2), (2, 0), (0, 0)]]]
    pair = [r.h for r in table(spark, eight, again).select(G.geometry_hash(F.col("polygons")).alias("h")).collect()]
    assert pair[0] == pair[1]
    assert table(spark, []).select(G.geometry_hash(F.col("polygons"))).first()[0] is not None


def test_unique_geometries_and_what_touches_them(spark):
    areas = table(spark, [[box(0, 0, 2, 2)]], [[box(0, 0, 2, 2)[::-1]]], [[box(4, 4, 6, 6)]])
    home = table(spark, [[box(-5, -5, 3, 5)]], [[box(3, -5, 9, 5)]], names=["AAA", "BBB"])
    df = spark.createDataFrame(
        [("area|0", "area", "0", None, "AAA", 1.0, 1.0, "1", 5.0), ("area|1", "area", "1", None, "AAA", 1.0, 1.0, "2", 7.0), ("area|2", "area", "2", None, "BBB", 5.0, 5.0, "3", 1.0), ("c", "country", "AAA", None, "AAA", 0.0, 0.0, "4", 10.0),
         ("p", "point", "-1:-1", None, "AAA", -1.0, -1.0, "5", 100.0), ("b", "buffer", "2.9:0", 50_000, "AAA", 2.9, 0.0, "6", 1000.0), ("b2", "buffer", "2.9:0", 50_000, "BBB", 2.9, 0.0, "7", 10_000.0), (None, None, None, None, "AAA", 0.0, 0.0, "8", 3.0)],
        "geom string, geom_kind string, geom_key string, geom_metres int, iso3 string, lon double, lat double, location_id string, adjusted_val double",
    )
    unique = outline.staged(surface.unique_geometries(df.filter("geom IS NOT NULL"), surface.geometry_shapes(df, home, areas)), "unique")
    assert sorted((r.location_ids, r.unique_dollars, r.location_count) for r in unique.collect()) == [("1|2", 12.0, 2), ("3", 1.0, 1), ("4", 10.0, 1), ("5", 100.0, 1), ("6", 1000.0, 1), ("7", 10_000.0, 1)]
    features = table(spark, [[box(-2, -2, -0.5, -0.5)]], [[box(3, -1, 4, 1)]], [[box(3.2, -1, 4, 1)]], [[box(20, 20, 21, 21)]], [[box(0.5, 0.5, 1, 1)]])
    sums = surface.touched_geometries(features, unique, home).groupBy("asdf_id").agg(F.sum("dollars").alias("s")).collect()
    assert {r.asdf_id: r.s for r in sums} == {0: 110.0, 1: 11_010.0, 2: 10_000.0, 4: 22.0}
