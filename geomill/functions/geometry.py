"""Boxes, grids and vertex arithmetic as column expressions.

A box is struct(minx, miny, maxx, maxy); a ring is array<struct<x, y>>, closed; polygons are array<array<ring>> with holes
after the outer ring. A grid is described by its top-left corner and pixel size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GLOBAL_AREA = 22500
SIDES = ("minx", "miny", "maxx", "maxy")


def box(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    return F.struct(*(c.cast("double").alias(n) for n, c in zip(SIDES, (minx, miny, maxx, maxy), strict=True)))


def envelope(df: DataFrame, by: str, bbox: str = "bbox") -> DataFrame:
    """The box around all boxes of a group (files of a dataset, features of a boundary)."""
    b = F.col(bbox)
    return df.groupBy(by).agg(F.min(b["minx"]).alias("minx"), F.min(b["miny"]).alias("miny"), F.max(b["maxx"]).alias("maxx"), F.max(b["maxy"]).alias("maxy"))


def grid_box(minx: Column, maxy: Column, px: Column, nrows: Column, ncols: Column) -> Column:
    """The box of a raster from its header."""
    return box(minx, maxy - nrows * px, minx + ncols * px, maxy)


def points_envelope(df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """One row: the box of the points whose coordinates are numbers."""
    points = df.select(F.expr(f"try_cast({lon} AS double)").alias("x"), F.expr(f"try_cast({lat} AS double)").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    return points.agg(F.min("x").alias("minx"), F.min("y").alias("miny"), F.max("x").alias("maxx"), F.max("y").alias("maxy"), F.count("*").alias("n_points"))


def trim_envelope(b: Column) -> Column:
    clip = lambda c, limit: F.greatest(F.lit(-limit), F.least(F.lit(limit), c))
    return box(clip(b["minx"], 180.0), clip(b["miny"], 90.0), clip(b["maxx"], 180.0), clip(b["maxy"], 90.0))


def box_area(b: Column) -> Column:
    return (b["maxx"] - b["minx"]) * (b["maxy"] - b["miny"])


def scale_of(b: Column) -> Column:
    return F.when(box_area(b) >= GLOBAL_AREA, "global").otherwise("regional")


def boxes_meet(a: Column, b: Column) -> Column:
    return (a["minx"] <= b["maxx"]) & (a["maxx"] >= b["minx"]) & (a["miny"] <= b["maxy"]) & (a["maxy"] >= b["miny"])


def snap_grid(b: Column, px: float) -> Column:
    """Snap a box out to the grid: struct(minx, miny, maxx, maxy, nrows, ncols). 1 / px must be whole."""
    inverse = round(1 / px)
    if inverse < 1 or abs(inverse * px - 1) > 1e-9:
        raise ValueError(f"invalid pixel size: {px}")
    low, high = (lambda c: F.floor(c * inverse)), (lambda c: F.ceil(c * inverse))
    cells = {"minx": low(b["minx"]), "miny": low(b["miny"]), "maxx": high(b["maxx"]), "maxy": high(b["maxy"])}
    sides = [(c / F.lit(float(inverse))).alias(n) for n, c in cells.items()]
    return F.struct(*sides, (cells["maxy"] - cells["miny"]).cast("int").alias("nrows"), (cells["maxx"] - cells["minx"]).cast("int").alias("ncols"))


def cell_of(lon: Column, lat: Column, minx: float, maxy: float, px: float, nrows: int, ncols: int) -> Column:
    """struct(grid_row, grid_col, inside) of the cell that holds a point, counted from the top left."""
    r, c = F.floor((F.lit(maxy) - lat) / px).cast("int"), F.floor((lon - F.lit(minx)) / px).cast("int")
    return F.struct(r.alias("grid_row"), c.alias("grid_col"), ((r >= 0) & (r < nrows) & (c >= 0) & (c < ncols)).alias("inside"))


def edges_of(polygons: Column) -> Column:
    """All edges of all rings: array of struct(x0, y0, x1, y1)."""
    edge = lambda r, i: F.struct(F.get(r, i - 1)["x"].alias("x0"), F.get(r, i - 1)["y"].alias("y0"), F.get(r, i)["x"].alias("x1"), F.get(r, i)["y"].alias("y1"))
    return F.flatten(F.transform(F.flatten(polygons), lambda r: F.when(F.size(r) > 1, F.transform(F.sequence(F.lit(1), F.size(r) - 1), lambda i: edge(r, i))).otherwise(F.array())))


def centroid(polygons: Column) -> Column:
    """struct(x, y): the centroid by area, the mean of the vertices where there is no area."""
    edges = edges_of(polygons)
    cross = lambda e: e["x0"] * e["y1"] - e["x1"] * e["y0"]
    total = lambda f: F.aggregate(edges, F.lit(0.0), lambda a, e: a + f(e))
    twice = total(cross)
    mean = lambda axis: total(lambda e: e[f"{axis}0"]) / F.size(edges)
    at = lambda axis: F.when(twice != 0, total(lambda e: (e[f"{axis}0"] + e[f"{axis}1"]) * cross(e)) / (3 * twice)).otherwise(mean(axis))
    return F.struct(at("x").alias("x"), at("y").alias("y"))


def ring_area(ring: Column) -> Column:
    """Signed shoelace area."""
    at = F.sequence(F.lit(1), F.size(ring) - 1)
    twice = F.aggregate(at, F.lit(0.0), lambda a, i: a + (F.get(ring, i - 1)["x"] * F.get(ring, i)["y"] - F.get(ring, i)["x"] * F.get(ring, i - 1)["y"]))
    return F.when(F.size(ring) > 2, twice / 2).otherwise(F.lit(0.0))


def area(polygons: Column) -> Column:
    """Planar area: outer rings minus holes."""
    one = lambda rings: F.aggregate(F.transform(rings, lambda r, i: F.when(i == 0, F.abs(ring_area(r))).otherwise(-F.abs(ring_area(r)))), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(F.transform(polygons, one), F.lit(0.0), lambda a, x: a + x)


def geometry_issues(polygons: Column) -> Column:
    """The sorted names of what makes a geometry unusable: empty, few points, open ring, non-finite, zero area."""
    rings = F.flatten(polygons)
    issue = lambda test, name: F.when(test, F.lit(name))
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    issues = F.array(
        issue(F.coalesce(F.size(rings), F.lit(0)) < 1, "empty"),
        issue(F.exists(rings, lambda r: F.size(r) < 4), "few points"),
        issue(F.exists(rings, lambda r: F.exists(r, lambda p: bad(p["x"]) | bad(p["y"]))), "non-finite"),
        issue(F.exists(rings, lambda r: (F.get(r, F.lit(0))["x"] != F.get(r, F.size(r) - 1)["x"]) | (F.get(r, F.lit(0))["y"] != F.get(r, F.size(r) - 1)["y"])), "open ring"),
        issue(F.exists(rings, lambda r: ring_area(F.concat(r, F.slice(r, 1, 1))) == 0), "zero area"),  # an open ring is closed for this
    )
    return F.array_sort(F.array_compact(issues))


def round_coords(polygons: Column, places: int = 6) -> Column:
    """Coordinates rounded, longitudes of 180 and beyond clamped to just under 180."""
    edge = 180 - 10.0**-places
    clamp = lambda v: F.when(v >= 180, edge).when(v <= -180, -edge).otherwise(F.round(v, places))
    point = lambda p: F.struct(clamp(p["x"]).alias("x"), F.round(p["y"], places).alias("y"))
    return F.transform(polygons, lambda rings: F.transform(rings, lambda r: F.transform(r, point)))


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _canonical_ring(ring: Column) -> Column:
    """Of all ways to write a ring, from any vertex and in either direction, the smallest."""
    opened = lambda r: F.when((F.size(r) > 1) & (F.get(r, F.lit(0)) == F.element_at(r, -1)), F.slice(r, F.lit(1), F.size(r) - 1)).otherwise(r)
    # a vertex equal to the one before it adds nothing
    apart = lambda r: F.filter(r, lambda p, i: (i == 0) | (p != F.get(r, i - 1)))
    turned = lambda way, i: F.concat(F.slice(way, i, F.size(way)), F.slice(way, F.lit(1), i - 1))

    def least(way: Column) -> Column:
        starts = _with(F.array_min(way), lambda first: F.filter(F.transform(way, lambda p, i: F.when(p == first, i + 1)), lambda i: i.isNotNull()))
        return F.array_min(F.transform(starts, lambda i: turned(way, i)))

    smaller = lambda points: F.when(F.size(points) > 0, F.least(least(points), _with(F.reverse(points), least))).otherwise(points)
    return _with(ring, lambda r: _with(opened(r), lambda o: _with(apart(o), smaller)))


def canonical(polygons: Column, places: int = 6) -> Column:
    """One form for all ways to write the same polygons: coordinates as whole numbers of 10 ** -places degrees, rings open, from their
    smallest vertex in the smaller direction, holes and parts in order. Equal shapes have equal forms."""
    whole = lambda v: F.round(v * 10.0**places).cast("long")
    ring = lambda r: _canonical_ring(F.transform(r, lambda p: F.struct(whole(p["x"]).alias("x"), whole(p["y"]).alias("y"))))
    part = lambda rings: _with(F.transform(rings, ring), lambda done: F.concat(F.slice(done, 1, 1), F.array_sort(F.slice(done, 2, F.size(done)))))
    return F.array_sort(F.transform(F.filter(polygons, lambda rings: F.size(rings) > 0), part))


def geometry_text(polygons: Column, places: int = 6) -> Column:
    """The canonical form as text: `x y` of each vertex, joined by `,` in a ring, `;` in a part and `|` between parts."""
    join = lambda items, mark, f: F.array_join(F.transform(items, f), mark)
    point = lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))
    return join(canonical(polygons, places), "|", lambda part: join(part, ";", lambda ring: join(ring, ",", point)))


def geometry_hash(polygons: Column, places: int = 6) -> Column:
    """SHA-1 of the canonical form: the identity of a geometry, however it is written."""
    return F.sha1(geometry_text(polygons, places).cast("binary"))


def inside_edges(x: Column, y: Column, edges: Column) -> Column:
    """Even-odd test over edges (so holes and parts count), half-open: left and lower edges belong to the inside."""

    def step(n: Column, e: Column) -> Column:
        across = (e["y0"] > y) != (e["y1"] > y)
        return n + F.when(across & (x < (e["x1"] - e["x0"]) * (y - e["y0"]) / (e["y1"] - e["y0"]) + e["x0"]), 1).otherwise(0)

    return F.aggregate(edges, F.lit(0), step) % 2 == 1


def polygon_of_box(b: Column) -> Column:
    corner = lambda x, y: F.struct(b[x].alias("x"), b[y].alias("y"))
    ring = F.array(corner("minx", "maxy"), corner("minx", "miny"), corner("maxx", "miny"), corner("maxx", "maxy"), corner("minx", "maxy"))
    return F.array(F.array(ring))


def polygons_box(polygons: Column) -> Column:
    points = F.flatten(F.flatten(polygons))
    side = lambda pick, axis: pick(F.transform(points, lambda p: p[axis]))
    return box(side(F.array_min, "x"), side(F.array_min, "y"), side(F.array_max, "x"), side(F.array_max, "y"))
