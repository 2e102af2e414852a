"""Outlines of polygons in cells: which polygons hold a point, and which polygons touch each other.

Edges are dealt into the square cells that they run through, so whatever is joined or tested meets by equality of cells and never
carries a whole outline. Cells count from ORIGIN, an odd place, so that no cell line runs along coordinates with few decimals; cells of
level k are ROOT / FAN ** k degrees wide, and as these are powers of two, levels nest exactly.

Inside is even-odd and half-open, as in `functions.geometry.inside_edges`: a place on an edge counts as lying right of it and, on a level
edge, above it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomill.functions import geometry as G
from geomill.sources.tables import staged

ORIGIN = {"x": -180.0137035999, "y": -90.0072973525}
ROOT, FAN, DEEPEST = 16.0, 4, 12
MOST = 32  # edges of a cell
SIDES = ("x0", "y0", "x1", "y1")
CELL = ("tree_level", "cell_x", "cell_y", "tree_parity")


def size_of(level: Column | int) -> Column:
    return F.lit(ROOT) / F.pow(F.lit(float(FAN)), F.lit(level) if isinstance(level, int) else level)


def index(v: Column, axis: str, size: Column) -> Column:
    return F.floor((v - ORIGIN[axis]) / size).cast("long")


def line(i: Column, axis: str, size: Column) -> Column:
    """Where cell number i begins."""
    return F.lit(ORIGIN[axis]) + i * size


def outline(features: DataFrame) -> DataFrame:
    """The edges of features (polygons, ...): their other columns, x0, y0, x1, y1."""
    keys = [c for c in features.columns if c != "polygons"]
    return features.select(*keys, F.explode(G.edges_of(F.col("polygons"))).alias("_e")).select(*keys, *(F.col(f"_e.{s}").alias(s) for s in SIDES))


def with_cells(edges: DataFrame, size: Column, inside_of: Column | None = None, fan: Column | None = None) -> DataFrame:
    """Edges with every cell (cell_x, cell_y) of `size` that they run through; a hair more, so that rounding loses none. `inside_of`, a struct (cell_x, cell_y) of a coarser cell
    `fan` times as wide, keeps to the cells in it."""
    x0, y0, x1, y1 = map(F.col, SIDES)
    south, north, hair = F.least(y0, y1), F.greatest(y0, y1), size * 1e-9

    def span(low: Column, high: Column, axis: str, coarse: str) -> Column:
        a, b = index(low - hair, axis, size), index(high + hair, axis, size)
        if inside_of is not None:
            first = inside_of[coarse] * fan
            a, b = F.greatest(a, first), F.least(b, first + fan - 1)
        return F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))

    rows = edges.withColumn("_iy", F.explode(span(south, north, "y", "cell_y")))
    at = lambda y: F.when(y1 != y0, x0 + (x1 - x0) * (F.least(north, F.greatest(south, y)) - y0) / (y1 - y0))
    low, high = at(line(F.col("_iy"), "y", size) - hair), at(line(F.col("_iy") + 1, "y", size) + hair)
    west, east = F.coalesce(F.least(low, high), F.least(x0, x1)), F.coalesce(F.greatest(low, high), F.greatest(x0, x1))
    return rows.withColumn("_ix", F.explode(span(west, east, "x", "cell_x"))).drop("cell_x", "cell_y").withColumnsRenamed({"_ix": "cell_x", "_iy": "cell_y"})


def above(e: dict[str, Column], x: Column, y: Column) -> Column:
    """Whether an edge passes just right of `x` above the height y, on a tie if it rises."""
    height = (e["y1"] - e["y0"]) * (x - e["x0"]) / (e["x1"] - e["x0"]) + e["y0"]
    return (height > y) | ((height == y) & (e["y1"] != e["y0"]) & ((e["y1"] > e["y0"]) == (e["x1"] > e["x0"])))


def crossings(e: dict[str, Column], corner: tuple[Column, Column], x: Column, y: Column) -> Column:
    """How often (0 to 2) an edge crosses the way from a corner up or down to the height y, then level to (x, y) west of it."""
    cx, cy = corner
    upright = ((e["x0"] > cx) != (e["x1"] > cx)) & (above(e, cx, cy) != above(e, cx, y))
    place = (e["x1"] - e["x0"]) * (y - e["y0"]) / (e["y1"] - e["y0"]) + e["x0"]
    level = ((e["y0"] > y) != (e["y1"] > y)) & (x < place) & ~(cx < place)
    return F.when(upright, 1).otherwise(0) + F.when(level, 1).otherwise(0)


def corner_of(ix: Column, iy: Column, size: Column) -> tuple[Column, Column]:
    """A cell's lower right corner, whose side its parity tells."""
    return line(ix + 1, "x", size), line(iy, "y", size)


def _numpy_crossings(e: np.ndarray, corner: tuple[float, float], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many edges each way crosses, as `crossings` has it: ways from one corner to the places (x, y)."""
    (x0, y0, x1, y1), (cx, cy) = e.T, corner
    upright = np.flatnonzero((x0 > cx) != (x1 > cx))
    height = (y1 - y0)[upright] * (cx - x0[upright]) / (x1 - x0)[upright] + y0[upright]
    rising = (y1 != y0)[upright] & ((y1 > y0) == (x1 > x0))[upright]
    over = lambda at: (height > at) | ((height == at) & rising)
    out = np.empty(len(x), np.int64)
    for k, (to_x, to_y) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
        level = np.flatnonzero((y0 > to_y) != (y1 > to_y))
        place = (x1 - x0)[level] * (to_y - y0[level]) / (y1 - y0)[level] + x0[level]
        out[k] = (over(cy) != over(to_y)).sum() + ((to_x < place) & ~(cx < place)).sum()
    return out


def _in_cells(e: np.ndarray, ix: range, iy: range, size: float) -> list[np.ndarray]:
    """The edges that run through each cell of a block (a hair more, so that rounding loses none), row by row."""
    x0, y0, x1, y1 = e.T
    south, north, hair = np.minimum(y0, y1), np.maximum(y0, y1), size * 1e-9
    out = []
    for j in iy:
        low, high = ORIGIN["y"] + j * size - hair, ORIGIN["y"] + (j + 1) * size + hair
        row = np.flatnonzero((north >= low) & (south <= high))
        with np.errstate(divide="ignore", invalid="ignore"):
            at = lambda y: (x1 - x0)[row] * (np.clip(y, south[row], north[row]) - y0[row]) / (y1 - y0)[row] + x0[row]
            one, two = at(low), at(high)
        flat = y0[row] == y1[row]
        west, east = np.where(flat, np.minimum(x0, x1)[row], np.minimum(one, two)), np.where(flat, np.maximum(x0, x1)[row], np.maximum(one, two))
        for i in ix:
            left, right = ORIGIN["x"] + i * size - hair, ORIGIN["x"] + (i + 1) * size + hair
            out.append(e[row[(east >= left) & (west <= right)]])
    return out


def quadtree(e: np.ndarray, most: int) -> list[tuple]:
    """(level, cell_x, cell_y, parity, edges) of the leaves over an outline (x0, y0, x1, y1); a leaf inside has None as edges, cells outside are
    left out. Parity is that of a cell's lower right corner: of the edges that the level line from there meets in the east at
    a root cell, and over the way from the parent's corner below."""
    if not len(e):
        return []
    (west, south), (east, north) = np.minimum(e[:, :2], e[:, 2:]).min(axis=0), np.maximum(e[:, :2], e[:, 2:]).max(axis=0)
    number = lambda v, axis: int(np.floor((v - ORIGIN[axis]) / ROOT))
    ix, iy = range(number(west, "x"), number(east, "x") + 1), range(number(south, "y"), number(north, "y") + 1)
    x0, y0, x1, y1 = e.T
    parities = []
    for j in iy:
        y = ORIGIN["y"] + j * ROOT
        hit = (y0 > y) != (y1 > y)
        places = (x1 - x0)[hit] * (y - y0[hit]) / (y1 - y0)[hit] + x0[hit]
        parities += [int((ORIGIN["x"] + (i + 1) * ROOT < places).sum() % 2) for i in ix]
    cells = [(0, i, j) for j in iy for i in ix]
    waiting, leaves = [(*c, p, part) for c, p, part in zip(cells, parities, _in_cells(e, ix, iy, ROOT), strict=True)], []
    while waiting:
        k, i, j, parity, part = waiting.pop()
        if not len(part):
            if parity:
                leaves.append((k, i, j, parity, None))
        elif len(part) <= most or k == DEEPEST:
            leaves.append((k, i, j, parity, part))
        else:
            size, finer = ROOT / FAN**k, ROOT / FAN ** (k + 1)
            across, up = range(i * FAN, (i + 1) * FAN), range(j * FAN, (j + 1) * FAN)
            to_x, to_y = np.tile(ORIGIN["x"] + (np.array(across) + 1) * finer, FAN), np.repeat(ORIGIN["y"] + np.array(up) * finer, FAN)
            ways = _numpy_crossings(part, (ORIGIN["x"] + (i + 1) * size, ORIGIN["y"] + j * size), to_x, to_y)
            children = [(k + 1, a, b) for b in up for a in across]
            waiting += [(*c, (parity + int(n)) % 2, own) for c, n, own in zip(children, ways, _in_cells(part, across, up, finer), strict=True)]
    return leaves


def edges_of_lists(polygons: pa.Array) -> list[np.ndarray]:
    """The edges (x0, y0, x1, y1) of each of an Arrow array of polygons, as `functions.geometry.edges_of` has them."""
    sizes = lambda a: a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = lambda n: np.append(0, np.cumsum(n))
    parts, rings = polygons.flatten(), polygons.flatten().flatten()
    points = rings.flatten()
    x, y = (points.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
    at = ends(sizes(rings))
    first = np.ones(len(x), bool)
    first[at[:-1][at[:-1] < len(x)]] = False  # an edge ends at every vertex but a ring's first
    to = np.flatnonzero(first)
    edges = np.stack([x[to - 1], y[to - 1], x[to], y[to]], axis=1)
    until = at[ends(sizes(parts))[ends(sizes(polygons))]]
    return np.split(edges, np.searchsorted(to, until[1:-1])) if len(polygons) else []


def border_index(features: DataFrame, most: int = MOST) -> DataFrame:
    """The quadtrees of features (polygons, ...), one for each row: its other columns, tree_level, cell_x, cell_y, tree_parity, tree_edges. Stage
    it: it is read more than once.

    A cell without edges that lies inside has null as edges; cells outside have no row. A border cell holds its edges, `most` at most, and the
    parity of its lower right corner; cells with more are cut into FAN * FAN smaller ones, down to level DEEPEST, where
    a cell keeps what it has (vertices within some micrometres of each other). An outline is a row's value, so a task builds its whole
    tree; from there on only its leaves are moved."""
    keys = [c for c in features.columns if c != "polygons"]
    kinds = "".join(f"`{c}` {features.schema[c].dataType.simpleString()}, " for c in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, edges in enumerate(edges_of_lists(batch["polygons"])):
                edges = edges[np.isfinite(edges).all(axis=1)]
                leaves = quadtree(edges, most)
                if leaves:
                    kept = np.concatenate([np.zeros((0, 4)), *(e for *_, e in leaves if e is not None)])
                    ends = np.cumsum([0, *(0 if e is None else len(e) for *_, e in leaves)])
                    offsets = pa.array([None if leaf[-1] is None else int(at) for leaf, at in zip(leaves, ends[:-1], strict=True)] + [int(ends[-1])], pa.int32())
                    structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in kept.T], list(SIDES))
                    columns = [pa.array([leaf[c] for leaf in leaves], kind) for c, kind in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int32()))]
                    own = [batch[c].take(pa.array(np.full(len(leaves), row))) for c in keys]
                    yield pa.RecordBatch.from_arrays([*own, *columns, pa.ListArray.from_arrays(offsets, structs)], [*keys, *CELL, "tree_edges"])

    return features.select(*keys, "polygons").mapInArrow(run, f"{kinds}tree_level int, cell_x bigint, cell_y bigint, tree_parity int, tree_edges array<struct<x0:double,y0:double,x1:double,y1:double>>")


def held_by(places: DataFrame, tree: DataFrame, on: tuple[str, ...] = ()) -> DataFrame:
    """places (lon, lat, and `on`) joined with the features of a tree (`border_index`) that hold them and agree in `on`. A place asks one
    cell of each level that the tree has; where cells have no edges no test is needed. Nothing but the test follows the join, so Spark
    splits a cell that many places ask."""
    levels = [r.tree_level for r in tree.select("tree_level").distinct().collect()]  # DEEPEST + 1 at most
    lon, lat = F.col("lon"), F.col("lat")
    cell = lambda k: F.struct(F.lit(k).alias("tree_level"), index(lon, "x", F.lit(ROOT / FAN**k)).alias("cell_x"), index(lat, "y", F.lit(ROOT / FAN**k)).alias("cell_y"))
    asked = places.withColumn("_c", F.explode(F.array(*map(cell, sorted(levels)))) if levels else F.lit(None).cast("struct<tree_level:int,cell_x:bigint,cell_y:bigint>"))
    asked = asked.select(*places.columns, "_c.tree_level", "_c.cell_x", "_c.cell_y")
    met = asked.join(tree, ["tree_level", "cell_x", "cell_y", *on])
    corner = corner_of(F.col("cell_x"), F.col("cell_y"), size_of(F.col("tree_level")))
    crossed = F.aggregate("tree_edges", F.col("tree_parity"), lambda n, e: n + crossings({s: e[s] for s in SIDES}, corner, lon, lat))
    return met.filter(F.coalesce(crossed, F.col("tree_parity")) % 2 == 1).drop("tree_level", "cell_x", "cell_y", "tree_parity", "tree_edges")


def point_in_polygon(points: DataFrame, polygons: DataFrame, on: tuple[str, ...] = (), most: int = MOST) -> DataFrame:
    """points (lon, lat, ...) joined with the features (polygons, ...) that hold them and agree in the columns `on`; columns of both
    sides are kept, but for `polygons`. Distinct places are asked once, and no joined row has more than `most` edges."""
    held = held_by(points.select("lon", "lat", *on).distinct(), staged(border_index(polygons, most), "border-index"), on)
    return points.join(held, ["lon", "lat", *on])


# ---- polygons that touch ----


def side_of(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def segments_touch(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Whether two edges share a point, their ends included."""
    one, two = ((c["x0"], c["y0"], c["x1"], c["y1"]) for c in (a, b))
    ends = lambda c: ((c["x0"], c["y0"]), (c["x1"], c["y1"]))
    meet = lambda axis: (F.least(a[f"{axis}0"], a[f"{axis}1"]) <= F.greatest(b[f"{axis}0"], b[f"{axis}1"])) & (F.least(b[f"{axis}0"], b[f"{axis}1"]) <= F.greatest(a[f"{axis}0"], a[f"{axis}1"]))
    (p, q), (r, s) = (tuple(side_of(*of, *end) for end in ends(other)) for of, other in ((one, b), (two, a)))
    return meet("x") & meet("y") & (p * q <= 0) & (r * s <= 0)


def edges_meeting(left: DataFrame, right: DataFrame, left_key: str, right_key: str, level: int = 2, most: int = MOST) -> DataFrame:
    """left_key, right_key of all whose edges (key, x0, y0, x1, y1) share a point. Edges meet in cells that both sides run through, of `level` or,
    where one outline has more than `most` edges in a cell, as much finer as there are more (an outline is a line, so halving a
    cell halves its edges)."""
    size = F.lit(ROOT / FAN**level)
    sides = [with_cells(e.select(F.col(k).alias("key"), *SIDES), size) for e, k in ((left, left_key), (right, right_key))]
    counts = [s.groupBy("cell_x", "cell_y", "key").agg(F.count("*").alias("n")).groupBy("cell_x", "cell_y").agg(F.max("n").alias("n")) for s in sides]
    both = counts[0].join(counts[1].withColumnRenamed("n", "m"), ["cell_x", "cell_y"])
    more = F.ceil(F.log(F.greatest("n", "m") / F.lit(float(most))) / F.log(F.lit(float(FAN))))
    both = staged(both.select("cell_x", "cell_y", F.greatest(F.lit(0), F.least(F.lit(DEEPEST - level), more)).cast("int").alias("more")), "shared-cells")
    finer = [s.join(both, ["cell_x", "cell_y"]) for s in sides]
    finer = [with_cells(f, size_of(F.col("more") + level), F.struct("cell_x", "cell_y"), F.pow(F.lit(float(FAN)), F.col("more")).cast("long")) for f in finer]
    one, two = (f.select("more", "cell_x", "cell_y", F.col("key").alias(f"{p}key"), *(F.col(s).alias(f"{p}{s}") for s in SIDES)) for f, p in zip(finer, "ab", strict=True))
    names = lambda p: {s: F.col(f"{p}{s}") for s in SIDES}
    met = one.join(two, ["more", "cell_x", "cell_y"]).filter(segments_touch(names("a"), names("b")))
    return met.select(F.col("akey").alias(left_key), F.col("bkey").alias(right_key)).distinct()


def part_corners(features: DataFrame, key: str) -> DataFrame:
    """key, lon, lat: the first vertex of each part of each feature."""
    corners = F.transform(F.filter("polygons", lambda p: (F.size(p) > 0) & (F.size(p[0]) > 0)), lambda p: p[0][0])
    return features.select(key, F.explode(corners).alias("_p")).select(key, F.col("_p.x").alias("lon"), F.col("_p.y").alias("lat"))


def touching(left: DataFrame, right: DataFrame, left_key: str, right_key: str, level: int = 2) -> DataFrame:
    """left_key, right_key of all features (key, polygons) that share a point: their edges meet, or one holds a vertex of a part of the other. A
    feature may be a point, as a ring of twice the same vertex."""
    a, b = left.select(left_key, "polygons"), right.select(right_key, "polygons")
    met = edges_meeting(outline(a), outline(b), left_key, right_key, level)
    in_left = point_in_polygon(part_corners(b, right_key), a).select(left_key, right_key)
    in_right = point_in_polygon(part_corners(a, left_key), b).select(left_key, right_key)
    return met.unionByName(in_left).unionByName(in_right).distinct()
