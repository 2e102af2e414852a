"""Polygon to grid cells, metric buffers, and circles clipped to a country.

Rasterising and buffering are vectorised numpy helpers over Arrow batches; Spark deals out the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomill.functions import geometry as G
from geomill.operators.outline import border_index, held_by, index, outline, size_of, with_cells
from geomill.sources.tables import staged

BAND = 32  # grid rows rasterised at once, so that no task holds a whole country
CELLS, CIRCLES = 20_000_000, 4_000  # sub-cells and circles that a task is given
POLYGONS = "array<array<array<struct<x:double,y:double>>>>"


def _cover(edges: np.ndarray, r0: int, r1: int, minx: float, maxy: float, px: float, scale: int, ncols: int) -> tuple[int, np.ndarray]:
    """(first column, counts [row, column]): sub-cell centres inside (even-odd, half-open) for rows r0..r1-1, over the columns that the
    edges (x0, y0, x1, y1) of these rows span."""
    x0, y0, x1, y1 = edges.T
    low = int(np.clip(np.floor((min(x0.min(), x1.min()) - minx) / px), 0, ncols))
    high = int(np.clip(np.ceil((max(x0.max(), x1.max()) - minx) / px), low, ncols))
    sub, rows, cols = px / scale, (r1 - r0) * scale, (high - low) * scale
    steps = np.zeros((rows, cols + 1), np.int32)
    first = max(0, int(np.floor((maxy - max(y0.max(), y1.max())) / sub)) - r0 * scale)
    last = min(rows, int(np.ceil((maxy - min(y0.min(), y1.min())) / sub)) - r0 * scale + 1)
    for k in range(first, last):
        y = maxy - (r0 * scale + k + 0.5) * sub
        hit = (y0 > y) != (y1 > y)
        if hit.any():
            x = np.sort((x1[hit] - x0[hit]) * (y - y0[hit]) / (y1[hit] - y0[hit]) + x0[hit])
            at = np.clip(np.ceil((x - minx) / sub - 0.5) - low * scale, 0, cols).astype(np.int64)
            np.add.at(steps[k], at[0::2], 1)
            np.add.at(steps[k], at[1::2], -1)
    inside = np.cumsum(steps, axis=1)[:, :cols]
    return low, inside.reshape(r1 - r0, scale, high - low, scale).sum(axis=(1, 3))


def _tasks(features: DataFrame, sub: float, rows: int, cols: int) -> int:
    """How many tasks the polygons' sub-cells are worth: CELLS a task, and one for each core."""
    b = G.polygons_box(F.col("polygons"))
    side = lambda low, high, most: F.least(F.lit(most), F.ceil((b[high] - b[low]) / sub))
    cells = features.agg(F.sum(side("minx", "maxx", cols).cast("double") * side("miny", "maxy", rows))).first()[0] or 0
    return max(features.sparkSession.sparkContext.defaultParallelism, int(cells // CELLS))


def rasterize(features: DataFrame, minx: float, maxy: float, px: float, nrows: int, ncols: int, scale: int = 10, key: str = "asdf_id") -> DataFrame:
    """key, grid_row, grid_col, cover (sub-cell centres inside, of scale * scale), for features (key, polygons).

    `scale` is 1 or a multiple of 10. Edges are dealt into the bands of BAND rows that they reach into, and a band of a polygon is
    rasterised by itself. Bands are dealt over tasks by the sub-cells of the polygons' boxes, not by their bytes, which are few.
    """
    if scale != 1 and scale % 10:
        raise ValueError("scale must be 1 or a multiple of 10")
    tasks = _tasks(features, px / scale, nrows * scale, ncols * scale)
    band = lambda y: F.floor((F.lit(maxy) - y) / (px * BAND))
    edges = outline(features.select(key, "polygons"))
    top, bottom = F.greatest(F.lit(0), band(F.greatest("y0", "y1"))), F.least(F.lit((nrows - 1) // BAND), band(F.least("y0", "y1")))
    spans = edges.withColumn("band", F.explode(F.when(top <= bottom, F.sequence(top, bottom)).otherwise(F.array().cast("array<bigint>"))))
    bands = spans.repartition(tasks, key, "band").groupBy(key, "band").agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("edges"))
    low = (F.col("band") * BAND).cast("int")
    bands = bands.select(key, low.alias("low"), F.least(low + BAND, F.lit(nrows)).alias("high"), "edges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, rows, cols, covers = [], [], [], []
            lists = batch["edges"]
            flat, offsets = lists.flatten(), np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
            table = np.stack([flat.field(c).to_numpy(zero_copy_only=False) for c in ("x0", "y0", "x1", "y1")], axis=1)
            for k, (low, high) in enumerate(zip(batch["low"].to_pylist(), batch["high"].to_pylist(), strict=True)):
                left, cover = _cover(table[offsets[k] : offsets[k + 1]], low, high, minx, maxy, px, scale, ncols)
                r, c = np.nonzero(cover)
                owners.append(np.full(len(r), k))
                rows.append(r + low)
                cols.append(c + left)
                covers.append(cover[r, c])
            join = lambda x, kind: pa.array(np.concatenate(x).astype(kind) if x else np.zeros(0, kind))
            yield pa.RecordBatch.from_arrays([batch[key].take(join(owners, np.int64)), join(rows, np.int32), join(cols, np.int32), join(covers, np.int64)], [key, "grid_row", "grid_col", "cover"])

    kind = features.schema[key].dataType.simpleString()
    return bands.mapInArrow(run, f"{key} {kind}, grid_row int, grid_col int, cover long")


def touched_cells(features: DataFrame, cells: DataFrame, minx: float, maxy: float, px: float, nrows: int, ncols: int, scale: int = 10, key: str = "asdf_id") -> DataFrame:
    """For features without a row in `cells`, that is without a covered sub-cell: the grid cells that their edges run through, with full
    cover (all-touched rule). Such a polygon holds no whole cell, so its edges reach all that it touches."""
    small = features.join(cells.select(key).distinct(), key, "left_anti").select(key, F.explode(G.edges_of(F.col("polygons"))).alias("e"))
    index = lambda v, most: F.greatest(F.lit(0), F.least(F.lit(most - 1), F.floor(v).cast("int")))
    north, south = F.greatest("e.y0", "e.y1"), F.least("e.y0", "e.y1")
    rows = small.select(key, "e", F.explode(F.sequence(index((F.lit(maxy) - north) / px, nrows), index((F.lit(maxy) - south) / px, nrows))).alias("grid_row"))
    at = lambda y: F.when(F.col("e.y1") != F.col("e.y0"), F.col("e.x0") + (F.col("e.x1") - F.col("e.x0")) * (y - F.col("e.y0")) / (F.col("e.y1") - F.col("e.y0")))
    upper, lower = at(F.least(north, F.lit(maxy) - F.col("grid_row") * px)), at(F.greatest(south, F.lit(maxy) - (F.col("grid_row") + 1) * px))
    west, east = F.coalesce(F.least(upper, lower), F.least("e.x0", "e.x1")), F.coalesce(F.greatest(upper, lower), F.greatest("e.x0", "e.x1"))
    spans = F.sequence(index((west - minx) / px, ncols), index((east - minx) / px, ncols))
    return rows.select(key, "grid_row", F.explode(spans).alias("grid_col")).distinct().withColumn("cover", F.lit(scale * scale).cast("long"))


# ---- metric buffers: transverse Mercator by its series in the third flattening ----

_A, _F = 6378137.0, 1 / 298.257223563
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_FORWARD = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BACK = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_LATITUDE = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)
_K0, _EAST = 0.9996, 500_000.0


def utm_forward(lon: np.ndarray, lat: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Easting and northing (0 at the equator) in the zone of the given central meridian."""
    phi, dlam = np.radians(lat), np.radians(lon - centre)
    e = 2 * np.sqrt(_N) / (1 + _N)
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(dlam)), np.arctanh(np.sin(dlam) / np.sqrt(1 + t * t))
    x, y = eta.copy(), xi.copy()
    for j, a in enumerate(_FORWARD, 1):
        x += a * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        y += a * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
    return _EAST + _K0 * _RADIUS * x, _K0 * _RADIUS * y


def utm_back(east: np.ndarray, north: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    xi, eta = north / (_K0 * _RADIUS), (east - _EAST) / (_K0 * _RADIUS)
    x, y = eta.copy(), xi.copy()
    for j, b in enumerate(_BACK, 1):
        x -= b * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        y -= b * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
    chi = np.arcsin(np.sin(y) / np.cosh(x))
    lat = chi + sum(d * np.sin(2 * j * chi) for j, d in enumerate(_LATITUDE, 1))
    return centre + np.degrees(np.arctan2(np.sinh(x), np.cos(y))), np.degrees(lat)


def buffer_rings(lon: np.ndarray, lat: np.ndarray, metres: np.ndarray, corners: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Closed rings of `corners` vertices round each point, by a circle in the point's UTM zone: arrays [point, vertex]."""
    centre = np.floor((lon + 180) / 6) * 6 - 177
    east, north = utm_forward(lon, lat, centre)
    angle = np.linspace(0, 2 * np.pi, corners + 1)
    ring = lambda at, wave: at[:, None] + metres[:, None] * wave
    return utm_back(ring(east, np.cos(angle)), ring(north, np.sin(angle)), centre[:, None])


def buffer_m(places: DataFrame) -> DataFrame:
    """places (lon, lat, metres, ...) with `polygons`: the circle round each place. Neither poles nor the antimeridian are treated."""
    schema = places.schema.simpleString().removeprefix("struct<").removesuffix(">")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = buffer_rings(*(batch[c].to_numpy(zero_copy_only=False).astype(float) for c in ("lon", "lat", "metres")))
            out: pa.Array = pa.StructArray.from_arrays([pa.array(x.ravel()), pa.array(y.ravel())], ["x", "y"])
            for size in (x.shape[1], 1, 1):
                out = pa.ListArray.from_arrays(pa.array(np.arange(0, len(out) + 1, size), pa.int32()), out)
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, "polygons"])

    return places.mapInArrow(run, f"{schema}, polygons {POLYGONS}")


# ---- circles clipped to their country ----

_EDGES = ("x0", "y0", "x1", "y1")


def _met(edges: np.ndarray, y: float) -> np.ndarray:
    """Where the level line at y meets the edges, from west to east."""
    x0, y0, x1, y1 = edges.T
    hit = (y0 > y) != (y1 > y)
    return np.sort((x1[hit] - x0[hit]) * (y - y0[hit]) / (y1[hit] - y0[hit]) + x0[hit])


def _clipped(ring: np.ndarray, border: np.ndarray, inside: bool, cx: float, cy: float, minx: float, maxy: float, px: float, nrows: int, ncols: int, scale: int) -> tuple[np.ndarray, ...]:
    """(rows, columns, covers) of the sub-cell centres in a circle and in the country whose edges near it are `border`; `inside` says whether
    the country holds the centre (cx, cy). Both parities run along each line: the country's is known at the centre, and so at every
    place that is reached over the edges near the circle."""
    if not len(border) and not inside:
        return (np.zeros(0, np.int64),) * 3
    sub = px / scale
    low = max(0, int(np.floor((maxy - max(ring[:, 1].max(), ring[:, 3].max())) / sub)))
    high = min(nrows * scale, int(np.ceil((maxy - min(ring[:, 1].min(), ring[:, 3].min())) / sub)) + 1)
    left = max(0, int(np.floor((min(ring[:, 0].min(), ring[:, 2].min()) - minx) / sub)))
    right = min(ncols * scale, int(np.ceil((max(ring[:, 0].max(), ring[:, 2].max()) - minx) / sub)) + 1)
    columns = np.arange(left, max(left, right))
    x, rows, cols = minx + (columns + 0.5) * sub, [], []
    if len(border):
        x0, y0, x1, y1 = border.T
        upright = (x0 > cx) != (x1 > cx)
        height = (y1 - y0)[upright] * (cx - x0[upright]) / (x1 - x0)[upright] + y0[upright]
        rising = ((y1 != y0) & ((y1 > y0) == (x1 > x0)))[upright]
        over = lambda at: (height > at) | ((height == at) & rising)
        from_centre = over(cy)
    for k in range(low, high):
        y = maxy - (k + 0.5) * sub
        held = np.searchsorted(_met(ring, y), x, "right") % 2 == 1
        if len(border) and held.any():
            met = _met(border, y)
            here = inside ^ bool((from_centre != over(y)).sum() % 2)
            held &= here ^ ((np.searchsorted(met, x, "right") + np.searchsorted(met, cx, "right")) % 2 == 1)
        found = columns[held]
        rows.append(np.full(len(found), k // scale))
        cols.append(found // scale)
    if not rows:
        return (np.zeros(0, np.int64),) * 3
    cells, covers = np.unique(np.concatenate(rows) * ncols + np.concatenate(cols), return_counts=True)
    return cells // ncols, cells % ncols, covers


def buffer_boxes(places: DataFrame) -> DataFrame:
    """places (lon, lat, metres, ...) with the box (minx, miny, maxx, maxy) of the circle round each place."""
    schema = places.schema.simpleString().removeprefix("struct<").removesuffix(">")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = buffer_rings(*(batch[c].to_numpy(zero_copy_only=False).astype(float) for c in ("lon", "lat", "metres")))
            sides = [pa.array(v) for v in ((x.min(axis=1), y.min(axis=1), x.max(axis=1), y.max(axis=1)) if len(x) else [np.zeros(0)] * 4)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *sides], [*batch.schema.names, *G.SIDES])

    return places.mapInArrow(run, f"{schema}, minx double, miny double, maxx double, maxy double")


def borders_near(places: DataFrame, countries: DataFrame, level: int = 2) -> DataFrame:
    """geom, border: the edges of their country (iso3, polygons) that reach into the boxes of the circles of places (geom, iso3, lon, lat, metres), of
    those where any does. Edges and boxes meet in cells of `level`, so no outline travels whole."""
    size = size_of(level)
    span = lambda axis: F.explode(F.sequence(index(F.col(f"min{axis}"), axis, size), index(F.col(f"max{axis}"), axis, size)))
    boxes = buffer_boxes(places).withColumn("cell_x", span("x")).withColumn("cell_y", span("y"))
    edges = with_cells(outline(countries.select("iso3", "polygons")), size)
    near = (F.greatest("x0", "x1") >= F.col("minx")) & (F.least("x0", "x1") <= F.col("maxx")) & (F.greatest("y0", "y1") >= F.col("miny")) & (F.least("y0", "y1") <= F.col("maxy"))
    return boxes.join(edges, ["iso3", "cell_x", "cell_y"]).filter(near).groupBy("geom").agg(F.collect_set(F.struct(*_EDGES)).alias("border"))


def clip_buffers(buffers: DataFrame, countries: DataFrame, minx: float, maxy: float, px: float, nrows: int, ncols: int, scale: int = 10) -> DataFrame:
    """geom, grid_row, grid_col, cover (in sub-cells, of scale * scale) of the circles of buffers (geom, iso3, lon, lat, metres) within their country
    (iso3, polygons), by the sub-cells whose centres lie in both. A circle without such a centre is the cell of its place if
    that is in the country, else one row of nulls. A circle wholly inside its country is not tested against it, nor is its ring ever moved.

    Stage `buffers` first: they are read more than once."""
    places = buffers.select("geom", "iso3", *(F.col(c).cast("double").alias(c) for c in ("lon", "lat", "metres")))
    tasks = max(buffers.sparkSession.sparkContext.defaultParallelism, buffers.count() // CIRCLES)
    tree = staged(border_index(countries.select("iso3", "polygons")), "country-index")
    home = held_by(places.select("geom", "iso3", "lon", "lat"), tree, ("iso3",)).select("geom").distinct().withColumn("inside", F.lit(True))
    circles = places.drop("iso3").repartition(tasks, "geom").join(borders_near(places, countries), "geom", "left").join(home, "geom", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lon, lat, metres = (batch[c].to_numpy(zero_copy_only=False) for c in ("lon", "lat", "metres"))
            inside = batch["inside"].fill_null(False).to_numpy(zero_copy_only=False)
            flat = batch["border"].flatten()
            ends = np.append(0, np.cumsum(batch["border"].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
            borders = np.stack([flat.field(c).to_numpy(zero_copy_only=False) for c in _EDGES], axis=1)
            x, y = buffer_rings(lon, lat, metres)
            rings = np.stack([x[:, :-1], y[:, :-1], x[:, 1:], y[:, 1:]], axis=2)
            owners, rows, cols, covers = [], [], [], []
            for k in range(len(lon)):
                cx, cy, home = float(lon[k]), float(lat[k]), bool(inside[k])
                r, c, cover = _clipped(rings[k], borders[ends[k] : ends[k + 1]], home, cx, cy, minx, maxy, px, nrows, ncols, scale)
                if not len(r):
                    row, col = int(np.floor((maxy - cy) / px)), int(np.floor((cx - minx) / px))
                    own = home and 0 <= row < nrows and 0 <= col < ncols
                    r, c, cover = ([row], [col], [scale * scale]) if own else ([-1], [-1], [-1])
                owners.append(np.full(len(r), k))
                for out, values in zip((rows, cols, covers), (r, c, cover), strict=True):
                    out.append(np.asarray(values, np.int64))
            joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owners, rows, cols, covers)]
            none = joined[1] < 0
            values = [pa.array(v, kind, mask=none) for v, kind in zip(joined[1:], (pa.int32(), pa.int32(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["geom"].take(pa.array(joined[0])), *values], ["geom", "grid_row", "grid_col", "cover"])

    return circles.mapInArrow(run, f"geom {buffers.schema['geom'].dataType.simpleString()}, grid_row int, grid_col int, cover long")
