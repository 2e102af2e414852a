"""Queries of boxes, grids and polygons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomill.functions import geometry as G
from geomill.operators import outline as O
from geomill.operators import rasterize as R
from geomill.operators import simplify as S
from geomill.operators.validity import all_issues
from geomill.plans.registry import Views, query
from geomill.plans.views import GRID
from geomill.sources.tables import staged


def row_box() -> Column:
    """The row's own box."""
    return G.box(F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy"))


R6 = lambda *names: [F.round(n, 6).alias(n) for n in names]
SIDES6 = "round(min(minx), 6) AS minx, round(min(miny), 6) AS miny, round(max(maxx), 6) AS maxx, round(max(maxy), 6) AS maxy"


def polygons(v: Views, source: str = "boxes") -> DataFrame:
    """The nations' boxes as polygons."""
    return getattr(v, source).withColumn("polygons", G.polygon_of_box(row_box()))


@query("geo_envelope", f"SELECT iso3, {SIDES6} FROM {{boxes}} GROUP BY iso3")
def geo_envelope(v: Views) -> DataFrame:
    return G.envelope(v.boxes.withColumn("bbox", row_box()), "iso3").select("iso3", *R6(*G.SIDES))


_TEXT_POINTS = "SELECT project_location_id, CASE WHEN project_location_id % 9 = 0 THEN 'unknown' ELSE CAST(longitude AS STRING) END AS longitude, CASE WHEN project_location_id % 13 = 0 THEN '' ELSE CAST(latitude AS STRING) END AS latitude FROM {locations}"


@query("geo_points_envelope", f"""SELECT round(min(x), 6) AS minx, round(min(y), 6) AS miny, round(max(x), 6) AS maxx, round(max(y), 6) AS maxy, count(*) AS n_points FROM (SELECT try_cast(longitude AS DOUBLE) AS x, try_cast(latitude AS DOUBLE) AS y FROM ({_TEXT_POINTS}) AS t) AS p WHERE x IS NOT NULL AND y IS NOT NULL""")
def geo_points_envelope(v: Views) -> DataFrame:
    return G.points_envelope(v.spark.sql(_TEXT_POINTS, locations=v.locations)).select(*R6(*G.SIDES), "n_points")


@query("geo_trim_envelope", """SELECT dataset, round(greatest(-180.0, least(180.0, minx * 1.2)), 6)::DOUBLE AS minx, round(greatest(-90.0, least(90.0, miny * 1.2)), 6)::DOUBLE AS miny, round(greatest(-180.0, least(180.0, maxx * 1.2)), 6)::DOUBLE AS maxx, round(greatest(-90.0, least(90.0, maxy * 1.2)), 6)::DOUBLE AS maxy FROM {catalog}""")
def geo_trim_envelope(v: Views) -> DataFrame:
    wide = G.box(*(F.col(s) * 1.2 for s in G.SIDES))
    return v.catalog.select("dataset", G.trim_envelope(wide).alias("b")).select("dataset", *(F.round(f"b.{s}", 6).alias(s) for s in G.SIDES))


@query("geo_scale", """SELECT dataset, CASE WHEN (maxx - minx) * (maxy - miny) * 16 >= 22500 THEN 'global' ELSE 'regional' END AS scale FROM {catalog}""")
def geo_scale(v: Views) -> DataFrame:
    four = G.box(F.col("minx"), F.col("miny"), F.col("minx") + (F.col("maxx") - F.col("minx")) * 4, F.col("miny") + (F.col("maxy") - F.col("miny")) * 4)
    return v.catalog.select("dataset", G.scale_of(four).alias("scale"))


@query("geo_snap_grid", """SELECT dataset, floor(minx * 2) / 2 + 0 AS minx, floor(miny * 2) / 2 + 0 AS miny, ceil(maxx * 2) / 2 + 0 AS maxx, ceil(maxy * 2) / 2 + 0 AS maxy, (ceil(maxy * 2) - floor(miny * 2))::INT AS nrows, (ceil(maxx * 2) - floor(minx * 2))::INT AS ncols FROM {catalog}""")
def geo_snap_grid(v: Views) -> DataFrame:
    return v.catalog.select("dataset", G.snap_grid(row_box(), 0.5).alias("g")).select("dataset", "g.*")


@query("geo_cell_of_point", """SELECT project_location_id, floor((90 - latitude) / 3)::INT AS grid_row, floor((longitude + 180) / 3)::INT AS grid_col, longitude < 180 AS inside FROM {locations}""")
def geo_cell_of_point(v: Views) -> DataFrame:
    return v.locations.select("project_location_id", G.cell_of(F.col("longitude"), F.col("latitude"), **GRID).alias("c")).select("project_location_id", "c.*")


def from_corners(corners: DataFrame, *keys: str) -> DataFrame:
    """keys, polygons of corners (keys, part, ring, k, x, y)."""
    rings = corners.groupBy(*keys, "part", "ring").agg(F.array_sort(F.collect_list(F.struct("k", "x", "y"))).alias("r"))
    rings = rings.withColumn("r", F.transform("r", lambda c: F.struct(c["x"].alias("x"), c["y"].alias("y"))))
    in_order = lambda name, what: F.transform(F.array_sort(F.collect_list(F.struct(name, what))), lambda s: s[what])
    parts = rings.groupBy(*keys, "part").agg(in_order("ring", "r").alias("p"))
    return parts.groupBy(*keys).agg(in_order("part", "p").alias("polygons"))


def shapes(v: Views) -> DataFrame:
    """asdf_id, polygons: the nations' polygons, with holes and second parts."""
    return from_corners(v.shape_corners, "asdf_id")


def countries(v: Views) -> DataFrame:
    """iso3, polygons."""
    return from_corners(v.country_corners, "iso3")


EDGES_SQL = "SELECT asdf_id, x0, y0, x1, y1 FROM {shape_edges}"
CROSSES = "(y0 > y) <> (y1 > y) AND x < (x1 - x0) * (y - y0) / (y1 - y0) + x0"
COVER_SQL = f"""SELECT asdf_id, (sr // 10)::INT AS grid_row, (sc // 10)::INT AS grid_col, count(*) AS cover FROM (SELECT s.asdf_id, sr, sc
  FROM (SELECT *, -180 + (sc + 0.5::DOUBLE) * 0.3::DOUBLE AS x, 90 - (sr + 0.5::DOUBLE) * 0.3::DOUBLE AS y FROM (SELECT asdf_id, sr, unnest(range(sc0, sc1)) AS sc FROM (SELECT asdf_id, sc0, sc1, unnest(range(sr0, sr1)) AS sr FROM {{features}}) AS r) AS c) AS s
  JOIN ({EDGES_SQL}) AS e ON e.asdf_id = s.asdf_id WHERE {CROSSES} GROUP BY s.asdf_id, sr, sc HAVING count(*) % 2 = 1) AS i GROUP BY 1, 2, 3"""
WEIGHTS_SQL = f"""SELECT *, false AS touched FROM ({COVER_SQL}) AS cover UNION ALL
  SELECT asdf_id, floor((90 - y) / 3)::INT, floor((x + 180) / 3)::INT, 100, true FROM {{shape_corners}} WHERE part = 0 AND ring = 0 AND k = 0 AND asdf_id NOT IN (SELECT asdf_id FROM ({COVER_SQL}) AS covered)"""


@query("geo_rasterize", COVER_SQL)
def geo_rasterize(v: Views) -> DataFrame:
    return R.rasterize(shapes(v), **GRID)


INSIDE_SQL = f"""SELECT l.x AS longitude, l.y AS latitude, e.asdf_id FROM (SELECT DISTINCT longitude AS x, latitude AS y FROM {{locations}}) AS l, ({EDGES_SQL}) AS e WHERE {CROSSES} GROUP BY ALL HAVING count(*) % 2 = 1"""


@query("geo_point_in_polygon", f"""SELECT project_location_id, asdf_id FROM {{locations}} JOIN ({INSIDE_SQL}) AS i USING (longitude, latitude)""")
def geo_point_in_polygon(v: Views) -> DataFrame:
    points = v.locations.select("project_location_id", F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    return O.point_in_polygon(points, shapes(v)).select("project_location_id", "asdf_id")


def circles_sql(places: str) -> str:
    """CTEs for DuckDB: `corners` (lon, lat, metres, iso3, k, x, y) of the 64-cornered circles round the places of a CTE (lon, lat,
    metres, iso3), from the same series as the operator."""
    wave = lambda terms, f, g: " + ".join(f"{c!r}::DOUBLE * {f}({2 * j} * xi) * {g}({2 * j} * eta)" for j, c in enumerate(terms, 1))
    scale = repr(R._K0 * R._RADIUS)
    e = repr(float(2 * R._N**0.5 / (1 + R._N)))
    return f"""zones AS (SELECT *, floor((lon + 180) / 6) * 6 - 177 AS cm FROM {places}),
    tangents AS (SELECT *, radians(lon - cm) AS dl, sinh(atanh(sin(radians(lat))) - {e}::DOUBLE * atanh({e}::DOUBLE * sin(radians(lat)))) AS t FROM zones),
    forward AS (SELECT *, atan2(t, cos(dl)) AS xi, atanh(sin(dl) / sqrt(1 + t * t)) AS eta FROM tangents),
    metric AS (SELECT lon, lat, metres, iso3, cm, {R._EAST!r}::DOUBLE + {scale}::DOUBLE * (eta + {wave(R._FORWARD, "cos", "sinh")}) AS east, {scale}::DOUBLE * (xi + {wave(R._FORWARD, "sin", "cosh")}) AS north FROM forward),
    turned AS (SELECT *, (north + metres * sin(2 * pi() * k / 64)) / {scale}::DOUBLE AS xi, (east + metres * cos(2 * pi() * k / 64) - {R._EAST!r}::DOUBLE) / {scale}::DOUBLE AS eta FROM (SELECT *, unnest(range(65)) AS k FROM metric) AS m),
    back AS (SELECT *, eta - ({wave(R._BACK, "cos", "sinh")}) AS ex, xi - ({wave(R._BACK, "sin", "cosh")}) AS en FROM turned),
    corners AS (SELECT lon, lat, metres, iso3, k, cm + degrees(atan2(sinh(ex), cos(en))) AS x, degrees(chi + {" + ".join(f"{d!r}::DOUBLE * sin({2 * j} * chi)" for j, d in enumerate(R._LATITUDE, 1))}) AS y FROM (SELECT *, asin(sin(en) / cosh(ex)) AS chi FROM back) AS c)"""


@query("geo_buffer", f"""WITH places AS (SELECT DISTINCT longitude AS lon, latitude AS lat, 25000.0::DOUBLE AS metres, '' AS iso3 FROM {{locations}}), {circles_sql("places")},
  sides AS (SELECT *, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM corners WINDOW w AS (PARTITION BY lon, lat ORDER BY k))
  SELECT lon AS longitude, lat AS latitude, round(min(x), 6) AS minx, round(min(y), 6) AS miny, round(max(x), 6) AS maxx, round(max(y), 6) AS maxy, round(abs(sum(x * y1 - x1 * y) / 2), 5) AS area FROM sides GROUP BY lon, lat""")
def geo_buffer(v: Views) -> DataFrame:
    """Areas and boxes of the 25 km circles round all distinct places."""
    places = v.locations.select(F.col("longitude").alias("lon"), F.col("latitude").alias("lat"), F.lit(25000.0).alias("metres")).distinct()
    return R.buffer_m(places).select(F.col("lon").alias("longitude"), F.col("lat").alias("latitude"), G.polygons_box(F.col("polygons")).alias("b"), F.round(G.area(F.col("polygons")), 5).alias("area")).select("longitude", "latitude", *(F.round(f"b.{s}", 6).alias(s) for s in G.SIDES), "area")


CLIPPED_SQL = f"""sides AS (SELECT lon, lat, metres, iso3, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM corners WINDOW w AS (PARTITION BY lon, lat, metres, iso3 ORDER BY k)),
  reach AS (SELECT lon, lat, metres, iso3, greatest(0, floor((90 - max(y)) / 0.3))::BIGINT AS r0, least(599, floor((90 - min(y)) / 0.3))::BIGINT AS r1, greatest(0, floor((min(x) + 180) / 0.3))::BIGINT AS c0, least(1199, floor((max(x) + 180) / 0.3))::BIGINT AS c1 FROM corners GROUP BY ALL),
  asked AS (SELECT *, -180 + (sc + 0.5::DOUBLE) * 0.3::DOUBLE AS x, 90 - (sr + 0.5::DOUBLE) * 0.3::DOUBLE AS y FROM (SELECT *, unnest(range(c0, c1 + 1)) AS sc FROM (SELECT *, unnest(range(r0, r1 + 1)) AS sr FROM reach) AS a) AS b),
  hit AS (SELECT lon, lat, metres, iso3, sr, sc, x, y FROM asked JOIN sides USING (lon, lat, metres, iso3) WHERE {CROSSES} GROUP BY ALL HAVING count(*) % 2 = 1),
  centres AS (SELECT DISTINCT iso3, sr, sc, x, y FROM hit),
  domestic AS (SELECT c.iso3, sr, sc FROM centres AS c JOIN {{country_edges}} AS e ON e.iso3 = c.iso3 WHERE {CROSSES} GROUP BY ALL HAVING count(*) % 2 = 1),
  at_home AS (SELECT p.lon, p.lat, p.iso3 FROM (SELECT DISTINCT lon, lat, iso3, lon AS x, lat AS y FROM places) AS p JOIN {{country_edges}} AS e ON e.iso3 = p.iso3 WHERE {CROSSES} GROUP BY ALL HAVING count(*) % 2 = 1),
  circle_cells AS (SELECT lon, lat, metres, h.iso3, sr // 10 AS r, sc // 10 AS c, count(*) AS cover FROM hit AS h JOIN domestic AS d USING (iso3, sr, sc) GROUP BY ALL),
  own_cells AS (SELECT lon, lat, metres, iso3, floor((90 - lat) / 3)::BIGINT AS r, floor((lon + 180) / 3)::BIGINT AS c, 100 AS cover FROM places JOIN at_home USING (lon, lat, iso3) WHERE NOT EXISTS (SELECT 1 FROM circle_cells q WHERE q.lon = places.lon AND q.lat = places.lat AND q.metres = places.metres AND q.iso3 = places.iso3)),
  clipped AS (SELECT * FROM circle_cells UNION ALL SELECT * FROM own_cells)"""
"""CTEs after `corners`: the cells of circles (lon, lat, metres, iso3, r, c, cover) clipped to crooked countries, sub-cell by sub-cell."""


@query("geo_clip_buffer", f"""WITH places AS (SELECT DISTINCT longitude AS lon, latitude AS lat, 50000.0::DOUBLE AS metres, recipients_iso3 AS iso3 FROM {{locations}} WHERE recipients_iso3 <> '' AND abs(latitude) < 80), {circles_sql("places")}, {CLIPPED_SQL}
  SELECT p.lon, p.lat, p.iso3, r::INT AS grid_row, c::INT AS grid_col, cover::BIGINT AS cover FROM places p LEFT JOIN clipped q ON q.lon = p.lon AND q.lat = p.lat AND q.iso3 = p.iso3""")
def geo_clip_buffer(v: Views) -> DataFrame:
    """The 50 km circles round all places, within their crooked country."""
    places = v.locations.filter("recipients_iso3 <> '' AND abs(latitude) < 80").select(F.col("longitude").alias("lon"), F.col("latitude").alias("lat"), F.col("recipients_iso3").alias("iso3")).distinct()
    places = staged(places.withColumn("geom", F.concat_ws("|", "lon", "lat", "iso3")).withColumn("metres", F.lit(50000.0)), "places")
    return R.clip_buffers(places, countries(v), **GRID).join(places.drop("metres"), "geom").select("lon", "lat", "iso3", "grid_row", "grid_col", "cover")


_ISSUES = ("", "open ring", "few points|spike|zero area", "spike|zero area", "non-finite", "crossing", "spike|touching", "touching rings", "crossing")


@query("geo_validity", "SELECT p_partkey, CASE p_partkey % 9 " + " ".join(f"WHEN {k} THEN '{names}'" for k, names in enumerate(_ISSUES)) + " END AS issues FROM {catalog}")
def geo_validity(v: Views) -> DataFrame:
    """Boxes spoilt in eight ways: among them bow ties, spikes, and holes that touch or cross the border."""
    ring = G.polygon_of_box(row_box())[0][0]
    n = F.col("p_partkey") % 9
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    west, south, east, north = F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy")
    across, up = (lambda share: west + (east - west) * share), (lambda share: south + (north - south) * share)
    flat = F.array(point(west, south), point(east, south), point(west, south), point(west, south))
    short = F.array(point(west, south), point(east, south), point(west, south))
    broken = F.transform(ring, lambda p: point(F.when(p["x"] == east, F.lit(float("nan"))).otherwise(p["x"]), p["y"]))
    tie = F.array(point(west, south), point(east, north), point(east, south), point(west, up(0.7)), point(west, south))
    spike = F.array(point(west, south), point(west, north), point(east, north), point(east, south), point(across(0.5), south), point(across(0.5), up(-0.4)), point(across(0.5), south), point(west, south))
    touching = F.array(point(west, up(0.5)), point(across(0.3), up(0.7)), point(across(0.4), up(0.3)), point(west, up(0.5)))
    crossing = F.array(point(across(0.5), up(0.5)), point(across(1.3), up(0.6)), point(across(0.6), up(0.2)), point(across(0.5), up(0.5)))
    bent = F.when(n == 1, F.slice(ring, 1, 4)).when(n == 2, short).when(n == 3, flat).when(n == 4, broken).when(n == 5, tie).when(n == 6, spike).otherwise(ring)
    rings = F.when(n == 7, F.array(bent, touching)).when(n == 8, F.array(bent, crossing)).otherwise(F.array(bent))
    return all_issues(v.catalog.select("p_partkey", F.array(rings).alias("polygons")), "p_partkey").select("p_partkey", F.array_join("issues", "|").alias("issues"))


@query("geo_area", """SELECT boundary, asdf_id, round((maxx - minx) * (maxy - miny), 6) AS area, round(sum((maxx - minx) * (maxy - miny)) OVER (PARTITION BY boundary), 6) AS total FROM {boxes}""")
def geo_area(v: Views) -> DataFrame:
    each = polygons(v).select("boundary", "asdf_id", G.area(F.col("polygons")).alias("area"))
    totals = each.groupBy("boundary").agg(F.round(F.sum("area"), 6).alias("total"))
    return each.withColumn("area", F.round("area", 6)).join(totals, "boundary")


def user_lines(v: Views) -> DataFrame:
    """Closed rings made of the users' events: time of day on one axis, value on the other."""
    x = F.hour("ts") + F.minute("ts") / 60
    points = v.events.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct(x.alias("x"), F.col("value").alias("y")))).alias("p")).filter(F.size("p") >= 4)
    ring = F.concat("p", F.slice("p", 1, 1))
    return points.select(F.col("user_id").alias("asdf_id"), F.array(F.array(ring)).alias("polygons"))


@query("geo_simplify")
def geo_simplify(v: Views) -> DataFrame:
    """Rows only: vertices before and after, by a tolerance and by a limit of characters."""
    lines = staged(user_lines(v), "user-lines")
    vertices = lambda name: F.size(F.flatten(F.flatten("polygons"))).alias(name)
    before = lines.select("asdf_id", vertices("n_before"))
    limited = S.limit_chars(lines, limit=300, step=5.0).select("asdf_id", vertices("n_limited"), "tolerance")
    simple = S.simplify(lines.withColumn("user", F.col("asdf_id")), 20.0, on=("user",)).select("asdf_id", vertices("n_simple"))
    return before.join(simple, "asdf_id").join(limited, "asdf_id")


@query("geo_simplify_shared")
def geo_simplify_shared(v: Views) -> DataFrame:
    """The crooked countries, whose borders fit as before, and the nations' polygons, which lie on their own layer."""
    layers = countries(v).select(F.col("iso3").alias("name"), F.lit("country").alias("layer"), "polygons")
    layers = staged(layers.unionByName(shapes(v).select(F.col("asdf_id").cast("string").alias("name"), F.lit("nation").alias("layer"), "polygons")), "layers")
    done = S.simplify(layers, 3.0, "name", ("layer",))
    return done.select("layer", "name", F.size(F.flatten(F.flatten("polygons"))).alias("n_vertices"), F.round(G.area(F.col("polygons")), 6).alias("area"))


@query("geo_fix_precision", """SELECT asdf_id, CASE WHEN minx <= -180 THEN -179.999999 ELSE round(minx, 6) END AS minx, round(miny, 6) AS miny, CASE WHEN x2 >= 180 THEN 179.999999 ELSE round(x2, 6) END AS maxx, round(maxy, 6) AS maxy FROM (SELECT asdf_id, minx / 1.0000007 AS minx, miny / 1.0000007 AS miny, maxx * 1.02 / 1.0000007 AS x2, maxy / 1.0000007 AS maxy FROM {boxes}) AS t""")
def geo_fix_precision(v: Views) -> DataFrame:
    odd = F.lit(1.0000007)
    bent = G.polygon_of_box(G.box(F.col("minx") / odd, F.col("miny") / odd, F.col("maxx") * 1.02 / odd, F.col("maxy") / odd))
    return v.boxes.select("asdf_id", G.polygons_box(G.round_coords(bent)).alias("b")).select("asdf_id", "b.*")
