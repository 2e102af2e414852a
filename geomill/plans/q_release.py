"""Queries of release tables, filters and money surfaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomill.functions import geometry as G
from geomill.operators import release as R
from geomill.operators import surface as S
from geomill.plans.q_geometry import CLIPPED_SQL, CROSSES, circles_sql, countries, polygons
from geomill.plans.registry import Views, query
from geomill.plans.views import GRID
from geomill.sources.tables import staged

# ---- filters ----

_P = "project_id, transactions_start_year, transactions_end_year, donors, ad_sector_names"


@query("flt_transaction_year", "SELECT project_id, transactions_start_year, transactions_end_year FROM {projects} WHERE 1996 BETWEEN transactions_start_year AND transactions_end_year OR 1999 BETWEEN transactions_start_year AND transactions_end_year")
def flt_transaction_year(v: Views) -> DataFrame:
    return R.filter_years(v.projects, [1996, 1999]).select("project_id", "transactions_start_year", "transactions_end_year")


@query("flt_amount_range", "SELECT project_id, total_commitments FROM {projects} WHERE total_commitments BETWEEN 50000 AND 150000")
def flt_amount_range(v: Views) -> DataFrame:
    return R.filter_range(v.projects, "total_commitments", [150000, 50000, 60000]).select("project_id", "total_commitments")


@query("flt_text_any", "SELECT project_id, ad_sector_names FROM {projects} WHERE contains(ad_sector_names, 'Health') OR contains(ad_sector_names, 'Wat')")
def flt_text_any(v: Views) -> DataFrame:
    return R.filter_any(v.projects, "ad_sector_names", ["Health", "Wat"]).select("project_id", "ad_sector_names")


@query("flt_apply_filters", f"SELECT {_P} FROM {{projects}} WHERE 1997 BETWEEN transactions_start_year AND transactions_end_year AND total_disbursements BETWEEN 10000 AND 60000 AND (contains(donors, 'Donor1') OR contains(donors, 'Donor3'))")
def flt_apply_filters(v: Views) -> DataFrame:
    chosen = {"transaction_year": [1997], "total_disbursements": [10000, 60000], "donors": ["Donor1", "Donor3"], "ad_sector_names": ["All"], "status": []}
    return R.apply_filters(v.projects, chosen).select(*_P.split(", "))


# ---- joins and aggregations ----


@query("rel_merge", "SELECT project_id, project_location_id, total_commitments, longitude, latitude FROM {projects} JOIN {locations} USING (project_id)")
def rel_merge(v: Views) -> DataFrame:
    return R.merge_release(v.projects, v.locations).select("project_id", "project_location_id", "total_commitments", "longitude", "latitude")


_SPLIT = "SELECT p.*, project_location_id, longitude, latitude, count(*) OVER (PARTITION BY project_id) AS location_count, coalesce(total_commitments, 0) / count(*) OVER (PARTITION BY project_id) AS split_dollars_pp FROM {projects} p JOIN {locations} USING (project_id)"


def split(v: Views) -> DataFrame:
    return R.split_value(R.merge_release(v.projects, v.locations))


@query("rel_split_value", f"SELECT project_id, project_location_id, location_count, split_dollars_pp FROM ({_SPLIT}) AS s")
def rel_split_value(v: Views) -> DataFrame:
    return split(v).select("project_id", "project_location_id", "location_count", "split_dollars_pp")


_RATIO = "len(list_filter(string_split(ad_sector_names, '|'), lambda x: x IN ('Health', 'Energy'))) / len(string_split(ad_sector_names, '|'))"


@query("rel_adjust_value", f"SELECT project_id, project_location_id, {_RATIO} AS sector_ratio, {_RATIO} * split_dollars_pp AS adjusted_val FROM ({_SPLIT}) AS s")
def rel_adjust_value(v: Views) -> DataFrame:
    return R.adjust_value(split(v), ["Health", "Energy"]).select("project_id", "project_location_id", "sector_ratio", "adjusted_val")


@query(
    "rel_nested",
    """SELECT project_id, coalesce(l.n, 0)::INT AS n_locations, t.n::INT AS n_transactions, coalesce(l.ids, '') AS location_ids FROM {projects} LEFT JOIN (SELECT project_id, count(*) AS n, string_agg(project_location_id::VARCHAR, '|' ORDER BY project_location_id) AS ids FROM {locations} GROUP BY project_id) l USING (project_id)
    LEFT JOIN (SELECT project_id, count(*) AS n FROM {transactions} GROUP BY project_id) t USING (project_id)""",
)
def rel_nested(v: Views) -> DataFrame:
    nested = R.nest_release(v.projects, v.locations.select("project_location_id", "longitude", "latitude", "project_id"), v.transactions)
    ids = F.array_join(F.transform("locations", lambda s: s["project_location_id"].cast("string")), "|")
    return nested.select("project_id", F.size("locations").alias("n_locations"), F.when(F.col("transactions").isNotNull(), F.size("transactions")).alias("n_transactions"), ids.alias("location_ids"))


@query("rel_orphans", "SELECT project_id, 'locations' AS missing FROM {projects} WHERE project_id NOT IN (SELECT project_id FROM {locations}) UNION ALL SELECT project_id, 'transactions' FROM {projects} WHERE project_id NOT IN (SELECT project_id FROM {transactions})")
def rel_orphans(v: Views) -> DataFrame:
    return R.release_gaps(v.projects, v.locations, v.transactions)


_LATEST = "SELECT name, version, release_id, rank() OVER (PARTITION BY preamble ORDER BY list_transform(string_split(version, '.'), lambda x: x::INT) DESC) AS nth FROM {releases} WHERE preamble <> 'brand#1' AND preamble <> 'brand13'"


@query("rel_latest", f"SELECT name, version, release_id FROM ({_LATEST}) AS t WHERE nth = 1")
def rel_latest(v: Views) -> DataFrame:
    active = v.releases.select("preamble").distinct().filter("preamble NOT IN ('brand#1', 'brand13')")
    return R.latest_releases(v.releases, active).select("name", "version", "release_id")


@query("rel_outdated", "SELECT name, version, release_id, 0 AS active FROM {releases} WHERE name NOT IN (SELECT name FROM (SELECT name, rank() OVER (PARTITION BY preamble ORDER BY list_transform(string_split(version, '.'), lambda x: x::INT) DESC) AS nth FROM {releases}) AS t WHERE nth = 1)")
def rel_outdated(v: Views) -> DataFrame:
    return R.mark_outdated(v.releases, R.latest_releases(v.releases)).select("name", "version", "release_id", "active")


@query("rel_count_in_box", "SELECT asdf_id AS box_id, count(DISTINCT project_id) AS n_projects FROM {boxes} LEFT JOIN {locations} ON longitude BETWEEN minx AND maxx AND latitude BETWEEN miny AND maxy GROUP BY asdf_id")
def rel_count_in_box(v: Views) -> DataFrame:
    return R.projects_in_box(v.locations, v.boxes.select(F.col("asdf_id").alias("box_id"), *G.SIDES))


# ---- surfaces ----


def coded(v: Views) -> DataFrame:
    """Locations of geocoded and other projects with their geometry type."""
    df = R.merge_release(v.projects, v.locations).select("project_id", "project_location_id", "is_geocoded", "location_class", "location_type_code", "geographic_exactness", "recipients_iso3", "longitude", "latitude")
    return S.assign_geom_type(df, S.geometry_lookup(v.spark))


_KNOWN = {a: sorted({b for c, b, _, _ in S.GEOMETRY_CODES if c == a and b != "default"}) for a, *_ in S.GEOMETRY_CODES}
_EFFECTIVE = "CASE " + " ".join(f"WHEN location_class = '{a}' AND location_type_code IN ({', '.join(repr(t) for t in known)}) THEN location_type_code" for a, known in _KNOWN.items() if known) + " ELSE 'default' END"
_CODES = ", ".join(f"('{a}', '{b}', '{kind}', {data})" for a, b, kind, data in S.GEOMETRY_CODES)
_TYPED = f"""SELECT m.*, k.geom_type, k.geom_data FROM (SELECT project_id, project_location_id, is_geocoded, recipients_iso3, longitude, latitude, location_class, geographic_exactness, {_EFFECTIVE} AS eff FROM {{projects}} JOIN {{locations}} USING (project_id)) AS m
  LEFT JOIN (SELECT * FROM (VALUES {_CODES}) AS c(a, b, geom_type, geom_data)) AS k ON k.a = location_class AND k.b = eff AND geographic_exactness IN ('1', '2') AND is_geocoded = 1"""


@query("msr_geom_type", f"SELECT project_location_id, geom_type, geom_data FROM ({_TYPED}) AS t")
def msr_geom_type(v: Views) -> DataFrame:
    return coded(v).select("project_location_id", "geom_type", "geom_data")


_HELD = "(SELECT min(asdf_id) FROM {{{{areas}}}} a WHERE a.iso3 = recipients_iso3 AND a.level = {level} AND longitude >= minx AND longitude < maxx AND latitude >= miny AND latitude < maxy)"


def _points(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("project_location_id").alias("location_id"), F.col("recipients_iso3").alias("iso3"), F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))


def _areas(v: Views) -> DataFrame:
    """Boxes; those of level 3 are written from another corner and the other way round."""
    turned = F.transform("polygons", lambda p: F.transform(p, lambda r: F.reverse(F.concat(F.slice(r, 3, 3), F.slice(r, 2, 2)))))
    return polygons(v, "areas").withColumn("polygons", F.when(F.col("level") == 3, turned).otherwise(F.col("polygons"))).select("asdf_id", "iso3", "level", "polygons")


@query("msr_adm_lookup", f"SELECT project_location_id, level, {_HELD.format(level='l.level').format()} AS adm_id FROM (SELECT *, 1 + project_location_id % 4 AS level FROM {{locations}}) AS l")
def msr_adm_lookup(v: Views) -> DataFrame:
    points = _points(v.locations).withColumn("level", (1 + F.col("project_location_id") % 4).cast("int"))
    return S.adm_lookup(points, _areas(v)).select("project_location_id", F.col("level").cast("long").alias("level"), "adm_id")


_KIND = """CASE WHEN geom_type IS NULL OR length(recipients_iso3) <> 3 THEN NULL WHEN geom_type = 'buffer' THEN 'buffer' WHEN geom_data = 0 THEN 'country' WHEN adm_id IS NOT NULL THEN 'area' WHEN geom_data = 1 THEN 'country' ELSE 'buffer' END"""
_GEOMETRY = f"""SELECT project_location_id, geom_kind, CASE WHEN geom_kind = 'buffer' THEN CASE WHEN geom_type = 'buffer' THEN geom_data ELSE 25000 END END AS geom_metres,
    CASE geom_kind WHEN 'country' THEN recipients_iso3 WHEN 'area' THEN adm_id::VARCHAR END AS area_key, recipients_iso3 AS iso3, longitude AS lon, latitude AS lat
    FROM (SELECT *, {_KIND} AS geom_kind FROM (SELECT t.*, CASE WHEN geom_type = 'adm' THEN {_HELD.format(level="geom_data").format()} END AS adm_id FROM ({_TYPED}) AS t) AS u) AS w"""


def _assigned(v: Views) -> DataFrame:
    return S.assign_geometry(_points(coded(v)), v.adm0, _areas(v), GRID)


@query("msr_geometry", f"SELECT project_location_id, geom_kind, geom_metres, area_key FROM ({_GEOMETRY}) AS g")
def msr_geometry(v: Views) -> DataFrame:
    return _assigned(v).select("project_location_id", "geom_kind", "geom_metres", F.when(F.col("geom_kind").isin("country", "area"), F.col("geom_key")).alias("area_key"))


# Money of the kept locations (two donors, two sectors), by the geometry of each; the geometries' cells; the shares of both.
_KEPT = f"SELECT project_location_id, {_RATIO} * split_dollars_pp AS adjusted_val FROM ({_SPLIT}) AS s WHERE contains(donors, 'Donor1') OR contains(donors, 'Donor3')"
_G = "geom_kind, area_key, metres, iso3, lon, lat"
_CELLS = f"""WITH money AS (SELECT geom_kind, area_key, geom_metres AS metres, CASE WHEN geom_kind = 'buffer' THEN iso3 END AS iso3, CASE WHEN geom_kind = 'buffer' THEN lon END AS lon, CASE WHEN geom_kind = 'buffer' THEN lat END AS lat, sum(adjusted_val) AS value, count(*) AS n
    FROM ({_GEOMETRY}) AS g JOIN ({_KEPT}) AS k USING (project_location_id) WHERE geom_kind IS NOT NULL GROUP BY ALL),
  outline_cells AS (SELECT 'area' AS geom_kind, asdf_id::VARCHAR AS area_key, sr // 10 AS r, sc // 10 AS c, count(*) AS cover FROM {{areas}}, (SELECT unnest(range(600)) AS sr) AS rr, (SELECT unnest(range(1200)) AS sc) AS cc
    WHERE -180 + (sc + 0.5::DOUBLE) * 0.3::DOUBLE >= minx AND -180 + (sc + 0.5::DOUBLE) * 0.3::DOUBLE < maxx AND 90 - (sr + 0.5::DOUBLE) * 0.3::DOUBLE >= miny AND 90 - (sr + 0.5::DOUBLE) * 0.3::DOUBLE < maxy GROUP BY ALL
    UNION ALL SELECT 'country', iso3, sr // 10, sc // 10, count(*) FROM (SELECT iso3, sr, sc FROM {{country_edges}} AS e, (SELECT sr, sc, -180 + (sc + 0.5::DOUBLE) * 0.3::DOUBLE AS x, 90 - (sr + 0.5::DOUBLE) * 0.3::DOUBLE AS y FROM (SELECT unnest(range(600)) AS sr) AS rr, (SELECT unnest(range(1200)) AS sc) AS cc) AS s
      WHERE {CROSSES} GROUP BY iso3, sr, sc HAVING count(*) % 2 = 1) AS held GROUP BY ALL),
  places AS (SELECT lon, lat, metres::DOUBLE AS metres, iso3 FROM money WHERE geom_kind = 'buffer'), {circles_sql("places")},
  {CLIPPED_SQL},
  cells AS (SELECT geom_kind, area_key, NULL::INT AS metres, NULL::VARCHAR AS iso3, NULL::DOUBLE AS lon, NULL::DOUBLE AS lat, r, c, cover FROM outline_cells
    UNION ALL SELECT 'buffer', NULL, metres::INT, iso3, lon, lat, r, c, cover FROM clipped),
  shares AS (SELECT *, cover / sum(cover) OVER (PARTITION BY {_G}) AS share FROM cells),
  spread AS (SELECT m.geom_kind, m.area_key, m.metres, m.lon, m.lat, r::INT AS grid_row, c::INT AS grid_col, value * share AS value, n FROM money m JOIN shares s
    ON s.geom_kind = m.geom_kind AND s.area_key IS NOT DISTINCT FROM m.area_key AND s.metres IS NOT DISTINCT FROM m.metres AND s.iso3 IS NOT DISTINCT FROM m.iso3 AND s.lon IS NOT DISTINCT FROM m.lon AND s.lat IS NOT DISTINCT FROM m.lat)"""


def money(v: Views) -> DataFrame:
    """The kept locations with their adjusted money and geometry, from one join of projects and locations. What is read twice is staged: the join, by
    which a project's locations are counted, and the kept locations, whose distinct places look for their areas."""
    projects = v.projects.select("project_id", "is_geocoded", "total_commitments", "donors", "ad_sector_names")
    release = staged(R.merge_release(projects, v.locations), "release")
    kept = R.adjust_value(R.apply_filters(R.split_value(release), {"donors": ["Donor1", "Donor3"]}), ["Health", "Energy"])
    columns = ("project_location_id", "is_geocoded", "location_class", "location_type_code", "geographic_exactness", "recipients_iso3", "longitude", "latitude", "adjusted_val")
    typed = staged(S.assign_geom_type(kept.select(*columns), S.geometry_lookup(v.spark)), "typed-locations")
    located = S.geometry_name(S.assign_geometry(_points(typed), v.adm0, _areas(v), GRID)).filter("geom IS NOT NULL")
    return located.select("geom", "geom_kind", "geom_key", "geom_metres", "iso3", "lon", "lat", F.col("location_id").cast("string").alias("location_id"), "adjusted_val")


def surface_cells(v: Views, located: DataFrame) -> DataFrame:
    return S.geometry_cells(located, countries(v), _areas(v), GRID)


def cents() -> Column:
    """Cut to cents where sums in any order agree: no amount ends in .6289 of one."""
    return (F.floor(F.col("value") * 100 + 0.3711) / 100).alias("value")


@query("msr_spread", f"{_CELLS} SELECT geom_kind, area_key, metres AS geom_metres, lon, lat, grid_row, grid_col, floor(value * 100 + 0.3711::DOUBLE) / 100 AS value FROM spread")
def msr_spread(v: Views) -> DataFrame:
    located = staged(money(v), "located-money")
    values = located.groupBy("geom").agg(F.sum("adjusted_val").alias("value"))
    named = located.select("geom", "geom_kind", F.when(F.col("geom_kind") != "buffer", F.col("geom_key")).alias("area_key"), "geom_metres", *(F.when(F.col("geom_kind") == "buffer", F.col(c)).alias(c) for c in ("lon", "lat"))).dropDuplicates(["geom"])
    return S.spread(values, surface_cells(v, located)).join(named, "geom").select("geom_kind", "area_key", "geom_metres", "lon", "lat", "grid_row", "grid_col", cents())


@query("msr_surface", f"{_CELLS} SELECT grid_row, grid_col, floor(sum(value) * 100 + 0.3711::DOUBLE) / 100 AS value FROM spread GROUP BY grid_row, grid_col")
def msr_surface(v: Views) -> DataFrame:
    located = staged(money(v), "located-money")
    return S.build_surface(located, surface_cells(v, located)).withColumn("value", cents())


_BOXED = "SELECT m.*, CASE WHEN geom_kind = 'area' THEN minx || ' ' || miny || ' ' || maxx || ' ' || maxy END AS outline FROM located AS m LEFT JOIN {{areas}} AS a ON a.asdf_id::VARCHAR = m.area_key"
_LOCATED = f"""located AS (SELECT geom_kind, area_key, geom_metres, CASE WHEN geom_kind = 'buffer' THEN iso3 END AS iso3, CASE WHEN geom_kind = 'buffer' THEN lon END AS lon, CASE WHEN geom_kind = 'buffer' THEN lat END AS lat, project_location_id::VARCHAR AS location_id, adjusted_val
  FROM ({_GEOMETRY}) AS g JOIN ({_KEPT}) AS k USING (project_location_id) WHERE geom_kind IS NOT NULL)"""


@query("msr_unique_geoms", f"""WITH {_LOCATED}, boxed AS ({_BOXED.format()})
  SELECT geom_kind, iso3, floor(sum(adjusted_val) * 100 + 0.3711::DOUBLE) / 100 AS unique_dollars, count(*) AS location_count, string_agg(location_id, '|' ORDER BY location_id) AS location_ids, CASE geom_kind WHEN 'buffer' THEN 65 WHEN 'area' THEN 5 ELSE (SELECT count(*) FROM {{country_corners}} c WHERE c.iso3 = min(boxed.area_key)) END AS n_vertices
  FROM boxed GROUP BY geom_kind, iso3, geom_metres, lon, lat, coalesce(outline, area_key)""")
def msr_unique_geoms(v: Views) -> DataFrame:
    """Areas of level 1 and 3 that have one outline are one geometry, though theirs are written from another corner the other way round."""
    unique = unique_geoms(v, staged(money(v), "located-money"))
    return unique.select("geom_kind", "iso3", ((F.floor(F.col("unique_dollars") * 100 + 0.3711)) / 100).alias("unique_dollars"), "location_count", "location_ids", F.size(F.flatten(F.flatten("polygons"))).cast("long").alias("n_vertices"))


def unique_geoms(v: Views, located: DataFrame) -> DataFrame:
    shapes = S.geometry_shapes(located, countries(v), _areas(v))
    return S.unique_geometries(located, staged(shapes, "geometry-shapes"))


_SECTORS = "SELECT DISTINCT unnest(string_split(ad_sector_names, '|')) AS s FROM {projects}"
_DONORS = "SELECT DISTINCT unnest(string_split(donors, '|')) AS d FROM {projects}"
_COMBOS = f"""SELECT sectors, donors FROM (SELECT []::VARCHAR[] AS sectors UNION ALL SELECT [s] FROM ({_SECTORS}) AS a UNION ALL SELECT [a.s, b.s] FROM ({_SECTORS}) AS a JOIN ({_SECTORS}) AS b ON a.s < b.s) AS x,
  (SELECT []::VARCHAR[] AS donors UNION ALL SELECT [d] FROM ({_DONORS}) AS e) AS y"""


@query("msr_filter_combos", f"SELECT array_to_string(sectors, '|') AS sectors, array_to_string(donors, '|') AS donors FROM ({_COMBOS}) AS c")
def msr_filter_combos(v: Views) -> DataFrame:
    return S.filter_combos(v.projects).select(F.array_join("sectors", "|").alias("sectors"), F.array_join("donors", "|").alias("donors"))


@query(
    "msr_combo_stats",
    f"""WITH strings AS (SELECT ad_sector_names, donors AS names, count(*) AS n, sum(split_dollars_pp) AS dollars FROM ({_SPLIT}) AS s GROUP BY 1, 2), combos AS ({_COMBOS}), total AS (SELECT sum(dollars) AS total FROM strings),
    m AS (SELECT sectors, c.donors, sum(n)::BIGINT AS count, sum(dollars * CASE WHEN len(sectors) = 0 THEN 1 ELSE len(list_filter(string_split(ad_sector_names, '|'), lambda x: list_contains(sectors, x))) / len(string_split(ad_sector_names, '|')) END) AS adjusted FROM combos c, strings
      WHERE (len(sectors) = 0 OR len(list_filter(sectors, lambda t: contains(ad_sector_names, t))) > 0) AND (len(c.donors) = 0 OR len(list_filter(c.donors, lambda t: contains(names, t))) > 0) GROUP BY sectors, c.donors)
    SELECT array_to_string(sectors, '|') AS sectors, array_to_string(donors, '|') AS donors, count, floor(adjusted + 0.3711::DOUBLE)::BIGINT AS adjusted, round(floor(round(100000 * adjusted / total, 6)) / 1000, 3) AS percentage
    FROM m, total WHERE NOT (count < 10 AND len(sectors) > 0 AND len(donors) > 0) AND adjusted > 0""",
)
def msr_combo_stats(v: Views) -> DataFrame:
    df = split(v)
    stats = S.combo_stats(df.select("ad_sector_names", "donors", "split_dollars_pp"), S.filter_combos(v.projects))
    whole = F.floor(F.col("adjusted") + 0.3711)  # sums in any order agree: no sum of money ends in .6289
    return stats.select("sectors", "donors", "count", whole.alias("adjusted"), "percentage")
