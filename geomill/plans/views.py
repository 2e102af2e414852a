"""The library's input shapes as views over the given star-schema tables.

Each view is one SELECT in SQL that both Spark and DuckDB read (`//` is whole division; Spark gets `div`). Names in braces are
tables or other views. Polygons are given by the corners of their rings (part, ring, k). `shape_corners` are polygons of five corners, one
inward, in the boxes of `features`, some with a hole and some with a second part; that of feature 24 is too small to hold a sub-cell's
centre. `country_corners` are countries with crooked borders that neighbours share; RG1 has a hole that is the second part of RG2, and
RG3 has one that is no country's. `areas` are administrative boxes of levels 1 to 3; in RG4 those of level 3 have the outlines of level 1. Grid: 3 degree pixels from (-180, 90), 60 rows, 120 columns; sub-cells of 0.3 degrees, counted from the west
(sc) and the north (sr).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

GRID = {"minx": -180.0, "maxy": 90.0, "px": 3.0, "nrows": 60, "ncols": 120}
NOW = 1706745600  # 2024-02-01
CATEGORIES = {"urgent": 1, "high": 2, "medium": 3, "not_specified": 4, "low": 5, "unused": 9}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_SECTOR = "CASE {} WHEN 0 THEN 'Health' WHEN 1 THEN 'Education' WHEN 2 THEN 'Energy' WHEN 3 THEN 'Water' WHEN 4 THEN 'Roads' ELSE 'Health Policy' END"
_KIND = "CASE {} WHEN 0 THEN 'mean' WHEN 1 THEN 'max' WHEN 2 THEN 'min' WHEN 3 THEN 'sum' WHEN 4 THEN 'count' WHEN 5 THEN 'categorical' ELSE 'reliability' END"

# Rings as (part, ring): corners (x, y); closed when they become rows.
_SHAPE = {
    (0, 0): ((0.013, 0.021), (0.987, 0.312), (0.553, 0.524), (0.991, 0.979), (0.217, 0.731)),
    (0, 1): ((0.31, 0.41), (0.43, 0.37), (0.47, 0.49), (0.35, 0.52)),
    (1, 0): ((0.03, 0.83), (0.17, 0.8), (0.11, 0.97)),
}
_ENCLAVE = {at: ((0.0, 0.0), (9.1, 1.3), (11.7, 8.9), (1.9, 7.3)) for at in ((0, 1), (1, 0))}
_STEP = "CASE WHEN k <= 8 THEN k WHEN k <= 17 THEN 17 - k ELSE 0 END"  # corners go up the western border and down the eastern one


def _corner_rows(rings: dict) -> str:
    rows = [(*at, k, *corners[k % len(corners)]) for at, corners in rings.items() for k in range(len(corners) + 1)]
    return " UNION ALL ".join(f"SELECT {p} AS part, {r} AS ring, {k} AS k, CAST({x} AS DOUBLE) AS cx, CAST({y} AS DOUBLE) AS cy" for p, r, k, x, y in rows)


def _border(number: str) -> str:
    """The x of the border with this number, 0 and 5 being the ends of the world, at a step of 22.5 degrees."""
    return f"CASE WHEN {number} = 0 THEN CAST(-180 AS DOUBLE) WHEN {number} = 5 THEN CAST(180 AS DOUBLE) ELSE CAST(-180 AS DOUBLE) + 72 * ({number}) + CAST(1.37 AS DOUBLE) * ((({number}) * 7 + ({_STEP}) * 5) % 9 - 4) END"


VIEWS = {
    "pixels": """SELECT 'ras_' || CAST(2000 + o_orderkey // 7200 AS STRING) AS resource, CAST((o_orderkey % 7200) // 120 AS INT) AS grid_row, CAST(o_orderkey % 120 AS INT) AS grid_col,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS value, CAST(substr(o_orderpriority, 1, 1) AS INT) AS category,
        CAST((100 + o_custkey % 5) * 10 + o_custkey % 10 AS INT) AS encoded FROM {orders}""",
    "features": """SELECT CAST(n_nationkey AS BIGINT) AS asdf_id, 'world_adm1_v1' AS boundary, 'RG' || CAST(n_nationkey % 5 AS STRING) AS iso3, n_name AS name,
        240 * (n_nationkey % 5) + 3 AS sc0, 240 * (n_nationkey % 5) + 238 AS sc1, 120 * (n_nationkey // 5) + 5 AS sr0, 120 * (n_nationkey // 5) + 116 AS sr1 FROM {nation}""",
    "boxes": """SELECT asdf_id, boundary, iso3, name, -180 + CAST(0.3 AS DOUBLE) * sc0 AS minx, 90 - CAST(0.3 AS DOUBLE) * sr1 AS miny, -180 + CAST(0.3 AS DOUBLE) * sc1 AS maxx, 90 - CAST(0.3 AS DOUBLE) * sr0 AS maxy FROM {features}""",
    "shape_frames": """SELECT asdf_id, minx + CASE WHEN asdf_id = 24 THEN 1 ELSE 0 END AS x, miny + CASE WHEN asdf_id = 24 THEN 1 ELSE 0 END AS y, (maxx - minx) * CASE WHEN asdf_id = 24 THEN CAST(0.0003 AS DOUBLE) ELSE 1 END AS w,
        (maxy - miny) * CASE WHEN asdf_id = 24 THEN CAST(0.0003 AS DOUBLE) ELSE 1 END AS h FROM {boxes}""",
    "shape_corners": f"""SELECT asdf_id, part, ring, k, x + cx * w AS x, y + cy * h AS y FROM {{shape_frames}} JOIN ({_corner_rows(_SHAPE)}) AS c
        ON part = 0 AND ring = 0 OR ring = 1 AND asdf_id % 3 = 0 AND asdf_id <> 24 OR part = 1 AND asdf_id % 4 = 1""",
    "shape_edges": """SELECT asdf_id, x AS x0, y AS y0, x1, y1 FROM (SELECT *, lead(x) OVER (PARTITION BY asdf_id, part, ring ORDER BY k) AS x1, lead(y) OVER (PARTITION BY asdf_id, part, ring ORDER BY k) AS y1 FROM {shape_corners}) AS e WHERE x1 IS NOT NULL""",
    "country_corners": f"""SELECT CAST(r_regionkey AS BIGINT) AS region_id, 'RG' || CAST(r_regionkey AS STRING) AS iso3, 0 AS part, 0 AS ring, k, {_border("CASE WHEN k BETWEEN 9 AND 17 THEN r_regionkey + 1 ELSE r_regionkey END")} AS x,
        CAST(-90 AS DOUBLE) + CAST(22.5 AS DOUBLE) * ({_STEP}) AS y FROM {{region}}, ({" UNION ALL ".join(f"SELECT {k} AS k" for k in range(19))}) AS ks
        UNION ALL SELECT CAST(r_regionkey AS BIGINT), 'RG' || CAST(r_regionkey AS STRING), part, ring, k, CASE WHEN r_regionkey = 3 THEN CAST(66.1 AS DOUBLE) ELSE CAST(-78.3 AS DOUBLE) END + cx, CAST(10.2 AS DOUBLE) + cy
        FROM {{region}} JOIN ({_corner_rows(_ENCLAVE)}) AS c ON ring = 1 AND r_regionkey IN (1, 3) OR part = 1 AND r_regionkey = 2""",
    "country_edges": """SELECT region_id, iso3, x AS x0, y AS y0, x1, y1 FROM (SELECT *, lead(x) OVER (PARTITION BY iso3, part, ring ORDER BY k) AS x1, lead(y) OVER (PARTITION BY iso3, part, ring ORDER BY k) AS y1 FROM {country_corners}) AS e WHERE x1 IS NOT NULL""",
    "grids": """SELECT DISTINCT 'ras_' || CAST(2000 + o_orderkey // 7200 AS STRING) AS resource FROM {orders}""",
    "areas": """SELECT asdf_id, iso3, 1 AS level, minx, miny, maxx, maxy FROM {boxes}
        UNION ALL SELECT 100 + asdf_id, iso3, 2, minx, miny, minx + CAST(0.4137 AS DOUBLE) * (maxx - minx), maxy FROM {boxes}
        UNION ALL SELECT 200 + asdf_id, iso3, 2, minx + CAST(0.4137 AS DOUBLE) * (maxx - minx), miny, maxx, maxy FROM {boxes}
        UNION ALL SELECT 300 + asdf_id, iso3, 3, minx, miny, maxx, miny + CAST(0.617 AS DOUBLE) * (maxy - miny) FROM {boxes} WHERE iso3 <> 'RG4'
        UNION ALL SELECT 400 + asdf_id, iso3, 3, minx, miny, maxx, maxy FROM {boxes} WHERE iso3 = 'RG4'""",
    "adm0": """SELECT CAST(r_regionkey AS BIGINT) AS region_id, 'RG' || CAST(r_regionkey AS STRING) AS iso3, r_name AS country, 240 * r_regionkey AS sc0, 240 * (r_regionkey + 1) AS sc1, 0 AS sr0, 600 AS sr1 FROM {region}""",
    "projects": f"""SELECT CAST(o_orderkey AS STRING) AS project_id, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS total_commitments, o_totalprice * CAST(0.5 AS DOUBLE) AS total_disbursements,
        CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS is_geocoded, CAST(year(o_orderdate) AS INT) AS transactions_start_year, CAST(year(o_orderdate) + o_custkey % 3 AS INT) AS transactions_end_year,
        'Donor' || CAST(o_custkey % 4 AS STRING) || CASE WHEN o_custkey % 3 = 0 THEN '|Donor' || CAST((o_custkey // 4) % 4 AS STRING) ELSE '' END AS donors,
        {_SECTOR.format("o_custkey % 6")} || CASE WHEN o_custkey % 2 = 0 THEN '|' || {_SECTOR.format("(o_custkey // 6) % 6")} ELSE '' END AS ad_sector_names FROM {{orders}}""",
    "locations": """SELECT CAST(l_orderkey AS STRING) AS project_id, l_orderkey * 10 + l_linenumber AS project_location_id, CAST(-179.91 AS DOUBLE) + CAST(0.18 AS DOUBLE) * pk AS longitude,
        CAST(-89.9 AS DOUBLE) + CAST(1.8 AS DOUBLE) * ((sk * 13) % 100) AS latitude, CAST(1 + sk % 5 AS STRING) AS location_class,
        CASE pk % 8 WHEN 0 THEN 'PCLI' WHEN 1 THEN 'ADM1' WHEN 2 THEN 'ADM2' WHEN 3 THEN 'PPL' WHEN 4 THEN 'PPLX' WHEN 5 THEN 'ADM3' WHEN 6 THEN 'ADM4' ELSE 'STRM' END AS location_type_code, CAST(1 + l_linenumber % 3 AS STRING) AS geographic_exactness,
        CASE WHEN sk % 17 = 0 THEN '' ELSE 'RG' || CAST(CAST(floor((CAST(-179.91 AS DOUBLE) + CAST(0.18 AS DOUBLE) * pk + 180) / 72) AS INT) AS STRING) END AS recipients_iso3
        FROM (SELECT l_orderkey, l_linenumber, min((l_partkey * 37) % 2000) AS pk, min(l_suppkey) AS sk FROM {lineitem} GROUP BY l_orderkey, l_linenumber) AS one""",
    "transactions": """SELECT CAST(l_orderkey AS STRING) AS project_id, CAST(year(l_shipdate) AS INT) AS transaction_year, l_extendedprice AS transaction_value FROM {lineitem}""",
    "releases": """SELECT lower(replace(p_brand, '#', '')) || '_geocodedresearchrelease_level1_v' || CAST(p_size % 3 AS STRING) || '_' || CAST(p_partkey % 4 AS STRING) || '_' || CAST(p_partkey % 12 AS STRING) AS name,
        lower(replace(p_brand, '#', '')) AS preamble, CAST(p_size % 3 AS STRING) || '.' || CAST(p_partkey % 4 AS STRING) || '.' || CAST(p_partkey % 12 AS STRING) AS version, p_partkey AS release_id FROM {part}""",
    "catalog": """SELECT 'ds' || CAST(p_partkey AS STRING) AS dataset, p_partkey, CASE p_partkey % 10 WHEN 7 THEN 'release' WHEN 9 THEN 'other' ELSE 'raster' END AS type,
        -180 + CAST(0.3 AS DOUBLE) * ((p_partkey * 53) % 1000) AS minx, -90 + CAST(0.3 AS DOUBLE) * ((p_partkey * 29) % 500) AS miny,
        -180 + CAST(0.3 AS DOUBLE) * ((p_partkey * 53) % 1000 + 4 * p_size) AS maxx, -90 + CAST(0.3 AS DOUBLE) * ((p_partkey * 29) % 500 + 2 * p_size) AS maxy,
        CASE WHEN p_partkey % 40 = 3 THEN 'global' ELSE 'regional' END AS scale, CASE p_size % 4 WHEN 0 THEN 'mean' WHEN 1 THEN 'mean|max' WHEN 2 THEN 'sum|count|min' ELSE 'categorical' END AS extract_types,
        CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'any' ELSE 'false' END AS pixel_check, CASE WHEN p_size % 10 = 0 THEN 0 ELSE 1 END AS active FROM {part}""",
    "files": """SELECT 'ds' || CAST(p_partkey AS STRING) AS dataset, 'ds' || CAST(p_partkey AS STRING) AS name, CAST(1000 + p_size * 10 + y - 2000 AS BIGINT) AS bytes, y AS file_year,
        CASE p_partkey % 4 WHEN 0 THEN 'None' WHEN 1 THEN 'ds_YYYY.tif' WHEN 2 THEN 'YYYY/ds_YYYY_MM.tif' ELSE 'YYYY/ds_YYYY_DDD.tif' END AS mask,
        CASE p_partkey % 4 WHEN 0 THEN 'data.tif' WHEN 1 THEN 'ds_' || CAST(y AS STRING) || '.tif'
          WHEN 2 THEN CAST(y AS STRING) || '/ds_' || CAST(y AS STRING) || '_' || lpad(CAST(1 + (p_partkey + y) % 12 AS STRING), 2, '0') || '.tif'
          ELSE CAST(y AS STRING) || '/ds_' || CAST(y AS STRING) || '_' || lpad(CAST(1 + (p_partkey * 7 + y) % 365 AS STRING), 3, '0') || '.tif' END AS path
        FROM {part}, (SELECT 2000 AS y UNION ALL SELECT 2001 UNION ALL SELECT 2002 UNION ALL SELECT 2003 UNION ALL SELECT 2004) AS years WHERE p_partkey % 4 <> 0 OR y = 2000""",
    "work": f"""SELECT boundary, data, extract_type, version, classification, generator, status, priority, attempts, submit_time, update_time FROM (
        SELECT 'b' || CAST(o_custkey % 25 AS STRING) AS boundary, 'ds' || CAST(o_orderkey % 200 AS STRING) AS data, {_KIND.format("o_orderkey % 7")} AS extract_type,
        CASE WHEN o_custkey % 3 = 0 THEN '1.0' ELSE '2.0' END AS version, CASE WHEN o_orderkey % 2 = 0 THEN 'auto-external' ELSE 'det-release' END AS classification, 'auto' AS generator,
        CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE CASE WHEN o_orderkey % 2 = 0 THEN -1 ELSE 2 END END AS status, CAST(o_orderkey % 3 - 1 AS INT) AS priority, CAST(o_custkey % 25 AS INT) AS attempts,
        CAST({{epoch:o_orderdate}} AS BIGINT) AS submit_time, CAST({{epoch:o_orderdate}} + 600 * (o_orderkey % 5) AS BIGINT) AS update_time,
        row_number() OVER (PARTITION BY o_custkey % 25, o_orderkey % 200, o_orderkey % 7, o_custkey % 3 = 0 ORDER BY o_orderkey) AS nth FROM {{orders}}) AS w WHERE nth = 1""",
    "requests": """SELECT CAST(user_id AS STRING) || '_' || CAST(day(ts) // 6 AS STRING) AS email, CAST({epoch:ts} AS BIGINT) AS request_time, CAST({epoch:ts} AS BIGINT) AS complete_time, 1 AS status, 0 AS comments_requested,
        CASE WHEN event_type = 'error' AND value > 100 THEN 1 ELSE 0 END AS contact_flag FROM {events}""",
    "request_items": f"""SELECT DISTINCT l_orderkey AS request_id, 'b' || CAST(o_custkey % 25 AS STRING) AS boundary, CASE WHEN l_linenumber = 1 THEN 'surface' ELSE 'raster' END AS kind,
        'ds' || CAST((l_orderkey + l_linenumber - 1) % 200 AS STRING) AS data, {_KIND.format("l_orderkey % 7")} AS extract_type FROM {{lineitem}} JOIN {{orders}} ON o_orderkey = l_orderkey""",
    "extract_results": """SELECT DISTINCT boundary, data, extract_type FROM {work} WHERE status = 1 AND attempts % 4 <> 0""",
}

_NAME = re.compile(r"\{(\w+)\}")
_EPOCH = re.compile(r"\{epoch:(\w+)\}")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a given table, as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = _EPOCH.sub(r"unix_timestamp(\1)", VIEWS[name]).replace("//", "div")
    return spark.sql(sql, **{n: view(spark, sf_dir, n) for n in set(_NAME.findall(VIEWS[name]))})


def duckdb_sql(query: str) -> str:
    """A DuckDB query over views named in braces, with the views it needs as common table expressions."""
    needed: dict[str, None] = {}

    def need(name: str) -> None:
        if name not in TABLES and name not in needed:
            for inner in _NAME.findall(VIEWS[name]):
                need(inner)
            needed[name] = None

    for name in _NAME.findall(query):
        need(name)
    plain = lambda s: _NAME.sub(r"\1", _EPOCH.sub(r"floor(epoch(\1))", s))
    parts = [f"{n} AS ({plain(VIEWS[n])})" for n in needed]
    recursive, body = query.strip().startswith("WITH "), plain(query).strip()
    if not parts:
        return body
    return f"WITH {', '.join(parts)}" + (f", {body[5:]}" if recursive else f" {body}")
