"""Queries of the catalog and of relevance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomill.functions import geometry as G
from geomill.operators import catalog as C
from geomill.operators import tracker as K
from geomill.plans.q_geometry import row_box
from geomill.plans.registry import Views, query
from geomill.plans.views import GRID

_RESOURCES = """SELECT dataset, path, bytes, mask, CASE WHEN mask = 'None' THEN dataset || '_none' WHEN mask = 'ds_YYYY.tif' THEN dataset || '_' || file_year ELSE dataset || '_' || file_year || substr(path, 14, CASE WHEN mask LIKE '%MM%' THEN 2 ELSE 3 END) END AS name,
  CASE WHEN mask = 'None' THEN 10000101 WHEN mask = 'ds_YYYY.tif' THEN file_year * 10000 + 101 WHEN mask LIKE '%MM%' THEN file_year * 10000 + substr(path, 14, 2)::INT * 100 + 1 ELSE strftime(make_date(file_year, 1, 1) + (substr(path, 14, 3)::INT - 1), '%Y%m%d')::INT END AS s,
  CASE WHEN mask = 'None' THEN 99991231 WHEN mask = 'ds_YYYY.tif' THEN file_year * 10000 + 1231 WHEN mask LIKE '%MM%' THEN strftime(last_day(make_date(file_year, substr(path, 14, 2)::INT, 1)), '%Y%m%d')::INT ELSE strftime(make_date(file_year, 1, 1) + (substr(path, 14, 3)::INT - 1), '%Y%m%d')::INT END AS e,
  CASE WHEN mask = 'None' THEN 'none' WHEN mask = 'ds_YYYY.tif' THEN 'year' WHEN mask LIKE '%MM%' THEN 'year month' ELSE 'year day' END AS type FROM {files}"""


@query("cat_resources", f'SELECT dataset, name, path, bytes, s AS "start", e AS "end", type, NULL::VARCHAR AS problem FROM ({_RESOURCES}) AS r')
def cat_resources(v: Views) -> DataFrame:
    return C.build_resources(v.files.drop("name"))


@query("cat_temporal", f'SELECT dataset, min(s) AS "start", max(e) AS "end", min(type) AS type FROM ({_RESOURCES}) AS r GROUP BY dataset')
def cat_temporal(v: Views) -> DataFrame:
    return C.dataset_temporal(C.build_resources(v.files.drop("name")))


@query("flt_resources_by_year", "SELECT dataset, path, CASE WHEN mask = 'None' THEN '' ELSE file_year::VARCHAR END AS year, CASE WHEN mask LIKE '%MM%' THEN substr(path, 14, 2) ELSE '' END AS month, CASE WHEN mask LIKE '%DDD%' THEN substr(path, 14, 3) ELSE '' END AS day FROM {files} WHERE mask = 'None' OR file_year IN (2000, 2001, 2003)")
def flt_resources_by_year(v: Views) -> DataFrame:
    years = v.files.select("dataset").distinct().withColumn("years", F.array(*map(F.lit, (2000, 2001, 2003))))
    return C.select_resources(v.files, years)




@query("cat_extent_check", "SELECT dataset, name, minx, maxx FROM (SELECT dataset, path AS name, 0 AS minx, CASE WHEN bytes % 7 = 0 THEN file_year + 1 ELSE 2000 END AS maxx, first_value(CASE WHEN bytes % 7 = 0 THEN file_year + 1 ELSE 2000 END) OVER (PARTITION BY dataset ORDER BY path) AS first_x FROM {files}) AS t WHERE maxx <> first_x")
def cat_extent_check(v: Views) -> DataFrame:
    wide = F.when(F.col("bytes") % 7 == 0, F.col("file_year") + 1).otherwise(2000)
    boxed = v.files.select("dataset", F.col("path").alias("name"), F.lit(0).alias("minx"), F.lit(0).alias("miny"), wide.alias("maxx"), F.lit(10).alias("maxy"))
    return C.extent_mismatch(boxed).select("dataset", "name", "minx", "maxx")


_ENTRIES = """SELECT 'ds' || CAST(p_partkey AS STRING) AS name, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE '/data/' || CAST(p_partkey AS STRING) END AS base, CASE WHEN p_partkey % 13 = 0 THEN 'vector' ELSE 'raster' END AS type,
  CASE WHEN p_partkey % 17 = 0 THEN '.png' ELSE '.tif' END AS file_extension, 'None' AS file_mask, CASE WHEN p_size % 9 = 0 THEN 'mean|mode' WHEN p_size % 9 = 1 THEN 'categorical' ELSE 'mean' END AS extract_types,
  CASE WHEN p_partkey % 19 = 0 THEN 'ten' WHEN p_partkey % 19 = 1 THEN '' ELSE '0.1' END AS factor, CASE WHEN p_partkey % 2 = 0 THEN 'forest:1|water:2' WHEN p_partkey % 3 = 0 THEN 'forest' END AS category_values FROM {part}"""


@query(
    "cat_validate",
    f"""SELECT name, concat_ws('|', CASE WHEN extract_types = 'categorical' AND (category_values IS NULL OR category_values = 'forest') THEN 'category map' END, CASE WHEN factor = 'ten' THEN 'factor is no number' END, CASE WHEN base = '' THEN 'missing base' END,
    CASE WHEN type <> 'vector' AND file_extension = '.png' THEN 'unknown extension' END, CASE WHEN contains(extract_types, 'mode') THEN 'unknown extract type' END, CASE WHEN type = 'vector' THEN 'unknown type' END) AS problems FROM ({_ENTRIES}) AS t""",
)
def cat_validate(v: Views) -> DataFrame:
    return C.validate_catalog(v.spark.sql(_ENTRIES, part=v.part))


_OLD = "SELECT CAST(p_partkey AS INT) AS id, 'ds' || CAST(p_partkey AS STRING) AS name, '/b/' || CAST(p_partkey AS STRING) AS base FROM {part} WHERE p_partkey % 2 = 0"
_NEW = """SELECT p_partkey AS new_id, 'ds' || CAST(p_partkey + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS STRING) AS name, '/b/' || CAST(p_partkey + CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS STRING) AS base,
  CASE WHEN p_partkey % 3 = 0 AND p_partkey % 2 = 0 THEN CAST(p_partkey AS INT) END AS id FROM {part}"""


@query(
    "cat_unique",
    f"""SELECT new_id, conflict FROM (SELECT new_id, CASE WHEN a.id IS NOT NULL AND b.id IS NOT NULL AND a.id <> b.id THEN 'split' WHEN a.id IS NOT NULL AND a.id IS DISTINCT FROM n.id THEN 'name' WHEN b.id IS NOT NULL AND b.id IS DISTINCT FROM n.id THEN 'base' END AS conflict
    FROM ({_NEW}) AS n LEFT JOIN ({_OLD}) AS a ON a.name = n.name LEFT JOIN ({_OLD}) AS b ON b.base = n.base) AS t WHERE conflict IS NOT NULL""",
)
def cat_unique(v: Views) -> DataFrame:
    return C.catalog_conflicts(v.spark.sql(_NEW, part=v.part), v.spark.sql(_OLD, part=v.part))


_RECORDS = "SELECT 'ds' || CAST(p_partkey AS STRING) AS name, p_brand AS title, p_size AS size, CAST(20200101 AS INT) AS date_added FROM {part} WHERE p_partkey % 3 <> 0"
_UPDATES = "SELECT 'ds' || CAST(p_partkey AS STRING) AS name, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_type END AS title, p_size + 1 AS size, CAST(20240101 AS INT) AS date_added FROM {part} WHERE p_partkey % 2 = 0"


@query("cat_upsert", f"SELECT coalesce(a.name, b.name) AS name, CASE WHEN b.name IS NOT NULL THEN b.title ELSE a.title END AS title, CASE WHEN b.name IS NOT NULL THEN b.size ELSE a.size END AS size, coalesce(a.date_added, b.date_added) AS date_added FROM ({_RECORDS}) AS a FULL JOIN ({_UPDATES}) AS b ON a.name = b.name")
def cat_upsert(v: Views) -> DataFrame:
    return C.upsert_catalog(v.spark.sql(_RECORDS, part=v.part), v.spark.sql(_UPDATES, part=v.part))


_TRACKED = "SELECT 'g' || CAST(o_custkey % 40 AS STRING) AS grp, 'ds' || CAST(o_orderkey % 300 AS STRING) AS dataset FROM {orders}"
_EXTRACTED = "SELECT 'b' || CAST(o_custkey % 40 AS STRING) AS boundary, 'ds' || CAST(o_orderkey % 300 AS STRING) AS dataset FROM {orders}"


@query(
    "cat_invalidate",
    f"""SELECT 'tracker' AS kind, grp AS holder, dataset, count(*) AS n FROM ({_TRACKED}) AS t WHERE grp NOT IN ('g3', 'g5') AND dataset NOT IN ('ds7', 'ds11') GROUP BY 2, 3
    UNION ALL SELECT 'extract', boundary, dataset, count(*) FROM ({_EXTRACTED}) AS e WHERE boundary NOT IN ('b3', 'b5') GROUP BY 2, 3""",
)
def cat_invalidate(v: Views) -> DataFrame:
    kind = F.when(F.col("p_partkey").isin(3, 5), "boundary").when(F.col("p_partkey").isin(7, 11), "dataset")
    changed = v.part.select(kind.alias("kind"), F.concat(F.when(F.col("p_partkey").isin(3, 5), "b").otherwise("ds"), F.col("p_partkey").cast("string")).alias("name"), F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("group")).filter("kind IS NOT NULL")
    trackers = v.spark.sql(_TRACKED, orders=v.orders).withColumnRenamed("grp", "group")
    left, extracts = C.invalidate(trackers, v.spark.sql(_EXTRACTED, orders=v.orders), changed)
    count = lambda df, name, kind: df.groupBy(F.lit(kind).alias("kind"), F.col(name).alias("holder"), "dataset").agg(F.count("*").alias("n"))
    return count(left, "group", "tracker").unionByName(count(extracts, "boundary", "extract"))


# ---- relevance ----


def groups(v: Views) -> DataFrame:
    return v.boxes.select(F.concat(F.lit("g"), F.col("asdf_id").cast("string")).alias("group"), "iso3", F.when(F.col("asdf_id") == 24, "global").otherwise("regional").alias("scale"), row_box().alias("bbox"))


_TRACKER = "SELECT 'g' || CAST(p_partkey % 25 AS STRING) AS grp, 'ds' || CAST(p_partkey AS STRING) AS dataset FROM {part}"
_MEET = "b.minx <= c.maxx AND b.maxx >= c.minx AND b.miny <= c.maxy AND b.maxy >= c.miny"


@query("trk_candidates", f"""SELECT 'g' || asdf_id AS "group", c.dataset, -1 AS status FROM {{boxes}} b JOIN {{catalog}} c ON (asdf_id = 24 OR c.scale = 'global' OR ({_MEET})) WHERE NOT EXISTS (SELECT 1 FROM ({_TRACKER}) AS t WHERE t.grp = 'g' || asdf_id AND t.dataset = c.dataset)""")
def trk_candidates(v: Views) -> DataFrame:
    tracker = v.spark.sql(_TRACKER, part=v.part).withColumnRenamed("grp", "group")
    return K.tracker_candidates(groups(v), v.catalog.select("dataset", "scale", row_box().alias("bbox")), tracker)


_CELLS = "((maxx - minx) / 0.05::DOUBLE * ((maxy - miny) / 0.05::DOUBLE))"


@query("trk_sample_step", f"SELECT dataset, min(s)::INT AS step FROM (SELECT dataset, {_CELLS} AS cells, unnest(range(1, 60)) AS s FROM {{catalog}}) AS t WHERE cells / (s * s) <= 100000 GROUP BY dataset")
def trk_sample_step(v: Views) -> DataFrame:
    return v.catalog.select("dataset", K.sample_step(row_box(), F.lit(0.05)).alias("step"))


_STEP = "SELECT asdf_id, minx, miny, maxx, maxy, 3.0::DOUBLE * (SELECT min(k) FROM (SELECT unnest(range(1, 60)) AS k) AS ks WHERE (maxx - minx) / 3.0::DOUBLE * ((maxy - miny) / 3.0::DOUBLE) / (k * k) <= 100000) AS s FROM {boxes}"
_GRID_POINTS = f"""SELECT asdf_id, minx + i * s AS lon, miny + j * s AS lat FROM (SELECT *, unnest(range(60)) AS i FROM ({_STEP}) AS a) AS b, (SELECT unnest(range(60)) AS j) AS c WHERE minx + i * s < maxx AND miny + j * s < maxy"""


def samples(v: Views) -> DataFrame:
    boxes = v.boxes.select(F.col("asdf_id").alias("box_id"), row_box().alias("bbox"))
    return K.sample_grid(boxes, K.sample_step(F.col("bbox"), F.lit(GRID["px"])) * GRID["px"])


@query("trk_sample_grid", f"SELECT asdf_id AS box_id, round(lon, 6) AS lon, round(lat, 6) AS lat FROM ({_GRID_POINTS}) AS g")
def trk_sample_grid(v: Views) -> DataFrame:
    return samples(v).select("box_id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query(
    "trk_pixel_check",
    f"""SELECT box_id, n_samples, n_valid, n_distinct, CASE box_id % 3 WHEN 1 THEN n_valid >= 1 WHEN 2 THEN true ELSE n_valid >= 0.05 * n_samples END AS relevant FROM (SELECT asdf_id AS box_id, count(*) AS n_samples, count(category) AS n_valid, count(DISTINCT category) AS n_distinct
    FROM (SELECT asdf_id, floor((90 - lat) / 3)::INT AS r, floor((lon + 180) / 3)::INT AS c FROM ({_GRID_POINTS}) AS g) AS p LEFT JOIN (SELECT grid_row, grid_col, category FROM {{pixels}} WHERE resource = (SELECT max(resource) FROM {{pixels}}) AND value IS NOT NULL) AS x ON x.grid_row = r AND x.grid_col = c GROUP BY asdf_id) AS t""",
)
def trk_pixel_check(v: Views) -> DataFrame:
    newest = v.pixels.agg(F.max("resource").alias("resource"))
    pixels = v.pixels.join(newest, "resource", "left_semi").filter("value IS NOT NULL").select("grid_row", "grid_col", F.col("category").alias("value"))
    placed = samples(v).select("box_id", G.cell_of(F.col("lon"), F.col("lat"), **GRID).alias("c")).select("box_id", "c.grid_row", "c.grid_col")
    option = F.when(F.col("asdf_id") % 3 == 1, "any").when(F.col("asdf_id") % 3 == 2, "false")
    return K.pixel_check(placed, pixels, v.boxes.select(F.col("asdf_id").alias("box_id"), option.alias("pixel_check")))


_PAIRS = "SELECT 'g' || asdf_id AS grp, b.iso3, 'rel' || d AS dataset, CASE d WHEN 0 THEN 'global' ELSE 'regional' END AS release_scale, CASE d WHEN 1 THEN 'RG0|RG2' ELSE 'RG1' END AS isos, minx, miny, maxx, maxy FROM {boxes} b, (SELECT 0 AS d UNION ALL SELECT 1 UNION ALL SELECT 2) AS dd"


@query("trk_release_check", f"""SELECT grp AS "group", dataset, CASE WHEN release_scale = 'global' THEN EXISTS (SELECT 1 FROM {{locations}} l WHERE longitude BETWEEN minx AND maxx AND latitude BETWEEN miny AND maxy) ELSE list_contains(string_split(isos, '|'), iso3) END AS relevant FROM ({_PAIRS}) AS p""")
def trk_release_check(v: Views) -> DataFrame:
    releases = F.explode(F.array(*(F.struct(F.lit(f"rel{d}").alias("dataset"), F.lit("regional" if d else "global").alias("release_scale"), F.array(*map(F.lit, ("RG0", "RG2") if d == 1 else ("RG1",))).alias("release_iso3")) for d in range(3))))
    pairs = v.boxes.select(F.concat(F.lit("g"), F.col("asdf_id").cast("string")).alias("group"), "iso3", *G.SIDES, releases.alias("r")).select("group", "iso3", *G.SIDES, "r.*")
    return K.release_check(pairs, v.locations)


@query("trk_status", """SELECT dataset, type, CASE WHEN p_partkey % 23 = 0 OR active <> 1 OR p_partkey % 23 = 0 THEN -1 WHEN type NOT IN ('raster', 'release') THEN -2 WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS status FROM {catalog}""")
def trk_status(v: Views) -> DataFrame:
    df = v.catalog.select("dataset", "type", (F.col("p_partkey") % 2 == 0).alias("relevant"), (F.col("p_partkey") % 23 != 0).alias("known"), "active")
    return K.tracker_status(df).select("dataset", "type", "status")
