"""Queries of readers and writers: data derived from the tables is written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomill.functions.geometry import polygons_box
from geomill.operators.surface import build_surface
from geomill.operators.zonal import zonal_many
from geomill.plans.q_geometry import shapes
from geomill.plans.q_release import _CELLS, money, surface_cells
from geomill.plans.q_zonal import METHOD_SQL, WEIGHTS_SQL, all_of, pixels, weights
from geomill.plans.registry import Views, query
from geomill.plans.views import GRID
from geomill.sources import sinks
from geomill.sources import tables as T

_QUOTED = "SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'NA' WHEN 1 THEN NULL WHEN 2 THEN p_name || ', \"' || p_brand || '\"' ELSE p_name END AS label, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END AS amount FROM {part}"


@query("src_table_csv", _QUOTED)
def src_table_csv(v: Views) -> DataFrame:
    path = T.scratch(v.spark, "table") + ".tsv"
    v.spark.sql(_QUOTED, part=v.part).write.options(header=True, sep="\t", quote='"', escape='"', nullValue="").csv(path)
    return T.read_table(v.spark, path, "id long, label string, amount double")


SCHEMAS = {
    "projects": "project_id long, total_commitments double, total_disbursements double, is_geocoded int, transactions_start_year int, transactions_end_year int, donors string, ad_sector_names string",
    "locations": "project_id long, project_location_id long, longitude double, latitude double, location_class string, location_type_code string, geographic_exactness string, recipients_iso3 string",
    "transactions": "project_id long, transaction_year int, transaction_value double",
}


@query("src_release", "SELECT project_id, total_commitments, n_locations, n_transactions FROM {projects} LEFT JOIN (SELECT project_id, count(*) AS n_locations FROM {locations} GROUP BY 1) AS l USING (project_id) LEFT JOIN (SELECT project_id, count(*) AS n_transactions FROM {transactions} GROUP BY 1) AS t USING (project_id)")
def src_release(v: Views) -> DataFrame:
    base = T.scratch(v.spark, "release")
    for name in SCHEMAS:
        getattr(v, name).write.options(header=True, nullValue="", escape='"').csv(f"{base}/{name}.csv")
    r = T.read_release(v.spark, base, SCHEMAS)
    count = lambda name: r[name].groupBy("project_id").agg(F.count("*").alias(f"n_{name}"))
    return r["projects"].join(count("locations"), "project_id", "left").join(count("transactions"), "project_id", "left").select("project_id", "total_commitments", "n_locations", "n_transactions")


@query("src_features", "SELECT asdf_id, name, iso3, round(minx, 6) AS minx, round(maxy, 6) AS maxy, (SELECT count(*) FROM {shape_corners} c WHERE c.asdf_id = b.asdf_id) AS n_points FROM (SELECT asdf_id, min(x) AS minx, max(y) AS maxy FROM {shape_corners} GROUP BY asdf_id) AS b JOIN (SELECT asdf_id, name, iso3 FROM {boxes}) AS n USING (asdf_id)")
def src_features(v: Views) -> DataFrame:
    """Polygons with holes and parts, written as GeoJSON a feature a line and read back."""
    path = T.scratch(v.spark, "features")
    props = F.create_map(F.lit("name"), F.col("name"), F.lit("iso3"), F.col("iso3"))
    T.write_feature_lines(shapes(v).join(v.boxes.select("asdf_id", props.alias("properties")), "asdf_id"), path)
    read = T.read_feature_lines(v.spark, path).withColumn("b", polygons_box(F.col("polygons")))
    return read.select("asdf_id", F.col("properties.name").alias("name"), F.col("properties.iso3").alias("iso3"), F.round("b.minx", 6).alias("minx"), F.round("b.maxy", 6).alias("maxy"), F.size(F.flatten(F.flatten("polygons"))).cast("long").alias("n_points"))


@query("src_ascii_grid", "SELECT g.resource, CAST(r AS INT) AS grid_row, CAST(c AS INT) AS grid_col, value, -180.0::DOUBLE AS minx, 90.0::DOUBLE AS maxy, 60 AS nrows, 120 AS ncols FROM {grids} AS g CROSS JOIN (SELECT unnest(range(60)) AS r) AS rr CROSS JOIN (SELECT unnest(range(120)) AS c) AS cc LEFT JOIN {pixels} AS p ON p.resource = g.resource AND p.grid_row = r AND p.grid_col = c")
def src_ascii_grid(v: Views) -> DataFrame:
    """All rasters, a file each."""
    path = T.scratch(v.spark, "grids")
    T.write_ascii_grids(v.pixels, path, **GRID)
    return T.read_ascii_grid(v.spark, path).select(F.regexp_extract("path", "resource=([^/]+)", 1).alias("resource"), "grid_row", "grid_col", "value", "minx", "maxy", "nrows", "ncols")


@query("src_resource_scan", "SELECT 'resource=' || resource AS folder, 1::BIGINT AS n_files, true AS has_bytes FROM {grids}")
def src_resource_scan(v: Views) -> DataFrame:
    """One file per raster of the pixel table, found below its folder."""
    base = T.scratch(v.spark, "rasters")
    v.pixels.select("resource", "grid_row", "grid_col", "value").repartition("resource").write.partitionBy("resource").parquet(base)
    files = T.scan_resources(v.spark, base, ".parquet", "resource=ras_YYYY")
    return files.groupBy(F.substring_index("path", "/", 1).alias("folder")).agg(F.count("*").alias("n_files"), (F.min("bytes") > 0).alias("has_bytes"))


def _extracts(v: Views) -> DataFrame:
    stats = zonal_many(pixels(v), weights(v), ("mean", "max"), **all_of(v))
    return stats.select("resource", "asdf_id", F.round("mean", 4).alias("mean"), "max")


@query(
    "snk_extract_csv",
    f"""WITH w AS ({WEIGHTS_SQL}), z AS (SELECT resource, asdf_id, {METHOD_SQL["mean"]} AS mean FROM {{pixels}} p JOIN w ON w.grid_row = p.grid_row AND w.grid_col = p.grid_col WHERE value IS NOT NULL GROUP BY resource, asdf_id)
    SELECT r.resource, f.asdf_id, mean IS NULL AS is_na, mean FROM {{grids}} AS r CROSS JOIN {{features}} AS f LEFT JOIN z ON z.resource = r.resource AND z.asdf_id = f.asdf_id""",
)
def snk_extract_csv(v: Views) -> DataFrame:
    path = T.scratch(v.spark, "extract")
    sinks.write_extract_csv(_extracts(v), path)
    read = v.spark.read.schema("resource string, asdf_id long, mean string, max string").option("header", True).csv(path)
    return read.select("resource", "asdf_id", (F.col("mean") == "NA").alias("is_na"), F.expr("try_cast(mean AS double)").alias("mean"))


@query(
    "snk_extract_parquet",
    f"""WITH w AS ({WEIGHTS_SQL}), z AS (SELECT resource, asdf_id, max(value) AS value FROM {{pixels}} p JOIN w ON w.grid_row = p.grid_row AND w.grid_col = p.grid_col WHERE value IS NOT NULL GROUP BY resource, asdf_id)
    SELECT 'world_adm1_v1' AS boundary, 'ras' AS dataset, resource[5:]::INT AS temporal, 'max' AS method, asdf_id, value FROM z""",
)
def snk_extract_parquet(v: Views) -> DataFrame:
    path = T.scratch(v.spark, "extracts")
    long = _extracts(v).filter("max IS NOT NULL").select(F.lit("world_adm1_v1").alias("boundary"), F.lit("ras").alias("dataset"), F.substring_index("resource", "_", -1).alias("temporal"), F.lit("max").alias("method"), "asdf_id", F.col("max").alias("value"))
    sinks.write_extracts(long, path)
    return v.spark.read.parquet(path).select("boundary", "dataset", "temporal", "method", "asdf_id", "value")


@query("snk_surface", f"{_CELLS} SELECT (SELECT count(*)::INT FROM (SELECT DISTINCT grid_row, grid_col FROM spread) AS d) AS n_cells, (SELECT round(sum(value), 0) FROM spread) AS total, (SELECT sum(n)::BIGINT FROM money) AS n_locations, 'aid' AS dataset, 3.0::DOUBLE AS pixel_size")
def snk_surface(v: Views) -> DataFrame:
    """The surface, its locations and its summary, written and read back as one row."""
    path = T.scratch(v.spark, "surface")
    located = T.staged(money(v), "located-money")
    summary = located.agg(F.count("*").alias("location_count")).select(F.lit("aid").alias("dataset"), F.lit(GRID["px"]).alias("pixel_size"), F.lit(GRID["nrows"]).alias("nrows"), F.lit(GRID["ncols"]).alias("ncols"), "location_count", F.lit("{}").alias("filters"))
    sinks.write_surface(build_surface(located, surface_cells(v, located)), located, summary, path)
    cells = v.spark.read.parquet(f"{path}/cells").agg(F.count("*").cast("int").alias("n_cells"), F.round(F.sum("value"), 0).alias("total"))
    places = v.spark.read.option("header", True).csv(f"{path}/locations").agg(F.count("*").alias("n_locations"))
    kept = v.spark.read.schema("dataset string, pixel_size double").json(f"{path}/summary")
    return cells.crossJoin(places).crossJoin(kept).select("n_cells", "total", "n_locations", "dataset", "pixel_size")  # one row each
