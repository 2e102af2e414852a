"""Queries of merging, the feature store and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomill.operators import merge as M
from geomill.operators import requests as Q
from geomill.operators import store as ST
from geomill.operators.zonal import zonal_many
from geomill.plans.q_zonal import METHOD_SQL, WEIGHTS_SQL, all_of, pixels, weights
from geomill.plans.registry import Views, query
from geomill.plans.views import NOW
from geomill.sources.tables import scratch

_FIELD = """SELECT o_orderkey, 'ds' || CAST(o_orderkey % 9 AS STRING) AS ds, CASE o_custkey % 3 WHEN 0 THEN '2001' WHEN 1 THEN 'none' ELSE 'a1b2c3d4e5f6' END AS temporal,
  CASE o_orderkey % 4 WHEN 0 THEN 'mean' WHEN 1 THEN 'categorical' WHEN 2 THEN 'encoded' ELSE 'reliability' END AS method, CASE o_custkey % 4 WHEN 0 THEN 'sum' WHEN 1 THEN 'potential' WHEN 2 THEN 'count' ELSE 'water' END AS part FROM {orders}"""


@query("mrg_field_name", f"SELECT o_orderkey, CASE WHEN method IN ('categorical', 'encoded') THEN ds || '.' || temporal || '.' || method || '_' || part WHEN method = 'reliability' THEN CASE WHEN part = 'sum' THEN ds || '.' || substr(temporal, 1, 7) || '.sum' END ELSE ds || '.' || temporal || '.' || method END AS field FROM ({_FIELD}) AS t")
def mrg_field_name(v: Views) -> DataFrame:
    df = v.spark.sql(_FIELD, orders=v.orders)
    return df.select("o_orderkey", M.field_name(F.col("ds"), F.col("temporal"), F.col("method"), F.col("part")).alias("field"))


_WIDE = [("ras_2000", "mean"), ("ras_2000", "sum"), ("ras_2001", "mean"), ("ras_2001", "max"), ("ras_2009", "mean")]


@query(
    "mrg_wide",
    f"""WITH w AS ({WEIGHTS_SQL}), z AS (SELECT resource, asdf_id, {", ".join(f'{METHOD_SQL[m]} AS "{m}"' for m in ("mean", "sum", "max"))} FROM {{pixels}} p JOIN w ON w.grid_row = p.grid_row AND w.grid_col = p.grid_col WHERE value IS NOT NULL GROUP BY resource, asdf_id)
    SELECT f.asdf_id, {", ".join(f"round(max(CASE WHEN resource = '{r}' THEN z.{m} END), 4) AS ras_{r[4:]}_{m}" for r, m in _WIDE)}, f.name, f.iso3 FROM {{features}} f LEFT JOIN z ON z.asdf_id = f.asdf_id GROUP BY f.asdf_id, f.name, f.iso3""",
)
def mrg_wide(v: Views) -> DataFrame:
    stats = zonal_many(pixels(v), weights(v), ("mean", "sum", "max"), **all_of(v))
    field = lambda m: F.concat(F.lit("ras."), F.substring("resource", 5, 4), F.lit(f".{m}"))
    long = stats.select("asdf_id", F.explode(F.array(*(F.struct(field(m).alias("field"), F.col(m).alias("value")) for m in ("mean", "sum", "max")))).alias("s")).select("asdf_id", "s.*")
    order = [f"ras.{r[4:]}.{m}" for r, m in _WIDE]
    merged = M.merge_extracts(long, v.features.select("asdf_id", "name", "iso3"), order)
    return merged.select("asdf_id", *(F.round(F.col(f"`{f}`"), 4).alias(f.replace(".", "_")) for f in order), "name", "iso3")


_JOBS = """SELECT 'job' || CAST(p_partkey % 20 AS STRING) AS job, 'ds' || CAST(p_partkey AS STRING) AS dataset, CASE WHEN p_partkey % 4 = 0 THEN 'npl_adm2_gadm28' END AS boundary, CASE WHEN p_partkey % 3 = 0 THEN 'mean|max' END AS extract_type,
  CASE WHEN p_size % 2 = 0 THEN '2000:2002|!2001' END AS years, 'tza_adm1_gadm28' AS default_boundary, 'sum' AS default_extract_type, '2003' AS default_years FROM {part} WHERE p_size % 5 <> 4"""


@query(
    "mrg_plan",
    f"""SELECT job, boundary, dataset, count(*) AS n_tasks, string_agg(item, '|' ORDER BY item) AS results FROM (SELECT job, coalesce(boundary, default_boundary) AS boundary, j.dataset, path || '.' || unnest(string_split(coalesce(extract_type, default_extract_type), '|')) AS item
    FROM ({_JOBS}) AS j JOIN {{files}} f ON f.dataset = j.dataset WHERE mask = 'None' OR CASE WHEN years IS NULL THEN file_year = 2003 ELSE file_year IN (2000, 2002) END) AS t GROUP BY 1, 2, 3""",
)
def mrg_plan(v: Views) -> DataFrame:
    files = v.files.select("dataset", "path", F.col("file_year").alias("year"))
    catalog = v.files.select("dataset", "mask").distinct()
    return M.plan_counts(M.merge_plan(v.spark.sql(_JOBS, part=v.part), catalog, files))


_SEEN = "SELECT sha1(CAST(o_custkey AS STRING)) AS hash, 'npl_adm' || CAST(o_orderkey % 3 AS STRING) || '_gadm28' AS boundary, CAST(max(o_orderkey) AS STRING) AS properties FROM {orders} WHERE o_orderkey % 2 = 0 GROUP BY 1, 2"
_ADDED = "SELECT sha1(CAST(o_custkey AS STRING)) AS hash, 'npl_adm' || CAST(o_orderkey % 4 AS STRING) || '_gadm28' AS boundary, 'new' || CAST(max(o_orderkey) AS STRING) AS properties FROM {orders} WHERE o_orderkey % 2 = 1 GROUP BY 1, 2"


@query(
    "ftr_upsert",
    f"""WITH b AS (SELECT hash, boundary, max_by(properties, age) AS properties FROM (SELECT *, 0 AS age FROM ({_SEEN}) AS s UNION ALL SELECT *, 1 FROM ({_ADDED}) AS a) AS u GROUP BY hash, boundary),
    t AS (SELECT DISTINCT hash, unnest(['npl', substr(boundary, 5, 4), 'gadm28', substr(boundary, 5, 4) || '_gadm28']) AS tag FROM b)
    SELECT hash, datasets, tags, properties FROM (SELECT hash, string_agg(boundary, '|' ORDER BY boundary) AS datasets, string_agg(boundary || '=' || properties, '|' ORDER BY boundary) AS properties FROM b GROUP BY hash) AS x JOIN (SELECT hash, string_agg(tag, '|' ORDER BY tag) AS tags FROM t GROUP BY hash) AS y USING (hash)""",
)
def ftr_upsert(v: Views) -> DataFrame:
    """Two batches merged into a store."""
    root = scratch(v.spark, "features")
    for batch in (_SEEN, _ADDED):
        ST.merge_features(root, v.spark.sql(batch, orders=v.orders))
    merged = ST.read_store(v.spark, root, ST.FEATURES)
    entries = F.array_sort(F.transform(F.map_entries("properties"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return merged.select("hash", F.array_join("datasets", "|").alias("datasets"), F.array_join("tags", "|").alias("tags"), F.array_join(entries, "|").alias("properties"))


_STORED = "SELECT 'h' || CAST(o_custkey % 500 AS STRING) AS hash, 'ds' || CAST(o_orderkey % 7 AS STRING) AS data, 'mean' AS method, '1.0' AS version, max(o_totalprice) AS value FROM {orders} WHERE o_orderkey % 3 = 0 GROUP BY 1, 2"
_FRESH = "SELECT 'h' || CAST(o_custkey % 600 AS STRING) AS hash, 'ds' || CAST(o_orderkey % 9 AS STRING) AS data, 'mean' AS method, '1.0' AS version, min(o_totalprice) AS value FROM {orders} WHERE o_orderkey % 3 = 1 GROUP BY 1, 2"


@query("ftr_extracts", f"SELECT coalesce(b.hash, a.hash) AS hash, coalesce(b.data, a.data) AS data, 'mean' AS method, '1.0' AS version, coalesce(b.value, a.value) AS value FROM ({_STORED}) AS a FULL JOIN ({_FRESH}) AS b ON a.hash = b.hash AND a.data = b.data")
def ftr_extracts(v: Views) -> DataFrame:
    """Two batches merged into a store."""
    root = scratch(v.spark, "feature-extracts")
    for batch in (_STORED, _FRESH):
        ST.merge_extracts(root, v.spark.sql(batch, orders=v.orders))
    return ST.read_store(v.spark, root, ST.EXTRACTS).drop("prefix")


LINES = 1_000_000  # line items that a task is given; dealt by their bytes, which are few, a task would get ten times as many


def request_rows(v: Views) -> DataFrame:
    """One request per order: a surface filter of its donor, and the files of its line items with one or two extract types."""
    tasks = max(v.spark.sparkContext.defaultParallelism, v.lineitem.count() // LINES)
    named = lambda part: F.concat(F.lit("ds"), part.cast("string"), F.lit("_2000"))
    parts = v.lineitem.repartition(tasks, "l_orderkey").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("parts"))
    files = parts.select("l_orderkey", F.sort_array(F.transform("parts", named)).alias("files"))
    types = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit("mean"), F.lit("max"))).otherwise(F.array(F.lit("sum")))
    donors = F.array(F.when(F.col("o_custkey") % 4 == 0, F.lit("All")).otherwise(F.concat(F.lit("Donor"), (F.col("o_custkey") % 4).cast("string"))))
    filters = F.create_map(F.lit("donors"), donors)
    release = F.array(F.struct(F.lit("aid").alias("dataset"), filters.alias("filters")))
    return v.orders.repartition(tasks, "o_orderkey").join(files, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("request_id"), F.concat(F.lit("b"), (F.col("o_custkey") % 25).cast("string")).alias("boundary"), release.alias("release_data"), F.array(F.struct("files", types.alias("extract_types"))).alias("raster_data")
    )


@query(
    "req_items",
    """WITH o AS (SELECT o_orderkey, o_custkey FROM {orders} WHERE o_orderkey IN (SELECT l_orderkey FROM {lineitem}))
    SELECT o_orderkey AS request_id, 'b' || (o_custkey % 25) AS boundary, 'surface' AS kind, 'aid_' || sha1('{"dataset": "aid", "filters": {' || CASE WHEN o_custkey % 4 = 0 THEN '' ELSE '"donors": ["Donor' || (o_custkey % 4) || '"]' END || '}, "resolution": 0.05, "type": "release", "version": 1.0}') AS data, 'reliability' AS extract_type, 0 AS nth FROM o
    UNION ALL SELECT o_orderkey, 'b' || (o_custkey % 25), 'raster', data, unnest(CASE WHEN o_orderkey % 2 = 0 THEN ['mean', 'max'] ELSE ['sum'] END), 0 FROM o JOIN (SELECT DISTINCT l_orderkey, 'ds' || l_partkey || '_2000' AS data FROM {lineitem}) AS l ON l_orderkey = o_orderkey""",
)
def req_items(v: Views) -> DataFrame:
    return Q.request_items(request_rows(v))


_ONE_WORK = "(SELECT boundary, data, extract_type, max_by(status, version) AS status FROM {work} GROUP BY 1, 2, 3)"
_STATED = f"""SELECT i.*, CASE WHEN status IS NULL THEN 'new' WHEN status IN (0, 2, 3) THEN 'waiting' WHEN status = 1 AND r.data IS NOT NULL THEN 'done' ELSE 'error' END AS state, CASE WHEN status = 1 AND r.data IS NULL THEN -1 ELSE status END AS new_status,
  CASE WHEN status IS NULL OR (status = 1 AND r.data IS NULL) THEN 'new' WHEN status IN (0, 2) THEN 'waiting' WHEN status = 1 THEN 'done' ELSE 'error' END AS surface_state
  FROM {{request_items}} i LEFT JOIN {_ONE_WORK} w ON w.boundary = i.boundary AND w.data = i.data AND w.extract_type = i.extract_type LEFT JOIN {{extract_results}} r ON r.boundary = i.boundary AND r.data = i.data AND r.extract_type = i.extract_type"""


def stated(v: Views) -> DataFrame:
    work = v.work.groupBy("boundary", "data", "extract_type").agg(F.max_by("status", "version").alias("status"))
    items, results = v.request_items, v.extract_results
    extracts = Q.cache_state(items, work, results)
    surfaces = Q.cache_state(items, work, results, "surface").select("request_id", *Q.ITEM, "kind", F.col("state").alias("surface_state"))
    return extracts.join(surfaces, ["request_id", *Q.ITEM, "kind"])


@query("req_cache", f"SELECT request_id, boundary, kind, data, extract_type, state, new_status, surface_state FROM ({_STATED}) AS s")
def req_cache(v: Views) -> DataFrame:
    return stated(v).select("request_id", "boundary", "kind", "data", "extract_type", "state", "new_status", "surface_state")


@query(
    "req_ready",
    f"""SELECT request_id, count(*) FILTER (kind = 'surface' AND final <> 'done') AS missing_surfaces, count(*) FILTER (final <> 'done') AS missing_extracts, count(*) FILTER (final <> 'done') = 0 AS ready,
    coalesce(string_agg(data || '.' || extract_type, '|' ORDER BY data || '.' || extract_type) FILTER (final = 'done'), '') AS results FROM (SELECT *, CASE WHEN kind = 'surface' THEN surface_state ELSE state END AS final FROM ({_STATED}) AS s) AS t GROUP BY request_id""",
)
def req_ready(v: Views) -> DataFrame:
    final = F.when(F.col("kind") == "surface", F.col("surface_state")).otherwise(F.col("state"))
    return Q.request_ready(stated(v).withColumn("state", final)).select("request_id", "missing_surfaces", "missing_extracts", "ready", "results")


_QUEUED = "(SELECT boundary, data, extract_type, max_by(status, version) AS status, max_by(priority, version) AS priority, max_by(attempts, version) AS attempts, max(submit_time) AS submit_time, max(update_time) AS update_time FROM {work} GROUP BY 1, 2, 3)"


@query(
    "req_enqueue",
    f"""SELECT coalesce(w.boundary, i.boundary) AS boundary, coalesce(w.data, i.data) AS data, coalesce(w.extract_type, i.extract_type) AS extract_type, coalesce(status, 0) AS status, CASE WHEN w.data IS NULL OR (i.data IS NOT NULL AND priority < 0) THEN 0 ELSE priority END AS priority,
    coalesce(attempts, 0) AS attempts, coalesce(submit_time, {NOW}) AS submit_time, CASE WHEN w.data IS NULL OR (i.data IS NOT NULL AND priority < 0) THEN {NOW} ELSE update_time END AS update_time
    FROM {_QUEUED} AS w FULL JOIN (SELECT DISTINCT boundary, data, extract_type FROM {{request_items}}) AS i ON w.boundary = i.boundary AND w.data = i.data AND w.extract_type = i.extract_type""",
)
def req_enqueue(v: Views) -> DataFrame:
    last = lambda c: F.max_by(c, "version").alias(c)
    work = v.work.groupBy(*Q.ITEM).agg(last("status"), last("priority"), last("attempts"), F.max("submit_time").alias("submit_time"), F.max("update_time").alias("update_time"))
    return Q.enqueue(v.request_items, work, NOW)


@query(
    "req_users",
    f"""SELECT email, n_requests, earliest_time, latest_time FROM (SELECT email, count(*) AS n_requests, sum(contact_flag) AS flags, min(complete_time) AS earliest_time, max(complete_time) AS latest_time FROM {{requests}} WHERE complete_time > {NOW} - 365 * 86400 GROUP BY email) AS u
    WHERE flags = 0 AND n_requests > 3 AND {NOW} - earliest_time > 14 * 86400 AND {NOW} - latest_time > 7 * 86400""",
)
def req_users(v: Views) -> DataFrame:
    return Q.active_users(v.requests, NOW).select("email", "n_requests", "earliest_time", "latest_time")
