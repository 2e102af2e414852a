"""Queries of work lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomill.operators import work as W
from geomill.plans.registry import Views, query

KEYS = "boundary, data, extract_type, version"


def boundaries(v: Views) -> DataFrame:
    """25 boundaries in 10 groups, one in five an adm0."""
    top = F.col("n_nationkey") % 5 == 0
    return v.nation.select(F.concat(F.lit("b"), F.col("n_nationkey").cast("string")).alias("boundary"), F.concat(F.lit("g"), (F.col("n_nationkey") % 10).cast("string")).alias("group"), F.when(top, "actual").otherwise("sub").alias("group_class"), F.when(top, -1).otherwise(1).alias("active"))


_WANTED = """SELECT 'b' || n_nationkey AS boundary, f.path AS data, unnest(string_split(c.extract_types, '|')) AS extract_type, '2.0' AS version FROM {nation} JOIN {catalog} c ON (c.p_partkey + n_nationkey % 10) % 30 = 0 AND c.active = 1 AND c.type = 'raster' JOIN {files} f ON f.dataset = c.dataset WHERE n_nationkey % 5 <> 0"""


@query("wrk_expand", _WANTED)
def wrk_expand(v: Views) -> DataFrame:
    related = v.catalog.filter("type = 'raster'").select("dataset", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("g"), "p_partkey").filter("(p_partkey + g) % 30 = 0")
    tracker = related.select(F.concat(F.lit("g"), F.col("g").cast("string")).alias("group"), "dataset", F.lit(1).alias("status"))
    resources = v.files.select("dataset", F.col("path").alias("name"))
    return W.expand_work(boundaries(v), tracker, v.catalog.select("dataset", "extract_types", "active"), resources, "2.0")


_ASKED = "SELECT 'b' || CAST(l_partkey % 25 AS STRING) AS boundary, 'ds' || CAST(l_orderkey % 200 AS STRING) AS data, CASE l_linenumber % 3 WHEN 0 THEN 'mean' WHEN 1 THEN 'max' ELSE 'sum' END AS extract_type, CASE WHEN l_suppkey % 3 = 0 THEN '1.0' ELSE '2.0' END AS version FROM {lineitem}"


@query("wrk_missing", f"SELECT DISTINCT {KEYS} FROM ({_ASKED}) AS a WHERE NOT EXISTS (SELECT 1 FROM {{work}} w WHERE w.boundary = a.boundary AND w.data = a.data AND w.extract_type = a.extract_type AND w.version = a.version)")
def wrk_missing(v: Views) -> DataFrame:
    return W.missing_work(v.spark.sql(_ASKED, lineitem=v.lineitem), v.work)


@query("wrk_stale", f"SELECT {KEYS}, status, priority FROM {{work}} WHERE NOT (status = 0 AND priority = -1 AND (boundary IN ('b20', 'b21', 'b22', 'b23', 'b24') OR substr(data, 3)::INT >= 150 OR version <> '2.0'))")
def wrk_stale(v: Views) -> DataFrame:
    known = v.nation.filter("n_nationkey < 20").select(F.concat(F.lit("b"), F.col("n_nationkey").cast("string")).alias("boundary"))
    datasets = v.part.filter("p_partkey < 150").select(F.concat(F.lit("ds"), F.col("p_partkey").cast("string")).alias("data"))
    return W.drop_stale(v.work, known, datasets, "2.0").select(*KEYS.split(", "), "status", "priority")


@query("wrk_top", f"SELECT {KEYS}, priority, submit_time FROM {{work}} WHERE status = 0 AND classification = 'auto-external' AND attempts BETWEEN 0 AND 19 ORDER BY priority DESC, submit_time, {KEYS} LIMIT 500")
def wrk_top(v: Views) -> DataFrame:
    return W.next_work(v.work, 500, "auto-external", (0, 19)).select(*KEYS.split(", "), "priority", "submit_time")


_TRIAGE_NOW = 883612800 + 1500  # shortly after 1998-01-01


@query(
    "wrk_triage",
    f"""SELECT {KEYS}, CASE WHEN status = -1 OR (status = 2 AND {_TRIAGE_NOW} - update_time > 1200) THEN CASE WHEN attempts >= 20 THEN -2 ELSE 0 END ELSE status END AS new_status,
    CASE WHEN status = -1 THEN CASE WHEN attempts >= 5 THEN -2 ELSE 0 END ELSE status END AS surface_status, CASE WHEN status = -1 AND attempts < 5 THEN attempts + 1 ELSE attempts END AS surface_attempts FROM {{work}}""",
)
def wrk_triage(v: Views) -> DataFrame:
    key = KEYS.split(", ")
    surfaces = W.triage_surfaces(v.work).select(*key, F.col("new_status").alias("surface_status"), F.col("new_attempts").alias("surface_attempts"))
    return W.triage(v.work, _TRIAGE_NOW).select(*key, "new_status").join(surfaces, key)


@query("wrk_backlog", "SELECT classification, CASE WHEN attempts < 5 THEN 'low' ELSE 'high' END AS band, count(*) FILTER (status = 0) AS waiting, count(*) FILTER (status = -1) AS failed, count(*) FILTER (status = 2) AS running, count(*) AS total FROM {work} WHERE attempts < 20 AND status IN (0, -1, 2) GROUP BY 1, 2")
def wrk_backlog(v: Views) -> DataFrame:
    return W.backlog(v.work)


_ROWS = "SELECT 'b' || CAST(o_custkey % 25 AS STRING) AS boundary, 'ds' || CAST(o_orderkey % 10 AS STRING) AS data, 'mean' AS extract_type, o_orderkey % 977 AS asdf_id FROM {orders}"


@query(
    "wrk_complete",
    f"""SELECT r.boundary, data, extract_type, n_rows, coalesce(n_features, 0) AS n_features FROM (SELECT boundary, data, extract_type, count(*) AS n_rows FROM ({_ROWS}) AS t GROUP BY 1, 2, 3) AS r
    LEFT JOIN (SELECT 'b' || CAST(c_nationkey AS STRING) AS boundary, count(*) AS n_features FROM {{customer}} GROUP BY 1) AS f ON f.boundary = r.boundary WHERE n_rows <> coalesce(n_features, 0)""",
)
def wrk_complete(v: Views) -> DataFrame:
    features = v.customer.select(F.concat(F.lit("b"), F.col("c_nationkey").cast("string")).alias("boundary"), F.col("c_custkey").alias("asdf_id"))
    return W.incomplete(v.spark.sql(_ROWS, orders=v.orders), features)


