"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomill.functions import geometry as G
from geomill.functions import text as T
from geomill.plans.registry import Views, query

_YEARS = """SELECT o_orderkey, y, CASE o_orderkey % 6 WHEN 0 THEN CAST(y AS STRING) WHEN 1 THEN '1992:' || CAST(y AS STRING) WHEN 2 THEN '1992:' || CAST(y AS STRING) || '|!' || CAST(y - 1 AS STRING)
  WHEN 3 THEN '2005:' || CAST(y AS STRING) WHEN 4 THEN '1990:2005|!1994:1996|' || CAST(y AS STRING) ELSE '!' || CAST(y AS STRING) || '|1999:2001|x' END AS years
  FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y FROM {orders}) AS o"""


@query(
    "fn_parse_years",
    f"""SELECT o_orderkey, years, len(l)::BIGINT AS n_years, array_to_string(l, '|') AS parsed FROM (SELECT o_orderkey, years, CASE o_orderkey % 6 WHEN 0 THEN [y] WHEN 1 THEN range(1992, y + 1)
    WHEN 2 THEN list_filter(range(1992, y + 1), lambda x: x <> y - 1) WHEN 3 THEN range(2005, y + 1) WHEN 4 THEN list_concat(list_filter(range(1990, 2006), lambda x: x < 1994 OR x > 1996), [y]) ELSE NULL END AS l FROM ({_YEARS}) AS t) AS u""",
)
def fn_parse_years(v: Views) -> DataFrame:
    df = v.spark.sql(_YEARS.replace("//", "div"), orders=v.orders).withColumn("l", T.parse_years(F.col("years"), strict=False))
    return df.select("o_orderkey", "years", F.when(F.col("l").isNotNull(), F.size("l").cast("long")).alias("n_years"), F.array_join("l", "|").alias("parsed"))


@query(
    "fn_mask_temporal",
    """SELECT dataset, path, CASE WHEN mask = 'None' THEN '' WHEN mask = 'ds_YYYY.tif' THEN CAST(file_year AS STRING) ELSE CAST(file_year AS STRING) || CAST(file_year AS STRING) END AS year,
    CASE WHEN mask LIKE '%MM%' THEN substr(path, 14, 2) ELSE '' END AS month, CASE WHEN mask LIKE '%DDD%' THEN substr(path, 14, 3) ELSE '' END AS day, CASE WHEN mask = 'None' THEN '' ELSE CAST(file_year AS STRING) END AS cut_year FROM {files}""",
)
def fn_mask_temporal(v: Views) -> DataFrame:
    parts = v.files.withColumn("p", T.mask_parts(F.col("path"), F.col("mask")))
    return parts.select("dataset", "path", "p.year", "p.month", "p.day", T.cut_parts(F.col("p"))["year"].alias("cut_year"))


@query(
    "fn_mask_kind",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'None' WHEN 1 THEN 'ds_YYYY.tif' WHEN 2 THEN 'YYYY/ds_YYYY_MM.tif' ELSE 'YYYY_MM_DDD' END AS mask, p_size % 2 = 0 AS one_file,
    CASE WHEN p_partkey % 4 = 0 AND p_size % 2 = 0 THEN 'invariant' WHEN p_partkey % 4 = 1 AND p_size % 2 = 1 THEN 'year' WHEN p_partkey % 4 = 2 AND p_size % 2 = 1 THEN 'year-month' END AS kind,
    CASE WHEN p_partkey % 4 = 3 THEN 'mask not understood' WHEN p_partkey % 4 = 0 AND p_size % 2 = 1 THEN 'a folder needs a temporal mask' WHEN p_partkey % 4 <> 0 AND p_size % 2 = 0 THEN 'one file takes no temporal mask' END AS problem FROM {part}""",
)
def fn_mask_kind(v: Views) -> DataFrame:
    n = F.col("p_partkey") % 4
    mask = F.when(n == 0, "None").when(n == 1, "ds_YYYY.tif").when(n == 2, "YYYY/ds_YYYY_MM.tif").otherwise("YYYY_MM_DDD")
    df = v.part.select("p_partkey", mask.alias("mask"), (F.col("p_size") % 2 == 0).alias("one_file"))
    return df.withColumn("k", T.mask_kind(F.col("mask"), F.col("one_file"))).select("p_partkey", "mask", "one_file", "k.kind", "k.problem")


_DATE_PARTS = """SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 THEN substr(y, 1, 3) ELSE y END AS y, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN m WHEN 2 THEN m ELSE '' END AS m,
  CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN CASE WHEN o_custkey % 5 = 0 THEN '7' ELSE d END ELSE CASE WHEN o_custkey % 5 = 0 THEN d ELSE '0' || d END END AS d
  FROM (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS STRING) AS y, lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS m, lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS d FROM {orders}) AS o"""


@query(
    "fn_valid_date",
    f"""SELECT o_orderkey, message IS NULL AS valid, message FROM (SELECT o_orderkey, CASE WHEN length(y) <> 4 THEN 'invalid year' WHEN m <> '' AND length(m) <> 2 THEN 'invalid month'
    WHEN m <> '' AND d <> '' AND length(d) <> 2 THEN 'invalid day of month' WHEN m = '' AND d <> '' AND length(d) <> 3 THEN 'invalid day of year' END AS message FROM ({_DATE_PARTS}) AS p) AS q""",
)
def fn_valid_date(v: Views) -> DataFrame:
    df = v.spark.sql(_DATE_PARTS, orders=v.orders).withColumn("r", T.validate_date(F.col("y"), F.col("m"), F.col("d")))
    return df.select("o_orderkey", "r.valid", "r.message")


_GOOD_DATES = """SELECT o_orderkey, CAST(o_custkey % 10 AS INT) AS drange, CAST(year(o_orderdate) AS STRING) AS y, CASE WHEN o_orderkey % 4 IN (1, 2) THEN lpad(CAST(month(o_orderdate) AS STRING), 2, '0') ELSE '' END AS m,
  CASE o_orderkey % 4 WHEN 2 THEN lpad(CAST(day(o_orderdate) AS STRING), 2, '0') WHEN 3 THEN lpad(CAST(1 + o_orderkey % 365 AS STRING), 3, '0') ELSE '' END AS d, CAST(o_orderdate AS DATE) AS od FROM {orders}"""


@query(
    "fn_date_range",
    f"""SELECT o_orderkey, CAST(strftime(a, '%Y%m%d') AS INT) AS "start", CAST(strftime(b, '%Y%m%d') AS INT) AS "end", kind AS type FROM (SELECT o_orderkey,
    CASE o_orderkey % 4 WHEN 0 THEN make_date(y::INT, 1, 1) WHEN 1 THEN make_date(y::INT, m::INT, 1) WHEN 2 THEN od ELSE make_date(y::INT, 1, 1) + (d::INT - 1) END AS a,
    CASE o_orderkey % 4 WHEN 0 THEN make_date(y::INT, 12, 31) WHEN 1 THEN last_day(od) WHEN 2 THEN od + drange ELSE make_date(y::INT, 1, 1) + (d::INT - 1 + drange) END AS b,
    CASE o_orderkey % 4 WHEN 0 THEN 'year' WHEN 1 THEN 'year month' WHEN 2 THEN 'year month day' ELSE 'year day' END AS kind FROM ({_GOOD_DATES}) AS g) AS h""",
)
def fn_date_range(v: Views) -> DataFrame:
    df = v.spark.sql(_GOOD_DATES, orders=v.orders).withColumn("r", T.date_range(F.col("y"), F.col("m"), F.col("d"), F.col("drange")))
    return df.select("o_orderkey", "r.start", "r.end", "r.type")


@query("fn_clean_name", """SELECT p_partkey, CASE WHEN length(c) >= 5 THEN c END AS clean FROM (SELECT p_partkey, lower(regexp_replace(replace(CASE WHEN p_partkey % 5 = 0 THEN substr(p_name, 1, 3) ELSE p_name || ' (' || p_brand || ')' END, ' ', '_'), '[^0-9a-zA-Z._-]', '', 'g')) AS c FROM {part}) AS t""")
def fn_clean_name(v: Views) -> DataFrame:
    raw = F.when(F.col("p_partkey") % 5 == 0, F.substring("p_name", 1, 3)).otherwise(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")))
    return v.part.select("p_partkey", T.clean_name(raw).alias("clean"))


@query("fn_category_key", """SELECT o_orderpriority AS label, regexp_replace(lower(o_orderpriority), '[^0-9a-z]', '_', 'g') AS category_key, count(*) AS n FROM {orders} GROUP BY o_orderpriority""")
def fn_category_key(v: Views) -> DataFrame:
    return v.orders.groupBy(F.col("o_orderpriority").alias("label")).agg(F.count("*").alias("n")).withColumn("category_key", T.category_key(F.col("label")))


_PREAMBLE = "CASE p_partkey % 3 WHEN 0 THEN 'NigeriaAIMS' WHEN 1 THEN 'WorldBank' ELSE 'GlobalEnvironmentFacility' END"


@query(
    "fn_release_identity",
    f"""SELECT p_partkey, lower({_PREAMBLE}) || '_' || lower('GeocodedResearchRelease') || '_' || 'level1' || '_v' || replace(CAST(p_size AS STRING) || '.' || CAST(p_partkey % 9 AS STRING), '.', '_') AS name,
    CASE p_partkey % 3 WHEN 0 THEN 'Nigeria' WHEN 1 THEN 'World Bank' ELSE 'Global Environment Facility' END AS title_words FROM {{part}}""",
)
def fn_release_identity(v: Views) -> DataFrame:
    version = F.concat_ws(".", F.col("p_size").cast("string"), (F.col("p_partkey") % 9).cast("string"))
    r = T.release_identity(F.expr(_PREAMBLE), F.lit("GeocodedResearchRelease"), F.lit("Level1"), version)
    return v.part.select("p_partkey", r.alias("r")).select("p_partkey", "r.name", "r.title_words")


_FOLDERS = """SELECT p_partkey, 'RG' || CAST(p_partkey % 7 AS STRING) || '_ADM' || CAST(p_size % 4 AS STRING) AS folder, CASE WHEN p_partkey % 2 = 0 THEN 'gadm' ELSE 'gb' END AS source, CASE WHEN p_partkey % 2 = 0 THEN '2.8' ELSE '1_3_1' END AS version FROM {part}"""


@query(
    "fn_boundary_name",
    f"""SELECT p_partkey, f.iso3, adm, lower(f.iso3) || '_adm' || adm || '_' || tail AS name, lower(f.iso3) || '_' || tail AS "group", CASE WHEN adm = 0 THEN 'actual' ELSE 'sub' END AS group_class,
    CASE WHEN adm = 0 THEN -1 ELSE 1 END AS active, country FROM (SELECT p_partkey, substr(folder, 1, 3) AS iso3, CAST(substr(folder, 8, 1) AS INT) AS adm, CASE WHEN source = 'gadm' THEN 'gadm28' ELSE 'gb_1_3_1' END AS tail FROM ({_FOLDERS}) AS t) AS f LEFT JOIN {{adm0}} USING (iso3)""",
)
def fn_boundary_name(v: Views) -> DataFrame:
    named = T.boundary_identity(v.spark.sql(_FOLDERS, part=v.part), v.adm0)
    return named.select("p_partkey", "iso3", "adm", "name", "group", "group_class", "active", "country")


_DATA = "CASE p_partkey % 4 WHEN 0 THEN 'ds' || CAST(p_partkey AS STRING) || '_' || CAST(2000 + p_size AS STRING) WHEN 1 THEN 'ds_main_none' WHEN 2 THEN 'aid_' || CAST(p_partkey AS STRING) || '_a1b2c3' ELSE 'plain' END"


@query(
    "fn_data_name_split",
    f"""SELECT p_partkey, {_DATA} AS data, CASE p_partkey % 4 WHEN 0 THEN 'ds' || CAST(p_partkey AS STRING) WHEN 1 THEN 'ds_main_none' WHEN 2 THEN 'aid_' || CAST(p_partkey AS STRING) ELSE 'plain' END AS dataset,
    CASE p_partkey % 4 WHEN 0 THEN CAST(2000 + p_size AS STRING) WHEN 2 THEN 'a1b2c3' ELSE 'na' END AS temporal FROM {{part}}""",
)
def fn_data_name_split(v: Views) -> DataFrame:
    kind = F.when(F.col("p_partkey") % 4 == 2, "msr").otherwise("raster")
    df = v.part.select("p_partkey", F.expr(_DATA).alias("data"), kind.alias("kind"))
    return df.withColumn("r", T.split_data_name(F.col("data"), F.col("kind"))).select("p_partkey", "data", "r.dataset", "r.temporal")


@query(
    "fn_request_hash",
    """SELECT project_id, sha1('{"dataset": "aid", "filters": {"ad_sector_names": ["' || replace(ad_sector_names, '|', '", "') || '"], "donors": ["' || replace(donors, '|', '", "') || '"]}, "resolution": 0.05, "type": "release", "version": 1.0}') AS request_hash FROM {projects}""",
)
def fn_request_hash(v: Views) -> DataFrame:
    filters = F.create_map(F.lit("donors"), T.pipe_split(F.col("donors")), F.lit("ad_sector_names"), T.pipe_split(F.col("ad_sector_names")))
    return v.projects.select("project_id", T.request_hash(F.lit("aid"), filters, F.lit(0.05), F.lit("release"), F.lit(1.0)).alias("request_hash"))


_WHOLE = "round({} * 1000000)::BIGINT"
_TURNED_SQL = " || ',' || ".join(f"{_WHOLE.format(x)} || ' ' || {_WHOLE.format(y)}" for x, y in (("minx", "miny"), ("minx", "maxy"), ("maxx", "maxy"), ("maxx", "miny")))


@query("fn_geom_hash", f"""SELECT asdf_id, sha1({_TURNED_SQL}) AS geom_hash FROM {{boxes}}""")
def fn_geom_hash(v: Views) -> DataFrame:
    """Boxes that begin at any of their corners, every other one the other way round."""
    ring = G.polygon_of_box(G.box(*(F.col(s) for s in G.SIDES)))[0][0]
    open_, n = F.slice(ring, 1, 4), (F.col("asdf_id") % 4).cast("int")
    begun = F.concat(F.slice(open_, n + 1, 4), F.slice(open_, F.lit(1), n + 1))
    return v.boxes.select("asdf_id", G.geometry_hash(F.array(F.array(F.when(F.col("asdf_id") % 2 == 0, begun).otherwise(F.reverse(begun))))).alias("geom_hash"))


@query("fn_pipe_list", """SELECT DISTINCT unnest(string_split(ad_sector_names, '|')) AS token FROM {projects}""")
def fn_pipe_list(v: Views) -> DataFrame:
    return T.distinct_tokens(v.projects, "ad_sector_names")


@query(
    "fn_clean_filters",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 OR o_custkey % 5 = 0 THEN CASE WHEN o_orderkey % 7 = 0 OR o_custkey % 5 = 0 THEN '' ELSE 'years' END ELSE CASE WHEN o_orderkey % 7 = 0 THEN 'donors' ELSE 'donors|years' END END AS fields FROM
    (SELECT o_orderkey, o_custkey * (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 1 END) AS o_custkey FROM {orders}) AS o""",
)
def fn_clean_filters(v: Views) -> DataFrame:
    spoilt = (F.col("o_orderkey") % 2 == 0) & (F.col("o_custkey") % 5 == 0)
    donors = F.array(F.when((F.col("o_orderkey") % 3 == 0) | spoilt, F.lit("All")).otherwise("Donor1"), F.lit("Donor2"))
    years = F.array(F.lit("2000"), F.when(spoilt, F.lit(None)).when(F.col("o_orderkey") % 7 == 0, "None").otherwise("2001"))
    kept = T.clean_filters(F.create_map(F.lit("donors"), donors, F.lit("years"), years))
    return v.orders.select("o_orderkey", F.array_join(F.array_sort(F.map_keys(kept)), "|").alias("fields"))


_TAGGED = """SELECT p_partkey, 'ds' || CAST(p_partkey AS STRING) AS name, CASE WHEN p_partkey % 2 = 0 THEN 'land|featured' ELSE 'land' END AS tag_text, CASE p_size % 5 WHEN 0 THEN 2 WHEN 1 THEN -1 WHEN 2 THEN 0 ELSE 1 END AS active FROM {part}"""


@query(
    "fn_tag_sync",
    f"""SELECT name, CASE WHEN p_partkey % 3 = 0 THEN 'land|featured' ELSE 'land' END AS tags, CASE WHEN active IN (0, 1) THEN CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 1 END ELSE active END AS active FROM ({_TAGGED}) AS t""",
)
def fn_tag_sync(v: Views) -> DataFrame:
    rows = v.spark.sql(_TAGGED, part=v.part).withColumn("tags", T.pipe_split(F.col("tag_text")))
    featured, inactive = rows.filter("p_partkey % 3 = 0").select("name"), rows.filter("p_partkey % 5 = 0").select("name")
    done = T.sync_active(T.sync_tag(rows, featured), inactive)
    return done.select("name", F.array_join("tags", "|").alias("tags"), "active")
