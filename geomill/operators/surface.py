"""Mean surface rasters: locations get geometries, geometries get cells, money is spread over cells and summed."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomill.functions.geometry import cell_of, centroid, geometry_text
from geomill.functions.text import distinct_tokens, pipe_split
from geomill.operators.outline import point_in_polygon, touching
from geomill.operators.rasterize import buffer_m, clip_buffers, rasterize
from geomill.sources.tables import staged

# Location class -> location type -> (geometry, data) for geographic exactness 1 and 2.
GEOMETRY_CODES = [
    ("1", "default", "buffer", 25000), ("1", "PCLI", "adm", 0), ("1", "ADM1", "adm", 1), ("1", "ADM2", "adm", 2), ("1", "ADM3", "adm", 3), ("1", "ADM4", "adm", 4), ("1", "ADM5", "adm", 5),
    ("2", "default", "buffer", 5000), ("2", "PPL", "buffer", 5000), ("2", "PPLA", "buffer", 5000), ("2", "PPLC", "buffer", 5000), ("2", "PPLX", "buffer", 5000), ("2", "PPLL", "buffer", 5000), ("2", "PPLF", "buffer", 5000), ("2", "PPLA3", "buffer", 5000), ("2", "PPLA4", "buffer", 5000),
    ("3", "default", "buffer", 1000),
    ("4", "default", "buffer", 25000),
]
FALLBACK_METRES = 25000


def geometry_lookup(spark: SparkSession) -> DataFrame:
    rows = [(a, b, c, kind, data) for a, b, kind, data in GEOMETRY_CODES for c in ("1", "2")]
    return spark.createDataFrame(rows, "code_1 string, code_2 string, code_3 string, geom_type string, data int")


def assign_geom_type(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """geom_type and geom_data by class, type and exactness. Not geocoded, an unknown class or exactness: null; an unknown type: the
    class's default. The lookup is a fixed table of a few dozen rows."""
    exact = F.broadcast(lookup.select(F.col("code_1").alias("_a"), F.col("code_2").alias("_b"), F.col("code_3").alias("_c"), F.col("geom_type").alias("_t"), F.col("data").alias("_d")))
    other = F.broadcast(lookup.filter("code_2 = 'default'").select(F.col("code_1").alias("_e"), F.col("code_3").alias("_f"), F.col("geom_type").alias("_u"), F.col("data").alias("_v")))
    known = F.broadcast(lookup.select(F.col("code_1").alias("_g"), F.col("code_2").alias("_h")).distinct())
    one, two, three = (F.col(c).cast("string") for c in ("location_class", "location_type_code", "geographic_exactness"))
    out = df.join(exact, (one == F.col("_a")) & (two == F.col("_b")) & (three == F.col("_c")), "left")
    out = out.join(other, (one == F.col("_e")) & (three == F.col("_f")), "left").join(known, (one == F.col("_g")) & (two == F.col("_h")), "left")
    geocoded = F.col("is_geocoded") == 1
    pick = lambda a, b: F.when(geocoded, F.when(F.col("_g").isNotNull(), F.col(a)).otherwise(F.col(b)))
    return out.withColumn("geom_type", pick("_t", "_u")).withColumn("geom_data", pick("_d", "_v")).drop(*(f"_{c}" for c in "abcdefghtduv"))


def adm_lookup(points: DataFrame, areas: DataFrame) -> DataFrame:
    """points (iso3, level, lon, lat, ...) with adm_id: the area (asdf_id, iso3, level, polygons) of their country and level that holds
    them, the smallest id of several, null of none. Distinct places are tested once."""
    places = points.select("iso3", "level", "lon", "lat").filter("level IS NOT NULL").distinct()
    held = point_in_polygon(places, areas.select("asdf_id", "iso3", "level", "polygons"), on=("iso3", "level"))
    first = held.groupBy("iso3", "level", "lon", "lat").agg(F.min("asdf_id").alias("adm_id"))
    return points.join(first, ["iso3", "level", "lon", "lat"], "left")


def assign_geometry(df: DataFrame, countries: DataFrame, areas: DataFrame, grid: dict, strict: bool = False) -> DataFrame:
    """geom_kind, geom_key and geom_metres per location (location_id, iso3, lon, lat, geom_type, geom_data).

    point and buffer stand for the place; adm 0 is the country; adm 1 to 5 is the area of that level that holds the
    place. Without an area: adm 1 becomes the country, deeper ones a clipped 25 km buffer, unless `strict`, which drops the
    geometry. Outside the grid, without a country, or with an iso3 not of 3 letters: none.
    """
    adm = F.col("geom_type") == "adm"
    found = adm_lookup(df.withColumn("level", F.when(adm & (F.col("geom_data") >= 1), F.col("geom_data"))), areas).drop("level")
    known = countries.select("iso3", F.lit(True).alias("_country")).distinct()
    out = found.join(known, "iso3", "left")
    inside = cell_of(F.col("lon"), F.col("lat"), **grid)["inside"]
    usable = inside & F.col("_country").isNotNull() & (F.length("iso3") == 3)
    deep = F.col("geom_data") >= 2
    place = F.concat_ws(":", F.col("lon").cast("string"), F.col("lat").cast("string"))
    kind = (
        F.when(~usable | F.col("geom_type").isNull(), None)
        .when(F.col("geom_type") == "point", "point")
        .when(F.col("geom_type") == "buffer", "buffer")
        .when(adm & (F.col("geom_data") == 0), "country")
        .when(adm & F.col("adm_id").isNotNull(), "area")
    )
    if not strict:
        kind = kind.when(adm & ~deep, "country").when(adm & deep, "buffer")
    out = out.withColumn("geom_kind", kind)
    metres = F.when(F.col("geom_kind") == "buffer", F.when(F.col("geom_type") == "buffer", F.col("geom_data")).otherwise(FALLBACK_METRES))
    key = F.when(F.col("geom_kind") == "country", F.col("iso3")).when(F.col("geom_kind") == "area", F.col("adm_id").cast("string")).when(F.col("geom_kind").isNotNull(), place)
    return out.withColumn("geom_metres", metres).withColumn("geom_key", key).drop("_country")


def geometry_name(df: DataFrame) -> DataFrame:
    """df (geom_kind, geom_key, geom_metres, iso3) with `geom`, the same for the same geometry; null without one."""
    parts = F.concat_ws("|", "geom_kind", "geom_key", F.col("geom_metres").cast("string"), F.when(F.col("geom_kind") == "buffer", F.col("iso3")))
    return df.withColumn("geom", F.when(F.col("geom_kind").isNotNull(), parts))


def geometry_cells(df: DataFrame, countries: DataFrame, areas: DataFrame, grid: dict, scale: int = 10) -> DataFrame:
    """geom, grid_row, grid_col, cover (in sub-cells, of scale * scale) of every distinct geometry of df (geom, geom_kind, geom_key,
    geom_metres, iso3, lon, lat), made once however many locations have it.

    A point is its cell. A buffer is the sub-cells whose centres lie in the circle and in the country (`clip_buffers`); areas and countries
    are rasterised. A geometry without a sub-cell centre is the cell of its centroid (a buffer's is its place, if in the country)."""
    own = df.filter("geom IS NOT NULL").select("geom", "geom_kind", "geom_key", "geom_metres", "iso3", "lon", "lat").dropDuplicates(["geom"])
    whole = scale * scale

    def at(x: Column, y: Column) -> list[Column]:
        cell = cell_of(x, y, **grid)
        return [cell["grid_row"].alias("grid_row"), cell["grid_col"].alias("grid_col"), F.lit(whole).cast("long").alias("cover")]

    points = own.filter("geom_kind = 'point'").select("geom", *at(F.col("lon"), F.col("lat")))
    shapes = own.filter("geom_kind = 'country'").join(countries.select(F.col("iso3").alias("geom_key"), "polygons"), "geom_key").select("geom", "polygons")
    shapes = shapes.unionByName(own.filter("geom_kind = 'area'").join(areas.select(F.col("asdf_id").cast("string").alias("geom_key"), "polygons"), "geom_key").select("geom", "polygons"))
    shapes = staged(shapes, "shapes")
    covered = staged(rasterize(shapes, **grid, scale=scale, key="geom"), "shape-cells")
    bare = shapes.join(covered.select("geom").distinct(), "geom", "left_anti").withColumn("c", centroid(F.col("polygons"))).select("geom", *at(F.col("c.x"), F.col("c.y")))

    buffers = staged(own.filter("geom_kind = 'buffer'").select("geom", "iso3", "lon", "lat", F.col("geom_metres").alias("metres")), "buffers")
    circles = clip_buffers(buffers, countries, **grid, scale=scale).filter("grid_row IS NOT NULL")
    return staged(points.unionByName(covered).unionByName(bare).unionByName(circles), "geometry-cells")


def spread(values: DataFrame, cells: DataFrame) -> DataFrame:
    """Spread each geometry's money (geom, value) over its cells (geom, grid_row, grid_col, cover) by covered share. The shares' sums
    are aggregated before the join, so a geometry's cells need not meet in one task."""
    whole = cells.groupBy("geom").agg(F.sum("cover").alias("_whole"))
    shares = cells.join(whole, "geom").filter("_whole > 0")
    return values.join(shares, "geom").select("geom", "grid_row", "grid_col", (F.col("value") * F.col("cover") / F.col("_whole")).alias("value"))


def surface(spread_cells: DataFrame) -> DataFrame:
    """The summed grid: grid_row, grid_col, value. Cells without money have no row."""
    return spread_cells.groupBy("grid_row", "grid_col").agg(F.sum("value").alias("value"))


def build_surface(locations: DataFrame, cells: DataFrame) -> DataFrame:
    """From locations (geom, adjusted_val) to the summed grid; money is summed per geometry first, so that each geometry is
    spread once however many locations have it."""
    return surface(spread(locations.groupBy("geom").agg(F.sum("adjusted_val").alias("value")), cells))


def geometry_shapes(df: DataFrame, countries: DataFrame, areas: DataFrame) -> DataFrame:
    """geom, geom_kind, iso3, polygons of every distinct geometry of df (geom, geom_kind, geom_key, geom_metres, iso3, lon, lat). A point is a ring
    of twice its place; a buffer is its whole circle, which its country (iso3) clips; the others have no iso3."""
    own = df.filter("geom IS NOT NULL").select("geom", "geom_kind", "geom_key", "geom_metres", "iso3", "lon", "lat").dropDuplicates(["geom"])
    kind = lambda name: own.filter(F.col("geom_kind") == name)
    place = F.struct(F.col("lon").alias("x"), F.col("lat").alias("y"))
    points = kind("point").select("geom", "geom_kind", F.array(F.array(F.array(place, place))).alias("polygons"))
    held = kind("country").join(countries.select(F.col("iso3").alias("geom_key"), "polygons"), "geom_key").select("geom", "geom_kind", "polygons")
    parts = kind("area").join(areas.select(F.col("asdf_id").cast("string").alias("geom_key"), "polygons"), "geom_key").select("geom", "geom_kind", "polygons")
    circles = buffer_m(kind("buffer").select("geom", "geom_kind", "iso3", *(F.col(c).cast("double").alias(n) for c, n in (("lon", "lon"), ("lat", "lat"), ("geom_metres", "metres")))))
    whole = points.unionByName(held).unionByName(parts).withColumn("iso3", F.lit(None).cast("string"))
    return whole.unionByName(circles.select("geom", "geom_kind", "iso3", "polygons"))


def unique_geometries(df: DataFrame, shapes: DataFrame) -> DataFrame:
    """hash, geom_kind, iso3, unique_dollars, location_count, location_ids (joined by `|`), polygons of every distinct geometry of df (geom, location_id,
    adjusted_val) by its shape (`geometry_shapes`): areas of equal outline are one geometry, whatever their ids and however they are written.
    Locations are summed by name first, so that no outline is repeated for each of them."""
    named = df.groupBy("geom").agg(F.sum("adjusted_val").alias("dollars"), F.count("*").alias("n"), F.collect_list("location_id").alias("ids"))
    identity = F.sha1(F.concat_ws("|", geometry_text(F.col("polygons")), F.col("iso3")).cast("binary"))
    met = named.join(shapes.withColumn("hash", identity), "geom")
    ids = F.array_join(F.sort_array(F.flatten(F.collect_list("ids"))), "|")
    one = met.groupBy("hash").agg(F.sum("dollars").alias("unique_dollars"), F.sum("n").alias("location_count"), ids.alias("location_ids"), F.min("geom").alias("geom"))
    return one.join(shapes.select("geom", "geom_kind", "iso3", "polygons"), "geom").select("hash", "geom_kind", "iso3", "unique_dollars", "location_count", "location_ids", "polygons")


def touched_geometries(features: DataFrame, unique: DataFrame, countries: DataFrame) -> DataFrame:
    """asdf_id, hash, dollars of the unique geometries that share a point with each feature (asdf_id, polygons). A buffer touches a feature if its
    circle does and the country that clips it does. Stage `unique`: it is read more than once."""
    met = touching(features, unique.select("hash", "polygons"), "asdf_id", "hash").join(unique.select("hash", "iso3", F.col("unique_dollars").alias("dollars")), "hash")
    clipping = countries.join(unique.select("iso3").distinct(), "iso3", "left_semi").select("iso3", "polygons")
    held = touching(features, clipping, "asdf_id", "iso3").withColumn("_held", F.lit(True))
    return met.join(held, ["asdf_id", "iso3"], "left").filter("iso3 IS NULL OR _held").select("asdf_id", "hash", "dollars")


MAX_TOKENS = 10_000  # of 100 bytes or so: lists up to this are broadcast, longer ones are joined as Spark chooses


def _combinations(tokens: DataFrame, column: str, most: int) -> DataFrame:
    """All sets of 0..most tokens as sorted arrays, by self joins on order. Tokens are the sectors or donors of a release."""
    one = tokens.select(F.col("token"))
    one = F.broadcast(one) if one.limit(MAX_TOKENS + 1).count() <= MAX_TOKENS else one
    sets = [tokens.sparkSession.range(1).select(F.array().cast("array<string>").alias(column))]
    now = tokens.select(F.array("token").alias(column))
    for k in range(most):
        if k:
            now = now.join(one, F.col("token") > F.element_at(column, -1)).select(F.concat(column, F.array("token")).alias(column))
        sets.append(now)
    return reduce(DataFrame.unionByName, sets)


def filter_combos(df: DataFrame, sectors: int = 2, donors: int = 1) -> DataFrame:
    """sectors, donors: every pair of a sector set (up to `sectors` tokens) and a donor set (up to `donors`). A release with one
    donor has no donor filter. The result is all pairs by its meaning."""
    tokens = lambda column: distinct_tokens(df.select(column).distinct(), column)
    donor_tokens = tokens("donors")
    few = donor_tokens.limit(2).count() <= 1
    return _combinations(tokens("ad_sector_names"), "sectors", sectors).crossJoin(_combinations(donor_tokens, "donors", 0 if few else donors))


def _parts(own: DataFrame, chosen: DataFrame) -> DataFrame:
    """own, token: the chosen tokens that are part of each text (own). An automaton of the chosen tokens reads each text once; if they are more than
    MAX_TOKENS they do not go to every task, but meet the texts in a join."""
    tokens = [r.token for r in chosen.select("token").distinct().limit(MAX_TOKENS + 1).collect()]
    if len(tokens) > MAX_TOKENS:
        return own.join(chosen.select("token").distinct(), F.contains(F.col("own"), F.col("token")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = ahocorasick.Automaton()
        for t in tokens:
            search.add_word(t, t)
        search.make_automaton()
        for batch in batches:
            found = [(text, t) for text in batch["own"].to_pylist() if tokens and text is not None for t in {t for _, t in search.iter(text)}]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in (0, 1)], ["own", "token"])

    return own.mapInArrow(run, "own string, token string")


def _held_tokens(strings: DataFrame, column: str, chosen: DataFrame) -> DataFrame:
    """id, token: the chosen tokens that are part of each string (a token is part of a string if it is of one of its tokens), and `""`, which
    all hold. Tokens are compared with tokens, and strings meet them by equality."""
    own = strings.select("id", F.explode(F.array_distinct(pipe_split(F.col(column)))).alias("own"))
    found = own.join(_parts(own.select("own").distinct(), chosen), "own").select("id", "token").distinct()
    return found.unionByName(strings.select("id", F.lit("").alias("token")))


def _small_sets(strings: DataFrame, combos: DataFrame, sectors: DataFrame, donors: DataFrame) -> DataFrame:
    """sectors, donors, count, adjusted of combinations of at most two sectors and one donor, from counts of single tokens and of pairs that meet
    in a string: a set of two matches what either matches less what both do, and money is a sum over whole tokens. No combination
    ever meets a string."""
    by_donor = donors.withColumnRenamed("token", "donor").join(strings.select("id", "n", "dollars"), "id")
    held = staged(sectors.withColumnRenamed("token", "sector"), "held-sectors")
    single = held.join(by_donor, "id").groupBy("sector", "donor").agg(F.sum("n").alias("n"))
    tokens = pipe_split(F.col("ad_sector_names"))
    shares = strings.select("id", F.explode(tokens).alias("sector"), (F.lit(1.0) / F.size(tokens)).alias("share")).groupBy("id", "sector").agg(F.sum("share").alias("share"))
    shares = shares.unionByName(strings.select("id", F.lit("").alias("sector"), F.lit(1.0).alias("share")))
    money = shares.join(by_donor, "id").groupBy("sector", "donor").agg(F.sum(F.col("share") * F.col("dollars")).alias("adjusted"))
    single = staged(single.join(money, ["sector", "donor"], "left"), "single-tokens")
    real = held.filter("sector != ''")
    pairs = real.withColumnRenamed("sector", "first").join(real.withColumnRenamed("sector", "second"), "id").filter("first < second")
    pairs = pairs.join(by_donor, "id").groupBy("first", "second", "donor").agg(F.sum("n").alias("both"))
    token = lambda c, k: F.coalesce(F.get(c, F.lit(k)), F.lit(""))
    asked = combos.select("sectors", "donors", token("sectors", 0).alias("first"), F.get("sectors", F.lit(1)).alias("second"), token("donors", 0).alias("donor"))
    of = lambda name: single.select(F.col("sector").alias(name), "donor", F.col("n").alias(f"n_{name}"), F.col("adjusted").alias(f"a_{name}"))
    met = asked.join(of("first"), ["first", "donor"], "left").join(of("second"), ["second", "donor"], "left").join(pairs, ["first", "second", "donor"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return met.select("sectors", "donors", (zero("n_first") + zero("n_second") - zero("both")).alias("count"), (F.coalesce("a_first", F.lit(0.0)) + F.coalesce("a_second", F.lit(0.0))).alias("adjusted"))


def _any_sets(strings: DataFrame, combos: DataFrame, sectors: DataFrame, donors: DataFrame) -> DataFrame:
    """The same of sets of any size: combinations meet the strings that hold one of their tokens."""
    asked = lambda column: F.explode(F.when(F.size(column) == 0, F.array(F.lit(""))).otherwise(F.col(column)))
    wanted = combos.select("combo", asked("sectors").alias("sector"), "donors").select("combo", "sector", asked("donors").alias("donor"))
    held = sectors.withColumnRenamed("token", "sector").join(donors.withColumnRenamed("token", "donor"), "id")
    both = wanted.join(held, ["sector", "donor"]).select("combo", "id").distinct().join(strings, "id").join(combos, "combo")
    tokens = pipe_split(F.col("ad_sector_names"))
    ratio = F.when(F.size("sectors") == 0, 1.0).otherwise(F.size(F.filter(tokens, lambda t: F.array_contains(F.col("sectors"), t))) / F.size(tokens))
    return both.groupBy("sectors", "donors").agg(F.sum("n").alias("count"), F.sum(ratio * F.col("dollars")).alias("adjusted"))


def combo_stats(df: DataFrame, combos: DataFrame) -> DataFrame:
    """Per combination: count of matching locations, sum of adjusted money, percentage of the total cut to 3 decimals, hash.

    Rows (ad_sector_names, donors, split_dollars_pp) are summed per distinct pair of strings first: adjusted money is linear
    in the split money. A location matches when a chosen sector and a chosen donor are substrings of its strings; its money
    counts by the share of whole tokens chosen. Sets of up to two sectors and one donor are counted from tokens and pairs of them
    (`_small_sets`), others by joining combinations and strings on tokens. Dropped: no location; under
    10 locations with more than one field chosen; no money.
    """
    strings = df.groupBy("ad_sector_names", "donors").agg(F.count("*").alias("n"), F.sum("split_dollars_pp").alias("dollars")).withColumnRenamed("donors", "donor_names")
    strings = staged(strings.withColumn("id", F.monotonically_increasing_id()), "combo-strings")
    combos = staged(combos.withColumn("combo", F.monotonically_increasing_id()), "combos")
    total = df.agg(F.sum("split_dollars_pp").alias("total"))
    chosen = lambda column: combos.select(F.explode(column).alias("token")).distinct()
    sectors, donors = staged(_held_tokens(strings, "ad_sector_names", chosen("sectors")), "held-sectors"), staged(_held_tokens(strings, "donor_names", chosen("donors")), "held-donors")
    small = combos.filter("size(sectors) > 2 OR size(donors) > 1").isEmpty()
    found = (_small_sets if small else _any_sets)(strings, combos, sectors, donors)
    fields = (F.size("sectors") > 0).cast("int") + (F.size("donors") > 0).cast("int")
    kept = found.filter((F.col("count") > 0) & ~((F.col("count") < 10) & (fields > 1)) & (F.col("adjusted") > 0)).crossJoin(F.broadcast(total))
    named = lambda name, c: F.when(F.size(c) > 0, F.concat(F.lit(name), F.array_join(c, "|"))).otherwise("")
    key: Column = F.concat_ws(";", named("ad_sector_names=", F.col("sectors")), named("donors=", F.col("donors")))
    return kept.select(
        F.array_join("sectors", "|").alias("sectors"), F.array_join("donors", "|").alias("donors"), "count", "adjusted",
        (F.floor(F.round(100000 * F.col("adjusted") / F.col("total"), 6)) / 1000).alias("percentage"), F.sha1(key.cast("binary")).alias("hash"),
    )
