"""Release tables: projects, locations and transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomill.functions.text import pipe_split


def merge_release(projects: DataFrame, locations: DataFrame, only_geocoded: bool = True) -> DataFrame:
    """Projects joined with their locations on project_id as text; projects without a location stay unless `only_geocoded`."""
    left = projects.withColumn("project_id", F.col("project_id").cast("string"))
    return left.join(locations.withColumn("project_id", F.col("project_id").cast("string")), "project_id", "inner" if only_geocoded else "left")


def split_value(df: DataFrame, amount: str = "total_commitments") -> DataFrame:
    """location_count of each project and split_dollars_pp = amount / count, a null amount counting as 0. Must run before any
    filter: all locations of the project share its money. Counts come from a grouped join, so a project with very many
    locations is pre-aggregated and its join can be split."""
    counts = df.groupBy("project_id").agg(F.count("*").alias("location_count"))
    return df.join(counts, "project_id").withColumn("split_dollars_pp", F.coalesce(F.col(amount), F.lit(0.0)) / F.col("location_count"))


def adjust_value(df: DataFrame, sectors: list[str] | None = None) -> DataFrame:
    """adjusted_val = split money times the share of the project's sector tokens that are chosen (whole tokens, duplicates
    count). No choice, or `All`, takes everything."""
    if not sectors or "All" in sectors:
        ratio = F.lit(1.0)
    else:
        tokens = pipe_split(F.col("ad_sector_names"))
        ratio = F.coalesce(F.size(F.filter(tokens, lambda t: t.isin(*sectors))) / F.size(tokens), F.lit(0.0))
    return df.withColumn("sector_ratio", ratio).withColumn("adjusted_val", F.col("sector_ratio") * F.col("split_dollars_pp"))


def filter_years(df: DataFrame, years: list[int]) -> DataFrame:
    """Keep projects with a chosen year inside [transactions_start_year, transactions_end_year]; null years fail."""
    chosen = F.array(*(F.lit(y) for y in years))
    return df.filter(F.exists(chosen, lambda y: y.between(F.col("transactions_start_year"), F.col("transactions_end_year"))))


def filter_range(df: DataFrame, column: str, values: list[float]) -> DataFrame:
    """min(values) <= column <= max(values)."""
    return df.filter(F.col(column).between(min(values), max(values)))


def filter_any(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Keep rows whose text holds any of the values as a substring."""
    test = F.lit(False)
    for value in values:
        test |= F.col(column).cast("string").contains(value)
    return df.filter(test)


def apply_filters(df: DataFrame, filters: dict[str, list]) -> DataFrame:
    """Apply a whole filter map; empty lists and those with `All` are skipped. Known fields: transaction_year,
    total_commitments, total_disbursements; all others match text."""
    for field, values in filters.items():
        if not values or "All" in values:
            continue
        if field == "transaction_year":
            df = filter_years(df, [int(v) for v in values])
        elif field in ("total_commitments", "total_disbursements"):
            df = filter_range(df, field, [float(v) for v in values])
        else:
            df = filter_any(df, field, [str(v) for v in values])
    return df


def nest_release(projects: DataFrame, locations: DataFrame, transactions: DataFrame) -> DataFrame:
    """Projects with an array of their locations (empty if none) and of their transactions (null if none). A project's
    arrays are one row: their size is bounded by what one project has."""

    def nested(df: DataFrame, name: str) -> DataFrame:
        fields = [c for c in df.columns if c != "project_id"]
        return df.groupBy("project_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))

    out = projects.join(nested(locations, "locations"), "project_id", "left").join(nested(transactions, "transactions"), "project_id", "left")
    kind = out.schema["locations"].dataType.simpleString()
    return out.withColumn("locations", F.coalesce("locations", F.array().cast(kind)))


def release_gaps(projects: DataFrame, locations: DataFrame, transactions: DataFrame) -> DataFrame:
    """project_id, missing: projects without any location or without any transaction."""
    gaps = [projects.join(other.select("project_id").distinct(), "project_id", "left_anti").select("project_id", F.lit(name).alias("missing")) for other, name in ((locations, "locations"), (transactions, "transactions"))]
    return gaps[0].unionByName(gaps[1])


def latest_releases(releases: DataFrame, active: DataFrame | None = None) -> DataFrame:
    """The newest version of each preamble (the name up to its first `_`), versions compared number by number; ties stay.
    `active` (preamble) limits the preambles."""
    known = releases.filter("name IS NOT NULL AND version IS NOT NULL").withColumn("_preamble", F.substring_index("name", "_", 1))
    known = known.withColumn("_version", F.transform(F.split("version", r"\."), lambda p: p.cast("int")))
    best = known.groupBy("_preamble").agg(F.max("_version").alias("_best"))
    latest = known.join(best, "_preamble").filter("_version = _best")
    if active is not None:
        latest = latest.join(active.select(F.col("preamble").alias("_preamble")).distinct(), "_preamble", "left_semi")
    return latest.drop("_preamble", "_version", "_best")


def mark_outdated(releases: DataFrame, latest: DataFrame) -> DataFrame:
    """The releases that are not the latest, with active 0."""
    return releases.join(latest.select("name").distinct(), "name", "left_anti").withColumn("active", F.lit(0))


def projects_in_box(locations: DataFrame, boxes: DataFrame, tile: float = 15.0) -> DataFrame:
    """box_id, n_projects: projects with at least one location inside each box (both axes, edges included). Boxes are cut into
    tiles and locations meet them by an equi-join, so neither side is compared whole with the other."""
    index = lambda c: F.floor(c / tile).cast("int")
    tiles = boxes.withColumn("_tx", F.explode(F.sequence(index(F.col("minx")), index(F.col("maxx"))))).withColumn("_ty", F.explode(F.sequence(index(F.col("miny")), index(F.col("maxy")))))
    points = locations.select("project_id", "longitude", "latitude", index(F.col("longitude")).alias("_tx"), index(F.col("latitude")).alias("_ty"))
    inside = points.join(tiles, ["_tx", "_ty"]).filter("longitude BETWEEN minx AND maxx AND latitude BETWEEN miny AND maxy")
    counts = inside.select("box_id", "project_id").distinct().groupBy("box_id").agg(F.count("*").alias("n_projects"))
    return boxes.select("box_id").join(counts, "box_id", "left").withColumn("n_projects", F.coalesce("n_projects", F.lit(0)))
