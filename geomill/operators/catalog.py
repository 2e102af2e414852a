"""The catalog: resources with their time ranges, checks, updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomill.functions import text as T

# Fixed values.
DATA_FORMATS = {"raster": ["tif", "asc"], "boundary": ["geojson", "shp"], "release": ["csv"]}
EXTRACT_TYPES = ["categorical", "count", "encoded", "max", "mean", "median", "min", "reliability", "sum"]


def build_resources(files: DataFrame, drange: int = 0) -> DataFrame:
    """One row per file (dataset, path, mask, bytes): name `<dataset>_<ymd>` or `_none`, start, end, type, problem."""
    parts = files.withColumn("_p", T.cut_parts(T.mask_parts(F.col("path"), F.col("mask"))))
    y, m, d = F.col("_p.year"), F.col("_p.month"), F.col("_p.day")
    fixed = F.col("mask") == "None"
    check, span = T.validate_date(y, m, d), T.date_range(y, m, d, drange)
    valid = fixed | check["valid"]
    out = parts.withColumn("_valid", valid).withColumn("_span", F.when(~fixed & valid, span)).withColumn("problem", F.when(~valid, check["message"]))
    ymd = F.concat(y, m, d)
    return out.select(
        "dataset", F.concat_ws("_", "dataset", F.when(fixed, "none").otherwise(ymd)).alias("name"), "path", "bytes",
        F.when(fixed, T.INVARIANT_START).otherwise(F.col("_span.start")).alias("start"),
        F.when(fixed, T.INVARIANT_END).otherwise(F.col("_span.end")).alias("end"),
        F.when(fixed, "none").otherwise(F.col("_span.type")).alias("type"), "problem",
    )


def select_resources(files: DataFrame, years: DataFrame) -> DataFrame:
    """Files (dataset, path, mask) whose masked year is among the dataset's years (dataset, years array); invariant ones always. Sorted."""
    parts = T.cut_parts(T.mask_parts(F.col("path"), F.col("mask")))
    joined = files.join(years, "dataset").withColumn("_p", parts)
    chosen = (F.col("mask") == "None") | F.array_contains("years", F.col("_p.year").cast("int"))
    return joined.filter(chosen).select("dataset", "path", F.col("_p.year").alias("year"), F.col("_p.month").alias("month"), F.col("_p.day").alias("day")).orderBy("dataset", "path")


def dataset_temporal(resources: DataFrame) -> DataFrame:
    """dataset, start, end, type over its resources."""
    return resources.groupBy("dataset").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("type").alias("type"))


def extent_mismatch(resources: DataFrame) -> DataFrame:
    """Resources (dataset, name, minx..maxy) whose box differs from that of the dataset's first resource by name."""
    sides = F.struct("minx", "miny", "maxx", "maxy")
    first = resources.groupBy("dataset").agg(F.min_by(sides, "name").alias("_first"))
    return resources.join(first, "dataset").filter(sides != F.col("_first")).drop("_first")


def validate_catalog(df: DataFrame) -> DataFrame:
    """name and its problems (sorted, joined by `|`, empty if none). Columns: name, base, type, file_extension, file_mask,
    extract_types (pipe string), factor (text), category_values (pipe string of labels:values or null)."""
    issue = lambda test, message: F.when(test, F.lit(message))
    missing = [issue(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", f"missing {c}") for c in ("name", "base", "type", "file_extension", "file_mask")]
    known_type = F.col("type").isin(*DATA_FORMATS)
    extension = F.lit(False)
    for kind, allowed in DATA_FORMATS.items():
        extension |= (F.col("type") == kind) & F.regexp_replace("file_extension", r"^\.", "").isin(*allowed)
    types = T.pipe_split(F.col("extract_types"))
    unknown = F.size(F.array_except(types, F.array(*map(F.lit, EXTRACT_TYPES)))) > 0
    mapped = F.exists(types, lambda t: t.isin("categorical", "encoded"))
    entries = T.pipe_split(F.col("category_values"))
    bad_map = F.col("category_values").isNull() | ~F.forall(entries, lambda e: e.rlike(r"^[^:]+:-?\d+$"))
    problems = F.array(
        *missing,
        issue(~known_type, "unknown type"),
        issue(known_type & ~extension, "unknown extension"),
        issue(unknown, "unknown extract type"),
        issue((F.coalesce(F.col("factor"), F.lit("")) != "") & F.expr("try_cast(factor AS double) IS NULL"), "factor is no number"),
        issue(mapped & bad_map, "category map"),
    )
    return df.select("name", F.array_join(F.array_sort(F.array_compact(problems)), "|").alias("problems"))


def catalog_conflicts(new: DataFrame, old: DataFrame) -> DataFrame:
    """new_id, conflict: `name` or `base` taken by another record of `old` (id, name, base), or `split` when name and base belong
    to different records. An update carries the id of the record that it updates; an insert has a null id."""
    by_name = old.select(F.col("name"), F.col("id").alias("_name_id"))
    by_base = old.select(F.col("base"), F.col("id").alias("_base_id"))
    both = new.join(by_name, "name", "left").join(by_base, "base", "left")
    n, b, own = F.col("_name_id"), F.col("_base_id"), F.col("id")
    conflict = (
        F.when(n.isNotNull() & b.isNotNull() & (n != b), "split")
        .when(n.isNotNull() & ~n.eqNullSafe(own), "name")
        .when(b.isNotNull() & ~b.eqNullSafe(own), "base")
    )
    return both.select("new_id", conflict.alias("conflict")).filter("conflict IS NOT NULL")


def upsert_catalog(old: DataFrame, new: DataFrame) -> DataFrame:
    """Records by name: fields of the new record replace the old one's, date_added stays."""
    a, b = old.alias("a"), new.alias("b")
    fields = [c for c in old.columns if c not in ("name", "date_added")]
    is_new = F.col("b.name").isNotNull()
    merged = [F.when(is_new, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in fields]
    return a.join(b, F.col("a.name") == F.col("b.name"), "full").select(F.coalesce("a.name", "b.name").alias("name"), *merged, F.coalesce("a.date_added", "b.date_added").alias("date_added"))


def invalidate(trackers: DataFrame, extracts: DataFrame, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What stays of trackers (group, dataset) and extracts (boundary, dataset) after `changed` (kind, name, group): a replaced
    boundary drops its extracts and its group's tracker, a replaced dataset its rows in all trackers."""
    boundaries = changed.filter("kind = 'boundary'")
    groups = boundaries.select("group").distinct()
    datasets = changed.filter("kind = 'dataset'").select(F.col("name").alias("dataset")).distinct()
    left = trackers.join(groups, "group", "left_anti").join(datasets, "dataset", "left_anti")
    return left, extracts.join(boundaries.select(F.col("name").alias("boundary")).distinct(), "boundary", "left_anti")
