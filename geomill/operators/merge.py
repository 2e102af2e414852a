"""Merging results: column names, wide tables, merge plans, the feature store."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomill.functions.text import parse_years, pipe_split


def field_name(dataset: Column, temporal: Column, method: Column, part: Column) -> Column:
    """`<ds>.<temporal>.<method>`; categorical and encoded add `_<part>`; reliability cuts the temporal (a hash) to 7 and keeps
    `sum` only (null for its other parts)."""
    plain = F.concat_ws(".", dataset, temporal, method)
    surface = F.when(part == "sum", F.concat_ws(".", dataset, F.substring(temporal, 1, 7), part))
    return F.when(method.isin("categorical", "encoded"), F.concat_ws("_", plain, part)).when(method == "reliability", surface).otherwise(plain)


def merge_extracts(extracts: DataFrame, features: DataFrame, order: list[str]) -> DataFrame:
    """One wide row per feature: asdf_id, the fields in the given order, then the features' attributes. extracts is the long table
    (asdf_id, field, value); the field list is given, so the pivot needs no pass of its own."""
    picked = [F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in order]
    wide = extracts.filter(F.col("field").isin(*order)).groupBy("asdf_id").agg(*picked)
    attributes = [c for c in features.columns if c != "asdf_id"]
    joined = features.join(wide, "asdf_id", "left")
    return joined.select("asdf_id", *(F.col(f"`{f}`") for f in order), *attributes)


def merge_plan(jobs: DataFrame, catalog: DataFrame, files: DataFrame) -> DataFrame:
    """Tasks of batch jobs: job entries (job, boundary, extract_type, years; null: the job's default_*) with the catalog (dataset, mask) and its
    files (dataset, path, year). job, boundary, dataset, extract_type, path."""
    pick = lambda c: F.coalesce(F.col(c), F.col(f"default_{c}")).alias(c)
    items = jobs.select("job", "dataset", *(pick(c) for c in ("boundary", "extract_type", "years")))
    items = items.withColumn("extract_type", F.explode(pipe_split(F.col("extract_type")))).withColumn("_years", parse_years(F.col("years")))
    tasks = items.join(catalog.select("dataset", "mask"), "dataset").join(files.select("dataset", "path", "year"), "dataset")
    return tasks.filter((F.col("mask") == "None") | F.array_contains("_years", F.col("year"))).select("job", "boundary", "dataset", "extract_type", "path")


def plan_counts(plan: DataFrame) -> DataFrame:
    """job, dataset, n_tasks, and the boundary's sorted results joined by `|`."""
    name = F.concat_ws(".", "path", "extract_type")
    return plan.groupBy("job", "boundary", "dataset").agg(F.count("*").alias("n_tasks"), F.array_join(F.array_sort(F.collect_set(name)), "|").alias("results"))


def boundary_tags(boundary: Column) -> Column:
    """The parts of a boundary's name, and `<second>_<third>`."""
    parts = F.split(boundary, "_")
    return F.concat(parts, F.array(F.concat_ws("_", F.get(parts, F.lit(1)), F.get(parts, F.lit(2)))))


def upsert_features(store: DataFrame, new: DataFrame) -> DataFrame:
    """The store by geometry hash (hash, datasets, tags, properties: map boundary -> text) after adding features (hash, boundary,
    properties text): unions of datasets and tags, the newest properties of each boundary. Geometries stay beside the store and
    are joined by hash where needed, so only the light columns are shuffled."""
    pair = lambda k, v: F.map_from_entries(F.array(F.struct(k, v)))
    added = new.select("hash", F.array("boundary").alias("datasets"), boundary_tags(F.col("boundary")).alias("tags"), pair(F.col("boundary"), F.col("properties")).alias("properties"), F.lit(1).alias("_new"))
    both = store.withColumn("_new", F.lit(0)).unionByName(added)
    entries = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_new", F.map_entries("properties").alias("e")))), lambda s: s["e"]))
    keys = F.array_distinct(F.transform(F.col("_e"), lambda e: e["key"]))
    last = F.transform(F.array_sort(keys), lambda k: F.struct(k.alias("key"), F.element_at(F.filter(F.col("_e"), lambda e: e["key"] == k), -1)["value"].alias("value")))
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return both.groupBy("hash").agg(union("datasets"), union("tags"), entries.alias("_e")).select("hash", "datasets", "tags", F.map_from_entries(last).alias("properties"))


def upsert_extracts(store: DataFrame, new: DataFrame) -> DataFrame:
    """Extracts of features (hash, data, method, version, value): a new one replaces that of the same key, others are appended. The
    newest is picked by an aggregate, so partial aggregation runs before the shuffle."""
    both = reduce(DataFrame.unionByName, (d.withColumn("_age", F.lit(k)) for k, d in enumerate((store, new))))
    return both.groupBy("hash", "data", "method", "version").agg(F.max_by("value", F.struct("_age", "value")).alias("value"))
