"""Work lists: what is wanted, what is missing, what is next, what failed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomill.functions.text import pipe_split

KEY = ["boundary", "data", "extract_type", "version"]
STALE_SECONDS, MOST_ATTEMPTS, MOST_SURFACE_ATTEMPTS = 1200, 20, 5


def expand_work(boundaries: DataFrame, tracker: DataFrame, catalog: DataFrame, resources: DataFrame, version: str) -> DataFrame:
    """Every wanted item: active boundary (not adm0) x relevant active raster of its group x resource x extract type."""
    active = boundaries.filter("active = 1 AND group_class != 'actual'").select("boundary", "group")
    relevant = tracker.filter("status = 1").select("group", "dataset")
    rasters = catalog.filter("active = 1").select("dataset", F.explode(pipe_split(F.col("extract_types"))).alias("extract_type"))
    items = active.join(relevant, "group").join(rasters, "dataset").join(resources.select("dataset", F.col("name").alias("data")), "dataset")
    return items.select("boundary", "data", "extract_type", F.lit(version).alias("version"))


def missing_work(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Distinct wanted items without a row in `done`: inserted only if absent."""
    return wanted.dropDuplicates(KEY).join(done.select(*KEY), KEY, "left_anti")


def drop_stale(work: DataFrame, boundaries: DataFrame, datasets: DataFrame, version: str) -> DataFrame:
    """The work list without waiting automatic items (status 0, priority -1) of an unknown boundary or dataset or another version."""
    known = work.join(boundaries.select("boundary", F.lit(1).alias("_b")).distinct(), "boundary", "left")
    known = known.join(datasets.select("data", F.lit(1).alias("_d")).distinct(), "data", "left")
    stale = (F.col("status") == 0) & (F.col("priority") == -1) & (F.col("_b").isNull() | F.col("_d").isNull() | (F.col("version") != version))
    return known.filter(~stale).select(*work.columns)


def next_work(work: DataFrame, n: int, classification: str | None = None, attempts: tuple[int, int] | None = None) -> DataFrame:
    """The next n waiting items: highest priority, then earliest; a top-k, so no full sort. Ties go by key."""
    waiting = work.filter("status = 0")
    if classification:
        waiting = waiting.filter(F.col("classification") == classification)
    if attempts:
        waiting = waiting.filter(F.col("attempts").between(*attempts))
    return waiting.orderBy(F.desc("priority"), F.asc("submit_time"), *KEY).limit(n)


def next_surfaces(work: DataFrame, n: int) -> DataFrame:
    """Surfaces: requested ones (priority 0 or more) first, then automatic ones by priority, then smallest percentage."""
    asked = F.col("priority") >= 0
    order = [F.desc(asked), F.desc("priority"), F.when(asked, F.col("submit_time")).asc(), F.when(~asked, F.col("percentage")).asc(), F.asc("hash")]
    return work.filter("status = 0").orderBy(*order).limit(n)


def triage(work: DataFrame, now: int) -> DataFrame:
    """new_status of failed items (-1) and of running ones (2) not updated for 20 minutes: 0, or -2 from 20 attempts on."""
    stuck = (F.col("status") == -1) | ((F.col("status") == 2) & (now - F.col("update_time") > STALE_SECONDS))
    return work.withColumn("new_status", F.when(stuck, F.when(F.col("attempts") >= MOST_ATTEMPTS, -2).otherwise(0)).otherwise(F.col("status")))


def triage_surfaces(work: DataFrame) -> DataFrame:
    """Surfaces: failed ones only, at most 5 attempts, each retry counted."""
    failed, spent = F.col("status") == -1, F.col("attempts") >= MOST_SURFACE_ATTEMPTS
    out = work.withColumn("new_status", F.when(failed, F.when(spent, -2).otherwise(0)).otherwise(F.col("status")))
    return out.withColumn("new_attempts", F.when(failed & ~spent, F.col("attempts") + 1).otherwise(F.col("attempts")))


def backlog(work: DataFrame) -> DataFrame:
    """Open items (0, -1, 2) per class and band of attempts: `low` below 5 (or missing), `high` 5 to 19."""
    attempts = F.coalesce("attempts", F.lit(0))
    band = F.when(attempts < 5, "low").when(attempts < 20, "high")
    is_open = work.withColumn("band", band).filter("band IS NOT NULL AND status IN (0, -1, 2)")
    counts = [F.count_if(F.col("status") == s).alias(name) for s, name in ((0, "waiting"), (-1, "failed"), (2, "running"))]
    return is_open.groupBy("classification", "band").agg(*counts, F.count("*").alias("total"))


def incomplete(results: DataFrame, features: DataFrame) -> DataFrame:
    """boundary, data, extract_type, n_rows, n_features of results whose rows are not as many as their boundary's features.
    results (boundary, data, extract_type, asdf_id), features (boundary, asdf_id)."""
    rows = results.groupBy("boundary", "data", "extract_type").agg(F.count("asdf_id").alias("n_rows"))
    sizes = features.groupBy("boundary").agg(F.count("*").alias("n_features"))
    return rows.join(sizes, "boundary", "left").withColumn("n_features", F.coalesce("n_features", F.lit(0))).filter("n_rows != n_features")
