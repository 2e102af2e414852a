"""Requests: their items, the state of each item, what is ready, what must be queued, and their users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomill.functions.text import clean_filters, request_hash

ITEM = ["boundary", "data", "extract_type"]
DAY = 86_400


def request_items(requests: DataFrame, version: float = 1.0, resolution: float = 0.05) -> DataFrame:
    """One row per surface filter and per file x extract type: request_id, boundary, kind, data, extract_type, nth. requests:
    request_id, boundary, release_data array<struct<dataset, filters map>>, raster_data array<struct<files array, extract_types array>>."""
    releases = requests.select("request_id", "boundary", F.posexplode("release_data").alias("nth", "r"))
    key = request_hash(F.col("r.dataset"), clean_filters(F.col("r.filters")), F.lit(resolution), F.lit("release"), F.lit(version))
    surfaces = releases.select("request_id", "boundary", F.lit("surface").alias("kind"), F.concat_ws("_", "r.dataset", key).alias("data"), F.lit("reliability").alias("extract_type"), "nth")
    rasters = requests.select("request_id", "boundary", F.posexplode("raster_data").alias("nth", "r"))
    files = rasters.select("request_id", "boundary", F.lit("raster").alias("kind"), F.explode("r.files").alias("data"), "r.extract_types", "nth")
    return surfaces.unionByName(files.withColumn("extract_type", F.explode("extract_types")).drop("extract_types"))


def _state(kind: str) -> dict:
    status, stored = F.col("status"), F.coalesce("has_result", F.lit(False))
    if kind == "extract":
        done, waiting, error = (status == 1) & stored, status.isin(0, 2, 3), (status == 1) & ~stored
        state = F.when(status.isNull(), "new").when(waiting, "waiting").when(done, "done").otherwise("error")
        return {"state": state, "new_status": F.when(error, -1).otherwise(status)}
    state = F.when(status.isNull() | ((status == 1) & ~stored), "new").when(status.isin(0, 2), "waiting").when((status == 1) & stored, "done").otherwise("error")
    return {"state": state, "new_status": status}


def cache_state(items: DataFrame, work: DataFrame, results: DataFrame, kind: str = "extract", key: list[str] | None = None) -> DataFrame:
    """items with state (new, waiting, done, error) and new_status. Extracts: 0, 2, 3 wait; 1 is done with a stored result and an
    error without (status becomes -1); all else is an error. Surfaces: 0, 2 wait; 1 without a result is new again."""
    key = key or ITEM
    both = items.join(work.select(*key, "status"), key, "left").join(results.select(*key, F.lit(True).alias("has_result")).distinct(), key, "left")
    return both.withColumns(_state(kind)).drop("status", "has_result")


def request_ready(items: DataFrame) -> DataFrame:
    """request_id, missing_surfaces, missing_extracts, ready, results (sorted, joined by `|`). items: request_id, kind, state, data, extract_type.
    A missing surface lacks its extract too, so it counts in both."""
    missing = F.col("state") != "done"
    surface = F.col("kind") == "surface"
    counts = items.groupBy("request_id").agg(
        F.count_if(missing & surface).alias("missing_surfaces"), F.count_if(missing).alias("missing_extracts"),
        F.array_join(F.array_sort(F.collect_list(F.when(~missing, F.concat_ws(".", "data", "extract_type")))), "|").alias("results"),
    )
    return counts.withColumn("ready", (F.col("missing_surfaces") == 0) & (F.col("missing_extracts") == 0))


def enqueue(items: DataFrame, work: DataFrame, now: int, surfaces: bool = False) -> DataFrame:
    """The work list after queuing items: new ones with status 0, priority 0, attempts 0; an existing extract that the automatic
    pass made (priority below 0), or any existing surface, is raised to priority 0 with a new update time."""
    wanted = items.select(*ITEM).distinct().withColumn("_asked", F.lit(True))
    both = work.withColumn("_known", F.lit(True)).join(wanted, ITEM, "full")
    new = F.col("_known").isNull()
    raised = ~new & F.col("_asked").isNotNull() & (F.lit(True) if surfaces else F.col("priority") < 0)
    stamp = F.lit(now).cast("long")
    fill = lambda c, value: F.when(new, value).otherwise(F.col(c)).alias(c)
    return both.select(
        *ITEM, fill("status", F.lit(0)), F.when(new | raised, 0).otherwise(F.col("priority")).alias("priority"), fill("attempts", F.lit(0)),
        fill("submit_time", stamp), F.when(new | raised, stamp).otherwise(F.col("update_time")).alias("update_time"),
    )


def active_users(requests: DataFrame, now: int) -> DataFrame:
    """Users to ask for comments: over 3 requests in the last 365 days, none of them flagged, the first more than 14 and the last more
    than 7 days ago."""
    recent = requests.filter(F.col("complete_time") > now - 365 * DAY)
    users = recent.groupBy("email").agg(
        F.count("*").alias("n_requests"), F.sum(F.coalesce("comments_requested", F.lit(0))).alias("comments_requested"), F.sum(F.coalesce("contact_flag", F.lit(0))).alias("contact_flag"),
        F.min("complete_time").alias("earliest_time"), F.max("complete_time").alias("latest_time"),
    )
    return users.filter((F.col("comments_requested") == 0) & (F.col("contact_flag") == 0) & (F.col("n_requests") > 3) & (now - F.col("earliest_time") > 14 * DAY) & (now - F.col("latest_time") > 7 * DAY))
