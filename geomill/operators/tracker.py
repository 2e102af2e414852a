"""Relevance: which dataset matters to which boundary group.

Status: 1 relevant, 0 not, -1 new or to be checked again, -2 unknown type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomill.functions.geometry import boxes_meet
from geomill.operators.release import projects_in_box

MAX_SAMPLES, LEAST_SHARE = 100_000, 0.05


def tracker_candidates(boundaries: DataFrame, datasets: DataFrame, tracker: DataFrame, tile: float = 30.0) -> DataFrame:
    """New pairs (group, dataset) with status -1: boxes meet, or either side is global, and the pair is not tracked yet.
    boundaries (group, scale, bbox), datasets (dataset, scale, bbox). Regional boxes meet through an equi-join on tiles; only
    global ones (few) pair with everything."""
    index = lambda c: F.floor(c / tile).cast("int")

    def tiled(df: DataFrame) -> DataFrame:
        return df.withColumn("_tx", F.explode(F.sequence(index(F.col("bbox.minx")), index(F.col("bbox.maxx"))))).withColumn("_ty", F.explode(F.sequence(index(F.col("bbox.miny")), index(F.col("bbox.maxy")))))

    a, b = boundaries.select("group", "scale", "bbox"), datasets.select("dataset", F.col("scale").alias("d_scale"), F.col("bbox").alias("d_box"))
    regional_b = tiled(datasets.filter("scale = 'regional'")).select("dataset", F.col("bbox").alias("d_box"), "_tx", "_ty")
    met = tiled(a.filter("scale = 'regional'")).join(regional_b, ["_tx", "_ty"]).filter(boxes_meet(F.col("bbox"), F.col("d_box"))).select("group", "dataset")
    wide = a.filter("scale = 'global'").crossJoin(b).select("group", "dataset").unionByName(a.filter("scale = 'regional'").crossJoin(b.filter("d_scale = 'global'")).select("group", "dataset"))
    pairs = met.unionByName(wide).distinct()
    return pairs.join(tracker.select("group", "dataset"), ["group", "dataset"], "left_anti").withColumn("status", F.lit(-1))


def sample_step(bbox: Column, px: Column) -> Column:
    """The smallest whole step s with (dx / (px s)) * (dy / (px s)) <= MAX_SAMPLES, at least 1."""
    cells = (bbox["maxx"] - bbox["minx"]) / px * ((bbox["maxy"] - bbox["miny"]) / px)
    guess = F.greatest(F.lit(1), F.ceil(F.sqrt(cells / MAX_SAMPLES)).cast("int"))
    fits = lambda s: cells / (s * s) <= MAX_SAMPLES
    return F.when((guess > 1) & fits(guess - 1), guess - 1).when(fits(guess), guess).otherwise(guess + 1)


def sample_grid(boxes: DataFrame, step: Column) -> DataFrame:
    """All sample points of each box (box_id, bbox): from its minimum in steps, end exclusive; made by sequences on the executors."""
    stepped = boxes.withColumn("_s", step)
    count = lambda low, high: F.ceil((F.col(f"bbox.{high}") - F.col(f"bbox.{low}")) / F.col("_s")).cast("int")
    places = lambda low, high: F.filter(F.sequence(F.lit(0), F.greatest(F.lit(1), count(low, high)) - 1), lambda i: F.col(f"bbox.{low}") + i * F.col("_s") < F.col(f"bbox.{high}"))
    xs = stepped.withColumn("i", F.explode(places("minx", "maxx")))
    both = xs.withColumn("j", F.explode(places("miny", "maxy")))
    return both.select("box_id", (F.col("bbox.minx") + F.col("i") * F.col("_s")).alias("lon"), (F.col("bbox.miny") + F.col("j") * F.col("_s")).alias("lat"))


def pixel_check(samples: DataFrame, pixels: DataFrame, options: DataFrame) -> DataFrame:
    """box_id, n_samples, n_valid, n_distinct, relevant: 5 % of the samples must be valid; with option `any` one; with option
    `false` always relevant. samples (box_id, grid_row, grid_col), pixels (grid_row, grid_col, value), options (box_id, pixel_check).
    Samples of one cell are counted together before the join."""
    cells = samples.groupBy("box_id", "grid_row", "grid_col").agg(F.count("*").alias("n"))
    seen = cells.join(pixels.select("grid_row", "grid_col", "value"), ["grid_row", "grid_col"], "left")
    counts = seen.groupBy("box_id").agg(F.sum("n").alias("n_samples"), F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("n_valid"), F.count_distinct("value").alias("n_distinct"))
    option = F.coalesce("pixel_check", F.lit(""))
    relevant = F.when(option == "false", True).when(option == "any", F.col("n_valid") >= 1).otherwise(F.col("n_valid") >= LEAST_SHARE * F.col("n_samples"))
    return counts.join(options, "box_id", "left").select("box_id", "n_samples", "n_valid", "n_distinct", relevant.alias("relevant"))


def release_check(pairs: DataFrame, locations: DataFrame) -> DataFrame:
    """group, dataset, relevant for pairs (group, dataset, iso3, release_iso3 array, release_scale, minx..maxy): the boundary's iso3 is
    in the release's list, or the release is global and has a project with a location in the box."""
    boxes = pairs.filter("release_scale = 'global'").select(F.col("group").alias("box_id"), "minx", "miny", "maxx", "maxy").distinct()
    inside = projects_in_box(locations, boxes).select(F.col("box_id").alias("group"), "n_projects")
    both = pairs.join(inside, "group", "left")
    relevant = F.when(F.col("release_scale") == "global", F.coalesce("n_projects", F.lit(0)) >= 1).otherwise(F.array_contains("release_iso3", F.col("iso3")))
    return both.select("group", "dataset", relevant.alias("relevant"))


def tracker_status(df: DataFrame) -> DataFrame:
    """status from type, relevant, and whether the dataset is known and active (columns type, relevant, known, active)."""
    status = (
        F.when(~F.col("known") | (F.coalesce("active", F.lit(0)) != 1), -1)
        .when(~F.col("type").isin("raster", "release"), -2)
        .when(F.col("relevant"), 1)
        .otherwise(0)
    )
    return df.withColumn("status", status)
