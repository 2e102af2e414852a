"""Weights stored in buckets, and exact medians of groups of any size."""

from __future__ import annotations

import math
import statistics
import uuid

import pytest
from pyspark.sql import functions as F

from geomill.operators import medians as M
from geomill.operators import rasterize, zonal
from geomill.sources.tables import scratch, staged

GRID = {"minx": 0.0, "maxy": 10.0, "px": 1.0, "nrows": 10, "ncols": 10}


def boundary(spark, *rings):
    return spark.createDataFrame([(k, [[[(float(x), float(y)) for x, y in r]]]) for k, r in enumerate(rings)], f"asdf_id long, polygons {rasterize.POLYGONS}")


SQUARE, TRIANGLE, TINY = [(2, 2), (2, 5.5), (6.3, 5.5), (6.3, 2), (2, 2)], [(0, 0), (0, 10), (10, 0), (0, 0)], [(7.01, 7.01), (7.01, 7.02), (7.02, 7.02), (7.01, 7.01)]


def raster(spark, name, seed):
    return spark.createDataFrame([(name, i, j, float((i * 13 + j * seed) % 29)) for i in range(10) for j in range(10) if (i + j) % 7], "resource string, grid_row int, grid_col int, value double")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored_in(spark, root):
    return next(t.name for t in spark.catalog.listTables() if t.name.startswith("weights_") and root.rsplit("/", 1)[1] in spark.table(t.name).inputFiles()[0])


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_stored_pixels_and_weights_meet_without_an_exchange(spark, no_broadcast):
    root = scratch(spark, "store")
    features = boundary(spark, SQUARE, TRIANGLE, TINY)
    weights = zonal.stored_weights(features, **GRID, all_touched=True, root=root)
    assert "Arrow" not in plan_of(weights) and "Python" not in plan_of(weights)  # read, not made
    pixels = zonal.store_pixels(raster(spark, "a", 5).unionByName(raster(spark, "b", 7)), f"pixels_{uuid.uuid4().hex}", root)
    met = pixels.filter("value IS NOT NULL").join(weights, ["grid_row", "grid_col"])
    assert "Join" in plan_of(met) and "Exchange" not in plan_of(met)
    stats = zonal.zonal_many(pixels, weights, maxy=10.0, px=1.0)
    fresh = zonal.zonal_many(raster(spark, "a", 5).unionByName(raster(spark, "b", 7)), zonal.zone_weights(features, **GRID, all_touched=True), maxy=10.0, px=1.0)
    rows = lambda df: sorted((r.resource, r.asdf_id, *(None if r[m] is None else round(r[m], 9) for m in zonal.METHODS)) for r in df.collect())
    assert rows(stats) == rows(fresh) and len(rows(stats)) == 6


def test_stored_weights_are_made_once(spark, monkeypatch):
    root, made, real = scratch(spark, "store"), [], zonal.zone_weights
    monkeypatch.setattr(zonal, "zone_weights", lambda *a, **k: made.append(1) or real(*a, **k))
    features = boundary(spark, SQUARE, TRIANGLE)
    first = zonal.stored_weights(features, **GRID, root=root)
    turned = boundary(spark, [*SQUARE[2:], *SQUARE[1:3]], TRIANGLE[::-1]).repartition(2)
    again = zonal.stored_weights(turned, **GRID, root=root)
    assert len(made) == 1 and sorted(first.collect()) == sorted(again.collect())
    name = stored_in(spark, root)
    spark.sql(f"DROP TABLE {name}")  # as for another application, which finds the folder only
    assert sorted(zonal.stored_weights(features, **GRID, root=root).collect()) == sorted(first.collect()) and len(made) == 1
    zonal.stored_weights(boundary(spark, SQUARE), **GRID, root=root)
    zonal.stored_weights(features, **(GRID | {"px": 0.5, "nrows": 20, "ncols": 20}), root=root)
    assert len(made) == 3


def test_half_written_weights_are_made_again(spark):
    root = scratch(spark, "store")
    features = boundary(spark, SQUARE)
    want = sorted(zonal.stored_weights(features, **GRID, root=root).collect())
    name = stored_in(spark, root)
    fs = spark._jvm.org.apache.hadoop.fs
    path = fs.Path(f"{root}/{name}/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    assert sorted(zonal.stored_weights(features, **GRID, root=root).collect()) == want


# ---- medians ----

GROUPS = {
    "one": [3.0], "two": [1.0, 2.0], "equal": [7.0] * 50, "odd": [5.0, 1.0, 9.0], "wide": [1e-300, 1.0, 1e300, -1e300, 5e-324, 0.0], "tail": [float(k**4) for k in range(400)], "nearly": [1.0 + k * 2**-52 for k in range(300)],
    "halves": [0.0] * 200 + [1.0] * 200, "steps": [float(k // 100) for k in range(1001)], "ends": [-math.inf] * 20 + [math.inf] * 21 + [2.0], "negative": [-float(k) for k in range(333)], None: [4.0, 6.0], "zeros": [0.0, -0.0, -0.0],
}


@pytest.mark.parametrize(("bins", "keep"), [(1024, 2048), (4, 3)])
def test_medians_of_any_group(spark, monkeypatch, bins, keep):
    monkeypatch.setattr(M, "BINS", bins)
    monkeypatch.setattr(M, "KEEP", keep)
    rows = [(k, 1, v) for k, values in GROUPS.items() for v in values] + [("odd", 1, None), ("odd", 1, math.nan), ("nothing", 1, None), ("odd", 2, 4.0)]
    df = spark.createDataFrame(rows, "resource string, asdf_id long, value double").repartition(3)
    got = {(r.resource, r.asdf_id): r.median for r in M.medians(df, "resource", "asdf_id").collect()}
    assert got == {(k, 1): statistics.median(v) for k, v in GROUPS.items()} | {("odd", 2): 4.0}


def test_median_of_many_values_holds_few(spark):
    """A group of five million values: the same as `percentile`, though no round gathers over KEEP of a group."""
    df = staged(spark.range(5_000_000).select(F.lit(1).alias("k"), (F.sin(F.col("id") * 12.9898) * 43758.5453).alias("value")).unionByName(spark.range(7).select(F.lit(2).alias("k"), F.col("id").cast("double").alias("value"))), "many")
    got = {r.k: r.median for r in M.medians(df, "k").collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.percentile("value", F.lit(0.5)).alias("m")).collect()}
    assert got == pytest.approx(want, rel=1e-15)
