"""Laws and closed forms of the operators."""

from __future__ import annotations

import time
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from geomill.functions import geometry as G
from geomill.operators import merge, outline, rasterize, release, requests, simplify, surface, work, zonal

GRID = {"minx": 0.0, "maxy": 10.0, "px": 1.0, "nrows": 10, "ncols": 10}


def polygons(spark, *rings):
    rows = [(i, [[[(float(x), float(y)) for x, y in ring] for ring in rings_]]) for i, rings_ in enumerate(rings)]
    return spark.createDataFrame(rows, f"asdf_id long, polygons {rasterize.POLYGONS}")


SQUARE = [(2, 2), (2, 5.5), (6.3, 5.5), (6.3, 2), (2, 2)]
HOLE = [(3, 3), (3, 4), (4, 4), (4, 3), (3, 3)]
TINY = [(2.01, 2.01), (2.01, 2.02), (2.02, 2.02), (2.02, 2.01), (2.01, 2.01)]
TRIANGLE = [(0, 0), (0, 10), (10, 0), (0, 0)]


def test_rasterize_closed_forms(spark):
    cells = zonal.zone_weights(polygons(spark, [SQUARE], [SQUARE, HOLE], [TRIANGLE]), **GRID)
    sums = {r.asdf_id: r.s for r in cells.groupBy("asdf_id").agg(F.sum("cover").alias("s")).collect()}
    assert sums[0] == pytest.approx(100 * 3.5 * 4.3) and sums[1] == pytest.approx(100 * (3.5 * 4.3 - 1))
    assert abs(sums[2] / 100 - 50) < 1
    assert cells.filter("cover <= 0 OR cover > 100").count() == 0


def test_small_polygon_is_touched(spark):
    tiny = polygons(spark, [TINY])
    assert zonal.zone_weights(tiny, **GRID).count() == 0
    row = zonal.zone_weights(tiny, **GRID, all_touched=True).collect()
    assert [(r.grid_row, r.grid_col, r.cover) for r in row] == [(7, 2, 100.0)]


def test_zonal_laws(spark):
    pixels = spark.createDataFrame([("r", i, j, float(i * 10 + j) if (i + j) % 7 else None) for i in range(10) for j in range(10)], "resource string, grid_row int, grid_col int, value double")
    halves = polygons(spark, [[(0, 0), (0, 10), (3.5, 10), (3.5, 0), (0, 0)]], [[(3.5, 0), (3.5, 10), (10, 10), (10, 0), (3.5, 0)]])
    out = zonal.zonal_many(pixels, zonal.zone_weights(halves, **GRID), maxy=10.0, px=1.0).collect()
    total = sum(i * 10 + j for i in range(10) for j in range(10) if (i + j) % 7)
    assert sum(r["sum"] for r in out) == pytest.approx(total)
    assert all(r["min"] <= r["mean"] <= r["max"] for r in out)


def test_point_in_polygon_with_hole(spark):
    points = spark.createDataFrame([(0, 2.5, 2.5), (1, 3.5, 3.5), (2, 7.0, 7.0), (3, 2.0, 2.0)], "id long, lon double, lat double")
    held = outline.point_in_polygon(points, polygons(spark, [SQUARE, HOLE]))
    assert sorted(r.id for r in held.collect()) == [0, 3]


def test_utm_buffer():
    east, north = rasterize.utm_forward(np.array([-73.9857]), np.array([40.7484]), np.array([-75.0]))
    assert abs(east[0] - 585628) < 5 and abs(north[0] - 4511322) < 5
    lon, lat = rasterize.utm_back(east, north, np.array([-75.0]))
    assert abs(lon[0] + 73.9857) < 1e-9 and abs(lat[0] - 40.7484) < 1e-9
    x, y = rasterize.buffer_rings(np.array([10.0]), np.array([0.0]), np.array([1000.0]))
    east, north = rasterize.utm_forward(x[0], y[0], np.full(65, 9.0))
    assert np.allclose(np.hypot(east - east.mean(), north - north.mean())[:-1], 1000, rtol=0.02)


def test_douglas_peucker(spark):
    points = np.array([(0, 0), (1, 0.001), (2, 0), (3, 2), (4, 0)], float)
    assert simplify.douglas_peucker(points, 0.01).tolist() == [True, False, True, True, True]
    done = simplify.limit_chars(polygons(spark, [TRIANGLE]), limit=10).first()
    assert len(done.polygons[0][0]) == 4


def test_area_and_issues(spark):
    df = polygons(spark, [SQUARE, HOLE], [SQUARE[:4]], [[(0, 0), (1, 1), (0, 0)]])
    rows = df.select("asdf_id", G.area(F.col("polygons")).alias("a"), G.geometry_issues(F.col("polygons")).alias("i")).orderBy("asdf_id").collect()
    assert rows[0].a == pytest.approx(3.5 * 4.3 - 1) and rows[0].i == []
    assert rows[1].i == ["open ring"] and rows[2].i == ["few points", "zero area"]


def test_reliability(spark):
    sums = spark.createDataFrame([(0, 0.0), (1, 5.0), (2, 50.0), (3, None)], "asdf_id long, sum double")
    geoms = spark.createDataFrame([(2, "a", 150.0), (2, "b", 50.0), (2, "b", 50.0)], "asdf_id long, hash string, dollars double")
    got = {r.asdf_id: r.reliability for r in zonal.reliability(sums, geoms).collect()}
    assert got == {0: 1.0, 1: 0.0, 2: 0.25, 3: 1.0}


def test_surface_keeps_money(spark):
    money = spark.createDataFrame([("a", 10.0), ("a", 5.0), ("b", 3.0)], "geom string, adjusted_val double")
    cells = spark.createDataFrame([("a", 0, 0, 100), ("a", 0, 1, 50), ("b", 0, 1, 7)], "geom string, grid_row int, grid_col int, cover long")
    out = {(r.grid_row, r.grid_col): r.value for r in surface.build_surface(money, cells).collect()}
    assert out == {(0, 0): pytest.approx(10.0), (0, 1): pytest.approx(8.0)}
    assert surface.build_surface(money.limit(0), cells).count() == 0


def test_split_and_adjust(spark):
    df = spark.createDataFrame([("p", 90.0, "Health|Health|Water"), ("p", 90.0, "Health|Health|Water"), ("q", None, "Health Policy")], "project_id string, total_commitments double, ad_sector_names string")
    out = release.adjust_value(release.split_value(df), ["Health"]).collect()
    assert sorted(r.adjusted_val for r in out) == [0.0, 30.0, 30.0]
    assert release.filter_any(df, "ad_sector_names", ["Health"]).count() == 3


def test_combo_sizes(spark):
    df = spark.createDataFrame([("a|b", "x"), ("c", "y")], "ad_sector_names string, donors string")
    sizes = {(len(r.sectors), len(r.donors)) for r in surface.filter_combos(df).collect()}
    assert sizes == {(0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (2, 1)}
    assert {len(r.donors) for r in surface.filter_combos(df.filter("donors = 'x'")).collect()} == {0}


def test_latest_compares_numbers(spark):
    df = spark.createDataFrame([("a_x_v1_10", "1.10"), ("a_x_v1_9", "1.9"), ("b_x", "0.1"), (None, "3")], "name string, version string")
    assert sorted(r.version for r in release.latest_releases(df).collect()) == ["0.1", "1.10"]


def test_upserts_are_idempotent(spark):
    store = spark.createDataFrame([("h", "d", "mean", "1", 1.0)], "hash string, data string, method string, version string, value double")
    new = spark.createDataFrame([("h", "d", "mean", "1", 2.0), ("h", "e", "mean", "1", 3.0)], store.schema)
    once = merge.upsert_extracts(store, new)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, merge.upsert_extracts(once, new).collect()))
    assert {r.data: r.value for r in once.collect()} == {"d": 2.0, "e": 3.0}


def test_categories_of_every_feature(spark):
    """Features without a counted cell have zeros; an encoded value is a code and a count."""
    pixels = spark.createDataFrame([("r", 7, 2, 1034, 5), ("r", 7, 3, 1032, 6), ("s", 0, 0, 1061, None)], "resource string, grid_row int, grid_col int, encoded int, category int")
    features = polygons(spark, [SQUARE], [TINY])
    cells = zonal.centre_cells(features, **GRID)
    got = {(r.resource, r.asdf_id): (r.op_3, r.op_6, r.total) for r in zonal.zonal_encoded(pixels, cells, [3, 6], features).collect()}
    assert got == {("r", 0): (6, 0, 6), ("r", 1): (0, 0, 0), ("s", 0): (0, 0, 0), ("s", 1): (0, 0, 0)}
    got = {(r.resource, r.asdf_id): (r.five, r.total, r.other) for r in zonal.zonal_categorical(pixels, cells, {"five": 5}, features).collect()}
    assert got == {("r", 0): (1, 2, "6:1"), ("r", 1): (0, 0, ""), ("s", 0): (0, 0, ""), ("s", 1): (0, 0, "")}


def test_touched_cells_count_but_are_not_summed(spark):
    pixels = zonal.with_tiles(spark.createDataFrame([("r", 7, 2, 8.0)], "resource string, grid_row int, grid_col int, value double"))
    features = polygons(spark, [TINY])
    row = zonal.zonal_many(pixels, zonal.zone_weights(features, **GRID, all_touched=True), maxy=10.0, px=1.0, features=features).first()
    assert (row["count"], row["sum"], row["mean"], row["median"]) == (1.0, None, 8.0, 8.0)


def test_tiles_prune_folders(spark, tmp_path):
    pixels = spark.range(200 * 200).select(F.lit("r").alias("resource"), (F.col("id") / 200).cast("int").alias("grid_row"), (F.col("id") % 200).cast("int").alias("grid_col"), F.lit(1.0).alias("value"))
    zonal.write_pixels(pixels, f"{tmp_path}/pixels")
    grid = {"minx": 0.0, "maxy": 200.0, "px": 1.0, "nrows": 200, "ncols": 200}
    features = polygons(spark, [[(10, 150), (10, 160), (20, 160), (20, 150), (10, 150)]])
    done = zonal.zonal_many(spark.read.parquet(f"{tmp_path}/pixels"), zonal.zone_weights(features, **grid), ("sum", "count"), maxy=200.0, px=1.0)
    assert [(r["sum"], r["count"]) for r in done.collect()] == [(100.0, 100.0)]
    assert "dynamicpruning" in done._jdf.queryExecution().toString()


def test_a_tiny_polygon_on_a_large_grid_is_cheap():
    ring = np.array([(10.0, 10.0), (10.0, 10.01), (10.01, 10.01), (10.01, 10.0), (10.0, 10.0)])
    edges = np.hstack([ring[:-1], ring[1:]])
    rasterize._cover(edges, 1590, 1622, -180.0, 90.0, 0.05, 10, 7200)
    tracemalloc.start()
    began = time.perf_counter()
    left, cover = rasterize._cover(edges, 1590, 1622, -180.0, 90.0, 0.05, 10, 7200)
    took, (_, peak) = time.perf_counter() - began, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert took < 0.02 and peak < 1 << 20 and cover.shape[1] <= 2 and left in (3799, 3800)


def test_long_thin_polygon_touches_its_diagonal(spark):
    thin = polygons(spark, [[(0.531, 0.5), (9.53, 9.5), (9.529, 9.5), (0.531, 0.5)]])
    cells = {(r.grid_row, r.grid_col) for r in zonal.zone_weights(thin, **GRID, all_touched=True).filter("touched").collect()}
    want = {(9 - k, k) for k in range(10)}
    assert want <= cells and all(abs(9 - r - c) <= 1 for r, c in cells)


def test_centroid(spark):
    df = polygons(spark, [SQUARE], [TRIANGLE], [[(1, 1), (3, 1), (1, 1)]])
    got = [tuple(r.c) for r in df.orderBy("asdf_id").select(G.centroid(F.col("polygons")).alias("c")).collect()]
    assert got[0] == pytest.approx((4.15, 3.75)) and got[1] == pytest.approx((10 / 3, 10 / 3)) and got[2] == pytest.approx((2, 1))


def test_geometry_of_every_kind_keeps_its_money(spark):
    """Points, buffers (clipped, tiny, and outside their country), areas by level (one too small for a sub-cell's centre), countries."""
    box = lambda x0, y0, x1, y1: [[[(x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0)]]]
    rings = f"polygons {rasterize.POLYGONS}"
    countries = spark.createDataFrame([("AAA", box(0.0, 0.0, 5.0, 10.0)), ("BBB", box(5.0, 0.0, 10.0, 10.0))], f"iso3 string, {rings}")
    areas = spark.createDataFrame([(1, "AAA", 1, box(0.0, 0.0, 5.0, 5.0)), (2, "AAA", 2, box(1.0, 1.0, 2.0, 2.0)), (3, "AAA", 2, box(3.01, 3.01, 3.02, 3.02)), (4, "BBB", 2, box(5.0, 0.0, 9.0, 9.0))], f"asdf_id long, iso3 string, level int, {rings}")
    rows = [
        (0, "AAA", 1.5, 1.5, "point", None), (1, "AAA", 4.9, 4.5, "buffer", 25000), (2, "AAA", 2.51, 2.51, "buffer", 1), (3, "AAA", 1.5, 1.5, "adm", 0), (4, "AAA", 1.5, 1.5, "adm", 1), (5, "AAA", 1.5, 1.5, "adm", 2),
        (6, "AAA", 3.015, 3.015, "adm", 2), (7, "AAA", 4.0, 9.0, "adm", 1), (8, "AAA", 4.0, 9.0, "adm", 3), (9, "ZZZ", 1.0, 1.0, "point", None), (10, "AAA", 50.0, 1.0, "point", None), (11, "BBB", 1.0, 1.0, "buffer", 1000), (12, "AAA", 1.5, 1.5, None, None),
    ]
    df = spark.createDataFrame(rows, "location_id long, iso3 string, lon double, lat double, geom_type string, geom_data int")
    placed = surface.geometry_name(surface.assign_geometry(df, countries, areas, GRID)).cache()
    kinds = {r.location_id: (r.geom_kind, r.geom_key, r.geom_metres) for r in placed.collect()}
    assert kinds[4] == ("area", "1", None) and kinds[5] == ("area", "2", None) and kinds[6] == ("area", "3", None) and kinds[3] == ("country", "AAA", None)
    assert kinds[7] == ("country", "AAA", None) and kinds[8] == ("buffer", "4.0:9.0", 25000) and [kinds[k][0] for k in (9, 10, 12)] == [None] * 3
    strict = {r.location_id: r.geom_kind for r in surface.assign_geometry(df, countries, areas, GRID, strict=True).collect()}
    assert strict[7] is None and strict[8] is None and strict[5] == "area"
    cells = surface.geometry_cells(placed, countries, areas, GRID).cache()
    for r in placed.collect():
        own = [(c.grid_row, c.grid_col, c.cover) for c in cells.filter(F.col("geom") == r.geom).collect()]
        if r.location_id in (9, 10, 11, 12):
            assert own == []  # without a geometry, or a buffer that does not meet its country
            continue
        spread = surface.build_surface(spark.createDataFrame([(r.geom, 12.5)], "geom string, adjusted_val double"), cells)
        assert spread.agg(F.sum("value")).first()[0] == pytest.approx(12.5), r
        if r.location_id == 1:
            assert {c for _, c, _ in own} == {4}  # nothing beyond the border
        if r.location_id in (2, 6):
            assert own == [(7, 2, 100)] if r.location_id == 2 else own == [(6, 3, 100)]


def test_combinations_beyond_the_broadcast_bound(spark, monkeypatch):
    df = spark.createDataFrame([("a|b", "x"), ("c|a b", "y|z")], "ad_sector_names string, donors string").withColumn("split_dollars_pp", F.lit(4.0))
    few = sorted(map(str, surface.filter_combos(df).collect()))
    monkeypatch.setattr(surface, "MAX_TOKENS", 1)
    assert sorted(map(str, surface.filter_combos(df).collect())) == few and len(few) == (1 + 4 + 6) * 4
    stats = {(r.sectors, r.donors): (r["count"], r.adjusted) for r in surface.combo_stats(df, surface.filter_combos(df)).collect()}
    assert stats["a", ""] == (2, 2.0) and stats["a|c", ""] == (2, 4.0) and stats["", ""] == (2, 8.0)


def test_work_and_requests(spark):
    items = spark.createDataFrame([(1, "b", "surface", "s", "reliability", "new"), (1, "b", "raster", "d", "mean", "done")], "request_id long, boundary string, kind string, data string, extract_type string, state string")
    row = requests.request_ready(items).first()
    assert (row.missing_surfaces, row.missing_extracts, row.ready, row.results) == (1, 1, False, "d.mean")
    todo = spark.createDataFrame([(-1, 20, 0), (-1, 3, 0), (2, 3, 0), (2, 3, 5000), (1, 3, 0)], "status int, attempts int, update_time long")
    assert [r.new_status for r in work.triage(todo, 5100).collect()] == [-2, 0, 0, 2, 1]


def test_empty_tables(spark):
    pixels = spark.createDataFrame([], "resource string, grid_row int, grid_col int, value double")
    weights = spark.createDataFrame([], "asdf_id long, grid_row int, grid_col int, cover long")
    assert zonal.zonal_many(pixels, weights).count() == 0


def test_combinations_are_counted_without_pairs(spark):
    """Substrings, repeated tokens and nulls: the same from tokens and pairs as from all matches, and no nested-loop join."""
    sectors = ["Health", "Health Policy", "Water", "Wat", "Roads", "Energy|Water", "Water|Water|Roads", "Health Policy|Energy", "Policy", None]
    rows = [(sectors[k % 10], f"D{k % 3}" + ("|D1" if k % 4 == 0 else ""), float(k % 7)) for k in range(200)]
    df = spark.createDataFrame(rows, "ad_sector_names string, donors string, split_dollars_pp double")
    combos = surface.filter_combos(df)
    strings = df.groupBy("ad_sector_names", "donors").agg(F.count("*").alias("n"), F.sum("split_dollars_pp").alias("dollars")).withColumnRenamed("donors", "donor_names")
    strings = surface.staged(strings.withColumn("id", F.monotonically_increasing_id()), "strings")
    combos = surface.staged(combos.withColumn("combo", F.monotonically_increasing_id()), "combos")
    held = [surface._held_tokens(strings, c, combos.select(F.explode(t).alias("token")).distinct()) for c, t in (("ad_sector_names", "sectors"), ("donor_names", "donors"))]
    rows = lambda df: {("|".join(r.sectors), "|".join(r.donors)): (r["count"], pytest.approx(r.adjusted)) for r in df.filter("count > 0").collect()}
    assert rows(surface._small_sets(strings, combos, *held)) == rows(surface._any_sets(strings, combos, *held))
    plan = surface._small_sets(strings, combos, *held)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_many_sectors(spark):
    df = spark.createDataFrame([(f"S{k % 300:03d}|S{k * 7 % 300:03d}", f"D{k % 5}", 1.0) for k in range(3000)], "ad_sector_names string, donors string, split_dollars_pp double")
    stats = surface.combo_stats(df, surface.filter_combos(df))
    one = {r.sectors: r["count"] for r in stats.filter("donors = '' AND sectors IN ('S005', 'S005|S035', '')").collect()}
    holds = lambda *names: sum(any(n in {f"S{k % 300:03d}", f"S{k * 7 % 300:03d}"} for n in names) for k in range(3000))
    assert one == {"": 3000, "S005": holds("S005"), "S005|S035": holds("S005", "S035")}


def test_samples_of_a_crowded_cell_are_dealt_over_tasks(spark, monkeypatch):
    """A cell that holds most points is cut into parts; every point meets every raster once, with a value or without."""
    monkeypatch.setattr(zonal, "SAMPLES", 100, raising=False)
    rows = [(i, 2 + i / 1000, 7.5) for i in range(400)] + [(400, 9.5, 0.5), (401, -5.0, 3.0), (402, None, 1.0)]
    points = spark.createDataFrame(rows, "point_id int, lon double, lat double")
    names = spark.createDataFrame([(f"r{k}",) for k in range(5)], "resource string")
    pixels = spark.createDataFrame([(f"r{k}", 2, 2, float(k)) for k in range(4)] + [("r0", 9, 9, None), ("r1", 9, 9, 8.0)], "resource string, grid_row int, grid_col int, value double")
    got = zonal.sample_points(pixels, points, **GRID, resources=names).withColumn("task", F.spark_partition_id()).collect()
    want = {(i, k): float(k) if i < 400 and k < 4 else 8.0 if (i, k) == (400, 1) else None for i in range(403) for k in range(5)}
    assert len(got) == len(want) and {(r.point_id, int(r.resource[1:])): r.value for r in got} == want
    assert max(Counter(r.task for r in got).values()) < 1000
