"""Readers and writers on files of their own."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from geomill.functions import geometry as G
from geomill.operators import catalog, tracker
from geomill.sources import sinks, tables


def test_read_table(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,label\n1,NA\n2,\n3,"a, ""b""\nc"\n', encoding="utf-8")
    rows = tables.read_table(spark, str(tmp_path / "t.csv"), "id long, label string").orderBy("id").collect()
    assert [r.label for r in rows] == ["NA", None, 'a, "b"\nc']
    with pytest.raises(ValueError, match="not a table"):
        tables.read_table(spark, str(tmp_path / "t.xls"), "id long")


def test_release_needs_its_columns(spark, tmp_path):
    for name in ("projects", "locations", "transactions"):
        (tmp_path / f"{name}.csv").write_text("project_id,other\n1,2\n", encoding="utf-8")
    with pytest.raises(ValueError, match="projects lacks is_geocoded"):
        tables.read_release(spark, str(tmp_path), dict.fromkeys(("projects", "locations", "transactions"), "project_id long, other long"))


def test_features(spark, tmp_path):
    (tmp_path / "f.geojson").write_text(
        '{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": "a", "n": 3}, "geometry": {"type": "Polygon", "coordinates": [[[0,0],[0,2],[2,2],[2,0],[0,0]],[[0.5,0.5],[0.5,1],[1,1],[1,0.5],[0.5,0.5]]]}},'
        '{"type": "Feature", "properties": {"name": null}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0,0],[0,1],[1,1],[0,0]]],[[[5,5],[5,6],[6,6],[5,5]]]]}}]}',
        encoding="utf-8",
    )
    rows = tables.read_features(spark, str(tmp_path / "f.geojson")).select("asdf_id", "properties", G.area(F.col("polygons")).alias("a")).orderBy("asdf_id").collect()
    assert [(r.asdf_id, r.a) for r in rows] == [(0, 3.75), (1, 1.0)]
    assert rows[0].properties == {"name": "a", "n": "3"}


def test_ascii_grid(spark, tmp_path):
    (tmp_path / "g.asc").write_text("NCOLS 3\nNROWS 2\nXLLCORNER 10\nYLLCORNER -1\nCELLSIZE 0.5\nNODATA_VALUE -9\n1 2 -9\n4 5.5 6\n", encoding="utf-8")
    rows = tables.read_ascii_grid(spark, str(tmp_path / "g.asc")).orderBy("grid_row", "grid_col").collect()
    assert [r.value for r in rows] == [1.0, 2.0, None, 4.0, 5.5, 6.0] and (rows[0].minx, rows[0].maxy, rows[0].pixel_size) == (10.0, 0.0, 0.5)


def test_ascii_grid_without_nodata_and_with_a_centre(spark, tmp_path):
    (tmp_path / "g.asc").write_text("ncols 2\nnrows 2\nxllcenter 10.25\nyllcenter -0.75\ncellsize 0.5\n1 2\n4 -9999\n", encoding="utf-8")
    rows = tables.read_ascii_grid(spark, str(tmp_path / "g.asc")).orderBy("grid_row", "grid_col").collect()
    assert [r.value for r in rows] == [1.0, 2.0, 4.0, -9999.0] and (rows[0].minx, rows[0].maxy, rows[0].nrows) == (10.0, 0.0, 2)


def test_features_of_several_files(spark, tmp_path):
    one = '{"type": "Feature", "properties": {"name": "%s"}, "geometry": {"type": "Polygon", "coordinates": [[[0,0],[0,2],[2,2],[0,0]]]}}'
    for file, names in (("b", "xy"), ("a", "uvw"), ("c", "z")):
        (tmp_path / f"{file}.geojson").write_text('{"type": "FeatureCollection", "features": [' + ",".join(one % n for n in names) + "]}", encoding="utf-8")
    rows = tables.read_features(spark, str(tmp_path)).orderBy("asdf_id").collect()
    assert [(r.asdf_id, r.properties["name"]) for r in rows] == list(enumerate("uvwxyz")) and rows[3].file.endswith("b.geojson")


def test_extracts_are_laid_out_by_all_keys(spark, tmp_path):
    df = spark.createDataFrame([("b", "d", t, m, i, 1.0) for t in ("2000", "2001") for m in ("mean", "max") for i in range(9)], "boundary string, dataset string, temporal string, method string, asdf_id long, value double")
    sinks.write_extracts(df, f"{tmp_path}/out")
    assert (tmp_path / "out" / "boundary=b" / "dataset=d" / "temporal=2000" / "method=max").is_dir()
    sinks.write_extracts(df.drop("temporal"), f"{tmp_path}/less")
    assert (tmp_path / "less" / "boundary=b" / "dataset=d" / "method=max").is_dir() and spark.read.parquet(f"{tmp_path}/out").count() == 36


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    assert tables.scratch(spark, "x") != tables.scratch(spark, "x")
    context = type("Context", (), {"master": "yarn", "applicationId": "a"})()
    session = type("Session", (), {"conf": type("Conf", (), {"get": lambda self, name, default: default})(), "sparkContext": context})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.scratch(session, "x")


def test_scan_resources(spark, tmp_path):
    (tmp_path / "2001").mkdir()
    (tmp_path / "2001" / "a.tif").write_bytes(b"123")
    (tmp_path / "note.txt").write_bytes(b"1")
    assert [tuple(r) for r in tables.scan_resources(spark, str(tmp_path), "tif", None).collect()] == [("2001/a.tif", 3)]
    (tmp_path / "b.tif").write_bytes(b"12")
    assert tables.scan_resources(spark, str(tmp_path), ".tif", "YYYY/a.tif").count() == 2
    for extension, message in (("tif", "more than one"), ("asc", "no file")):
        with pytest.raises(ValueError, match=message):
            tables.scan_resources(spark, str(tmp_path), extension, "None")


def test_extract_csv_writes_na(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, None), (2, float("nan"), "x")], "id long, mean double, name string")
    sinks.write_extract_csv(df.coalesce(1), f"{tmp_path}/out")
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert text.splitlines() == ["id,mean,name", "1,2.5,NA", "2,NA,x"]


def test_catalog_resources_and_problems(spark):
    files = spark.createDataFrame([("d", "2001/x_2001_13.tif", "YYYY/x_YYYY_MM.tif", 1), ("d", "2001/x_201_1.tif", "YYYY/x_YYY_M.tif", 1), ("d", "x.tif", "None", 1)], "dataset string, path string, mask string, bytes long")
    rows = catalog.build_resources(files.filter("mask != 'YYYY/x_YYYY_MM.tif'")).orderBy("name").collect()
    assert rows[-1].name == "d_none" and (rows[-1].start, rows[-1].end) == (10000101, 99991231)
    entry = spark.createDataFrame([("n", None, "raster", ".tif", "None", "mean|mode", "x", None)], "name string, base string, type string, file_extension string, file_mask string, extract_types string, factor string, category_values string")
    assert catalog.validate_catalog(entry).first().problems == "factor is no number|missing base|unknown extract type"


@pytest.mark.parametrize(("dx", "dy", "px", "step"), [(1, 1, 0.5, 1), (316, 316, 1, 1), (317, 316, 1, 2), (3162, 3162, 1, 10), (3163, 3163, 1, 11)])
def test_sample_step(spark, dx, dy, px, step):
    box = G.box(F.lit(0.0), F.lit(0.0), F.lit(float(dx)), F.lit(float(dy)))
    assert spark.range(1).select(tracker.sample_step(box, F.lit(float(px))).alias("s")).first().s == step


def test_large_files_are_split_by_lines(spark, tmp_path):
    """A raster and a collection over many blocks: rows and ids are those of the whole file."""
    n, m = 300, 40
    head = ["NCOLS 40", "NROWS 300", "xllcorner 1", "yllcorner 2", "cellsize 0.5", "NODATA_value -1"]
    body = [" ".join(str(-1 if (r + c) % 7 == 0 else r * m + c) for c in range(m)) for r in range(n)]
    (tmp_path / "g.asc").write_text("\n".join([*head, *body[:100], "", *body[100:], ""]) + "\n")
    collection = ['{"type": "FeatureCollection", "name": "x", "features": [']
    shape = '{"type": "Polygon", "coordinates": [[[%d, 0], [%d, 1], [%d, 1], [%d, 0]]]}'
    collection += ['{"type": "Feature", "properties": {"n": "%d é"}, "geometry": %s}%s' % (k, shape % (k, k, k + 1, k), "," if k < n - 1 else "") for k in range(n)] + ["]}"]
    (tmp_path / "c.geojson").write_text("\n".join(collection), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(str(tmp_path / "g.asc")).rdd.getNumPartitions() > 5
        cells = {(r.grid_row, r.grid_col): r.value for r in tables.read_ascii_grid(spark, str(tmp_path / "g.asc")).collect()}
        features = tables.read_feature_lines(spark, str(tmp_path / "c.geojson")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert cells == {(r, c): None if (r + c) % 7 == 0 else float(r * m + c) for r in range(n) for c in range(m)}
    assert sorted((r.asdf_id, r.properties["n"], r.polygons[0][0][0].x) for r in features) == [(k, f"{k} é", float(k)) for k in range(n)]


def test_feature_lines_round_trip(spark, tmp_path):
    polygons = [[[(0.0, 0.0), (0.0, 1.5), (2.25, 1.0), (0.0, 0.0)], [(0.1, 0.2), (0.2, 0.3), (0.3, 0.2), (0.1, 0.2)]], [[(5.0, 5.0), (5.0, 6.0), (6.0, 6.0), (5.0, 5.0)]]]
    df = spark.createDataFrame([(7, {"name": 'a "b", {c}\nd'}, polygons), (3, None, polygons[:1]), (12, {"name": None}, [])], "asdf_id long, properties map<string,string>, polygons array<array<array<struct<x:double,y:double>>>>").repartition(3)
    tables.write_feature_lines(df, str(tmp_path / "out"))
    key = lambda r: (r.asdf_id, r.properties and {k: v for k, v in r.properties.items() if v is not None}, r.polygons)
    assert sorted(map(key, tables.read_feature_lines(spark, str(tmp_path / "out")).collect()), key=str) == sorted(map(key, df.collect()), key=str)
