"""Exact cases of the scalar functions."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from geomill.functions import geometry as G
from geomill.functions import text as T


def one(spark, column, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, F.lit(value))
    return df.select(column.alias("r")).first().r


@pytest.mark.parametrize(
    ("text", "years"),
    [
        ("1900:1905", [*range(1900, 1906)]), ("1905:1900", []), ("1900", [1900]), ("!1900", []), ("1980|1990:1992", [1980, 1990, 1991, 1992]),
        ("1900:1910|!1905", [y for y in range(1900, 1911) if y != 1905]), ("1900:1910|!1905:1910|1950", [1900, 1901, 1902, 1903, 1904, 1950]),
        ("!1900:1910|!1905|1900:1910", [*range(1900, 1911)]), ("1985:1987|!1980:1990", []), ("1980:1982|!1981", [1980, 1982]), ("1990|1990", [1990, 1990]),
    ],
)
def test_parse_years(spark, text, years):
    assert one(spark, T.parse_years(F.col("t")), t=text) == years


def test_parse_years_edges(spark):
    assert len(one(spark, T.parse_years(F.col("t")), t="")) == 9000
    assert one(spark, F.size(T.parse_years(F.lit(None).cast("string")))) == 9000
    for wrong in ("x", "1905:x", "1900:1905:1910", "|", "1900|"):
        assert one(spark, T.parse_years(F.col("t"), strict=False), t=wrong) is None
        with pytest.raises(Exception, match="malformed years"):
            one(spark, T.parse_years(F.col("t")), t=wrong)


@pytest.mark.parametrize(
    ("mask", "one_file", "kind"),
    [("None", True, "invariant"), ("YYYY", False, "year"), ("YYYY_MM", False, "year-month"), ("YYYY_DDD", False, "year-day"), ("YYYY_MM_DDD", False, None), ("YYYY_DDD_MM", False, None), ("test", False, None), ("YYY", False, None), ("DD", False, None), ("MM_DDD", False, None), ("None", False, None), ("YYYY", True, None)],
)
def test_mask_kind(spark, mask, one_file, kind):
    r = one(spark, T.mask_kind(F.col("m"), F.col("o")), m=mask, o=one_file)
    assert r.kind == kind and (r.problem is None) == (kind is not None)


def test_mask_parts(spark):
    r = one(spark, T.cut_parts(T.mask_parts(F.col("n"), F.col("m"))), n="2001/year_day_2001_007.tif", m="YYYY/year_day_YYYY_DDD.tif")
    assert (r.year, r.month, r.day) == ("2001", "", "007")


@pytest.mark.parametrize(
    ("y", "m", "d", "expected"),
    [("2000", "", "", (20000101, 20001231, "year")), ("2000", "02", "", (20000201, 20000229, "year month")), ("2000", "", "060", (20000229, 20000229, "year day")), ("2001", "02", "28", (20010228, 20010228, "year month day"))],
)
def test_date_range(spark, y, m, d, expected):
    assert tuple(one(spark, T.date_range(F.col("y"), F.col("m"), F.col("d")), y=y, m=m, d=d)) == expected


def test_valid_date(spark):
    check = lambda y, m, d: one(spark, T.validate_date(F.col("y"), F.col("m"), F.col("d")), y=y, m=m, d=d).valid
    assert check("2000", "", "") and check("2000", "01", "31") and check("2000", "", "366")
    assert not check("200", "", "") and not check("2000", "1", "") and not check("2000", "01", "031") and not check("2000", "", "31")


def test_names(spark):
    assert one(spark, T.clean_name(F.col("n")), n="My Data-Set (v1.0)") == "my_data-set_v1.0"
    assert one(spark, T.clean_name(F.col("n")), n="ab c") is None
    assert one(spark, T.category_key(F.col("n")), n="Rain-fed Crop") == "rain_fed_crop"
    assert tuple(one(spark, T.split_data_name(F.col("n"), F.col("k")), n="ltdr_2001", k="raster")) == ("ltdr", "2001")
    assert tuple(one(spark, T.split_data_name(F.col("n"), F.col("k")), n="ltdr_mean", k="raster")) == ("ltdr_mean", "na")
    assert one(spark, T.release_identity(F.lit("NigeriaAIMS"), F.lit("Type"), F.lit("L1"), F.lit("1.3.1"))).title_words == "Nigeria"


def test_request_hash_ignores_key_order(spark):
    a = F.create_map(F.lit("b"), F.array(F.lit("2")), F.lit("a"), F.array(F.lit("1")))
    b = F.create_map(F.lit("a"), F.array(F.lit("1")), F.lit("b"), F.array(F.lit("2")))
    text = one(spark, T.request_json(F.lit("d"), a, F.lit(0.05), F.lit("release"), F.lit(1.0)))
    assert text == '{"dataset": "d", "filters": {"a": ["1"], "b": ["2"]}, "resolution": 0.05, "type": "release", "version": 1.0}'
    hashed = lambda m: one(spark, T.request_hash(F.lit("d"), m, F.lit(0.05), F.lit("release"), F.lit(1.0)))
    assert hashed(a) == hashed(b)


def test_scale_and_snap(spark):
    box = lambda dx, dy: G.box(F.lit(0.0), F.lit(0.0), F.lit(dx), F.lit(dy))
    assert one(spark, G.scale_of(box(150.0, 150.0))) == "global" and one(spark, G.scale_of(box(149.9, 150.0))) == "regional"
    g = one(spark, G.snap_grid(G.box(F.lit(0.3), F.lit(-0.3), F.lit(1.1), F.lit(0.9)), 0.5))
    assert tuple(g) == (0.0, -0.5, 1.5, 1.0, 3, 3)
    with pytest.raises(ValueError, match="pixel size"):
        G.snap_grid(F.col("b"), 0.3)


def test_request_json_is_canonical(spark):
    odd = ["a", 'Öl & "Gas"', "tab\tnew\n", "\x01\x7f", "日本", "😀x", "back\\slash", "", "1995"]
    df = spark.createDataFrame([({"donors": odd, "transaction_year": ["1995", "-2.5"], "é": []},)], "f map<string,array<string>>")
    got = df.select(T.request_json(F.lit("aïd"), F.col("f"), F.lit(0.05), F.lit("release"), F.lit(1.0)).alias("j")).first().j
    want = {"dataset": "aïd", "filters": {"donors": odd, "transaction_year": [1995, -2.5], "é": []}, "resolution": 0.05, "type": "release", "version": 1.0}
    assert got == json.dumps(want, sort_keys=True, ensure_ascii=True)
