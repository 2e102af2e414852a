"""Every registered query of the library runs on the smallest tables; those with SQL give the same rows as DuckDB."""

from __future__ import annotations

import math
import os
import re

import duckdb
import pytest

from geomill.operators import zonal
from geomill.plans import q_release, q_requests, q_zonal, registry

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(round(float(value), 5) + 0.0)
    return str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in registry.oracle_sql():
        assert rows
        return
    result = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == sorted(tuple(plain(r[i]) for i in order) for r in result.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")
def test_requests_are_dealt_by_line_items(spark, monkeypatch):
    """So many line items a task, however few bytes they take."""
    monkeypatch.setattr(q_requests, "LINES", 100, raising=False)
    views = registry.Views(spark, SF_DIR)
    plan = re.sub(r"#[0-9]+L?", "", q_requests.request_rows(views)._jdf.queryExecution().executedPlan().toString())
    assert f"hashpartitioning(l_orderkey, {views.lineitem.count() // 100})" in plan


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")
def test_money_reads_the_release_once(spark):
    """What follows the kept locations does not make them again from orders and line items."""
    plan = q_release.money(registry.Views(spark, SF_DIR))._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan and "o_orderkey" not in plan


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")
def test_samples_are_dealt_by_their_own_number(spark, monkeypatch):
    """So many rows of the result a task, however few bytes points and pixels take; pixels are not broadcast through the driver."""
    monkeypatch.setattr(zonal, "SAMPLES", 1000, raising=False)
    views = registry.Views(spark, SF_DIR)
    plan = re.sub(r"#[0-9]+L?", "", q_zonal.zon_point_sample(views)._jdf.queryExecution().executedPlan().toString())
    assert plan.count(f"hashpartitioning(grid_row, grid_col, part, {views.locations.count() * views.grids.count() // 1000})") == 2
    assert "SortMergeJoin [resource, grid_row, grid_col]" in plan
