"""All registered queries of the library and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geomill.plans.views import duckdb_sql, view

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


class Views:
    """The views over one data folder, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of Views as query `name`, with the SQL (over views in braces) that gives the same rows."""

    def keep(f: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        _queries[name] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            _sql[name] = duckdb_sql(sql)
        return f

    return keep


def _load() -> None:
    from geomill.plans import q_catalog, q_functions, q_geometry, q_io, q_release, q_requests, q_work, q_zonal  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
