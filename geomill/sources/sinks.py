"""Writers of extracts and surfaces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_extract_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; null, NaN and missing fields are `NA`."""
    plain = [F.when(~F.isnan(c), F.col(c)).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes]
    df.select(*plain).write.options(header=True, nullValue="NA", emptyValue="").csv(path)


LAYOUT = ("boundary", "dataset", "temporal", "method")


def write_extracts(df: DataFrame, path: str) -> None:
    """The long result table laid out by boundary, dataset, temporal and method (those of them that it has). Rows of one folder are
    dealt together so that few files are written; Spark splits a folder that holds much more than others."""
    keys = [c for c in LAYOUT if c in df.columns]
    df.hint("rebalance", *map(F.col, keys)).write.partitionBy(*keys).parquet(path)


def write_surface(cells: DataFrame, locations: DataFrame, summary: DataFrame, path: str) -> None:
    """The summed grid (Parquet), the active locations (CSV) and one summary row (JSON)."""
    cells.write.parquet(f"{path}/cells")
    locations.write.option("header", True).csv(f"{path}/locations")
    summary.write.json(f"{path}/summary")
