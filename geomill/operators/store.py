"""A store of rows by hash that batches are merged into, without rewriting what they do not touch.

Rows lie in folders by the first digits of their key's digest. A batch rewrites only the folders that its keys fall into: the merged folders are written beside the store first, and
when all are whole they are moved in one by one. Whoever opens the store next finishes a move that was cut off and drops folders that
were never whole, so a merge that is killed has happened either not at all or in full, and a batch may be merged again.
One writer at a time; readers that started before a move have to start again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geomill.operators.merge import upsert_extracts, upsert_features
from geomill.sources.tables import staged

FEATURES = "hash string, datasets array<string>, tags array<string>, properties map<string,string>"
EXTRACTS = "hash string, data string, method string, version string, value double"
DIGITS = 2  # of the digest: 16 ** DIGITS folders


class _Folders:
    """The folders of a store, by the file system that its root names."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.system = self.path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        return self.system.exists(self.path(f"{self.root}/{name}"))

    def prefixes(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.system.listStatus(self.path(f"{self.root}/{name}")) if s.getPath().getName().startswith("prefix="))

    def delete(self, name: str) -> None:
        self.system.delete(self.path(f"{self.root}/{name}"), True)

    def move(self, prefix: str) -> None:
        """Put a merged folder in the place of the old one. Cut off between the two, the merged one is still there to be moved."""
        self.system.mkdirs(self.path(f"{self.root}/rows"))
        self.delete(f"rows/{prefix}")
        if not self.system.rename(self.path(f"{self.root}/merged/{prefix}"), self.path(f"{self.root}/rows/{prefix}")):
            raise OSError(f"{prefix} of {self.root} could not be moved")


def recover(spark: SparkSession, root: str) -> None:
    """Finish or drop what a merge left behind."""
    folders = _Folders(spark, root)
    if folders.exists("merged/_SUCCESS"):
        for prefix in folders.prefixes("merged"):
            folders.move(prefix)
    folders.delete("merged")


def read_store(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of a store, with the column `prefix` of their folder; none where there is no store yet."""
    recover(spark, root)
    full = f"{schema}, prefix string"
    return spark.read.schema(full).parquet(f"{root.rstrip('/')}/rows") if _Folders(spark, root).exists("rows") else spark.createDataFrame([], full)


def merge_into(root: str, new: DataFrame, schema: str, merge: Callable[[DataFrame, DataFrame], DataFrame], key: str = "hash", digits: int = DIGITS) -> None:
    """Merge a batch into the store: `merge(rows of the touched folders, batch)` gives their new rows. A store keeps the digits it began with. A null
    key is a key like any other; an empty batch changes nothing."""
    spark = new.sparkSession
    prefix = F.substring(F.coalesce(F.sha1(F.col(key)), F.lit("0" * digits)), 1, digits)
    new = staged(new, "batch")
    touched = [r.prefix for r in new.select(prefix.alias("prefix")).distinct().collect()]  # 16 ** digits at most
    old = read_store(spark, root, schema).filter(F.col("prefix").isin(touched)).drop("prefix")
    if not touched:
        return
    merged = merge(old, new).withColumn("prefix", prefix)
    merged.hint("rebalance", F.col("prefix")).write.mode("overwrite").partitionBy("prefix").parquet(f"{root.rstrip('/')}/merged")
    if not _Folders(spark, root).exists("merged/_SUCCESS"):  # the mark of whole folders, switched off by some settings
        raise ValueError("merges need mapreduce.fileoutputcommitter.marksuccessfuljobs")
    recover(spark, root)


def merge_features(root: str, new: DataFrame, digits: int = DIGITS) -> None:
    """`upsert_features` into a store."""
    merge_into(root, new, FEATURES, upsert_features, digits=digits)


def merge_extracts(root: str, new: DataFrame, digits: int = DIGITS) -> None:
    """`upsert_extracts` into a store."""
    merge_into(root, new, EXTRACTS, upsert_extracts, digits=digits)
