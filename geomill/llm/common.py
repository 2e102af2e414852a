"""What the operators share: reading a table's needed columns, cutting lineage in the cluster's shared folder, and joins whose keys
may be very uneven."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folder: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in spark.checkpoint.dir. Where that is unset a temporary folder does on one machine (tests); a
    cluster must set it, as its executors share no other folder."""
    folder, app = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.applicationId
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = _own_folder.setdefault(app, tempfile.mkdtemp(prefix="spark-geomill-"))
    return f"{folder.rstrip('/')}/geomill-{app}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, local or remote."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Delete all that this application staged; for the end of a job, when its results are written elsewhere."""
    delete(spark, shared_dir(spark))


LEAST_FILES = 12


def files_for(rows: int, per_file: int) -> int:
    """How many files (and so tasks) to write about `rows` rows with: in proportion, a dozen at least."""
    return max(LEAST_FILES, -(-rows // per_file))


def staged(df: DataFrame, label: str, files: int | None = None) -> DataFrame:
    """`df` written once as a table in the shared folder and read back: survives lost executors, cuts lineage. `files`, where
    the size is known, keeps many shuffle partitions from writing as many small files."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    (df.coalesce(files) if files else df).write.option("compression", "zstd").parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    read.staged_path = path
    return read


def drop_staged(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    delete(df.sparkSession, df.staged_path)


MOST_KEYS = 4096


def join_uneven(rows: DataFrame, keyed: DataFrame, on: str, weight: str, total: int, most: int = MOST_KEYS) -> DataFrame:
    """`rows` joined with `keyed` (one row per key) where some keys may hold any part of all rows. `weight`, of keyed, says how
    many rows a key has, of `total`. Keys over a 1 / most part of the total, so fewer than `most`, meet their rows by broadcast
    and leave them where they are; all others meet by a shuffle. `rows` is read twice: stage it first."""
    often = keyed.filter(F.col(weight) > total // most)
    hot = rows.join(F.broadcast(often), on)
    cold = rows.join(F.broadcast(often.select(on)), on, "left_anti").join(keyed.filter(F.col(weight) <= total // most), on)
    return hot.unionByName(cold)


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """The wanted column names, each with as many `_` before it as keep it apart from those taken (whatever their case)."""
    used, out = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """A text, null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; -1 for a null id, so that such rows are never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % by, F.lit(-1))
