"""Readers of tables, features and rasters, and a place for what jobs write between steps."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATORS = {"csv": ",", "tsv": "\t"}
REQUIRED = {
    "projects": ("project_id", "is_geocoded", "total_commitments"),
    "locations": ("project_id", "project_location_id", "longitude", "latitude", "location_class", "location_type_code", "geographic_exactness"),
    "transactions": ("project_id",),
}
RING = "array<struct<x:double,y:double>>"

_folders: dict[str, str] = {}


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the cluster's shared folder (spark.checkpoint.dir). Where that is unset a temporary folder does on one machine
    (tests); a cluster must set it, as its executors share no other folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = _folders.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="spark-geomill-"))
    return f"{folder.rstrip('/')}/geomill-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the shared folder and read back, for what is used more than once."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete all that this application has in the shared folder; for the end of a job."""
    place = spark._jvm.org.apache.hadoop.fs.Path(scratch(spark, "").rsplit("/", 1)[0])
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A .csv or .tsv with a header and a declared schema: quoted by `"`, UTF-8; blank is null, and only blank (`NA` is text).
    Any other extension is an error."""
    extension = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if extension not in SEPARATORS:
        raise ValueError(f"not a table: {path}")
    return spark.read.schema(schema).options(header=True, sep=SEPARATORS[extension], quote='"', escape='"', encoding="UTF-8", nullValue="", emptyValue="", multiLine=True).csv(path)


def check_columns(df: DataFrame, required: tuple[str, ...], what: str) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks {', '.join(missing)}")
    return df


def read_release(spark: SparkSession, base: str, schemas: dict[str, str]) -> dict[str, DataFrame]:
    """projects, locations and transactions of a release folder, project_id as text, required columns checked."""
    out = {}
    for name, required in REQUIRED.items():
        df = check_columns(read_table(spark, f"{base}/{name}.csv", schemas[name]), required, name)
        out[name] = df.withColumn("project_id", F.col("project_id").cast("string"))
    return out


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files: file, nth (from 0 in each file), value, and columns that folders give. Files are split as Spark splits them: a line's number is its
    place in its block after the lines of the blocks before, which are counted first."""
    lines = spark.read.text(path)
    folders = [c for c in lines.columns if c != "value"]
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), *folders, "value", F.monotonically_increasing_id().alias("_at"))
    blocks = lines.groupBy("file", "_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_block")) - F.col("_n")  # a row for each block of a file
    blocks = staged(blocks.select("file", "_block", "_first", before.alias("_before")), "blocks")
    return lines.join(blocks, ["file", "_block"]).select("file", (F.col("_at") - F.col("_first") + F.col("_before")).alias("nth"), *folders, "value")


_RINGS = "array<array<array<double>>>"


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON collections, one row per feature: file, asdf_id, properties (map of texts), polygons. asdf_id goes from 0 through the
    files in the order of their names. Polygon and MultiPolygon. A collection is one JSON value, so a file is read by one
    task and exploded there; many files are read side by side."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    schema = "struct<features: array<struct<properties: map<string,string>, geometry: struct<type: string, coordinates: string>>>>"
    read = text.select("file", F.from_json("value", schema)["features"].alias("features"))
    sizes = read.select("file", F.size("features").alias("n"))  # one row per file
    before = sizes.select("file", (F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    features = read.select("file", F.posexplode("features").alias("nth", "f")).join(before, "file")
    return features.select("file", (F.col("before") + F.col("nth")).cast("long").alias("asdf_id"), F.col("f.properties").alias("properties"), _polygons(F.col("f.geometry")).alias("polygons"))


def _feature_line() -> Column:
    """A feature (asdf_id, properties, polygons) as GeoJSON."""
    coordinates = F.to_json(F.transform("polygons", lambda part: F.transform(part, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))))
    head = F.concat(F.lit('{"type": "Feature", "id": '), F.col("asdf_id").cast("string"), F.lit(', "properties": '), F.coalesce(F.to_json("properties"), F.lit("null")))
    return F.concat(head, F.lit(', "geometry": {"type": "MultiPolygon", "coordinates": '), F.coalesce(coordinates, F.lit("[]")), F.lit("}}"))


def write_feature_lines(features: DataFrame, path: str) -> None:
    """Features (asdf_id, properties, polygons) as GeoJSON text sequences, one feature a line, written side by side."""
    features.select(_feature_line().alias("value")).write.text(path)


def read_feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON with one feature a line, as a sequence or as a collection whose features have lines of their own: file, asdf_id, properties,
    polygons. Files are split, so a collection may be of any size. asdf_id is the feature's `id` if that is a whole number, else its number in
    its file, from 0. Other lines (the collection's own) are passed over; for collections on one line see `read_features`."""
    schema = "struct<type: string, id: string, properties: map<string,string>, geometry: struct<type: string, coordinates: string>>"
    text = F.regexp_replace(F.trim("value"), r",$", "")
    whole = F.when(text.startswith("{") & text.endswith("}"), F.from_json(text, schema))
    lines = numbered_lines(spark, path).select("file", "nth", whole.alias("f")).withColumn("is", F.coalesce(F.col("f.type") == "Feature", F.lit(False)))
    passed = lines.filter(~F.col("is")).groupBy("file").agg(F.collect_list("nth").alias("passed"))
    features = lines.filter("is").join(passed, "file", "left")
    number = F.col("nth") - F.coalesce(F.size(F.filter("passed", lambda k: k < F.col("nth"))), F.lit(0))
    own = F.when(F.col("f.id").rlike(r"^-?[0-9]{1,18}$"), F.col("f.id").cast("long"))
    return features.select("file", F.coalesce(own, number).cast("long").alias("asdf_id"), F.col("f.properties").alias("properties"), _polygons(F.col("f.geometry")).alias("polygons"))


def _polygons(geometry: Column) -> Column:
    """The polygons of a geometry struct (type, coordinates as JSON); null of another type."""
    text = geometry["coordinates"]
    rings = F.when(geometry["type"] == "Polygon", F.array(F.from_json(text, _RINGS))).when(geometry["type"] == "MultiPolygon", F.from_json(text, f"array<{_RINGS}>"))
    point = lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
    return F.transform(rings, lambda part: F.transform(part, lambda r: F.transform(r, point)))


def geojson(features: DataFrame) -> DataFrame:
    """One GeoJSON text of features (asdf_id, properties, polygons), for files small enough to be one value."""
    coordinates = F.to_json(F.transform("polygons", lambda part: F.transform(part, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))))
    one = F.concat(F.lit('{"type": "Feature", "properties": '), F.to_json("properties"), F.lit(', "geometry": {"type": "MultiPolygon", "coordinates": '), coordinates, F.lit("}}"))
    ordered = F.array_sort(F.collect_list(F.struct("asdf_id", one.alias("text"))))
    return features.agg(F.concat(F.lit('{"type": "FeatureCollection", "features": ['), F.array_join(F.transform(ordered, lambda s: s["text"]), ", "), F.lit("]}")).alias("value"))


# The header lines of an ESRI ASCII grid, in lower case.
HEADER = ("ncols", "nrows", "xllcorner", "xllcenter", "yllcorner", "yllcenter", "cellsize", "nodata_value")


def read_ascii_grid(spark: SparkSession, path: str) -> DataFrame:
    """ESRI ASCII grids as pixels: path, grid_row, grid_col, value, and the grid's minx, maxy, pixel_size, nrows, ncols. Header lines are
    known by their keyword, so there may be a nodata line or none, and the origin may be a corner or a cell's centre; nodata is
    null. A line is a row of the grid, and files are split by lines, so a raster may be of any size; blank lines count for nothing."""
    lines = numbered_lines(spark, path)
    words = F.split(F.trim("value"), r"\s+")
    header, blank = F.lower(words[0]).isin(*HEADER), F.trim("value") == ""
    entry = F.when(header, F.struct(F.lower(words[0]), F.get(words, F.lit(1)).cast("double")))
    heads = lines.filter(header | blank).groupBy("file").agg(F.collect_list("nth").alias("passed"), F.map_from_entries(F.collect_list(entry)).alias("header"))
    h = lambda key: F.try_element_at("header", F.lit(key))
    rows = lines.filter(~header & ~blank).join(heads, "file")
    rows = rows.withColumn("grid_row", (F.col("nth") - F.size(F.filter("passed", lambda k: k < F.col("nth")))).cast("int"))
    cells = rows.select(F.col("file").alias("path"), "header", "grid_row", F.posexplode(words).alias("grid_col", "text"))
    value, size = F.col("text").cast("double"), h("cellsize")
    origin = lambda axis: F.coalesce(h(f"{axis}llcorner"), h(f"{axis}llcenter") - size / 2)
    return cells.select(
        "path", "grid_row", "grid_col", F.when(h("nodata_value").isNull() | (value != h("nodata_value")), value).alias("value"), origin("x").alias("minx"),
        (origin("y") + h("nrows") * size).alias("maxy"), size.alias("pixel_size"), h("nrows").cast("int").alias("nrows"), h("ncols").cast("int").alias("ncols"),
    )


def write_ascii_grids(pixels: DataFrame, path: str, minx: float, maxy: float, px: float, nrows: int, ncols: int, nodata: float = -9999.0) -> None:
    """One ESRI ASCII grid per raster, in a folder `resource=<name>`; missing pixels are nodata. Lines are made side by side, and a raster's file is
    streamed in order, line by line; no task holds a raster."""
    rows = pixels.groupBy("resource", "grid_row").agg(F.map_from_entries(F.collect_list(F.struct("grid_col", "value"))).alias("m"))
    cell = lambda c: F.coalesce(F.try_element_at("m", c), F.lit(nodata)).cast("string")
    made = rows.select("resource", "grid_row", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(ncols - 1)), cell), " ").alias("value"))
    each = pixels.select("resource").distinct()
    blank = " ".join([str(nodata)] * ncols)
    every = each.select("resource", F.explode(F.sequence(F.lit(0), F.lit(nrows - 1))).alias("grid_row")).join(made, ["resource", "grid_row"], "left").withColumn("value", F.coalesce("value", F.lit(blank)))
    header = (f"ncols {ncols}", f"nrows {nrows}", f"xllcorner {minx}", f"yllcorner {maxy - nrows * px}", f"cellsize {px}", f"NODATA_value {nodata}")
    heads = each.select("resource", F.posexplode(F.array(*map(F.lit, header))).alias("k", "value")).select("resource", (F.col("k") - len(header)).alias("grid_row"), "value")
    ordered = heads.unionByName(every).repartition("resource").sortWithinPartitions("resource", "grid_row")
    ordered.select("resource", "value").write.partitionBy("resource").text(path)


def scan_resources(spark: SparkSession, base: str, extension: str, mask: str | None) -> DataFrame:
    """Files below `base` with the extension: path (relative), bytes. Only listings are read, no contents. Without a mask (None)
    exactly one file is allowed."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{extension.lstrip('.')}").load(base)
    top = base.rstrip("/").split("://", 1)[-1].removeprefix("file:").lstrip("/")
    files = found.select(F.regexp_replace("path", r"^.*\Q" + top + r"\E/", "").alias("path"), F.col("length").alias("bytes"))
    if mask in (None, "None") and (n := files.limit(2).count()) != 1:
        raise ValueError(f"{'no' if not n else 'more than one'} file and no mask")
    return files
