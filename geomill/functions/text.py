"""Scalar functions over strings, dates and arrays. All are Spark column expressions.

A null input gives null unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST_YEAR, LAST_YEAR = 1000, 9999
INVARIANT_START, INVARIANT_END = 10000101, 99991231


def parse_years(years: Column, strict: bool = True) -> Column:
    """`a|a:b|!a|!a:b` read left to right into an array of years; empty or null means 1000..9999.

    `!` removes, a reversed range does nothing, duplicates stay. Malformed text is an error, or null unless `strict`.
    """
    tokens = F.split(years, r"\|")

    def step(found: Column, token: Column) -> Column:
        body = F.regexp_replace(token, "^!", "")
        low, high = F.substring_index(body, ":", 1).cast("int"), F.substring_index(body, ":", -1).cast("int")
        added = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
        return F.when(token.startswith("!"), F.filter(found, lambda y: (y < low) | (y > high))).otherwise(F.concat(found, added))

    valid = years.rlike(r"^!?\d+(:\d+)?(\|!?\d+(:\d+)?)*$")
    parsed = F.aggregate(tokens, F.array().cast("array<int>"), step)
    wrong = F.raise_error(F.concat(F.lit("malformed years: "), years)).cast("array<int>") if strict else F.lit(None).cast("array<int>")
    every = F.sequence(F.lit(FIRST_YEAR), F.lit(LAST_YEAR))
    return F.when(years.isNull() | (years == ""), every).when(valid, parsed).otherwise(wrong)


def mask_part(name: Column, mask: Column, letter: str) -> Column:
    """The digits of `name` at the positions where `mask` holds `letter`."""
    place = F.sequence(F.lit(1), F.least(F.length(name), F.length(mask)))
    chars = F.transform(place, lambda i: F.when(F.substring(mask, i, F.lit(1)) == letter, F.substring(name, i, F.lit(1))).otherwise(""))
    digits = F.array_join(F.filter(chars, lambda c: c.rlike("[0-9]")), "")
    return F.when((F.length(name) == 0) | (F.length(mask) == 0), "").otherwise(digits)


def mask_parts(name: Column, mask: Column) -> Column:
    """struct(year, month, day) of digits; empty where the mask has no such letter."""
    return F.struct(*(mask_part(name, mask, letter).alias(part) for part, letter in (("year", "Y"), ("month", "M"), ("day", "D"))))


def cut_parts(parts: Column) -> Column:
    """Year cut to 4, month to 2, day to 3 digits, for masks that repeat them in folder and file name."""
    return F.struct(*(F.substring(parts[p], 1, n).alias(p) for p, n in (("year", 4), ("month", 2), ("day", 3))))


def mask_kind(mask: Column, one_file: Column) -> Column:
    """struct(kind, problem): kind is invariant, year, year-month or year-day, or null with a problem."""
    y, m, d = mask.contains("YYYY"), mask.contains("MM"), mask.contains("DDD")
    kind = F.when(mask == "None", "invariant").when(y & m & ~d, "year-month").when(y & d & ~m, "year-day").when(y & ~m & ~d, "year")
    problem = (
        F.when(kind.isNull(), "mask not understood")
        .when((mask == "None") & ~one_file, "a folder needs a temporal mask")
        .when((mask != "None") & one_file, "one file takes no temporal mask")
    )
    return F.struct(F.when(problem.isNull(), kind).alias("kind"), problem.alias("problem"))


def validate_date(year: Column, month: Column, day: Column) -> Column:
    """struct(valid, message): 4-digit year; where given, 2-digit month, day of 2 digits with a month and 3 without."""
    given = lambda c: c.isNotNull() & (c != "")
    message = (
        F.when(~F.coalesce(year, F.lit("")).rlike("^[0-9]{4}$"), "invalid year")
        .when(given(month) & ~month.rlike("^[0-9]{2}$"), "invalid month")
        .when(given(month) & given(day) & ~day.rlike("^[0-9]{2}$"), "invalid day of month")
        .when(~given(month) & given(day) & ~day.rlike("^[0-9]{3}$"), "invalid day of year")
    )
    return F.struct(message.isNull().alias("valid"), message.alias("message"))


def _ymd(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("int")


def date_range(year: Column, month: Column, day: Column, drange: Column | int = 0) -> Column:
    """struct(start, end, type) as yyyymmdd: a day plus `drange` days, a whole month, or a whole year."""
    drange = F.lit(drange) if isinstance(drange, int) else drange
    has_m, has_d = F.coalesce(month, F.lit("")) != "", F.coalesce(day, F.lit("")) != ""
    y, m, d = (c.cast("int") for c in (year, month, day))
    january, first = F.make_date(y, F.lit(1), F.lit(1)), F.make_date(y, F.when(has_m, m).otherwise(1), F.lit(1))
    exact = F.when(has_m, F.date_add(first, d - 1)).otherwise(F.date_add(january, d - 1))
    start = F.when(has_d, exact).when(has_m, first).otherwise(january)
    end = F.when(has_d, F.date_add(exact, drange)).when(has_m, F.last_day(first)).otherwise(F.make_date(y, F.lit(12), F.lit(31)))
    # fixed values: the names of the date types
    kind = F.when(has_d & has_m, "year month day").when(has_d, "year day").when(has_m, "year month").otherwise("year")
    return F.struct(_ymd(start).alias("start"), _ymd(end).alias("end"), kind.alias("type"))


def clean_name(name: Column) -> Column:
    """Spaces to `_`, other characters than `[0-9a-zA-Z._-]` dropped, lower case; null when under 5 characters."""
    clean = F.lower(F.regexp_replace(F.replace(name, F.lit(" "), F.lit("_")), r"[^0-9a-zA-Z._-]", ""))
    return F.when(F.length(clean) >= 5, clean)


def category_key(label: Column) -> Column:
    return F.regexp_replace(F.lower(label), "[^0-9a-z]", "_")


# Fixed value: the pattern that cuts a preamble into title words (a capitalised word, or a run of capitals).
TITLE_WORDS = "[A-Z](?:[A-Z]*(?![a-z])|[a-z]*)"


def release_identity(preamble: Column, data_type: Column, level: Column, version: Column) -> Column:
    """struct(name, title_words): the release's name, and its preamble's words without AIMS."""
    name = F.format_string("%s_%s_%s_v%s", F.lower(preamble), F.lower(data_type), F.lower(level), F.replace(version, F.lit("."), F.lit("_")))
    words = F.array_remove(F.regexp_extract_all(preamble, F.lit(TITLE_WORDS), F.lit(0)), "AIMS")
    return F.struct(name.alias("name"), F.array_join(words, " ").alias("title_words"))


def boundary_identity(folders: DataFrame, countries: DataFrame) -> DataFrame:
    """From folder (`ISO_ADMn`), source (gadm or gb) and version: iso3, adm, name, group, group_class, active, country.
    The countries of the world are a small dimension, broadcast by Spark where under its threshold."""
    iso, adm = F.substring("folder", 1, 3), F.substring("folder", 5, 100)
    tail = F.when(F.col("source") == "gadm", F.concat(F.lit("gadm"), F.replace("version", F.lit("."), F.lit("")))).otherwise(F.concat(F.lit("gb_"), F.col("version")))
    top = F.lower("folder").contains("adm0")
    named = folders.select(
        "*",
        iso.alias("iso3"),
        F.substring(adm, -1, 1).cast("int").alias("adm"),
        F.concat_ws("_", F.lower(iso), F.lower(adm), tail).alias("name"),
        F.concat_ws("_", F.lower(iso), tail).alias("group"),
        F.when(top, "actual").otherwise("sub").alias("group_class"),
        F.when(top, -1).otherwise(1).alias("active"),
    )
    return named.join(countries.select("iso3", "country"), "iso3", "left")


def split_data_name(data: Column, classification: Column) -> Column:
    """struct(dataset, temporal): split at the last `_` if digits follow; a surface (msr) always loses its suffix."""
    digits = data.rlike("_[0-9]+$")
    head, tail = F.regexp_extract(data, "^(.*)_[^_]*$", 1), F.regexp_extract(data, "_([^_]*)$", 1)
    cut = digits | ((classification == "msr") & data.contains("_"))
    return F.struct(F.when(cut, head).otherwise(data).alias("dataset"), F.when(cut, tail).otherwise("na").alias("temporal"))


# Filter fields whose values are numbers.
NUMBER_FIELDS = ("transaction_year", "total_commitments", "total_disbursements")


def json_text(value: Column) -> Column:
    """A text as JSON in ASCII: quotes, backslashes and control characters escaped, all else beyond ASCII as UTF-16 units."""

    def escaped(char: Column) -> Column:
        units = F.lower(F.hex(F.encode(char, "UTF-16BE")))
        unicode = F.concat(F.lit("\\u"), F.substring(units, 1, 4), F.when(F.length(units) == 8, F.concat(F.lit("\\u"), F.substring(units, 5, 4))).otherwise(""))
        out = F.when(F.length(char) == 0, "")
        for plain, code in (('"', '\\"'), ("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\f", "\\f"), ("\b", "\\b")):
            out = out.when(char == plain, code)
        return out.when(char.between(" ", "~"), char).otherwise(unicode)

    chars = F.transform(F.sequence(F.lit(1), F.greatest(F.length(value), F.lit(1))), lambda i: escaped(F.substring(value, i, F.lit(1))))
    plain = value.rlike(r"^[ !#-\[\]-~]*\z")  # most texts: nothing to escape
    return F.concat(F.lit('"'), F.when(plain, value).otherwise(F.array_join(chars, "")), F.lit('"'))


def _json_list(values: Column, numbers: Column) -> Column:
    quoted = F.transform(values, lambda v: F.when(numbers & v.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), v).otherwise(json_text(v)))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def request_json(dataset: Column, filters: Column, resolution: Column, kind: Column, version: Column) -> Column:
    """The canonical JSON of a filter request in ASCII: sorted keys, `, ` and `: ` between. `filters` maps field -> array of strings;
    those of NUMBER_FIELDS are written as numbers."""
    fields = F.array_sort(F.map_keys(filters))
    inner = F.array_join(F.transform(fields, lambda k: F.concat(json_text(k), F.lit(": "), _json_list(F.element_at(filters, k), k.isin(*NUMBER_FIELDS)))), ", ")
    return F.concat(F.lit('{"dataset": '), json_text(dataset), F.lit(', "filters": {'), inner, F.lit('}, "resolution": '), resolution.cast("string"), F.lit(', "type": '), json_text(kind), F.lit(', "version": '), version.cast("string"), F.lit("}"))


def request_hash(dataset: Column, filters: Column, resolution: Column, kind: Column, version: Column) -> Column:
    """SHA-1 of the canonical JSON, so that equal filters share a result."""
    return F.sha1(request_json(dataset, filters, resolution, kind, version))


def geom_hash(geometry_text: Column) -> Column:
    return F.sha1(geometry_text)


def pipe_split(text: Column) -> Column:
    return F.split(text, r"\|")


def distinct_tokens(df: DataFrame, column: str) -> DataFrame:
    """The distinct tokens of a pipe-separated column, sorted."""
    return df.select(F.explode(pipe_split(F.col(column))).alias("token")).filter("token != ''").distinct().orderBy("token")


def clean_filters(filters: Column) -> Column:
    """A filter map (field -> array) without the fields whose values hold `All`, `None` or null."""
    return F.map_filter(filters, lambda k, v: ~F.exists(v, lambda x: x.isNull() | x.isin("All", "None")))


def sync_tag(df: DataFrame, names: DataFrame, tag: str = "featured") -> DataFrame:
    """Give `tag` to the rows whose name is listed, take it from all others."""
    listed = names.select(F.col("name").alias("_listed")).distinct()
    joined = df.join(listed, F.col("name") == F.col("_listed"), "left")
    without = F.array_remove("tags", tag)
    return joined.withColumn("tags", F.when(F.col("_listed").isNotNull(), F.array_union(without, F.array(F.lit(tag)))).otherwise(without)).drop("_listed")


def sync_active(df: DataFrame, inactive: DataFrame) -> DataFrame:
    """active becomes 0 for listed names and 1 for others; only values 0 and 1 change, forced ones (2, -1, -2) stay."""
    listed = inactive.select(F.col("name").alias("_listed")).distinct()
    joined = df.join(listed, F.col("name") == F.col("_listed"), "left")
    wanted = F.when(F.col("_listed").isNotNull(), 0).otherwise(1)
    return joined.withColumn("active", F.when(F.col("active").isin(0, 1), wanted).otherwise(F.col("active"))).drop("_listed")
