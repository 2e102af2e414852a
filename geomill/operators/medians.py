"""Exact medians of groups of any size, by rounds of histograms.

Each group has an interval that holds the value in its middle. A round counts the group's values in BINS equal parts of the
interval, which Spark sums within tasks first, and keeps the part that holds the middle; when a part holds KEEP values at most, or one value only, these
are gathered. No task ever holds a group's values, and a round reads the values once for all groups together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomill.sources.tables import staged

BINS, KEEP = 1024, 2048
LARGEST = 1.7976931348623157e308


def _part(value: Column, low: Column, high: Column) -> Column:
    """The number of a value's part of [low, high]: 0 for `low`, the last for `high`, never falling in between. Halves do not overflow."""
    low, high = F.greatest(low, F.lit(-LARGEST)), F.least(high, F.lit(LARGEST))
    width = high / 2 - low / 2
    share = F.least(F.lit(float(BINS - 1)), F.greatest(F.lit(0.0), (F.least(high, F.greatest(low, value)) / 2 - low / 2) / width * BINS))
    return F.when(width > 0, F.floor(share)).when(value > low, 1).otherwise(0).cast("int")


def medians(values: DataFrame, *keys: str, value: str = "value") -> DataFrame:
    """keys, median of each group: of an even number the mean of the two middle values. Null and NaN values do not count; a group
    without others has no row. Stage `values` first: each round reads them."""
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    same = reduce(lambda a, b: a & b, on)
    named = lambda df: df.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    data = values.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL AND NOT isnan(_v)").withColumn("_v", F.col("_v") + 0.0)
    open_ = data.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    # below: values under the interval; held: values in it; middle: the number of the lower middle value
    open_ = staged(open_.select(*keys, "n", "low", "high", F.lit(0).cast("long").alias("below"), F.col("n").alias("held"), F.floor((F.col("n") - 1) / 2).alias("middle")), "intervals")
    done = []
    while True:
        ready = (F.col("held") <= KEEP) | (F.col("low") == F.col("high"))
        done.append(open_.filter(ready))
        wide = open_.filter(~ready)
        if wide.isEmpty():
            break
        inside = data.join(named(wide), same).filter("_v >= low AND _v <= high").withColumn("part", _part(F.col("_v"), F.col("low"), F.col("high")))
        counts = inside.groupBy(*keys, "part").agg(F.count("*").alias("c"), F.min("_v").alias("a"), F.max("_v").alias("b"))
        parts = counts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("part", "c", "a", "b"))).alias("parts"))  # BINS at most
        found = named(wide).join(parts, same).select(*keys, "n", "below", "middle", "parts")
        start = F.struct(F.col("below").alias("below"), F.lit(None).cast("struct<part:int,c:bigint,a:double,b:double>").alias("hit"))
        step = lambda s, p: F.when(s["hit"].isNotNull(), s).when(s["below"] + p["c"] > F.col("middle"), F.struct(s["below"].alias("below"), p.alias("hit"))).otherwise(F.struct((s["below"] + p["c"]).alias("below"), s["hit"].alias("hit")))
        found = found.withColumn("at", F.aggregate("parts", start, step))
        open_ = staged(found.select(*keys, "n", F.col("at.hit.a").alias("low"), F.col("at.hit.b").alias("high"), F.col("at.below").alias("below"), F.col("at.hit.c").alias("held"), "middle"), "intervals")
    ended = staged(reduce(DataFrame.unionByName, done), "intervals")
    few = data.join(named(ended.filter("low < high")), same).filter("_v >= low AND _v <= high").groupBy(*keys).agg(F.array_sort(F.collect_list("_v")).alias("kept"))
    after = data.join(named(ended), same).filter("_v > high").groupBy(*keys).agg(F.min("_v").alias("next"))
    met = named(ended).join(few, same, "left").select(*(F.col(f"_k_{k}").alias(k) for k in keys), "n", "low", "below", "held", "middle", "kept")
    met = named(met).join(after, same, "left").select(*(F.col(f"_k_{k}").alias(k) for k in keys), "n", "low", "below", "held", "middle", "kept", "next")
    nth = lambda k: F.when(k - F.col("below") >= F.col("held"), F.col("next")).when(F.col("kept").isNull(), F.col("low")).otherwise(F.get("kept", (k - F.col("below")).cast("int")))
    lower, upper = nth(F.col("middle")), nth(F.floor(F.col("n") / 2))
    return met.select(*keys, F.when(lower == upper, lower).otherwise(lower / 2 + upper / 2).alias("median"))
