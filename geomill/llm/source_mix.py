"""Operator 4: mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source's mean repetition rate is its target weight times the size of the mix over its own size (characters).
Each document draws its number of copies by inverting the Poisson distribution of that mean at a uniform number
hashed from seed and doc_id: the number of k with P(X <= k) below the draw. Copies are exploded and then
shuffled globally by a hash of (seed, doc_id, copy). Nothing is random, so lost tasks give the same rows again.

A distribution is tabled from 12 standard deviations and 30 below its mean to as much above it (what lies outside is below
1e-30), by Stirling's series and a running sum, so a table grows with the root of its rate.

Weights default to each source's share of characters to the power `temperature`. The mix has `epochs` times the
characters of the corpus.

Defined cases: a null source is a source of its own (named `""` in `weights`); a null text is empty; a source that `weights`
leaves out gets no copies; other sources without characters get rate 1; rows of one id draw alike, and rows without id draw by
their text; an empty table gives an empty result; a column that has the name of an added one stays, and the added one gets one
more `_`. Tables go to the documents by a broadcast join while all of them hold at most MAX_BROADCAST numbers
(the only switch: it picks the join, not the rows), and by a join over salted keys beyond.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geomill.llm.common import documents, free_names, staged, text_of

TEMPERATURE, EPOCHS, SEED = 0.5, 1.0, 17
MAX_BROADCAST, SALTS = 1_000_000, 64  # numbers of 8 bytes
PER_TASK = 128_000_000  # characters of copies that a task sorts, on average
EXACT = 16  # factorials up to here are tabled, Stirling's series takes over beyond (it is exact to 1e-15 there)


def _bits(*parts: Column, digits: int = 13) -> Column:
    """The first hexadecimal digits of an md5 as a number (13 digits: 52 bits)."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, digits), 16, 10).cast("long")


def log_poisson(k: Column, rate: Column) -> Column:
    """The logarithm of P(X = k). For large k it is summed from small terms only: with d = (k - rate) / rate it is
    -rate * ((1 + d) * log(1 + d) - d) and what Stirling's series adds to k log k - k."""
    small = k * F.log(rate) - rate - F.element_at(F.array(*(F.lit(math.lgamma(j + 1.0)) for j in range(EXACT))), k.cast("int") + 1)
    d, x = (k - rate) / rate, k.cast("double")
    series = 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3))) + 1 / (1260 * F.pow(x, F.lit(5))) - 1 / (1680 * F.pow(x, F.lit(7)))
    return F.when(k < EXACT, small).otherwise(-rate * ((1 + d) * F.log1p(d) - d) - 0.5 * F.log(2 * math.pi * x) - series)


def repetition_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, epochs: float = EPOCHS) -> DataFrame:
    """One row per source: source_key, rate, least, chars (expected of all its copies),
    cdf (P(least <= X <= k) for k = least, least + 1, ...)."""
    spark = docs.sparkSession
    sizes = docs.groupBy(F.coalesce("source", F.lit("")).alias("source_key")).agg(F.sum(F.length(text_of())).cast("double").alias("chars"))
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow("chars", F.lit(temperature)))
    else:
        given = spark.createDataFrame(list(weights.items()), "source_key string, weight double")
        weighted = sizes.join(given, "source_key", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    totals = weighted.agg(F.sum("chars").alias("all_chars"), F.sum("weight").alias("all_weight"))
    asked = F.lit(True) if weights is None else F.col("weight") > 0
    rate = F.when(F.col("chars") == 0, F.when(asked, 1.0).otherwise(0.0)).otherwise(F.col("weight") / F.col("all_weight") * F.col("all_chars") * epochs / F.col("chars"))
    rates = weighted.crossJoin(F.broadcast(totals)).select("source_key", rate.alias("rate"), (rate * F.col("chars")).alias("chars"))  # totals: one row
    reach = 12 * F.sqrt("rate") + 30
    least, most = F.greatest(F.lit(0), F.floor(F.col("rate") - reach)), F.ceil(F.col("rate") + reach)
    k = rates.withColumn("least", least).withColumn("k", F.explode(F.sequence(F.col("least"), F.when(F.col("rate") > 0, most).otherwise(F.col("least")))))
    p = F.when(F.col("rate") > 0, F.exp(log_poisson(F.col("k"), F.col("rate")))).otherwise(F.lit(1.0))
    up_to = Window.partitionBy("source_key").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    summed = k.withColumn("cdf", F.sum(p).over(up_to))
    table = F.transform(F.array_sort(F.collect_list(F.struct("k", "cdf"))), lambda s: s["cdf"])
    return summed.groupBy("source_key", "rate", "least", "chars").agg(table.alias("cdf"))


def _copies(docs: DataFrame, weights: dict[str, float] | None, temperature: float, epochs: float, seed: int) -> DataFrame:
    """doc (the row as a struct), copy, n_copies, shuffle_key."""
    rates = staged(repetition_rates(docs, weights, temperature, epochs), "source-rates")
    size, chars = rates.agg(F.sum(F.size("cdf") + 2), F.sum("chars")).first()
    size, chars = size or 0, chars or 0.0
    digest = F.concat(F.lit("text:"), F.md5(text_of().cast("binary")))
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce("source", F.lit("")).alias("source_key"), F.coalesce(F.col("doc_id").cast("string"), digest).alias("doc_key"))
    rates = rates.drop("rate", "chars")
    if size <= MAX_BROADCAST:
        joined = rows.join(F.broadcast(rates), "source_key")
    else:
        salted = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("doc_key"), F.lit(SALTS)).cast("int")).join(salted, ["source_key", "salt"])
    draw = (_bits(F.lit(f"count{seed}"), F.col("doc_key")) + 0.5) / float(1 << 52)
    drawn = joined.withColumn("draw", draw)
    n_copies = F.size(F.filter("cdf", lambda c: c < F.col("draw"))).cast("long")
    drawn = drawn.select("doc", "doc_key", (F.col("least") + n_copies).alias("n_copies")).filter("n_copies > 0")
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_copies") - 1)))
    copies = copies.withColumn("shuffle_key", _bits(F.lit(f"place{seed}"), F.col("doc_key"), F.col("copy").cast("string"), digits=15)).drop("doc_key")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(chars / PER_TASK))
    return copies.repartition(parts, "shuffle_key").sortWithinPartitions("shuffle_key")


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, epochs: float = EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixed corpus: all columns of `docs`, and _copy, _n_copies, _shuffle_key."""
    names = free_names(docs.columns, "_copy", "_n_copies", "_shuffle_key")
    added = [F.col(c).alias(n) for c, n in zip(("copy", "n_copies", "shuffle_key"), names, strict=True)]
    return _copies(docs, weights, temperature, epochs, seed).select("doc.*", *added)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of the mix, with the digest of the text that it carries."""
    return mix_sources(documents(spark, sf_dir)).select(
        "doc_id", "source", F.col("_copy").alias("copy"), F.col("_n_copies").alias("n_copies"), F.col("_shuffle_key").alias("shuffle_key"), F.sha2(text_of(), 256).alias("text_sha256")
    )


ORACLE = f"""
WITH d AS (SELECT *, coalesce(source, '') AS k, coalesce(text, '') AS t, coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS id FROM documents),
s AS (SELECT k, sum(length(t))::DOUBLE AS chars, pow(sum(length(t))::DOUBLE, {TEMPERATURE}) AS weight FROM d GROUP BY k),
r AS (SELECT k, CASE WHEN chars = 0 THEN 1.0 ELSE weight / sum(weight) OVER () * sum(chars) OVER () * {EPOCHS} / chars END AS rate FROM s),
c AS (SELECT k, n, sum(exp(CASE WHEN n = 0 THEN 0 ELSE n * ln(rate) END - rate - lgamma(n + 1.0))) OVER (PARTITION BY k ORDER BY n) AS cdf
  FROM (SELECT k, rate, unnest(range(ceil(rate + 12 * sqrt(rate) + 31)::BIGINT)) AS n FROM r)),
u AS (SELECT d.*, (('0x' || md5('count{SEED}:' || id)[1:13])::BIGINT + 0.5) / 4503599627370496.0 AS draw FROM d),
n AS (SELECT u.doc_id, u.source, u.id, u.t, (SELECT count(*) FROM c WHERE c.k = u.k AND c.cdf < u.draw) AS n_copies FROM u)
SELECT doc_id, source, copy, n_copies, ('0x' || md5('place{SEED}:' || id || ':' || copy)[1:15])::BIGINT AS shuffle_key, sha256(t) AS text_sha256
FROM (SELECT *, unnest(range(n_copies)) AS copy FROM n)
"""
