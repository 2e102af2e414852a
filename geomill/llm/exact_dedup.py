"""Operator 2: exact deduplication against an immutable snapshot, screened by binary fuse filters.

`build_snapshot` groups the digests of the rows already held, deals them into buckets by digest, and builds one
static 3-wise binary fuse filter per bucket. `exact_dedup` first groups the new batch's own duplicates by digest,
then asks the bucket's filter about each distinct digest; only positives are joined with the exact bucket, and
texts of one group are compared byte by byte with the text that stays. Texts whose digests agree but whose bytes
do not are grouped anew by the text itself.

Of equal texts the row with the largest doc_id stays. Defined cases: a null text is empty; a null doc_id is smaller
than any other; of repeated rows (same id and text) one stays; an empty table or snapshot gives an empty result or
no match; other columns are ignored, whatever their names. Groups are counted by partial aggregation, compared in salted shares of
`SHARE` rows, and told their answer by broadcast where they are large, so a group may hold any part of all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomill.llm.common import documents, files_for, join_uneven, staged, text_of

PER_BUCKET = 32_768  # digests a filter is built for
ROWS_PER_FILE = 1_000_000
SHARE = 2_048  # members of a group compared with one copy of its text
U64 = np.uint64


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


# ---- binary fuse filter ----


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys + U64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> U64(shift))) * U64(factor)
    return x ^ (x >> U64(31))


def _slots(hashes: np.ndarray, segment: int, span: int) -> np.ndarray:
    """Three slots per key, in three neighbouring segments: shape (3, keys)."""
    base = ((hashes >> U64(32)) * U64(span)) >> U64(32)
    mask = U64(segment - 1)
    second = (base + U64(segment)) ^ ((hashes >> U64(18)) & mask)
    third = (base + U64(2 * segment)) ^ (hashes & mask)
    return np.stack([base, second, third]).astype(np.int64)


def _fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (hashes ^ (hashes >> U64(32))).astype(np.uint16)


def build_fuse(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """(seed, segment length, span of first slots, 16-bit fingerprints) of a filter holding the distinct 64-bit `keys`.
    Keys are peeled in rounds: all slots that hold one key are freed at once, and filled in reverse."""
    n = max(len(keys), 2)
    segment = 1 << max(2, min(18, int(math.log(n) / math.log(3.33) + 2.25)))
    size = int(n * max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(n))) + 8
    span = max(1, math.ceil(size / segment) - 2) * segment
    for seed in range(1, 200):
        hashes = _mix(keys, seed)
        slots, total = _slots(hashes, segment, span), span + 2 * segment
        count = np.bincount(slots.ravel(), minlength=total)
        which = np.zeros(total, np.int64)  # exclusive or of the keys in a slot
        for row in slots:
            np.bitwise_xor.at(which, row, np.arange(len(keys)))
        rounds, left = [], len(keys)
        while left:
            single = np.flatnonzero(count == 1)
            if not len(single):
                break
            freed, first = np.unique(which[single], return_index=True)
            rounds.append((freed, single[first]))
            for row in slots[:, freed]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(which, row, freed)
            left -= len(freed)
        if left:
            continue
        table, marks = np.zeros(total, np.uint16), _fingerprint(hashes)
        for freed, slot in reversed(rounds):
            own = slots[:, freed]
            others = table[own[0]] ^ table[own[1]] ^ table[own[2]] ^ table[slot]
            table[slot] = marks[freed] ^ others
        return seed, segment, span, table
    raise ValueError("the keys are not distinct")


def fuse_holds(keys: np.ndarray, seed: int, segment: int, span: int, table: np.ndarray) -> np.ndarray:
    hashes = _mix(keys, seed)
    a, b, c = _slots(hashes, segment, span)
    return (table[a] ^ table[b] ^ table[c]) == _fingerprint(hashes)


def _keys(digests: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The first 8 bytes of each digest (shorter ones padded)."""
    raw = b"".join(d.as_py()[:8].ljust(8, b"\0") for d in digests)
    return np.frombuffer(raw, "<u8").copy()


# ---- snapshot ----


class Snapshot(NamedTuple):
    """Immutable: the texts held, their rows (digest, doc_id, copies), exact buckets (bucket, digest, keep_id, group_size) and
    the buckets' filters."""

    texts: DataFrame
    rows: DataFrame
    exact: DataFrame
    filters: DataFrame
    n_buckets: int

    def save(self, path: str) -> None:
        for name in ("texts", "rows", "exact", "filters"):
            getattr(self, name).write.parquet(f"{path}/{name}")
        self.texts.sparkSession.range(1).select(F.lit(self.n_buckets).alias("n_buckets")).write.parquet(f"{path}/layout")


def load_snapshot(spark: SparkSession, path: str) -> Snapshot:
    texts, rows, exact, filters = (spark.read.parquet(f"{path}/{name}") for name in ("texts", "rows", "exact", "filters"))
    return Snapshot(texts, rows, exact, filters, spark.read.parquet(f"{path}/layout").first().n_buckets)


def _buckets_for(digests: int) -> int:
    return max(1, math.ceil(digests / PER_BUCKET))


def _bucketed(groups: DataFrame, n_buckets: int) -> DataFrame:
    return groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(n_buckets)).cast("int"))


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))


def _build(group: pa.Table) -> pa.Table:
    seed, segment, span, table = build_fuse(np.unique(_keys(group["digest"])))
    return pa.table({"bucket": group["bucket"].slice(0, 1), "seed": pa.array([seed], pa.int64()), "segment": pa.array([segment], pa.int64()), "span": pa.array([span], pa.int64()), "fingerprints": pa.array([table.tobytes()], pa.binary())})


FILTERS = "bucket int, seed long, segment long, span long, fingerprints binary"


def build_snapshot(held: DataFrame, digest=digest_of) -> Snapshot:
    """From the documents (doc_id, text) that are held."""
    files = files_for(held.count(), ROWS_PER_FILE)
    rows = staged(_rows(held, digest), "held-rows", files)
    groups = staged(_grouped(rows), "snapshot-groups", files)
    n_buckets = _buckets_for(groups.count())
    exact = _bucketed(groups, n_buckets)
    filters = exact.select("bucket", "digest").groupBy("bucket").applyInArrow(_build, FILTERS)
    return Snapshot(held.select("doc_id", "text"), rows, exact, staged(filters, "snapshot-filters", files), n_buckets)


def _screen(asked: pa.Table, filters: pa.Table) -> pa.Table:
    if not filters.num_rows or not asked.num_rows:
        return asked.select(["digest"]).slice(0, 0)
    f = filters.to_pylist()[0]
    held = fuse_holds(_keys(asked["digest"]), f["seed"], f["segment"], f["span"], np.frombuffer(f["fingerprints"], np.uint16))
    return asked.select(["digest"]).filter(pa.array(held))


def screened(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The digests among `groups` that the snapshot's filters may hold (all that it holds, and about one in 65,536 others). Where
    more are asked than the buckets were dealt for, a bucket's digests are shared out and each share gets the filter."""
    shares = max(1, math.ceil(groups.count() / (snapshot.n_buckets * PER_BUCKET)))
    asked = _bucketed(groups.select("digest"), snapshot.n_buckets).withColumn("share", F.pmod(F.hash("digest"), F.lit(shares)))
    filters = snapshot.filters.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    return asked.groupBy("bucket", "share").cogroup(filters.groupBy("bucket", "share")).applyInArrow(_screen, "digest binary")


# ---- deduplication ----


def _rows(docs: DataFrame, digest) -> DataFrame:
    """One light row per (digest, doc_id) with its number of copies; repeated rows meet here."""
    light = docs.select("doc_id", digest(text_of()).alias("digest"))
    return light.groupBy("digest", "doc_id").agg(F.count("*").alias("copies"))


CELLS = 1 << 26  # bits of the map that picks the texts worth moving: 8 MB at any size of the tables


def _marked(texts: DataFrame, members: DataFrame) -> DataFrame:
    """The texts (own, digest, ...) whose digest falls into a marked cell of a bit map over the members' digests: all members, and few
    others while the map is sparse. The map is at most CELLS bits, in rows of 32,768, and is broadcast."""
    cell = F.pmod(F.xxhash64("digest"), F.lit(CELLS))
    marks = members.select(cell.alias("cell")).groupBy(F.bitmap_bucket_number("cell").alias("row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    placed = texts.withColumn("cell", cell).withColumn("row", F.bitmap_bucket_number("cell")).withColumn("bit", F.bitmap_bit_position("cell").cast("int"))
    octet = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.floor(octet / F.pow(F.lit(2), F.col("bit") % 8)) % 2 == 1
    return placed.join(F.broadcast(marks), "row").filter(marked).select(*texts.columns)


def _differing(texts: DataFrame, members: DataFrame) -> DataFrame:
    """The digests of groups (members: digest, doc_id, keep_id, group_size) in which some text (texts: id, own, digest) is not, byte
    for byte, the text that stays. Only texts of such groups are moved."""
    moved = _marked(texts, members).withColumnRenamed("digest", "d")
    joined = moved.join(members, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("d") == F.col("digest")))
    joined = joined.select("digest", "own", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("stays"), "id")
    shares = F.ceil(F.col("group_size") / SHARE).cast("int")
    stay = joined.filter("stays").groupBy("digest").agg(F.min("own").alias("kept_text"), F.max("own").alias("kept_other"), F.first("group_size").alias("group_size"))
    stay = stay.withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("group_size")
    dealt = joined.filter("NOT stays").withColumn("share", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), shares).cast("int"))
    return (
        dealt.select("digest", "share", "own").join(stay, ["digest", "share"])
        .filter((F.col("own") != F.col("kept_text")) | (F.col("kept_other") != F.col("kept_text"))).select("digest").distinct()
    )


def grouped_rows(batch: DataFrame, snapshot: Snapshot | None = None, digest=digest_of) -> DataFrame:
    """One row per (digest, doc_id) of the batch and the snapshot: digest, doc_id, copies, keep_id, group_size."""
    snapshot = snapshot or build_snapshot(batch.limit(0), digest)
    files = files_for(batch.count(), ROWS_PER_FILE)
    new = staged(_rows(batch, digest), "batch-rows", files)
    groups = staged(_grouped(new), "batch-groups", files)
    positive = screened(groups, snapshot)
    matched = groups.join(positive, "digest", "left_semi").join(snapshot.exact.select("digest", F.col("keep_id").alias("held_id"), F.col("group_size").alias("held_size")), "digest")
    matched = staged(matched.select("digest", F.greatest("keep_id", "held_id").alias("keep_id"), (F.col("group_size") + F.col("held_size")).alias("group_size")), "matched", files)
    only_new = groups.join(matched, "digest", "left_anti")
    only_old = snapshot.exact.select("digest", "keep_id", "group_size").join(matched, "digest", "left_anti")
    answer = matched.unionByName(only_new).unionByName(only_old)
    both = staged(new.unionByName(snapshot.rows).groupBy("digest", "doc_id").agg(F.sum("copies").alias("copies")), "all-rows", files)
    rows = staged(join_uneven(both, answer, "digest", "group_size", both.agg(F.sum("copies")).first()[0] or 0), "dedup-rows", files)

    docs = batch.select("doc_id", "text").unionByName(snapshot.texts)
    texts = docs.select(F.col("doc_id").alias("id"), text_of().alias("own"), digest(text_of()).alias("digest"))
    differ = staged(_differing(texts, rows.filter("group_size > 1").select("doc_id", "digest", "keep_id", "group_size")), "differing", files)
    if differ.isEmpty():
        return rows
    # digests of unequal texts met: their groups are formed by the texts
    apart = texts.join(differ, "digest", "left_semi").groupBy("digest", F.col("own").alias("text"), F.col("id").alias("doc_id")).agg(F.count("*").alias("copies"))
    again = apart.groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    again = apart.join(again, ["digest", "text"]).select(*rows.columns)
    return rows.join(differ, "digest", "left_anti").select(*again.columns).unionByName(again)


def exact_dedup(batch: DataFrame, snapshot: Snapshot | None = None, digest=digest_of) -> DataFrame:
    """One row per row of `batch` and of the documents in `snapshot`: doc_id, keep_id, group_size, kept, digest."""
    each = grouped_rows(batch, snapshot, digest).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long"))))
    return each.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "digest")


def halves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The new batch and the rows held before it, dealt by id: what a query over one table takes as its snapshot."""
    odd = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 1, F.lit(True))
    return docs.filter(odd), docs.filter(~odd)


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    batch, held = halves(docs)
    stays = grouped_rows(batch, build_snapshot(held)).filter("doc_id <=> keep_id").select(F.col("doc_id").alias("id"), "digest", "copies")
    own = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("own_id"), digest_of(text_of()).alias("own_digest"))
    kept = own.join(stays, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_digest") == F.col("digest")), "left_semi")
    if not stays.filter("copies > 1").isEmpty():
        kept = kept.dropDuplicates(["own_id", "own_digest"])
    return kept.select("doc.*")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, held = halves(documents(spark, sf_dir))
    return exact_dedup(batch, build_snapshot(held)).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
