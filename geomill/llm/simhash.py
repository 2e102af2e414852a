"""Operator 13: SimHash fingerprints of documents, and all fingerprints within a Hamming radius by permuted block tables.

A text's terms are its runs of TERM words (A-Z lower-cased; of fewer words the whole sequence), hashed to BITS bits; a term that occurs
n times votes with weight 1 + log2(n), for every bit that it has and against every bit that it lacks, and the fingerprint has the
bits with a positive sum. Likeness is the share of equal bits.

`within_radius` splits fingerprints into blocks. Two that differ in at most `radius` bits agree in at least blocks - radius whole
blocks, so there is one table for every choice of so many blocks, keyed by their bits (the fingerprint permuted so that they
lead). The number of blocks grows with the logarithm of the rows, so that a key stays rarer than a fingerprint is by chance. A pair is
counted in the first table that holds it only. Equal fingerprints are one entry with a count; entries of a crowded key are compared
block by block (`_mates`), and nothing leaves a task but a count per entry.

`with_next` gives each row the next row's text although texts are shuffled only once: rows are range-sorted, neighbours meet
inside a partition, and only each partition's first and last row go on to meet across its borders.

Defined cases: a null text is empty; a text without words has the fingerprint of no votes, all zeros; equal texts have equal
fingerprints; rows of one doc_id go by their text; a null doc_id comes last in descending order; one row alone is its own next
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomill.llm.common import documents, files_for, join_uneven, staged, text_of
from geomill.llm.words import mix, word_hashes

BITS, TERM, RADIUS = 64, 3, 3
PIECE, CROWD, ROWS_PER_FILE, ENTRIES_PER_TASK = 1 << 14, 2048, 500_000, 100_000
U64 = np.uint64

_places = np.random.Generator(np.random.PCG64(71_993)).integers(1, 1 << 63, TERM, dtype=np.uint64) * U64(2) + U64(1)


# ---- fingerprints ----


def terms(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of TERM words, repeated as they are."""
    width = min(TERM, len(words))
    if not width:
        return words
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total += words[k : len(words) - width + 1 + k] * _places[k]
    return mix(total)


def votes(items: np.ndarray) -> np.ndarray:
    """The sum of the weighted votes for each bit, the lowest first."""
    distinct, often = np.unique(items, return_counts=True)
    weights = 1 + np.log2(often)
    total = np.full(BITS, -weights.sum())
    for at in range(0, len(distinct), PIECE):
        bits = np.unpackbits(distinct[at : at + PIECE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += 2 * (weights[at : at + PIECE] @ bits)
    return total


def simhash(text: str | None) -> int:
    return int(np.packbits(votes(terms(word_hashes(text))) > 1e-9, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (a signed long of BITS bits) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(t) for t in batch["text"].to_pylist()], np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.int64())], ["doc_id", "fingerprint"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, "doc_id long, fingerprint long")


# ---- permuted block tables ----


def cuts(blocks: int) -> list[tuple[int, int]]:
    """(lowest bit, mask in place) of each block."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    return [(a, ((1 << b) - (1 << a))) for a, b in itertools.pairwise(edges)]


def tables(blocks: int, radius: int) -> list[int]:
    """The mask of the leading blocks of every table."""
    masks = [m for _, m in cuts(blocks)]
    return [sum(masks[k] for k in chosen) for chosen in itertools.combinations(range(blocks), blocks - radius)]


def blocks_for(rows: int, radius: int) -> int:
    """The fewest blocks whose keys have 4 bits more than the rows' number."""
    bits = math.log2(max(rows, 2)) + 4
    return next((b for b in range(radius + 1, 4 * radius + 2) if (b - radius) * BITS / b >= bits), 4 * radius + 1)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _mates(n: Column) -> Column:
    """An entry's block of its key's entries, and every pair of it with another block or itself: low, high, side."""
    parts = F.ceil(n / CROWD).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), parts).cast("int")
    return F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.struct(F.least(own, k).alias("low"), F.greatest(own, k).alias("high"), (own > k).cast("int").alias("side")))


def _counter(radius: int, masks: list[int]):
    keys = np.array(masks, np.uint64)

    def count(group: pa.Table) -> pa.Table:
        side, value, copies = (group[c].to_numpy() for c in ("side", "fingerprint", "copies"))
        table, same = group["table"][0].as_py(), group["low"][0].as_py() == group["high"][0].as_py()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))
        entries, rows = np.zeros(len(value), np.int64), np.zeros(len(value), np.int64)
        bits, earlier = value.view(np.uint64), keys[:table]
        for i in left:
            apart = bits[right] ^ bits[i]
            near = np.flatnonzero((np.bitwise_count(apart) <= radius) & (apart != 0))
            if len(near) and len(earlier):
                near = near[((apart[near][:, None] & earlier) != 0).all(axis=1)]  # no earlier table holds the pair
            entries[i] += len(near)
            rows[i] += copies[right[near]].sum()
            if not same:
                entries[right[near]] += 1
                rows[right[near]] += copies[i]
        found = entries > 0
        return pa.table({"fingerprint": value[found], "near": entries[found], "near_rows": rows[found]})

    return count


def within_radius(entries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fingerprint, near, near_rows: of each distinct fingerprint of entries (fingerprint, copies) that has any, the number of other
    fingerprints within `radius` bits, and the copies that these stand for. Stage `entries` first: they are read more than once."""
    n = entries.count()
    masks = tables(blocks_for(n, radius), radius)
    keyed = entries.select("fingerprint", "copies", F.posexplode(F.array(*(F.col("fingerprint").bitwiseAND(F.lit(_signed(m))) for m in masks))).alias("table", "key"))
    crowds = keyed.groupBy("table", "key").agg(F.count("*").alias("n")).filter("n > 1")
    crowds = staged(crowds.withColumn("id", F.xxhash64("table", "key")), "crowded-keys", files_for(n, ROWS_PER_FILE))
    met = join_uneven(keyed.withColumn("id", F.xxhash64("table", "key")).drop("table", "key"), crowds, "id", "n", n * len(masks))
    met = met.select("id", "table", "key", "fingerprint", "copies", F.explode(_mates(F.col("n"))).alias("m")).select("id", "table", "key", "fingerprint", "copies", "m.*")
    # comparing costs more than the few bytes of an entry tell, so entries are dealt by number
    met = met.repartition(files_for(n * len(masks), ENTRIES_PER_TASK), "table", "key", "low", "high")
    counted = met.groupBy("table", "key", "low", "high").applyInArrow(_counter(radius, masks), "fingerprint long, near long, near_rows long")
    return counted.groupBy("fingerprint").agg(F.sum("near").alias("near"), F.sum("near_rows").alias("near_rows"))


# ---- a row and the next one ----

EDGES = "doc_id long, n_chars long, edited_sha256 string, fingerprint long, edited_fingerprint long, next_fingerprint long, part int, text string, next string"


def edited(text: str, following: str) -> str:
    """The last third of `text` gives way to as much of the beginning of `following`."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def _compared(doc_id: int | None, text: str, own: int, following: str, of_next: int) -> tuple:
    changed = edited(text, following)
    return doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own, simhash(changed), of_next


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint of every row, the next row being that of the next smaller doc_id
    (of the smallest, the largest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, schema = TaskContext.get().partitionId(), None, EDGES_ARROW
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                own = simhash(text)
                if before is None:  # for the partition before
                    out.append((doc_id, None, None, own, None, None, part, None, text))
                else:
                    out.append((*_compared(*before, text, own), part, None, None))
                before = doc_id, text, own
            yield pa.RecordBatch.from_arrays([pa.array(signed(c, k), schema.field(k).type) for k, c in enumerate(zip(*out, strict=True))], schema=schema)
        if before is not None:
            yield pa.RecordBatch.from_arrays([pa.array(signed([v], k), schema.field(k).type) for k, v in enumerate((before[0], None, None, before[2], None, None, part, before[1], None))], schema=schema)

    def signed(column, k: int):
        return [None if v is None else _signed(v) for v in column] if k in (3, 4, 5) else list(column)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("hash", F.xxhash64("text")).withColumn("tie", F.monotonically_increasing_id())
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash")]
    dealt = plain.repartitionByRange(*order, F.col("tie")).sortWithinPartitions(*order, "text").select("doc_id", "text")
    rows = staged(dealt.mapInArrow(run, EDGES), "edited")
    firsts = rows.filter("next IS NOT NULL").select(F.col("part").alias("to"), "next", F.col("fingerprint").alias("next_fingerprint"))
    parts = sorted(r.part for r in rows.filter("text IS NOT NULL").select("part").collect())  # a number for each partition of the sort
    spark = docs.sparkSession
    follows = spark.createDataFrame([(a, b) for a, b in zip(parts, [*parts[1:], *parts[:1]], strict=True)], "part int, to int")
    borders = rows.filter("text IS NOT NULL").select("part", "doc_id", "text", "fingerprint").join(follows, "part").join(firsts, "to")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_compared(r["doc_id"], r["text"], r["fingerprint"] % (1 << 64), r["next"], r["next_fingerprint"] % (1 << 64)) for r in batch.to_pylist()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(signed(c, k), EDGES_ARROW.field(k).type) for k, c in enumerate(zip(*out, strict=True))], EDGES_ARROW.names[:6])

    inner = rows.filter("n_chars IS NOT NULL").select(*EDGES_ARROW.names[:6])
    return inner.unionByName(borders.mapInArrow(meet, EDGES.split(", part")[0]))


EDGES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.int64()), ("edited_fingerprint", pa.int64()),
    ("next_fingerprint", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("next", pa.string()),
])


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With `near_rows`: how many rows have another fingerprint within RADIUS bits of the row's."""
    rows = staged(with_next(documents(spark, sf_dir)), "fingerprints")
    entries = staged(rows.groupBy("fingerprint").agg(F.count("*").alias("copies")), "distinct-fingerprints")
    near = within_radius(entries).select("fingerprint", "near_rows")
    counts = entries.join(near, "fingerprint", "left").select("fingerprint", "copies", F.coalesce("near_rows", F.lit(0)).alias("near_rows"))
    counted = join_uneven(rows, staged(counts, "near-fingerprints"), "fingerprint", "copies", rows.count())
    text = lambda c: F.lower(F.lpad(F.hex(c), BITS // 4, "0"))
    like = lambda c: 1 - F.bit_count(F.col("fingerprint").bitwiseXOR(F.col(c))) / F.lit(float(BITS))
    return counted.select(
        "doc_id", "n_chars", "edited_sha256", text("fingerprint").alias("fingerprint"), text("edited_fingerprint").alias("edited_fingerprint"),
        like("edited_fingerprint").alias("near_edited"), like("next_fingerprint").alias("near_next"), "near_rows",
    )
