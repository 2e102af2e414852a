"""Operator 1: token ids in blocks coded by a static range asymmetric numeral system (rANS).

Documents are ordered by doc_id (a range shuffle), encoded, and closed by an end id. One frequency table, counted
over all ids and scaled to 2**20, is shared by every block. A stored row ("segment") holds whole consecutive
documents: at most BLOCK ids to a block, LANES interleaved 64-bit states to a block that emit 32-bit words into
one stream. Every CHECKPOINT steps the states and the stream position are stored, with a checksum of the ids up to
the next checkpoint, so decoding starts at all checkpoints of all blocks at once, and any one can be read alone.

A file set is two tables: `segments` (start, n_tokens, doc_ids, doc_tokens, shape, states, offsets, checksums,
words) and `table` (token, frequency). `start` counts ids before the segment over the whole set.

Defined cases: a null text is empty (its end id alone); a null doc_id sorts first; rows of one doc_id (or of none) follow one another by
a hash of their texts, so that however many they are they can be dealt over partitions;
an empty table gives an empty file set; other columns are ignored, whatever their names. A text is encoded whole; a very long one makes a
segment of its own with more blocks.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geomill.llm import bpe
from geomill.llm.common import documents, shared_dir, staged, text_of

SCALE, LOW = 20, 1 << 31  # frequencies sum to 2**SCALE; states stay in [LOW, LOW * 2**32)
LANES, BLOCK, CHECKPOINT, SEGMENT = 64, 65_536, 256, 2_000_000
U64 = np.uint64
SEGMENTS = "start long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, shape array<int>, states binary, offsets binary, checksums binary, words binary"


# ---- the coder ----


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE, at least 1 for every id that occurs."""
    total, occurs = 1 << SCALE, counts > 0
    freq = np.where(occurs, np.maximum(1, np.round(counts * (total / max(1, counts.sum())))), 0).astype(np.int64)
    order = np.argsort(-freq, kind="stable")
    while excess := int(freq.sum()) - total:
        head = order[freq[order] > 1][: max(1, abs(excess) // 8 + 1)] if excess > 0 else order[:1]
        freq[head] -= np.minimum(np.maximum(1, excess // len(head)), freq[head] - 1) if excess > 0 else excess
    return freq


class Coder:
    def __init__(self, freq: np.ndarray) -> None:
        self.freq = freq.astype(np.uint64)
        self.first = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray, lanes: int = LANES, block: int = BLOCK, checkpoint: int = CHECKPOINT) -> dict:
        blocks = max(1, -(-len(ids) // block))
        steps = max(1, -(-len(ids) // (blocks * lanes)))
        parts = -(-steps // checkpoint)
        per_part = -(-steps // parts)
        steps = parts * per_part
        padded = np.full(blocks * steps * lanes, ids[0] if len(ids) else np.flatnonzero(self.freq)[0], np.int64)
        padded[: len(ids)] = ids
        grid = np.ascontiguousarray(padded.reshape(blocks, steps, lanes).transpose(1, 0, 2))
        x = np.full((blocks, lanes), LOW, np.uint64)
        emitted, values = np.zeros(grid.shape, bool), np.zeros(grid.shape, np.uint32)
        states = np.zeros((parts, blocks, lanes), np.uint64)
        for t in range(steps - 1, -1, -1):
            f = self.freq[grid[t]]
            full = x >= (f << U64(63 - SCALE))
            emitted[t], values[t] = full, x & U64(0xFFFFFFFF)
            x = np.where(full, x >> U64(32), x)
            q = x // f
            x = (q << U64(SCALE)) + (x - q * f) + self.first[grid[t]]
            if t % per_part == 0:
                states[t // per_part] = x
        emitted, values = emitted.transpose(1, 0, 2), values.transpose(1, 0, 2)
        each = emitted.reshape(blocks * parts, per_part * lanes).sum(axis=1)
        tokens = padded.astype("<u4").reshape(blocks * parts, per_part * lanes)
        return {
            "shape": [blocks, parts, per_part, lanes],
            "states": states.transpose(1, 0, 2).astype("<u8").tobytes(),
            "offsets": (np.cumsum(each) - each).astype("<u8").tobytes(),
            "checksums": np.array([zlib.crc32(row) for row in tokens], "<u4").tobytes(),
            "words": values[emitted].astype("<u4").tobytes(),
        }

    def decode(self, coded: dict, n: int) -> np.ndarray:
        """All n ids."""
        blocks, parts, _, _ = coded["shape"]
        return self.decode_parts(coded, np.arange(blocks * parts)).ravel()[:n]

    def decode_parts(self, coded: dict, chosen: np.ndarray) -> np.ndarray:
        """The ids after the chosen checkpoints (numbered through all blocks), one row each, read from these on their own. The last
        ones hold padding after the segment's last id."""
        blocks, parts, per_part, lanes = coded["shape"]
        rows = len(chosen)
        x = np.frombuffer(coded["states"], "<u8").reshape(blocks * parts, lanes)[chosen].astype(np.uint64)
        at = np.frombuffer(coded["offsets"], "<u8")[chosen].astype(np.int64)
        words = np.append(np.frombuffer(coded["words"], "<u4").astype(np.uint64), U64(0))
        out = np.zeros((per_part, rows, lanes), np.uint32)
        mask = U64((1 << SCALE) - 1)
        for t in range(per_part):
            slot = x & mask
            s = out[t] = self.symbol[slot.astype(np.int64)]
            x = self.freq[s] * (x >> U64(SCALE)) + slot - self.first[s]
            low = x < U64(LOW)
            place = at[:, None] + np.cumsum(low, axis=1) - 1
            at += low.sum(axis=1)
            x = np.where(low, (x << U64(32)) | words[np.where(low, place, 0)], x)
        tokens = np.ascontiguousarray(out.transpose(1, 0, 2)).reshape(rows, per_part * lanes).astype("<u4")
        if [zlib.crc32(row) for row in tokens] != np.frombuffer(coded["checksums"], "<u4")[chosen].tolist():
            raise ValueError("a block is damaged: its checksum differs")
        return tokens

    def decode_range(self, coded: dict, start: int, stop: int) -> np.ndarray:
        """Ids start..stop - 1 of a segment, from the checkpoints that cover them only."""
        size = coded["shape"][2] * coded["shape"][3]
        chosen = np.arange(start // size, -(-stop // size))
        return self.decode_parts(coded, chosen).ravel()[start - start // size * size :][: stop - start]


# ---- writing ----


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """In ascending doc_id order: part, at (ids before it in the part), doc_id, n_tokens, ids. A sample of
    every batch is encoded by both encoders, and the whole batch by the tokenizers library should they differ."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, at = bpe.load(tokenizer), 0
        end = np.array([end_id], model.dtype)
        for batch in batches:
            ids = [np.concatenate([i, end]) for i in model.encode_all(batch["text"].to_pylist())]
            lengths = np.array(list(map(len, ids)), np.int64)
            before = at + np.cumsum(lengths) - lengths
            at += int(lengths.sum())
            yield pa.RecordBatch.from_arrays([batch["part"], pa.array(before), batch["doc_id"], pa.array(lengths), pa.array([i.tobytes() for i in ids], pa.binary())], ["part", "at", "doc_id", "n_tokens", "ids"])

    ordered = docs.select("doc_id", text_of().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash", "text")
    return ordered.withColumn("part", F.spark_partition_id()).mapInArrow(encode, "part int, at long, doc_id long, n_tokens long, ids binary")


def id_counts(tokens: DataFrame, dtype: str) -> DataFrame:
    """token, n: over all ids, summed within tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            own = np.bincount(np.frombuffer(b"".join(batch["ids"].to_pylist()), dtype))
            if len(own) > len(total):
                total, own = own, total
            total[: len(own)] += own
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["token", "n"])

    return tokens.select("ids").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Write the file set. The driver holds one number per id of the vocabulary and one per partition."""
    spark, model = docs.sparkSession, bpe.load(tokenizer)
    dtype, size = model.dtype.str, model.size
    tokens = staged(tokenized(docs, tokenizer, end_id), "tokens")
    counts = np.zeros(size, np.int64)
    for row in id_counts(tokens, dtype).collect():
        counts[row.token] = row.n
    freq = scaled(counts) if counts.any() else counts
    kept = [(int(t), int(freq[t])) for t in np.flatnonzero(freq)]
    spark.createDataFrame(kept, "token long, frequency long").coalesce(1).write.parquet(f"{path}/table")
    sizes = sorted((row.part, row.n) for row in tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before = dict(zip([p for p, _ in sizes], np.cumsum([0, *(n for _, n in sizes)]).tolist(), strict=False))
    shared = spark.sparkContext.broadcast((freq, before))  # bounded by the vocabulary and the number of partitions

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq, before = shared.value
        coder, held, n, goes_on = Coder(freq), [], 0, None

        def coded() -> pa.RecordBatch:
            part, at = held[0][:2]
            ids = np.frombuffer(b"".join(h[4] for h in held), dtype)
            row = {"start": before[part] + at, "n_tokens": len(ids), "doc_ids": [h[2] for h in held], "doc_tokens": [h[3] for h in held]} | coder.encode(ids)
            return pa.RecordBatch.from_pylist([row], schema=SEGMENTS_ARROW)

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("part", "at", "doc_id", "n_tokens", "ids")), strict=True):
                if held and (row[:2] != goes_on or n + row[3] > SEGMENT):
                    yield coded()
                    held, n = [], 0
                held.append(row)
                n += row[3]
                goes_on = (row[0], row[1] + row[3])
        if held:
            yield coded()

    tokens.mapInArrow(segments, SEGMENTS).write.option("compression", "none").parquet(f"{path}/segments")


SEGMENTS_ARROW = pa.schema([
    ("start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
    ("shape", pa.list_(pa.int32())), ("states", pa.binary()), ("offsets", pa.binary()), ("checksums", pa.binary()), ("words", pa.binary()),
])


# ---- reading ----


def read_tokens(spark: SparkSession, path: str, reduce, schema: str) -> DataFrame:
    """`reduce(doc_id, start, ids)` of every document of a file set; ids is a little-endian unsigned 32-bit array."""
    table = spark.read.parquet(f"{path}/table").collect()  # at most the vocabulary
    freq = np.zeros(max([r.token for r in table], default=0) + 1, np.int64)
    for r in table:
        freq[r.token] = r.frequency
    shared = spark.sparkContext.broadcast(freq)
    names = [c.split()[0] for c in schema.split(", ")]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids, at, out = coder.decode(row, row["n_tokens"]), 0, []
                for doc_id, n in zip(row["doc_ids"], row["doc_tokens"], strict=True):
                    out.append(reduce(doc_id, row["start"] + at, ids[at : at + n]))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    return spark.read.schema(SEGMENTS).parquet(f"{path}/segments").mapInArrow(decode, schema)


def _digest(doc_id: int, start: int, ids: np.ndarray) -> tuple:
    return doc_id, start, len(ids), zlib.crc32(np.ascontiguousarray(ids))


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path, _digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
