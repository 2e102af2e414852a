"""Operator 3: BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over 32 bytes cuts each distinct text into chunks of about 1 KB, at places that depend on the
content alone, so that a passage shared by documents gives the same chunks in each. Chunks that occur more than
once are encoded once, by the document that owns their first occurrence, and their ids are joined back to all
others; every other chunk is encoded where it stands. Then the joins are repaired: from the last safe place
before a join to the first safe place after it the text is encoded again. A place is safe where a space or line
feed follows a visible ASCII character: pre-tokenization always splits there and looks no further back, so both
encodings agree exactly from there on. Where the ids on the two sides do not meet a safe place, the repaired span
widens until they do, at the latest over the whole text.

Ids equal those of the tokenizers library on the whole text. Decoding joins the tokens' bytes and replaces
malformed UTF-8, as the library does with skip_special_tokens=False.

Defined cases: a null text is empty (no ids); equal texts and repeated rows share one encoding; an empty table gives
an empty result; other columns are ignored, whatever their names. Texts travel once, compressed, by digest; chunks and texts
that hold over a 1 / MOST part of all places or rows, so fewer than MOST, reach them by broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geomill.llm import bpe
from geomill.llm.common import documents, join_uneven, staged, text_of

WINDOW, SHORTEST, LONGEST, CUT_BITS = 32, 256, 16_384, 10
MOST = 512
_KEY = 16  # bytes of a chunk's digest

_gear = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte, a polynomial hash of the up to 32 bytes that end there."""
    h, width, factor = _gear[data], 1, 0x9E3779B1
    while width < WINDOW:
        h[width:] += h[:-width].copy() * np.uint32(factor)
        width, factor = 2 * width, factor * factor & 0xFFFFFFFF
    return h


def cuts(data: bytes) -> list[int]:
    """Where chunks end, the length of the text last; always between characters."""
    n, ends, last = len(data), [], 0
    if n > SHORTEST:
        raw = np.frombuffer(data, np.uint8)
        found = np.flatnonzero(rolling_hash(raw) >> np.uint32(32 - CUT_BITS) == 0) + 1
        for at in [*found.tolist(), n]:
            while at - last > LONGEST:
                last = _whole(data, last + LONGEST)
                ends.append(last)
            at = _whole(data, at)
            if at - last >= SHORTEST and at < n:
                ends.append(at)
                last = at
    return [*ends, n] if n else []


def _whole(data: bytes, at: int) -> int:
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


def safe_places(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    inside = ((raw[1:] == 0x20) | (raw[1:] == 0x0A)) & (raw[:-1] > 0x20) & (raw[:-1] < 0x7F)
    return np.concatenate([[0], np.flatnonzero(inside) + 1, [len(data)]])


def joined_ids(model: bpe.Bpe, data: bytes, ends: list[int], chunk_ids: list[np.ndarray]) -> np.ndarray:
    """The ids of the whole text from those of its chunks."""
    if len(ends) < 2:
        return chunk_ids[0] if chunk_ids else np.zeros(0, model.dtype)
    safe, joins = safe_places(data), np.array(ends[:-1])
    left = safe[np.searchsorted(safe, joins, "right") - 1]
    right = safe[np.searchsorted(safe, joins, "left")]
    starts, pieces, at, k = [0, *ends[:-1]], [], 0, 0
    offsets = [np.concatenate([[0], np.cumsum(model.token_chars[ids])]) for ids in chunk_ids]

    def own(begin: int, end: int) -> bool:
        """Take ids from the chunk that holds begin..end, if its tokens meet both places."""
        c = int(np.searchsorted(joins, begin, "right"))
        a, b = np.searchsorted(offsets[c], [begin - starts[c], end - starts[c]])
        if b >= len(offsets[c]) or offsets[c][a] != begin - starts[c] or offsets[c][b] != end - starts[c]:
            return False
        pieces.append(chunk_ids[c][a:b])
        return True

    while k < len(joins):
        begin, end = int(left[k]), int(right[k])
        k += 1
        while k < len(joins) and left[k] < end:
            end = max(end, int(right[k]))
            k += 1
        if begin > at and not own(at, begin):
            return model.encode(data.decode())
        if end > begin:
            pieces.append(model.encode(data[begin:end].decode()))
        at = end
    if at < len(data) and not own(at, len(data)):
        return model.encode(data.decode())
    return np.concatenate(pieces)


# ---- the plan ----


def _chunk_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """digest, digests of the text's chunks in order."""
    for batch in batches:
        keys = []
        for text in batch["text"].to_pylist():
            data, start, own = text.encode(), 0, []
            for end in cuts(data):
                own.append(hashlib.blake2b(data[start:end], digest_size=_KEY).digest())
                start = end
            keys.append(own)
        yield pa.RecordBatch.from_arrays([batch["digest"], pa.array(keys, pa.list_(pa.binary()))], ["digest", "chunks"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(3)
    for batch in batches:
        packed = [pack.compress(t.as_py().encode()) for t in batch["text"]]
        yield pa.RecordBatch.from_arrays([batch["digest"], pa.array(packed, pa.binary())], ["digest", "packed"])


class _Encoder:
    """What both passes do with one text in a task."""

    def __init__(self, tokenizer: str, reduce, schema: list[tuple[str, pa.DataType]]) -> None:
        self.model, self.reduce = bpe.load(tokenizer), reduce
        self.unpack, self.pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(3)
        self.schema = pa.schema(schema)

    def chunk(self, data: bytes, ends: list[int], at: int) -> np.ndarray:
        return self.model.encode(data[ends[at - 1] if at else 0 : ends[at]].decode())

    def result(self, digest: bytes, copies: int, data: bytes, ends: list[int], known: dict[int, np.ndarray]) -> dict:
        ids = [known[k] if k in known else self.chunk(data, ends, k) for k in range(len(ends))]
        return {"digest": digest, "copies": copies, "n_chunks": len(ends), "n_shared_chunks": len(known)} | self.reduce(self.model, joined_ids(self.model, data, ends, ids))


def _first_pass(tokenizer: str, reduce, schema: list[tuple[str, pa.DataType]]):
    """A result for every text all of whose chunks are its own; the ids of the shared chunks that a text owns; and the
    texts that wait for chunks of others, as they came."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(tokenizer, reduce, schema)
        for batch in batches:
            out = []
            for digest, copies, packed, marks in zip(batch["digest"].to_pylist(), batch["copies"].to_pylist(), batch["packed"], batch["marks"].to_pylist(), strict=True):
                packed, marks = packed.as_py(), marks or []
                data = encoder.unpack.decompress(packed)
                ends = cuts(data)
                known = {m["at"]: encoder.chunk(data, ends, m["at"]) for m in marks if m["owned"]}
                out += [{"chunk": m["chunk"], "n": m["n"], "ids": encoder.pack.compress(known[m["at"]].tobytes())} for m in marks if m["owned"]]
                out.append({"digest": digest, "copies": copies, "packed": packed} if len(known) < len(marks) else encoder.result(digest, copies, data, ends, known))
            yield pa.RecordBatch.from_pylist(out, schema=encoder.schema)

    return run


def _second_pass(tokenizer: str, reduce, schema: list[tuple[str, pa.DataType]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(tokenizer, reduce, schema)
        for batch in batches:
            out = []
            for digest, copies, packed, shared in zip(batch["digest"].to_pylist(), batch["copies"].to_pylist(), batch["packed"], batch["shared"].to_pylist(), strict=True):
                data = encoder.unpack.decompress(packed.as_py())
                known = {s["at"]: np.frombuffer(encoder.unpack.decompress(s["ids"]), encoder.model.dtype) for s in shared}
                out.append(encoder.result(digest, copies, data, cuts(data), known))
            yield pa.RecordBatch.from_pylist(out, schema=encoder.schema)

    return run


def encode_texts(docs: DataFrame, tokenizer: str, reduce, schema: str) -> DataFrame:
    """One row per row of `docs`: doc_id, the columns that `reduce(model, ids)` gives as a dict for the text's ids (named and
    typed by `schema`), n_chunks and n_shared_chunks.

    Texts are shuffled once, packed, by digest; only those that wait for a chunk of another text (they hold one that is
    shared and not theirs) are shuffled again. Chunk digests, not chunks, are grouped to find what is shared."""
    rows = docs.select("doc_id", text_of().alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    lists = rows.select("digest", "text").mapInArrow(_chunk_keys, "digest binary, chunks array<binary>").groupBy("digest").agg(F.first("chunks").alias("chunks"))
    lists = staged(lists, "chunk-lists")
    places = lists.select("digest", F.posexplode("chunks").alias("at", "chunk"))
    n_places = lists.agg(F.sum(F.size("chunks"))).first()[0] or 0
    shared = places.groupBy("chunk").agg(F.count("*").alias("n"), F.min(F.struct("digest", "at")).alias("owner")).filter("n > 1")
    owned = (F.col("owner.digest") == F.col("digest")) & (F.col("owner.at") == F.col("at"))
    met = join_uneven(places, shared, "chunk", "n", n_places, MOST)
    marks = met.groupBy("digest").agg(F.collect_list(F.struct("at", "chunk", "n", owned.alias("owned"))).alias("marks"))
    texts = rows.select("digest", "text").mapInArrow(_packed, "digest binary, packed binary").groupBy("digest").agg(F.first("packed").alias("packed"), F.count("*").alias("copies"))

    results = f"digest binary, copies long, n_chunks long, n_shared_chunks long, {schema}"
    kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    typed = lambda s: [(n, kinds[k]) for n, k in map(str.split, s.split(", "))]
    extra = "packed binary, chunk binary, n long, ids binary"
    first = texts.join(marks, "digest", "left").mapInArrow(_first_pass(tokenizer, reduce, typed(f"{results}, {extra}")), f"{results}, {extra}")
    first = staged(first, "first-pass")
    given = join_uneven(places, first.filter("chunk IS NOT NULL").select("chunk", "n", "ids"), "chunk", "n", n_places, MOST)
    given = given.groupBy("digest").agg(F.collect_list(F.struct("at", "ids")).alias("shared"))
    second = first.filter("packed IS NOT NULL").select("digest", "copies", "packed").join(given, "digest").mapInArrow(_second_pass(tokenizer, reduce, typed(results)), results)
    done = first.filter("n_chunks IS NOT NULL").select(*second.columns).unionByName(second)
    done = staged(done, "encoded-texts")
    named = [n for n, _ in typed(schema)]
    light = staged(rows.select("doc_id", "digest"), "text-digests")
    return join_uneven(light, done, "digest", "copies", done.agg(F.sum("copies")).first()[0] or 0, MOST).select("doc_id", *named, "n_chunks", "n_shared_chunks")


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
_decimal: list[str] = []


def digests(model: bpe.Bpe, ids: np.ndarray) -> dict:
    """n_tokens, SHA-256 of the ids in decimal joined by commas, SHA-256 of the decoded text."""
    if len(_decimal) < model.size:
        _decimal[:] = map(str, range(model.size))
    listed = ids.tolist()
    decimal = ",".join(map(_decimal.__getitem__, listed))
    decoded = model.decode(listed)
    return {"n_tokens": len(listed), "ids_sha256": hashlib.sha256(decimal.encode()).hexdigest(), "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest()}


def op3_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_texts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), digests, DIGESTS)
