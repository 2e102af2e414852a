"""Operator 5: language-model scoring with Elias-Fano n-gram tries of order three.

The model adds the counts of three orders with fixed weights:
p(w | g h) = (c(g h w) + BACK * (c(h w) + PRIOR * u(w))) / (c(g h) + BACK * (c(h) + PRIOR)), where
u(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)), c, N and V being counts over the learned documents' tokens. It sums to one over the
learned words and one unseen one. Its logarithm is a term of (g, h, w) and a term of the context (g, h); the first needs
counts of n-grams that end with w, the second of those that end with h, so each is found where its last word's counts
are, and a document's score is the sum of what all shards add.

1. Distinct words with counts go to shards by hash range: sorted word hashes in Elias-Fano code with their counts (N
   and V are their sums).
2. Every batch of texts sends each shard its distinct words, for each the distinct words before it, for each of these the
   words before that, and for each the documents and how often. Words with over 1 / (4 * shards) of all tokens, learned or
   not, are dealt over all shards by the word before. They are at most MOST_SPLIT (the share is 1 / MOST_SPLIT at least),
   so what is broadcast has a fixed bound. An n-gram in over MOST_PLACES documents of a batch (a passage that many share)
   sends its counts only; its documents stay with the batch, to which the shard returns the n-gram's terms.
3. A shard builds its trie from the learned n-grams, writes it to an unlinked scratch file of the task and maps it. Levels:
   words; names (the words before, as sorted 40-bit hashes); children of words and children of pairs, each stored
   as parent * names + rank of the child among the names, which is monotone; monotone pointers to where each parent's
   children begin; smoothed logarithms quantised to 1 / GRID in 16 bits. All sequences are in Elias-Fano code and are
   queried as they are: a child is found by successor search inside its parent's range, never by expanding a level. What
   is not found takes the term of the shorter n-gram.
4. The sums of each document are added over shards, batch by batch.

Tokens: words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased (64-bit hashes), then one end, which is a token. Two starts stand
before the first word.

Defined cases: a null text is empty (its end alone); rows with a null id are learned from; repeated rows count and are
scored each by itself; with nothing to learn from all scores are 0; an empty table gives an empty result; other columns
are ignored. All counts cover all rows; the work and what is gathered grow in proportion to the text.
"""

from __future__ import annotations

import hashlib
import math
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomill.llm.common import documents, remainder, staged, text_of
from geomill.llm.words import mix, word_hashes

BACK, PRIOR, GRID = 1 / 128, 256.0, 2048
SHARDS, SHARD_BYTES, MOST_SPLIT = 128, 6 << 20, 1 << 20  # at least so many shards; bytes of text for each
BATCH_BYTES, BATCH_DOCS, MOST_PLACES = 8 << 20, 32_000, 256
START, END = np.uint64(0x1D8AF066F5B7B3C1), np.uint64(0x8E9D5C3FD1A26B47)
LEARNED, APART = 0x8000, 0x7FFF  # marks a learned document's place in its batch; the place of all documents of a common n-gram
U64 = np.uint64


# ---- Elias-Fano code ----

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
_PLACES = np.array([[k for k in range(8) if b >> k & 1] + [8] * (8 - bin(b).count("1")) for b in range(256)], np.uint8)


def _select(words: np.ndarray, before: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Places of the nth (from 0) set bits of packed 64-bit words; `before` counts the set bits before each word."""
    at = np.searchsorted(before, nth, "right") - 1
    left, word, place = nth - before[at], words[at], 64 * at
    for half in (32, 16, 8):
        ones = np.bitwise_count(word & U64((1 << half) - 1)).astype(np.int64)
        above = left >= ones
        left -= np.where(above, ones, 0)
        step = np.where(above, half, 0)
        word >>= step.astype(np.uint64)
        place += step
    return place + _PLACES[(word & U64(255)).astype(np.intp), left]


class EliasFano:
    """A monotone sequence as it is coded: the low bytes of the values as they are; of each next value a set bit after as many
    clear bits as the rest grew; and a count of set bits before every 64 of these."""

    @staticmethod
    def pack(values: np.ndarray) -> bytes:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        width = 0
        while width < 7 and (top >> (8 * width)) > 4 * n + 64:
            width += 1
        high, last = (values >> U64(8 * width)).astype(np.int64), top >> (8 * width)
        bits = np.zeros(-(-(last + n + 2) // 64) * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        upper = np.packbits(bits, bitorder="little")
        sums = np.cumsum(_ONES[upper].reshape(-1, 8).sum(axis=1))
        before = np.append(0, sums[:-1]).astype("<u8")
        low = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]).tobytes()
        return np.array([width, n, last, len(before)], "<u8").tobytes() + upper.tobytes() + before.tobytes() + low + bytes(-len(low) % 8)

    def __init__(self, buffer: np.ndarray) -> None:
        """From the head of a buffer of bytes, of which `used` are its own; nothing is copied or expanded."""
        self.width, self.size, self.last, n = np.frombuffer(buffer[:32], "<u8").astype(int).tolist()
        self.upper, self.before = np.frombuffer(buffer[32 : 32 + 8 * n], "<u8"), np.frombuffer(buffer[32 + 8 * n : 32 + 16 * n], "<u8")
        at = 32 + 16 * n
        self.low = buffer[at : at + self.size * self.width].reshape(self.size, self.width)
        self.used = at + -(-self.size * self.width // 8) * 8

    def _low(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), 8), np.uint8)
        out[:, : self.width] = self.low[at]
        return out.view("<u8").ravel()

    def values(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, np.int64)
        high = _select(self.upper, self.before.astype(np.int64), at) - at
        return high.astype(np.uint64) << U64(8 * self.width) | self._low(at)

    def _first(self, high: np.ndarray) -> np.ndarray:
        """How many values have a smaller high part."""
        zeros = 64 * np.arange(len(self.before), dtype=np.int64) - self.before.astype(np.int64)
        return np.where(high > 0, _select(~self.upper, zeros, np.maximum(high - 1, 0)) - high + 1, 0)

    def find(self, keys: np.ndarray, low: np.ndarray | int = 0, stop: np.ndarray | int | None = None) -> np.ndarray:
        """Where each key stands among the places low..stop - 1, or -1: the successor there, if it is the key itself."""
        keys = np.asarray(keys, np.uint64)
        high = np.minimum(keys >> U64(8 * self.width), U64(self.last + 1)).astype(np.int64)
        a, end = np.maximum(self._first(high), low), np.minimum(self._first(high + 1), self.size if stop is None else stop)
        b, rest = end.copy(), keys & U64((1 << 8 * self.width) - 1)
        open_ = np.flatnonzero(a < b)
        while len(open_):
            middle = (a[open_] + b[open_]) >> 1
            less = self._low(middle) < rest[open_]
            a[open_[less]] = middle[less] + 1
            b[open_[~less]] = middle[~less]
            open_ = open_[a[open_] < b[open_]]
        inside = np.flatnonzero((a < end) & (keys >> U64(8 * self.width) <= U64(self.last)))
        out = np.full(len(keys), -1, np.int64)
        met = inside[self._low(a[inside]) == rest[inside]]
        out[met] = a[met]
        return out


# ---- the trie ----


def quantise(logarithm: np.ndarray) -> np.ndarray:
    return np.round(logarithm * GRID).astype("<i2")


class Trie:
    """The levels of a shard over one flat buffer of bytes (an array in memory or a numpy.memmap)."""

    CODES = ("words", "names", "children", "pairs", "grandchildren", "triples")
    VALUES = ("unigram", "after_word", "bigram", "after_pair", "trigram")

    @staticmethod
    def pack(words: np.ndarray, names: np.ndarray, pairs: np.ndarray, triples: np.ndarray, values: list[np.ndarray]) -> bytes:
        """words, names: sorted; pairs: sorted place of the word * names + place of the name; triples: the same over places of
        pairs; values: the quantised terms in the order of VALUES."""
        n = max(1, len(names))
        children = np.searchsorted(pairs // U64(n), np.arange(len(words) + 1, dtype=np.uint64))
        grandchildren = np.searchsorted(triples // U64(n), np.arange(len(pairs) + 1, dtype=np.uint64))
        parts = [EliasFano.pack(x) for x in (words, names, children, pairs, grandchildren, triples)]
        return b"".join([*parts, *(v.astype("<i2").tobytes() for v in values)])

    def __init__(self, buffer: np.ndarray) -> None:
        at = 0
        for name in self.CODES:
            setattr(self, name, code := EliasFano(buffer[at:]))
            at += code.used
        for name, size in zip(self.VALUES, (self.words.size, self.words.size, self.pairs.size, self.pairs.size, self.triples.size), strict=True):
            setattr(self, name, np.frombuffer(buffer[at : at + 2 * size], "<i2"))
            at += 2 * size

    def _child(self, code: EliasFano, pointers: EliasFano, parent: np.ndarray, name: np.ndarray) -> np.ndarray:
        out, ask = np.full(len(parent), -1, np.int64), np.flatnonzero((parent >= 0) & (name >= 0))
        if len(ask):
            owners, back = np.unique(parent[ask], return_inverse=True)
            low, stop = (pointers.values(owners + k).astype(np.int64)[back] for k in (0, 1))
            keys = parent[ask].astype(np.uint64) * U64(max(1, self.names.size)) + name[ask].astype(np.uint64)
            out[ask] = code.find(keys, low, stop)
        return out

    def find(self, words: np.ndarray, ids: np.ndarray, pair_word: np.ndarray, pair_id: np.ndarray, triple_pair: np.ndarray, triple_id: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For n-grams given as places in `words` and `ids` (pairs) and in the pairs (triples): the terms of the triples, and
        of the contexts that the pairs are."""
        word, name = self.words.find(words), self.names.find(ids)
        owner = word[pair_word]
        pair = self._child(self.pairs, self.children, owner, name[pair_id])
        triple = self._child(self.triples, self.grandchildren, pair[triple_pair], name[triple_id])
        term, context = self.unigram[owner], self.after_word[owner]
        known = np.flatnonzero(pair >= 0)
        term[known], context[known] = self.bigram[pair[known]], self.after_pair[pair[known]]
        terms, seen = term[triple_pair], np.flatnonzero(triple >= 0)
        terms[seen] = self.trigram[triple[seen]]
        return terms.astype(np.int64), context.astype(np.int64)


def build_trie(words: np.ndarray, counts: np.ndarray, ids: np.ndarray, pairs: tuple, triples: tuple, n: int, v: int) -> bytes:
    """words (sorted) with their counts (0: not learned); ids (sorted); pairs (place in words, place in ids, count) and
    triples (place in pairs, place in ids, count), both sorted and learned (count 1 or more)."""
    (pair_word, pair_id, pair_count), (triple_pair, triple_id, triple_count) = pairs, triples
    used = np.zeros(len(ids), bool)
    used[pair_id] = used[triple_id] = True
    names, rank = ids[used], np.cumsum(used) - 1
    size = max(1, len(names))
    unigram = PRIOR * (counts + 0.5) / (n + 0.5 * (v + 1))
    bigram = BACK * (pair_count + unigram[pair_word])
    trigram = triple_count + bigram[triple_pair]
    whole = BACK * (counts + PRIOR)
    pair_whole = pair_count + whole[pair_word]
    end = words == END  # its context is that of the first word: the two starts, which occur as often as ends
    whole[end] += counts[end]
    at_end = end[pair_word]
    pair_whole[at_end] = whole[pair_word[at_end]]
    terms = [quantise(np.log10(x)) for x in (BACK * unigram, 1 / whole, bigram, 1 / pair_whole, trigram)]
    return Trie.pack(words, names, pair_word.astype(np.uint64) * U64(size) + rank[pair_id].astype(np.uint64), triple_pair.astype(np.uint64) * U64(size) + rank[triple_id].astype(np.uint64), terms)


# ---- what batches of texts send ----


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned numbers, byte by byte of equal weight, as few bytes as the largest needs, compressed."""
    heads, planes = [], []
    for a in arrays:
        width = max(1, -(-int(a.max()).bit_length() // 8)) if len(a) else 1
        heads += [len(a), width]
        planes.append(np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())
    return zstandard.ZstdCompressor(1).compress(np.array([len(arrays), *heads], "<u4").tobytes() + b"".join(planes))


def loosened(packed: bytes) -> list[np.ndarray]:
    """The arrays again, of unsigned numbers as narrow as they need be."""
    raw = zstandard.ZstdDecompressor().decompress(packed)
    count = int(np.frombuffer(raw[:4], "<u4")[0])
    heads, at, out = np.frombuffer(raw, "<u4", 2 * count, 4).tolist(), 4 + 8 * count, []
    for n, width in zip(heads[0::2], heads[1::2], strict=True):
        size = 1 << (width - 1).bit_length()
        a = np.zeros((n, size), np.uint8)
        a[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
        out.append(a.view(f"<u{size}").ravel())
        at += n * width
    return out


def zigzag(x: np.ndarray) -> np.ndarray:
    return ((x << 1) ^ (x >> 63)).view(np.uint64)


def unzigzag(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    return (x >> U64(1)).astype(np.int64) ^ -(x & U64(1)).astype(np.int64)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(batch key, doc_ids, learned, tokens of each) of about BATCH_BYTES of text."""
    held, size, nth = [], 0, 0
    part = TaskContext.get().partitionId()

    def out() -> tuple:
        key = hashlib.blake2b(f"{part}/{nth}/{held[0][0]}/{held[-1][0]}".encode(), digest_size=8).digest()
        return int.from_bytes(key, "little", signed=True), [h[0] for h in held], np.array([h[1] for h in held], bool), [h[2] for h in held]

    for batch in batches:
        for doc_id, learned, text in zip(batch["doc_id"].to_pylist(), batch["learned"].to_pylist(), batch["text"], strict=True):
            text = text.as_py()
            held.append((doc_id, learned, np.append(word_hashes(text), END)))
            size += len(text)
            if size >= BATCH_BYTES or len(held) >= BATCH_DOCS:
                yield out()
                held, size, nth = [], 0, nth + 1
    if held:
        yield out()


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> U64(32)) * U64(shards)) >> U64(32)


def _vocabulary(shards: int):
    """Per shard the batch's distinct words, and how often learned and other documents have them."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, learned, tokens in _batches(batches):
            words, place = np.unique(np.concatenate(tokens), return_inverse=True)
            marks = np.repeat(learned, list(map(len, tokens)))
            taught, others = np.bincount(place[marks], minlength=len(words)), np.bincount(place[~marks], minlength=len(words))
            ends = np.searchsorted(shard_of(words, shards), np.arange(shards + 1, dtype=np.uint64))
            rows = [k for k in range(shards) if ends[k] < ends[k + 1]]
            packed = [squeezed(*(x[ends[k] : ends[k + 1]] for x in (words, taught, others))) for k in rows]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(packed, pa.binary())], ["shard", "packed"])

    return send


def _level_one(group: pa.Table) -> pa.Table:
    words, taught, others = (np.concatenate(x).astype(np.uint64) for x in zip(*(loosened(p.as_py()) for p in group["packed"]), strict=True))
    distinct, place = np.unique(words, return_inverse=True)
    counts, rest = (np.bincount(place, x, len(distinct)).astype(np.uint64) for x in (taught, others))
    figures = [int((counts > 0).sum()), int(counts.sum()), int(rest.sum())]
    return pa.table({"shard": group["shard"].slice(0, 1)} | {c: pa.array([x], pa.int64()) for c, x in zip(("n_words", "n_tokens", "n_others"), figures, strict=True)} | {"words": pa.array([EliasFano.pack(distinct)], pa.binary()), "counts": pa.array([squeezed(counts, rest)], pa.binary())})


LEVEL = "shard int, n_words long, n_tokens long, n_others long, words binary, counts binary"


def _coded(packed: bytes) -> EliasFano:
    return EliasFano(np.frombuffer(packed, np.uint8))


def _frequent(least: int):
    """The words with over `least` tokens, and how often learned documents have them."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, counts in zip(batch["words"], batch["counts"], strict=True):
                counts, rest = (x.astype(np.int64) for x in loosened(counts.as_py()))
                often = np.flatnonzero(counts + rest > least)
                yield pa.RecordBatch.from_arrays([pa.array(_coded(packed.as_py()).values(often).view(np.int64)), pa.array(counts[often])], ["word", "n"])

    return find


SENT = "shard int, batch long, packed binary, doc_ids array<long>, n_tokens binary"
SENT_ARROW = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), ("packed", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.binary())])


def _name(words: np.ndarray) -> np.ndarray:
    """The 40-bit id of a word as context."""
    return mix(words ^ U64(0xA5A5A5A5)) >> U64(24)


def _runs(new: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """How many marks of `inner` each run that begins at a mark of `new` has."""
    return np.add.reduceat(inner, np.flatnonzero(new), dtype=np.int64)


def _grouped(shard: np.ndarray, code: np.ndarray, h: np.ndarray, g: np.ndarray, place: np.ndarray) -> np.ndarray:
    """An order by (shard, code, h, g, place); from two sorts of one number each while the batch is small enough for that."""
    bits, most = int(h.max()).bit_length(), len(h).bit_length()
    if int(shard.max()).bit_length() + 2 * bits > 64 or most + bits + 16 > 64:
        return np.lexsort((place, g, h, code, shard))
    key = (shard << U64(bits) | code) << U64(bits) | h
    order = np.argsort(key)
    key = key[order]
    run = np.cumsum(np.append(False, key[1:] != key[:-1])).astype(np.uint64)
    return order[np.argsort((run << U64(bits) | g[order]) << U64(16) | place[order])]


def _common_apart(of: np.ndarray, place: np.ndarray, times: np.ndarray, most: int) -> tuple:
    """Entries (place, times) of n-grams (sorted by `of`, the n-gram's number) with those of over `most` entries summed into two,
    at APART and APART | LEARNED: how many entries each n-gram has now, places and times; then, of the n-grams so summed, their
    numbers, how many entries they had, and these."""
    many = np.bincount(of)
    common = np.flatnonzero(many > most)
    if not len(common):
        return many, place, times, common, common, place[:0], times[:0]
    apart = (many > most)[of]
    own, own_place, own_times = of[apart], place[apart], times[apart]
    sums = [np.bincount(own[marked], own_times[marked], len(many))[common].astype(np.int64) for marked in (own_place < LEARNED, own_place >= LEARNED)]
    of = np.concatenate([of[~apart], common, common])
    order = np.argsort(of, kind="stable")
    ends = [np.full(len(common), APART, place.dtype), np.full(len(common), APART | LEARNED, place.dtype)]
    place, times = (np.concatenate(x)[order] for x in ([place[~apart], *ends], [times[~apart], *sums]))
    return np.bincount(of, minlength=len(many)), place, times, common, many[common], own_place & place.dtype.type(LEARNED - 1), own_times


def _ngrams(shards: int, shared, most: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value[0]
        for key, doc_ids, learned, tokens in _batches(batches):
            sizes = np.array(list(map(len, tokens)))
            words, code = np.unique(np.concatenate(tokens), return_inverse=True)
            code, begins = code.astype(np.uint64), np.cumsum(sizes) - sizes
            h, g = np.empty_like(code), np.empty_like(code)
            h[1:] = code[:-1]
            h[begins] = len(words)
            g[1:] = h[:-1]
            g[begins] = len(words)
            names = _name(np.append(words, START))
            place = np.repeat(np.arange(len(sizes)) | np.where(learned, LEARNED, 0), sizes).astype(np.uint64)
            shard = shard_of(words, shards)[code]
            often = np.flatnonzero(np.isin(words, frequent)[code])
            shard[often] = shard_of(mix(words[code[often]] ^ names[h[often]]), shards)
            order = _grouped(shard, code, h, g, place)
            shard, code, h, g = (x.astype(np.uint32)[order] for x in (shard, code, h, g))
            place = place.astype(np.uint16)[order]
            del order, often
            head = np.append(True, (code[1:] != code[:-1]) | (shard[1:] != shard[:-1]))
            pair = head | np.append(True, h[1:] != h[:-1])
            triple = pair | np.append(True, g[1:] != g[:-1])
            entry = np.flatnonzero(triple | np.append(True, place[1:] != place[:-1]))
            times, place = np.diff(np.append(entry, len(place))).astype(np.int32), place[entry]
            first, of = np.flatnonzero(triple), (np.cumsum(triple, dtype=np.int32) - 1)[entry]
            del entry
            many, places, times, common, runs, common_places, common_times = _common_apart(of, place, times, most)
            del of, place
            begin = np.append(0, np.cumsum(many))
            ends, rows = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint32)), []
            firsts = np.searchsorted(first, ends)
            for k in range(shards):
                cut = slice(ends[k], ends[k + 1])
                if ends[k] < ends[k + 1]:
                    w, p, t = head[cut], pair[cut], triple[cut]
                    own = slice(begin[firsts[k]], begin[firsts[k + 1]])
                    entries = many[firsts[k] : firsts[k + 1]]
                    befores = h[cut][p]
                    local, at = np.unique(names[np.concatenate([befores, g[cut][t]])], return_inverse=True)  # names recur: sent once, in order, as steps
                    steps = np.diff(local, prepend=U64(0))
                    packed = squeezed(words[code[cut][w]], steps, _runs(w, p), at[: len(befores)], _runs(p, t), at[len(befores) :], entries, places[own], times[own])
                    rows.append({"shard": k, "batch": key, "packed": packed})
            steps = zigzag(np.diff(common_places.astype(np.int64), prepend=0))
            kept = squeezed(sizes, shard[first[common]], runs, steps, common_times)
            rows.append({"shard": key % shards, "batch": key, "doc_ids": doc_ids, "n_tokens": kept})
            yield pa.RecordBatch.from_pylist(rows, schema=SENT_ARROW)

    return send


# ---- a shard ----


def _distinct(parent: np.ndarray, child: np.ndarray, children: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (parent, child) in order, and which one each row is."""
    keys, back = np.unique(parent.astype(np.uint64) * U64(children) + child.astype(np.uint64), return_inverse=True)
    return (keys // U64(children)).astype(np.int64), (keys % U64(children)).astype(np.int64), back


def _shard(n: int, v: int, shared):
    def score(sent: pa.Table, level: pa.Table) -> pa.Table:
        frequent, frequent_counts = shared.value
        rows = sent.to_pylist()
        out = [r for r in rows if r["doc_ids"] is not None]
        rows = sorted((r for r in rows if r["doc_ids"] is None), key=lambda r: r["batch"])
        if not rows:
            return pa.Table.from_pylist(out, schema=SENT_ARROW)
        word, steps, pairs_of, h, triples_of, g, entries_of, place, times = (list(x) for x in zip(*(loosened(r["packed"]) for r in rows), strict=True))
        names = [np.cumsum(s, dtype=np.uint64) for s in steps]
        h, g = ([name[i] for name, i in zip(names, at, strict=True)] for at in (h, g))
        stops = np.cumsum(list(map(len, place)))[:-1]
        word, h, g = (np.concatenate(x).astype(np.uint64) for x in (word, h, g))
        pairs_of, triples_of, entries_of, place, times = (np.concatenate(x) for x in (pairs_of, triples_of, entries_of, place, times))
        place = place.astype(np.uint16)
        words, word_at = np.unique(word, return_inverse=True)
        counts = np.zeros(len(words))
        if level.num_rows:
            at = _coded(level["words"][0].as_py()).find(words)
            counts[at >= 0] = loosened(level["counts"][0].as_py())[0][at[at >= 0]]
        at = np.minimum(np.searchsorted(frequent, words), max(0, len(frequent) - 1))
        hit = np.flatnonzero(frequent[at] == words) if len(frequent) else at[:0]
        counts[hit] = frequent_counts[at[hit]]
        ids, id_at = np.unique(np.concatenate([h, g]), return_inverse=True)
        n_pairs = len(h)
        del word, h, g, names, steps
        pair_word, pair_id, pair = _distinct(np.repeat(word_at, pairs_of), id_at[:n_pairs], len(ids))
        triple_pair, triple_id, triple = _distinct(np.repeat(pair, triples_of), id_at[n_pairs:], len(ids))
        del word_at, id_at, pair
        triple = np.repeat(triple.astype(np.uint32), entries_of)
        learned = np.flatnonzero(place >= LEARNED)
        triple_count = np.bincount(triple[learned], times[learned], len(triple_pair))
        pair_count = np.bincount(triple_pair, triple_count, len(pair_word))
        known, known_pair = triple_count > 0, pair_count > 0
        moved = np.cumsum(known_pair) - 1
        del learned
        packed = build_trie(words, counts, ids, (pair_word[known_pair], pair_id[known_pair], pair_count[known_pair]), (moved[triple_pair[known]], triple_id[known], triple_count[known]), n, v)
        with tempfile.TemporaryFile() as file:  # this task's scratch, as Spark's own spill files: no other task needs it
            file.write(packed)
            file.flush()
            terms, contexts = Trie(np.asarray(np.memmap(file, np.uint8, "r"))).find(words, ids, pair_word, pair_id, triple_pair, triple_id)
        value, owner = (terms + contexts[triple_pair]).astype(np.int32), pair_word[triple_pair].astype(np.uint32)
        del packed, terms, contexts, pair_word, pair_id, triple_pair, triple_id
        for r, triple, place, times in zip(rows, *(np.split(x, stops) for x in (triple, place, times)), strict=True):
            told, own = triple[place == APART], place & np.uint16(LEARNED - 1)
            alone = own != APART
            triple, times = triple[alone], times[alone]
            docs, doc = np.unique(own[alone], return_inverse=True)
            sums = np.zeros(len(docs), np.int64)
            np.add.at(sums, doc, value[triple] * times.astype(np.int64))
            own, count, item = _distinct(doc, counts[owner[triple]].astype(np.int64), int(counts.max()) + 1)
            common = zigzag(value[told].astype(np.int64)), counts[owner[told]].astype(np.int64)
            packed = squeezed(docs, zigzag(sums), np.bincount(own, minlength=len(docs)), count, np.bincount(item, times).astype(np.int64), *common)
            out.append({"shard": r["shard"], "batch": r["batch"], "packed": packed})
        return pa.Table.from_pylist(out, schema=SENT_ARROW)

    return score


def _added(n: int, v: int):
    def add(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["shard"])
        docs = next(r for r in rows if r["doc_ids"] is not None)
        size = len(docs["doc_ids"])
        model, base, known = np.zeros(size, np.int64), np.zeros(size), np.zeros(size, np.int64)
        kept = loosened(docs["n_tokens"])
        tokens, shard, runs, common_times = (kept[i].astype(np.int64) for i in (0, 1, 2, 4))
        common_place, begin = np.cumsum(unzigzag(kept[3])), np.append(0, np.cumsum(runs))

        def count_in(place: np.ndarray, count: np.ndarray, times: np.ndarray) -> None:
            nonlocal base, known
            base += np.bincount(place, times * np.log10(count + 0.5), size)
            known += np.bincount(place, times * (count > 0), size).astype(np.int64)

        for r in rows:
            if r["doc_ids"] is None:
                place, sums, items, count, times, common, common_count = loosened(r["packed"])
                model[place] += unzigzag(sums)
                count_in(np.repeat(place, items), count, times)
                a, b = np.searchsorted(shard, [r["shard"], r["shard"] + 1])
                place, times = (x[begin[a] : begin[b]] for x in (common_place, common_times))
                np.add.at(model, place, np.repeat(unzigzag(common), runs[a:b]) * times)
                count_in(place, np.repeat(common_count, runs[a:b]), times)
        return pa.table({"doc_id": pa.array(docs["doc_ids"], pa.int64()), "n_tokens": tokens, "n_known": known, "base_score": base - tokens * math.log10(n + 0.5 * (v + 1)), "score": model / GRID})

    return add


def lm_scores(docs: DataFrame, learn: Column, most_places: int = MOST_PLACES) -> tuple[DataFrame, int]:
    """(doc_id, n_tokens, n_known, base_score, score of every row, N). Learns from the rows where `learn` holds."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", text_of().alias("text"), F.coalesce(learn, F.lit(False)).alias("learned"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(SHARDS, math.ceil(size / SHARD_BYTES))
    sent = rows.mapInArrow(_vocabulary(shards), "shard int, packed binary")
    levels = staged(sent.groupBy("shard").applyInArrow(_level_one, LEVEL), "level-one")
    total = levels.agg(F.sum("n_tokens").alias("n"), F.sum("n_words").alias("v"), F.sum("n_others").alias("others")).first()
    n, v = total.n or 0, total.v or 0
    least = math.ceil((n + (total.others or 0)) / min(4 * shards, MOST_SPLIT))
    often = levels.select("words", "counts").mapInArrow(_frequent(least), "word long, n long").toArrow()  # fewer than MOST_SPLIT
    frequent = often["word"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(frequent)
    shared = spark.sparkContext.broadcast((frequent[order], often["n"].to_numpy().astype(np.uint64)[order]))
    pairs = rows.mapInArrow(_ngrams(shards, shared, most_places), SENT)
    sums = pairs.groupBy("shard").cogroup(levels.groupBy("shard")).applyInArrow(_shard(n, v, shared), SENT)
    scored = sums.groupBy("batch").applyInArrow(_added(n, v), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored, n


def op5_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored, n = lm_scores(docs, remainder("doc_id", 5) != 1)
    return scored.select("doc_id", (remainder("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), F.round("base_score", 6).alias("base_score"), "score")


ORACLE = rf"""
WITH RECURSIVE bits AS (
  SELECT doc_id, doc_id::VARCHAR AS s, 0 AS k, 4294967295::UBIGINT AS crc FROM documents
  UNION ALL
  SELECT doc_id, s, k + 1, CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END
  FROM (SELECT doc_id, s, k, CASE WHEN k % 8 = 0 THEN xor(crc, ascii(substr(s, k // 8 + 1, 1))::UBIGINT) ELSE crc END AS x FROM bits WHERE k < 8 * length(s))
),
h AS (SELECT doc_id, xor(crc, 4294967295::UBIGINT) % 5 = 1 AS held_out FROM bits WHERE k = 8 * length(s)),
w AS (SELECT doc_id, list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') AS words FROM documents),
p AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
t AS (SELECT doc_id, held_out, word, lag(word, 1, '  ') OVER o AS h1, lag(word, 2, '  ') OVER o AS h2 FROM p JOIN h USING (doc_id) WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
l AS (SELECT * FROM t WHERE NOT held_out),
c AS (SELECT word, count(*) AS c FROM l GROUP BY word),
c2 AS (SELECT h1, word, count(*) AS c2 FROM l GROUP BY h1, word),
c3 AS (SELECT h2, h1, word, count(*) AS c3 FROM l GROUP BY h2, h1, word),
d1 AS (SELECT h1, count(*) AS d1 FROM l GROUP BY h1),
d2 AS (SELECT h2, h1, count(*) AS d2 FROM l GROUP BY h2, h1),
n AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM c),
x AS (SELECT doc_id, held_out, c, coalesce(c2, 0) AS c2, coalesce(c3, 0) AS c3, coalesce(d1, 0) AS d1, coalesce(d2, 0) AS d2, n, (coalesce(c, 0) + 0.5::DOUBLE) / (n + 0.5::DOUBLE * (v + 1)) AS u
  FROM t LEFT JOIN c USING (word) LEFT JOIN c2 USING (h1, word) LEFT JOIN c3 USING (h2, h1, word) LEFT JOIN d1 USING (h1) LEFT JOIN d2 USING (h2, h1), n)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, n AS train_tokens, round(sum(log10(u)), 6) AS base_score,
  sum(round(log10(c3 + {BACK}::DOUBLE * (c2 + {PRIOR} * u)) * {GRID}) + round(-log10(d2 + {BACK}::DOUBLE * (d1 + {PRIOR}::DOUBLE)) * {GRID})) / {GRID} AS score
FROM x GROUP BY doc_id, held_out, n
"""
