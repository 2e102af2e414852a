"""Each operator against a brute-force version, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing
column names."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import time
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from geomill.llm import bpe, chat_format, chunk_bpe, common, exact_dedup, language_id, line_clean, near_dedup, ngram_trie, quality_rules, source_mix, token_output
from geomill.llm.words import shingles, word_hashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, key long, chunk string, rate double"  # more columns than needed, some of the operators' own names


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(("an", "er", "th", "ou", "de", "é", "ing")) for _ in range(r.randint(1, 4))) for _ in range(n))


BASE = words(1, 200)
TEXTS = [
    (0, BASE, "en", "a"), (1, BASE, "en", "a"), (2, BASE + " one two three", "en", "b"), (3, None, None, None), (4, "", "fr", "b"), (5, " \n\t ", "fr", "b"), (6, "word", "en", "c"),
    (7, words(2, 300), "fr", "c"), (7, words(2, 300), "fr", "c"), (8, words(3, 50) + "\n" + BASE, "en", "a"), (9, "x" * 70_000 + " é" + "   <|endoftext|> 'll\r\n  end  ", "en", "a"),
    (10, words(4, 20_000), "fr", "c"), (11, "日本語のテキスト" * 400, "ja", "c"), (None, "a text without an id", "en", "a"), (12, "a text without an id", "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "d", 1, "c", 0.5) for i, t, lang, s in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


# ---- 1: token output ----


def test_coder_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 63, 65, 1000, 200_000):
        ids = rng.zipf(1.5, n).clip(0, 999).astype(np.int64)
        coder = token_output.Coder(token_output.scaled(np.bincount(np.append(ids, [0, 1]), minlength=1000)))
        coded = coder.encode(ids, lanes=8, block=4096, checkpoint=16)
        assert np.array_equal(coder.decode(coded, n), ids)
        for a, b in ((0, n), (n // 3, n // 2), (n - 1, n), (min(n, 130), min(n, 140))):
            assert np.array_equal(coder.decode_range(coded, max(0, a), b), ids[max(0, a) : b])
    coded["words"] = coded["words"][:-4] + b"\1\2\3\4"
    with pytest.raises(ValueError, match="damaged"):
        coder.decode(coded, n)


def test_scaled_frequencies():
    for counts in ([1], [1, 1_000_000_000], [*range(1, 50_000)], [0, 5, 0, 7]):
        freq = token_output.scaled(np.array(counts))
        assert freq.sum() == 1 << token_output.SCALE and ((freq > 0) == (np.array(counts) > 0)).all()


def test_token_files(spark, docs, library, monkeypatch):
    monkeypatch.setattr(token_output, "SEGMENT", 5_000)
    path = f"{common.shared_dir(spark)}/files-{uuid.uuid4().hex}"
    token_output.write_tokens(docs, path, PATH)
    got = token_output.read_tokens(spark, path, token_output._digest, "doc_id long, start long, n_tokens long, ids_crc32 long").collect()
    start, want = 0, []
    for i, t, *_ in sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0)):  # no two texts of one id differ
        ids = [*ids_of(library, t), 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda x: x[1]) == want


def test_token_files_of_many_rows_without_id(spark, library):
    """They are dealt over partitions, and the starts go on through all of them."""
    texts = [words(k, 5 + k % 7) for k in range(300)]
    df = spark.createDataFrame([*((None, t, "x") for t in texts), (5, None, "x")], "doc_id long, text string, part string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = token_output.tokenized(df, PATH).groupBy("part").count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 2
    path = f"{common.shared_dir(spark)}/files-{uuid.uuid4().hex}"
    token_output.write_tokens(df, path, PATH)
    got = sorted(token_output.read_tokens(spark, path, token_output._digest, "doc_id long, start long, n_tokens long, ids_crc32 long").collect(), key=lambda r: r.start)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))] and got[-1].doc_id == 5
    crc = lambda t: zlib.crc32(np.array([*ids_of(library, t), 0], "<u4").tobytes())
    assert sorted(r.ids_crc32 for r in got) == sorted(map(crc, [*texts, ""]))


def test_token_files_of_nothing(spark, docs):
    path = f"{common.shared_dir(spark)}/files-{uuid.uuid4().hex}"
    token_output.write_tokens(docs.limit(0), path, PATH)
    assert token_output.read_tokens(spark, path, token_output._digest, "doc_id long, start long, n_tokens long, ids_crc32 long").count() == 0


# ---- 2: exact dedup ----


def test_binary_fuse():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 1000, 40_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        fuse = exact_dedup.build_fuse(keys)
        assert exact_dedup.fuse_holds(keys, *fuse).all()
        assert exact_dedup.fuse_holds(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64), *fuse).mean() < 0.01


def brute_dedup(rows):
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, best[t or ""], len(groups[t or ""])) for i, t, *_ in rows), key=str)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(docs, weak):
    digest = (lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 3), 4, "0"))) if weak else exact_dedup.digest_of  # weak: unequal texts meet
    batch, held = exact_dedup.halves(docs)
    done = exact_dedup.exact_dedup(batch, exact_dedup.build_snapshot(held, digest), digest).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in done), key=str) == brute_dedup(TEXTS)
    assert sum(r.kept for r in done) == len({t or "" for _, t, *_ in TEXTS})


def test_exact_dedup_keeps_rows(docs):
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len({t or "" for _, t, *_ in TEXTS})
    assert exact_dedup.keep_first(docs.limit(0)).count() == 0
    assert exact_dedup.exact_dedup(docs).filter("kept").count() == kept.count()


OWN_NAMES = ("doc", "_id", "_digest", "_own", "own_id", "own_digest", "id", "digest", "copies", "keep_id", "group_size", "copy", "_copy", "__COPY", "_n_copies", "n_copies", "_cdf", "cdf", "_source_key", "source_key", "least", "_draw", "draw", "_shuffle_key", "shuffle_key", "salt", "doc_key", "component", "component_id", "kept", "u", "v", "a", "b", "key", "hub", "n", "_v", "chunk", "at", "part", "h", "packed", "learned")


@pytest.fixture(scope="module")
def crowded(docs):
    """The fixture with a column of each name that an operator uses inside."""
    more = [c for c in OWN_NAMES if c not in docs.columns]
    return docs.select("*", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in more))


def test_exact_dedup_with_clashing_names(crowded):
    kept = exact_dedup.keep_first(crowded)
    assert kept.columns == crowded.columns and kept.count() == len({t or "" for _, t, *_ in TEXTS})
    assert all(r["_id"] == f"_id{r.doc_id}" for r in kept.filter("doc_id IS NOT NULL").collect())
    batch, held = exact_dedup.halves(crowded)
    done = exact_dedup.exact_dedup(batch, exact_dedup.build_snapshot(held)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in done), key=str) == brute_dedup(TEXTS)


def test_a_stored_snapshot(spark, docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "PER_BUCKET", 2)
    batch, held = exact_dedup.halves(docs)
    path = f"{common.shared_dir(spark)}/snapshot-{uuid.uuid4().hex}"
    exact_dedup.build_snapshot(held).save(path)
    snapshot = exact_dedup.load_snapshot(spark, path)
    assert snapshot.n_buckets > 1 and exact_dedup.load_snapshot(spark, path).exact.filter(f"bucket >= {snapshot.n_buckets}").isEmpty()
    for new in (batch, docs.filter("false")):
        done = exact_dedup.exact_dedup(new, snapshot).collect()
        rows = [(i, t) for i, t, *_ in TEXTS if new is batch or (i is not None and zlib.crc32(str(i).encode()) % 2 == 0)]
        assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in done), key=str) == brute_dedup(rows)


def test_marked_texts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "CELLS", 1 << 17)
    texts = spark.range(3000).select("id", F.lit("t").alias("own"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    found = {r.id for r in exact_dedup._marked(texts, texts.filter("id % 10 = 3")).collect()}
    assert set(range(3, 3000, 10)) <= found and len(found) < 330


# ---- 3: chunk BPE ----


def test_cuts_depend_on_content():
    data = words(5, 4000).encode()
    a, b = chunk_bpe.cuts(data), chunk_bpe.cuts(b"another beginning " * 20 + data)
    assert a[-1] == len(data) and len({data[x:y] for x, y in zip([0, *a], a, strict=False)} & {(b"another beginning " * 20 + data)[x:y] for x, y in zip([0, *b], b, strict=False)}) > 3


def test_joined_ids_any_cut(library):
    model, r = bpe.load(PATH), random.Random(3)
    for text in (TEXTS[10][1][-40:], "a  b\n\n c 'll don't 12345 x", TEXTS[12][1][:200], words(6, 60), "   leading", "   x y"):
        data = text.encode()
        for _ in range(40):
            ends = sorted({chunk_bpe._whole(data, r.randint(1, len(data))) for _ in range(r.randint(0, 6))} | {len(data)})
            chunks = [model.encode(data[a:b].decode()) for a, b in zip([0, *ends], ends, strict=False)]
            assert chunk_bpe.joined_ids(model, data, ends, chunks).tolist() == ids_of(library, text)


def test_chunk_bpe(docs, library):
    done = chunk_bpe.encode_texts(docs, PATH, chunk_bpe.digests, chunk_bpe.DIGESTS).collect()
    want = []
    for i, t, *_ in TEXTS:
        ids = ids_of(library, t)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((tuple(r)[:4] for r in done), key=str) == sorted(want, key=str)
    assert chunk_bpe.encode_texts(docs.limit(0), PATH, chunk_bpe.digests, chunk_bpe.DIGESTS).count() == 0


@pytest.mark.parametrize("most", [512, 1 << 40])
def test_shared_chunks_are_joined(spark, library, most, monkeypatch):
    """With chunks and copies told by broadcast, and by shuffle."""
    monkeypatch.setattr(chunk_bpe, "MOST", most)
    shared = words(7, 3000)
    rows = [(k, words(100 + k, 40) + " " + shared + " " + words(200 + k, 40)) for k in range(6)]
    rows += [(10 + k, rows[0][1]) for k in range(5)]
    more = [(*r, "x", "y") for r in rows]
    done = chunk_bpe.encode_texts(spark.createDataFrame(more, "doc_id long, text string, copies string, packed string"), PATH, chunk_bpe.digests, chunk_bpe.DIGESTS).collect()
    assert sum(r.n_shared_chunks for r in done) > 50 and len(done) == len(rows)
    assert {r.doc_id: r.ids_sha256 for r in done} == {i: hashlib.sha256(",".join(map(str, ids_of(library, t))).encode()).hexdigest() for i, t in rows}


# ---- 4: source mix ----


def poisson_count(draw: float, rate: float) -> int:
    k, p, total = 0, math.exp(-rate), math.exp(-rate)
    while total < draw:
        k += 1
        p *= rate / k
        total += p
    return k


def test_source_mix(docs):
    weights = {"a": 3.0, "c": 1.0}
    mixed = source_mix.mix_sources(docs, weights, epochs=2.0)
    sizes = collections.Counter()
    for _, t, _, s in TEXTS:
        sizes[s or ""] += len(t or "")
    want = collections.Counter()
    for i, t, _, s in TEXTS:
        if s in weights:
            rate = weights[s] / 4 * sum(sizes.values()) * 2 / sizes[s]
            key = f"text:{hashlib.md5((t or '').encode()).hexdigest()}" if i is None else i
            draw = (int(hashlib.md5(f"count17:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            want[i, t] += poisson_count(draw, rate)
    rows = mixed.collect()
    assert collections.Counter((r.doc_id, r.text) for r in rows) == +want and set(docs.columns) <= set(mixed.columns)
    assert {r.source for r in rows} <= set(weights)


def test_source_mix_both_joins_agree(docs, monkeypatch):
    few = sorted(map(str, source_mix.mix_sources(docs).collect()))
    monkeypatch.setattr(source_mix, "MAX_BROADCAST", 0)
    assert sorted(map(str, source_mix.mix_sources(docs).collect())) == few and few
    assert source_mix.mix_sources(docs.limit(0)).count() == 0


def test_source_mix_with_clashing_names(docs, crowded):
    few = sorted(str((r.doc_id, r.text, r._copy, r._shuffle_key)) for r in source_mix.mix_sources(docs).collect())
    mixed = source_mix.mix_sources(crowded)
    assert mixed.columns == [*crowded.columns, "___copy", "__n_copies", "__shuffle_key"]
    assert sorted(str((r.doc_id, r.text, r["___copy"], r["__shuffle_key"])) for r in mixed.collect()) == few


def test_source_mix_without_ids(spark):
    """Different texts without id draw each for itself and are spread."""
    df = spark.createDataFrame([(None, f"text {k}", "a") for k in range(400)], "doc_id long, text string, source string")
    rows = source_mix.mix_sources(df, epochs=3.0).collect()
    drawn = collections.Counter(r.text for r in rows)
    assert len(set(drawn.values())) > 5 and 1000 < len(rows) < 1400 and len({r._shuffle_key for r in rows}) == len(rows)


def test_poisson_tables(spark):
    rates = [0.01, 1.0, 15.5, 16.0, 40.0, 700.0, 1e6]
    k = F.explode(F.expr("sequence(greatest(0, cast(rate - 6 * sqrt(rate) - 3 as long)), cast(rate + 6 * sqrt(rate) + 3 as long))"))
    df = spark.createDataFrame([(r,) for r in rates], "rate double").select("rate", k.alias("k"))
    for r in df.withColumn("p", source_mix.log_poisson(F.col("k"), F.col("rate"))).collect():
        assert r.p == pytest.approx(r.k * math.log(r.rate) - r.rate - math.lgamma(r.k + 1), abs=2e-8)


def test_source_mix_at_a_high_rate(spark):
    """A source of 4 characters with half the weight of 4 million: half a million times each of its documents."""
    df = spark.createDataFrame([(0, "tiny", "a"), *((k, "x" * 40_000, "b") for k in range(1, 101))], "doc_id long, text string, source string")
    began = time.perf_counter()
    counts = source_mix._copies(df, {"a": 1.0, "b": 1.0}, 0.5, 1.0, 17).groupBy("doc.source").agg(F.count("*").alias("n")).collect()
    assert time.perf_counter() - began < 20
    counts = {r.source: r.n for r in counts}
    assert abs(counts["a"] - 500_000.5) < 12 * 708 and 10 < counts["b"] < 100


def test_source_mix_is_native(docs):
    plan = source_mix.mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# ---- 5: n-gram trie ----


def test_elias_fano():
    rng = np.random.default_rng(2)
    for values in ([], [0], [5, 5, 5], np.sort(rng.integers(0, 1 << 62, 5000)), np.arange(300), np.array([1 << 63], np.uint64), np.sort(rng.integers(0, 50, 700))):
        values = np.array(values, np.uint64)
        packed = np.frombuffer(ngram_trie.EliasFano.pack(values) + b"more", np.uint8)
        code = ngram_trie.EliasFano(packed)
        assert np.array_equal(code.values(np.arange(len(values))), values) and code.used == len(packed) - 4
        asked = np.concatenate([values, values + np.uint64(1), rng.integers(0, 1 << 63, 500, dtype=np.uint64), np.arange(400, dtype=np.uint64)])
        known = set(values.tolist())
        for key, at in zip(asked.tolist(), code.find(asked).tolist(), strict=True):
            assert (at >= 0) == (key in known) and (at < 0 or (values[at] == key and (at == 0 or values[at - 1] < key)))
        if len(values) > 250:
            assert set(code.find(values[:250], 100, 200).tolist()) <= {-1, *range(100, 200)} and (code.find(values[100:200], 100, 200) >= 0).all()


def trie_of(grams, counts, n, v):
    """The packed trie of learned (g, h, w) with their counts, and what asks it for any n-grams."""
    words = np.array(sorted(counts), np.uint64)
    ids = np.unique(np.array([x for g, h, _ in grams for x in (g, h)], np.uint64))
    pairs = collections.Counter()
    for (_, h, w), c in grams.items():
        pairs[w, h] += c
    place, of = {int(w): k for k, w in enumerate(words)}, {int(i): k for k, i in enumerate(ids)}
    pair_keys = sorted(pairs)
    pair_at = {p: k for k, p in enumerate(pair_keys)}
    triples = sorted((pair_at[w, h], of[g], c) for (g, h, w), c in grams.items())
    column = lambda rows, k: np.array([r[k] for r in rows], np.int64)
    rows = [(place[w], of[h], pairs[w, h]) for w, h in pair_keys]
    return ngram_trie.build_trie(words, np.array([counts[int(w)] for w in words], float), ids, tuple(column(rows, k) for k in range(3)), tuple(column(triples, k) for k in range(3)), n, v), words


def test_a_mapped_trie_finds_every_order(tmp_path):
    r = random.Random(5)
    names, vocabulary = [r.randrange(1 << 40) for _ in range(30)], [r.randrange(1 << 63) for _ in range(40)]
    grams = collections.Counter((r.choice(names), r.choice(names), r.choice(vocabulary[:30])) for _ in range(1500))
    counts = collections.Counter(dict.fromkeys(vocabulary, 0))
    pairs = collections.Counter()
    for (_, h, w), c in grams.items():
        counts[w] += c
        pairs[w, h] += c
    n, v = sum(counts.values()), 30
    packed, words = trie_of(grams, counts, n, v)
    (tmp_path / "trie").write_bytes(packed)
    buffer = np.memmap(tmp_path / "trie", np.uint8, "r")
    trie = ngram_trie.Trie(buffer)
    assert all(np.shares_memory(x, buffer) for x in (trie.trigram, trie.after_pair, trie.triples.upper, trie.triples.low, trie.pairs.upper))
    assert len(packed) < 8 * (2 * len(grams) + 2 * len(pairs)) + 1500
    asked = np.array(sorted({*names, 1, 2, 1 << 39}), np.uint64)
    pair_word, pair_id = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(asked)), indexing="ij"))
    triple_pair, triple_id = (x.ravel() for x in np.meshgrid(np.arange(len(pair_word)), np.arange(len(asked)), indexing="ij"))
    terms, contexts = trie.find(words, asked, pair_word, pair_id, triple_pair, triple_id)
    back, prior = ngram_trie.BACK, ngram_trie.PRIOR
    for k in r.sample(range(len(terms)), 4000):
        w, h, g = int(words[pair_word[triple_pair[k]]]), int(asked[pair_id[triple_pair[k]]]), int(asked[triple_id[k]])
        u = (counts[w] + 0.5) / (n + 0.5 * (v + 1))
        assert terms[k] == round(math.log10(grams[g, h, w] + back * (pairs[w, h] + prior * u)) * ngram_trie.GRID)
        assert contexts[triple_pair[k]] == round(-math.log10(pairs[w, h] + back * (counts[w] + prior)) * ngram_trie.GRID)


def test_squeezed_arrays():
    rng = np.random.default_rng(3)
    arrays = [np.zeros(0, np.uint64), np.arange(300), rng.integers(0, 1 << 63, 99, dtype=np.uint64), np.array([0])]
    assert all(np.array_equal(a, b) for a, b in zip(ngram_trie.loosened(ngram_trie.squeezed(*arrays)), arrays, strict=True))
    signed = np.array([0, -1, 1, -(1 << 40), 1 << 40])
    assert ngram_trie.unzigzag(ngram_trie.zigzag(signed)).tolist() == signed.tolist()


def brute_lm(rows):
    tokens = [["<", "<", *(t or "").encode().lower().split(), None] for _, t, *_ in rows]
    learned = [i is None or zlib.crc32(str(i).encode()) % 5 != 1 for i, *_ in rows]
    taught = [t for t, yes in zip(tokens, learned, strict=True) if yes]
    c = collections.Counter(w for t in taught for w in t[2:])
    n, v = sum(c.values()), len(c)
    pairs = collections.Counter(p for t in taught for p in zip(t[1:], t[2:], strict=False))
    triples = collections.Counter(p for t in taught for p in zip(t, t[1:], t[2:], strict=False))
    one, two = collections.Counter(), collections.Counter()
    for (g, h, _), k in triples.items():
        one[h] += k
        two[g, h] += k
    u = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))
    back, prior = ngram_trie.BACK, ngram_trie.PRIOR
    for (i, *_), t in zip(rows, tokens, strict=True):
        score = sum(math.log10((triples[g, h, w] + back * (pairs[h, w] + prior * u(w))) / (two[g, h] + back * (one[h] + prior))) for g, h, w in zip(t, t[1:], t[2:], strict=False))
        yield i, len(t) - 2, sum(c[w] > 0 for w in t[2:]), sum(math.log10(u(w)) for w in t[2:]), score, n


@pytest.mark.parametrize("batch", [1 << 30, 2_000])
def test_lm_scores(docs, batch, monkeypatch):
    monkeypatch.setattr(ngram_trie, "BATCH_BYTES", batch)
    scored, n = ngram_trie.lm_scores(docs, common.remainder("doc_id", 5) != 1)
    key = lambda r: (str(r[0]), r[1], round(r[3], 3))
    for got, want in zip(sorted(map(tuple, scored.collect()), key=key), sorted(brute_lm(TEXTS), key=key), strict=True):
        assert got[:3] == want[:3] and n == want[5]
        assert got[3] == pytest.approx(want[3], abs=1e-6) and abs(got[4] - want[4]) <= 1e-3 * want[1]


@pytest.mark.parametrize("most", [0, 1, 3])
def test_lm_scores_of_common_ngrams(docs, most):
    """Whether an n-gram's documents go to its shard or stay with their batch, all figures are the same."""
    learn, figures = common.remainder("doc_id", 5) != 1, lambda scored: sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6), r.score) for r in scored.collect())
    rows = docs.union(docs.filter("doc_id < 9").withColumn("doc_id", F.col("doc_id") + 100))
    assert figures(ngram_trie.lm_scores(rows, learn, most)[0]) == figures(ngram_trie.lm_scores(rows, learn)[0])


def test_common_ngrams_apart():
    of, place = np.array([0, 1, 1, 1, 2, 2]), np.array([5, 1, 2, ngram_trie.LEARNED | 3, 4, ngram_trie.LEARNED | 4], np.uint64)
    many, places, times, common_ones, runs, own, own_times = ngram_trie._common_apart(of, place, np.array([1, 2, 3, 4, 5, 6]), 2)
    marks = [ngram_trie.APART, ngram_trie.APART | ngram_trie.LEARNED]
    assert many.tolist() == [1, 2, 2] and places.tolist() == [5, *marks, 4, ngram_trie.LEARNED | 4] and times.tolist() == [1, 5, 4, 5, 6]
    assert common_ones.tolist() == [1] and runs.tolist() == [3] and own.tolist() == [1, 2, 3] and own_times.tolist() == [2, 3, 4]


def test_lm_learns_from_nothing(docs):
    scored, n = ngram_trie.lm_scores(docs, F.lit(False))
    assert n == 0 and all(r.n_known == 0 and abs(r.score) < 1e-9 for r in scored.collect())
    assert ngram_trie.lm_scores(docs.limit(0), F.lit(True))[0].count() == 0


def test_lm_scores_a_long_run_of_an_unseen_word(spark):
    """Its terms add up to over 2**31 grid units. The word is frequent in held-out text only, and is dealt over the shards all the same."""
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    taught = [i for i in range(100, 130) if zlib.crc32(str(i).encode()) % 5 != 1]
    rows = [(held, "zzq " * 300_000), *((i, words(i, 300)) for i in taught)]
    scored, _ = ngram_trie.lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), common.remainder("doc_id", 5) != 1)
    got, want = {r.doc_id: r for r in scored.collect()}, {w[0]: w for w in brute_lm(rows)}
    assert got[held].n_known == 1 and want[held][4] * ngram_trie.GRID < -(2**31)
    for i, _ in rows:
        assert abs(got[i].score - want[i][4]) <= 1e-3 * want[i][1]


# ---- 6: line rules ----


def brute_repeats(tokens):
    seen = collections.defaultdict(list)
    for i in range(len(tokens) - 2):
        seen[tuple(tokens[i : i + 3])].append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)})


def test_line_rules(docs):
    r = random.Random(4)
    for n in (0, 1, 2, 3, 4, 50, 400):
        tokens = [r.choice((b"a", b"b", b"c", b"dd", b"e")) for _ in range(n)]
        assert line_clean.repeated_words(tokens) == brute_repeats(tokens)
    assert line_clean.line_fails("Home | About | Contact | Login", 7) and line_clean.line_fails("Licensed under CC BY 4.0.", 5) and line_clean.line_fails("a line that never ends", 5)
    assert not line_clean.line_fails("words without end. " * 15 + "and so", 47) and line_clean.line_fails("words without end " * 15, 45)
    assert not line_clean.line_fails("A plain sentence, that is all.", 6) and not line_clean.line_fails("Heading", 1)
    clean, figures = line_clean.clean_text("Good words stand here today.\nHome | A | B | C |\nGood words stand here today.")
    assert clean.count("\n") == 1 and figures[3] == 1 and figures[6] == 1
    done = {r.doc_id: r for r in line_clean.line_figures(docs).collect()}
    assert done[3].n_words == 0 and done[3].base_failed and not done[5].kept and done[0].n_words == 200
    kept = {x.doc_id: x.text for x in line_clean.keep_clean(docs).collect()}
    assert set(kept) == {i for i, x in done.items() if x.kept} and all(t == line_clean.clean_text(dict((i, t) for i, t, *_ in TEXTS)[i])[0] for i, t in kept.items())
    assert line_clean.keep_clean(docs).columns == docs.columns
    assert line_clean.line_figures(docs.limit(0)).count() == 0


def test_cleaned_texts_go_on(spark):
    body = "This is a sentence of the text, and it has an end.\n" * 2 + "\n".join(words(k, 12) + "." for k in range(6))
    rows = [(0, "Home | About | Login\n" + body + "\n\nsubscribe to our letter"), (1, body + "\nadd to basket now."), (2, "\n".join(words(90 + k, 9) for k in range(20)) + "\n" + body), (3, None)]
    df = spark.createDataFrame([(*r, r[1], 7) for r in rows], "doc_id long, text string, Text_ string, n int")
    kept = {r.doc_id: r for r in line_clean.keep_clean(df).collect()}
    assert kept[0].text == body + "\n" and kept[1].text == rows[1][1] and set(kept) == {0, 1} and kept[0]["Text_"] == rows[0][1]
    kept = {r.doc_id: r.text for r in line_clean.keep_clean(df, ("add to basket",), 0.9).collect()}
    assert kept[1] == body and kept[2] == body
    assert line_clean.line_figures(df, ("add to basket",)).filter("doc_id = 1").first().n_removed_lines == 1


def test_line_rules_of_a_very_long_text(spark):
    text = "\n".join(f"Line {k} says word{k % 1000} and then stops here." for k in range(200_000)) + "\nHome | About | Login"
    row = line_clean.line_figures(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_words, row.n_lines, row.n_removed_lines, row.n_dup_lines) == (1_600_005, 200_001, 1, 0) and row.n_symbols == 2


# ---- 7: near dedup ----


def near_rows():
    r = random.Random(9)
    rows, original = [], words(50, 150).split()
    for k in range(60):  # a star of copies: more or fewer words replaced
        copy = list(original)
        for _ in range(r.randint(0, 12)):
            copy[r.randrange(len(copy))] = f"w{r.randint(0, 10**6)}"
        rows.append((k * 3 % 61, " ".join(copy)))
    rows += [(200 + k, words(300 + k, 120) + " " + words(1, 30)) for k in range(20)]
    return rows + [(i, t) for i, t, *_ in TEXTS if i is None or i < 9]


def brute_components(rows):
    sets = [(i, set(shingles(word_hashes(t), 5).tolist())) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and None not in (i, j) and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted(((i, len(s), find(i) if i is not None else None) for i, s in sets), key=str)


@pytest.mark.parametrize("block", [512, 7])
def test_near_dedup(spark, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", block * 600)
    rows = near_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_components(df).collect()), key=str)
    assert got == brute_components(rows)
    assert near_dedup.near_components(df.limit(0)).count() == 0
    assert near_dedup.keep_one(df).columns == df.columns


def test_blocks_bring_all_pairs_across_components_together(spark):
    rows = [(7, i, 0, True) for i in range(40)] + [(7, i, i // 2, False) for i in range(40, 55)] + [(8, i, i, False) for i in range(3)]
    dealt = near_dedup._block_pairs(spark.createDataFrame(rows, "key long, doc_id long, component long, major boolean"), F.when(F.col("key") == 7, 4), F.lit(3))
    groups: dict = {}
    for r in dealt.collect():
        groups.setdefault((r.key, r.low, r.high), ([], []))[r.side].append(r.doc_id)
    met = {(key, frozenset((a, b))) for (key, low, high), (left, right) in groups.items() for a in left for b in (left if low == high else right) if a != b}
    part = {(k, d): c for k, d, c, _ in rows}
    wanted = {(k, frozenset((a, b))) for k, a in part for j, b in part if j == k and part[k, a] != part[k, b]}
    assert wanted <= met
    assert not any(pair <= set(range(40)) for key, pair in met if key == 7)


def test_near_dedup_of_long_texts_and_clashing_names(spark, crowded):
    """Copies of a very long text with words replaced, one of them past the threshold."""
    r = random.Random(19)
    long = words(77, 60_000).split()

    def copy(n):
        other = list(long)
        for at in r.sample(range(len(other)), n):
            other[at] = f"w{at}"
        return " ".join(other)

    rows = [(0, " ".join(long)), (1, copy(600)), (2, copy(1500)), (3, copy(9000)), (4, " ".join(long).upper())]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_dedup.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sorted(got.items()) == [(i, (n, c)) for i, n, c in brute_components(rows)] and got[3][1] == 3
    kept = near_dedup.keep_one(crowded)
    want = {(i, c) for i, _, c in brute_components([(i, t) for i, t, *_ in TEXTS])}
    assert kept.columns == crowded.columns and {x.doc_id for x in kept.collect()} == {i for i, c in want if i == c}


def test_shared_counts(monkeypatch):
    monkeypatch.setattr(near_dedup, "COLUMNS", 16)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 200, rng.integers(0, 90)).astype(np.uint64)) for _ in range(30)]
    got = near_dedup.shared_counts(sets[:12], sets[12:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]


def test_components(spark):
    r = random.Random(6)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(250)] + [(1000 + k, 1001 + k) for k in range(40)]
    got = {x.node: x.component for x in near_dedup.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        parent[b] = a
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


# ---- 8: language ID ----


def brute_phrases(symbols, sample):
    chars = lambda x: "".join(map(chr, x))
    text, n, at = chars(sample), 0, 0
    while at < len(symbols):
        stop = at + 1
        while stop < len(symbols) and chars(symbols[at : stop + 1]) in text:
            stop += 1
        n, at = n + 1, stop
    return n


@pytest.mark.parametrize("segment", [4, 16, 256])
def test_phrases_are_longest_matches(segment, monkeypatch):
    """Of texts shorter and longer than a lane, with runs whose parses from different places never meet."""
    monkeypatch.setattr(language_id, "SEGMENT", segment)
    r = random.Random(8)
    sample = [r.choice((0, 3, 4, 5)) for _ in range(400)] + [6] * 3 + [3]
    table = language_id.suffix_automaton(sample, 9)
    rows = [[r.choice((0, 3, 4, 5, 7, 1)) for _ in range(r.randint(0, 400))] for _ in range(40)]
    rows += [[6] * 1000, [6] * 700 + [3, 4] * 200 + [6] * 301, [], [0], sample * 2, [7] * 300]
    got = language_id.phrase_counts([np.array(x, np.int64) for x in rows], [table, table])
    assert got[0].tolist() == got[1].tolist() == [brute_phrases(row, sample) for row in rows]
    assert [len(x) for x in language_id.phrase_counts([], [table])] == [0]


def test_language_id(spark, docs):
    speech = {"en": "the quick brown fox and the lazy dog went over this hill with them ", "de": "der schnelle braune fuchs und der faule hund gingen nicht durch diese strasse ", "es": "el zorro marrón y el perro vago pasaron por esta montaña con ellos también "}
    r = random.Random(1)
    rows = [(k, " ".join(r.choice(speech[lang].split()) for _ in range(60)), lang) for k, lang in enumerate(list(speech) * 40)]
    model = language_id.fit_languages(spark.createDataFrame([*rows, (500, None, "en"), (501, "text", None)], "doc_id long, text string, lang string"))
    assert model[0] == sorted(speech)
    held = spark.createDataFrame([*((k, t) for k, t, _ in rows), (900, None), (901, "123 !"), (902, "")], "doc_id long, text string")
    got = {x.doc_id: x for x in language_id.predict(held, *model).collect()}
    assert all(got[k].lang_pred == lang and 0 < got[k].score <= 1 for k, _, lang in rows)
    assert {got[k].lang_pred for k in (900, 901, 902)} == {"und"} and got[900].score == 0
    assert language_id.predict(docs.limit(0), *model).count() == 0
    nothing = language_id.fit_languages(docs.limit(0))
    assert {x.lang_pred for x in language_id.predict(held, *nothing).collect()} == {"und"}


def test_phrases_over_many_letters():
    r = random.Random(18)
    sample = [r.choice((0, *range(3, 2000))) if r.random() < 0.5 else r.choice((3, 4, 5)) for _ in range(3000)]
    rows = [[x for _ in range(20) for at in [r.randrange(2990)] for x in (*sample[at : at + r.randint(1, 9)], r.randrange(3, 2100))] for _ in range(40)]
    got = language_id.phrase_counts([np.array(x) for x in rows], [language_id.suffix_automaton(sample, 2100)])
    assert got[0].tolist() == [brute_phrases(row, sample) for row in rows]


def test_language_id_against_brute_force(spark):
    """The whole prediction, from the learned symbols by substring search; short labelled texts, ties and repeated rows among them."""
    r = random.Random(61)
    rows = [(k, " ".join("".join(r.choice("abcdé" if k % 2 else "abcxy") for _ in range(r.randint(1, 5))) for _ in range(12)), ("one", "two")[k % 2]) for k in range(200)]
    rows += [(300 + k, f"{t} 123 -- {t.upper()}" * 9, None) for k, (_, t, _) in enumerate(rows[:20])] + [rows[0], (400, "z", None), (401, "zz zz", None), (402, "?", "one"), (403, None, "two")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    names, alphabet, automata, logs = language_id.fit_languages(table)
    taught = language_id.sample(table).collect()
    assert names == ["one", "two"] and {x.lang for x in taught} == set(names)
    learned = []
    for name in names:
        own = sorted((x["rank"], x.place, x.text) for x in taught if x.lang == name)
        learned.append(alphabet.symbols(" ".join(["", *(t for *_, t in own)])[: 2 * language_id.CHARS])[: language_id.CHARS].tolist())
    got = collections.Counter((x.doc_id, x.lang_pred, round(x.score, 9), x.n_phrases) for x in language_id.predict(table, names, alphabet, automata, logs).collect())
    want = collections.Counter()
    for i, t, _ in rows:
        symbols = alphabet.symbols(t or "").tolist()
        if not any(c.isalpha() for c in t or ""):
            want[i, "und", 0.0, 0] += 1
            continue
        counts = [brute_phrases(symbols, s) for s in learned]
        cost = sorted((n * math.log2(len(s) + 2), k) for k, (n, s) in enumerate(zip(counts, learned, strict=True)))
        want[i, names[cost[0][1]], round(1 - cost[0][0] / cost[1][0], 9), counts[cost[0][1]]] += 1
    assert got == want


def test_language_id_of_many_scripts(spark):
    """The two Han languages, and the two beyond 16 bits, have the same letters and differ in their words only."""
    r = random.Random(88)
    span = lambda a, n: [chr(a + k) for k in range(n)]
    han, gothic = span(0x4E00, 1500), span(0x10330, 17)
    scripts = {"zh": han, "yue": han, "ja": span(0x3042, 80) + span(0x30A2, 80) + han[:200], "ko": span(0xAC00, 900), "ru": span(0x430, 32), "uk": span(0x430, 32), "el": span(0x3B1, 25), "fr": list("abcdefghijklmnopqrstuvwxyzéèçàù"), "ar": span(0x628, 18), "x1": gothic, "x2": gothic}
    known = {lang: ["".join(r.choice(letters) for _ in range(r.randint(2, 5))) for _ in range(300)] for lang, letters in scripts.items()}
    rows = [(k, " ".join(r.choice(known[lang]) for _ in range(120)), lang) for k, lang in enumerate(list(scripts) * 40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, alphabet, *model = language_id.fit_languages(table)
    assert names == sorted(scripts) and alphabet.size > 1500
    got = {x.doc_id: x.lang_pred for x in language_id.predict(table, names, alphabet, *model).collect()}
    assert sum(got[k] == lang for k, _, lang in rows) >= 0.99 * len(rows)


def test_language_id_learns_from_texts_of_any_length(spark):
    """Twelve languages: of posts, of books, and of one book and one in-band text; each learns CHARS symbols where it has them."""
    r = random.Random(89)
    letters = "abcdefghijklmnop"
    known = {f"l{k:02}": ["".join(r.choice(letters) for _ in range(r.randint(3, 7))) for _ in range(200)] for k in range(12)}
    text = lambda lang, n: " ".join(r.choice(known[lang]) for _ in range(n))
    rows = []
    for k, lang in enumerate(known):
        lengths = [8] * 1500 if k % 3 == 0 else [6000] * 6 if k % 3 == 1 else [8000, 60, 60, 60, 8000, 8000]
        rows += [(len(rows) + i, text(lang, n), lang) for i, n in enumerate(lengths)]
    rows += rows[:1] * 50
    names, *model = language_id.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert names == sorted(known) and all(2**log - 2 >= 0.99 * language_id.CHARS for log in model[2])
    asked = [(k, text(lang, 60), lang) for k, lang in enumerate(list(known) * 5)]
    got = {x.doc_id: x.lang_pred for x in language_id.predict(spark.createDataFrame(asked, "doc_id long, text string, lang string"), names, *model).collect()}
    assert [got[k] for k, *_ in asked] == [lang for *_, lang in asked]


# ---- 9: quality rules ----


def test_rules_from_a_tree():
    described = "Tree\n  If (feature 0 <= 0.5)\n   If (feature 1 <= 2.0)\n    Predict: 0.0\n   Else (feature 1 > 2.0)\n    Predict: 1.0\n  Else (feature 0 > 0.5)\n   Predict: 1.0\n"
    assert quality_rules.tree_rules(described) == [((0, "<=", 0.5),), ((0, "<=", 0.5), (1, "<=", 2.0)), ((0, "<=", 0.5), (1, ">", 2.0)), ((0, ">", 0.5),)]
    assert quality_rules.tightened(((0, "<=", 0.5), (0, "<=", 0.2), (0, ">", 0.1))) == ((0, "<=", 0.2), (0, ">", 0.1))


def test_quality_rules(spark, docs):
    rows = [(k, words(k, 80) + "." if k % 4 else "BUY NOW!! " * 40, "en") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(200)] + [(None, 1), (7, None)], "doc_id long, quality int")
    model = quality_rules.fit_rules(quality_rules.labelled(df, labels))
    score = {r.doc_id: r.score for r in quality_rules.score_quality(df, *model).collect()}
    assert all((score[k] >= quality_rules.CUT) == (k % 4 > 0) for k in range(200))
    assert all(0 <= r.score <= 1 for r in quality_rules.score_quality(docs, *model).collect())
    assert quality_rules.score_quality(docs.limit(0), *model).count() == 0
    for few, want in ((labels.filter("quality = 1"), 1.0), (labels.limit(0), 0.0)):
        one = quality_rules.fit_rules(quality_rules.labelled(df, few))
        assert {r.score for r in quality_rules.score_quality(df, *one).collect()} == {want}


def test_quality_scores_against_brute_force(spark, docs):
    """Every score from the fitted rules in plain Python; repeated rows and ties in the statistics among the learned ones."""
    r = random.Random(91)
    rows = [(k, (words(k, r.randint(1, 90)) + r.choice((".", " | | |", "!!", " Licensed under X", "\n\nA B"))) * r.randint(1, 2)) for k in range(260)]
    rows += rows[:5] * 3 + [(900 + k, rows[7][1]) for k in range(6)] + [(950, None), (951, ""), (952, "   "), (None, "x"), (953, words(9, 30_000))]
    table = spark.createDataFrame([(*x, 1.0, "y") for x in rows], "doc_id long, text string, label double, features string").repartition(3)
    labels = spark.createDataFrame([(i, int(r.random() < (0.9 if len(t or "") > 250 else 0.2))) for i, t in dict(rows).items() if i is not None], "doc_id long, quality int")
    sample = quality_rules.labelled(table, labels)
    assert sample.count() == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in dict(rows) if i is not None)
    intercept, rules = quality_rules.fit_rules(sample)
    assert rules

    def figures(text):
        parts = re.split(r"[ \t\n\x0b\f\r]+", text.strip(" "))  # a text of no words has one empty part
        while len(parts) > 1 and not parts[-1] and not text:
            parts.pop()
        n = len(parts)
        marks = [text.count(m) / n for m in quality_rules.MARKS.values()]
        return [*marks, math.log1p(len(text)), len(text) / n, len(set(parts)) / n, sum("A" <= c <= "Z" for c in text) / n, n / (1 + text.count("\n")), float("licensed under" in text.lower() or "all rights reserved" in text.lower())]

    def score(text):
        x = figures(text or "")
        total = intercept + sum(w for rule, w in rules if all((x[k] <= cut) if sign == "<=" else (x[k] > cut) for k, sign, cut in rule))
        return 1 / (1 + math.exp(-total))

    got = quality_rules.score_quality(table, intercept, rules).collect()
    key = lambda x: (str(x[0]), round(x[1], 9))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(((i, score(t)) for i, t in rows), key=key), strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-9)


def test_statistics_have_their_names(spark):
    assert list(quality_rules.statistics(F.lit("a"))) == quality_rules.NAMES


# ---- 10: chat formatting ----


def test_chats_round_trip(spark):
    hard = ["\\", "\\l", "[INST]", "</s>", "<", "[+]", "a\\bt[", "", None, "日本 [ROLE=x] é", chat_format.HOSTILE, "]"]
    r = random.Random(2)
    turns = [(c, t, r.choice(("user", "assistant", "system", "too]l", "INST", None)), r.choice(hard)) for c in (0, 1, 2, None) for t in range(60)]
    turns += [(3, 0, "user", "twice"), (3, 0, "user", "twice"), (3, 0, "assistant", None)]
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, turns string").repartition(3)
    got = {x.conv_id: x for x in chat_format.parse_chats(chat_format.format_chats(df)).collect()}
    for c in (0, 1, 2, 3, None):
        want = sorted((t, role or "", text or "") for k, t, role, text in turns if k == c)
        assert [(x.role, x.text) for x in got[c].turns] == [(role, text) for _, role, text in want]
        assert got[c].loss_text == "".join(text for _, role, text in want if role == "assistant")
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_a_long_conversation_and_clashing_names(spark):
    n = 60_000
    df = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 2, "assistant").otherwise("user").alias("role"), F.concat(F.lit("t["), F.col("id").cast("string")).alias("text"))
    df = df.select("*", *(F.lit("x").alias(c) for c in ("start", "size", "lead", "escaped", "turns", "first", "formatted", "loss_spans")))
    chat = chat_format.format_chats(df).first()
    spans = [chat.formatted[s.start : s.start + s.length] for s in chat.loss_spans]
    assert spans == [f"t\\l{k}" for k in range(2, n, 3)] and chat.formatted.count("</s>") == 2 * n // 3
