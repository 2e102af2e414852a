"""Operators 11 to 13 against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from geomill.llm import hard_negatives, merkle_manifest, simhash

# ---- 11: hard negatives ----

VECTORS = "vec_id long, embedding array<float>, label int, v string, part int"


def mined(rows, anchor, positives=5, negatives=3, low=50, high=95):
    """By the statement of the task, over (vec_id, label, integers)."""
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, label, a in (r for r in rows if anchor(r[0])):
        scored = sorted(((-dot(a, b), j, other) for j, other, b in rows if j != i))
        for ps, j in [(-s, j) for s, j, other in scored if other == label][:positives]:
            fit = [(-s, k) for s, k, other in scored if other != label and low * ps <= 100 * -s <= high * ps]
            out += [(i, j, n, k, ps, s) for n, (s, k) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def vectors_of(rng, n, m, labels, noise=1.0):
    centres = rng.normal(size=(labels, m))
    return [(k, (centres[k % labels] + noise * rng.normal(size=m)).astype(np.float32).tolist(), int(k % labels), "x", 1) for k in range(n)]


def integers(rows):
    whole = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label, *_ in rows if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)]
    return list({i: (i, label, v) for i, label, v in sorted(whole, reverse=True)}.values())


def mine(spark, rows, anchor="vec_id % 10 = 0"):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    usable = hard_negatives.usable(df, F.col("label"), F.transform("embedding", lambda x: x.cast("double"))).withColumn("v", F.transform("v", lambda x: F.floor(256 * x).cast("double")))
    out = hard_negatives.hard_negatives(usable, F.expr(anchor))
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in out.collect())


def test_hard_negatives_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", 64)
    monkeypatch.setattr(hard_negatives, "QUERY_BLOCK", 8)
    monkeypatch.setattr(hard_negatives, "QUERIES", 4)
    rng = np.random.default_rng(3)
    rows = vectors_of(rng, 400, 24, 4)
    rows += [(k, rows[k % 7][1], 1, "x", 1) for k in range(400, 440)]  # ties
    rows += [rows[5], (900, None, 1, "x", 1), (910, [1.0, None], 1, "x", 1), (920, [float("nan")], 1, "x", 1), (930, [1.0], None, "x", 1), (None, [1.0], 1, "x", 1), (940, [], 2, "x", 1), (950, [0.5, 2.0], 2, "x", 1), (960, [1.0] * 24, 77, "x", 1), (970, [-1.0] * 24, 3, "x", 1)]
    assert mine(spark, rows) == mined(integers(rows), lambda i: i % 10 == 0)


def test_hard_negatives_of_a_hot_label_and_of_nothing(spark):
    rng = np.random.default_rng(4)
    rows = [(k, v, 0 if k % 3 else 1 + k % 5, *rest) for k, v, _, *rest in vectors_of(rng, 200, 8, 5, 0.1)]
    assert mine(spark, rows) == mined(integers(rows), lambda i: i % 10 == 0)
    assert mine(spark, []) == [] and mine(spark, [(0, [1.0], 1, "x", 1)]) == []


def test_index_finds_all_and_leaves_out_lists():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(500, 32)) * np.linspace(4, 0.1, 32), rng.normal(size=(40, 32)) * np.linspace(4, 0.1, 32)
    scores, norms = y @ x.T, np.linalg.norm(y, axis=1)
    for share in (0.9, 0.5, 0.1):
        least = share * norms * np.linalg.norm(x, axis=1).max()
        index = hard_negatives.Index(x, (least / norms).min())
        q, r, s = index.search(y, least)
        assert sorted(zip(q, r, strict=True)) == sorted(zip(*np.nonzero(scores >= least[:, None]), strict=True))
        assert np.allclose(s, scores[q, r])
        assert (index.lists != 0).sum() < x.size


# ---- 12: Merkle manifest ----

ROWS = "doc_id long, text string, lang string, source string, n_chars long, nth long, tree string, hash string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    value = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    return h(*map(value, (doc_id, source, lang, n_chars, text)))


def fold_up(levels, i, node):
    proof = []
    for level in levels[:-1]:
        first = i // 16 * 16
        before, after = level[first:i], level[i + 1 : first + 16]
        proof += before + after
        node, i = h(*before, node, *after), i // 16
    return proof, node


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def manifest_of(rows):
    """rows (doc_id, text, lang, source, n_chars): by the statement of the task."""
    lower = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    sources = {}
    for i, text, lang, source, n in rows:
        own = leaf_of(i, source, lang, n, text)
        bad = leaf_of(i, source, lang, n, lower(text)) if i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else own
        sources.setdefault(source, []).append(((i is not None, i or 0), own, bad, i))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([own for _, own, *_ in sorted(sources[s])]) for s in order}
    whole, out = levels_of([trees[s][-1][0] for s in order]), []
    for at, s in enumerate(order):
        for k, (_, own, bad, i) in enumerate(sorted(sources[s])):
            low, node = fold_up(trees[s], k, bad)
            high, node = fold_up(whole, at, node)
            out.append((i, own, trees[s][-1][0], whole[-1][0], h(*low, *high), node, node == whole[-1][0]))
    return out


def shown(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()), key=str)


def manifest(spark, rows):
    df = spark.createDataFrame([(*r, 1, "t", "h") for r in rows], ROWS).repartition(3)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return shown(merkle_manifest.manifest(df, chosen, F.translate("text", merkle_manifest.UPPER, merkle_manifest.LOWER)))


def test_manifest_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(k * 3, f"Text {k} É" if k % 9 else None, None if k % 11 == 0 else "en", rng.choice(["big"] * 6 + ["Ünit", "b", None]), k) for k in range(8000)]  # over one builder of `big`
    rows += [(1, "Solo", "en", "one row", 4), (2, "", "", "", None), (2, "", "", "", None), (None, "No Id", "en", "big", 3), (1, "A", "en", "big", 1), (1, "B", "en", "big", 1)]
    rows += [(10_000 + k, f"s{k}", "en", f"source {k}", 1) for k in range(40)]
    assert manifest(spark, rows) == sorted(manifest_of(rows), key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 257])
def test_manifest_of_few_rows(spark, n):
    rows = [(k, f"Row {k}", "en", "a", 1) for k in range(n)]
    assert manifest(spark, rows) == sorted(manifest_of(rows), key=str)


def test_positions_are_those_of_the_log():
    for n in (1, 2, 15, 16, 17, 256, 257, 300, 4095, 4096):
        leaves = [h(str(k)) for k in range(n)]
        height = merkle_manifest.local_height(n)
        log, levels = merkle_manifest.append_log(leaves, height), levels_of(leaves)
        assert len(log) == sum(map(len, levels)) and height == len(levels) - 1
        for level, nodes in enumerate(levels):
            last = np.minimum((np.arange(len(nodes)) + 1) * 16**level, n) - 1
            assert [log[p] for p in merkle_manifest.position(level, last)] == nodes


def test_a_changed_byte_shows(spark):
    rows = [(k, f"row {k}", "en", "ab"[k % 2], 1) for k in range(100)]
    df = spark.createDataFrame([(*r, 1, "t", "h") for r in rows], ROWS)
    got = merkle_manifest.manifest(df, F.col("doc_id") == 7, F.concat("text", F.lit(" "))).collect()
    assert [r.doc_id for r in got if not r.verified] == [7] and len(got) == 100


# ---- 13: SimHash ----

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint long, part int, key string"


def plain_simhash(text):
    """Bit by bit over the operator's term hashes."""
    counts = {}
    for t in simhash.terms(simhash.word_hashes(text)).tolist():
        counts[t] = counts.get(t, 0) + 1
    out = 0
    for bit in range(64):
        if sum((1 + math.log2(n)) * (1 if t >> bit & 1 else -1) for t, n in counts.items()) > 1e-9:
            out |= 1 << bit
    return out


def sentence(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(n))


TEXTS = [(k, sentence(k, 5 + 7 * (k % 20))) for k in range(60)] + [(100, None), (101, ""), (102, " \n "), (103, "word"), (104, sentence(1, 12)), (105, sentence(1, 12)), (106, sentence(2, 30_000)), (7, sentence(77, 9)), (None, sentence(78, 40)), (107, "ÉÉ 日本語 " * 50)]


def asked(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1, 2, 3, "k") for i, t in texts], DOCS)


def test_fingerprints_bit_by_bit(spark):
    got = simhash.fingerprints(asked(spark, TEXTS).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.fingerprint % (1 << 64)) for r in got) == sorted((str(i), plain_simhash(t)) for i, t in TEXTS)
    assert plain_simhash("One two THREE four") == plain_simhash("one  two\tthree four") != plain_simhash("one two three five")


@pytest.mark.parametrize("parts", [1, 7])
def test_next_rows_meet_across_partitions(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = simhash.with_next(asked(spark, TEXTS[:-3] + TEXTS[-2:]).repartition(3)).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    rows = sorted(((i, t or "") for i, t in TEXTS[:-3] + TEXTS[-2:] if i is not None), reverse=True) + [(None, t) for i, t in TEXTS if i is None]
    want = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 3
        changed = t[: len(t) - cut] + following[:cut]
        want.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), *map(simhash.simhash, (t, changed, following))))
    u = lambda v: v % (1 << 64)
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, u(r.fingerprint), u(r.edited_fingerprint), u(r.next_fingerprint)) for r in got), key=str) == sorted(want, key=str)


def test_next_row_of_one_row_and_of_none(spark):
    one = simhash.with_next(asked(spark, [(5, "abc def ghi")])).collect()
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in one] == [(5, 11, hashlib.sha256(b"abc def abc").hexdigest())]
    assert simhash.with_next(asked(spark, [])).count() == 0


@pytest.mark.parametrize("crowd", [2048, 16])
def test_all_within_the_radius(spark, monkeypatch, crowd):
    """One cluster round a value, pairs at all small distances, and others at random; crowded keys split into blocks."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    r = random.Random(9)
    values = {r.getrandbits(64) for _ in range(300)}
    for v in list(values)[:60]:
        values.add(v ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 5))))
    centre = r.getrandbits(64)
    values |= {centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 2))) for _ in range(150)}
    copies = {v: r.randint(1, 4) for v in values}
    df = spark.createDataFrame([(simhash._signed(v), c) for v, c in copies.items()], "fingerprint long, copies long")
    for radius in (1, 3):
        want = {}
        for v in values:
            near = [w for w in values if 0 < (v ^ w).bit_count() <= radius]
            if near:
                want[v] = (len(near), sum(copies[w] for w in near))
        got = {row.fingerprint % (1 << 64): (row.near, row.near_rows) for row in simhash.within_radius(df, radius).collect()}
        assert got == want


def test_blocks_grow_with_the_rows():
    for rows in (1, 10**3, 10**6, 10**9):
        b = simhash.blocks_for(rows, 3)
        assert (b - 3) * 64 / b >= math.log2(max(rows, 2)) + 4
        masks = simhash.tables(b, 3)
        r = random.Random(rows)
        for _ in range(200):
            apart = sum(1 << k for k in r.sample(range(64), 3))
            assert any(apart & m == 0 for m in masks)
