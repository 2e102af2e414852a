"""Operator 7: near-duplicate groups by MinHash, banding, verification and star contraction.

A document's set is its distinct 5-word shingles (64-bit hashes). MINIMA universal hash functions give its signature;
BANDS bands of ROWS minima give the buckets in which documents meet (two documents of similarity 0.75 miss each
other in all 32 bands with probability 5e-6). Nobody emits all pairs of a bucket:

1. every member is paired with the bucket's hub only, the member that meets most documents over all its buckets (the
   original of a group of copies, as a rule); pairs of equal sets are links at once, others must agree in enough minima
   (MARGIN standard deviations below the threshold) and are then confirmed on full sets;
2. components of these links are found; in buckets whose members are still in different components, signatures are compared in
   blocks of BLOCK members (a block pair is one group; blocks of the bucket's largest component are not compared with each
   other, so one large group of copies costs its members times the few outside it), which leaves the members that agree in enough minima with one of
   another component. Only their texts are moved, to be compared on full sets in blocks of BLOCK_SHINGLES shingles:
   intersections of all pairs come from one matrix product, and of the pairs that reach the threshold only those that join two
   components leave the task, so its output is never more than its members. Buckets with the same members are compared once;
3. components of all links come from alternating large-star and small-star rounds until no edge changes.

Defined cases: a null text or one without words has an empty set and is linked with nothing; with fewer than five words
the whole sequence is the one shingle; rows of one doc_id count as one document, linked by the links of any of
them; a null doc_id is linked with nothing; an empty table gives an empty result; other columns are ignored, whatever their
names. A bucket, a set or a hub may hold any part of all rows: joins tell large ones by their counts (`join_uneven`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomill.llm.common import documents, drop_staged, files_for, join_uneven, staged, text_of
from geomill.llm.words import shingles, word_hashes

SIZE, THRESHOLD = 5, 75  # words of a shingle, per cent of the union
BANDS, ROWS = 32, 4
MINIMA, MARGIN, BLOCK, BLOCK_SHINGLES, COLUMNS, SHARE = BANDS * ROWS, 5.5, 512, 300_000, 4096, 256
ROWS_PER_FILE, DOCS_PER_FILE = 500_000, 20_000
LEAST = int(MINIMA * (THRESHOLD / 100 - MARGIN * (THRESHOLD / 100 * (1 - THRESHOLD / 100) / MINIMA) ** 0.5))  # equal minima

_rng = np.random.Generator(np.random.PCG64(40_031))
_factors = _rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_terms = _rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64)


def signature(items: np.ndarray) -> np.ndarray:
    """The upper 32 bits of the smallest a * x + b (mod 2**64) for each hash function."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 512):
        values = np.multiply.outer(_factors, items[at : at + 512])
        values += _terms[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= THRESHOLD * (len(a) + len(b) - both)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, whole, sig = [], [], []
        for text in batch["text"].to_pylist():
            items = shingles(word_hashes(text), SIZE)
            n.append(len(items))
            whole.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
            sig.append(signature(items).tobytes() if len(items) else None)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(whole, pa.binary()), pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "set_key", "signature"])


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the whole set), signature (MINIMA unsigned 32-bit numbers)."""
    return docs.select("doc_id", "text").mapInArrow(_signed, "doc_id long, n_shingles long, set_key binary, signature binary")


# ---- components ----


def _tally(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node with an edge (u, v), by large-star and small-star."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
    before = _tally(edges)
    files = files_for(before[0], ROWS_PER_FILE)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        last, edges = edges, staged(small.filter("u != v").distinct(), "edges", files)
        if hasattr(last, "staged_path"):
            drop_staged(last)
        after = _tally(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select("v", "v").distinct().toDF("node", "component"))


# ---- candidates and their confirmation ----


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), "<u4").reshape(-1, MINIMA) for c in ("sig_a", "sig_b"))
            yield batch.filter(pa.array((a == b).sum(axis=1) >= LEAST)).select(["a", "b"])


def _confirmed(members: pa.Table, hubs: pa.Table) -> pa.Table:
    out = []
    sets = [shingles(word_hashes(t), SIZE) for t in hubs["hub_text"].to_pylist()]
    if sets:
        for doc, text in zip(members["a"].to_pylist(), members["text"].to_pylist(), strict=True):
            own = shingles(word_hashes(text), SIZE)
            if any(similar(own, s) for s in sets):
                out.append(doc)
    hub = members["b"][0].as_py() if members.num_rows else None
    return pa.table({"u": pa.array(out, pa.int64()), "v": pa.array([hub] * len(out), pa.int64())})


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold, as edges (u, v). Members meet their partner b in shares of
    SHARE, b's text going to each share."""
    counts = pairs.groupBy("b").agg(F.count("*").alias("n")).withColumn("shares", F.ceil(F.col("n") / SHARE).cast("int"))
    members = join_uneven(pairs, counts, "b", "n", pairs.count()).withColumn("share", F.pmod(F.xxhash64("a"), F.col("shares")).cast("int"))
    members = members.join(texts.select(F.col("doc_id").alias("a"), "text"), "a").select("a", "b", "share", "text")
    hubs = counts.select(F.col("b").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("hub_share"))
    hubs = hubs.join(texts.select(F.col("doc_id").alias("hub"), F.col("text").alias("hub_text")), "hub").select("hub", "hub_share", "hub_text")
    return members.groupBy("b", "share").cogroup(hubs.groupBy("hub", "hub_share")).applyInArrow(_confirmed, "u long, v long")


def _agreeing_pairs(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs (a, b) that agree in enough minima. b may be the hub of any part of all rows."""
    counts = pairs.groupBy("b").agg(F.count("*").alias("n"))
    hubs = counts.join(signed.select(F.col("doc_id").alias("b"), F.col("signature").alias("sig_b")), "b")
    both = join_uneven(pairs, hubs, "b", "n", pairs.count()).join(signed.select(F.col("doc_id").alias("a"), F.col("signature").alias("sig_a")), "a")
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(_agreeing, "a long, b long").distinct()


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set: a product of 0/1 matrices, COLUMNS items at a time."""
    items, place, often = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    useful = often[place] > 1  # an item of one set only is shared with none
    order = np.argsort(place[useful], kind="stable")
    place, rows = place[useful][order], rows[useful][order]
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(items), COLUMNS):
        a, b = np.searchsorted(place, [at, at + COLUMNS])
        if a < b:
            columns, own = np.unique(place[a:b], return_inverse=True)
            marks = np.zeros((len(left) + len(right), len(columns)), np.float32)
            marks[rows[a:b], own] = 1
            out += marks[: len(left)] @ marks[len(left) :].T
    return out.astype(np.int32)


def _across(group: pa.Table) -> pa.Table:
    """Links that join the components of a block pair's two sides (one side: a block with itself)."""
    side, doc, part = (group[c].to_numpy() for c in ("side", "doc_id", "component"))
    sets = [shingles(word_hashes(t), SIZE) for t in group["text"].to_pylist()]
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    right = right if group["low"][0].as_py() != group["high"][0].as_py() else left
    u, v = [], []
    if len(left) and len(right):
        sizes = np.array(list(map(len, sets)))
        both = shared_counts([sets[i] for i in left], [sets[i] for i in right])
        far = part[left][:, None] != part[right][None, :]
        i, j = np.nonzero(far & (both > 0) & (100 * both >= THRESHOLD * (sizes[left][:, None] + sizes[right][None, :] - both)))
        names, place = np.unique(part, return_inverse=True)
        _, one = np.unique(place[left[i]] * len(names) + place[right[j]], return_index=True)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for k in one.tolist():
            a, b = find(part[left[i[k]]]), find(part[right[j[k]]])
            if a != b:
                root[a] = b
                u.append(doc[left[i[k]]])
                v.append(doc[right[j[k]]])
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _agreeing_members(group: pa.Table) -> pa.Table:
    """The members of a block pair that agree in enough minima with one of the other side in another component."""
    side, doc, part = (group[c].to_numpy() for c in ("side", "doc_id", "component"))
    signs = np.frombuffer(b"".join(group["signature"].to_pylist()), "<u4").reshape(-1, MINIMA)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    right = right if group["low"][0].as_py() != group["high"][0].as_py() else left
    found = np.zeros(len(doc), bool)
    for i in left:
        met = right[((signs[right] == signs[i]).sum(axis=1) >= LEAST) & (part[right] != part[i])]
        found[met] = True
        found[i] |= len(met) > 0
    docs = np.unique(doc[found])
    return pa.table({"key": pa.array([group["key"][0].as_py()] * len(docs), pa.int64()), "doc_id": pa.array(docs, pa.int64())})


def _block_pairs(members: DataFrame, majors: Column, minors: Column) -> DataFrame:
    """Members (key, doc_id, component, major) dealt into blocks, each going to all pairs of its block with another or itself: key, low, high,
    side, doc_id, component. `major` marks the key's largest component, which has the first `majors` blocks: pairs of two of these hold no
    link across components and are left out."""
    least_one = lambda n: F.greatest(F.lit(1), F.coalesce(n, F.lit(0)).cast("int"))
    dealt = members.withColumn("majors", least_one(majors)).withColumn("minors", least_one(minors))
    own = F.when(F.col("major"), F.pmod(F.xxhash64("doc_id"), F.col("majors"))).otherwise(F.col("majors") + F.pmod(F.xxhash64("doc_id"), F.col("minors")))
    dealt = dealt.withColumn("block", own.cast("int"))
    mates = F.transform(
        F.sequence(F.when(F.col("major"), F.col("majors")).otherwise(0), F.col("majors") + F.col("minors") - 1),
        lambda k: F.struct(F.least(F.col("block"), k).alias("low"), F.greatest(F.col("block"), k).alias("high"), F.when(F.col("block") <= k, 0).otherwise(1).alias("side")),
    )
    return dealt.withColumn("mate", F.explode(mates)).select("key", "mate.low", "mate.high", "mate.side", "doc_id", "component")


def open_links(buckets: DataFrame, labels: DataFrame, signed: DataFrame, texts: DataFrame, files: int) -> DataFrame:
    """Links across components in buckets that the links so far leave apart, found block by block."""
    named = buckets.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    named = staged(named.select("key", "doc_id", "component"), "named-buckets", files)
    parts = named.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("members"))
    apart = parts.groupBy("key").agg(F.sum("n").alias("n"), F.sum("members").alias("members"), F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("most"))
    once = apart.filter("n > 2 AND parts > 1").groupBy("n", "members").agg(F.min(F.struct("key", "most")).alias("one"))
    once = once.select("one.key", "n", F.col("one.most.n").alias("n_major"), F.col("one.most.component").alias("most"))
    left = join_uneven(named, once, "key", "n", named.count()).withColumn("major", F.col("component") == F.col("most"))
    left = staged(left.select("key", "n", "n_major", "major", "doc_id", "component"), "open-buckets", files)
    sized = signed.join(left.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "n_shingles", "signature")
    compared = _block_pairs(left, F.ceil(F.col("n_major") / BLOCK), F.ceil((F.col("n") - F.col("n_major")) / BLOCK))
    compared = compared.join(sized.drop("n_shingles"), "doc_id").groupBy("key", "low", "high")
    agreeing = staged(compared.applyInArrow(_agreeing_members, "key long, doc_id long").distinct(), "agreeing-members", files)
    sizes = sized.groupBy("doc_id").agg(F.sum("n_shingles").alias("n_shingles"))
    met = agreeing.join(left.drop("n", "n_major"), ["key", "doc_id"]).join(sizes, "doc_id")
    of = lambda side: F.sum(F.when(side, F.col("n_shingles")))
    whole = met.groupBy("key").agg(of(F.col("major")).alias("of_major"), of(~F.col("major")).alias("of_minor"))
    dealt = _block_pairs(met.join(whole, "key"), F.ceil(F.col("of_major") / BLOCK_SHINGLES), F.ceil(F.col("of_minor") / BLOCK_SHINGLES))
    return dealt.join(texts, "doc_id").groupBy("key", "low", "high").applyInArrow(_across, "u long, v long")


def near_components(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept."""
    n = docs.count()
    light, heavy = files_for(n * BANDS, 16 * ROWS_PER_FILE), 2 * files_for(n, DOCS_PER_FILE)
    signed = staged(signatures(docs), "signatures")  # as many tasks as the scan has
    known = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring("signature", k * (4 * ROWS) + 1, F.lit(4 * ROWS))))
    banded = known.select("doc_id", F.explode(keys).alias("key")).distinct()
    crowds = banded.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = staged(banded.join(crowds, "key"), "buckets", light)
    degrees = buckets.groupBy("doc_id").agg(F.sum("n").alias("degree"))
    hubs = buckets.join(degrees, "doc_id").groupBy("key").agg(F.max(F.struct("degree", (-F.col("doc_id")).alias("less"))).alias("hub"), F.first("n").alias("size"))
    hubs = hubs.select("key", (-F.col("hub.less")).alias("hub"), "size")
    pairs = join_uneven(buckets, hubs, "key", "size", n * BANDS).filter("doc_id != hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    met = staged(known.join(degrees.select("doc_id"), "doc_id", "left_semi"), "met", light)

    sets = met.groupBy("set_key").agg(F.min("doc_id").alias("v"), F.count("*").alias("n")).filter("n > 1")
    equal = join_uneven(met.select("doc_id", "set_key"), sets, "set_key", "n", n)
    equal = staged(equal.filter("doc_id != v").select(F.col("doc_id").alias("u"), "v").distinct(), "equal-sets", light)
    first = met.select("doc_id").distinct().join(equal.select(F.col("u").alias("doc_id")), "doc_id", "left_anti")
    for side in ("a", "b"):  # one document stands for all of an equal set
        pairs = pairs.join(equal.select(F.col("u").alias(side), F.col("v").alias("first")), side, "left").withColumn(side, F.coalesce("first", side)).drop("first")
    pairs = staged(pairs.filter("a != b").distinct(), "hub-pairs", light)
    near = staged(_agreeing_pairs(pairs, met), "near-pairs", light)
    texts = staged(docs.select("doc_id", text_of().alias("text")).join(first, "doc_id"), "met-texts", heavy)
    links = staged(equal.unionByName(confirmed(near, texts)), "links", heavy)
    more = staged(open_links(buckets.select("key", "doc_id").join(first, "doc_id", "left_semi"), components(links), met, texts, light), "more-links", heavy)
    labels = components(links.unionByName(more))
    named = signed.select("doc_id", "n_shingles").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return named.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents whose doc_id is the smallest of their group, with all their columns."""
    dropped = near_components(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir))


_SETS = r"""
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b USING (shingle) JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, na.n_shingles, nb.n_shingles HAVING 100 * count(*) >= 75 * (na.n_shingles + nb.n_shingles - count(*)))
"""
ORACLE = f"""
WITH RECURSIVE {_SETS.strip()},
r AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, l.v FROM r JOIN l ON l.u = r.seen)
SELECT d.doc_id, coalesce(n_shingles, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
"""
