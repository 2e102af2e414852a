"""Operator 12: a Merkle manifest of a dataset, kept as logs in postorder.

Every row is a leaf; the leaves of a source, in ascending doc_id, are one tree of ARITY children a node, and the roots of the
sources' trees are the leaves of the tree of the whole. Trees are built by aligned builders: a builder takes BLOCK = ARITY ** LEVELS
neighbouring leaves of one tree, which are whole subtrees but for the last, and appends every node when its last leaf has come
(`append_log`), so its log is in postorder; builders' roots are the leaves of the builders above them. No node stores an address:
`position` gives a node's place in its log from the sizes of the subtrees before it, and with it proofs are read (`sibling_texts`).

Leaves are hashed by column expressions where they are read, so no text is shuffled. Ranks in a source come from a range sort and the counts of
its partitions, so a source may hold any part of all rows; what leaves a builder is one log. Paths go down from the top: a builder's own levels
are joined with the path above its root, and only then meet the rows.

Defined cases: a null source is a source of its own, before all others; a null doc_id comes first in its source; rows of one
doc_id go by their leaf, equal rows are leaves of their own; nulls are hashed as `-`, which no value is; a source of one row has
its leaf as root, a table of one source has that source's root; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from geomill.llm.common import documents, staged

BITS, LEVELS = 4, 3
ARITY, BLOCK = 1 << BITS, 1 << BITS * LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "tree string, block long, n long, size long, nodes binary, root string"
PATH = "array<struct<left:string,right:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---- a log in postorder ----


def height_of(n: int) -> int:
    """Levels above n leaves until one node remains."""
    h = 0
    while n > 1 << BITS * h:
        h += 1
    return h


def position(level: int, last: np.ndarray) -> np.ndarray:
    """The place in a log of the node of `level` whose last leaf is number `last`: before that leaf came all nodes of whole subtrees
    of earlier leaves, ARITY ** j to a subtree of level j, and after it the node's own levels."""
    return sum((last >> BITS * j for j in range(1, LEVELS + 1)), last) + level


def append_log(leaves: list[str], height: int) -> list[str]:
    """All nodes up to `height` in the order of their completion; the last run of a level may be short."""
    log, waiting = [], [[] for _ in range(height + 1)]

    def append(level: int, node: str) -> None:
        log.append(node)
        waiting[level].append(node)
        if len(waiting[level]) == ARITY:
            close(level)

    def close(level: int) -> None:
        run = waiting[level]
        if run and level < height:
            waiting[level] = []
            append(level + 1, digest("".join(run)))

    for leaf in leaves:
        append(0, leaf)
    for level in range(height):
        close(level)
    return log


def sibling_texts(log: str, size: int, height: int, level: int) -> list[tuple[str, str]]:
    """For every node of a level the digests of its run before and after it, read from the log (64 characters a node) by position."""
    step = BITS * level
    last = np.minimum(np.arange(1, ((size - 1) >> step) + 2) << step, size) - 1
    nodes = [log[64 * p : 64 * p + 64] for p in position(level, last).tolist()]
    out = []
    for first in range(0, len(nodes), ARITY):
        run = nodes[first : first + ARITY]
        out += [("".join(run[:k]), "".join(run[k + 1 :])) for k in range(len(run))]
    return out


def local_height(n: int) -> int:
    return min(LEVELS, height_of(n))


def local_paths(log: str, size: int, n: int, above: list[tuple[str, str]], level: int = 0) -> list[list[tuple[str, str]]]:
    """For every node of a level of a log its path to the root of all: (digests before, digests after) from level to level."""
    height = local_height(n)
    levels = [sibling_texts(log, size, height, k) for k in range(level, height)]
    count = ((size - 1) >> BITS * level) + 1
    return [[texts[i >> BITS * k] for k, texts in enumerate(levels)] + above for i in range(count)]


def folded(node: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        node = digest(left + node + right)
    return node


# ---- building ----


def ranked(nodes: DataFrame, *order: str) -> DataFrame:
    """nodes (tree, ...) with `nth`, their number in their tree by `order`, and `n`, their tree's size."""
    dealt = nodes.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "_tie").sortWithinPartitions("tree", *order)
    sorted_ = staged(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()).drop("_tie"), "sorted-leaves")
    runs = sorted_.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_run"))
    before = W.partitionBy("tree").orderBy("_part")  # a row for each partition that a tree reaches into
    runs = runs.select("tree", "_part", "_first", (F.sum("_run").over(before) - F.col("_run")).alias("_before"), F.sum("_run").over(W.partitionBy("tree")).alias("n"))
    runs = staged(runs, "leaf-runs")
    return sorted_.join(runs, ["tree", "_part"]).withColumn("nth", F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_at", "_first", "_before")


def _built(group: pa.Table) -> pa.Table:
    leaves = group["hash"].take(pa.array(np.argsort(group["nth"].to_numpy(), kind="stable"))).to_pylist()
    n = group["n"][0].as_py()
    log = append_log(leaves, local_height(n))
    row = {"tree": group["tree"][0].as_py(), "block": group["block"][0].as_py(), "n": n, "size": len(leaves), "nodes": bytes.fromhex("".join(log)), "root": log[-1]}
    return pa.Table.from_pylist([row], schema=pa.schema([("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("size", pa.int64()), ("nodes", pa.binary()), ("root", pa.string())]))


def build(leaves: DataFrame) -> list[DataFrame]:
    """The logs (SEGMENT) of all trees of leaves (tree, nth, n, hash), from the lowest builders to the one at the top of each tree."""
    rounds = []
    while True:
        dealt = leaves.select("tree", F.floor(F.col("nth") / BLOCK).alias("block"), "nth", "n", "hash")
        logs = staged(dealt.groupBy("tree", "block").applyInArrow(_built, SEGMENT), "merkle-logs")
        rounds.append(logs)
        leaves = logs.filter(F.col("n") > BLOCK).select("tree", F.col("block").alias("nth"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("root").alias("hash"))
        if leaves.isEmpty():
            return rounds


def roots(rounds: list[DataFrame]) -> DataFrame:
    """tree, root."""
    tops = [logs.filter(F.col("n") <= BLOCK).select("tree", "root") for logs in rounds]
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out


# ---- proofs ----


def _paths_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pair = pa.struct([("left", pa.string()), ("right", pa.string())])
    for batch in batches:
        trees, nth, paths, tops = [], [], [], []
        for row in batch.to_pylist():
            own = local_paths(row["nodes"].hex(), row["size"], row["n"], [(s["left"], s["right"]) for s in row["above"]])
            trees += [row["tree"]] * len(own)
            nth += range(row["block"] * BLOCK, row["block"] * BLOCK + len(own))
            paths += [[{"left": a, "right": b} for a, b in p] for p in own]
            tops += [row["top"]] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(trees, pa.string()), pa.array(nth, pa.int64()), pa.array(paths, pa.list_(pair)), pa.array(tops, pa.string())], ["tree", "nth", "above", "top"])


def with_paths(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest logs with `above`, the path from their root to the top, and `top`, from the paths (tree, above, top) of the trees' roots."""
    paths = None
    for logs in reversed(rounds):
        found = logs.filter(F.col("n") <= BLOCK).join(above, "tree")
        if paths is not None:
            found = found.unionByName(logs.filter(F.col("n") > BLOCK).join(paths.withColumnRenamed("nth", "block"), ["tree", "block"]))
        if logs is rounds[0]:
            return found
        paths = staged(found.mapInArrow(_paths_down, f"tree string, nth long, above {PATH}, top string"), "merkle-paths")
    raise AssertionError


def _proven(rows: pa.Table, logs: pa.Table) -> pa.Table:
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    out = [[] for _ in names]
    for log in logs.to_pylist():
        text, size, height = log["nodes"].hex(), log["size"], local_height(log["n"])
        above = [(s["left"], s["right"]) for s in log["above"]]
        first = sibling_texts(text, size, height, 0) if height else [("", "")]
        upper = local_paths(text, size, log["n"], above, 1) if height else [above]
        rest = ["".join(left + right for left, right in path) for path in upper]
        places = position(0, np.arange(size)).tolist()
        known: dict[tuple[int, str], str] = {}
        for doc_id, nth, tampered in zip(*(rows[c].to_pylist() for c in ("doc_id", "nth", "tampered")), strict=True):
            i = nth - log["block"] * BLOCK
            leaf, run = text[64 * places[i] : 64 * places[i] + 64], i >> BITS
            left, right = first[i]
            node = tampered or leaf
            if height:
                node = digest(left + node + right)
            if (run, node) not in known:
                known[run, node] = folded(node, upper[run])
            values = (doc_id, leaf, log["subroot"], log["top"], digest(left + right + rest[run]), known[run, node])
            for column, value in zip(out, values, strict=True):
                column.append(value)
    return pa.table([pa.array(c, pa.int64() if k == 0 else pa.string()) for k, c in enumerate(out)], names)


def hashed(docs: DataFrame, *columns: Column) -> Column:
    """The leaf of a row: every value with its length before it."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def manifest(docs: DataFrame, tampered: Column, text: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of `docs` (FIELDS). Rows that `tampered` marks are checked with
    `text` as their text: their leaf is folded with the siblings of the manifest."""
    values = [F.col(c) for c in FIELDS]
    leaves = docs.select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), hashed(docs, *values).alias("hash"), F.when(tampered, hashed(docs, *values[:-1], text)).alias("tampered"))
    leaves = ranked(leaves, "doc_id", "hash")
    logs = build(leaves)
    subroots = staged(roots(logs), "subroots")
    sources = ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("root").alias("hash")), "source")
    sources = staged(sources, "sources")
    tops = build(sources)
    whole = roots(tops).select("tree", F.array().cast(PATH).alias("above"), F.col("root").alias("top"))
    paths = with_paths(tops, whole).mapInArrow(_paths_down, f"tree string, nth long, above {PATH}, top string")
    above = paths.drop("tree").join(sources.select("nth", "source"), "nth").select(F.col("source").alias("tree"), "above", "top")
    lowest = with_paths(logs, staged(above, "source-paths")).join(subroots.withColumnRenamed("root", "subroot"), "tree").drop("root")
    rows = leaves.select("tree", F.floor(F.col("nth") / BLOCK).alias("block"), "doc_id", "nth", "tampered")
    proven = rows.groupBy("tree", "block").cogroup(lowest.groupBy("tree", "block")).applyInArrow(_proven, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(documents(spark, sf_dir), chosen, F.translate("text", UPPER, LOWER))


SQL_LEVELS = 5  # of the SQL, enough for a million leaves of a source and as many sources


def _oracle() -> str:
    """All trees level by level, with the proof and the folded node of every row carried up."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join([*map(field, FIELDS[:-1]), field(text)]) + ")"
    ctes = [
        "bits AS (SELECT doc_id, doc_id::VARCHAR AS s, 0 AS k, 4294967295::UBIGINT AS crc FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) AS i"
        " UNION ALL SELECT doc_id, s, k + 1, CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END"
        " FROM (SELECT doc_id, s, k, CASE WHEN k % 8 = 0 THEN xor(crc, ascii(substr(s, k // 8 + 1, 1))::UBIGINT) ELSE crc END AS x FROM bits WHERE k < 8 * length(s)) AS b)",
        "marked AS (SELECT doc_id FROM bits WHERE k = 8 * length(s) AND xor(crc, 4294967295::UBIGINT) % 5 = 0)",
        f"d AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf('text')} AS leaf, CASE WHEN doc_id IN (SELECT doc_id FROM marked) THEN {leaf('low')} ELSE {leaf('text')} END AS node"
        f" FROM (SELECT *, translate(text, '{UPPER}', '{LOWER}') AS low FROM documents) AS t)",
        "s AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nth FROM d)",
    ]

    def tree(p: str, leaves: str) -> None:
        ctes.append(f"{p}0 AS ({leaves})")
        for k in range(SQL_LEVELS):
            ctes.append(f"{p}runs{k} AS (SELECT tree, nth // {ARITY} AS run, list(hash ORDER BY nth) AS hashes, sum(count(*)) OVER (PARTITION BY tree) AS n FROM {p}{k} GROUP BY tree, nth // {ARITY})")
            ctes.append(f"{p}{k + 1} AS (SELECT tree, run AS nth, CASE WHEN n = 1 THEN hashes[1] ELSE sha256(array_to_string(hashes, '')) END AS hash FROM {p}runs{k})")

    def fold(p: str, now: str) -> str:
        for k in range(SQL_LEVELS):
            met = f"(SELECT x.*, n, array_to_string(hashes[1:place % {ARITY}], '') AS before, array_to_string(hashes[place % {ARITY} + 2:], '') AS after FROM {now} AS x JOIN {p}runs{k} AS r ON r.tree = x.under AND r.run = x.place // {ARITY}) AS m"
            ctes.append(f"{p}fold{k} AS (SELECT doc_id, m.tree, leaf, under, place // {ARITY} AS place, CASE WHEN n = 1 THEN proof ELSE proof || before || after END AS proof, CASE WHEN n = 1 THEN node ELSE sha256(before || node || after) END AS node FROM {met})")
            now = f"{p}fold{k}"
        return now

    tree("a", "SELECT tree, nth, leaf AS hash FROM s")
    ctes.append(f"sources AS (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS nth, hash FROM a{SQL_LEVELS})")
    tree("b", "SELECT '' AS tree, nth, hash FROM sources")
    ctes.append("asked AS (SELECT doc_id, tree, leaf, tree AS under, nth AS place, '' AS proof, node FROM s)")
    ctes.append(f"lifted AS (SELECT doc_id, l.tree, leaf, '' AS under, o.nth AS place, proof, node FROM {fold('a', 'asked')} AS l JOIN sources AS o ON o.tree = l.tree)")
    last, top = fold("b", "lifted"), f"b{SQL_LEVELS}"
    return (
        f"WITH RECURSIVE {', '.join(ctes)} SELECT doc_id, leaf, o.hash AS subroot, {top}.hash AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = {top}.hash AS verified"
        f" FROM {last} AS h JOIN sources AS o ON o.tree = h.tree CROSS JOIN {top}"
    )


ORACLE = _oracle()
