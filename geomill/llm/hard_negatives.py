"""Operator 11: hard negatives by threshold joins over an inverted index that leaves out what norms bound (after L2AP).

`threshold_join` finds all pairs of a query and a row whose inner product reaches the query's threshold. Rows and queries are dealt into
blocks, and a task holds one block of each. There the rows are indexed by dimension (`Index`): of every row only the leading
dimensions are listed, until the norm of the rest is under the least threshold of a query of unit norm, so a row that is in no list
cannot reach any threshold. Queries add up partial scores list by list; after every CHUNK dimensions pairs are pruned that
cannot reach the threshold with the norms of what remains, and the survivors' scores are completed exactly.

`hard_negatives` lowers thresholds in rounds. First each anchor looks for its best rows of the same label, at falling shares of
the largest norm, until it has enough. Then every (anchor, positive) is a window of scores, and anchors look for rows of other
labels at falling shares of the positive's score, until the windows are full or reach their lower end. A task sends the best few of each
anchor or window only, so what leaves the tasks never grows with the pairs; only anchors that lack something go into the next round.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; rows of one id count as
one, that of the smallest label and then vector; shorter vectors end in zeros; an empty vector has score 0 with all; a positive of
negative score has an empty window; equal scores go by id; an empty table gives an empty result; other columns are ignored.
Scores are exact while they are under 2**53. Labels may hold any part of all rows: they are dealt into blocks too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from geomill.llm.common import LEAST_FILES, drop_staged, staged

ROW_BLOCK, QUERY_BLOCK = 16_384, 4_096  # rows and queries of a task
QUERIES, CHUNK, FEW = 128, 16, 0.1  # queries scored at once, dimensions between two prunings, share of pairs that is few
POSITIVE_SHARES = (0.6, 0.35, 0.2, None)  # of the largest norm; None: no threshold
NEGATIVE_SHARES = (0.8, 0.65)  # of the positive's score, before the window's lower end


class Index:
    """Lists by dimension of a block of rows, for queries whose threshold is at least `least` times their norm.

    Dimensions go by falling sum of squares. Rows are ordered by how many dimensions they list, so that the list of a
    dimension is a run of the first rows and lists of neighbouring dimensions lie side by side."""

    def __init__(self, rows: np.ndarray, least: float) -> None:
        n, m = rows.shape
        self.dims = np.argsort(-(rows * rows).sum(axis=0), kind="stable")
        rows = rows[:, self.dims]
        rest = np.sqrt(np.append(np.cumsum((rows * rows)[:, ::-1], axis=1)[:, ::-1], np.zeros((n, 1)), axis=1))
        listed = np.minimum((rest >= least).sum(axis=1), m)  # falling, so these are the leading ones
        self.order = np.argsort(-listed, kind="stable")
        self.rows, self.rest, self.listed = rows[self.order], rest[self.order], listed[self.order]
        self.lists = np.where(np.arange(m) < self.listed[:, None], self.rows, 0.0)
        self.lengths = (self.listed[:, None] > np.arange(m)).sum(axis=0)

    def search(self, queries: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of all pairs whose score reaches the query's threshold."""
        queries, m = queries[:, self.dims], len(self.dims)
        rest = np.sqrt(np.append(np.cumsum((queries * queries)[:, ::-1], axis=1)[:, ::-1], np.zeros((len(queries), 1)), axis=1))
        partial, alive = np.zeros((len(queries), len(self.rows))), np.ones((len(queries), len(self.rows)), bool)
        for d in range(0, m, CHUNK):
            n = self.lengths[d]
            if n:
                partial[:, :n] += queries[:, d : d + CHUNK] @ self.lists[:n, d : d + CHUNK].T
            seen = np.minimum(self.listed, d + CHUNK)  # what is not yet added of a row begins there
            most = partial + rest[:, seen] * self.rest[np.arange(len(seen)), seen] * (1 + 1e-9) + 1e-6
            alive = most >= thresholds[:, None]
            if not n or alive.mean() < FEW:
                break
        q, r = np.nonzero(alive)
        scores = np.empty(len(q))
        for at in range(0, len(q), 1 << 17):
            some = slice(at, at + (1 << 17))
            scores[some] = np.einsum("ij,ij->i", queries[q[some]], self.rows[r[some]])
        reached = scores >= thresholds[q]
        return q[reached], self.order[r[reached]], scores[reached]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    sizes = pc.list_value_length(column).to_numpy().astype(np.int64)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = pc.list_flatten(column).to_numpy()
    return out


def _first(groups: np.ndarray, most: int) -> np.ndarray:
    """Of sorted group numbers, the places of the first `most` of each."""
    starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])) if len(groups) else np.zeros(0, np.int64)
    nth = np.arange(len(groups)) - np.repeat(starts, np.diff(np.append(starts, len(groups))))
    return np.flatnonzero(nth < most)


def threshold_join(rows: pa.Table, queries: pa.Table):
    """Of a block of rows (vec_id, label, v) and one of queries (anchor_id, v, threshold): blocks of (query, row, score) by falling score,
    then by id."""
    sizes = [pc.max(pc.list_value_length(t["v"])).as_py() or 0 for t in (rows, queries) if t.num_rows]
    width = max([1, *sizes])
    x, y, least = _matrix(rows["v"], width), _matrix(queries["v"], width), queries["threshold"].to_numpy()
    ids, norms = rows["vec_id"].to_numpy(), np.sqrt((y * y).sum(axis=1))
    by_norm = np.divide(least, norms, out=np.zeros(len(norms)), where=norms > 0)
    index = Index(x, by_norm.min())
    for at in range(0, len(y), QUERIES):
        q, r, scores = index.search(y[at : at + QUERIES], least[at : at + QUERIES])
        order = np.lexsort((ids[r], -scores, q))
        yield q[order] + at, r[order], scores[order].astype(np.int64)


def _positives(most: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = [[], [], []]
        if rows.num_rows and queries.num_rows:
            ids, anchors = rows["vec_id"].to_numpy(), queries["anchor_id"].to_numpy()
            for q, r, scores in threshold_join(rows, queries):
                other = ids[r] != anchors[q]
                q, r, scores = q[other], r[other], scores[other]
                first = _first(q, most)
                for column, values in zip(out, (anchors[q[first]], ids[r[first]], scores[first]), strict=True):
                    column.append(values)
        return pa.table([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in out], ["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(most: int, low: int, high: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        if rows.num_rows and queries.num_rows:
            ids, labels, own = (rows["vec_id"].to_numpy(), rows["label"].to_numpy(), queries["label"].to_numpy())
            anchors, windows = queries["anchor_id"].to_numpy(), queries["windows"].combine_chunks()
            count, flat = windows.value_lengths().to_numpy(), windows.flatten()
            starts = np.cumsum(count) - count
            positives, tops = flat.field("positive_id").to_numpy(), flat.field("positive_score").to_numpy()
            for q, r, scores in threshold_join(rows, queries):
                other = labels[r] != own[q]
                q, r, scores = q[other], r[other], scores[other]
                for k in range(int(count.max())):
                    have = np.flatnonzero(count[q] > k)
                    top = tops[starts[q[have]] + k]
                    have, top = (c[(low * top <= 100 * scores[have]) & (100 * scores[have] <= high * top)] for c in (have, top))
                    first = _first(q[have], most)
                    have, top = have[first], top[first]
                    for column, values in zip(out, (anchors[q[have]], positives[starts[q[have]] + k], top, ids[r[have]], scores[have]), strict=True):
                        column.append(values)
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        return pa.table([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in out], names)

    return run


def usable(rows: DataFrame, label: Column, vector: Column) -> DataFrame:
    """vec_id, label, v of the rows that take part, one of each id."""
    whole = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), vector.alias("v")).filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    broken = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = whole.filter(~broken).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"))
    return whole.select("vec_id", "row.label", "row.v")


def _salt(column: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(column), parts).cast("int")


def _each(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), (parts - 1).cast("int")))


def _best(found: DataFrame, by: list[str], score: str, row: str, most: int) -> DataFrame:
    """The first rows of each group, with their `rank`. Every task has sent `most` rows of a group at most."""
    order = W.partitionBy(*by).orderBy(F.col(score).desc(), F.col(row))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def same_label(rows: DataFrame, anchors: DataFrame, most: int) -> DataFrame:
    """anchor_id, label, v, windows: every anchor's best rows of its label (positive_id, positive_score), `most` or all."""
    sizes = rows.groupBy("label").agg(F.count("*").alias("n"))
    asked = anchors.groupBy("label").agg(F.count("*").alias("asked"))
    sizes = staged(sizes.join(asked, "label").select("label", "n", F.ceil(F.col("n") / ROW_BLOCK).alias("parts"), F.ceil(F.col("asked") / QUERY_BLOCK).alias("askers")), "label-sizes")
    dealt = staged(rows.join(sizes, "label").withColumn("part", _salt("vec_id", F.col("parts"))).withColumn("asker", _each(F.col("askers"))).select("label", "part", "asker", "vec_id", "v"), "label-blocks")
    norm = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0] or 0.0
    waiting, found = anchors.join(sizes, "label"), []
    for share in POSITIVE_SHARES:
        least = F.lit(float("-inf")) if share is None else F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)) * (share * norm**0.5)
        queries = waiting.withColumn("threshold", least).withColumn("asker", _salt("anchor_id", F.col("askers"))).withColumn("part", _each(F.col("parts")))
        met = dealt.groupBy("label", "part", "asker").cogroup(queries.groupBy("label", "part", "asker")).applyInArrow(_positives(most), "anchor_id long, positive_id long, positive_score long")
        best = _best(met, ["anchor_id"], "positive_score", "positive_id", most).groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("windows"))
        state = staged(waiting.join(best, "anchor_id", "left"), "positives")
        full = (F.coalesce(F.size("windows"), F.lit(0)) >= F.least(F.lit(most), F.col("n") - 1)) | F.lit(share is None)
        found.append(state.filter(full & F.col("windows").isNotNull()).select("anchor_id", "label", "v", "windows"))
        waiting = state.filter(~full).drop("windows")
        if waiting.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = staged(out, "anchors-with-positives")
    drop_staged(dealt)
    return out


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for every row (vec_id, label, v) that `anchors` marks and each of its best
    `positives` rows of the same label, the best `negatives` rows of other labels that score from `low` to `high` per cent of the positive."""
    rows = staged(rows, "vectors")
    asking = rows.filter(anchors).select(F.col("vec_id").alias("anchor_id"), "label", "v")
    n, n_asking = rows.count(), asking.count()
    parts, askers = F.lit(max(LEAST_FILES, -(-n // ROW_BLOCK))), F.lit(max(1, -(-n_asking // QUERY_BLOCK)))
    dealt = staged(rows.withColumn("part", _salt("vec_id", parts)).withColumn("asker", _each(askers)), "row-blocks")
    waiting, found = same_label(rows, asking, positives), []
    waiting = waiting.withColumn("windows", F.filter("windows", lambda w: w["positive_score"] >= 0)).filter("size(windows) > 0")
    for share in (*NEGATIVE_SHARES, low / 100):
        lowest = F.array_min(F.transform("windows", lambda w: w["positive_score"]))
        queries = waiting.withColumn("threshold", F.greatest(F.lit(share), F.lit(low / 100)) * lowest - 1e-6).withColumn("asker", _salt("anchor_id", askers)).withColumn("part", _each(parts))
        met = dealt.groupBy("part", "asker").cogroup(queries.groupBy("part", "asker")).applyInArrow(_negatives(negatives, low, high), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
        best = staged(_best(met, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives), "negatives")
        if share * 100 <= low:
            found.append(best)
            break
        full = best.groupBy("anchor_id", "positive_id").agg(F.count("*").alias("n")).filter(F.col("n") >= negatives).select("anchor_id", "positive_id")
        found.append(best.join(full, ["anchor_id", "positive_id"], "left_semi"))
        each = waiting.select("anchor_id", "label", "v", F.explode("windows").alias("w")).select("anchor_id", "label", "v", "w.positive_id", "w.positive_score")
        left = each.join(full, ["anchor_id", "positive_id"], "left_anti")
        waiting = staged(left.groupBy("anchor_id", "label", "v").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("windows")), "open-windows")
        if waiting.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = usable(rows, label, F.transform("embedding", lambda x: x.cast("double")))
    vectors = vectors.withColumn("v", F.transform("v", lambda x: F.floor(256 * x).cast("double")))
    return hard_negatives(vectors, F.col("vec_id") % 50 == 0)


ORACLE = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other, list_inner_product(a.v, b.v)::BIGINT AS score FROM e a, e b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other)::INT AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) <= 3
"""
