"""Operator 9: a sparse rule ensemble for quality.

Statistics of the text are Spark column expressions. On a bounded sample of labelled rows a random forest of shallow
trees is grown (pyspark.ml), the paths from root to every node become conjunctive rules over the statistics, lasso
logistic regression weighs the rules, and those with a weight are compiled back into one column expression, so
scoring is one pass over the texts without Python and without a shuffle.

The sample is the FIT_ROWS labelled rows with the smallest hash of their id (documented bound, alike at every size).

Defined cases: a null text is empty and scored; a null label or id is not learned from; with fewer than two classes to
learn from every score is the share of label 1 (0 without labels); repeated rows are learned from once (of different texts with one
id and label, the first in order) and get equal scores; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomill.llm.common import documents, remainder, staged, text_of

FIT_ROWS, TREES, DEPTH, LASSO, CUT = 20_000, 24, 3, 0.001, 0.3
FIT_PARTS = 2  # partitions of the sample: it has some 3 MB, and every step of the fit is a job over it
LICENCES = ("licensed under", "all rights reserved")
MARKS = {"period": ".", "comma": ",", "bang": "!", "bar": "|", "hash": "#", "star": "*", "dollar": "$", "percent": "%", "amp": "&"}


def statistics(text: Column, licences: tuple[str, ...] = LICENCES) -> dict[str, Column]:
    """Named statistics of a text (all 0 or more; of an empty text finite). `licences` are phrases in lower case."""
    chars = F.length(text).cast("double")
    words = F.split(F.trim(text), r"\s+")
    n_words = F.size(words).cast("double")
    count = lambda mark: chars - F.length(F.replace(text, F.lit(mark), F.lit("")))
    lines = 1.0 + count("\n")
    found = {f"{name}_rate": count(mark) / n_words for name, mark in MARKS.items()}
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("double")
    return found | {
        "log_chars": F.log1p(chars),
        "word_chars": chars / n_words,
        "distinct_share": F.size(F.array_distinct(words)) / n_words,
        "upper_rate": upper / n_words,
        "line_words": n_words / lines,
        "licensed": F.when(reduce(or_, (F.lower(text).contains(p) for p in licences), F.lit(False)), 1.0).otherwise(0.0),
    }


NAMES = [*(f"{n}_rate" for n in MARKS), "log_chars", "word_chars", "distinct_share", "upper_rate", "line_words", "licensed"]

Rule = tuple[tuple[int, str, float], ...]


def tree_rules(described: str) -> list[Rule]:
    """The paths to all nodes but the root, from a tree's description: (statistic, `<=` or `>`, cut) conditions."""
    path, found = [], []
    for line in described.splitlines():
        if m := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line):
            depth = len(m[1])
            path = [p for p in path if p[0] < depth]
            path.append((depth, (int(m[2]), m[3], float(m[4]))))
            found.append(tuple(sorted({c for _, c in path})))
    return found


def tightened(rule: Rule) -> Rule:
    """Of conditions on one statistic in one direction, the narrowest."""
    best: dict[tuple[int, str], float] = {}
    for k, sign, cut in rule:
        best[k, sign] = cut if (k, sign) not in best else (min if sign == "<=" else max)(best[k, sign], cut)
    return tuple(sorted((k, sign, cut) for (k, sign), cut in best.items()))


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for k, sign, cut in rule:
        out &= (F.col(NAMES[k]) <= cut) if sign == "<=" else (F.col(NAMES[k]) > cut)
    return out


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The statistics and label of the sample."""
    learn = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (remainder("doc_id", 5) != 0))
    learn = learn.select("doc_id", F.col("quality").cast("double").alias("label")).distinct().orderBy(F.xxhash64("doc_id"), "label").limit(FIT_ROWS)
    known = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(learn), "doc_id")  # at most FIT_ROWS rows
    known = known.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # repeated rows count once
    return staged(known.select("label", *(c.alias(n) for n, c in statistics(F.col("text")).items())), "quality-fit")


def fit_rules(sample: DataFrame) -> tuple[float, list[tuple[Rule, float]]]:
    """(intercept, rules with their weights)."""
    classes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        return (float("inf") if classes.get(1.0) else float("-inf")), []
    sample = sample.coalesce(FIT_PARTS)
    vectors = sample.select("label", array_to_vector(F.array(*(F.col(n).cast("double") for n in NAMES))).alias("features")).cache()
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=5, featureSubsetStrategy="onethird").fit(vectors)
    vectors.unpersist()
    rules = sorted({tightened(r) for tree in forest.trees for r in tree_rules(tree.toDebugString)})
    if not rules:
        share = classes.get(1.0, 0) / sum(classes.values())
        return math.log(share / (1 - share)), []
    marks = sample.select("label", array_to_vector(F.array(*(holds(r).cast("double") for r in rules))).alias("features")).cache()
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(marks)
    marks.unpersist()
    weights = lasso.coefficients.toArray().tolist()
    return float(lasso.intercept), [(r, w) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6]


def score_column(intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    """The ensemble's probability of label 1, over columns named as NAMES."""
    if intercept in (float("inf"), float("-inf")):
        return F.lit(1.0 if intercept > 0 else 0.0)
    total = F.lit(intercept)
    for rule, weight in rules:
        total += F.when(holds(rule), weight).otherwise(0.0)
    return 1.0 / (1.0 + F.exp(-total))


def score_quality(docs: DataFrame, intercept: float, rules: list[tuple[Rule, float]]) -> DataFrame:
    """doc_id and score of every row."""
    measured = docs.select("doc_id", text_of().alias("text")).select("doc_id", *(c.alias(n) for n, c in statistics(F.col("text")).items()))
    return measured.select("doc_id", score_column(intercept, rules).alias("score"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_rules(labelled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return score_quality(docs, *model).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
