"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted trees on a bounded labelled sample give paths; each path is a rule, a conjunction of
bounds on statistics. A lasso logistic regression weighs the rules and leaves most of them out; the
rest is compiled into one column expression over the statistics of every document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .arrays import chunked, text_bytes, with_fields
from .boosting import Tree, boost, lasso_logistic
from .tables import crc_fold
from .text_stats import NAMES, statistics

#: Labelled documents that the rules are learned from at most: those of the least hashes.
SAMPLE = 20_000
TREES = 60
DEPTH = 3
PENALTY = 2e-4

Rule = tuple[tuple[str, bool, float], ...]  # (statistic, at most rather than above, bound)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """Texts and labels of at most `sample` documents outside the held-out fold.

    Rows without an id or a label of 0 or 1 are left out; of repeated labels the least counts. The
    sample is broadcast: its size is bound by the parameter.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where("doc_id is not null and y in (0, 1)").where(crc_fold("doc_id", 5) != 0)
        .groupBy("doc_id").agg(F.min("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    return docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")


def statistic_rows(batches):
    """The rows, as one struct, and the statistics of their texts."""
    for batch in chunked(with_fields(batches, text="text"), "text"):
        values = statistics(*text_bytes(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c) for c in values.T)], names=["row", *NAMES])


def with_statistics(docs: DataFrame) -> DataFrame:
    """One row per input row: row, all of it, and the statistics of its text."""
    chosen = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    names = [T.StructField(name, T.DoubleType()) for name in NAMES]
    return chosen.mapInArrow(statistic_rows, T.StructType([chosen.schema["row"], *names]))


def paths(tree: Tree) -> list[Rule]:
    """Every node below the root as the conjunction of the bounds on its path, each bound of a
    statistic only once, at its tightest."""
    found, open_ = [], [(0, {})]
    while open_:
        node, bounds = open_.pop()
        if bounds:
            found.append(tuple(sorted((NAMES[j], low, t) for (j, low), t in bounds.items())))
        j = int(tree.feature[node])
        if j >= 0:
            t = float(tree.threshold[node])
            below, above = dict(bounds), dict(bounds)
            below[j, True] = min(t, bounds.get((j, True), t))
            above[j, False] = max(t, bounds.get((j, False), t))
            open_ += [(int(tree.left[node]), below), (int(tree.right[node]), above)]
    return found


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, low, bound in rule:
        column = x[:, NAMES.index(name)]
        out &= column <= bound if low else column > bound
    return out


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH,
              penalty: float = PENALTY) -> tuple[float, list[tuple[Rule, float]]]:
    """The intercept and the rules with weights other than 0.

    Labels of one kind only, or none, give the intercept alone.
    """
    mean = (y.sum() + 0.5) / (len(y) + 1)
    if len(np.unique(y)) < 2:
        return float(np.log(mean / (1 - mean))), []
    rules = sorted({rule for tree in boost(x, y, trees, depth)[1] for rule in paths(tree)})
    active = np.stack([holds(rule, x) for rule in rules], 1)
    # Rules that hold for the same rows are one; the shortest stands for them.
    keys: dict[bytes, int] = {}
    for i in sorted(range(len(rules)), key=lambda i: len(rules[i])):
        keys.setdefault(np.packbits(active[:, i]).tobytes(), i)
    picked = sorted(keys.values())
    bias, weights = lasso_logistic(active[:, picked].astype(np.float64), y.astype(np.float64), penalty)
    return bias, [(rules[i], float(w)) for i, w in zip(picked, weights) if abs(w) > 1e-9]


def compiled(bias: float, rules: list[tuple[Rule, float]]) -> Column:
    """The probability as one column expression over the statistics."""
    margin = F.lit(bias)
    for rule, weight in rules:
        condition = None
        for name, low, bound in rule:
            part = F.col(name) <= bound if low else F.col(name) > bound
            condition = part if condition is None else condition & part
        margin = margin + F.when(condition, weight).otherwise(0.0)
    return 1 / (1 + F.exp(-margin))


def learn_quality(docs: DataFrame, labels: DataFrame, label: str = "quality",
                  sample: int = SAMPLE) -> tuple[float, list[tuple[Rule, float]]]:
    rows = with_statistics(labelled_sample(docs, labels, label, sample))
    held = rows.select("row.doc_id", "row.y", *NAMES).orderBy("doc_id").toArrow()
    x = np.stack([held[name].to_numpy() for name in NAMES], 1)
    return fit_rules(x, held["y"].to_numpy().astype(np.int64))


def score_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3,
    sample: int = SAMPLE, carry: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted; with `carry` also row, all of it.

    `held_out` documents (crc32 of the id as text a multiple of 5) teach nothing. The score is
    the probability of label 1 from the statistics of the whole text; null counts as empty, and an
    empty text is scored like any other. Repeated rows are scored each; a null id is not held out.
    Without labels of both kinds every score is the share of label 1. An empty table gives no rows.
    """
    bias, rules = learn_quality(docs.select("doc_id", "text"), labels, label, sample)
    scored = with_statistics(docs if carry else docs.select("doc_id", "text"))
    scored = scored.withColumn("score", compiled(bias, rules)).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "score", "row")
    return scored.select(
        "doc_id", F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), *(["row"] if carry else []))
