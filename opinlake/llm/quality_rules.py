"""Quality by a sparse ensemble of rules, scored as Spark column expressions.

Small boosted trees over text statistics are fitted on labelled rows; every path from a root to
a node below it is a rule, a conjunction of comparisons. Lasso logistic regression over all rules
keeps a few with their weights, and those are compiled into one column expression over the columns
of statistics. Fitting uses at most `MAX_LABELLED` rows outside fold 1; the statistics come from one
pass over every whole text in the tasks that read it.

Inputs: NULL and empty texts have a score like any other. Without labels of both kinds the score
is the share of good ones among them, 1 if there are none. Rows without a doc_id are scored and not
held out. Rows come back one for one; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake.llm.batches import as_bytes, map_slices
from opinlake.llm.labelled import MAX_LABELLED, fold, labelled_texts
from opinlake.llm.text_stats import STATS, measure
from opinlake.llm.trees import Tree, boost, lasso_logistic

THRESHOLD = 0.5
PENALTY = 0.001

# (column number, whether at most, threshold)
Condition = tuple[int, bool, float]


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        good = np.ones(len(x), bool)
        for column, at_most, cut in self.conditions:
            good &= (x[:, column] <= cut) == at_most
        return good

    def column(self) -> Column:
        test = F.lit(True)
        for column, at_most, cut in self.conditions:
            value = F.col(STATS[column])
            test = test & (value <= F.lit(cut) if at_most else value > F.lit(cut))
        return test

    def __str__(self) -> str:
        return " AND ".join(f"{STATS[c]} {'<=' if low else '>'} {cut:.6g}" for c, low, cut in self.conditions)


def paths(tree: Tree) -> list[Rule]:
    """A rule for every node but the root; of several bounds of a column the tightest."""
    found = []

    def walk(node: int, bounds: dict[tuple[int, bool], float]) -> None:
        if bounds:
            found.append(Rule(tuple(sorted((c, low, cut) for (c, low), cut in bounds.items()))))
        if tree.feature[node] < 0:
            return
        column, cut = tree.feature[node], tree.threshold[node]
        low, high = bounds.get((column, True), np.inf), bounds.get((column, False), -np.inf)
        walk(tree.left[node], bounds | {(column, True): min(low, cut)})
        walk(tree.right[node], bounds | {(column, False): max(high, cut)})

    walk(0, {})
    return found


@dataclass
class RuleModel:
    bias: float
    rules: list[Rule]
    weights: list[float]

    def score(self) -> Column:
        """The probability of label 1, over the columns `STATS`."""
        total = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def scores(self, x: np.ndarray) -> np.ndarray:
        held = [w * rule.holds(x) for rule, w in zip(self.rules, self.weights, strict=True)]
        return 1 / (1 + np.exp(-(self.bias + np.sum(held, axis=0) if held else np.full(len(x), self.bias))))


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and `STATS` of every text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = measure(batch.column("text").to_pylist())
        columns = [pa.array(np.ascontiguousarray(c)) for c in stats.T]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep), *columns], [*keep, *STATS]
        )

    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([f"{c} {types[c]}" for c in keep] + [f"{c} double" for c in STATS])
    return map_slices(as_bytes(docs, *keep), work, schema)


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, penalty: float = PENALTY) -> RuleModel:
    sample = labelled_texts(docs, labels, "quality", limit)
    # At most `limit` rows of some numbers each come to the driver.
    rows = statistics(sample.withColumn("text", F.col("text").cast("string")), "doc_id", "label")
    rows = rows.orderBy("doc_id").collect()
    x = np.array([[r[c] for c in STATS] for r in rows]).reshape(len(rows), len(STATS))
    y = np.array([r["label"] for r in rows], float)
    if len({*y}) < 2:
        share = np.clip(y.mean() if len(y) else 1.0, 1e-6, 1 - 1e-6)
        return RuleModel(float(np.log(share / (1 - share))), [], [])
    trees = boost(x, y, rounds=30, depth=3, rate=0.3, smallest=2.0).trees
    rules = list(dict.fromkeys(rule for tree in trees for rule in paths(tree)))
    held = np.column_stack([rule.holds(x) for rule in rules]).astype(float)
    # Rules that hold on the same rows are one rule.
    _, first = np.unique(held, axis=1, return_index=True)
    first = np.sort(first)
    bias, weights = lasso_logistic(held[:, first], y, penalty)
    kept = [(rules[k], float(w)) for k, w in zip(first, weights, strict=True) if w]
    return RuleModel(bias, [r for r, _ in kept], [w for _, w in kept])


def score_documents(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted (1: good), one row for each row of `docs`."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = statistics(keyed, "doc_id").select("doc_id", model.score().alias("score"))
    held = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))
    return scored.select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
