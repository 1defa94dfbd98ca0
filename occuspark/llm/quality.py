"""Quality classifier: a sparse ensemble of rules over text statistics, compiled to Spark columns.

1. Statistics of the whole text as column expressions (JVM only).
2. A shallow random forest on a bounded sample of labelled rows.
3. Every path of its trees is a conjunction of threshold tests: a rule.
4. Lasso logistic regression gives the rules weights; most become zero.
5. The rules left are compiled into one column expression that scores any text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, documents_of, labelled_sample

#: Inside brackets of a regular expression.
SYMBOLS = r"$%&#*<>{}\[\]\\^~=+@_"
SENTENCE_ENDS = ".?!"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body or a pushed-down filter names it."""
    return F.transform(F.array(value), body)[0]


def statistics(text: Column) -> Column:
    """A struct of one double per statistic of a text; all are 0 for a text without words."""
    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    def count_of(chars: str) -> Column:
        return F.regexp_count(text, F.lit(f"[{chars}]"))

    parts = F.struct(
        F.char_length(text).cast("double").alias("n"),
        F.array_remove(F.split(text, r"\s+"), "").alias("words"),
        F.array_remove(F.split(text, "\n"), "").alias("lines"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("upper"),
        F.regexp_count(text, F.lit(r"(?<!\S)(\S++)(?=\s\1(?!\S))")).alias("repeats"),
        count_of(SYMBOLS).alias("symbols"), count_of("|").alias("pipes"), count_of("!").alias("exclamations"),
        count_of(SENTENCE_ENDS).alias("ends"), count_of(",;:").alias("commas"),
        count_of("0123456789").alias("digits"))

    def measures(p: Column) -> Column:
        n, words, lines = p["n"], F.size(p["words"]).cast("double"), F.size(p["lines"]).cast("double")
        values = {
            "log_words": F.log1p(words),
            "word_length": ratio(n - words, words),
            "distinct_words": ratio(F.size(F.array_distinct(p["words"])), words),
            "repeated_next": ratio(p["repeats"], words),
            "repeated_lines": ratio(lines - F.size(F.array_distinct(p["lines"])), lines),
            "words_per_line": F.log1p(ratio(words, lines)),
            "symbols": ratio(p["symbols"], n),
            "pipes": ratio(p["pipes"], words),
            "exclamations": ratio(p["exclamations"], words),
            "sentence_ends": ratio(p["ends"], words),
            "commas": ratio(p["commas"], words),
            "digits": ratio(p["digits"], n),
            "upper": ratio(p["upper"], words),
        }
        return F.struct(*[values[f].cast("double").alias(f) for f in FEATURES])

    return bound(parts, measures)


FEATURES = ["log_words", "word_length", "distinct_words", "repeated_next", "repeated_lines", "words_per_line",
            "symbols", "pipes", "exclamations", "sentence_ends", "commas", "digits", "upper"]
#: ``((feature, at most?, threshold), ...)``: a conjunction of tests.
Rule = tuple[tuple[str, bool, float], ...]


@dataclass
class RuleModel:
    intercept: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def column(self, text: Column) -> Column:
        """The score of a text, 0 to 1, as a column expression."""
        def scored(st: Column) -> Column:
            margin = F.lit(float(self.intercept))
            for rule, weight in self.rules:
                tests = [st[name] <= F.lit(at) if at_most else st[name] > F.lit(at) for name, at_most, at in rule]
                margin = margin + F.when(reduce(and_, tests), F.lit(float(weight))).otherwise(F.lit(0.0))
            return 1.0 / (1.0 + F.exp(-margin))

        return bound(statistics(text), scored)

    def score(self, x: np.ndarray) -> np.ndarray:
        """The same on rows of features in the order of ``FEATURES``."""
        margin = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            margin += weight * holds(rule, x)
        return 1.0 / (1.0 + np.exp(-margin))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    ok = np.ones(len(x), dtype=bool)
    for name, at_most, at in rule:
        v = x[:, FEATURES.index(name)]
        ok &= v <= at if at_most else v > at
    return ok


def tree_paths(model) -> list[Rule]:
    """Every path from a root to a node below it, each feature's tests merged to the tightest."""
    found: dict[Rule, None] = {}

    def walk(node, path: dict) -> None:
        if path:
            found[tuple(sorted((f, le, t) for (f, le), t in path.items()))] = None
        if node.getClass().getSimpleName() != "InternalNode":
            return
        split = node.split()
        name, at = FEATURES[split.featureIndex()], float(split.threshold())
        for child, le in ((node.leftChild(), True), (node.rightChild(), False)):
            old = path.get((name, le), at)
            walk(child, {**path, (name, le): min(old, at) if le else max(old, at)})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 600) -> tuple[float, np.ndarray]:
    """Intercept and L1-penalised weights by accelerated proximal gradient."""
    n, m = z.shape
    z1 = np.column_stack([np.ones(n), z])
    step = 1.0 / (0.25 * np.linalg.norm(z1, 2) ** 2 / n + 1e-9)
    w = v = np.zeros(m + 1)
    t = 1.0
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(z1 @ v, -30, 30)))
        nxt = v - step * (z1.T @ (p - y)) / n
        nxt[1:] = np.sign(nxt[1:]) * np.maximum(0.0, np.abs(nxt[1:]) - step * penalty)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = nxt + (t - 1) / t2 * (nxt - w)
        w, t = nxt, t2
    return float(w[0]), w[1:]


def fit(sample: DataFrame, trees: int = 24, depth: int = 3, penalty: float = 5e-4, seed: int = 7) -> RuleModel:
    """A rule model from rows of ``text`` and ``label`` (0 or 1): a bounded sample.

    Without rows the score is 0.5 everywhere; with one class only it is that
    class's smoothed share.
    """
    rows = cut_lineage(sample.select("label", statistics(F.col("text")).alias("st")).select("label", "st.*").coalesce(8))
    table = np.array([[float(v) for v in r] for r in rows.collect()])
    if not len(table):
        return RuleModel()
    table = table[np.lexsort(table.T)]
    y, x = table[:, 0], table[:, 1:]
    if y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(share / (1 - share))))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, seed=seed, labelCol="label",
                                    featureSubsetStrategy="onethird", subsamplingRate=0.7).fit(vectors)
    rules = tree_paths(forest)
    if not rules:
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(share / (1 - share))))
    z = np.column_stack([holds(r, x) for r in rules]).astype(float)
    intercept, weight = lasso_logistic(z, y, penalty)
    return RuleModel(intercept, [(r, w) for r, w in zip(rules, weight.tolist(), strict=True) if abs(w) > 1e-4])


def fit_labels(docs: DataFrame, labels: DataFrame, keep: Column, rows: int = 20_000) -> RuleModel:
    """Fit on at most ``rows`` labelled documents that ``keep`` (over ``doc_id``) admits."""
    return fit(labelled_sample(docs, labels, "quality", keep, rows))


def score(docs: DataFrame, model: RuleModel, *extra: str) -> DataFrame:
    """``doc_id, score`` (and ``extra`` columns) of every whole text; null reads as empty."""
    return documents_of(docs, *extra).select("doc_id", *extra, model.column(F.col("text")).alias("score"))


def kept(docs: DataFrame, model: RuleModel, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score of ``least`` or more, all columns as they were."""
    return docs.where(model.column(F.coalesce(F.col("text").cast("string"), F.lit(""))) >= least)
