"""Toxicity from a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, strips accents, maps look-alike letters (Cyrillic, Greek,
full width) and digit substitutions to one letter each and turns everything else
into spaces.  The lexicon holds whole words and word beginnings with log-odds
weights learned on a bounded sample of labelled rows; hits inside an exception
phrase do not count.  The hits' weight is normalised by length and a logistic
curve, fitted on labelled rows that the lexicon has not seen, makes it a score.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, documents_of, labelled_sample

#: Look-alike letters and the Latin letter each stands for.
HOMOGLYPHS = {"а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
              "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ɡ": "g", "һ": "h", "ո": "n", "ԛ": "q",
              "ѡ": "w", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
              "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe"}
#: Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
#: ``1`` stands for i and for l, so both fold to one letter.
SAME = {"l": "i"}
#: Harmless uses of listed words.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "pond scum", "sore loser", "stupid simple")
INVISIBLE = "​‌‍⁠﻿­"


class Folding(dict):
    """Translation table for ``str.translate``, filled as characters turn up."""

    def __missing__(self, code: int) -> str:
        out = ""
        for c in unicodedata.normalize("NFKD", chr(code).lower()):
            c = HOMOGLYPHS.get(c, SUBSTITUTES.get(c, c))
            if unicodedata.combining(c[0]) or c in INVISIBLE:
                continue
            out += "".join(SAME.get(x, x) for x in c) if c.isalpha() else " "
        self[code] = out
        return out


def fold(text: str, table: Folding) -> str:
    """Folded words, one space before, between and after each."""
    return f" {' '.join(text.translate(table).split())} "


def word_terms(word: str, shortest: int = 3, longest: int = 8) -> list[str]:
    """A folded word's beginnings (of ``shortest`` to ``longest`` letters) and the whole word with its end."""
    return [f" {word[:k]}" for k in range(shortest, min(longest, len(word)) + 1)] + [f" {word} "]


def text_terms(folded: str) -> set[str]:
    out: set[str] = set()
    for w in set(folded.split()):
        if 3 <= len(w) <= 40:
            out.update(word_terms(w))
    return out


def passage_mark(folded: str) -> int:
    """Smallest hash of the text's three-word runs: near copies mostly share it."""
    w = folded.split()
    return min((zlib.crc32(" ".join(w[i:i + 3]).encode()) for i in range(max(1, len(w) - 2))), default=0)


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self):
        import ahocorasick
        a, table = ahocorasick.Automaton(), Folding()
        for term, w in self.weights.items():
            a.add_word(term, (len(term), w))
        for phrase in self.exceptions:
            a.add_word(key := fold(phrase, table)[:-1], (len(key), None))
        if len(a):
            a.make_automaton()
        return a


def features(folded: str, automaton) -> tuple[float, float, float]:
    """Hits' weight, by length and in all, and different terms hit; all on a log scale."""
    spans, hits = [], []
    if len(automaton):
        for end, (size, weight) in automaton.iter(folded):
            (spans if weight is None else hits).append((end - size + 1, end, weight))
    if spans:
        hits = [h for h in hits if not any(a <= h[0] and h[1] <= b + 1 for a, b, _ in spans)]
    total = sum(h[2] for h in hits)
    words = folded.count(" ") - 1
    different = len({folded[a:b + 1] for a, b, _ in hits})
    return float(np.log1p(100.0 * total / (words + 20.0))), float(np.log1p(total)), float(np.log1p(different))


@dataclass
class Model:
    lexicon: Lexicon = field(default_factory=Lexicon)
    weights: tuple[float, ...] = (-2.0, 0.0, 0.0, 0.0)

    def scorer(self):
        automaton, table, w = self.lexicon.automaton(), Folding(), self.weights

        def one(text: str) -> float:
            x = features(fold(text, table), automaton)
            return float(1.0 / (1.0 + np.exp(-np.clip(w[0] + sum(a * b for a, b in zip(w[1:], x, strict=True)),
                                                      -30, 30))))
        return one


def ridge_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> tuple[float, ...]:
    """Weights (intercept first) by Newton steps; features never count against toxicity."""
    keep = list(range(x.shape[1]))
    while True:
        z = np.column_stack([np.ones(len(x)), x[:, keep]])
        w = np.zeros(z.shape[1])
        reg = np.diag([1e-3] + [penalty] * len(keep))
        for _ in range(40):
            p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -30, 30)))
            w = w - np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + reg, z.T @ (p - y) + reg @ w)
        if not keep or w[1:].min() >= 0:
            break
        keep.pop(int(np.argmin(w[1:])))
    out = [float(w[0])] + [0.0] * x.shape[1]
    for k, v in zip(keep, w[1:], strict=True):
        out[k + 1] = float(v)
    return tuple(out)


def learn_lexicon(sample: DataFrame, most_terms: int = 2000, least_gain: float = 20.0,
                  least_weight: float = 1.0) -> dict[str, float]:
    """Terms that toxic rows of the sample hold far more often than the others, with log-odds weights.

    A term counts once per text, and near copies count once.  Of terms of which
    one begins another only the most telling stays.  At most ``most_terms`` terms
    reach the driver.
    """
    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Folding()
        for b in batches:
            count: Counter = Counter()
            for text, label in zip(b["text"], b["label"], strict=True):
                count.update((t, int(label)) for t in text_terms(fold(text, table)))
            if count:
                yield pd.DataFrame([(t, n if y else 0, 0 if y else n) for (t, y), n in count.items()],
                                   columns=["term", "pos", "neg"])

    @F.pandas_udf("long")
    def mark(texts: pd.Series) -> pd.Series:
        table = Folding()
        return texts.map(lambda t: passage_mark(fold(t, table)))

    once = sample.withColumn("mark", mark("text")).dropDuplicates(["label", "mark"]).drop("mark")
    once = cut_lineage(once)
    size = {r["label"]: r["n"] for r in once.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    if not pos or not neg:
        return {}
    seen = (once.where("label = 1").mapInPandas(terms, "term string, pos long, neg long")
            .groupBy("term").agg(F.sum("pos").alias("pos")).where(F.col("pos") >= 3))
    other = (once.where("label = 0").mapInPandas(terms, "term string, pos long, neg long")
             .groupBy("term").agg(F.sum("neg").alias("neg")))
    a, b = F.col("pos"), F.coalesce(F.col("neg"), F.lit(0))
    expected = (a + b) * F.lit(pos / (pos + neg))
    gain = 2 * (a * F.log(a / expected) + F.when(b > 0, b * F.log(b / (a + b - expected))).otherwise(F.lit(0.0)))
    weight = F.log((a + 0.5) / (pos + 1)) - F.log((b + 0.5) / (neg + 1))
    best = (seen.join(other, "term", "left").select("term", gain.alias("gain"), weight.alias("weight"))
            .where((F.col("gain") >= least_gain) & (F.col("weight") >= least_weight))
            .orderBy(F.col("gain").desc(), F.length("term").desc(), "term").limit(most_terms * 10).collect())
    chosen: dict[str, float] = {}
    for r in best:
        t = r["term"]
        if len(chosen) < most_terms and not any(t.startswith(c) or c.startswith(t.rstrip()) for c in chosen):
            chosen[t] = r["weight"]
    return chosen


def learn_exceptions(sample: DataFrame, weights: dict[str, float], least: int = 5, most: int = 500) -> tuple[str, ...]:
    """Two-word phrases around a listed word that ``least`` clean rows hold and no toxic row does."""
    def phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, lexicon = Folding(), tuple(sorted(weights))
        for b in batches:
            out = []
            for text, label in zip(b["text"], b["label"], strict=True):
                w = fold(text, table).split()
                listed = [f" {x} ".startswith(lexicon) for x in w]
                found = {f"{x} {y}" for x, y, p, q in zip(w, w[1:], listed, listed[1:], strict=False) if p or q}
                out += [(f, int(label)) for f in found]
            yield pd.DataFrame(out, columns=["phrase", "label"])

    if not weights:
        return ()
    n = F.count("*")
    rows = (sample.mapInPandas(phrases, "phrase string, label long").groupBy("phrase")
            .agg(n.alias("n"), F.max("label").alias("toxic")).where((F.col("n") >= least) & (F.col("toxic") == 0))
            .orderBy(F.col("n").desc(), "phrase").limit(most).collect())
    return tuple(r["phrase"] for r in rows)


def fit(sample: DataFrame) -> Model:
    """A model from a bounded sample of ``doc_id, text, label``.

    The curve is fitted on measurements by lexicons that have not seen the row:
    each hash half is measured with the other half's lexicon.  The final lexicon
    is learned on the whole sample.  Without toxic or without clean rows every
    score is the smoothed share of toxic rows.
    """
    sample = cut_lineage(sample.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2))))

    def lexicon_of(rows: DataFrame) -> Lexicon:
        weights = learn_lexicon(rows)
        return Lexicon(weights, EXCEPTIONS + learn_exceptions(rows, weights))

    halves = {h: lexicon_of(sample.where(F.col("half") != h)) for h in (0, 1)}

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automata, table = {h: x.automaton() for h, x in halves.items()}, Folding()
        for b in batches:
            rows = [(*features(fold(t, table), automata[int(h)]), float(y))
                    for t, h, y in zip(b["text"], b["half"], b["label"], strict=True)]
            yield pd.DataFrame(rows, columns=["a", "b", "c", "label"])

    table = np.array([tuple(r) for r in sample.mapInPandas(measured, "a double, b double, c double, label double")
                      .collect()]).reshape(-1, 4)
    table = table[np.lexsort(table.T)]
    y, lexicon = table[:, 3], lexicon_of(sample)
    if not lexicon.weights or y.sum() in (0, len(y)):
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(lexicon, (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))
    return Model(lexicon, ridge_logistic(table[:, :3], y))


def fit_labels(docs: DataFrame, labels: DataFrame, keep: Column, rows: int = 20_000) -> Model:
    """Fit on at most ``rows`` labelled documents that ``keep`` (over ``doc_id``) admits."""
    return fit(labelled_sample(docs, labels, "toxic", keep, rows))


def score_column(model: Model):
    """The score of a text column; some thousand terms at most travel with the task."""
    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = model.scorer()
        for texts in parts:
            yield pd.Series([one(t) for t in texts], dtype=float)

    return run


def score(docs: DataFrame, model: Model, *extra: str) -> DataFrame:
    """``doc_id, score`` (and ``extra`` columns) of every whole text; null reads as empty.

    A text without listed words, an empty one included, gets the curve's lowest
    score.  Repeated rows score alike, each in its own row.
    """
    return documents_of(docs, *extra).select("doc_id", *extra, score_column(model)("text").alias("score"))


def kept(docs: DataFrame, model: Model, most: float = 0.7) -> DataFrame:
    """The rows of ``docs`` with a score under ``most``, all columns as they were."""
    return docs.where(score_column(model)(F.coalesce(F.col("text").cast("string"), F.lit(""))) < most)
