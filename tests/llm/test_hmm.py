"""Hidden Markov language model against plain recursions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from occuspark.llm import hmm
from occuspark.llm.common import held_out

COLUMNS = "doc_id long, text string, lang string, wid int, chunk string, e0 double"


def random_model(rng, k, words):
    start, moves = rng.dirichlet(np.ones(k + 1)), rng.dirichlet(np.ones(k + 1), k)
    return hmm.Model(start, moves, rng.dirichlet(np.ones(words), k).T)


def plain_forward(model, words):
    """Probability of a text in logs, one state vector at a time."""
    if not len(words):
        return math.log(model.start[model.k])
    v, log = model.start[:model.k] * model.words[words[0]], 0.0
    for w in words[1:]:
        log, v = log + math.log(v.sum()), v / v.sum()
        v = (v @ model.moves[:, :model.k]) * model.words[w]
    return log + math.log(v @ model.moves[:, model.k])


def plain_expected(model, words):
    """Expected counts by all pairs of forward and backward vectors."""
    k, n = model.k, len(words)
    a, b = np.zeros((n, k)), np.zeros((n, k))
    a[0], b[-1] = model.start[:k] * model.words[words[0]], model.moves[:, k]
    for t in range(1, n):
        a[t] = (a[t - 1] @ model.moves[:, :k]) * model.words[words[t]]
    for t in range(n - 2, -1, -1):
        b[t] = model.moves[:, :k] @ (model.words[words[t + 1]] * b[t + 1])
    p = a[-1] @ b[-1]
    gamma = a * b / p
    pairs = sum((np.outer(a[t], model.words[words[t + 1]] * b[t + 1]) * model.moves[:, :k] / p for t in range(n - 1)),
                np.zeros((k, k)))
    by_word = np.zeros_like(model.words)
    np.add.at(by_word, words, gamma)
    return gamma[0], np.column_stack([pairs, gamma[-1]]), by_word


@pytest.mark.parametrize("segment", [1, 3, 2048])
def test_recursions_equal_plain_ones(segment):
    rng = np.random.default_rng(segment)
    model = random_model(rng, 3, 6)
    lens = np.array([5, 1, 12, 2, 7, 1, 30])
    tokens = rng.integers(0, 6, lens.sum())
    each = np.split(tokens, np.cumsum(lens)[:-1])
    texts = hmm.Texts(tokens, lens, segment)
    assert np.allclose(hmm.forward(texts, model), [plain_forward(model, w) for w in each], rtol=1e-12)
    got = hmm.expected(texts, model)
    want = [sum(x) for x in zip(*[plain_expected(model, w) for w in each], strict=True)]
    for g, w in zip(got[:3], want, strict=True):
        assert np.allclose(g, w, atol=2e-5)


def test_probabilities_of_all_texts_sum_to_one():
    model = random_model(np.random.default_rng(2), 2, 2)
    model.moves[:] = [[0.1, 0.2, 0.7], [0.15, 0.05, 0.8]]
    total, level = math.exp(plain_forward(model, [])), [()]
    for _ in range(9):
        level = [(*w, x) for w in level for x in (0, 1)]
        lens = np.full(len(level), len(level[0]))
        total += np.exp(hmm.forward(hmm.Texts(np.concatenate(level).astype(int), lens), model)).sum()
    assert 0.9999 < total <= 1 + 1e-9


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def rows_of(n, seed=1):
    rng = random.Random(seed)
    tongues = [["the", "of", "And", "cat", "ran"], ["der", "und", "die", "katze", "Über"], ["le", "de", "et", "chat", "a b"]]
    rows = []
    for i in range(n):
        words = [rng.choice(tongues[i % 3]) for _ in range(rng.randrange(60))]
        if i % 17 == 0:
            words.append(f"rare{i}")
        rows.append((i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(words), "x", 1, "c", 0.5))
    rows += [(None, "the cat", "x", 1, "c", None), (3, None, None, None, None, None), (4, "", None, None, None, None)]
    rows += [(6, "the der le", "x", 1, "c", 0.1)] * 3
    return rows + [(2**60 + 1, "der die " * 6000, "x", 1, "c", 0.1)]


OPTIONS = dict(states=3, chunk_words=500, shard_entries=10, rounds=2, sample_rows=60, sample_rounds=15, prior=0.01)


def test_query_equals_a_plain_model(spark):
    rows = rows_of(400)
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    model = hmm.train(docs, held_out(10, 0), **OPTIONS)
    got = sorted(map(tuple, hmm.score(model).collect()), key=str)

    c = Counter(w for r in rows if not out(r[0]) for w in tokens_of(r[1]))
    ends = sum(not out(r[0]) for r in rows)
    n, v = sum(c.values()) + ends, len(c) + 1
    base = lambda x: math.log10((x + 0.1) / (n + 0.1 * (v + 1)))
    # the parameters, word by word, from the model's shards
    words = {w: i for i, w in enumerate(sorted(c))}
    e = np.zeros((len(words), 3))
    shards = {r.shard: hmm.unsqueezed(r.e, r["size"], 3) for r in model.shards.collect()}
    chunk_words = {r.chunk: hmm.unblob(r.words, r["size"]) for r in
                   hmm.chunks(docs, held_out(10, 0), 500).select("chunk", "words", "size").collect()}
    assert len(shards) > 3 and len(chunk_words) >= 3
    for r in model.places.collect():
        for local, place in zip(hmm.unpacked(r.locals, r["size"]), hmm.unpacked(r.places, r["size"])):
            e[words[bytes(chunk_words[r.chunk][local]).decode()]] = shards[r.shard][place]
    assert np.isclose(e.sum(), sum(c.values()), rtol=1e-4)
    unknown = 0.1 / (n + 0.1 * (v + 1))
    q = np.array([c[w] for w in sorted(c)]) / sum(c.values())
    lam = 0.01 * sum(c.values()) / 3
    b = (1 - unknown) * (e + lam * q[:, None]) / (model.totals + lam)
    assert np.allclose(b.sum(axis=0) + unknown, 1)
    m = hmm.Model(model.start, model.moves, np.vstack([b, np.full((1, 3), unknown)]))
    assert np.allclose(m.moves.sum(axis=1), 1) and np.isclose(m.start.sum(), 1)
    want = []
    for doc_id, text, *_ in rows:
        ws = tokens_of(text)
        want.append((doc_id, out(doc_id), len(ws) + 1, sum(w in words for w in ws) + 1, n,
                     sum(base(c[w]) for w in ws) + base(ends),
                     plain_forward(m, [words.get(w, len(words)) for w in ws]) / math.log(10)))
    want = sorted(want, key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-6)


def test_rounds_raise_the_likelihood_and_held_out_texts_score_over_the_base(spark):
    docs = spark.createDataFrame(rows_of(400), COLUMNS).repartition(2)
    model = hmm.train(docs, held_out(10, 0), **{**OPTIONS, "rounds": 4, "sample_rounds": 3})
    assert all(b > a for a, b in zip(model.likelihoods, model.likelihoods[1:], strict=False))
    sums = hmm.score(model).where("held_out").agg(F.sum("score"), F.sum("base_score")).head()
    assert sums[0] > sums[1]


def test_no_training_texts_and_empty_table(spark):
    got = hmm.score_texts(spark.createDataFrame([(1, "a b", "x", 1, "c", 0.0)], COLUMNS), F.lit(True), **OPTIONS).collect()
    assert len(got) == 1 and got[0].train_tokens == 0 and got[0].n_known == 0 and got[0].base_score == 0
    assert math.isfinite(got[0].score)
    assert hmm.score_texts(spark.createDataFrame([], COLUMNS), held_out(10, 0), **OPTIONS).collect() == []
