"""Sainte-Laguë quotas and the mix against plain re-computation."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from occuspark.llm import mixing


def one_by_one(votes, seats, most):
    got = [0] * len(votes)
    for _ in range(min(seats, sum(m for m, v in zip(most, votes, strict=True) if v > 0))):
        open_ = [i for i in range(len(votes)) if got[i] < most[i] and votes[i] > 0]
        got[max(open_, key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
    return got


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 30)), min_size=1, max_size=8), st.integers(0, 150))
def test_quotas_are_the_highest_quotients(entries, seats):
    votes, most = [v for v, _ in entries], [m for _, m in entries]
    got = mixing.sainte_lague(np.array(votes, float), seats, np.array(most)).tolist()
    want = one_by_one(votes, seats, most)
    assert sum(got) == sum(want) and all(g <= m for g, m in zip(got, most, strict=True))
    # seats of equal quotients may go either way
    quotients = lambda s: sorted(v / (2 * a + 1) for v, n in zip(votes, s, strict=True) for a in range(n))
    assert np.allclose(quotients(got), quotients(want))


def test_targets_stop_at_three_times_and_keep_the_total():
    t = mixing.targets(np.array([1000, 10, 500, 0]), np.array([1.0, 2.0, 3.0, 1.0]))
    assert t[1] == 30 and t[3] == 0
    assert abs(t.sum() - 1510) < 1e-6 and abs(t[2] / t[0] - 3) < 1e-6


def test_mix_takes_near_targets_and_reruns_agree(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 400))), f"s{min(4, int(rng.exponential(1.2)))}", "x", 3.5)
            for i in range(3000)]
    rows += [(9001, None, "s0", "x", 1.0), (9002, "a b", None, "x", 1.0), (9002, "a b", None, "x", 1.0),
             (None, "c\x0bd e", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, target double")
    opts = {"shard_words": 5000, "shard_rows": 100}
    out = mixing.mix(docs, **opts).toPandas()
    assert len(out) == len(rows)
    size = sorted(len(re.findall(mixing.WORD, r[1] or "")) for r in rows)
    assert sorted(out["size"]) == size
    assert (out.taken <= 3 * out["size"]).all() and (out.taken >= 0).all()
    by = out.groupby("source", dropna=False).agg(t=("target", "first"), got=("taken", "sum"), n=("size", "sum"),
                                                 s=("source_size", "first"))
    assert (by.n == by.s).all()
    assert (abs(by.got - by.t) <= 0.02 * by.t + 2).all()
    again = mixing.mix(docs.repartition(7), **opts).toPandas()
    key = ["doc_id", "size", "taken"]
    assert out[key].sort_values(key).values.tolist().__repr__() == again[key].sort_values(key).values.tolist().__repr__()
    copies = mixing.copies(docs, **opts)
    assert copies.columns == docs.columns
    words = copies.selectExpr("source", "size(array_remove(split(coalesce(text, ''), '[ \\\\x0b]+'), '')) AS n").groupBy("source").sum("n").collect()
    got = {r[0]: r[1] for r in words}
    assert all(abs(got[s] - t) <= 0.05 * t + 400 for s, t in zip(by.index, by.t, strict=True) if isinstance(s, str))


def test_mix_empty_and_wordless(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    out = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, "  ", None)], schema)).toPandas()
    assert out.taken.tolist() == [0, 0] and out.target.tolist() == [0.0, 0.0]
    assert mixing.copies(spark.createDataFrame([(1, None, "a")], schema)).count() == 0


def test_group_deal_keeps_the_parents_blocks(spark):
    rows = [(0, i, int(10 + i % 7), 500) for i in range(90)] + [(1, i, 3, 2) for i in range(5)]
    got = mixing.deal(spark.createDataFrame(rows, "k int, shard int, size long, blocks long"), ["k"], "shard").toPandas()
    assert got[got.k == 0].blocks.sum() == 500 and got[got.k == 1].blocks.sum() == 2


def test_plan_does_not_repeat_the_sums(spark):
    rows = [(i, "w " * (i % 9), "abc"[i % 3]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange", plan)) <= 12
