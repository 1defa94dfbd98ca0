"""Best match by token overlap against comparing every pair."""

import random

import pytest
from pyspark.sql import functions as F

from occuspark.operators import catalogue as CT
from occuspark.operators import setjoin


def plain(ex, rec, threshold):
    out = {}
    for i, n, g in ex:
        a, best = set(n.split()), None
        for j, m, h in rec:
            b = set(m.split())
            if a & b:
                s = len(a & b) / max(len(a), len(b)) + (g is not None and g == h)
                if best is None or (-s, j) < (-best[1], best[0]):
                    best = (j, s)
        if best and best[1] >= threshold:
            out[i] = best
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_best_match_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"tok{int(30 ** rng.random())}" for _ in range(60)]

    def rows(n, first):
        return [(first + i, " ".join(rng.sample(vocabulary, rng.randrange(1, 7))), rng.choice(["A", "B", "C", None]))
                for i in range(n)]

    ex, rec = rows(150, 0), rows(120, 1000)
    ex += [(900, ex[0][1], "A"), (901, "unseen", "A"), (902, "", "A")]
    e = spark.createDataFrame(ex, "item_id long, name string, muscle_group string")
    r = spark.createDataFrame(rec, "record_id long, name string, muscle_group string")
    for threshold in (0.34, 0.8):
        got = {x.item_id: (x.record_id, x.score) for x in CT.fuzzy_match(e, r, threshold).collect()}
        assert got == plain(ex, rec, threshold)


def test_a_popular_token_forms_no_pairs(spark):
    """Every set holds the popular token: one shared token is a look-up, and longer sets meet on rarer tokens."""
    n = 4000
    def side(first, sep):
        return spark.range(n).select((F.col("id") + first).alias("rec"), F.array(
            F.lit("popular"), F.concat(F.lit(sep), F.col("id").cast("string"))).alias("tok"), F.lit("A").alias("g"))
    wanted = setjoin.signatures(side(0, "e").unionByName(side(0, "both").limit(50)), "tok", "g")
    records = setjoin.signatures(side(n, "r").unionByName(side(n, "both").limit(50)), "tok", "g", F.min("rec").alias("rec"))
    place = setjoin.placed(wanted.select("sig").unionByName(records.select("sig")))
    assert place.where("t = 'popular'").agg(F.min("p")).head()[0] == 1  # always last
    w, r = wanted.join(place, "sig"), records.join(place, "sig")
    formed = setjoin.pairs(w, r, setjoin.by_one_token(w, r, "rec"), "rec", 0.34)
    assert formed.count() <= 50
    best = setjoin.best_match(wanted, records, 0.34, "rec")
    assert best.count() == wanted.count() and best.where("score = 2").count() == formed.count()
