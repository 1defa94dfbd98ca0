"""Quality rules and toxicity lexicon: held-out accuracy, folding, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from occuspark.llm import quality, toxicity

DATA = "/root/testdata/sf0.1"


def held(spark, query, label):
    rows = query(spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").where("held_out").toPandas()
    return rows.score.to_numpy(), rows.predicted.to_numpy(), rows[label].to_numpy()


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable"))
    return (order[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())


def test_quality_held_out(spark):
    from occuspark.llm.queries import op3_rule_quality
    score, predicted, y = held(spark, op3_rule_quality, "quality")
    assert auc(score, y) > 0.98 and (predicted == y).mean() > 0.97


def test_toxicity_held_out(spark):
    from occuspark.llm.queries import op1_toxicity
    score, predicted, y = held(spark, op1_toxicity, "toxic")
    assert auc(score, y) > 0.9 and (predicted == y).mean() > 0.97
    assert predicted[y == 0].mean() < 0.01


EDGE = [(1, None, "x", 0.5), (2, "", "x", 0.5), (3, "   \n\t", "x", 0.5), (4, "a" * 200_000, "x", 0.5),
        (5, "word " * 60_000, "x", 0.5), (6, "line one.\nline one.", "x", 0.5), (6, "line one.\nline one.", "x", 0.5),
        (None, "no id", "x", 0.5)]
SCHEMA = "doc_id long, text string, words string, score double"


@pytest.mark.parametrize("module", [quality, toxicity])
def test_edge_rows_get_a_score(spark, module):
    docs = spark.createDataFrame(EDGE, SCHEMA)
    sample = spark.createDataFrame([(i, f"good plain sentence number {i}." if i % 2 else "bad$$ $$ rotten ## word" * 3,
                                     i % 2) for i in range(60)], "doc_id long, text string, label int")
    model = module.fit(sample)
    out = module.score(docs, model).toPandas()
    assert len(out) == len(EDGE) and out.score.between(0, 1).all()
    assert out.score.iloc[0] == out.score.iloc[1]
    assert module.kept(docs, model).columns == docs.columns
    assert module.score(spark.createDataFrame([], SCHEMA), model).count() == 0


@pytest.mark.parametrize("labels", [[], [0, 0, 0], [1, 1]])
@pytest.mark.parametrize("module", [quality, toxicity])
def test_fit_without_both_classes(spark, module, labels):
    sample = spark.createDataFrame([(i, f"text {i}", y) for i, y in enumerate(labels)],
                                   "doc_id long, text string, label int")
    scores = module.score(spark.createDataFrame(EDGE, SCHEMA), module.fit(sample)).toPandas().score
    assert scores.nunique() == 1 and scores.between(0, 1).all()


def test_rules_score_like_their_columns(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["Word", "the", "of##", "a,", "END.", "x|"], rng.integers(1, 60))) for _ in range(200)]
    sample = spark.createDataFrame([(i, t, int(t.count("#") < 8)) for i, t in enumerate(texts)],
                                   "doc_id long, text string, label int")
    model = quality.fit(sample)
    assert model.rules
    x = np.array([list(r) for r in sample.orderBy("doc_id").select(quality.statistics(F.col("text")).alias("s"))
                  .select(*[F.col("s")[f] for f in quality.FEATURES]).collect()])
    got = [r.score for r in quality.score(sample, model).orderBy("doc_id").collect()]
    assert np.allclose(got, model.score(x))


def test_statistics_of_a_small_text(spark):
    text = "One two two.\nThree $4\n\nThree $4"
    st = spark.createDataFrame([(text,)], "t string").select(quality.statistics(F.col("t")).alias("s")).first().s
    assert abs(st.log_words - np.log1p(7)) < 1e-12 and abs(st.distinct_words - 5 / 7) < 1e-12
    assert abs(st.repeated_lines - 1 / 3) < 1e-12 and st.digits == 2 / len(text) and st.symbols == 2 / len(text)


def test_lasso_drops_useless_rules():
    rng = np.random.default_rng(1)
    z = rng.integers(0, 2, (800, 6)).astype(float)
    _, w = quality.lasso_logistic(z, z[:, 2], 0.01)
    assert w[2] > 1 and (np.abs(np.delete(w, 2)) < 0.05).all()


def test_folding_meets_look_alikes():
    t = toxicity.Folding()
    plain = toxicity.fold("You idiot loser, stupid!", t)
    assert toxicity.fold("Y0u 1d10t 1oser, ѕtuріd!", t) == plain
    assert toxicity.fold("ＹＯＵ ÏDÏÓT lo​ser -- stupid", t) == plain


def test_exceptions_hide_hits():
    lexicon = toxicity.Lexicon({" trash ": 2.0, " idiot": 3.0})
    a, t = lexicon.automaton(), toxicity.Folding()
    assert toxicity.features(toxicity.fold("put it in the trash can", t), a)[1] == 0.0
    assert toxicity.features(toxicity.fold("put it in the tr4sh, idiotic", t), a)[1] == pytest.approx(np.log1p(5.0))
    short, long = (toxicity.features(toxicity.fold("idiot " + "fine words " * n, t), a)[0] for n in (2, 200))
    assert short > long


def test_lexicon_keeps_the_most_telling_beginning(spark):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join([f"w{int(x)}" + "ab" * (i % 3) for x in rng.integers(0, 500, 30)]
                         + ([f"nastig{'en' if i % 4 else 'er'}"] if i % 5 == 0 else [])), int(i % 5 == 0))
            for i in range(400)]
    found = toxicity.learn_lexicon(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    assert any(t.startswith(" nasti") for t in found) and len(found) < 5
