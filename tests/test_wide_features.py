"""Linear models and preprocessing when one-hot categories outgrow the normal equations."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from occuspark.operators import ml
from occuspark.plans import q_ml


def rows(spark, sites):
    r = spark.range(sites * 3).withColumn("gym_id", F.concat(F.lit("g"), (F.col("id") % sites).cast("string")))
    return r.select("gym_id", F.concat(F.lit("at "), "gym_id").alias("address"), F.sin("id").alias("a"), F.cos(F.col("id") * 3).alias("b"),
                    (F.col("id") % sites % 17 + F.sin("id") * 4 + 20).alias("active_people"), F.col("id").alias("seq"))


def fitted(train):
    got = ml.fit_predict(train, train, q_ml._ridge(train), numeric=["a", "b"], categorical=["gym_id", "address"])
    return np.array([r[0] for r in got.orderBy("seq").select("prediction").collect()])


def test_ridge_on_more_features_than_the_normal_equations_take(spark):
    assert len(fitted(rows(spark, 2100).checkpoint())) == 6300  # 4,204 features


def test_both_solvers_agree(spark, monkeypatch):
    train = rows(spark, 40).checkpoint()
    normal = fitted(train)
    monkeypatch.setattr(ml, "NORMAL_WIDTH", 10)
    assert np.allclose(fitted(train), normal, atol=1e-3) and normal.std() > 1


def test_preprocessed_rows_are_summed_sparse(spark, monkeypatch):
    train = rows(spark, 30).withColumn("city", F.lit("x")).checkpoint()
    monkeypatch.setattr(ml, "NUMERIC", ["a", "b"])

    class Ctx:
        def split(self):
            return train

    monkeypatch.setattr(q_ml, "_tt", lambda c: (train, None))
    out = q_ml.ml_preprocess(Ctx())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["seq"]: r for r in out.collect()}
    model = Pipeline(stages=ml.preprocess_stages(["a", "b"], ml.CATEGORICAL)).fit(train)
    want = {r["seq"]: r["features"] for r in model.transform(train).select("seq", "features").collect()}
    assert "UDF(features" not in plan and len(got) == 90
    for k, v in want.items():
        assert got[k]["n_features"] == v.size and got[k]["feature_sum"] == pytest.approx(v.toArray().sum(), abs=1e-9)
