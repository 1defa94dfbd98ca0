"""ARMA by two least-squares stages, token tensors, scenario draws, the metric store and achievements."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from occuspark.functions import calendar as cal
from occuspark.operators import forecast, members, metric_store, ml, progression


def arma22(n, phi, theta, seed):
    rng = np.random.default_rng(seed)
    e, y = rng.normal(size=n), np.zeros(n)
    for t in range(2, n):
        y[t] = 5 + phi[0] * y[t - 1] + phi[1] * y[t - 2] + e[t] + theta[0] * e[t - 1] + theta[1] * e[t - 2]
    return y


def test_arma_recovers_simulated_coefficients(spark):
    want = {"a": ((0.5, 0.3), (0.4, 0.2)), "b": ((0.6, -0.3), (0.5, 0.4))}
    frames = [pd.DataFrame({"gym_id": g, "seq": np.arange(12_000), "active_people": arma22(12_000, *c, seed=i)})
              for i, (g, c) in enumerate(want.items())]
    df = spark.createDataFrame(pd.concat(frames)).withColumns({
        "ts": F.timestamp_seconds(F.col("seq") * 60).cast("timestamp_ntz"), "is_train": (F.col("seq") < 10_000).cast("int")})
    out = ml.arma_per_series(df.checkpoint()).checkpoint()
    for r in out.groupBy("gym_id").agg(*[F.first(f"b_{c}").alias(c) for c in ("y_1", "y_2", "e_1", "e_2")]).collect():
        phi, theta = want[r.gym_id]
        assert np.allclose([r.y_1, r.y_2, r.e_1, r.e_2], [*phi, *theta], atol=0.08)
    errors = out.where("is_train = 0").agg(F.stddev(F.col("active_people") - F.col("prediction"))).head()[0]
    assert errors == pytest.approx(1.0, abs=0.05)  # one-step errors are the innovations


def test_token_windows_scale_by_train_rows_only(spark):
    rows = [(i, "g" if i % 2 else "h", float(i), None if i == 7 else float(i * i), 3.0, int(i < 30)) for i in range(40)]
    df = spark.createDataFrame(rows, "seq int, gym_id string, a double, b double, c double, is_train int")
    df = df.withColumn("ts", F.timestamp_seconds("seq").cast("timestamp_ntz"))
    got = {r.seq: r for r in ml.token_windows(df, ["a", "b", "c"], ["a", "c"], n=4).collect()}
    train = [r for r in rows if r[5]]
    def z(v, i):
        known = [r[i] for r in train if r[i] is not None]
        s = np.std(known)
        return 0.0 if v is None else (v - np.mean(known)) / (s if s > 0 else 1.0)
    assert sorted(got) == list(range(8, 40))
    for i, r in got.items():
        before = [rows[i - 2 * k] for k in range(4, 0, -1)]
        assert np.allclose(r.tokens, [[z(b[2], 2), z(b[3], 3), 0.0] for b in before])
        assert np.allclose(r.context, [z(rows[i][2], 2), 0.0])


def test_scenario_reruns_agree_and_draws_spread(spark):
    rng = random.Random(2)
    rows = [(i, dt.datetime(2024, 1, 1 + i % 28, 6 + i % 17, rng.randrange(60)), f"gym_00{1 + i % 2}", "c", "a", 20 + rng.randrange(40))
            for i in range(3000)]
    obs = spark.createDataFrame(rows, "seq long, ts timestamp_ntz, gym_id string, city string, address string, active_people int")
    a = forecast.scenario_projection(obs, cal.DEMO_HOLIDAYS)
    first = {(r.gym_id, r.ts): r.active_people for r in a.collect()}
    again = {(r.gym_id, r.ts): r.active_people for r in forecast.scenario_projection(obs.repartition(5), cal.DEMO_HOLIDAYS).collect()}
    assert first == again and len(first) == 2 * 504
    other = {(r.gym_id, r.ts): r.active_people for r in forecast.scenario_projection(obs, cal.DEMO_HOLIDAYS, seed=7).collect()}
    open_ = [k for k, v in first.items() if v]
    assert sum(first[k] != other[k] for k in open_) > len(open_) / 2
    z = spark.range(20_000).select(forecast.normal_draw(F.lit("x"), F.col("id").cast("string")).alias("z"))
    m = z.agg(F.avg("z"), F.stddev("z"), F.avg((F.abs("z") < 1).cast("double"))).head()
    assert abs(m[0]) < 0.03 and abs(m[1] - 1) < 0.03 and abs(m[2] - 0.683) < 0.02


def test_metric_store_reads_last_runs(spark, tmp_path):
    store = metric_store.MetricStore(spark, str(tmp_path / "metrics"))
    assert store.rows().collect() == [] and store.missing() == list(metric_store.SOURCES)

    def board(*rows):
        return spark.createDataFrame([(m, 10, e, e + 1, None) for m, e in rows],
                                     "model string, rows int, mae double, rmse double, wape double")
    store.append(metric_store.metric_rows(board(("x", 3.0), ("y", 1.0)), "baseline", F.col("model")), "01")
    store.append(metric_store.metric_rows(board(("x", 2.0), ("z", 4.0)), "baseline", F.col("model")), "02")
    store.append(metric_store.metric_rows(board(("p", 0.5)), "training_progression", "policy", "next_set_weight_kg"), "01")
    store.append(metric_store.metric_rows(board(("p", 0.7)), "training_progression", "policy", "next_set_weight_kg"), "01")
    got = {(r.model, r.mae, r["rank"]) for r in metric_store.ranked(store.latest()).collect()}
    assert got == {("x", 2.0, 1), ("z", 4.0, 2), ("policy", 0.7, 1)}
    assert store.rows().where("family = 'baseline'").count() == 4
    assert "baseline" not in store.missing() and "tabular_ml" in store.missing()


def test_hybrid_choice_takes_the_policy_unless_a_model_is_better(spark):
    best = spark.createDataFrame([((1.5, "ridge"), (0.8, "forest"))],
                                 "weight_kg struct<mae: double, model: string>, reps struct<mae: double, model: string>")
    rows = [(8, 8, 6, 10), (10, 8, 6, 9)]
    hold = spark.createDataFrame(rows, "reps int, policy_reps int, policy_reps_min int, policy_reps_max int")
    r = progression.hybrid_choice(best, hold).head()
    assert r.selected == "hybrid_ridge_weight_forest_reps" and r.reps_mae == 0.8
    assert r.confidence == pytest.approx(max(0.55, min(0.86, 1 - (1.5 + 1.6 - 0.5) / 25)))
    r = progression.hybrid_choice(best, hold.where("reps = 8")).head()
    assert r.selected == "hybrid_ridge_weight_policy_reps" and r.reps_mae == 0.0


def test_achievements_read_each_table_once_and_take_hot_users(spark):
    """One user holds nine tenths of the sets; counters cross inside a day."""
    day = dt.datetime(2024, 1, 1, 8)
    sets = [(i, 1 if i % 10 else 2, ["a", "b", "c", "d", "e"][i % 5], 50.0, 10, day + dt.timedelta(minutes=i), None) for i in range(600)]
    visits = [(i, 1, day + dt.timedelta(hours=5 * i), 20.0) for i in range(7)]
    s = spark.createDataFrame(sets, "set_id long, user_id long, exercise string, weight_kg double, reps int, "
                                    "performed_at timestamp_ntz, modifiers_json string")
    v = spark.createDataFrame(visits, "visit_id long, user_id long, checked_in_at timestamp_ntz, active_people_at_checkin double")
    t = spark.createDataFrame([(1, 2, day)], "template_id long, user_id long, created_at timestamp_ntz")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    got = {(r.user_id, r.code): r for r in members.achievements(users, s, v, t, core_lifts=("A",), bench="b",
                                                               targets={"exercise_explorer": 4.0}).collect()}
    assert len(got) == 30
    own = [x for x in sets if x[1] == 1]
    run = np.cumsum([x[3] * x[4] for x in own])
    assert got[1, "volume_builder"].unlocked_at == own[int(np.argmax(run >= 50_000))][5]
    assert got[1, "off_peak_hero"].unlocked_at == visits[4][2] and got[1, "attendance_base"].unlocked_at == visits[2][2]
    firsts = sorted(min(x[5] for x in own if x[2] == e) for e in "abcde")
    assert got[1, "exercise_explorer"].unlocked_at == firsts[3] and got[1, "exercise_explorer"].progress == 4.0
    assert got[2, "template_operator"].progress == 1.0 and got[2, "template_operator"].unlocked_at is None
    assert got[1, "bench_milestone"].progress == 50.0 and got[3, "attendance_base"].progress == 0.0
    core = [x for x in own if x[2] == "a"]
    assert (got[1, "strength_master"].unlocked_at == core[19][5]) if len(core) >= 20 else True
