import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from occuspark.operators import ordering, series, topk


def _series(spark, n=150, gyms=("gym_001", "gym_002")):
    rnd = random.Random(7)
    rows = []
    for g in gyms:
        t0 = dt.datetime(2026, 5, 1)
        for i in range(n):
            rows.append((i, g, t0 + dt.timedelta(minutes=20 * i), rnd.randint(0, 120)))
    return spark.createDataFrame(rows, "seq long, gym_id string, ts timestamp_ntz, active_people int"), rows


def test_lags_and_rolling_match_python(spark):
    df, rows = _series(spark)
    out = {(r.gym_id, r.seq): r for r in series.rolling_features(series.lag_features(df)).collect()}
    for g in ("gym_001", "gym_002"):
        vals = [r[3] for r in rows if r[1] == g]
        for i, v in enumerate(vals):
            r = out[(g, i)]
            assert r.lag_1 == (vals[i - 1] if i >= 1 else None)
            assert r.lag_96 == (vals[i - 96] if i >= 96 else None)
            sample = vals[max(0, i - 16):i]
            exp = sum(sample) / len(sample) if sample else None
            assert (r.rolling_mean_16 is None and exp is None) or abs(r.rolling_mean_16 - exp) < 1e-9


def test_dedupe_last_keeps_highest_sequence(spark):
    df = spark.createDataFrame([(1, "g", 1, 5), (2, "g", 1, 7), (3, "g", 2, 1)], "seq long, gym_id string, ts int, v int")
    out = sorted((r.ts, r.v) for r in topk.dedupe_last(df, ["gym_id", "ts"]).collect())
    assert out == [(1, 7), (2, 1)]


def test_current_streak(spark):
    d = [dt.date(2026, 5, x) for x in (1, 2, 4, 5, 6)]
    df = spark.createDataFrame([(1, x) for x in d] + [(2, dt.date(2026, 5, 3))], "user_id int, day date")
    out = {r.user_id: r.streak for r in series.current_streak(df).collect()}
    assert out == {1: 3, 2: 1}


def test_distinct_cross_counts_ties(spark):
    t = dt.datetime(2026, 5, 1)
    rows = [(1, t, "a"), (1, t, "b"), (1, t + dt.timedelta(hours=1), "a"), (1, t + dt.timedelta(hours=2), "c")]
    df = spark.createDataFrame(rows, "user_id int, ts timestamp_ntz, item string")
    r = series.distinct_cross(df, "user_id", "ts", "item", 2).first()
    assert r.crossed_at == t
    r3 = series.distinct_cross(df, "user_id", "ts", "item", 3).first()
    assert r3.crossed_at == t + dt.timedelta(hours=2)


def test_split_first_80_percent(spark):
    df, _ = _series(spark, n=10, gyms=("g",))
    flags = [r.is_train for r in series.split_flags(df).orderBy("ts").collect()]
    assert flags == [1] * 8 + [0] * 2


def test_global_row_number_is_a_total_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"))
    out = ordering.total_order(df, ["k"])
    plan = out._jdf.queryExecution().toString()
    assert "Window" not in plan
    got = sorted((r.k, r.pos) for r in out.collect())
    assert got == [(k, k + 1) for k in range(1000)]


def test_infer_interval(spark):
    df, _ = _series(spark, n=30)
    assert series.infer_interval(df).first().interval_minutes == 20


def _hot(spark, n=3000):
    return spark.range(n).select(
        F.col("id").alias("seq"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 37 % 100000)").alias("ts"),
        F.when(F.col("id") % 10 == 0, "g2").otherwise("g1").alias("gym_id"), (F.col("id") * 7919 % 101).cast("int").alias("active_people"))


def test_chunked_windows_on_a_hot_entity(spark):
    df = _hot(spark)
    got = series.lag_features(df, lags=(1, 5), tiebreak="seq", chunk_rows=64)
    got = series.rolling_features(got, windows=(5,), tiebreak="seq", chunk_rows=50).toPandas().sort_values(["gym_id", "ts", "seq"])
    exp = df.toPandas().sort_values(["gym_id", "ts", "seq"])
    by = exp.groupby("gym_id").active_people
    for n in (1, 5):
        assert got[f"lag_{n}"].fillna(-1).tolist() == by.shift(n).fillna(-1).tolist()
    want = by.transform(lambda s: s.shift(1).rolling(5, min_periods=1).mean())
    assert all(abs(a - b) < 1e-9 or (a != a and b != b) for a, b in zip(got.rolling_mean_5, want, strict=True))


def test_no_window_spans_an_entity(spark):
    df = _hot(spark, 100)
    for out in (series.lag_features(df), series.seq_lags(df), series.seq_windows(df), series.split_flags(df), series.split3(df)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Window [lag(" not in plan.replace("_c#", "_c") or "_c#" in plan
        for line in plan.splitlines():
            if "Window [" in line and ("lag(" in line or "collect_list(" in line):
                assert "_c#" in line.split("windowspecdefinition(")[1].split("ASC")[0]


def test_splits_follow_positions(spark):
    df = _hot(spark, 1000)
    got = series.split3(df, tiebreak="seq").toPandas().sort_values(["gym_id", "ts", "seq"])
    for _, g in got.groupby("gym_id"):
        n = len(g)
        assert g.split.tolist() == ["train"] * int(n * 0.7) + ["validation"] * (int(n * 0.8) - int(n * 0.7)) + ["test"] * (n - int(n * 0.8))


def test_exact_quantiles_of_real_values(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    rows = [("a", float(x)) for x in rng.lognormal(0, 3, 4001)] + [("b", float(x)) for x in rng.integers(0, 3, 500)] + [("c", 1.5), ("d", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    for q in (0.0, 0.5, 0.8, 1.0):
        got = {r.k: r.quantile for r in series.exact_quantiles(df, "v", ["k"], q, pieces=16).collect()}
        for k in "abc":
            want = np.quantile([v for i, v in rows if i == k], q)
            assert abs(got[k] - want) <= 1e-9 * max(1, abs(want))
        assert "d" not in got
    one = series.exact_quantiles(df, "v", [], 0.5).first().quantile
    assert abs(one - np.median([v for _, v in rows if v is not None])) < 1e-9


def test_interval_without_gaps(spark):
    df = spark.createDataFrame([("g", None)], "gym_id string, ts timestamp_ntz")
    assert series.infer_interval(df).first()[0] == 20


def test_keyed_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(4)
    values = {"skew": rng.exponential(5, 30_000), "ties": rng.integers(0, 3, 20_000).astype(float), "one": np.array([4.0]),
              "two": np.array([1.0, 2.0]), "same": np.full(9000, 7.0), "few": rng.normal(size=11), "far": np.r_[np.zeros(9000), 1e12]}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("few", None), (None, 3.0), (None, 5.0), ("none", None)]
    df = spark.createDataFrame(rows, "key string, value double").repartition(7)
    for q in (0.5, 0.8, 0.0, 1.0, 0.37):
        for accuracy in (2000, 100):
            got = {r.key: r.quantile for r in ordering.keyed_quantiles(df, q, accuracy=accuracy).collect()}
            assert got.keys() == values.keys() | {None} and abs(got.pop(None) - (3 + 2 * q)) < 1e-9
            for k, v in got.items():
                assert v == pytest.approx(np.quantile(values[k], q), rel=1e-12, abs=1e-12)


def test_total_order_with_ties_and_no_rows(spark):
    df = spark.range(500).select((F.col("id") % 5).alias("k"), "id").repartition(9)
    out = [(r.pos, r.k) for r in ordering.total_order(df, ["k"]).collect()]
    assert [k for _, k in sorted(out)] == sorted(k for _, k in out) and sorted(p for p, _ in out) == list(range(1, 501))
    assert ordering.total_order(df.limit(0), ["k"]).collect() == []
