"""Queries for Spark ML experiments.

Model fits are rows-only checks (no SQL oracle); the fitted statistics and the
per-series AR(1) are SQL-expressible and carry oracles.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import aggregates as A
from ..operators import boosting
from ..operators import forecast as FC
from ..operators import metric_store as MS
from ..operators import ml as ML
from ..operators import progression as P
from ..operators import series
from ..operators import weather as WX
from ..session import ensure_checkpoint_dir
from .registry import query
from .views import HOLIDAYS


def _tt(c):
    def build():
        s = c.materialize(c.split())
        return s.filter("is_train = 1"), s.filter("is_train = 0")
    return c._memo("ml_tt", build)


def _ridge(train):
    st = train.agg(F.stddev_pop(F.col(ML.TARGET).cast("double")).alias("s"), F.count(F.lit(1)).alias("n")).first()
    return ML.ridge(1.0, st["s"] or 0.0, st["n"])


@query("ml_preprocess")
def ml_preprocess(c):
    train, _ = _tt(c)
    allrows = ML.as_double(c.split(), ML.NUMERIC)
    model = Pipeline(stages=ML.preprocess_stages(ML.NUMERIC, ML.CATEGORICAL)).fit(ML.as_double(train, ML.NUMERIC))
    rows = model.transform(allrows).select("seq", F.unwrap_udt("features").alias("v"))  # one-hot vectors stay sparse
    return rows.select("seq", F.coalesce("v.size", F.size("v.values")).alias("n_features"),
                       F.aggregate("v.values", F.lit(0.0), lambda a, x: a + x).alias("feature_sum"))


STATS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, avg(CAST({c} AS DOUBLE)) AS mean, "
    f"stddev_pop(CAST({c} AS DOUBLE)) AS std_pop, NULL::VARCHAR AS mode FROM v_split WHERE is_train = 1" for c in ML.NUMERIC)
STATS_SQL += "".join(
    f" UNION ALL SELECT '{c}', NULL, NULL, NULL, (SELECT {c} FROM v_split WHERE is_train = 1 GROUP BY {c} "
    f"ORDER BY count(*) DESC, {c} LIMIT 1)" for c in ML.CATEGORICAL)


@query("ml_preprocess_stats", STATS_SQL)
def ml_preprocess_stats(c):
    train, _ = _tt(c)
    return ML.preprocess_stats(train)


SEQ_SQL = """
WITH s AS (SELECT seq, gym_id, ts, CAST(lag(active_people, 1) OVER w AS DOUBLE) AS l1, CAST(lag(active_people, 12) OVER w AS DOUBLE) AS l12
           FROM v_obs WINDOW w AS (PARTITION BY gym_id ORDER BY ts) QUALIFY lag(active_people, 12) OVER w IS NOT NULL),
j AS (SELECT s.*, v.is_train FROM s JOIN v_split v USING (seq)),
st AS (SELECT avg(l1) AS m1, stddev_pop(l1) AS s1, avg(l12) AS m12, stddev_pop(l12) AS s12 FROM j WHERE is_train = 1)
SELECT seq, (l1 - m1) / s1 AS z_lag_1, (l12 - m12) / s12 AS z_lag_12 FROM j CROSS JOIN st"""


@query("ml_sequence_preprocess", SEQ_SQL)
def ml_sequence_preprocess(c):
    s = series.seq_lags(c.obs().select("seq", "gym_id", "ts", "active_people"))
    j = s.join(c.split().select("seq", "is_train"), "seq")
    st = j.filter("is_train = 1").agg(F.avg("seq_lag_1").alias("m1"), F.stddev_pop("seq_lag_1").alias("s1"),
                                      F.avg("seq_lag_12").alias("m12"), F.stddev_pop("seq_lag_12").alias("s12"))
    k = j.crossJoin(F.broadcast(st))  # one-row statistics fitted on train rows only
    return k.select("seq", ((F.col("seq_lag_1") - F.col("m1")) / F.col("s1")).alias("z_lag_1"),
                    ((F.col("seq_lag_12") - F.col("m12")) / F.col("s12")).alias("z_lag_12"))


@query("ml_ridge")
def ml_ridge(c):
    train, test = _tt(c)
    return ML.fit_predict(train, test, _ridge(train)).select("seq", "gym_id", "ts", "active_people", "prediction")


@query("ml_random_forest")
def ml_random_forest(c):
    train, test = _tt(c)
    return ML.fit_predict(train, test, ML.random_forest()).select("seq", "gym_id", "ts", "active_people", "prediction")


@query("ml_gbt")
def ml_gbt(c):
    train, test = _tt(c)
    return ML.boosted(train, test).select("seq", "gym_id", "ts", "active_people", F.col("p_all").alias("prediction"))


@query("ml_experiment_board")
def ml_experiment_board(c):
    train, test = _tt(c)
    board = ML.experiment_board(train, test, {"ridge_regression": _ridge(train), "random_forest": ML.random_forest()})
    boosted = A.metrics(ML.boosted(train, test), ML.TARGET, "p_all").withColumn("model", F.lit("gradient_boosting"))
    return board.unionByName(boosted)


@query("agg_metrics_clipped_models")
def agg_metrics_clipped_models(c):
    train, test = _tt(c)
    pred = ML.fit_predict(train, test, _ridge(train))
    return A.metrics(pred, ML.TARGET, "prediction", by=["gym_id"], clip=True)


ABLATION_ROUNDS = 200  # fixed value: boosting rounds of the ablations


@query("ml_ablation")
def ml_ablation(c):
    """The boosted model on each group of features, all groups fitted in one stage."""
    train, test = _tt(c)
    pred = ML.boosted(train, test, ML.FEATURE_GROUPS, rounds=ABLATION_ROUNDS)
    return A.metrics_multi(pred, {g: f"p_{g}" for g in ML.FEATURE_GROUPS}, ML.TARGET, model_col="feature_group")


def _with_weather(c, df):
    j = WX.join_weather(df, c.weather()).drop("timestamp_hour")
    return j


@query("ml_weather_ablation")
def ml_weather_ablation(c):
    s = c.materialize(_with_weather(c, c.split()))
    train, test = s.filter("is_train = 1"), s.filter("is_train = 0")
    sets = {"base": ML.NUMERIC, "base_plus_weather": ML.NUMERIC + list(WX.WEATHER_FEATURES)}
    pred = ML.boosted(train, test, sets, numeric=sets["base_plus_weather"], rounds=ABLATION_ROUNDS)
    board = A.metrics_multi(pred, {g: f"p_{g}" for g in sets}, ML.TARGET, model_col="feature_set")
    return board.crossJoin(F.broadcast(WX.coverage(s).select("matched_weather_rows")))  # one row


@query("ml_supplement_diag")
def ml_supplement_diag(c):
    from .q_maintain import _extended
    train, test = _tt(c)
    ext = _extended(c).withColumns({"seq": F.lit(None).cast("bigint"), "city": F.lit(None).cast("string"),
                                    "address": F.lit(None).cast("string")})
    feat = series.feature_table(ext, HOLIDAYS).withColumn("active_people", F.col("active_people").cast("double"))
    places = train.select("gym_id", "city", "address").distinct()
    sup = feat.filter("is_synthetic = 1").drop("city", "address").join(places, "gym_id")
    used = [*ML.CATEGORICAL, *ML.NUMERIC, ML.TARGET]
    both = c.materialize(train.select(*used).unionByName(sup.select(*used)))  # read for means, bins and rows
    boards = [A.metrics(ML.boosted(rows, test, rounds=ABLATION_ROUNDS, row_key=None), ML.TARGET, "p_all")
              .withColumn("experiment", F.lit(name)) for name, rows in (("real_only", train), ("real_plus_supplement", both))]
    return boards[0].unionByName(boards[1])


@query("ml_series_ar_exog", """
WITH tr AS (SELECT * FROM v_split WHERE is_train = 1),
co AS (SELECT gym_id, regr_slope(CAST(active_people AS DOUBLE), lag_1) AS slope, regr_intercept(CAST(active_people AS DOUBLE), lag_1) AS intercept
       FROM tr GROUP BY gym_id),
p AS (SELECT t.gym_id, t.active_people AS a, t.active_people - (co.intercept + co.slope * t.lag_1) AS e
      FROM (SELECT * FROM v_split WHERE is_train = 0) t JOIN co USING (gym_id))
SELECT gym_id, count(e) AS rows, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, sum(abs(e)) / sum(abs(a)) AS wape FROM p GROUP BY gym_id""", digits=6)
def ml_series_ar_exog(c):
    train, test = _tt(c)
    pred = ML.ar1_per_series(train, test)
    return A.metrics(pred, ML.TARGET, "prediction", by=["gym_id"])


@query("ml_series_ar_exog_multi")
def ml_series_ar_exog_multi(c):
    train, test = _tt(c)
    pred = ML.ar_exog_per_series(train, test, ["lag_1", "lag_4", "rolling_mean_16", "is_open_estimated"])
    return A.metrics(pred, ML.TARGET, "prediction", by=["gym_id"])


@query("ml_series_arma")
def ml_series_arma(c):
    """ARMA(2, 2) per site by two least-squares stages, scored on the holdout."""
    pred = ML.arma_per_series(c.materialize(c.split().select("seq", "gym_id", "ts", ML.TARGET, "is_train")))
    return A.metrics(pred.filter("is_train = 0"), ML.TARGET, "prediction", by=["gym_id"], clip=True)


TOKENS = [ML.TARGET, *ML.NUMERIC]


def _scaled_sql(c):
    return (f"coalesce((CAST({c} AS DOUBLE) - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END, 0.0) AS {c}")


TOKEN_SQL = f"""
WITH st AS (SELECT {", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in TOKENS)}
  FROM v_split WHERE is_train = 1),
sc AS (SELECT seq, gym_id, row_number() OVER (PARTITION BY gym_id ORDER BY ts) AS rn, {", ".join(_scaled_sql(c) for c in TOKENS)}
  FROM v_split CROSS JOIN st)
SELECT a.seq, 13 - CAST(k AS BIGINT) AS step, {", ".join(f"b.{c}" for c in TOKENS)}
FROM sc a CROSS JOIN (SELECT unnest(range(1, 13)) AS k) JOIN sc b ON b.gym_id = a.gym_id AND b.rn = a.rn - k WHERE a.rn > 12
UNION ALL SELECT seq, 0, NULL, {", ".join(ML.NUMERIC)} FROM sc WHERE rn > 12"""


@query("ml_token_tensors", TOKEN_SQL, digits=6)
def ml_token_tensors(c):
    """The sequence models' input, flattened: twelve token vectors (oldest first) and, as step 0, the context vector."""
    rows = c.materialize(c.split().select("seq", "gym_id", "ts", "is_train", *TOKENS))  # read for counts, statistics and windows
    w = ML.token_windows(rows, TOKENS, ML.NUMERIC)
    first = F.concat(F.array(F.lit(None).cast("double")), "context")
    steps = w.select("seq", F.posexplode(F.concat(F.array(first), "tokens")).alias("step", "v"))
    return steps.select("seq", "step", *[F.col("v")[i].alias(x) for i, x in enumerate(TOKENS)])


@query("ml_recursive_forecast")
def ml_recursive_forecast(c):
    """The boosted model on the full feature row (calendar, holidays, lags, weather), step by step over seven days."""
    s = c.materialize(_with_weather(c, c.split()))
    train = s.filter("is_train = 1")
    means = [f"{x}_mean" for x in ML.CATEGORICAL]
    features = [*ML.NUMERIC, *WX.WEATHER_FEATURES, *means]
    model = boosting.fit(boosting.target_means(train, train, ML.CATEGORICAL, ML.TARGET), features, ML.TARGET,
                         row_key="seq")["all"]
    ahead = _with_weather(c, FC.future_rows(c.obs(), HOLIDAYS))
    ahead = boosting.target_means(train, ahead, ML.CATEGORICAL, ML.TARGET)
    return ML.recursive_forecast(c.obs(), ahead, model)


def _pg_tt(c):
    from .q_progression import _policy
    pol = P.split(_policy(c))
    feats = P.features(_policy(c)).drop("actual_weight_kg", "actual_reps")
    j = feats.join(pol.select("set_id", "is_train", "policy_weight_kg", "policy_reps", "policy_reps_min", "policy_reps_max",
                              "weight_kg", "reps"), "set_id")
    j = c._memo("pg_tt", lambda: c.materialize(j))
    return j.filter("is_train = 1"), j.filter("is_train = 0")


PG_NUMERIC = ["set_index", "history_count", "latest_weight_kg", "latest_reps", "latest_set_index", "matching_weight_kg",
              "matching_reps", "avg_recent_reps", "avg_recent_weight_kg", "avg_latest_session_reps",
              "avg_latest_session_weight_kg", "best_recent_weight_kg", "best_recent_e1rm", "e1rm_trend", "days_since_last",
              "current_session_sets", "previous_current_weight_kg", "previous_current_reps"]


def _pg_models(c):
    """Predictions of the supervised models for both targets: ``(model, target, rows)``."""
    if "pg_models" in c._cache:
        return c._cache["pg_models"]
    train, test = _pg_tt(c)
    out = []
    for target in ("weight_kg", "reps"):
        tr = ML.as_double(train, [*PG_NUMERIC, target]).withColumnRenamed(target, ML.TARGET)
        te = ML.as_double(test, [*PG_NUMERIC, target]).withColumnRenamed(target, ML.TARGET)
        for name, est in (("ridge", _ridge(tr)), ("forest", ML.random_forest(num_trees=240, max_depth=14, min_leaf=2))):
            out.append((name, target, ML.fit_predict(tr, te, est, numeric=PG_NUMERIC, categorical=["exercise"])))
    c._cache["pg_models"] = out
    return out


@query("pg_supervised")
def pg_supervised(c):
    res = None
    for name, target, pred in _pg_models(c):
        m = A.metrics(pred, ML.TARGET, "prediction").select(F.lit(name).alias("model"), F.lit(target).alias("target"),
                                                            "rows", "mae", "rmse")
        res = m if res is None else res.unionByName(m)
    return res


@query("pg_hybrid_select")
def pg_hybrid_select(c):
    """Best weight model + policy reps when the policy's reps are not worse; confidence from the score.

    The choice is an aggregate over the frame of metrics by (model, target) and the policy's own row.
    """
    best = [F.min(F.when(F.col("target") == t, F.struct("mae", "model"))).alias(t) for t in ("weight_kg", "reps")]
    return P.hybrid_choice(pg_supervised(c).agg(*best), _pg_tt(c)[1])


def _sequence_boosted(c):
    """The boosted model on the twelve previous counts and the context, as the sequence models see them."""
    lags = [f"seq_lag_{i}" for i in range(1, 13)]
    rows = series.seq_lags(c.split().select("seq", "gym_id", "ts", ML.TARGET)).select("seq", *lags)
    s = c.materialize(c.split().join(rows, "seq"))
    pred = ML.boosted(s.filter("is_train = 1"), s.filter("is_train = 0"), numeric=lags + ML.CALENDAR + ML.HOLIDAY,
                      rounds=ABLATION_ROUNDS)
    return A.metrics(pred, ML.TARGET, "p_all")


def _ar1(c):
    pred = ML.ar1_per_series(*_tt(c)).filter(F.col("prediction").isNotNull())
    return A.metrics(pred, ML.TARGET, "prediction", clip=True)


def _arma(c):
    pred = ML.arma_per_series(c.materialize(c.split().select("seq", "gym_id", "ts", ML.TARGET, "is_train")))
    return A.metrics(pred.filter("is_train = 0"), ML.TARGET, "prediction", clip=True)


#: Source of the registry -> its board of metrics and how its models are named.
BOARDS = {
    "baseline": (lambda c: FC.baseline_board(c.pred()), "model"),
    "tabular_ml": (ml_experiment_board, "model"),
    "feature_ablation": (ml_ablation, "feature_group"),
    "sequence_boosted": (_sequence_boosted, None),
    "statistical_exogenous": (_ar1, None),
    "statistical_arma": (_arma, None),
    "weather_ablation": (ml_weather_ablation, "feature_set"),
    "synthetic_training_diagnostic": (ml_supplement_diag, "experiment"),
    "training_progression": (lambda c: pg_supervised(c).filter("target = 'weight_kg'").drop("target"), "model"),
}
NAMES = {"sequence_boosted": "boosted_sequence_12", "statistical_exogenous": "ar1_per_gym", "statistical_arma": "arma_2_2_per_gym"}


@query("ml_metric_registry")
def ml_metric_registry(c):
    """The registry over all nine metric sources: those that have no run of this data yet are evaluated and appended
    to the shared store, then the last run of each is ranked."""
    name = hashlib.sha256(c.sf_dir.encode()).hexdigest()[:16]
    store = MS.MetricStore(c.spark, f"{ensure_checkpoint_dir(c.spark).rstrip('/')}/model-metrics-{name}")
    for family in store.missing():
        board, label = BOARDS[family]
        target = "next_set_weight_kg" if family == "training_progression" else "occupancy_people"
        model = NAMES[family] if label is None else F.col(label)
        run = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        store.append(MS.metric_rows(board(c), family, model, target), run)
    return MS.ranked(store.latest()).drop("run")
