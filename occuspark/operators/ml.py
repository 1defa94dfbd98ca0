"""Spark ML forecasting experiments: preprocessing, pooled models, ablations,
per-series autoregression and the recursive multi-step forecast.

Model fitting is Spark ML (distributed tree / normal-equation solvers) and, for the
boosted model, :mod:`boosting`.  The recursive forecast walks the horizon of a bucket of sites
over fixed 96-value histories, so its memory does not depend on how long a site's history is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, OneHotEncoder, OneHotEncoderModel, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import aggregates, boosting, forest, ordering, series

TARGET = "active_people"
CATEGORICAL = ["gym_id", "city", "address"]
CALENDAR = ["hour", "day_of_week", "is_weekend", "month", "day_of_month", "week_of_year", "is_open_estimated"]
HOLIDAY = ["is_public_holiday", "is_gym_closed_holiday", "is_major_low_traffic_holiday", "is_major_holiday_window",
           "days_to_nearest_major_holiday", "holiday_effect_multiplier"]
LAGS = ["lag_1", "lag_4", "lag_96"]
ROLLING = ["rolling_mean_4", "rolling_mean_16", "rolling_mean_96"]
NUMERIC = CALENDAR + HOLIDAY + LAGS + ROLLING
NORMAL_WIDTH = 4096  # features that Spark's normal-equation solver takes
FOREST_WORK = 1_500_000  # rows x trees that Spark's forest takes
# Feature groups of the ablation.
FEATURE_GROUPS = {
    "calendar_only": CALENDAR, "calendar_holiday": CALENDAR + HOLIDAY, "lag_only": LAGS, "rolling_only": ROLLING,
    "calendar_lag": CALENDAR + LAGS, "calendar_holiday_lag": CALENDAR + HOLIDAY + LAGS,
    "calendar_rolling": CALENDAR + ROLLING, "lag_rolling": LAGS + ROLLING, "all_features": NUMERIC,
}


def as_double(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def preprocess_stages(numeric, categorical, out="features"):
    """Median imputation + z-score for numbers; one-hot for categories (unknown -> all zeros)."""
    imp = Imputer(strategy="median", inputCols=list(numeric), outputCols=[f"_imp_{c}" for c in numeric])
    num_vec = VectorAssembler(inputCols=[f"_imp_{c}" for c in numeric], outputCol="_num", handleInvalid="keep")
    scaler = StandardScaler(inputCol="_num", outputCol="_num_z", withMean=True, withStd=True)
    stages = [imp, num_vec, scaler]
    cat_out = []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"_idx_{c}", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol=f"_idx_{c}", outputCol=f"_oh_{c}", dropLast=True, handleInvalid="keep"))
        cat_out.append(f"_oh_{c}")
    stages.append(VectorAssembler(inputCols=["_num_z", *cat_out], outputCol=out))
    return stages


def preprocess_stats(train: DataFrame, numeric=NUMERIC, categorical=CATEGORICAL) -> DataFrame:
    """The fitted medians / means / population std (numbers) and modes (categories) as rows.

    All medians come from the same two passes over the rows.
    """
    long = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                                            for c in numeric])).alias("x")).select("x.*")
    medians = ordering.keyed_quantiles(long, 0.5, "feature")
    moments = long.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std_pop"))
    rows = moments.join(medians, "feature", "left").select("feature", F.col("quantile").alias("median"), "mean", "std_pop",
                                                           F.lit(None).cast("string").alias("mode"))
    for c in categorical:
        counts = train.groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        mode = counts.agg(F.min_by(F.col(c), F.struct(-F.col("_n"), F.col(c))).alias("mode")).select(
            F.lit(c).alias("feature"), F.lit(None).cast("double").alias("median"), F.lit(None).cast("double").alias("mean"),
            F.lit(None).cast("double").alias("std_pop"), "mode")
        rows = rows.unionByName(mode)
    return rows


def ridge(alpha: float, label_std_pop: float, n: int, features="features"):
    """sklearn-equivalent ridge: Spark scales the L2 penalty by the label deviation."""
    return LinearRegression(featuresCol=features, labelCol=TARGET, solver="normal", elasticNetParam=0.0,
                            regParam=alpha * label_std_pop / max(1, n) if label_std_pop else 0.0, standardization=False)


def random_forest(num_trees=160, max_depth=14, min_leaf=4, seed=42, features="features"):
    return RandomForestRegressor(featuresCol=features, labelCol=TARGET, numTrees=num_trees, maxDepth=max_depth,
                                 minInstancesPerNode=min_leaf, seed=seed)


def gbt(max_iter=240, step=0.06, max_depth=5, seed=42, features="features"):
    return GBTRegressor(featuresCol=features, labelCol=TARGET, maxIter=max_iter, stepSize=step, maxDepth=max_depth, seed=seed)


def fit_predict(train: DataFrame, test: DataFrame, estimator, numeric=NUMERIC, categorical=CATEGORICAL,
                pred_col="prediction") -> DataFrame:
    """Fit preprocessing + estimator on train, predict test; predictions clipped at 0.

    A linear model on more features than the normal equations take (one-hot sites grow with
    the data) is fitted by L-BFGS: the same least squares, by passes over the sparse rows.
    A forest of more rows x trees than Spark's takes is grown by :mod:`forest`, with its parameters.
    """
    tr = as_double(train, [*numeric, TARGET])
    te = as_double(test, [*numeric, TARGET])
    if isinstance(estimator, RandomForestRegressor) and tr.count() * estimator.getNumTrees() > FOREST_WORK:
        model = forest.fit(tr, list(numeric), list(categorical), TARGET, estimator.getNumTrees(), estimator.getMaxDepth(),
                           estimator.getMinInstancesPerNode(), estimator.getSeed())
        return te.withColumn(pred_col, F.greatest(model.column(train.sparkSession), F.lit(0.0)))
    prepared = Pipeline(stages=preprocess_stages(numeric, categorical)).fit(tr)
    width = len(numeric) + sum(s.categorySizes[0] for s in prepared.stages if isinstance(s, OneHotEncoderModel))
    if isinstance(estimator, LinearRegression) and estimator.getSolver() == "normal" and width > NORMAL_WIDTH:
        n = max(2, tr.count())  # this solver scales the penalty by the sample deviation, the other by the population's
        estimator = estimator.copy({estimator.solver: "l-bfgs", estimator.maxIter: 500, estimator.tol: 1e-10,
                                    estimator.regParam: estimator.getRegParam() * (n / (n - 1)) ** 0.5})
    out = estimator.fit(prepared.transform(tr)).transform(prepared.transform(te))
    return out.withColumn(pred_col, F.greatest(F.col("prediction"), F.lit(0.0)))


def experiment_board(train: DataFrame, test: DataFrame, models: dict, numeric=NUMERIC, categorical=CATEGORICAL) -> DataFrame:
    boards = []
    for name, est in models.items():
        pred = fit_predict(train, test, est, numeric, categorical)
        boards.append(aggregates.metrics(pred, TARGET, "prediction").withColumn("model", F.lit(name)))
    out = boards[0]
    for b in boards[1:]:
        out = out.unionByName(b)
    return out


def ar1_per_series(train: DataFrame, test: DataFrame, key="gym_id", y=TARGET, x="lag_1") -> DataFrame:
    """Per-series AR(1) by least squares (``regr_slope`` / ``regr_intercept``), scored on the holdout."""
    coef = train.groupBy(key).agg(F.regr_slope(F.col(y).cast("double"), F.col(x)).alias("slope"),
                                  F.regr_intercept(F.col(y).cast("double"), F.col(x)).alias("intercept"))
    pred = test.join(coef, key).withColumn("prediction", F.col("intercept") + F.col("slope") * F.col(x))
    return pred


def least_squares_per_series(train: DataFrame, regressors, key="gym_id", y=TARGET) -> DataFrame:
    """Per-series least squares on several regressors: Gram sums X'X, X'y by ``groupBy`` (one row of
    k x k sums per series), then a k x k solve per series in ``applyInPandas``.  Rows with a null take no part."""
    cols = ["_one", *regressors]
    t = train.withColumn("_one", F.lit(1.0)).dropna(subset=[*regressors, y])
    sums = [F.sum(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"xx_{a}__{b}") for i, a in enumerate(cols) for b in cols[i:]]
    sums += [F.sum(F.col(a).cast("double") * F.col(y).cast("double")).alias(f"xy_{a}") for a in cols]
    gram = t.groupBy(key).agg(*sums)
    k = len(cols)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        xtx = np.zeros((k, k))
        for i, a in enumerate(cols):
            for j in range(i, k):
                xtx[i, j] = xtx[j, i] = row[f"xx_{a}__{cols[j]}"]
        xty = np.array([row[f"xy_{a}"] for a in cols])
        beta = np.linalg.lstsq(xtx, xty, rcond=None)[0]
        return pd.DataFrame({key: [row[key]], **{f"b_{c}": [float(b)] for c, b in zip(cols, beta)}})

    return gram.groupBy(key).applyInPandas(solve, f"{key} string, " + ", ".join(f"b_{c} double" for c in cols))


def linear(regressors) -> Column:
    """The prediction of ``least_squares_per_series`` coefficients."""
    expr = F.col("b__one")
    for c in regressors:
        expr = expr + F.col(f"b_{c}") * F.col(c)
    return expr


def ar_exog_per_series(train: DataFrame, test: DataFrame, regressors, key="gym_id", y=TARGET) -> DataFrame:
    """Test rows with the clipped prediction of per-series least squares."""
    pred = test.join(least_squares_per_series(train, regressors, key, y), key)
    return pred.withColumn("prediction", F.greatest(linear(regressors), F.lit(0.0)))


def arma_per_series(df: DataFrame, p: int = 2, q: int = 2, long: int = 20, key="gym_id", ts="ts", y=TARGET,
                    tiebreak: str | None = "seq", flag="is_train", exog=()) -> DataFrame:
    """Per-series ARMA(p, q) by Hannan and Rissanen's two least-squares stages, with one-step predictions.

    1. A long autoregression (``long`` lags) gives every row its innovation.
    2. The value is regressed on ``p`` own lags, ``q`` lagged innovations and ``exog``.

    Both stages fit on the train rows; lags come from chunked windows, so no task holds a
    series.  Returns the rows with ``b_*`` coefficients and ``prediction`` (null for a
    series' first ``long + q`` rows).
    """
    own = [f"y_{i}" for i in range(1, long + 1)]
    value = F.col(y).cast("double")
    lagged = series.over_chunks(df, lambda w: {c: F.lag(value, i + 1).over(w) for i, c in enumerate(own)}, long, key, ts, tiebreak)
    first = least_squares_per_series(lagged.filter(F.col(flag) == 1), own, key, y)
    inner = lagged.join(first, key).withColumn("_e", value - linear(own)).drop("b__one", *[f"b_{c}" for c in own], *own[max(p, 1):])
    shocks = [f"e_{i}" for i in range(1, q + 1)]
    rows = series.over_chunks(inner, lambda w: {c: F.lag("_e", i + 1).over(w) for i, c in enumerate(shocks)}, max(q, 1), key, ts,
                              tiebreak)
    used = [*own[:p], *shocks, *exog]
    second = least_squares_per_series(rows.filter(F.col(flag) == 1), used, key, y)
    return rows.join(second, key).withColumn("prediction", linear(used)).drop("_e")


def token_windows(df: DataFrame, fields, context, n: int = 12, key="gym_id", ts="ts", tiebreak: str | None = "seq",
                  flag="is_train") -> DataFrame:
    """Rows with ``tokens`` (the previous ``n`` rows' scaled ``fields``, oldest first) and a scaled ``context`` vector.

    Means and deviations come from the train rows alone (a constant field is only centred);
    a missing value is the mean, 0.  Rows with a shorter history are dropped.
    """
    names = list(dict.fromkeys([*fields, *context]))
    fitted = df.filter(F.col(flag) == 1).agg(*[x for c in names for x in (
        F.avg(F.col(c).cast("double")).alias(f"_m_{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"_s_{c}"))])

    def scaled(c):
        spread = F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(1.0)
        return F.coalesce((F.col(c).cast("double") - F.col(f"_m_{c}")) / spread, F.lit(0.0))

    rows = df.crossJoin(F.broadcast(fitted)).select(  # one row of statistics
        *df.columns, F.array(*[scaled(c) for c in fields]).alias("_token"), F.array(*[scaled(c) for c in context]).alias("context"))
    out = series.over_chunks(rows, lambda w: {"tokens": F.collect_list("_token").over(w.rowsBetween(-n, -1))}, n, key, ts, tiebreak)
    return out.filter(F.size("tokens") == n).drop("_token")


def boosted(train: DataFrame, test: DataFrame, groups: dict[str, list[str]] | None = None, numeric=NUMERIC,
            categorical=CATEGORICAL, rounds: int = 240, row_key: str = "seq", **options) -> DataFrame:
    """Test rows with one prediction column (``p_<group>``, at least 0) for each group of numeric features.

    All groups are fitted in one stage by :mod:`boosting`; categories enter as their mean target.
    """
    means = [f"{c}_mean" for c in categorical]
    groups = {g: [*cols, *means] for g, cols in (groups or {"all": list(numeric)}).items()}
    models = boosting.fit(boosting.target_means(train, train, categorical, TARGET), [*numeric, *means], TARGET, groups,
                          rounds=rounds, row_key=row_key, **options)
    rows = boosting.target_means(train, test, categorical, TARGET)
    return rows.withColumns({f"p_{g}": F.greatest(m.column(), F.lit(0.0)) for g, m in models.items()}).drop(*means)


SITES_PER_TASK = 256  # sites that one call of the recursive forecast walks together, in the mean


def recursive_forecast(history: DataFrame, spine: DataFrame, model: boosting.Ensemble, key="gym_id", value=TARGET,
                       tiebreak: str | None = "seq", sites_per_task: int = SITES_PER_TASK) -> DataFrame:
    """Step-wise forecast per site: each prediction enters the history that the next step's lags come from.

    ``spine`` has the future rows with ``is_closed`` and every feature of the model but the
    ``lag_n`` and ``rolling_mean_n`` ones (calendar, holidays, weather, category means; nulls
    are read as train medians).  Closed slots predict 0, and that 0 enters the history.  A
    task walks a bucket of sites step by step, all sites of the bucket at once; of each it
    holds the last observed values, as many as the longest lag, and the horizon.
    """
    lags = {c: int(c.rsplit("_", 1)[1]) for c in model.features if c.startswith("lag_")}
    means = {c: int(c.rsplit("_", 1)[1]) for c in model.features if c.startswith("rolling_mean_")}
    known = [c for c in model.features if c not in lags and c not in means]
    span = max([1, *lags.values(), *means.values()])
    order = [F.col("ts").desc()] + ([F.col(tiebreak).desc()] if tiebreak else [])
    hist = (history.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
            .filter(F.col("_r") <= span).select(key, (-F.col("_r")).alias("_r"), F.col(value).cast("double").alias("_value")))
    fut = spine.select(F.col(key).alias("_key"), "ts", F.col("is_closed").cast("int").alias("_closed"),
                       *[F.col(c).cast("double").alias(c) for c in known])
    sites = history.agg(F.approx_count_distinct(key)).head()[0]
    buckets = max(1, -(-sites // sites_per_task), min(sites, history.sparkSession.sparkContext.defaultParallelism))
    hist = hist.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    fut = fut.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)))

    def walk(past: pd.DataFrame, ahead: pd.DataFrame) -> pd.DataFrame:
        if ahead.empty:
            return pd.DataFrame({key: [], "ts": [], "prediction": []})
        ahead = ahead.assign(_site=pd.factorize(ahead["_key"], use_na_sentinel=False)[0]).sort_values(["_site", "ts"], kind="stable")
        site = ahead["_site"].to_numpy()
        n = site[-1] + 1
        step = ahead.groupby("_site").cumcount().to_numpy()
        names = ahead.drop_duplicates("_site")[["_key", "_site"]]
        past = past.merge(names, left_on=key, right_on="_key").sort_values("_r")
        # the last observed values of each site, right-aligned, and how many there are
        values, size = np.full((n, span), np.nan), np.zeros(n, int)
        values[past["_site"].to_numpy(), past["_r"].to_numpy() + span] = past["_value"].to_numpy(float)
        np.add.at(size, past["_site"].to_numpy(), 1)
        rows = np.full((len(ahead), len(model.features)), np.nan)
        at = {c: i for i, c in enumerate(model.features)}
        for c in known:
            rows[:, at[c]] = ahead[c].to_numpy(float)
        closed, made = ahead["_closed"].to_numpy(), np.zeros(len(ahead))
        turn = np.argsort(step, kind="stable")
        for mine in np.split(turn, np.flatnonzero(np.diff(step[turn])) + 1):  # one row of each site that has the step
            who = site[mine]
            for c, k in lags.items():
                rows[mine, at[c]] = values[who, span - k]
            for c, k in means.items():
                used = np.minimum(size[who], k)
                held = np.arange(span)[None, :] >= span - used[:, None]
                sums = np.where(held, values[who], 0.0).sum(axis=1)
                rows[mine, at[c]] = np.where(used > 0, sums / np.maximum(used, 1), np.nan)
            p = np.where(closed[mine] != 0, 0.0, np.maximum(model.predict(rows[mine]), 0.0))
            made[mine] = p
            values[who] = np.concatenate([values[who, 1:], p[:, None]], axis=1)
            size[who] = np.minimum(size[who] + 1, span)
        return pd.DataFrame({key: ahead["_key"].to_numpy(), "ts": ahead["ts"].to_numpy(), "prediction": made})

    return (hist.groupBy("_bucket").cogroup(fut.groupBy("_bucket"))
            .applyInPandas(walk, f"{key} string, ts timestamp_ntz, prediction double"))
