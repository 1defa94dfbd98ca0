"""Forecast baselines, profile forecasts and uncertainty bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from . import aggregates, joins, series

DEFAULT_UNCERTAINTY = 8.0  # fixed value: fallback p80 error when no history exists
DEFAULT_PROFILE_STD = 8.0  # fixed value: fallback profile std


def calendar_profile_predict(train: DataFrame, test: DataFrame, value="active_people",
                             out="pred_calendar") -> DataFrame:
    """Mean by (gym, weekday, hour) -> mean by gym -> global mean, fitted on ``train``."""
    by_slot = train.groupBy("gym_id", "day_of_week", "hour").agg(F.avg(value).alias("m"))
    by_gym = train.groupBy("gym_id").agg(F.avg(value).alias("m"))
    overall = train.agg(F.avg(value).alias("m"))
    return joins.lookup_fallback(test, [(["gym_id", "day_of_week", "hour"], by_slot, "m"),
                                        (["gym_id"], by_gym, "m"), ([], overall, "m")], out)


BASELINES = {  # fixed values: model name -> prediction column
    "previous_observation": "pred_previous",
    "seasonal_lag_1d": "pred_seasonal",
    "rolling_mean_16": "pred_rolling",
    "calendar_profile_gym_weekday_hour": "pred_calendar",
}


def baseline_predictions(split_df: DataFrame, flag="is_train") -> DataFrame:
    """Holdout rows with the four baseline predictions side by side."""
    train = split_df.filter(F.col(flag) == 1)
    test = split_df.filter(F.col(flag) == 0).withColumns({
        "pred_previous": F.col("lag_1"), "pred_seasonal": F.col("lag_96"),
        "pred_rolling": F.col("rolling_mean_16")})
    return calendar_profile_predict(train, test)


def baseline_board(pred_df: DataFrame) -> DataFrame:
    """All baselines scored on the holdout (no clipping), ordered by MAE."""
    return aggregates.metrics_multi(pred_df, BASELINES).orderBy("mae", "model")


def forecast_start(last_ts: Column, interval_minutes: int, now: Column | None = None) -> Column:
    """``last + interval``; a later ``now`` is rounded up to the interval grid instead."""
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(interval_minutes))
    last_based = last_ts + step
    if now is None:
        return last_based
    cur = F.date_trunc("minute", now).cast("timestamp_ntz")
    rem = F.minute(cur) % interval_minutes
    rounded = F.when(rem == 0, cur).otherwise(
        cur + F.make_dt_interval(F.lit(0), F.lit(0), (F.lit(interval_minutes) - rem)))
    return F.when(cur <= last_based, last_based).otherwise(rounded)


def uncertainty_lookup(errors: DataFrame, abs_err="abs_error", q=0.8):
    """p80 absolute error by (gym, hour), by hour and overall."""
    gh, h, g = aggregates.quantile_levels(errors, abs_err, [["gym_id", "hour"], ["hour"], []], q)
    return gh, h, g


def interval_bands(df: DataFrame, pred="prediction", u="uncertainty_abs_error_p80") -> DataFrame:
    """low = max(0, p - u), high = p + u; the uncertainty is 0 where the prediction is 0."""
    uu = F.when(F.col(pred) == 0, F.lit(0.0)).otherwise(F.col(u))
    return df.withColumn(u, uu).withColumns({
        "prediction_interval_low": F.greatest(F.lit(0.0), F.col(pred) - F.col(u)),
        "prediction_interval_high": F.col(pred) + F.col(u)})


def future_rows(obs: DataFrame, holidays: cal.HolidayCalendar, horizon_days: int = 7,
                interval_minutes: int | None = None) -> DataFrame:
    """Future slots of every site with its place, calendar and holiday features and ``is_closed``.

    Without an interval, the median gap of the observations is used.
    """
    if interval_minutes is None:
        interval_minutes = series.infer_interval(obs).head()[0]  # one number
    meta = series.latest_per_entity(obs, "gym_id", "ts", seq="seq", cols=["city", "address"])
    bounds = obs.agg(F.max("ts").alias("_last")).select(forecast_start(F.col("_last"), interval_minutes).alias("_start"))
    bounds = bounds.withColumn("_end", F.col("_start") + F.make_dt_interval(F.lit(horizon_days)))
    rows = series.spine(meta.crossJoin(F.broadcast(bounds)), F.col("_start"), F.col("_end"), interval_minutes)  # one row
    return (rows.drop("_start", "_end").withColumns({**cal.calendar_columns("ts"), **cal.holiday_columns("ts", holidays),
                                                     "is_open_estimated": cal.business_open("ts")})
            .withColumn("is_closed", (F.col("is_gym_closed_holiday") == 1) | (F.col("is_open_estimated") == 0)))


def forecast_profile(obs: DataFrame, errors: DataFrame, holidays: cal.HolidayCalendar,
                     horizon_days: int = 7, interval_minutes: int = 20,
                     value="active_people", model_name="calendar_profile") -> DataFrame:
    """7-day profile forecast per gym on a 20-minute grid with p80 error bands.

    Prediction: mean by (gym, weekday, hour) -> (gym, hour) -> global mean; 0 on
    closed hours and closed holidays.  Work grows with gyms x horizon only.
    """
    prof = obs.withColumns({"day_of_week": cal.weekday("ts"), "hour": F.hour("ts")})
    meta = series.latest_per_entity(obs, "gym_id", "ts", seq="seq", cols=["city", "address"])
    start_end = obs.agg(F.max("ts").alias("_last")).select(
        forecast_start(F.col("_last"), interval_minutes).alias("_start"))
    start_end = start_end.withColumn("_end", F.col("_start") + F.make_dt_interval(F.lit(horizon_days)))
    grid = series.spine(meta.crossJoin(F.broadcast(start_end)), F.col("_start"), F.col("_end"),
                        interval_minutes).drop("_start", "_end")
    grid = grid.withColumns({"day_of_week": cal.weekday("ts"), "hour": F.hour("ts")})
    by_slot = prof.groupBy("gym_id", "day_of_week", "hour").agg(F.avg(value).alias("m"))
    by_gh = prof.groupBy("gym_id", "hour").agg(F.avg(value).alias("m"))
    overall = prof.agg(F.avg(value).alias("m"))
    pred = joins.lookup_fallback(grid, [(["gym_id", "day_of_week", "hour"], by_slot, "m"),
                                        (["gym_id", "hour"], by_gh, "m"), ([], overall, "m")], "_raw")
    gh, h, g = uncertainty_lookup(errors)
    pred = joins.lookup_fallback(pred, [(["gym_id", "hour"], gh, "p80"), (["hour"], h, "p80"), ([], g, "p80")],
                                 "uncertainty_abs_error_p80", F.lit(DEFAULT_UNCERTAINTY))
    closed = (cal.in_dates("ts", holidays.closed) == 1) | (cal.business_open("ts") == 0)
    pred = pred.withColumn("prediction", F.when(closed, F.lit(0.0)).otherwise(F.greatest(F.col("_raw"), F.lit(0.0))))
    out = interval_bands(pred)
    hol = cal.holiday_columns("ts", holidays)
    return out.select(
        "ts", "gym_id", "city", "address", "prediction", "prediction_interval_low", "prediction_interval_high",
        "uncertainty_abs_error_p80", F.lit(model_name).alias("model"), "day_of_week", "hour",
        cal.is_weekend("ts").cast("int").alias("is_weekend"), cal.business_open("ts").alias("is_open_estimated"),
        cal.business_label("ts").alias("business_hours"),
        *[hol[k].alias(k) for k in ("is_public_holiday", "is_gym_closed_holiday", "is_major_low_traffic_holiday",
                                    "is_major_holiday_window", "holiday_effect_multiplier")])


def profile_fallback(obs: DataFrame, rows: DataFrame, value="active_people") -> DataFrame:
    """``profile_mean, profile_std`` of rows with ``gym_id, day_of_week, hour``, the rows of the site's slot and hour
    behind them (``slot_rows, gh_rows``; null without any)."""
    prof = obs.withColumns({"day_of_week": cal.weekday("ts"), "hour": F.hour("ts")})
    by_slot = aggregates.profile(prof, ["gym_id", "day_of_week", "hour"], value, "slot")
    by_hour = aggregates.profile(prof, ["gym_id", "hour"], value, "gh")
    overall = prof.agg(F.avg(value).alias("mean_all"))
    p = (rows.join(by_slot, ["gym_id", "day_of_week", "hour"], "left").join(by_hour, ["gym_id", "hour"], "left")
         .crossJoin(F.broadcast(overall)))  # one row
    return p.withColumns({"profile_mean": F.coalesce("slot_mean", "gh_mean", "mean_all"),
                          "profile_std": F.coalesce("slot_std", "gh_std", F.lit(DEFAULT_PROFILE_STD))})


SEED = 42  # fixed value: seed of the scenario's draws


def hash32(*parts) -> Column:
    """32 bits of the parts' text, the same on every engine (the first eight digits of its md5)."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def normal_draw(*parts) -> Column:
    """A standard normal number drawn by hash (Box and Muller)."""
    u = [(hash32(F.lit(side), *parts) + 0.5) / 4294967296.0 for side in ("radius", "angle")]
    return F.sqrt(-2.0 * F.log(u[0])) * F.cos(2.0 * F.lit(3.141592653589793) * u[1])


def scenario_projection(obs: DataFrame, holidays: cal.HolidayCalendar, horizon_days: int = 7, interval_minutes: int = 20,
                        seed: int = SEED, value="active_people") -> DataFrame:
    """Projected counts per site and slot: profile x holiday x season x a site's trend, plus residual and noise.

    The profile's mean and deviation fall back from (site, weekday, hour) to (site, hour) and
    to the global mean and 8.0.  Residuals of the observations are numbered inside each
    (site, weekday, hour) and (site, hour); a slot's residual is the one whose number its
    hash picks, found by an equi-join, so reruns agree.  Closed slots are 0.
    """
    prof = obs.withColumns({"day_of_week": cal.weekday("ts"), "hour": F.hour("ts")})
    by_slot = aggregates.profile(prof, ["gym_id", "day_of_week", "hour"], value, "slot")
    res = prof.join(by_slot, ["gym_id", "day_of_week", "hour"]).withColumns({
        "_r": F.col(value) - F.col("slot_mean"), "_slot": F.concat_ws("|", "gym_id", "day_of_week", "hour"),
        "_gh": F.concat_ws("|", "gym_id", "hour")}).select("ts", "seq", "_r", "_slot", "_gh")

    def drawn(key: str, out: str) -> DataFrame:
        placed = series.chunked_row_index(res, key, "ts", "seq", out="_i")
        return placed.select(key, F.col("_i").alias(f"{out}_i"), F.col("_r").alias(out))

    start = obs.agg(forecast_start(F.max("ts"), interval_minutes).alias("_s"))
    grid = obs.select("gym_id").distinct().crossJoin(F.broadcast(start))  # one row
    grid = series.spine(grid, F.col("_s"), F.col("_s") + F.make_dt_interval(F.lit(horizon_days)), interval_minutes)
    minutes = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("_s").cast("timestamp"))
    steps = horizon_days * 24 * 60 // interval_minutes + (1 if horizon_days * 24 * 60 % interval_minutes else 0)
    grid = grid.withColumns({"step": minutes / F.lit(60_000_000 * interval_minutes), "day_of_week": cal.weekday("ts"),
                             "hour": F.hour("ts"), "_at": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
                             "_slot": F.concat_ws("|", "gym_id", cal.weekday("ts"), F.hour("ts")),
                             "_gh": F.concat_ws("|", "gym_id", F.hour("ts"))}).drop("_s")
    p = profile_fallback(obs, grid, value)
    pick = hash32(F.lit("residual"), F.col("gym_id"), F.col("_at"), F.lit(str(seed)))
    p = p.withColumns({"near_i": F.pmod(pick, F.col("slot_rows")), "far_i": F.when(F.col("slot_rows").isNull(), F.pmod(pick, F.col("gh_rows")))})
    p = p.join(drawn("_slot", "near"), ["_slot", "near_i"], "left").join(drawn("_gh", "far"), ["_gh", "far_i"], "left")
    mean, std = F.col("profile_mean"), F.col("profile_std")
    trend = 0.004 * normal_draw(F.lit("trend"), F.col("gym_id"), F.lit(str(seed)))
    noise = normal_draw(F.lit("noise"), F.col("gym_id"), F.col("_at"), F.lit(str(seed))) * F.greatest(F.lit(1.5), std * 0.18)
    v = (mean * cal.holiday_multiplier("ts", holidays) * cal.season_factor("ts") * (1 + trend * (F.col("step") / steps))
         + F.coalesce("near", "far", F.lit(0.0)) * 0.35 + noise)
    count = F.bround(F.least(F.greatest(v, F.lit(0.0)), F.lit(260.0)), 0).cast("long")
    closed = (cal.in_dates("ts", holidays.closed) == 1) | (cal.business_open("ts") == 0)
    return p.select("gym_id", "ts", F.when(closed, F.lit(0)).otherwise(count).alias("active_people"))
