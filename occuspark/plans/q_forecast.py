"""Queries for splits, baselines, metrics and the profile forecast."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import aggregates, forecast, joins, series
from .registry import query
from .views import HOLIDAYS

METRIC_SQL = """count(e) AS rows, coalesce(avg(abs(e)), 0.0) AS mae, coalesce(sqrt(avg(e * e)), 0.0) AS rmse,
  CASE WHEN coalesce(sum(CASE WHEN e IS NOT NULL THEN abs(a) END), 0) = 0 THEN 0.0
       ELSE sum(abs(e)) / sum(CASE WHEN e IS NOT NULL THEN abs(a) END) END AS wape"""


@query("ts_split", "SELECT seq, gym_id, ts, is_train FROM v_split")
def ts_split(c):
    return c.split().select("seq", "gym_id", "ts", "is_train")


@query("ts_split3", """
SELECT seq, gym_id, ts, CASE WHEN rn <= a THEN 'train' WHEN rn <= b THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, greatest(a + 1, floor(n * CAST(0.8 AS DOUBLE))) AS b FROM (
  SELECT seq, gym_id, ts, row_number() OVER (PARTITION BY gym_id ORDER BY ts) AS rn,
         greatest(1, floor(count(*) OVER (PARTITION BY gym_id) * CAST(0.7 AS DOUBLE))) AS a,
         count(*) OVER (PARTITION BY gym_id) AS n FROM v_obs))""")
def ts_split3(c):
    return series.split3(c.obs()).select("seq", "gym_id", "ts", "split")


def _pred_sql(col):
    return f"SELECT seq, gym_id, ts, active_people, {col} AS prediction FROM v_pred"


def _pred(c, col):
    return c.pred().select("seq", "gym_id", "ts", "active_people", F.col(col).alias("prediction"))


@query("ml_base_previous", _pred_sql("pred_previous"))
def ml_base_previous(c):
    return _pred(c, "pred_previous")


@query("ml_base_seasonal", _pred_sql("pred_seasonal"))
def ml_base_seasonal(c):
    return _pred(c, "pred_seasonal")


@query("ml_base_rolling", _pred_sql("pred_rolling"))
def ml_base_rolling(c):
    return _pred(c, "pred_rolling")


@query("ml_base_calendar", _pred_sql("pred_calendar"))
def ml_base_calendar(c):
    return _pred(c, "pred_calendar")


@query("join_lookup_fallback", """
SELECT seq, pred_calendar AS prediction,
  CASE WHEN b.gym_id IS NOT NULL THEN 'slot' WHEN g.gym_id IS NOT NULL THEN 'gym' ELSE 'global' END AS level
FROM v_pred p
LEFT JOIN (SELECT DISTINCT gym_id, day_of_week, hour FROM v_split WHERE is_train = 1) b USING (gym_id, day_of_week, hour)
LEFT JOIN (SELECT DISTINCT gym_id FROM v_split WHERE is_train = 1) g USING (gym_id)""")
def join_lookup_fallback(c):
    train = c.split().filter("is_train = 1")
    slots = train.select("gym_id", "day_of_week", "hour").distinct().withColumn("lv", F.lit("slot"))
    gyms = train.select("gym_id").distinct().withColumn("lv", F.lit("gym"))
    one = c.spark.range(1).select(F.lit("global").alias("lv"))
    out = joins.lookup_fallback(c.pred(), [(["gym_id", "day_of_week", "hour"], slots, "lv"),
                                           (["gym_id"], gyms, "lv"), ([], one, "lv")], "level")
    return out.select("seq", F.col("pred_calendar").alias("prediction"), "level")


BOARD_SQL = f"""
SELECT model, {METRIC_SQL} FROM (
  SELECT m.model, p.active_people AS a, p.active_people - CASE m.pcol WHEN 'pred_previous' THEN p.pred_previous
    WHEN 'pred_seasonal' THEN p.pred_seasonal WHEN 'pred_rolling' THEN p.pred_rolling ELSE p.pred_calendar END AS e
  FROM v_pred p CROSS JOIN (VALUES ('pred_previous', 'previous_observation'), ('pred_seasonal', 'seasonal_lag_1d'),
               ('pred_rolling', 'rolling_mean_16'), ('pred_calendar', 'calendar_profile_gym_weekday_hour'))
       AS m(pcol, model))
GROUP BY model"""


@query("ml_baseline_board", BOARD_SQL)
def ml_baseline_board(c):
    return forecast.baseline_board(c.pred())


@query("agg_metrics_multi", BOARD_SQL)
def agg_metrics_multi(c):
    return aggregates.metrics_multi(c.pred(), forecast.BASELINES)


@query("agg_metrics", f"SELECT {METRIC_SQL} FROM (SELECT active_people AS a, active_people - pred_rolling AS e FROM v_pred)")
def agg_metrics(c):
    return aggregates.metrics(c.pred(), pred="pred_rolling")


@query("agg_metrics_clipped", f"""
SELECT {METRIC_SQL} FROM (SELECT active_people AS a, active_people - greatest(pred_calendar - 40.0, 0.0) AS e FROM v_pred)""")
def agg_metrics_clipped(c):
    # A shifted prediction makes the clip at zero bite on the driver data.
    return aggregates.metrics(c.pred().withColumn("p", F.col("pred_calendar") - 40.0), pred="p", clip=True)


@query("agg_error_slices", """
SELECT CASE WHEN grouping(hour) = 0 THEN 'hour' WHEN grouping(day_of_week) = 0 THEN 'day_of_week' ELSE 'gym' END AS slice,
  coalesce(CAST(hour AS VARCHAR), CAST(day_of_week AS VARCHAR), gym_id) AS slice_key, city, address,
  count(*) AS rows, avg(abs(active_people - pred_calendar)) AS mae,
  sqrt(avg((active_people - pred_calendar) * (active_people - pred_calendar))) AS rmse,
  avg(active_people) AS avg_actual, avg(pred_calendar) AS avg_prediction
FROM v_pred GROUP BY GROUPING SETS ((hour), (day_of_week), (gym_id, city, address))""")
def agg_error_slices(c):
    return aggregates.error_slices(c.pred(), pred="pred_calendar")


@query("agg_profile", """
SELECT gym_id, isodow(ts) - 1 AS day_of_week, hour(ts) AS hour, count(*) AS profile_rows,
  avg(active_people) AS profile_mean, coalesce(stddev_samp(active_people), 0.0) AS profile_std
FROM v_obs GROUP BY ALL""")
def agg_profile(c):
    return aggregates.profile(c.feat(), ["gym_id", "day_of_week", "hour"])


@query("agg_profile_coarse", """
SELECT gym_id, hour(ts) AS hour, count(*) AS fallback_rows,
  avg(active_people) AS fallback_mean, coalesce(stddev_samp(active_people), 0.0) AS fallback_std
FROM v_obs GROUP BY ALL""")
def agg_profile_coarse(c):
    return aggregates.profile(c.feat(), ["gym_id", "hour"], prefix="fallback")


@query("agg_residuals", """
SELECT seq, active_people - avg(active_people) OVER (PARTITION BY gym_id, isodow(ts), hour(ts)) AS residual FROM v_obs""")
def agg_residuals(c):
    return aggregates.residuals(c.feat(), ["gym_id", "day_of_week", "hour"]).select("seq", "residual")


@query("agg_calendar_mean", """
SELECT CASE WHEN grouping(day_of_week) = 0 THEN 'slot' WHEN grouping(gym_id) = 0 THEN 'gym' ELSE 'global' END AS level,
  coalesce(gym_id, '*') AS gym_id, coalesce(CAST(day_of_week AS VARCHAR), '*') AS day_of_week,
  coalesce(CAST(hour AS VARCHAR), '*') AS hour, avg(active_people) AS mean, count(*) AS rows
FROM v_split WHERE is_train = 1 GROUP BY GROUPING SETS ((gym_id, day_of_week, hour), (gym_id), ())""")
def agg_calendar_mean(c):
    tr = c.split().filter("is_train = 1")
    g = tr.groupingSets([["gym_id", "day_of_week", "hour"], ["gym_id"], []], "gym_id", "day_of_week", "hour").agg(
        F.avg("active_people").alias("mean"), F.count(F.lit(1)).alias("rows"),
        F.grouping("day_of_week").alias("_gd"), F.grouping("gym_id").alias("_gg"))
    level = F.when(F.col("_gd") == 0, "slot").when(F.col("_gg") == 0, "gym").otherwise("global")
    return g.select(level.alias("level"), F.coalesce("gym_id", F.lit("*")).alias("gym_id"),
                    F.coalesce(F.col("day_of_week").cast("string"), F.lit("*")).alias("day_of_week"),
                    F.coalesce(F.col("hour").cast("string"), F.lit("*")).alias("hour"), "mean", "rows")


@query("agg_p80_error", """
SELECT CASE WHEN grouping(hour) = 1 THEN 'global' WHEN grouping(gym_id) = 1 THEN 'hour' ELSE 'gym_hour' END AS level,
  coalesce(gym_id, '*') AS gym_id, coalesce(CAST(hour AS VARCHAR), '*') AS hour,
  quantile_cont(abs(active_people - pred_calendar), 0.8) AS p80
FROM v_pred GROUP BY GROUPING SETS ((gym_id, hour), (hour), ())""")
def agg_p80_error(c):
    gh, h, g = forecast.uncertainty_lookup(c.pred_errors())
    return (gh.select(F.lit("gym_hour").alias("level"), "gym_id", F.col("hour").cast("string").alias("hour"), "p80")
            .unionByName(h.select(F.lit("hour").alias("level"), F.lit("*").alias("gym_id"),
                                  F.col("hour").cast("string").alias("hour"), "p80"))
            .unionByName(g.select(F.lit("global").alias("level"), F.lit("*").alias("gym_id"),
                                  F.lit("*").alias("hour"), "p80")))


@query("join_uncertainty_fallback", """
SELECT ts, gym_id, uncertainty_abs_error_p80 FROM v_future""")
def join_uncertainty_fallback(c):
    return c.future().select("ts", "gym_id", "uncertainty_abs_error_p80")


@query("join_profile_fallback", """
WITH o AS (SELECT *, isodow(ts) - 1 AS dow, hour(ts) AS h FROM v_obs),
b AS (SELECT gym_id, dow, h, avg(active_people) AS m, coalesce(stddev_samp(active_people), 0.0) AS sd FROM o GROUP BY ALL),
g AS (SELECT gym_id, h, avg(active_people) AS m, coalesce(stddev_samp(active_people), 0.0) AS sd FROM o GROUP BY ALL)
SELECT f.ts, f.gym_id, coalesce(b.m, g.m, a.m) AS profile_mean, coalesce(b.sd, g.sd, 8.0) AS profile_std
FROM v_future f LEFT JOIN b ON b.gym_id = f.gym_id AND b.dow = isodow(f.ts) - 1 AND b.h = hour(f.ts)
LEFT JOIN g ON g.gym_id = f.gym_id AND g.h = hour(f.ts) CROSS JOIN (SELECT avg(active_people) AS m FROM v_obs) a""")
def join_profile_fallback(c):
    """Mean and deviation of every future slot: (site, weekday, hour), else (site, hour), else the global mean and 8.0."""
    rows = forecast.future_rows(c.obs(), HOLIDAYS, interval_minutes=20).select("ts", "gym_id", "day_of_week", "hour")
    return forecast.profile_fallback(c.obs(), rows).select("ts", "gym_id", "profile_mean", "profile_std")


@query("agg_entity_sizes", "SELECT gym_id, count(*) AS rows FROM v_obs GROUP BY gym_id ORDER BY rows DESC, gym_id LIMIT 1")
def agg_entity_sizes(c):
    return aggregates.entity_sizes(c.obs())


@query("agg_dataset_summary", """
SELECT count(*) AS rows, count(DISTINCT gym_id) AS gyms, min(ts) AS min_timestamp, max(ts) AS max_timestamp,
  min(active_people) AS min_active_people, max(active_people) AS max_active_people,
  avg(active_people) AS avg_active_people FROM v_obs""")
def agg_dataset_summary(c):
    return aggregates.dataset_summary(c.obs())


@query("ml_forecast_profile", "SELECT * FROM v_future")
def ml_forecast_profile(c):
    return c.future()


@query("ml_interval_bands", """
SELECT ts, gym_id, prediction, prediction_interval_low, prediction_interval_high,
  CAST(prediction_interval_low <= prediction AND prediction <= prediction_interval_high AS INTEGER) AS contains
FROM v_future""")
def ml_interval_bands(c):
    f = c.future()
    return f.select("ts", "gym_id", "prediction", "prediction_interval_low", "prediction_interval_high",
                    ((F.col("prediction_interval_low") <= F.col("prediction"))
                     & (F.col("prediction") <= F.col("prediction_interval_high"))).cast("int").alias("contains"))


@query("ts_infer_interval", """
SELECT CASE WHEN count(g) = 0 THEN 20 ELSE greatest(5, CAST(round(median(g)) AS INTEGER)) END AS interval_minutes
FROM (SELECT (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY gym_id ORDER BY ts))) / 6e7 AS g FROM v_obs)""")
def ts_infer_interval(c):
    return series.infer_interval(c.obs())


@query("ts_spine", """
SELECT gym_id, unnest(range(s, s + INTERVAL 1 DAY, INTERVAL 20 MINUTE)) AS ts
FROM (SELECT gym_id, date_trunc('hour', max(ts)) + INTERVAL 1 HOUR AS s FROM v_obs GROUP BY gym_id)""")
def ts_spine(c):
    last = c.obs().groupBy("gym_id").agg(
        (cal.hour_floor(F.max("ts")) + F.expr("INTERVAL 1 HOUR")).alias("_s"))
    return series.spine(last, F.col("_s"), F.col("_s") + F.expr("INTERVAL 1 DAY"), 20).select("gym_id", "ts")


@query("ts_forecast_start", """
SELECT gym_id, max(ts) + INTERVAL 20 MINUTE AS start_default,
  CASE WHEN TIMESTAMP '2024-01-20 10:07:00' <= max(ts) + INTERVAL 20 MINUTE THEN max(ts) + INTERVAL 20 MINUTE
       ELSE TIMESTAMP '2024-01-20 10:20:00' END AS start_with_now
FROM v_obs GROUP BY gym_id""")
def ts_forecast_start(c):
    last = F.max("ts")
    now = F.lit("2024-01-20 10:07:33").cast("timestamp_ntz")
    return c.obs().groupBy("gym_id").agg(forecast.forecast_start(last, 20).alias("start_default"),
                                         forecast.forecast_start(last, 20, now).alias("start_with_now"))


@query("ts_latest_per_entity", """
SELECT gym_id, ts, seq, active_people FROM (
  SELECT *, row_number() OVER (PARTITION BY gym_id ORDER BY ts DESC, seq) AS rn FROM v_obs_raw) WHERE rn = 1""")
def ts_latest_per_entity(c):
    # Hour-truncated times create ties; the first-seen row (lowest seq) wins.
    return series.latest_per_entity(c.obs_raw(), "gym_id", "ts", seq="seq", cols=["ts", "seq", "active_people"])


@query("ts_row_budget", """
SELECT gym_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY gym_id ORDER BY ts) AS rn FROM v_future)
WHERE rn <= 2 * 72""")
def ts_row_budget(c):
    return series.row_budget(c.future(), "gym_id", "ts", 2 * 72).select("gym_id", "ts")


@query("ts_seq_lags", """
SELECT seq, gym_id, ts, active_people, """ + ", ".join(
    f"CAST(lag(active_people, {i}) OVER w AS DOUBLE) AS seq_lag_{i}" for i in range(1, 13)) + """
FROM v_obs WINDOW w AS (PARTITION BY gym_id ORDER BY ts) QUALIFY lag(active_people, 12) OVER w IS NOT NULL""")
def ts_seq_lags(c):
    df = series.seq_lags(c.obs().select("seq", "gym_id", "ts", "active_people"))
    return df.withColumns({f"seq_lag_{i}": F.col(f"seq_lag_{i}").cast("double") for i in range(1, 13)})


@query("ts_seq_windows", """
SELECT seq, gym_id, ts, array_to_string(w, ',') AS window, len(w) AS window_len FROM (
  SELECT seq, gym_id, ts, list(active_people) OVER (PARTITION BY gym_id ORDER BY ts
         ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS w FROM v_obs) WHERE len(w) = 12""")
def ts_seq_windows(c):
    df = series.seq_windows(c.obs(), fields=("active_people",))
    vals = F.transform("window", lambda s: s["active_people"].cast("string"))
    return df.select("seq", "gym_id", "ts", F.array_join(vals, ",").alias("window"),
                     F.size("window").alias("window_len"))


@query("ts_entity_id", """
SELECT o.seq, k.entity_id FROM v_obs o JOIN (
  SELECT key, printf('gym_%03d', dense_rank() OVER (ORDER BY key)) AS entity_id
  FROM (SELECT DISTINCT city || '|' || address AS key FROM v_obs)) k ON k.key = o.city || '|' || o.address""")
def ts_entity_id(c):
    return series.entity_id(c.obs().drop("gym_id"), out="entity_id").select("seq", "entity_id")


@query("cal_open_forecast_filter", """
SELECT ts, gym_id, prediction FROM v_future
WHERE is_open_estimated = 1 AND is_gym_closed_holiday = 0 AND
  (CASE WHEN isodow(ts) >= 6 THEN hour(ts) >= 9 AND hour(ts) < 18 ELSE hour(ts) >= 7 AND hour(ts) < 22 END)""")
def cal_open_forecast_filter(c):
    f = c.future()
    return f.filter((F.col("is_open_estimated") == 1) & (F.col("is_gym_closed_holiday") == 0)
                    & (cal.business_open("ts") == 1)).select("ts", "gym_id", "prediction")


NOW = "2024-02-01 08:00:00"


@query("cal_horizon_filter", f"""
SELECT ts, gym_id, prediction FROM v_future
WHERE ts >= TIMESTAMP '{NOW}' AND ts < TIMESTAMP '{NOW}' + INTERVAL (least(greatest(3, 1), 7)) DAY""")
def cal_horizon_filter(c):
    now = F.lit(NOW).cast("timestamp_ntz")
    days = max(1, min(3, 7))
    return c.future().filter((F.col("ts") >= now) & (F.col("ts") < now + F.make_dt_interval(F.lit(days)))) \
        .select("ts", "gym_id", "prediction")


@query("flt_entity_tail", """
SELECT seq, gym_id, ts, active_people FROM (
  SELECT *, row_number() OVER (PARTITION BY gym_id ORDER BY ts DESC) AS rn FROM v_obs) WHERE rn <= 30""")
def flt_entity_tail(c):
    w = Window.partitionBy("gym_id").orderBy(F.col("ts").desc())
    return (c.obs().withColumn("_rn", F.row_number().over(w)).filter("_rn <= 30")
            .select("seq", "gym_id", "ts", "active_people"))
