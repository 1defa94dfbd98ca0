"""Queries for slot recommendation and network boards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import recommend as R
from .registry import query
from .views import sql_fh, sql_open, sql_window_label

OPEN_F = f"is_gym_closed_holiday = 0 AND is_open_estimated = 1 AND {sql_open('ts')} = 1"
SLOT_COLS = "rank, ts, window_label, expected_people, score"


def _slots_sql(src: str, part: str, k: str) -> str:
    return f"""
SELECT {part}, {SLOT_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY prediction, ts) AS rank,
         {sql_window_label('ts')} AS window_label, prediction AS expected_people,
         greatest(0.0, 100.0 - prediction) AS score
  FROM (SELECT *, row_number() OVER (PARTITION BY {part}, date_trunc('hour', ts) ORDER BY prediction, ts) AS h
        FROM ({src})) WHERE h = 1) WHERE rank <= {k}"""


def _slots(df, part):
    return df.select(*part, "rank", "ts", "window_label", "expected_people", "score")


@query("rec_slots_backtest", _slots_sql(
    f"""SELECT gym_id, ts, pred_calendar AS prediction FROM (
          SELECT *, row_number() OVER (PARTITION BY gym_id ORDER BY ts DESC) AS rn FROM v_pred)
        WHERE rn <= 240 AND {sql_open('ts')} = 1""", "gym_id", "5"))
def rec_slots_backtest(c):
    p = c.pred().select("gym_id", "ts", F.col("pred_calendar").alias("prediction"))
    return _slots(R.backtest_slots(p, 5, 240), ["gym_id"])


@query("rec_slots_future", _slots_sql(
    f"SELECT gym_id, ts, prediction FROM v_future WHERE {OPEN_F} AND {sql_fh('ts')} >= 8 AND {sql_fh('ts')} < 20",
    "gym_id", "5"))
def rec_slots_future(c):
    return _slots(R.future_slots(c.future(), 5, 8, 20), ["gym_id"])


def _pref_join_sql(weekday_and_crowd: bool) -> str:
    extra = ("AND f.prediction <= p.max_crowd_people AND list_contains(p.preferred_weekdays, isodow(f.ts) - 1)"
             if weekday_and_crowd else "")
    return f"""SELECT p.user_id, f.gym_id, f.ts, f.prediction FROM v_prefs_full p JOIN
      (SELECT * FROM v_future WHERE {OPEN_F}) f ON f.gym_id = p.preferred_gym_id
      AND {sql_fh('f.ts')} >= p.preferred_min_hour AND {sql_fh('f.ts')} < p.preferred_max_hour {extra}"""


PREF_SQL = _slots_sql(_pref_join_sql(True), "user_id", "5")


@query("rec_slots_preference", PREF_SQL.replace("SELECT user_id, rank", "SELECT user_id, gym_id, rank", 1))
def rec_slots_preference(c):
    return _slots(R.preference_slots(c.prefs_full(), c.future(), 5), ["user_id", "gym_id"])


PERSONAL_SQL = f"""
WITH m AS ({_slots_sql(_pref_join_sql(True), "user_id", "5").replace("SELECT user_id, rank", "SELECT user_id, gym_id, rank", 1)}),
fb AS ({_slots_sql(_pref_join_sql(False) + " WHERE p.user_id NOT IN (SELECT user_id FROM m)", "user_id", "5").replace("SELECT user_id, rank", "SELECT user_id, gym_id, rank", 1)})
SELECT *, 'preference' AS source FROM m UNION ALL SELECT *, 'fallback' AS source FROM fb"""


@query("rec_slots_personalised", PERSONAL_SQL)
def rec_slots_personalised(c):
    return R.personalised_slots(c.prefs_full(), c.future(), 5)


@query("rec_campaigns", f"""
SELECT gym_id, city, address, ts, prediction AS expected_people, greatest(0.0, 100.0 - prediction) AS score,
  'off_peak_bonus' AS campaign_type FROM (
  SELECT *, row_number() OVER (PARTITION BY gym_id, date_trunc('hour', ts) ORDER BY prediction, ts) AS h
  FROM v_future WHERE {OPEN_F}) WHERE h = 1 ORDER BY prediction, ts, gym_id LIMIT 12""")
def rec_campaigns(c):
    return R.campaigns(c.future(), 12)


def _plan(c):
    slots = R.personalised_slots(c.prefs_full(), c.future(), 20)
    goal = c.prefs_full().select("user_id", "weekly_goal_sessions")
    slots = slots.join(goal, "user_id").filter(F.col("rank") <= F.greatest(F.lit(1), F.least(F.lit(20), "weekly_goal_sessions")))
    return R.weekly_plan(slots, c.templates())


PLAN_SQL = f"""
WITH m AS ({_slots_sql(_pref_join_sql(True), "user_id", "20").replace("SELECT user_id, rank", "SELECT user_id, gym_id, rank", 1)}),
fb AS ({_slots_sql(_pref_join_sql(False) + " WHERE p.user_id NOT IN (SELECT user_id FROM m)", "user_id", "20").replace("SELECT user_id, rank", "SELECT user_id, gym_id, rank", 1)}),
s AS (SELECT u.* FROM (SELECT * FROM m UNION ALL SELECT * FROM fb) u JOIN v_prefs_full p USING (user_id)
      WHERE u.rank <= greatest(1, least(20, p.weekly_goal_sessions))),
t AS (SELECT user_id, name, estimated_minutes, row_number() OVER (PARTITION BY user_id ORDER BY template_id) - 1 AS ti,
             count(*) OVER (PARTITION BY user_id) AS tn FROM v_templates)
SELECT s.user_id, s.rank AS day_index, s.ts AS scheduled_at, s.window_label, s.expected_people,
  coalesce(t.name, ['Upper Strength', 'Lower Progression', 'Recovery Cardio', 'Full Body Technique'][((s.rank - 1) % 4) + 1]) AS focus,
  coalesce(t.estimated_minutes, 55) AS estimated_minutes
FROM s LEFT JOIN (SELECT DISTINCT user_id, tn FROM t) n USING (user_id)
LEFT JOIN t ON t.user_id = s.user_id AND t.ti = (s.rank - 1) % n.tn"""


@query("rec_weekly_plan", PLAN_SQL)
def rec_weekly_plan(c):
    return _plan(c)


@query("join_cycle", PLAN_SQL)
def join_cycle(c):
    return _plan(c)


@query("rec_schedule_rows", f"""
WITH plan AS ({PLAN_SQL})
SELECT plan.user_id, p.preferred_gym_id AS gym_id, 0 AS template_id, focus AS title, scheduled_at, expected_people,
  'planned' AS status FROM plan JOIN v_prefs_full p USING (user_id)""")
def rec_schedule_rows(c):
    plan = _plan(c).join(c.prefs_full().select("user_id", "preferred_gym_id"), "user_id")
    return plan.select("user_id", F.col("preferred_gym_id").alias("gym_id"), F.lit(0).alias("template_id"),
                       F.col("focus").alias("title"), "scheduled_at", "expected_people",
                       F.lit("planned").alias("status"))


@query("rec_gym_directory", """
SELECT gym_id, arg_max(city, (ts, seq)) AS city, arg_max(address, (ts, seq)) AS address FROM v_obs GROUP BY gym_id""")
def rec_gym_directory(c):
    return R.gym_directory(c.obs())


@query("agg_network_overview", f"""
WITH latest AS (SELECT gym_id, city, address, ts, active_people FROM (
  SELECT *, row_number() OVER (PARTITION BY gym_id ORDER BY ts DESC, seq) AS rn FROM v_obs) WHERE rn = 1),
fut AS (SELECT * FROM v_future WHERE {OPEN_F})
SELECT (SELECT count(*) FROM latest) AS gyms, (SELECT CAST(sum(active_people) AS DOUBLE) FROM latest) AS latest_total_people,
  (SELECT avg(active_people) FROM latest) AS avg_latest_people, (SELECT coalesce(avg(prediction), 0.0) FROM fut) AS future_avg_prediction,
  (SELECT count(*) FROM fut WHERE prediction <= 35) AS low_traffic_slots, (SELECT count(*) FROM v_future) AS forecast_points,
  (SELECT gym_id FROM latest ORDER BY active_people DESC, gym_id LIMIT 1) AS peak_gym_id,
  (SELECT CAST(max(active_people) AS DOUBLE) FROM latest) AS peak_people""")
def agg_network_overview(c):
    from ..operators import series
    latest = series.latest_per_entity(c.obs(), "gym_id", "ts", seq="seq", cols=["active_people"])
    fut = R.open_slots(c.future())
    a = latest.agg(F.count(F.lit(1)).alias("gyms"), F.sum("active_people").cast("double").alias("latest_total_people"),
                   F.avg("active_people").alias("avg_latest_people"),
                   F.min_by("gym_id", F.struct(-F.col("active_people"), F.col("gym_id"))).alias("peak_gym_id"),
                   F.max("active_people").cast("double").alias("peak_people"))
    b = fut.agg(F.coalesce(F.avg("prediction"), F.lit(0.0)).alias("future_avg_prediction"),
                F.count(F.when(F.col("prediction") <= 35, 1)).alias("low_traffic_slots"))
    n = c.future().agg(F.count(F.lit(1)).alias("forecast_points"))
    return a.crossJoin(b).crossJoin(n)


@query("agg_location_board", f"""
WITH o AS (SELECT gym_id, arg_max(city, (ts, seq)) AS city, arg_max(address, (ts, seq)) AS address,
             CAST(arg_max(active_people, (ts, -seq)) AS DOUBLE) AS latest_people, avg(active_people) AS avg_people,
             CAST(max(active_people) AS DOUBLE) AS peak_people FROM v_obs GROUP BY gym_id),
f AS (SELECT gym_id, avg(prediction) AS fa, max(prediction) AS fp, count(*) FILTER (WHERE prediction <= 35) AS cc
      FROM v_future WHERE {OPEN_F} GROUP BY gym_id)
SELECT o.*, coalesce(f.fa, 0.0) AS future_avg_prediction, coalesce(f.fp, 0.0) AS future_peak_prediction,
  coalesce(f.cc, 0) AS campaign_candidate_slots FROM o LEFT JOIN f USING (gym_id)""")
def agg_location_board(c):
    o = c.obs().groupBy("gym_id").agg(
        F.max_by("city", F.struct("ts", "seq")).alias("city"), F.max_by("address", F.struct("ts", "seq")).alias("address"),
        F.max_by("active_people", F.struct(F.col("ts"), -F.col("seq"))).cast("double").alias("latest_people"),
        F.avg("active_people").alias("avg_people"), F.max("active_people").cast("double").alias("peak_people"))
    f = R.open_slots(c.future()).groupBy("gym_id").agg(
        F.avg("prediction").alias("fa"), F.max("prediction").alias("fp"),
        F.count(F.when(F.col("prediction") <= 35, 1)).alias("cc"))
    j = o.join(f, "gym_id", "left")
    return j.select("gym_id", "city", "address", "latest_people", "avg_people", "peak_people",
                    F.coalesce("fa", F.lit(0.0)).alias("future_avg_prediction"),
                    F.coalesce("fp", F.lit(0.0)).alias("future_peak_prediction"),
                    F.coalesce("cc", F.lit(0)).alias("campaign_candidate_slots")) \
        .orderBy(F.col("future_avg_prediction").desc())


@query("agg_network_curve", """
SELECT ts, avg(prediction) AS prediction, avg(prediction_interval_low) AS low, avg(prediction_interval_high) AS high
FROM v_future GROUP BY ts""")
def agg_network_curve(c):
    return c.future().groupBy("ts").agg(F.avg("prediction").alias("prediction"),
                                        F.avg("prediction_interval_low").alias("low"),
                                        F.avg("prediction_interval_high").alias("high"))


@query("agg_weekday_bars", f"""
SELECT d.day_of_week, coalesce(b.m, 0.0) AS expected_people FROM (SELECT unnest(range(0, 7)) AS day_of_week) d
LEFT JOIN (SELECT day_of_week, avg(prediction) AS m FROM v_future WHERE {OPEN_F} GROUP BY ALL) b USING (day_of_week)""")
def agg_weekday_bars(c):
    days = c.spark.range(0, 7).select(F.col("id").alias("day_of_week"))
    b = R.open_slots(c.future()).groupBy("day_of_week").agg(F.avg("prediction").alias("m"))
    return days.join(b, "day_of_week", "left").select("day_of_week", F.coalesce("m", F.lit(0.0)).alias("expected_people"))


@query("agg_hour_bars", f"""
SELECT h.hour, coalesce(b.m, 0.0) AS expected_people, coalesce(b.n, 0) AS slots FROM (SELECT unnest(range(7, 23)) AS hour) h
LEFT JOIN (SELECT hour, avg(prediction) AS m, count(*) AS n FROM v_future WHERE {OPEN_F} GROUP BY ALL) b USING (hour)""")
def agg_hour_bars(c):
    hours = c.spark.range(7, 23).select(F.col("id").alias("hour"))
    b = R.open_slots(c.future()).groupBy("hour").agg(F.avg("prediction").alias("m"), F.count(F.lit(1)).alias("n"))
    return hours.join(b, "hour", "left").select("hour", F.coalesce("m", F.lit(0.0)).alias("expected_people"),
                                                F.coalesce("n", F.lit(0)).alias("slots"))


@query("agg_month_bars", "SELECT month(ts) AS month, avg(active_people) AS avg_people FROM v_obs GROUP BY ALL")
def agg_month_bars(c):
    return c.obs().groupBy(F.month("ts").alias("month")).agg(F.avg("active_people").alias("avg_people"))


@query("agg_offpeak_share", f"""
SELECT least(100, round(count(*) FILTER (WHERE prediction <= 35) * 100.0 /
  (count(*) * (SELECT count(DISTINCT gym_id) FROM v_future)))) AS offpeak_share FROM v_future WHERE {OPEN_F}""")
def agg_offpeak_share(c):
    # Reproduces the dashboard quirk: the denominator multiplies rows by the number of locations.
    f = R.open_slots(c.future())
    n = c.future().agg(F.countDistinct("gym_id").alias("_g"))
    a = f.agg(F.count(F.when(F.col("prediction") <= 35, 1)).alias("_low"), F.count(F.lit(1)).alias("_rows"))
    share = F.least(F.lit(100.0), F.round(F.col("_low") * 100.0 / (F.col("_rows") * F.col("_g"))))
    return a.crossJoin(n).select(share.alias("offpeak_share"))


@query("cal_training_window", f"""
SELECT seq, {sql_window_label('ts')} AS window_label, {sql_window_label('ts', 90, True)} AS slot_label FROM v_obs""")
def cal_training_window(c):
    return c.obs().select("seq", cal.training_window_label("ts").alias("window_label"),
                          cal.training_window_label("ts", 90, strict=True).alias("slot_label"))


@query("cal_fractional_hour", f"SELECT seq, ts FROM v_obs WHERE {sql_fh('ts')} >= 9.5 AND {sql_fh('ts')} < 17.25")
def cal_fractional_hour(c):
    fh = cal.fractional_hour("ts")
    return c.obs().filter((fh >= 9.5) & (fh < 17.25)).select("seq", "ts")
