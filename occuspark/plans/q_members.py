"""Queries for member analytics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import members as M
from ..operators import series
from .registry import query

# Rule parameters for the driver data: exercises are event types, so the core
# lifts, the bench exercise and the explorer target are chosen from them.
CORE = ("click", "view")
BENCH = "purchase"
TARGETS = {"exercise_explorer": 5.0}


@query("mb_preferences", """
SELECT user_id, preferred_min_hour, preferred_max_hour, max_crowd_people, weekly_goal_sessions,
  array_to_string(preferred_weekdays, ',') AS preferred_weekdays, off_peak_bonus_enabled, preferred_gym_id,
  preferred_rep_mode, preferred_rep_min, preferred_rep_max FROM v_prefs_full""")
def mb_preferences(c):
    p = c.prefs_full()
    return p.select("user_id", "preferred_min_hour", "preferred_max_hour", "max_crowd_people", "weekly_goal_sessions",
                    F.array_join("preferred_weekdays", ",").alias("preferred_weekdays"), "off_peak_bonus_enabled",
                    "preferred_gym_id", "preferred_rep_mode", "preferred_rep_min", "preferred_rep_max")


GAMI_SQL = """
WITH days AS (SELECT DISTINCT user_id, CAST(performed_at AS DATE) AS day FROM v_sets),
lat AS (SELECT user_id, max(day) AS latest FROM days GROUP BY user_id),
wk AS (SELECT d.user_id, count(*) FILTER (WHERE d.day >= l.latest - INTERVAL 6 DAY) AS weekly_sessions
       FROM days d JOIN lat l USING (user_id) GROUP BY d.user_id),
isl AS (SELECT user_id, day, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS island FROM days),
st AS (SELECT i.user_id, count(*) AS current_streak_days FROM isl i
       JOIN (SELECT user_id, arg_max(island, day) AS island FROM isl GROUP BY user_id) l USING (user_id, island)
       GROUP BY i.user_id),
bon AS (SELECT s.user_id, count(*) FILTER (WHERE p.off_peak_bonus_enabled = 1
          AND hour(s.performed_at) + minute(s.performed_at) / 60.0 >= p.preferred_min_hour
          AND hour(s.performed_at) + minute(s.performed_at) / 60.0 < p.preferred_max_hour) AS b
        FROM v_sets s JOIN v_prefs_full p USING (user_id) GROUP BY s.user_id)
SELECT p.user_id, p.weekly_goal_sessions, coalesce(wk.weekly_sessions, 0) AS weekly_sessions,
  coalesce(st.current_streak_days, 0) AS current_streak_days,
  least(100.0, coalesce(wk.weekly_sessions, 0) / p.weekly_goal_sessions * 100.0) AS consistency_score,
  coalesce(bon.b, 0) * 10 AS off_peak_bonus_points,
  CASE WHEN least(100.0, coalesce(wk.weekly_sessions, 0) / p.weekly_goal_sessions * 100.0) >= 75
       THEN 'Consistent Builder' ELSE 'Momentum Starter' END AS level
FROM v_prefs_full p LEFT JOIN wk USING (user_id) LEFT JOIN st USING (user_id) LEFT JOIN bon USING (user_id)"""


@query("mb_gamification", GAMI_SQL)
def mb_gamification(c):
    return M.gamification(c.sets(), c.prefs_full())


@query("ts_current_streak", """
WITH days AS (SELECT DISTINCT user_id, CAST(checked_in_at AS DATE) AS day FROM v_visits),
isl AS (SELECT user_id, day, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS island FROM days)
SELECT i.user_id, count(*) AS streak FROM isl i
JOIN (SELECT user_id, arg_max(island, day) AS island FROM isl GROUP BY user_id) l USING (user_id, island) GROUP BY i.user_id""")
def ts_current_streak(c):
    return series.current_streak(c.visits().select("user_id", F.to_date("checked_in_at").alias("day")))


@query("ts_rolling_week", """
WITH days AS (SELECT DISTINCT user_id, CAST(performed_at AS DATE) AS day FROM v_sets)
SELECT user_id, count(*) FILTER (WHERE day >= latest - INTERVAL 6 DAY) AS weekly_sessions
FROM days JOIN (SELECT user_id, max(day) AS latest FROM days GROUP BY user_id) USING (user_id) GROUP BY user_id""")
def ts_rolling_week(c):
    days = c.sets().select("user_id", F.to_date("performed_at").alias("day")).distinct()
    lat = days.groupBy("user_id").agg(F.max("day").alias("latest"))
    return days.join(lat, "user_id").groupBy("user_id").agg(
        F.count(F.when(F.col("day") >= F.date_sub("latest", 6), 1)).alias("weekly_sessions"))


@query("ts_running_total_cross", """
SELECT user_id, min(performed_at) FILTER (WHERE run >= 100000) AS crossed_at FROM (
  SELECT *, sum(weight_kg * reps) OVER (PARTITION BY user_id ORDER BY performed_at, set_id ROWS UNBOUNDED PRECEDING) AS run
  FROM v_sets) GROUP BY user_id""")
def ts_running_total_cross(c):
    s = c.sets().withColumn("volume", F.col("weight_kg") * F.col("reps"))
    return series.running_cross_chunked(s, "user_id", "performed_at", "volume", 100000, tiebreak="set_id")


@query("ts_nth_event", """
SELECT user_id, checked_in_at AS nth_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY checked_in_at, visit_id) AS rn FROM v_visits) WHERE rn = 10""")
def ts_nth_event(c):
    return series.nth_event_chunked(c.visits(), "user_id", "checked_in_at", 10, tiebreak="visit_id")


@query("ts_distinct_cross", """
SELECT user_id, min(ts) FILTER (WHERE seen >= 6) AS crossed_at FROM (
  SELECT user_id, ts, sum(n) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen
  FROM (SELECT user_id, ts, count(*) AS n FROM (
        SELECT user_id, gym_id, min(date_trunc('day', checked_in_at)) AS ts FROM v_visits GROUP BY ALL) GROUP BY ALL))
GROUP BY user_id""")
def ts_distinct_cross(c):
    # Day-truncated check-ins make several gyms appear at the same instant (RANGE ties).
    v = c.visits().withColumn("ts", F.date_trunc("day", "checked_in_at").cast("timestamp_ntz"))
    return series.distinct_cross(v, "user_id", "ts", "gym_id", 6)


@query("ts_running_max", """
SELECT user_id, exercise, day, best, max(best) OVER (PARTITION BY user_id, exercise ORDER BY day
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_pr FROM (
  SELECT user_id, exercise, CAST(performed_at AS DATE) AS day, max(weight_kg) AS best FROM v_sets GROUP BY ALL)""")
def ts_running_max(c):
    d = c.sets().groupBy("user_id", "exercise", F.to_date("performed_at").alias("day")).agg(
        F.max("weight_kg").alias("best"))
    return series.running_max(d, ["user_id", "exercise"], "day", "best", "running_pr")


@query("topk_recent_n", """
SELECT user_id, visit_id, checked_in_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY checked_in_at DESC, visit_id DESC) AS rn FROM v_visits)
WHERE rn <= 5""")
def topk_recent_n(c):
    w = Window.partitionBy("user_id").orderBy(F.col("checked_in_at").desc(), F.col("visit_id").desc())
    return (c.visits().withColumn("_rn", F.row_number().over(w)).filter("_rn <= 5")
            .select("user_id", "visit_id", "checked_in_at"))


@query("mb_offpeak_visits", """
SELECT visit_id, user_id, checked_in_at FROM v_visits
WHERE (hour(checked_in_at) >= 10 AND hour(checked_in_at) < 16) OR active_people_at_checkin <= 45""")
def mb_offpeak_visits(c):
    return c.visits().filter(M.offpeak_visit()).select("visit_id", "user_id", "checked_in_at")


def _nth_sql(src, order, ts, n, name):
    return (f"SELECT user_id, {ts} AS {name} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order})"
            f" AS rn FROM ({src})) WHERE rn = {n}")


ACH_SQL = f"""
WITH s AS (SELECT *, lower(exercise) AS ex, CAST(performed_at AS DATE) AS day FROM v_sets),
days AS (SELECT DISTINCT user_id, day FROM s),
lat AS (SELECT user_id, max(day) AS latest FROM days GROUP BY user_id),
weekly AS (SELECT d.user_id, CAST(count(*) FILTER (WHERE d.day >= l.latest - INTERVAL 6 DAY) AS DOUBLE) AS p1
           FROM days d JOIN lat l USING (user_id) GROUP BY d.user_id),
d4 AS ({_nth_sql("SELECT * FROM days", "day", "day", 4, "d4")}),
u1 AS (SELECT s.user_id, arg_max(performed_at, (performed_at, set_id)) AS u1 FROM s JOIN d4 ON s.user_id = d4.user_id
       AND s.day = d4.d4 GROUP BY s.user_id),
agg AS (SELECT user_id, CAST(count(*) FILTER (WHERE ex IN {CORE}) AS DOUBLE) AS p3, sum(weight_kg * reps) AS p5,
          coalesce(max(weight_kg) FILTER (WHERE ex = '{BENCH}'), 0.0) AS p6,
          min(performed_at) FILTER (WHERE ex = '{BENCH}' AND weight_kg >= 100.0) AS u6,
          CAST(count(DISTINCT exercise) AS DOUBLE) AS p7,
          CAST(count(*) FILTER (WHERE coalesce(modifiers_json, '{{}}') <> '{{}}') AS DOUBLE) AS p8,
          max(performed_at) AS last_set FROM s GROUP BY user_id),
u3 AS ({_nth_sql(f"SELECT * FROM s WHERE ex IN {CORE}", "performed_at, set_id", "performed_at", 20, "u3")}),
u5 AS (SELECT user_id, min(performed_at) FILTER (WHERE run >= 50000.0) AS u5 FROM (
         SELECT *, sum(weight_kg * reps) OVER (PARTITION BY user_id ORDER BY performed_at, set_id ROWS UNBOUNDED PRECEDING) AS run
         FROM s) GROUP BY user_id),
u7 AS (SELECT user_id, min(ts) FILTER (WHERE seen >= 5) AS u7 FROM (
         SELECT user_id, ts, sum(n) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen
         FROM (SELECT user_id, ts, count(*) AS n FROM (SELECT user_id, exercise, min(performed_at) AS ts FROM s GROUP BY ALL)
               GROUP BY ALL)) GROUP BY user_id),
u8 AS ({_nth_sql("SELECT * FROM s WHERE coalesce(modifiers_json, '{}') <> '{}'", "performed_at, set_id", "performed_at", 3, "u8")}),
vv AS (SELECT *, (hour(checked_in_at) >= 10 AND hour(checked_in_at) < 16) OR active_people_at_checkin <= 45 AS off FROM v_visits),
vagg AS (SELECT user_id, CAST(count(*) FILTER (WHERE off) AS DOUBLE) AS p2, CAST(count(*) AS DOUBLE) AS p9,
           max(checked_in_at) AS last_visit FROM vv GROUP BY user_id),
u2 AS ({_nth_sql("SELECT * FROM vv WHERE off", "checked_in_at, visit_id", "checked_in_at", 5, "u2")}),
u9 AS ({_nth_sql("SELECT * FROM vv", "checked_in_at, visit_id", "checked_in_at", 3, "u9")}),
tagg AS (SELECT user_id, CAST(count(*) AS DOUBLE) AS p4 FROM v_templates GROUP BY user_id),
u4 AS ({_nth_sql("SELECT * FROM v_templates", "created_at, template_id", "created_at", 3, "u4")}),
w AS (SELECT * FROM v_users LEFT JOIN weekly USING (user_id) LEFT JOIN u1 USING (user_id) LEFT JOIN agg USING (user_id)
      LEFT JOIN u3 USING (user_id) LEFT JOIN u5 USING (user_id) LEFT JOIN u7 USING (user_id) LEFT JOIN u8 USING (user_id)
      LEFT JOIN vagg USING (user_id) LEFT JOIN u2 USING (user_id) LEFT JOIN u9 USING (user_id)
      LEFT JOIN tagg USING (user_id) LEFT JOIN u4 USING (user_id)),
r AS (
  SELECT user_id, 1 AS id, 'consistency_builder' AS code, coalesce(p1, 0.0) AS p, 4.0 AS t, u1 AS u, greatest(last_set, last_visit) AS la FROM w
  UNION ALL SELECT user_id, 2, 'off_peak_hero', coalesce(p2, 0.0), 5.0, u2, greatest(last_set, last_visit) FROM w
  UNION ALL SELECT user_id, 3, 'strength_master', coalesce(p3, 0.0), 20.0, u3, greatest(last_set, last_visit) FROM w
  UNION ALL SELECT user_id, 4, 'template_operator', coalesce(p4, 0.0), 3.0, u4, greatest(last_set, last_visit) FROM w
  UNION ALL SELECT user_id, 5, 'volume_builder', coalesce(p5, 0.0), 50000.0, u5, greatest(last_set, last_visit) FROM w
  UNION ALL SELECT user_id, 6, 'bench_milestone', coalesce(p6, 0.0), 100.0, u6, greatest(last_set, last_visit) FROM w
  UNION ALL SELECT user_id, 7, 'exercise_explorer', coalesce(p7, 0.0), 5.0, u7, greatest(last_set, last_visit) FROM w
  UNION ALL SELECT user_id, 8, 'set_specialist', coalesce(p8, 0.0), 3.0, u8, greatest(last_set, last_visit) FROM w
  UNION ALL SELECT user_id, 9, 'attendance_base', coalesce(p9, 0.0), 3.0, u9, greatest(last_set, last_visit) FROM w
  UNION ALL SELECT user_id, 10, 'secret_forecast', 0.0, 1.0, NULL, greatest(last_set, last_visit) FROM w)
SELECT user_id, id, code, least(p, t) AS progress, t AS target, CASE WHEN p >= t THEN coalesce(u, la) END AS unlocked_at FROM r"""


def _ach(c):
    return M.achievements(c.users(), c.sets(), c.visits(), c.templates(), core_lifts=CORE, bench=BENCH,
                          targets=TARGETS)


@query("mb_achievements", ACH_SQL)
def mb_achievements(c):
    return _ach(c)


ACTIVITY_SQL = f"""
WITH ach AS ({ACH_SQL}),
rv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY checked_in_at DESC, visit_id DESC) AS rn
       FROM v_visits) WHERE rn <= 100),
v AS (SELECT user_id, count(*) AS visits, count(*) FILTER (WHERE hour(checked_in_at) >= 10 AND hour(checked_in_at) < 16) AS off
      FROM rv GROUP BY user_id),
st AS (SELECT user_id, count(*) AS logged_sets FROM v_sets GROUP BY user_id),
tp AS (SELECT user_id, count(*) AS templates FROM v_templates GROUP BY user_id),
a AS (SELECT user_id, count(unlocked_at) AS achievements_unlocked FROM ach GROUP BY user_id)
SELECT a.user_id, coalesce(v.visits, 0) AS visits, coalesce(st.logged_sets, 0) AS logged_sets,
  coalesce(tp.templates, 0) AS templates, a.achievements_unlocked,
  CASE WHEN coalesce(v.visits, 0) > 0 THEN v.off / v.visits * 100 ELSE 0.0 END AS off_peak_visit_share,
  coalesce(r5.ids, '') AS recent_visits, coalesce(rs.ids, '') AS recent_workouts
FROM a LEFT JOIN v USING (user_id)
LEFT JOIN (SELECT user_id, string_agg(CAST(visit_id AS VARCHAR), ',' ORDER BY rn) AS ids FROM rv WHERE rn <= 5 GROUP BY user_id) r5 USING (user_id)
LEFT JOIN (SELECT user_id, string_agg(CAST(set_id AS VARCHAR), ',' ORDER BY rn) AS ids FROM (SELECT user_id, set_id,
  row_number() OVER (PARTITION BY user_id ORDER BY performed_at DESC, set_id DESC) AS rn FROM v_sets) WHERE rn <= 600 GROUP BY user_id) rs USING (user_id) LEFT JOIN st USING (user_id) LEFT JOIN tp USING (user_id)"""


def _activity(c):
    return M.activity(c.visits(), c.sets(), c.templates(), _ach(c))


@query("mb_activity", ACTIVITY_SQL)
def mb_activity(c):
    return _activity(c)


@query("mb_xp_level", f"""
WITH act AS ({ACTIVITY_SQL}), g AS ({GAMI_SQL}),
x AS (SELECT act.user_id, round(visits * 35 + logged_sets * 12 + templates * 45 + achievements_unlocked * 80
        + g.off_peak_bonus_points) AS xp FROM act JOIN g USING (user_id))
SELECT user_id, xp, greatest(1, floor(xp / 250) + 1) AS level,
  least(100.0, round((xp - (greatest(1, floor(xp / 250) + 1) - 1) * 250) / 250 * 100)) AS level_progress FROM x""")
def mb_xp_level(c):
    a = _activity(c).join(M.gamification(c.sets(), c.prefs_full()).select("user_id", "off_peak_bonus_points"), "user_id")
    xp = F.round(F.col("visits") * 35 + F.col("logged_sets") * 12 + F.col("templates") * 45
                 + F.col("achievements_unlocked") * 80 + F.col("off_peak_bonus_points"))
    lvl = F.greatest(F.lit(1), F.floor(F.col("xp") / 250) + 1)
    return a.select("user_id", xp.alias("xp")).select(
        "user_id", "xp", lvl.alias("level"),
        F.least(F.lit(100.0), F.round((F.col("xp") - (lvl - 1) * 250) / 250 * 100)).alias("level_progress"))


@query("mb_weekly_percent", f"""
WITH g AS ({GAMI_SQL})
SELECT user_id, least(100, round(weekly_sessions / greatest(1, weekly_goal_sessions) * 100)) AS weekly_percent FROM g""")
def mb_weekly_percent(c):
    g = M.gamification(c.sets(), c.prefs_full())
    return g.select("user_id", F.least(F.lit(100.0), F.round(
        F.col("weekly_sessions") / F.greatest(F.lit(1), F.col("weekly_goal_sessions")) * 100)).alias("weekly_percent"))


PROGRESS_SQL = """
SELECT user_id, exercise, count(*) AS sets, max(weight_kg) AS best_weight_kg, sum(weight_kg * reps) AS total_volume_kg,
  max(performed_at) AS last_performed_at FROM v_sets GROUP BY ALL"""


@query("agg_exercise_progress", PROGRESS_SQL)
def agg_exercise_progress(c):
    return M.exercise_progress(c.sets())


@query("mb_progress", f"""
SELECT e.*, t.total_sets, t.tracked_exercises,
  row_number() OVER (PARTITION BY e.user_id ORDER BY e.total_volume_kg DESC, e.exercise) AS volume_rank
FROM ({PROGRESS_SQL}) e JOIN (SELECT user_id, count(*) AS total_sets, count(DISTINCT exercise) AS tracked_exercises
FROM v_sets GROUP BY user_id) t USING (user_id)""")
def mb_progress(c):
    return M.progress(c.sets())


@query("agg_period_progress", """
WITH s AS (SELECT v.*, p.period FROM v_sets v JOIN (SELECT user_id, max(performed_at) AS last FROM v_sets GROUP BY user_id) l
           USING (user_id) CROSS JOIN (VALUES ('month', 31), ('year', 365), ('all', NULL)) p(period, days)
           WHERE p.days IS NULL OR v.performed_at >= l.last - to_days(CAST(p.days AS INTEGER))),
g AS (SELECT period, user_id, exercise, count(*) AS sets, sum(weight_kg * reps) AS total_volume_kg,
        max(weight_kg) AS best_weight_kg FROM s GROUP BY ALL)
SELECT * FROM (SELECT g.*, m.metric, row_number() OVER (PARTITION BY period, user_id, metric ORDER BY
    CASE metric WHEN 'volume' THEN total_volume_kg WHEN 'best' THEN best_weight_kg ELSE sets END DESC, exercise) AS rank
  FROM g CROSS JOIN (VALUES ('sets'), ('volume'), ('best')) m(metric)) WHERE rank <= 8""")
def agg_period_progress(c):
    """The 8 leading exercises per user for each period (31 or 365 days back, all) and metric."""
    return M.period_progress(c.sets())


@query("agg_daily_performance", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grain, user_id ORDER BY bucket DESC) AS recency FROM (
  SELECT grain, user_id, left(strftime(performed_at, '%Y-%m-%d'), size) AS bucket, count(*) AS sets, sum(weight_kg * reps) AS volume,
    max(weight_kg) AS best, count(DISTINCT CAST(performed_at AS DATE)) AS workouts, sum(reps * 3) AS duration
  FROM v_sets CROSS JOIN (VALUES ('day', 10), ('month', 7)) b(grain, size) GROUP BY ALL)) WHERE recency <= 12""")
def agg_daily_performance(c):
    """The last 12 days, and the last 12 months, of each user's training; a set lasts three seconds a repetition."""
    return M.daily_performance(c.sets().withColumn("duration_seconds", F.col("reps") * 3))


@query("agg_workout_days", """
SELECT user_id, CAST(performed_at AS DATE) AS day, count(*) AS sets, sum(weight_kg * reps) AS volume,
  min(performed_at) AS started_at FROM v_sets GROUP BY ALL""")
def agg_workout_days(c):
    return c.sets().groupBy("user_id", F.to_date("performed_at").alias("day")).agg(
        F.count(F.lit(1)).alias("sets"), F.sum(F.col("weight_kg") * F.col("reps")).alias("volume"),
        F.min("performed_at").alias("started_at"))


@query("mb_calendar", """
SELECT user_id, CAST(scheduled_at AS DATE) AS day, count(*) AS workouts,
  string_agg(title || ':' || status, ';' ORDER BY scheduled_at, scheduled_id) AS items
FROM v_scheduled GROUP BY ALL""")
def mb_calendar(c):
    s = c.scheduled()
    g = s.groupBy("user_id", F.to_date("scheduled_at").alias("day")).agg(
        F.count(F.lit(1)).alias("workouts"),
        F.sort_array(F.collect_list(F.struct("scheduled_at", "scheduled_id", "title", "status"))).alias("_items"))
    return g.select("user_id", "day", "workouts", F.array_join(F.transform(
        "_items", lambda x: F.concat(x["title"], F.lit(":"), x["status"])), ";").alias("items"))


@query("mb_chat_sessions", """
SELECT conv_id, count(*) AS messages, string_agg(role, '>' ORDER BY turn) AS roles,
  sum(length(text)) AS chars, CAST(max(CASE WHEN role = 'system' THEN 1 ELSE 0 END) AS INTEGER) AS pinned,
  string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript
FROM conversations GROUP BY conv_id""")
def mb_chat_sessions(c):
    t = c.t("conversations")
    g = t.groupBy("conv_id").agg(F.count(F.lit(1)).alias("messages"),
                                 F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("_r"),
                                 F.sum(F.length("text")).alias("chars"),
                                 F.max(F.when(F.col("role") == "system", 1).otherwise(0)).alias("pinned"))
    return g.select("conv_id", "messages", F.array_join(F.transform("_r", lambda x: x["role"]), ">").alias("roles"),
                    "chars", "pinned", F.array_join(F.transform("_r", lambda x: F.concat(x["role"], F.lit(": "), x["text"])), "\n")
                    .alias("transcript"))
