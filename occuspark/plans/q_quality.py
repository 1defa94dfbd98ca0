"""Queries for data-quality rules run on the library's own outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import quality as Q
from ..operators import series
from .q_series import FEATURE_COLS
from .registry import query
from .q_recommend import PREF_SQL
from .views import sql_open


def _rules_sql(src: str, rules: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {cond}) AS violations, count(*) AS checked_rows FROM {src}"
                              for n, cond in rules)


OBS_COLS = ["seq", "ts", "gym_id", "city", "address", "active_people"]


@query("dq_year_guard", _rules_sql("v_obs", [("year_is_2024", "year(ts) <> 2024")]))
def dq_year_guard(c):
    return Q.rule_counts(c.obs(), [("year_is_2024", F.year("ts") != 2024)])


@query("dq_unique_keys", "SELECT gym_id, ts, count(*) AS n FROM v_obs_raw GROUP BY ALL HAVING count(*) > 1")
def dq_unique_keys(c):
    return Q.duplicate_keys(c.obs_raw(), ["gym_id", "ts"])


@query("dq_key_match", """
SELECT side, count(*) AS n FROM (
  SELECT 'only_left' AS side FROM (SELECT gym_id, ts FROM v_feat EXCEPT ALL SELECT gym_id, ts FROM v_obs_raw)
  UNION ALL SELECT 'only_right' FROM (SELECT gym_id, ts FROM v_obs_raw EXCEPT ALL SELECT gym_id, ts FROM v_feat)) GROUP BY side""")
def dq_key_match(c):
    # Features keep every observation, the hour-truncated raw feed has duplicates: both sides differ.
    d = Q.key_difference(c.feat(), c.obs_raw(), ["gym_id", "ts"])
    return d.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query("set_key_equality", """
SELECT count(*) FILTER (WHERE side = 'only_left') AS only_left, count(*) FILTER (WHERE side = 'only_right') AS only_right FROM (
  SELECT 'only_left' AS side FROM (SELECT gym_id, ts FROM v_feat EXCEPT ALL SELECT gym_id, ts FROM v_obs)
  UNION ALL SELECT 'only_right' FROM (SELECT gym_id, ts FROM v_obs EXCEPT ALL SELECT gym_id, ts FROM v_feat))""")
def set_key_equality(c):
    d = Q.key_difference(c.feat(), c.obs(), ["gym_id", "ts"])
    return d.agg(F.count(F.when(F.col("side") == "only_left", 1)).alias("only_left"),
                 F.count(F.when(F.col("side") == "only_right", 1)).alias("only_right"))


@query("dq_summary_match", """
WITH a AS (SELECT count(*) AS rows, count(DISTINCT gym_id) AS gyms, min(ts) AS min_ts, max(ts) AS max_ts,
             min(active_people) AS min_p, max(active_people) AS max_p FROM v_obs),
b AS (SELECT count(*) AS rows, count(DISTINCT gym_id) AS gyms, min(ts) AS min_ts, max(ts) AS max_ts,
        min(active_people) AS min_p, max(active_people) AS max_p FROM v_feat)
SELECT CAST(a.rows IS NOT DISTINCT FROM b.rows AS INTEGER) AS rows_match, CAST(a.gyms IS NOT DISTINCT FROM b.gyms AS INTEGER) AS gyms_match,
  CAST(a.min_ts IS NOT DISTINCT FROM b.min_ts AND a.max_ts IS NOT DISTINCT FROM b.max_ts AS INTEGER) AS range_match,
  CAST(a.min_p IS NOT DISTINCT FROM b.min_p AND a.max_p IS NOT DISTINCT FROM b.max_p AS INTEGER) AS counts_match FROM a, b""")
def dq_summary_match(c):
    def summ(df):
        return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("gym_id").alias("gyms"), F.min("ts").alias("min_ts"),
                      F.max("ts").alias("max_ts"), F.min("active_people").alias("min_p"), F.max("active_people").alias("max_p"))
    a = summ(c.obs())
    b = summ(c.feat()).select(*[F.col(x).alias(f"b_{x}") for x in ("rows", "gyms", "min_ts", "max_ts", "min_p", "max_p")])
    j = a.crossJoin(b)

    def eq(x):
        return F.col(x).eqNullSafe(F.col(f"b_{x}"))
    return j.select(eq("rows").cast("int").alias("rows_match"), eq("gyms").cast("int").alias("gyms_match"),
                    (eq("min_ts") & eq("max_ts")).cast("int").alias("range_match"),
                    (eq("min_p") & eq("max_p")).cast("int").alias("counts_match"))


LAG_RULES = [("lag_1", "lag_1 IS DISTINCT FROM r1"), ("lag_4", "lag_4 IS DISTINCT FROM r4"),
             ("is_open_estimated", f"is_open_estimated <> {sql_open('ts')}")]


@query("dq_lag_check", "WITH x AS (SELECT *, CAST(lag(active_people, 1) OVER w AS DOUBLE) AS r1, CAST(lag(active_people, 4) OVER w AS DOUBLE) AS r4 "
       "FROM v_feat WINDOW w AS (PARTITION BY gym_id ORDER BY ts, seq)) " + _rules_sql("x", LAG_RULES))
def dq_lag_check(c):
    f = c.feat()
    x = series.over_chunks(f.drop("row_pos", "entity_rows"), lambda w: {
        f"r{n}": F.lag("active_people", n).over(w).cast("double") for n in (1, 4)}, 4, tiebreak="seq")
    return Q.rule_counts(x, [("lag_1", ~F.col("lag_1").eqNullSafe(F.col("r1"))), ("lag_4", ~F.col("lag_4").eqNullSafe(F.col("r4"))),
                             ("is_open_estimated", F.col("is_open_estimated") != cal.business_open("ts"))])


FLAGS = ["is_weekend", "is_open_estimated", "is_public_holiday", "is_gym_closed_holiday", "is_major_low_traffic_holiday",
         "is_major_holiday_window"]


@query("dq_binary_flags", _rules_sql("v_feat", [(f, f"{f} NOT IN (0, 1)") for f in FLAGS]))
def dq_binary_flags(c):
    f = c.feat()
    return Q.rule_counts(f, [(x, ~F.col(x).isin(0, 1)) for x in FLAGS])


@query("dq_closed_nonzero", _rules_sql("v_future", [("closed_nonzero", f"prediction <> 0 AND (is_gym_closed_holiday = 1 OR {sql_open('ts')} = 0)")]))
def dq_closed_nonzero(c):
    f = c.future()
    closed = (F.col("is_gym_closed_holiday") == 1) | (cal.business_open("ts") == 0)
    return Q.rule_counts(f, [("closed_nonzero", (F.col("prediction") != 0) & closed)])


@query("dq_hours_boundary", f"""
SELECT CAST(hour(ts) AS INTEGER) AS hour, isodow(ts) >= 6 AS weekend, count(*) AS rows,
  count(*) FILTER (WHERE is_open_estimated <> {sql_open('ts')}) AS mismatches, max(is_open_estimated) AS open_flag
FROM v_future WHERE hour(ts) IN (6, 7, 8, 9, 17, 18, 21, 22) GROUP BY ALL""")
def dq_hours_boundary(c):
    f = c.future().filter(F.hour("ts").isin(6, 7, 8, 9, 17, 18, 21, 22))
    return f.groupBy(F.hour("ts").alias("hour"), cal.is_weekend("ts").alias("weekend")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("is_open_estimated") != cal.business_open("ts"), 1)).alias("mismatches"),
        F.max("is_open_estimated").alias("open_flag"))


@query("dq_interval_contains", _rules_sql("v_future", [("interval_contains", "NOT (prediction_interval_low <= prediction AND prediction <= prediction_interval_high)"),
                                                       ("low_non_negative", "prediction_interval_low < 0")]))
def dq_interval_contains(c):
    f = c.future()
    return Q.rule_counts(f, [("interval_contains", ~((F.col("prediction_interval_low") <= F.col("prediction"))
                                                      & (F.col("prediction") <= F.col("prediction_interval_high")))),
                             ("low_non_negative", F.col("prediction_interval_low") < 0)])


@query("dq_field_bounds", _rules_sql("v_prefs_full", [
    ("min_hour_range", "preferred_min_hour < 0 OR preferred_min_hour > 23"),
    ("max_hour_range", "preferred_max_hour < 1 OR preferred_max_hour > 24"),
    ("crowd_range", "max_crowd_people < 1 OR max_crowd_people > 300"),
    ("goal_range", "weekly_goal_sessions < 1 OR weekly_goal_sessions > 14"),
    ("rep_range", "preferred_rep_min < 1 OR preferred_rep_max > 30"),
    ("gym_pattern", "NOT regexp_full_match(preferred_gym_id, 'gym_[0-9]{3}')"),
    ("weekdays_length", "length(preferred_weekdays_text) > 20")]))
def dq_field_bounds(c):
    p = c.prefs_full()
    col = F.col
    return Q.rule_counts(p, [
        ("min_hour_range", (col("preferred_min_hour") < 0) | (col("preferred_min_hour") > 23)),
        ("max_hour_range", (col("preferred_max_hour") < 1) | (col("preferred_max_hour") > 24)),
        ("crowd_range", (col("max_crowd_people") < 1) | (col("max_crowd_people") > 300)),
        ("goal_range", (col("weekly_goal_sessions") < 1) | (col("weekly_goal_sessions") > 14)),
        ("rep_range", (col("preferred_rep_min") < 1) | (col("preferred_rep_max") > 30)),
        ("gym_pattern", ~col("preferred_gym_id").rlike("^gym_[0-9]{3}$")),
        ("weekdays_length", F.length("preferred_weekdays_text") > 20)])


@query("dq_preference_rules", """
SELECT user_id, CAST(preferred_min_hour >= preferred_max_hour AS INTEGER) AS bad_hours,
  CAST(len(list_filter(preferred_weekdays, lambda d: d >= 0 AND d <= 6)) = 0 AS INTEGER) AS no_weekday,
  CAST(preferred_rep_min > preferred_rep_max AS INTEGER) AS bad_reps,
  CAST(list_contains(string_split(preferred_weekdays_text, ','), 'x') AS INTEGER) AS invalid_weekday_text FROM v_prefs_full""")
def dq_preference_rules(c):
    p = c.prefs_full()
    return p.select("user_id", (F.col("preferred_min_hour") >= F.col("preferred_max_hour")).cast("int").alias("bad_hours"),
                    (F.size(F.filter("preferred_weekdays", lambda d: (d >= 0) & (d <= 6))) == 0).cast("int").alias("no_weekday"),
                    (F.col("preferred_rep_min") > F.col("preferred_rep_max")).cast("int").alias("bad_reps"),
                    F.array_contains(F.split("preferred_weekdays_text", ","), "x").cast("int").alias("invalid_weekday_text"))


@query("dq_nonempty", """
SELECT 'observations' AS output, count(*) > 0 AS non_empty FROM v_obs UNION ALL SELECT 'features', count(*) > 0 FROM v_feat
UNION ALL SELECT 'future', count(*) > 0 FROM v_future UNION ALL SELECT 'weather', count(*) > 0 FROM v_weather
UNION ALL SELECT 'sets', count(*) > 0 FROM v_sets""")
def dq_nonempty(c):
    parts = [("observations", c.obs()), ("features", c.feat()), ("future", c.future()), ("weather", c.weather()),
             ("sets", c.sets())]
    out = None
    for name, df in parts:
        d = df.agg((F.count(F.lit(1)) > 0).alias("non_empty")).select(F.lit(name).alias("output"), "non_empty")
        out = d if out is None else out.unionByName(d)
    return out


@query("dq_slot_rules", f"""
WITH s AS ({PREF_SQL.replace("SELECT user_id, rank", "SELECT user_id, gym_id, rank", 1)})
SELECT count(*) FILTER (WHERE NOT ({sql_open('s.ts')} = 1)) AS outside_hours,
  count(*) FILTER (WHERE hour(s.ts) + minute(s.ts) / 60.0 < p.preferred_min_hour OR hour(s.ts) + minute(s.ts) / 60.0 >= p.preferred_max_hour) AS outside_window,
  count(*) FILTER (WHERE s.expected_people > p.max_crowd_people) AS over_crowd, count(*) AS slots
FROM s JOIN v_prefs_full p USING (user_id)""")
def dq_slot_rules(c):
    from ..operators import recommend as R
    s = R.preference_slots(c.prefs_full(), c.future(), 5)  # carries the user's window and crowd cap
    fh = cal.fractional_hour("ts")
    return s.agg(F.count(F.when(cal.business_open("ts") != 1, 1)).alias("outside_hours"),
                 F.count(F.when((fh < F.col("preferred_min_hour")) | (fh >= F.col("preferred_max_hour")), 1)).alias("outside_window"),
                 F.count(F.when(F.col("expected_people") > F.col("max_crowd_people"), 1)).alias("over_crowd"),
                 F.count(F.lit(1)).alias("slots"))


@query("dq_required_columns", """
WITH o AS (SELECT count(*) AS n, %s FROM v_obs),
f AS (SELECT count(*) AS n, %s FROM v_feat)
SELECT 'observations' AS output, column_name, n AS rows, filled FROM (UNPIVOT o ON COLUMNS(* EXCLUDE n) INTO NAME column_name VALUE filled)
UNION ALL SELECT 'features', column_name, n, filled FROM (UNPIVOT f ON COLUMNS(* EXCLUDE n) INTO NAME column_name VALUE filled)""" % (
    ", ".join(f"count({x}) AS {x}" for x in OBS_COLS), ", ".join(f"count({x}) AS {x}" for x in FEATURE_COLS)))
def dq_required_columns(c):
    """Rows and filled values of every required column of the observation and feature outputs.

    A column that an output lacks fails the query, as the reference's check does.
    """
    def filled(df, name, cols):
        got = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(x)).alias(x) for x in cols])
        return got.unpivot(["rows"], list(cols), "column_name", "filled").withColumn("output", F.lit(name))
    both = filled(c.obs(), "observations", OBS_COLS).unionByName(filled(c.feat(), "features", FEATURE_COLS))
    return both.select("output", "column_name", "rows", "filled")
