"""Fixture views over the driver tables (FIXTURES.md part B).

``Ctx`` builds each view as a DataFrame with the library's operators;
``VIEW_SQL`` holds the same view in DuckDB SQL for the oracles.  The two
definitions are kept side by side so they cannot drift apart unnoticed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import forecast, members, series
from ..sources.tables import load_table

USERS_PER_GYM = 8  # members of one site: the number of sites grows with the data
HOLIDAYS = cal.DEMO_HOLIDAYS
CHUNK_ROWS = 50_000  # rows per window chunk of one series (halo overhead 96 / 50k = 0.2 %)


# ---------------------------------------------------------------- SQL helpers
def _dates_sql(dates) -> str:
    return ", ".join(f"DATE '{d.isoformat()}'" for d in dates)


def sql_in_dates(expr: str, dates) -> str:
    if not dates:
        return "0"
    return f"CAST(CAST({expr} AS DATE) IN ({_dates_sql(dates)}) AS INTEGER)"


def sql_distance(expr: str, dates) -> str:
    if not dates:
        return str(cal.DEFAULT_HOLIDAY_DISTANCE)
    parts = [f"abs(date_diff('day', CAST({expr} AS DATE), DATE '{d.isoformat()}'))" for d in dates]
    return f"least({', '.join(parts)})"


def sql_multiplier(expr: str, c: cal.HolidayCalendar) -> str:
    return (f"CASE WHEN {sql_in_dates(expr, c.closed)} = 1 THEN {cal.MULT_CLOSED} "
            f"WHEN {sql_in_dates(expr, c.special)} = 1 THEN {cal.MULT_SPECIAL} "
            f"WHEN {sql_in_dates(expr, c.public)} = 1 THEN {cal.MULT_PUBLIC} "
            f"WHEN {sql_distance(expr, c.major)} <= {cal.MAJOR_WINDOW_DAYS} THEN {cal.MULT_WINDOW} "
            f"ELSE {cal.MULT_DEFAULT} END")


def sql_dow(expr: str) -> str:
    return f"(isodow({expr}) - 1)"


def sql_open(expr: str) -> str:
    return (f"CASE WHEN isodow({expr}) >= 6 THEN CAST(hour({expr}) >= {cal.WEEKEND_OPEN_HOUR} AND hour({expr}) < "
            f"{cal.WEEKEND_CLOSE_HOUR} AS INTEGER) ELSE CAST(hour({expr}) >= {cal.WEEKDAY_OPEN_HOUR} AND "
            f"hour({expr}) < {cal.WEEKDAY_CLOSE_HOUR} AS INTEGER) END")


def sql_holiday_cols(expr: str, c: cal.HolidayCalendar = HOLIDAYS) -> str:
    return ",\n  ".join([
        f"{sql_in_dates(expr, c.public)} AS is_public_holiday",
        f"{sql_in_dates(expr, c.closed)} AS is_gym_closed_holiday",
        f"{sql_in_dates(expr, c.major)} AS is_major_low_traffic_holiday",
        f"CAST({sql_distance(expr, c.major)} <= {cal.MAJOR_WINDOW_DAYS} AS INTEGER) AS is_major_holiday_window",
        f"{sql_distance(expr, c.major)} AS days_to_nearest_major_holiday",
        f"{sql_multiplier(expr, c)} AS holiday_effect_multiplier",
    ])


def sql_calendar_cols(expr: str) -> str:
    return ",\n  ".join([
        f"hour({expr}) AS hour", f"{sql_dow(expr)} AS day_of_week",
        f"CAST(isodow({expr}) >= 6 AS INTEGER) AS is_weekend", f"month({expr}) AS month",
        f"day({expr}) AS day_of_month", f"weekofyear({expr}) AS week_of_year",
    ])


def gym_number(member: str):
    return F.floor(F.col(member) / USERS_PER_GYM)


def gym_name(member: str):
    """``gym_`` and at least three digits, as ``lpad`` gives for the numbers that occur."""
    return F.format_string("gym_%03d", gym_number(member) + 1)


# ------------------------------------------------------------------ SQL views
VIEW_SQL: dict[str, str] = {}

VIEW_SQL["v_obs"] = f"""
SELECT e.event_id AS seq, e.ts AS ts,
       printf('gym_%03d', e.user_id // {USERS_PER_GYM} + 1) AS gym_id,
       n.n_name AS city, 'site_' || CAST(e.user_id // {USERS_PER_GYM} AS VARCHAR) AS address,
       CAST(floor(e.value) AS INTEGER) AS active_people
FROM events e JOIN nation n ON n.n_nationkey = (e.user_id // {USERS_PER_GYM}) % 4
"""

VIEW_SQL["v_obs_raw"] = """
SELECT seq, date_trunc('hour', ts) AS ts, gym_id, city, address, active_people FROM v_obs
"""

VIEW_SQL["v_feat"] = f"""
SELECT seq, ts, gym_id, city, address, active_people,
  {sql_calendar_cols('ts')},
  {sql_open('ts')} AS is_open_estimated,
  {sql_holiday_cols('ts')},
  CAST(lag(active_people, 1) OVER (PARTITION BY gym_id ORDER BY ts) AS DOUBLE) AS lag_1,
  CAST(lag(active_people, 4) OVER (PARTITION BY gym_id ORDER BY ts) AS DOUBLE) AS lag_4,
  CAST(lag(active_people, 96) OVER (PARTITION BY gym_id ORDER BY ts) AS DOUBLE) AS lag_96,
  avg(active_people) OVER (PARTITION BY gym_id ORDER BY ts ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS rolling_mean_4,
  avg(active_people) OVER (PARTITION BY gym_id ORDER BY ts ROWS BETWEEN 16 PRECEDING AND 1 PRECEDING) AS rolling_mean_16,
  avg(active_people) OVER (PARTITION BY gym_id ORDER BY ts ROWS BETWEEN 96 PRECEDING AND 1 PRECEDING) AS rolling_mean_96
FROM v_obs
"""

VIEW_SQL["v_split"] = """
SELECT *, CAST(row_number() OVER (PARTITION BY gym_id ORDER BY ts)
              <= greatest(1, floor(count(*) OVER (PARTITION BY gym_id) * CAST(0.8 AS DOUBLE))) AS INTEGER) AS is_train
FROM v_feat
"""


VIEW_SQL["v_pred"] = """
SELECT t.*, t.lag_1 AS pred_previous, t.lag_96 AS pred_seasonal, t.rolling_mean_16 AS pred_rolling,
       coalesce(b.m, g.m, a.m) AS pred_calendar
FROM (SELECT * FROM v_split WHERE is_train = 0) t
LEFT JOIN (SELECT gym_id, day_of_week, hour, avg(active_people) AS m FROM v_split WHERE is_train = 1
           GROUP BY gym_id, day_of_week, hour) b USING (gym_id, day_of_week, hour)
LEFT JOIN (SELECT gym_id, avg(active_people) AS m FROM v_split WHERE is_train = 1 GROUP BY gym_id) g USING (gym_id)
CROSS JOIN (SELECT avg(active_people) AS m FROM v_split WHERE is_train = 1) a
"""

VIEW_SQL["v_future"] = f"""
SELECT ts, gym_id, city, address, prediction,
       greatest(0.0, prediction - u) AS prediction_interval_low, prediction + u AS prediction_interval_high,
       u AS uncertainty_abs_error_p80, 'calendar_profile' AS model, day_of_week, hour,
       CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend, {sql_open('ts')} AS is_open_estimated,
       CASE WHEN isodow(ts) >= 6 THEN '09:00-18:00' ELSE '07:00-22:00' END AS business_hours,
       {sql_in_dates('ts', HOLIDAYS.public)} AS is_public_holiday,
       {sql_in_dates('ts', HOLIDAYS.closed)} AS is_gym_closed_holiday,
       {sql_in_dates('ts', HOLIDAYS.major)} AS is_major_low_traffic_holiday,
       CAST({sql_distance('ts', HOLIDAYS.major)} <= 2 AS INTEGER) AS is_major_holiday_window,
       {sql_multiplier('ts', HOLIDAYS)} AS holiday_effect_multiplier
FROM (
  SELECT p.*, CASE WHEN prediction = 0 THEN 0.0 ELSE coalesce(ugh.p80, uh.p80, ug.p80, 8.0) END AS u
  FROM (
    SELECT s.*, CASE WHEN {sql_in_dates('s.ts', HOLIDAYS.closed)} = 1 OR {sql_open('s.ts')} = 0 THEN 0.0
                     ELSE greatest(coalesce(b.m, gh.m, a.m), 0.0) END AS prediction
    FROM (
      SELECT gym_id, city, address, ts, isodow(ts) - 1 AS day_of_week, hour(ts) AS hour FROM (
        SELECT m.gym_id, m.city, m.address,
               unnest(range(st.start, st.start + INTERVAL 7 DAY, INTERVAL 20 MINUTE)) AS ts
        FROM (SELECT gym_id, city, address FROM (
                SELECT *, row_number() OVER (PARTITION BY gym_id ORDER BY ts DESC, seq) AS rn FROM v_obs)
              WHERE rn = 1) m
        CROSS JOIN (SELECT max(ts) + INTERVAL 20 MINUTE AS start FROM v_obs) st)) s
    LEFT JOIN (SELECT gym_id, isodow(ts) - 1 AS day_of_week, hour(ts) AS hour, avg(active_people) AS m
               FROM v_obs GROUP BY ALL) b USING (gym_id, day_of_week, hour)
    LEFT JOIN (SELECT gym_id, hour(ts) AS hour, avg(active_people) AS m FROM v_obs GROUP BY ALL) gh
      USING (gym_id, hour)
    CROSS JOIN (SELECT avg(active_people) AS m FROM v_obs) a) p
  LEFT JOIN (SELECT gym_id, hour, quantile_cont(abs(active_people - pred_calendar), 0.8) AS p80
             FROM v_pred GROUP BY ALL) ugh USING (gym_id, hour)
  LEFT JOIN (SELECT hour, quantile_cont(abs(active_people - pred_calendar), 0.8) AS p80
             FROM v_pred GROUP BY ALL) uh USING (hour)
  CROSS JOIN (SELECT quantile_cont(abs(active_people - pred_calendar), 0.8) AS p80 FROM v_pred) ug)
"""


VIEW_SQL["v_sets"] = """
SELECT event_id AS set_id, user_id, event_type AS exercise,
       floor(value / 2.5) * 2.5 AS weight_kg, CAST(5 + event_id % 9 AS INTEGER) AS reps, ts AS performed_at,
       row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS set_index,
       props AS modifiers_json
FROM events
"""

VIEW_SQL["v_visits"] = f"""
SELECT event_id AS visit_id, user_id,
       printf('gym_%03d', user_id // {USERS_PER_GYM} + 1) AS gym_id,
       ts AS checked_in_at, value AS active_people_at_checkin
FROM events WHERE event_type IN ('view', 'click')
"""

VIEW_SQL["v_templates"] = """
SELECT o_orderkey AS template_id, o_custkey AS user_id, 'Template ' || CAST(o_orderkey AS VARCHAR) AS name,
       o_orderpriority AS focus, CAST(30 + o_orderkey % 60 AS INTEGER) AS estimated_minutes, o_orderdate AS created_at
FROM orders
"""

VIEW_SQL["v_prefs"] = f"""
SELECT c_custkey AS user_id, CAST(7 + c_custkey % 5 AS INTEGER) AS preferred_min_hour,
       CAST(15 + c_custkey % 6 AS INTEGER) AS preferred_max_hour, CAST(30 + c_custkey * 5 AS DOUBLE) AS max_crowd_people,
       CAST(2 + c_custkey % 4 AS INTEGER) AS weekly_goal_sessions,
       CAST(c_custkey % 7 AS VARCHAR) || ',' || CAST((c_custkey + 2) % 7 AS VARCHAR) || ',' ||
         CAST((c_custkey + 4) % 7 AS VARCHAR) || CASE WHEN c_custkey = 3 THEN ',x' ELSE '' END AS preferred_weekdays_text,
       CAST(CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END AS INTEGER) AS off_peak_bonus_enabled,
       printf('gym_%03d', c_custkey // {USERS_PER_GYM} + 1) AS preferred_gym_id,
       CASE c_custkey % 3 WHEN 0 THEN 'auto' WHEN 1 THEN 'custom' ELSE 'pr' END AS preferred_rep_mode,
       CAST(6 + c_custkey % 4 AS INTEGER) AS preferred_rep_min, CAST(10 + c_custkey % 3 AS INTEGER) AS preferred_rep_max
FROM customer WHERE c_custkey % 10 < 8
"""

VIEW_SQL["v_users"] = """
SELECT DISTINCT user_id FROM v_sets
"""

VIEW_SQL["v_prefs_full"] = """
SELECT user_id, coalesce(preferred_min_hour, 9) AS preferred_min_hour, coalesce(preferred_max_hour, 17) AS preferred_max_hour,
       coalesce(max_crowd_people, 45.0) AS max_crowd_people, coalesce(weekly_goal_sessions, 3) AS weekly_goal_sessions,
       coalesce(preferred_weekdays_text, '0,2,4') AS preferred_weekdays_text,
       coalesce(off_peak_bonus_enabled, 1) AS off_peak_bonus_enabled, coalesce(preferred_gym_id, 'gym_008') AS preferred_gym_id,
       coalesce(preferred_rep_mode, 'auto') AS preferred_rep_mode, coalesce(preferred_rep_min, 8) AS preferred_rep_min,
       coalesce(preferred_rep_max, 10) AS preferred_rep_max,
       CASE WHEN len(list_filter(string_split(coalesce(preferred_weekdays_text, '0,2,4'), ','), lambda x: regexp_full_match(x, '\\s*[+-]?[0-9]+\\s*'))) = 0
            THEN [0, 2, 4]
            ELSE list_transform(list_filter(string_split(coalesce(preferred_weekdays_text, '0,2,4'), ','),
                                            lambda x: regexp_full_match(x, '\\s*[+-]?[0-9]+\\s*')), lambda x: CAST(trim(x) AS INTEGER)) END
         AS preferred_weekdays
FROM v_users LEFT JOIN v_prefs USING (user_id)
"""


VIEW_SQL["v_scheduled"] = f"""
SELECT o_orderkey AS scheduled_id, o_custkey AS user_id,
       printf('gym_%03d', o_custkey // {USERS_PER_GYM} + 1) AS gym_id,
       'Session ' || CAST(o_orderkey AS VARCHAR) AS title, o_orderdate AS scheduled_at,
       CASE o_orderstatus WHEN 'O' THEN 'planned' WHEN 'F' THEN 'completed' ELSE 'skipped' END AS status,
       o_totalprice / 1000.0 AS expected_people, lower(o_orderpriority) AS notes
FROM orders
"""

VIEW_SQL["v_library"] = """
SELECT p_partkey AS item_id,
       trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') || '-' || CAST(p_partkey AS VARCHAR) AS slug,
       p_name AS name, p_brand AS muscle_group, p_type AS category,
       ['Beginner', 'Intermediate', 'Advanced'][p_size % 3 + 1] AS difficulty,
       CASE WHEN p_size % 7 = 0 THEN 'wger' WHEN p_size % 5 = 0 THEN 'local seed' ELSE 'import' END AS source_name,
       CAST(p_size % 2 AS INTEGER) AS has_anatomy,
       CASE WHEN p_size % 11 = 0 THEN lpad(CAST(p_partkey AS VARCHAR), 11, 'y') ELSE '' END AS youtube_video_id,
       CASE WHEN p_size % 4 = 0 THEN 'https://www.youtube.com/results?search_query=' || replace(p_name, ' ', '+') ELSE '' END AS video_url
FROM part
"""

VIEW_SQL["v_media"] = """
SELECT l_partkey AS item_id, l_orderkey AS order_key, l_linenumber AS sort_order,
       CASE l_returnflag WHEN 'A' THEN 'external_video' WHEN 'N' THEN 'external_image' ELSE 'gif' END AS media_type,
       CASE WHEN l_linenumber = 1 THEN 'https://www.youtube.com/watch?v=' || lpad(CAST(l_orderkey AS VARCHAR), 11, '0')
            ELSE 'https://media.example.org/' || CAST(l_partkey AS VARCHAR) || '/' || CAST(l_orderkey AS VARCHAR) || '-'
                 || CAST(l_linenumber AS VARCHAR) || CASE l_returnflag WHEN 'A' THEN '.mp4' WHEN 'N' THEN '.jpg' ELSE '.gif' END
       END AS media_url,
       CASE WHEN l_suppkey % 3 = 0 THEN 'generated reference' ELSE 'supplier ' || CAST(l_suppkey AS VARCHAR) END AS source_name,
       CAST(l_discount < CAST(0.08 AS DOUBLE) AS INTEGER) AS embed_allowed
FROM lineitem
"""

VIEW_SQL["v_weather"] = """
SELECT n.n_name AS city, date_trunc('hour', e.ts) AS timestamp_hour, e.event_type AS weather_source, e.event_id AS seq,
       e.value AS temperature_2m, e.value - 2.0 AS apparent_temperature, e.value / 100.0 AS precipitation,
       e.value / 200.0 AS rain, CASE WHEN e.value < 5 THEN NULL ELSE e.value / 300.0 END AS snowfall,
       CAST(CAST(floor(e.value) AS INTEGER) % 4 AS DOUBLE) AS weather_code, e.value % 100 AS cloud_cover, e.value / 10.0 AS wind_speed_10m
FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 4
"""

VIEW_SQL["v_weather_dedup"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city, timestamp_hour
  ORDER BY weather_source DESC, seq DESC) AS rn FROM v_weather) WHERE rn = 1
"""

def sql_window_label(expr: str, minutes: int = 90, strict: bool = False) -> str:
    lo, hi = ("<", "<") if strict else ("<=", "<=")
    start = (f"(CASE WHEN minute({expr}) {lo} 15 THEN date_trunc('hour', {expr}) "
             f"WHEN minute({expr}) {hi} 45 THEN date_trunc('hour', {expr}) + INTERVAL 30 MINUTE "
             f"ELSE date_trunc('hour', {expr}) + INTERVAL 1 HOUR END)")
    names = "['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']"
    return (f"({names}[isodow({start})] || ' ' || strftime({start}, '%H:%M') || '-' || "
            f"strftime({start} + INTERVAL {minutes} MINUTE, '%H:%M'))")


def sql_fh(expr: str) -> str:
    return f"(hour({expr}) + minute({expr}) / 60.0)"


# --------------------------------------------------------------- Spark views
class Ctx:
    """Per-query access to driver tables and fixture views (lazily built)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def materialize(self, df: DataFrame) -> DataFrame:
        """Cut lineage for a frame that several model fits read: ``checkpoint()`` writes it to the
        shared ``spark.checkpoint.dir`` (survives executor loss; never a machine-local cache)."""
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(self.spark)
        return df.checkpoint(eager=True)

    def t(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = load_table(self.spark, self.sf_dir, name)
        return self._cache[name]

    def _memo(self, key, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    # v_obs: one gym per eight users; the 25-row nation dimension is broadcast.
    def obs(self) -> DataFrame:
        def build():
            e = self.t("events")
            g = gym_number("user_id")
            nation = F.broadcast(self.t("nation").select("n_nationkey", "n_name"))
            return (e.select(F.col("event_id").alias("seq"), "ts", g.alias("_g"), gym_name("user_id").alias("gym_id"),
                             F.floor("value").cast("int").alias("active_people"))
                     .join(nation, (F.col("_g") % 4) == F.col("n_nationkey"))
                     .select("seq", "ts", "gym_id",
                             F.col("n_name").alias("city"),
                             F.concat(F.lit("site_"), F.col("_g").cast("string")).alias("address"),
                             "active_people"))
        return self._memo("obs", build)

    def obs_raw(self) -> DataFrame:
        return self.obs().withColumn("ts", cal.hour_floor("ts"))

    def feat(self) -> DataFrame:
        return self._memo("feat", lambda: series.feature_table_chunked(self.obs(), HOLIDAYS, chunk_rows=CHUNK_ROWS,
                                                                        keep_position=True))

    def split(self) -> DataFrame:
        # Chronological 80/20 per gym from the positions the feature table already computed.
        cut = F.greatest(F.lit(1), F.floor(F.col("entity_rows") * F.lit(0.8)))
        return self._memo("split", lambda: self.feat().withColumn("is_train", (F.col("row_pos") < cut).cast("int")))

    def pred(self) -> DataFrame:
        return self._memo("pred", lambda: forecast.baseline_predictions(self.split()))

    def split_light(self) -> DataFrame:
        """Observations with calendar keys and the 80/20 flag only (no lag/rolling windows):
        enough for the calendar-profile errors the forecast bands need."""
        def build():
            idx = series.chunked_row_index(self.obs(), "gym_id", "ts", "seq", total="_n")
            cut = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(0.8)))
            return idx.select("seq", "ts", "gym_id", "active_people", cal.weekday("ts").alias("day_of_week"),
                              F.hour("ts").alias("hour"), (F.col("_i") < cut).cast("int").alias("is_train"))
        return self._memo("split_light", build)

    def pred_errors(self) -> DataFrame:
        s = self.split_light()
        p = forecast.calendar_profile_predict(s.filter("is_train = 1"), s.filter("is_train = 0"))
        return p.withColumn("abs_error", F.abs(F.col("active_people") - F.col("pred_calendar")))

    def future(self) -> DataFrame:
        # The forecast is a product table (gyms x horizon rows, independent of history length):
        # it is materialised once so every consumer reads it instead of re-planning its lineage.
        return self._memo("future", lambda: self.materialize(
            forecast.forecast_profile(self.obs(), self.pred_errors(), HOLIDAYS)))

    # v_sets: workout sets derived from events (exercise = event type).
    def sets(self) -> DataFrame:
        def build():
            e = self.t("events")
            u = F.col("user_id")
            w = Window.partitionBy(u, F.to_date("ts"), "event_type").orderBy("ts", "event_id")
            return e.select(F.col("event_id").alias("set_id"), u.alias("user_id"),
                            F.col("event_type").alias("exercise"),
                            (F.floor(F.col("value") / 2.5) * 2.5).alias("weight_kg"),
                            (F.lit(5) + F.col("event_id") % 9).cast("int").alias("reps"),
                            F.col("ts").alias("performed_at"), F.row_number().over(w).alias("set_index"),
                            F.col("props").alias("modifiers_json"))
        return self._memo("sets", build)

    def visits(self) -> DataFrame:
        e = self.t("events").filter(F.col("event_type").isin("view", "click"))
        return e.select(F.col("event_id").alias("visit_id"), "user_id",
                        gym_name("user_id").alias("gym_id"),
                        F.col("ts").alias("checked_in_at"), F.col("value").alias("active_people_at_checkin"))

    def templates(self) -> DataFrame:
        o = self.t("orders")
        return o.select(F.col("o_orderkey").alias("template_id"), F.col("o_custkey").alias("user_id"),
                        F.concat(F.lit("Template "), F.col("o_orderkey").cast("string")).alias("name"),
                        F.col("o_orderpriority").alias("focus"),
                        (F.lit(30) + F.col("o_orderkey") % 60).cast("int").alias("estimated_minutes"),
                        F.col("o_orderdate").alias("created_at"))

    def prefs(self) -> DataFrame:
        c = self.t("customer").filter(F.col("c_custkey") % 10 < 8)  # a fifth have no preferences: the defaults apply
        k = F.col("c_custkey")
        wd = F.concat_ws(",", (k % 7).cast("string"), ((k + 2) % 7).cast("string"), ((k + 4) % 7).cast("string"))
        return c.select(k.alias("user_id"), (7 + k % 5).cast("int").alias("preferred_min_hour"),
                        (15 + k % 6).cast("int").alias("preferred_max_hour"),
                        (30 + k * 5).cast("double").alias("max_crowd_people"),
                        (2 + k % 4).cast("int").alias("weekly_goal_sessions"),
                        F.concat(wd, F.when(k == 3, F.lit(",x")).otherwise(F.lit(""))).alias("preferred_weekdays_text"),
                        F.when(k % 3 == 0, 0).otherwise(1).cast("int").alias("off_peak_bonus_enabled"),
                        gym_name("c_custkey").alias("preferred_gym_id"),
                        F.element_at(F.array(F.lit("auto"), F.lit("custom"), F.lit("pr")), (k % 3 + 1).cast("int"))
                         .alias("preferred_rep_mode"),
                        (6 + k % 4).cast("int").alias("preferred_rep_min"),
                        (10 + k % 3).cast("int").alias("preferred_rep_max"))

    def users(self) -> DataFrame:
        return self.sets().select("user_id").distinct()

    def prefs_full(self) -> DataFrame:
        return self._memo("prefs_full", lambda: members.preferences(self.users(), self.prefs()))

    def scheduled(self) -> DataFrame:
        o = self.t("orders")
        st = F.col("o_orderstatus")
        return o.select(F.col("o_orderkey").alias("scheduled_id"), F.col("o_custkey").alias("user_id"),
                        gym_name("o_custkey").alias("gym_id"),
                        F.concat(F.lit("Session "), F.col("o_orderkey").cast("string")).alias("title"),
                        F.col("o_orderdate").alias("scheduled_at"),
                        F.when(st == "O", "planned").when(st == "F", "completed").otherwise("skipped").alias("status"),
                        (F.col("o_totalprice") / 1000.0).alias("expected_people"), F.lower("o_orderpriority").alias("notes"))

    def library(self) -> DataFrame:
        p = self.t("part")
        base = F.regexp_replace(F.regexp_replace(F.lower("p_name"), "[^a-z0-9]+", "-"), "^-+|-+$", "")
        size = F.col("p_size")
        return p.select(
            F.col("p_partkey").alias("item_id"), F.concat(base, F.lit("-"), F.col("p_partkey").cast("string")).alias("slug"),
            F.col("p_name").alias("name"), F.col("p_brand").alias("muscle_group"), F.col("p_type").alias("category"),
            F.element_at(F.array(F.lit("Beginner"), F.lit("Intermediate"), F.lit("Advanced")), (size % 3 + 1).cast("int"))
             .alias("difficulty"),
            F.when(size % 7 == 0, "wger").when(size % 5 == 0, "local seed").otherwise("import").alias("source_name"),
            (size % 2).cast("int").alias("has_anatomy"),
            F.when(size % 11 == 0, F.lpad(F.col("p_partkey").cast("string"), 11, "y")).otherwise("").alias("youtube_video_id"),
            F.when(size % 4 == 0, F.concat(F.lit("https://www.youtube.com/results?search_query="),
                                           F.replace(F.col("p_name"), F.lit(" "), F.lit("+")))).otherwise("").alias("video_url"))

    def media(self) -> DataFrame:
        li = self.t("lineitem")
        ln, ok, pk, fl = F.col("l_linenumber"), F.col("l_orderkey"), F.col("l_partkey"), F.col("l_returnflag")
        ext = F.when(fl == "A", ".mp4").when(fl == "N", ".jpg").otherwise(".gif")
        url = F.when(ln == 1, F.concat(F.lit("https://www.youtube.com/watch?v="), F.lpad(ok.cast("string"), 11, "0"))) \
               .otherwise(F.concat(F.lit("https://media.example.org/"), pk.cast("string"), F.lit("/"), ok.cast("string"),
                                   F.lit("-"), ln.cast("string"), ext))
        return li.select(
            pk.alias("item_id"), ok.alias("order_key"), ln.alias("sort_order"),
            F.when(fl == "A", "external_video").when(fl == "N", "external_image").otherwise("gif").alias("media_type"),
            url.alias("media_url"),
            F.when(F.col("l_suppkey") % 3 == 0, "generated reference")
             .otherwise(F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string"))).alias("source_name"),
            (F.col("l_discount") < 0.08).cast("int").alias("embed_allowed"))

    # v_weather: hourly weather rows per city with several sources.
    def weather(self) -> DataFrame:
        e = self.t("events")
        nation = F.broadcast(self.t("nation").select("n_nationkey", "n_name"))
        v = F.col("value")
        return (e.join(nation, (F.col("user_id") % 4) == F.col("n_nationkey"))
                 .select(F.col("n_name").alias("city"), cal.hour_floor("ts").alias("timestamp_hour"),
                         F.col("event_type").alias("weather_source"), F.col("event_id").alias("seq"),
                         v.alias("temperature_2m"), (v - 2.0).alias("apparent_temperature"),
                         (v / 100.0).alias("precipitation"), (v / 200.0).alias("rain"),
                         F.when(v < 5, F.lit(None)).otherwise(v / 300.0).alias("snowfall"),
                         (F.floor(v).cast("int") % 4).cast("double").alias("weather_code"), (v % 100).alias("cloud_cover"),
                         (v / 10.0).alias("wind_speed_10m")))
