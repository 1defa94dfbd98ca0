"""Remaining calendar, aggregate, top-k and chunk-building queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import scalars as S
from ..operators import recommend as R
from .registry import query
from .views import HOLIDAYS, sql_distance, sql_multiplier, sql_open, sql_window_label


@query("cal_business_label", "SELECT seq, CASE WHEN isodow(ts) >= 6 THEN '09:00-18:00' ELSE '07:00-22:00' END AS business_hours FROM v_obs")
def cal_business_label(c):
    return c.obs().select("seq", cal.business_label("ts").alias("business_hours"))


@query("cal_holiday_distance", f"SELECT ts, gym_id, {sql_distance('ts', HOLIDAYS.major)} AS days_to_nearest_major_holiday FROM v_future")
def cal_holiday_distance(c):
    return c.future().select("ts", "gym_id", cal.holiday_distance("ts", HOLIDAYS.major).alias("days_to_nearest_major_holiday"))


@query("cal_holiday_window", f"SELECT ts, gym_id, CAST({sql_distance('ts', HOLIDAYS.major)} <= 2 AS INTEGER) AS in_window FROM v_future")
def cal_holiday_window(c):
    return c.future().select("ts", "gym_id", cal.holiday_window("ts", HOLIDAYS.major, 2).alias("in_window"))


@query("cal_holiday_multiplier", f"SELECT seq, {sql_multiplier('ts', HOLIDAYS)} AS holiday_effect_multiplier FROM v_obs")
def cal_holiday_multiplier(c):
    return c.obs().select("seq", cal.holiday_multiplier("ts", HOLIDAYS).alias("holiday_effect_multiplier"))


@query("cal_prediction_slot", f"SELECT ts, gym_id, {sql_window_label('ts', 90, True)} AS slot_label FROM v_future")
def cal_prediction_slot(c):
    return c.future().select("ts", "gym_id", cal.training_window_label("ts", 90, strict=True).alias("slot_label"))


@query("cal_load_band", f"""
SELECT ts, gym_id, CASE WHEN {sql_open('ts')} = 0 THEN 'closed' WHEN prediction >= 85 THEN 'peak' WHEN prediction >= 65 THEN 'busy'
  WHEN prediction >= 45 THEN 'moderate' ELSE 'low' END AS load_band FROM v_future""")
def cal_load_band(c):
    return c.future().select("ts", "gym_id", cal.load_band("prediction", cal.business_open("ts") == 1).alias("load_band"))


NOW = "2024-01-31 00:00:00"


@query("agg_gym_means", f"""
WITH scoped AS (SELECT gym_id, avg(prediction) AS m FROM v_future WHERE gym_id IN (SELECT preferred_gym_id FROM v_prefs_full)
                  AND ts < TIMESTAMP '{NOW}' + INTERVAL 3 DAY GROUP BY gym_id),
board AS (SELECT gym_id, avg(prediction) AS future_avg_prediction FROM v_future
          WHERE is_gym_closed_holiday = 0 AND is_open_estimated = 1 AND {sql_open('ts')} = 1 GROUP BY gym_id)
SELECT b.gym_id, coalesce(s.m, b.future_avg_prediction) AS scoped_avg_prediction FROM board b LEFT JOIN scoped s USING (gym_id)""")
def agg_gym_means(c):
    f = c.future()
    now = F.lit(NOW).cast("timestamp_ntz")
    scope = c.prefs_full().select(F.col("preferred_gym_id").alias("gym_id"))
    scoped = (f.join(scope, "gym_id", "left_semi").filter(F.col("ts") < now + F.expr("INTERVAL 3 DAYS"))
               .groupBy("gym_id").agg(F.avg("prediction").alias("m")))
    board = R.open_slots(f).groupBy("gym_id").agg(F.avg("prediction").alias("future_avg_prediction"))
    return board.join(scoped, "gym_id", "left").select(
        "gym_id", F.coalesce("m", "future_avg_prediction").alias("scoped_avg_prediction"))


@query("agg_workout_volume", """
SELECT user_id, CAST(performed_at AS DATE) AS day, sum(weight_kg * CASE WHEN uni THEN greatest(reps, reps - k % 2) ELSE reps END) AS volume,
  count(*) AS completed_sets FROM (
  SELECT *, CAST(json_extract(modifiers_json, '$.k') AS BIGINT) AS k, CAST(json_extract(modifiers_json, '$.k') AS BIGINT) % 3 = 0 AS uni
  FROM v_sets) WHERE set_index % 4 <> 0 GROUP BY ALL""")
def agg_workout_volume(c):
    # Unilateral sets (k % 3 = 0) log left/right reps and count the larger side; every 4th set is not completed.
    s = c.sets().withColumn("k", F.from_json("modifiers_json", "k BIGINT")["k"]).filter(F.col("set_index") % 4 != 0)
    tracked = F.when(F.col("k") % 3 == 0, F.greatest(F.col("reps"), F.col("reps") - F.col("k") % 2)).otherwise(F.col("reps"))
    return s.groupBy("user_id", F.to_date("performed_at").alias("day")).agg(
        F.sum(F.col("weight_kg") * tracked).alias("volume"), F.count(F.lit(1)).alias("completed_sets"))


@query("topk_quiet_slots", f"""
SELECT gym_id, rank, ts, expected_people FROM (
  SELECT gym_id, ts, prediction AS expected_people, row_number() OVER (PARTITION BY gym_id ORDER BY prediction, ts) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY gym_id, date_trunc('hour', ts) ORDER BY prediction, ts) AS h FROM v_future
    WHERE is_gym_closed_holiday = 0 AND is_open_estimated = 1 AND {sql_open('ts')} = 1) WHERE h = 1) WHERE rank <= 5""")
def topk_quiet_slots(c):
    return R.quiet_slots(R.open_slots(c.future()), ["gym_id"], 5).select("gym_id", "rank", "ts", "expected_people")


@query("topk_best_slot_per_day", f"""
SELECT gym_id, CAST(ts AS DATE) AS day, arg_min(ts, (prediction, ts)) AS best_ts, min(prediction) AS best_prediction
FROM v_future WHERE {sql_open('ts')} = 1 GROUP BY ALL""")
def topk_best_slot_per_day(c):
    f = c.future().filter(cal.business_open("ts") == 1)
    return f.groupBy("gym_id", F.to_date("ts").alias("day")).agg(
        F.min_by("ts", F.struct("prediction", "ts")).alias("best_ts"), F.min("prediction").alias("best_prediction"))


TEMPLATE_ITEMS_SQL = """
items AS (SELECT l.l_orderkey AS template_id, l.l_linenumber AS pos, 'part ' || CAST(l.l_partkey AS VARCHAR) AS exercise,
            CAST(CAST(floor(l.l_quantity) AS BIGINT) % 5 + 1 AS INTEGER) AS sets, CAST(5 + l.l_linenumber AS INTEGER) AS reps,
            floor(l.l_extendedprice / 1000.0) * 2.5 AS target_weight_kg, 90 AS rest_seconds, l.l_partkey, l.l_suppkey, l.l_quantity
          FROM lineitem l)"""


def _items(c):
    li = c.t("lineitem")
    return li.select(F.col("l_orderkey").alias("template_id"), F.col("l_linenumber").alias("pos"),
                     F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("exercise"),
                     (F.floor("l_quantity") % 5 + 1).cast("int").alias("sets"), (F.lit(5) + F.col("l_linenumber")).cast("int").alias("reps"),
                     (F.floor(F.col("l_extendedprice") / 1000.0) * 2.5).alias("target_weight_kg"), F.lit(90).alias("rest_seconds"),
                     "l_partkey", "l_suppkey", "l_quantity")


@query("fn_template_struct", f"""WITH {TEMPLATE_ITEMS_SQL},
j AS (SELECT template_id, to_json(list({{'exercise': exercise, 'sets': sets, 'reps': reps, 'target_weight_kg': target_weight_kg,
        'rest_seconds': rest_seconds}} ORDER BY pos, l_partkey, l_suppkey, l_quantity)) AS exercises_json FROM items GROUP BY template_id),
p AS (SELECT template_id, from_json(exercises_json, '[{{"exercise": "VARCHAR", "sets": "INTEGER", "reps": "INTEGER",
        "target_weight_kg": "DOUBLE", "rest_seconds": "INTEGER"}}]') AS ex FROM j)
SELECT t.template_id, t.name AS display_name, len(p.ex) AS n_exercises, list_sum(list_transform(p.ex, lambda e: e.sets)) AS total_sets,
  p.ex[1].exercise AS first_exercise FROM v_templates t JOIN p USING (template_id)""")
def fn_template_struct(c):
    it = _items(c)
    j = it.groupBy("template_id").agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct(
        "pos", "l_partkey", "l_suppkey", "l_quantity", "exercise", "sets", "reps", "target_weight_kg", "rest_seconds"))),
        lambda x: F.struct(x["exercise"].alias("exercise"), x["sets"].alias("sets"), x["reps"].alias("reps"),
                           x["target_weight_kg"].alias("target_weight_kg"), x["rest_seconds"].alias("rest_seconds")))).alias("exercises_json"))
    schema = "array<struct<exercise:string,sets:int,reps:int,target_weight_kg:double,rest_seconds:int>>"
    p = j.select("template_id", F.from_json("exercises_json", schema).alias("ex"))
    t = c.templates().select("template_id", F.col("name").alias("display_name"))
    return t.join(p, "template_id").select(
        "template_id", "display_name", F.size("ex").alias("n_exercises"),
        F.aggregate("ex", F.lit(0).cast("long"), lambda a, e: a + e["sets"]).alias("total_sets"),
        F.element_at("ex", 1)["exercise"].alias("first_exercise"))


@query("fn_json_lists", """
SELECT item_id, len(arr) AS n_items, arr[1] AS first_item FROM (
  SELECT item_id, CASE WHEN item_id % 9 = 0 THEN [] ELSE from_json('["' || replace(name, ' ', '","') || '"]', '["VARCHAR"]') END AS arr
  FROM v_library)""")
def fn_json_lists(c):
    lib = c.library()
    raw = F.when(F.col("item_id") % 9 == 0, F.lit("not a list")).otherwise(
        F.concat(F.lit('["'), F.replace("name", F.lit(" "), F.lit('","')), F.lit('"]')))
    arr = F.coalesce(F.from_json(raw, "array<string>"), F.array().cast("array<string>"))
    return lib.select("item_id", F.size(arr).alias("n_items"), F.try_element_at(arr, F.lit(1)).alias("first_item"))


def _catalogue_chunks(c):
    lib = c.library()
    text = F.concat(F.col("name"), F.lit(". Muscle group: "), F.col("muscle_group"), F.lit(". Category: "), F.col("category"),
                    F.lit(". Difficulty: "), F.col("difficulty"), F.lit(". Primary muscles: . Secondary muscles: . Instructions:  Cues: . Common mistakes: ."))
    return lib.select(F.concat(F.lit("exercise:"), F.col("slug"), F.lit(":technique")).alias("chunk_id"), F.col("name").alias("title"),
                      F.lit("exercise_library").alias("source_type"), text.alias("text"))


CAT_CHUNK_SQL = """cat AS (SELECT 'exercise:' || slug || ':technique' AS chunk_id, name AS title, 'exercise_library' AS source_type,
  name || '. Muscle group: ' || muscle_group || '. Category: ' || category || '. Difficulty: ' || difficulty
  || '. Primary muscles: . Secondary muscles: . Instructions:  Cues: . Common mistakes: .' AS text FROM v_library)"""


@query("tx_chunks_catalogue", f"WITH {CAT_CHUNK_SQL} SELECT * FROM cat")
def tx_chunks_catalogue(c):
    return _catalogue_chunks(c)


USER_CHUNK_SQL = f"""{TEMPLATE_ITEMS_SQL},
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY performed_at DESC, set_id DESC) AS rn FROM v_sets) WHERE rn <= 20),
hist AS (SELECT 'user:' || CAST(user_id AS VARCHAR) || ':recent_workouts' AS chunk_id, user_id, 'Recent workout history' AS title,
           'workout_history' AS source_type, string_agg(strftime(performed_at, '%Y-%m-%d %H:%M:%S') || ': ' || exercise || ' set '
           || CAST(set_index AS VARCHAR) || ', ' || CAST(weight_kg AS VARCHAR) || ' kg x ' || CAST(reps AS VARCHAR) || ', notes '
           || coalesce(modifiers_json, '') || '.', ' ' ORDER BY rn) AS text
         FROM w GROUP BY user_id),
tp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, template_id DESC) AS rn FROM v_templates) WHERE rn <= 8),
tl AS (SELECT template_id, string_agg(exercise || ': ' || CAST(sets AS VARCHAR) || ' sets x ' || CAST(reps AS VARCHAR) || ' reps at '
         || CAST(target_weight_kg AS VARCHAR) || ' kg, rest ' || CAST(rest_seconds AS VARCHAR) || ' seconds.', ' '
         ORDER BY pos, l_partkey, l_suppkey, l_quantity, exercise, sets, reps, target_weight_kg) AS lines
       FROM items WHERE template_id IN (SELECT template_id FROM tp) GROUP BY template_id),
tmpl AS (SELECT 'user:' || CAST(tp.user_id AS VARCHAR) || ':template:' || CAST(tp.template_id AS VARCHAR) AS chunk_id, tp.user_id, tp.name AS title,
           'workout_template' AS source_type, 'Template ' || tp.name || '. Focus ' || tp.focus || '. Estimated minutes '
           || CAST(tp.estimated_minutes AS VARCHAR) || '. ' || coalesce(tl.lines, '') AS text FROM tp LEFT JOIN tl USING (template_id)),
sc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY scheduled_at, scheduled_id) AS rn FROM v_scheduled) WHERE rn <= 12),
sched AS (SELECT 'user:' || CAST(user_id AS VARCHAR) || ':scheduled_workouts' AS chunk_id, user_id, 'Scheduled workouts' AS title,
            'scheduled_workouts' AS source_type, string_agg(strftime(scheduled_at, '%Y-%m-%d %H:%M:%S') || ': ' || title || ', gym ' || gym_id
            || ', expected people ' || CAST(expected_people AS VARCHAR) || ', status ' || status || ', notes ' || notes || '.', ' ' ORDER BY rn)
            AS text FROM sc GROUP BY user_id),
pref AS (SELECT 'user:' || CAST(user_id AS VARCHAR) || ':preferences' AS chunk_id, user_id, 'Training preferences' AS title,
           'user_preferences' AS source_type, 'Preferred training hours ' || CAST(preferred_min_hour AS VARCHAR) || ':00 to '
           || CAST(preferred_max_hour AS VARCHAR) || ':00. Maximum crowd tolerance ' || CAST(max_crowd_people AS VARCHAR)
           || '. Weekly goal ' || CAST(weekly_goal_sessions AS VARCHAR) || '. Preferred weekdays ' || preferred_weekdays_text
           || '. Off-peak bonus enabled ' || CAST(off_peak_bonus_enabled AS VARCHAR) || '.' AS text FROM v_prefs),
uc AS (SELECT * FROM hist UNION ALL SELECT * FROM tmpl UNION ALL SELECT * FROM sched UNION ALL SELECT * FROM pref)"""


def _user_chunks(c, gym_id: str | None = None):
    """History, template, schedule and preference chunks of every user; ``gym_id`` keeps only the sessions at that gym."""
    s = c.sets()
    w = Window.partitionBy("user_id").orderBy(F.col("performed_at").desc(), F.col("set_id").desc())
    recent = s.withColumn("rn", F.row_number().over(w)).filter("rn <= 20")
    line = F.concat(F.date_format("performed_at", "yyyy-MM-dd HH:mm:ss"), F.lit(": "), F.col("exercise"), F.lit(" set "),
                    F.col("set_index").cast("string"), F.lit(", "), F.col("weight_kg").cast("string"), F.lit(" kg x "),
                    F.col("reps").cast("string"), F.lit(", notes "), F.coalesce("modifiers_json", F.lit("")), F.lit("."))

    def joined(df, key, order_cols, text_col):
        g = df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order_cols, text_col.alias("_t")))).alias("_l"))
        return g.select(key, F.array_join(F.transform("_l", lambda x: x["_t"]), " ").alias("text"))
    hist = joined(recent, "user_id", ["rn"], line).select(
        F.concat(F.lit("user:"), F.col("user_id").cast("string"), F.lit(":recent_workouts")).alias("chunk_id"), "user_id",
        F.lit("Recent workout history").alias("title"), F.lit("workout_history").alias("source_type"), "text")
    tw = Window.partitionBy("user_id").orderBy(F.col("created_at").desc(), F.col("template_id").desc())
    tp = c.templates().withColumn("rn", F.row_number().over(tw)).filter("rn <= 8")
    it = _items(c).join(tp.select("template_id"), "template_id", "left_semi")
    iline = F.concat(F.col("exercise"), F.lit(": "), F.col("sets").cast("string"), F.lit(" sets x "), F.col("reps").cast("string"),
                     F.lit(" reps at "), F.col("target_weight_kg").cast("string"), F.lit(" kg, rest "),
                     F.col("rest_seconds").cast("string"), F.lit(" seconds."))
    tl = joined(it, "template_id", ["pos", "l_partkey", "l_suppkey", "l_quantity", "exercise", "sets", "reps", "target_weight_kg"], iline) \
        .withColumnRenamed("text", "lines")
    tmpl = tp.join(tl, "template_id", "left").select(
        F.concat(F.lit("user:"), F.col("user_id").cast("string"), F.lit(":template:"), F.col("template_id").cast("string")).alias("chunk_id"),
        "user_id", F.col("name").alias("title"), F.lit("workout_template").alias("source_type"),
        F.concat(F.lit("Template "), F.col("name"), F.lit(". Focus "), F.col("focus"), F.lit(". Estimated minutes "),
                 F.col("estimated_minutes").cast("string"), F.lit(". "), F.coalesce("lines", F.lit(""))).alias("text"))
    sw = Window.partitionBy("user_id").orderBy("scheduled_at", "scheduled_id")
    sc = c.scheduled().withColumn("rn", F.row_number().over(sw)).filter("rn <= 12")
    if gym_id is not None:
        sc = sc.filter(F.col("gym_id") == gym_id)
    sline = F.concat(F.date_format("scheduled_at", "yyyy-MM-dd HH:mm:ss"), F.lit(": "), F.col("title"), F.lit(", gym "),
                     F.col("gym_id"), F.lit(", expected people "), F.col("expected_people").cast("string"), F.lit(", status "),
                     F.col("status"), F.lit(", notes "), F.col("notes"), F.lit("."))
    sched = joined(sc, "user_id", ["rn"], sline).select(
        F.concat(F.lit("user:"), F.col("user_id").cast("string"), F.lit(":scheduled_workouts")).alias("chunk_id"), "user_id",
        F.lit("Scheduled workouts").alias("title"), F.lit("scheduled_workouts").alias("source_type"), "text")
    p = c.prefs()
    pref = p.select(F.concat(F.lit("user:"), F.col("user_id").cast("string"), F.lit(":preferences")).alias("chunk_id"), "user_id",
                    F.lit("Training preferences").alias("title"), F.lit("user_preferences").alias("source_type"),
                    F.concat(F.lit("Preferred training hours "), F.col("preferred_min_hour").cast("string"), F.lit(":00 to "),
                             F.col("preferred_max_hour").cast("string"), F.lit(":00. Maximum crowd tolerance "),
                             F.col("max_crowd_people").cast("string"), F.lit(". Weekly goal "),
                             F.col("weekly_goal_sessions").cast("string"), F.lit(". Preferred weekdays "),
                             F.col("preferred_weekdays_text"), F.lit(". Off-peak bonus enabled "),
                             F.col("off_peak_bonus_enabled").cast("string"), F.lit(".")).alias("text"))
    return hist.unionByName(tmpl).unionByName(sched).unionByName(pref)


@query("tx_chunks_user", f"WITH {USER_CHUNK_SQL} SELECT * FROM uc")
def tx_chunks_user(c):
    return _user_chunks(c)


@query("tx_corpus_union", f"""WITH {USER_CHUNK_SQL}, {CAT_CHUNK_SQL}
SELECT chunk_id, CAST(user_id AS VARCHAR) AS scope, title, source_type, length(text) AS text_chars, 0 AS part FROM uc
UNION ALL SELECT chunk_id, 'shared', title, source_type, length(text), 1 FROM cat""")
def tx_corpus_union(c):
    # A user's corpus is the user's own chunks (part 0) followed by the shared catalogue chunks
    # (part 1); the catalogue is stored once with scope 'shared', not copied per user.
    uc = _user_chunks(c).select("chunk_id", F.col("user_id").cast("string").alias("scope"), "title", "source_type",
                                F.length("text").alias("text_chars"), F.lit(0).alias("part"))
    cat = _catalogue_chunks(c).select("chunk_id", F.lit("shared").alias("scope"), "title", "source_type",
                                      F.length("text").alias("text_chars"), F.lit(1).alias("part"))
    return uc.unionByName(cat)
