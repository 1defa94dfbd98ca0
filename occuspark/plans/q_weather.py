"""Queries for weather joins and summaries, context ranges and join patterns of SURVEY 2.3 / 2.5."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import weather as WX
from .registry import query

WCOLS = ", ".join(WX.WEATHER_FEATURES)


@query("join_weather_dedupe", f"SELECT city, timestamp_hour, weather_source, seq, {WCOLS} FROM v_weather_dedup")
def join_weather_dedupe(c):
    return WX.dedupe(c.weather())


@query("src_weather_csv", f"SELECT city, timestamp_hour, {WCOLS} FROM v_weather_dedup")
def src_weather_csv(c):
    # Typed weather rows, one per city-hour (the CSV reader itself is exercised in tests).
    return WX.dedupe(c.weather()).select("city", "timestamp_hour", *WX.WEATHER_FEATURES)


@query("join_weather", f"""
SELECT o.seq, {", ".join(f"w.{x}" for x in WX.WEATHER_FEATURES)} FROM v_obs o
LEFT JOIN v_weather_dedup w ON w.city = o.city AND w.timestamp_hour = date_trunc('hour', o.ts)""")
def join_weather(c):
    return WX.join_weather(c.obs(), c.weather()).select("seq", *WX.WEATHER_FEATURES)


@query("join_weather_coverage", f"""
SELECT count(*) AS rows, count(*) FILTER (WHERE {" AND ".join(f"w.{x} IS NOT NULL" for x in WX.WEATHER_FEATURES)}) AS matched_weather_rows
FROM v_obs o LEFT JOIN v_weather_dedup w ON w.city = o.city AND w.timestamp_hour = date_trunc('hour', o.ts)""")
def join_weather_coverage(c):
    return WX.coverage(WX.join_weather(c.obs(), c.weather()))


HOURLY_SQL = """
h AS (SELECT city, timestamp_hour, avg(temperature_2m) AS temperature_2m, max(weather_code) AS weather_code
      FROM v_weather GROUP BY ALL),
p AS (SELECT city, CAST(timestamp_hour AS DATE) AS day, list(timestamp_hour ORDER BY timestamp_hour) AS time,
        list(temperature_2m ORDER BY timestamp_hour) AS t, list(weather_code ORDER BY timestamp_hour) AS wc FROM h GROUP BY ALL)"""


@query("src_columnar_arrays", f"""
WITH {HOURLY_SQL}
SELECT city, day, unnest(time) AS time, unnest(t) AS temperature_2m,
  unnest(CASE WHEN len(wc) > 1 THEN wc[1:len(wc) - 1] ELSE [] END) AS weather_code FROM p""")
def src_columnar_arrays(c):
    h = c.weather().groupBy("city", "timestamp_hour").agg(F.avg("temperature_2m").alias("temperature_2m"),
                                                          F.max("weather_code").alias("weather_code"))
    p = WX.columnar_payload(h, cols=("temperature_2m", "weather_code"))
    # The code array arrives one element short: its last hour must come back as NULL.
    p = p.withColumn("weather_code", F.slice("weather_code", 1, F.greatest(F.size("weather_code") - 1, F.lit(0))))
    return WX.payload_rows(p, arrays=("time", "temperature_2m", "weather_code"))


@query("agg_weather_summary", """
SELECT count(DISTINCT city) AS cities, count(*) AS rows, min(timestamp_hour) AS min_hour, max(timestamp_hour) AS max_hour,
  (SELECT weather_source FROM v_weather GROUP BY weather_source ORDER BY count(*) DESC, weather_source LIMIT 1) AS mode_source
FROM v_weather""")
def agg_weather_summary(c):
    return WX.summary(c.weather())


@query("agg_context_range", """
SELECT string_agg(DISTINCT city, '|' ORDER BY city) AS cities, min(CAST(ts AS DATE)) AS start_date, max(CAST(ts AS DATE)) AS end_date
FROM v_obs""")
def agg_context_range(c):
    return c.obs().agg(F.array_join(F.sort_array(F.collect_set("city")), "|").alias("cities"),
                       F.min(F.to_date("ts")).alias("start_date"), F.max(F.to_date("ts")).alias("end_date"))


@query("join_semi_scope", """
SELECT f.ts, f.gym_id, f.prediction FROM v_future f WHERE f.gym_id IN (SELECT preferred_gym_id FROM v_prefs_full)""")
def join_semi_scope(c):
    scope = c.prefs_full().select(F.col("preferred_gym_id").alias("gym_id"))
    return c.future().join(scope, "gym_id", "left_semi").select("ts", "gym_id", "prediction")


# Lookup of exercise -> muscle group for the driver's exercises (event types); others map to 'Other'.
MUSCLE_LOOKUP = (("click", "Chest"), ("view", "Back"), ("purchase", "Legs"))


def _lookup(c):
    return c.spark.createDataFrame(list(MUSCLE_LOOKUP), "exercise string, muscle_group string")


LOOKUP_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in MUSCLE_LOOKUP) + ") AS lk(exercise, muscle_group)"


@query("join_muscle_lookup", f"""
SELECT s.set_id, s.exercise, coalesce(lk.muscle_group, 'Other') AS muscle_group FROM v_sets s LEFT JOIN {LOOKUP_SQL}
ON lower(lk.exercise) = lower(s.exercise)""")
def join_muscle_lookup(c):
    lk = F.broadcast(_lookup(c).select(F.lower("exercise").alias("_ex"), "muscle_group"))  # constant table
    s = c.sets().withColumn("_ex", F.lower("exercise")).join(lk, "_ex", "left")
    return s.select("set_id", "exercise", F.coalesce("muscle_group", F.lit("Other")).alias("muscle_group"))


@query("agg_muscle_distribution", f"""
SELECT s.user_id, coalesce(lk.muscle_group, 'Other') AS muscle_group, count(*) AS sets FROM v_sets s LEFT JOIN {LOOKUP_SQL}
ON lower(lk.exercise) = lower(s.exercise) GROUP BY ALL""")
def agg_muscle_distribution(c):
    lk = F.broadcast(_lookup(c).select(F.lower("exercise").alias("_ex"), "muscle_group"))
    s = c.sets().withColumn("_ex", F.lower("exercise")).join(lk, "_ex", "left")
    return s.groupBy("user_id", F.coalesce("muscle_group", F.lit("Other")).alias("muscle_group")).agg(
        F.count(F.lit(1)).alias("sets"))


@query("join_slug_or_name", """
WITH rec AS (SELECT DISTINCT p_name AS record_name, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS rslug FROM part),
by_name AS (SELECT name_key, arg_max(item_id, item_id) AS item_id FROM (
  SELECT item_id, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS name_key FROM v_library) GROUP BY name_key)
SELECT r.record_name, coalesce(s.item_id, n.item_id) AS item_id,
  CASE WHEN s.item_id IS NOT NULL THEN 'slug' WHEN n.item_id IS NOT NULL THEN 'name' ELSE 'none' END AS matched_by
FROM rec r LEFT JOIN v_library s ON s.slug = r.rslug || '-0' LEFT JOIN by_name n ON n.name_key = r.rslug""")
def join_slug_or_name(c):
    from ..functions import scalars as S
    lib = c.library()
    rec = c.t("part").select(F.col("p_name").alias("record_name")).distinct() \
        .withColumn("rslug", S.slug_regex("record_name"))
    by_slug = lib.select(F.col("slug").alias("_s"), F.col("item_id").alias("_si"))
    by_name = lib.groupBy(S.slug_regex("name").alias("_n")).agg(F.max("item_id").alias("_ni"))
    j = (rec.join(by_slug, F.concat(F.col("rslug"), F.lit("-0")) == F.col("_s"), "left")
            .join(by_name, F.col("rslug") == F.col("_n"), "left"))
    return j.select("record_name", F.coalesce("_si", "_ni").alias("item_id"),
                    F.when(F.col("_si").isNotNull(), "slug").when(F.col("_ni").isNotNull(), "name").otherwise("none")
                    .alias("matched_by"))
