"""Queries for the scalar functions of SURVEY 2.8 (string, date, JSON, number) on driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from .registry import query

PYSP = "[\\t\\n\\x0b\\x0c\\r \\x1c-\\x1f\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def sql_pystrip(x: str) -> str:
    return f"regexp_replace({x}, '^{PYSP}+|{PYSP}+$', '', 'g')"


def sql_strip_html(x: str) -> str:
    s = f"replace(regexp_replace({x}, '<[^>]+>', chr(10), 'g'), chr(8203), '')"
    for ent, ch in S.HTML_ENTITIES:
        ch_sql = ch.replace("'", "''")
        s = f"replace({s}, '{ent}', '{ch_sql}')"
    return s


@query("fn_strip_html", f"SELECT page_id, {sql_strip_html('html')} AS text FROM pages")
def fn_strip_html(c):
    return c.t("pages").select("page_id", S.strip_html("html").alias("text"))


STEPS_SQL = f"""
WITH t0 AS (SELECT page_id, regexp_replace({sql_pystrip(f"regexp_replace(replace({sql_strip_html('html')}, chr(13), chr(10)), '\\n+', chr(10), 'g')")},
              '(?i)Notes\\s*\\(Instructions?\\)\\s*:\\s*', '', 'g') AS t FROM pages),
num AS (SELECT page_id, list_filter(list_transform(regexp_split_to_array(t, '(?:^|\\n)\\s*\\d+\\.\\s*'),
          lambda s: regexp_replace(s, '^[ \\-\\t\\n]+|[ \\-\\t\\n]+$', '', 'g')), lambda s: s <> '') AS steps FROM t0),
ls AS (SELECT page_id, list_filter(list_transform(string_split(t, chr(10)), lambda s: regexp_replace(s, '^[ \\-\\t]+|[ \\-\\t]+$', '', 'g')),
          lambda s: s <> '') AS lines FROM t0),
li AS (SELECT page_id, unnest(lines) AS l, generate_subscripts(lines, 1) AS i FROM ls),
isl AS (SELECT *, sum(CASE WHEN i = 1 OR regexp_matches(l, '^[A-Z0-9]') THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) AS g FROM li),
mg AS (SELECT page_id, g, CASE WHEN count(*) = 1 THEN min(l) ELSE {sql_pystrip("string_agg(l, ' ' ORDER BY i)")} END AS step
       FROM isl GROUP BY page_id, g),
merged AS (SELECT page_id, list(step ORDER BY g) AS steps FROM mg GROUP BY page_id)
SELECT n.page_id, CASE WHEN len(n.steps) >= 2 THEN len(n.steps) ELSE coalesce(len(m.steps), 0) END AS n_steps,
  CASE WHEN len(n.steps) >= 2 THEN array_to_string(n.steps, ' | ') ELSE coalesce(array_to_string(m.steps, ' | '), '') END AS steps
FROM num n LEFT JOIN merged m USING (page_id)"""


@query("fn_instruction_steps", STEPS_SQL)
def fn_instruction_steps(c):
    st = S.instruction_steps(F.col("html"))
    return c.t("pages").select("page_id", F.size(st).alias("n_steps"), F.array_join(st, " | ").alias("steps"))


@query("fn_clean_step", f"""
SELECT conv_id, turn, {sql_pystrip(f"regexp_replace(replace(regexp_replace({sql_pystrip('text')}, '(?i)^Step:?\\s*\\d+\\s*', ''), chr(8203), ' '), '{PYSP}+', ' ', 'g')")} AS step
FROM (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'Step ' || CAST(turn AS VARCHAR) || ' ' || text ELSE text END AS text FROM conversations)""")
def fn_clean_step(c):
    t = c.t("conversations")
    x = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("Step "), F.col("turn").cast("string"), F.lit(" "), F.col("text"))) \
         .otherwise(F.col("text"))
    return t.select("conv_id", "turn", S.clean_step(x).alias("step"))


@query("fn_label_maps", """
SELECT item_id,
  CASE lower(c) WHEN 'strength' THEN 'Hypertrophy' WHEN 'cardio' THEN 'Conditioning' WHEN 'plyometrics' THEN 'Conditioning'
    WHEN 'stretching' THEN 'Mobility' WHEN 'powerlifting' THEN 'Strength'
    ELSE upper(lower(CASE WHEN lower(c) = '' THEN 'Uncategorized' ELSE lower(c) END)[1])
         || lower(CASE WHEN lower(c) = '' THEN 'Uncategorized' ELSE lower(c) END)[2:] END AS category_label,
  CASE lower(d) WHEN 'beginner' THEN 'Beginner' WHEN 'intermediate' THEN 'Intermediate' WHEN 'expert' THEN 'Advanced'
    ELSE 'Unverified' END AS difficulty_label
FROM (SELECT item_id, ['strength', 'cardio', 'stretching', 'powerlifting', 'plyometrics', ''][item_id % 7 + 1] AS c0,
        ['beginner', 'intermediate', 'expert', 'unknown'][item_id % 4 + 1] AS d, category AS cat FROM v_library)
CROSS JOIN LATERAL (SELECT coalesce(c0, lower(cat)) AS c)""")
def fn_label_maps(c):
    lib = c.library()
    cats = F.array(*[F.lit(x) for x in ("strength", "cardio", "stretching", "powerlifting", "plyometrics", "")])
    diffs = F.array(*[F.lit(x) for x in ("beginner", "intermediate", "expert", "unknown")])
    cat = F.coalesce(F.try_element_at(cats, (F.col("item_id") % 7 + 1).cast("int")), F.lower("category"))
    diff = F.element_at(diffs, (F.col("item_id") % 4 + 1).cast("int"))
    return lib.select("item_id", S.category_label(cat).alias("category_label"),
                      S.difficulty_label(diff).alias("difficulty_label"))


# Rule lists for the driver catalogue (terms that occur in part names / types).
GROUP_RULES_A = [(("ring", "bolt"), "Chest"), (("gear",), "Back"), (("widget", "economy"), "Legs"), (("small",), "Arms")]
GROUP_RULES_B = [(("promo",), "Core"), (("gizmo", "large"), "Shoulders"), (("hot",), "Conditioning")]


def _sql_rules(expr, rules, default="Unknown"):
    parts = " ".join(f"WHEN {' OR '.join(f'contains({expr}, {chr(39)}{n}{chr(39)})' for n in needles)} THEN '{g}'"
                     for needles, g in rules)
    return f"CASE {parts} ELSE '{default}' END"


@query("fn_rule_group", f"""
SELECT item_id, {_sql_rules("lower(name || ' ' || category)", GROUP_RULES_A)} AS group_a,
  {_sql_rules("lower(category || ' ' || name)", GROUP_RULES_B)} AS group_b FROM v_library""")
def fn_rule_group(c):
    lib = c.library()
    return lib.select("item_id", S.rule_group(F.concat_ws(" ", "name", "category"), GROUP_RULES_A).alias("group_a"),
                      S.rule_group(F.concat_ws(" ", "category", "name"), GROUP_RULES_B).alias("group_b"))


@query("fn_license_text", """
SELECT item_id, CASE WHEN s <> '' AND u <> '' THEN s || ' - ' || u WHEN s <> '' THEN s ELSE 'fallback license' END AS license
FROM (SELECT item_id, trim(CASE WHEN item_id % 3 = 0 THEN '' ELSE muscle_group END) AS s,
        trim(CASE WHEN item_id % 2 = 0 THEN 'https://licenses.example.org/' || category ELSE '' END) AS u FROM v_library)""")
def fn_license_text(c):
    lib = c.library()
    short = F.when(F.col("item_id") % 3 == 0, F.lit("")).otherwise(F.col("muscle_group"))
    url = F.when(F.col("item_id") % 2 == 0, F.concat(F.lit("https://licenses.example.org/"), F.col("category"))).otherwise("")
    return lib.select("item_id", S.license_text(short, url, F.lit("fallback license")).alias("license"))


@query("fn_first_text", """
SELECT item_id, coalesce(nullif(trim(CASE WHEN item_id % 2 = 0 THEN '  ' ELSE youtube_video_id END), ''),
  nullif(trim(video_url), ''), nullif(trim(name), ''), '') AS first_text FROM v_library""")
def fn_first_text(c):
    lib = c.library()
    a = F.when(F.col("item_id") % 2 == 0, F.lit("  ")).otherwise(F.col("youtube_video_id"))
    return lib.select("item_id", S.first_text(a, F.col("video_url"), F.col("name")).alias("first_text"))


@query("fn_dedupe_ids", """
SELECT item_id, array_to_string(p, ',') AS primary_ids, array_to_string(list_filter(s, lambda x: NOT list_contains(p, x)), ',') AS secondary_ids
FROM (SELECT item_id,
  list_filter(p0, lambda x, i: list_position(p0, x) = i) AS p, list_filter(s0, lambda x, i: list_position(s0, x) = i) AS s
  FROM (SELECT item_id,
    list_filter(list_transform(string_split(name || ', ,' || name || ',' || muscle_group, ','), lambda x: trim(x)), lambda x: x <> '') AS p0,
    list_filter(list_transform(string_split(category || ',' || name || ', ' || category, ','), lambda x: trim(x)), lambda x: x <> '') AS s0
    FROM v_library))""")
def fn_dedupe_ids(c):
    lib = c.library()
    p = S.dedupe_ids(F.split(F.concat_ws(",", F.concat(F.col("name"), F.lit(", ")), F.col("name"), F.col("muscle_group")), ","))
    s = S.dedupe_ids(F.split(F.concat(F.col("category"), F.lit(","), F.col("name"), F.lit(", "), F.col("category")), ","))
    return lib.select("item_id", F.array_join(p, ",").alias("primary_ids"),
                      F.array_join(F.filter(s, lambda x: ~F.array_contains(p, x)), ",").alias("secondary_ids"))


@query("fn_parse_weekdays", """
SELECT user_id, array_to_string(preferred_weekdays, ',') AS weekdays FROM v_prefs_full""")
def fn_parse_weekdays(c):
    return c.prefs_full().select("user_id", F.array_join("preferred_weekdays", ",").alias("weekdays"))


@query("fn_sanitize_weekdays", """
SELECT user_id, array_to_string(list_sort(list_distinct(list_filter(list_concat(preferred_weekdays, [7, -1, preferred_weekdays[1]]),
  lambda d: d >= 0 AND d <= 6))), ',') AS weekdays FROM v_prefs_full""")
def fn_sanitize_weekdays(c):
    p = c.prefs_full()
    arr = F.concat("preferred_weekdays", F.array(F.lit(7), F.lit(-1), F.element_at("preferred_weekdays", 1)))
    return p.select("user_id", F.array_join(S.sanitize_weekdays(arr), ",").alias("weekdays"))


@query("fn_json_modifiers", """
SELECT set_id, CAST(json_extract(m, '$.k') AS DOUBLE) AS k, coalesce(m, '{}') <> '{}' AS has_modifiers,
  coalesce(CAST(json_extract(m, '$.myo_reps') AS BOOLEAN), false) AS myo_reps
FROM (SELECT set_id, CASE WHEN set_id % 50 = 0 THEN '{}' ELSE modifiers_json END AS m FROM v_sets)""")
def fn_json_modifiers(c):
    s = c.sets()
    m = F.when(F.col("set_id") % 50 == 0, F.lit("{}")).otherwise(F.col("modifiers_json"))
    parsed = F.from_json(m, "k BIGINT, myo_reps BOOLEAN")
    return s.select("set_id", parsed["k"].cast("double").alias("k"), (F.coalesce(m, F.lit("{}")) != "{}").alias("has_modifiers"),
                    F.coalesce(parsed["myo_reps"], F.lit(False)).alias("myo_reps"))


@query("fn_modifier_tags", """
SELECT set_id, array_to_string(list_filter([CASE WHEN k % 2 = 0 THEN CASE WHEN k % 4 = 0 THEN 'Myo match' ELSE 'Myo' END END,
  CASE WHEN k % 3 = 0 THEN 'Uni' END, CASE WHEN k % 5 = 0 THEN 'Drop' END, CASE WHEN k % 7 = 0 THEN 'Partials' END],
  lambda x: x IS NOT NULL), ',') AS tags
FROM (SELECT set_id, CAST(json_extract(modifiers_json, '$.k') AS BIGINT) AS k FROM v_sets)""")
def fn_modifier_tags(c):
    k = F.from_json("modifiers_json", "k BIGINT")["k"]
    s = c.sets().select("set_id", k.alias("k"))
    t = S.modifier_tags(F.col("k") % 2 == 0, F.col("k") % 4 == 0, F.col("k") % 3 == 0, F.col("k") % 5 == 0, F.col("k") % 7 == 0)
    return s.select("set_id", F.array_join(t, ",").alias("tags"))


@query("fn_duration", """
SELECT set_id, CASE WHEN d >= 3600 THEN printf('%dh %02dm', d // 3600, (d % 3600) // 60) ELSE printf('%d:%02d', (d % 3600) // 60, d % 60) END AS duration
FROM (SELECT set_id, CAST(floor(weight_kg * reps * 7) AS BIGINT) AS d FROM v_sets)""")
def fn_duration(c):
    d = F.floor(F.col("weight_kg") * F.col("reps") * 7)
    return c.sets().select("set_id", S.duration(d).alias("duration"))


@query("fn_int_to_bool", "SELECT item_id, CAST(embed_allowed AS BOOLEAN) AS embed_allowed, order_key, sort_order FROM v_media")
def fn_int_to_bool(c):
    return c.media().select("item_id", F.col("embed_allowed").cast("boolean").alias("embed_allowed"), "order_key", "sort_order")


@query("fn_safe_int", f"""
SELECT event_id, CASE WHEN d IS NULL OR isnan(d) OR abs(d) >= 9.2e18 THEN 0 ELSE greatest(0, CAST(trunc(d) AS BIGINT)) END AS safe_int
FROM (SELECT event_id, TRY_CAST(trim(x) AS DOUBLE) AS d FROM (
  SELECT event_id, CASE event_id % 6 WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN ' ' || CAST(-value AS VARCHAR)
    WHEN 2 THEN 'n/a' WHEN 3 THEN 'inf' WHEN 4 THEN '' ELSE CAST(value * 3 AS VARCHAR) END AS x FROM events))""")
def fn_safe_int(c):
    e = c.t("events")
    m = F.col("event_id") % 6
    x = (F.when(m == 0, F.col("value").cast("string")).when(m == 1, F.concat(F.lit(" "), (-F.col("value")).cast("string")))
          .when(m == 2, "n/a").when(m == 3, "inf").when(m == 4, "").otherwise((F.col("value") * 3).cast("string")))
    return e.select("event_id", x.alias("x")).select("event_id", S.safe_int("x").alias("safe_int"))


@query("fn_safe_float", """
SELECT event_id, TRY_CAST(nullif(trim(CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 4 = 1 THEN 'x' || props
  ELSE CAST(value AS VARCHAR) END), '') AS DOUBLE) AS safe_float FROM events""")
def fn_safe_float(c):
    e = c.t("events")
    m = F.col("event_id") % 4
    x = F.when(m == 0, "").when(m == 1, F.concat(F.lit("x"), F.col("props"))).otherwise(F.col("value").cast("string"))
    return e.select("event_id", x.alias("x")).select("event_id", S.safe_float("x").alias("safe_float"))


@query("fn_parse_iso", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE date_trunc('second', ts) END AS parsed FROM events""")
def fn_parse_iso(c):
    e = c.t("events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    x = F.when(F.col("event_id") % 3 == 0, F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("Tgarbage")))\
         .when(F.col("event_id") % 3 == 1, F.concat(iso, F.lit("Z"))).otherwise(iso)
    return e.select("event_id", S.parse_iso(x).alias("parsed"))


@query("fn_slot_score", "SELECT ts, gym_id, greatest(0.0, 100.0 - prediction) AS score FROM v_future")
def fn_slot_score(c):
    return c.future().select("ts", "gym_id", S.slot_score("prediction").alias("score"))


@query("fn_rep_range_center", """
SELECT set_id, greatest(5, reps - 1) AS low, least(15, reps + 1) AS high FROM v_sets""")
def fn_rep_range_center(c):
    lo, hi = S.rep_range_center(F.col("reps"))
    return c.sets().select("set_id", lo.alias("low"), hi.alias("high"))


@query("fn_log1p_standardise", """
WITH t AS (SELECT seq, ln(1 + greatest(active_people, 0)) AS y, is_train FROM v_split),
st AS (SELECT avg(y) AS m, CASE WHEN stddev_pop(y) < 1e-6 THEN 1.0 ELSE stddev_pop(y) END AS s FROM t WHERE is_train = 1)
SELECT seq, (y - m) / s AS y_scaled, greatest(exp((y - m) / s * s + m) - 1, 0.0) AS y_back FROM t CROSS JOIN st""")
def fn_log1p_standardise(c):
    t = c.split().select("seq", F.log1p(F.greatest("active_people", F.lit(0))).alias("y"), "is_train")
    st = t.filter("is_train = 1").agg(F.avg("y").alias("m"), F.stddev_pop("y").alias("_s")) \
          .select("m", F.when(F.col("_s") < 1e-6, 1.0).otherwise(F.col("_s")).alias("s"))
    j = t.crossJoin(F.broadcast(st))  # one-row statistics
    ys = (F.col("y") - F.col("m")) / F.col("s")
    return j.select("seq", ys.alias("y_scaled"), F.greatest(F.expm1(ys * F.col("s") + F.col("m")), F.lit(0.0)).alias("y_back"))


@query("fn_split_range_by_source", """
WITH r AS (SELECT user_id, min(CAST(performed_at AS DATE)) AS s, max(CAST(performed_at AS DATE)) AS e FROM v_sets GROUP BY user_id)
SELECT user_id, 'archive' AS source, s AS range_start, least(e, DATE '2024-01-20') AS range_end FROM r WHERE s <= DATE '2024-01-20'
UNION ALL SELECT user_id, 'forecast', greatest(s, DATE '2024-01-20'), e FROM r WHERE e > DATE '2024-01-20'""")
def fn_split_range_by_source(c):
    cut = F.lit("2024-01-20").cast("date")
    r = c.sets().groupBy("user_id").agg(F.min(F.to_date("performed_at")).alias("s"), F.max(F.to_date("performed_at")).alias("e"))
    parts = F.array(
        F.when(F.col("s") <= cut, F.struct(F.lit("archive").alias("source"), F.col("s").alias("range_start"),
                                            F.least("e", cut).alias("range_end"))),
        F.when(F.col("e") > cut, F.struct(F.lit("forecast").alias("source"), F.greatest("s", cut).alias("range_start"),
                                           F.col("e").alias("range_end"))))
    return r.select("user_id", F.inline(F.filter(parts, lambda x: x.isNotNull())))
