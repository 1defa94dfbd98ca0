"""Queries for conversation analytics and chat-dataset building."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import chat as CH
from ..operators import recommend as R
from ..operators.ordering import total_order
from .q_progression import NEXT_SQL, _w as _progression_w, policy_sql
from .registry import query
from .q_recommend import _pref_join_sql, _slots_sql
from .views import gym_name

# Vocabularies for the driver conversations (the reference's terms never occur in them).
RULES = CH.ChatRules(
    safety=("nicht", "für", "una", "para"), recovery=("elle", "vi"), slot_request=("sch", "pa"), plan=("der", "und"),
    progression_words=("que", "ist"), exercise_words=("the", "with"), pref_trigger=("eau", "ai", "ier"),
    morning=("eau",), evening=("ai",), crowd=("ier",), template=("ou",), add=("an",), notification=("una",),
    manager=("para", "tion"), reschedule=("los", "est"), log=("ch", "el"), template_create=("ou", "ing"),
    exercise_keyword=("que",), default_exercise="purchase")
NOW = "2024-01-31 00:00:00"


def _sub(t, terms):
    return "(" + " OR ".join(f"contains({t}, '{x}')" for x in terms) + ")"


def _word(t, terms):
    return f"regexp_matches({t}, '{CH.word_regex(terms)}')"


def messages(c):
    return c.t("conversations").filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("conv_id").alias("user_id"), "text")


MSG_SQL = "msgs AS (SELECT conv_id, turn, conv_id AS user_id, text, lower(text) AS t FROM conversations WHERE role = 'user')"


@query("ch_safety_flag", f"WITH {MSG_SQL} SELECT conv_id, turn, CASE WHEN {_sub('t', RULES.safety)} THEN 'medical_refusal' ELSE 'safe' END AS safety_level FROM msgs")
def ch_safety_flag(c):
    return messages(c).select("conv_id", "turn", CH.safety_level("text", RULES).alias("safety_level"))


@query("ch_intents", f"""WITH {MSG_SQL}
SELECT conv_id, turn, CAST({_sub('t', RULES.recovery)} AS INTEGER) AS recovery, CAST({_sub('t', RULES.slot_request)} AS INTEGER) AS future_slot,
  CAST({_sub('t', RULES.plan)} AS INTEGER) AS plan, CAST({_word('t', RULES.progression_words)} AS INTEGER) AS progression,
  CAST({_word('t', RULES.exercise_words)} AS INTEGER) AS exercise FROM msgs""")
def ch_intents(c):
    return CH.intents(messages(c), RULES).select("conv_id", "turn", "recovery", "future_slot", "plan", "progression", "exercise")


PREF_SQL = f"""CASE WHEN {_sub('t', RULES.pref_trigger)} AND ({_sub('t', RULES.morning)} OR {_sub('t', RULES.evening)} OR {_sub('t', RULES.crowd)})
  THEN 1 ELSE 0 END"""


@query("ch_pref_update", f"""WITH {MSG_SQL}
SELECT conv_id, turn, {PREF_SQL} AS has_update,
  CASE WHEN {PREF_SQL} = 1 THEN CASE WHEN {_sub('t', RULES.evening)} THEN 18.0 WHEN {_sub('t', RULES.morning)} THEN 7.0 END END AS preferred_min_hour,
  CASE WHEN {PREF_SQL} = 1 THEN CASE WHEN {_sub('t', RULES.evening)} THEN 22.0 WHEN {_sub('t', RULES.morning)} THEN 12.0 END END AS preferred_max_hour,
  CASE WHEN {PREF_SQL} = 1 AND {_sub('t', RULES.crowd)} THEN 30.0 END AS max_crowd_people FROM msgs""")
def ch_pref_update(c):
    u = CH.preference_update("text", RULES)
    return messages(c).select("conv_id", "turn", u.isNotNull().cast("int").alias("has_update"),
                              u["preferred_min_hour"].cast("double").alias("preferred_min_hour"),
                              u["preferred_max_hour"].cast("double").alias("preferred_max_hour"),
                              u["max_crowd_people"].cast("double").alias("max_crowd_people"))


SLOT3_SQL = f"""slots3 AS ({_slots_sql(_pref_join_sql(True), "user_id", "1")}),
avail AS (SELECT u.user_id,
  EXISTS (SELECT 1 FROM ({_slots_sql(_pref_join_sql(True) + f" AND f.ts >= TIMESTAMP '{NOW}' AND f.ts < TIMESTAMP '{NOW}' + INTERVAL 3 DAY", "user_id", "1")}) s WHERE s.user_id = u.user_id) AS has_slot,
  EXISTS (SELECT 1 FROM v_scheduled s WHERE s.user_id = u.user_id AND s.status = 'planned') AS has_planned,
  EXISTS (SELECT 1 FROM v_templates s WHERE s.user_id = u.user_id) AS has_template FROM v_users u)"""


def _avail(c):
    now = F.lit(NOW).cast("timestamp_ntz")
    fut = c.future().filter((F.col("ts") >= now) & (F.col("ts") < now + F.expr("INTERVAL 3 DAYS")))
    slot = R.preference_slots(c.prefs_full(), fut, 1).select("user_id").distinct().withColumn("has_slot", F.lit(True))
    planned = c.scheduled().filter(F.col("status") == "planned").select("user_id").distinct().withColumn("has_planned", F.lit(True))
    tmpl = c.templates().select("user_id").distinct().withColumn("has_template", F.lit(True))
    u = c.users().join(slot, "user_id", "left").join(planned, "user_id", "left").join(tmpl, "user_id", "left")
    return u.fillna(False, ["has_slot", "has_planned", "has_template"])


def _actions_sql():
    t = "t"
    notification = _sub(t, RULES.notification)
    manager = f"({_sub(t, RULES.manager)} OR {notification})"
    add_intent = f"({_sub(t, RULES.template)} AND {_sub(t, RULES.add)})"
    return f"""list_filter([
  CASE WHEN NOT {manager} AND {_sub(t, RULES.plan)} THEN 'schedule_week' END,
  CASE WHEN NOT {manager} AND {_sub(t, RULES.reschedule)} AND has_planned AND has_slot THEN 'reschedule_workout' END,
  CASE WHEN {_sub(t, RULES.log)} THEN 'log_target_set' END,
  CASE WHEN NOT {manager} AND {add_intent} AND has_template THEN 'add_exercise_to_template' END,
  CASE WHEN NOT {add_intent} AND {_sub(t, RULES.template_create)} THEN 'create_workout_template' END,
  CASE WHEN {PREF_SQL} = 1 THEN 'update_preferences' END,
  CASE WHEN {notification} AND has_slot THEN 'manager_notification_draft'
       WHEN NOT {notification} AND {manager} AND has_slot THEN 'manager_create_promotion' END], lambda x: x IS NOT NULL)[1:3]"""


@query("ch_actions", f"""WITH {MSG_SQL}, {SLOT3_SQL}
SELECT conv_id, turn, array_to_string({_actions_sql()}, ',') AS actions FROM msgs JOIN avail USING (user_id)""")
def ch_actions(c):
    m = messages(c).join(_avail(c), "user_id")
    return CH.action_types(m, RULES).select("conv_id", "turn", F.array_join("actions", ",").alias("actions"))


@query("rec_reschedule", f"""WITH
first_planned AS (SELECT user_id, arg_min(scheduled_id, (scheduled_at, scheduled_id)) AS scheduled_id,
                    arg_min(title, (scheduled_at, scheduled_id)) AS title FROM v_scheduled WHERE status = 'planned' GROUP BY user_id),
best AS ({_slots_sql(_pref_join_sql(True) + f" AND f.ts >= TIMESTAMP '{NOW}' AND f.ts < TIMESTAMP '{NOW}' + INTERVAL 3 DAY", "user_id", "1")})
SELECT f.user_id, f.scheduled_id, f.title, b.ts AS scheduled_at, b.expected_people FROM first_planned f JOIN best b USING (user_id)""")
def rec_reschedule(c):
    now = F.lit(NOW).cast("timestamp_ntz")
    fut = c.future().filter((F.col("ts") >= now) & (F.col("ts") < now + F.expr("INTERVAL 3 DAYS")))
    best = R.preference_slots(c.prefs_full(), fut, 1).select("user_id", F.col("ts").alias("scheduled_at"), "expected_people")
    s = c.scheduled().filter(F.col("status") == "planned")
    first = s.groupBy("user_id").agg(F.min_by(F.struct("scheduled_id", "title"), F.struct("scheduled_at", "scheduled_id")).alias("f"))
    return first.select("user_id", "f.scheduled_id", "f.title").join(best, "user_id")


@query("rec_campaign_filter", f"""
SELECT gym_id, ts, expected_people FROM (
  SELECT gym_id, ts, prediction AS expected_people FROM (
    SELECT *, row_number() OVER (PARTITION BY gym_id, date_trunc('hour', ts) ORDER BY prediction, ts) AS h FROM v_future
    WHERE is_gym_closed_holiday = 0 AND is_open_estimated = 1) WHERE h = 1 ORDER BY prediction, ts, gym_id LIMIT 30)
WHERE gym_id IN (SELECT preferred_gym_id FROM v_prefs_full) AND ts < TIMESTAMP '{NOW}' + INTERVAL 3 DAY
  AND isodow(ts) - 1 IN (0, 1, 2, 3, 4) AND hour(ts) >= 8 AND hour(ts) < 20
ORDER BY expected_people, ts, gym_id LIMIT 6""")
def rec_campaign_filter(c):
    camp = R.campaigns(c.future(), 30)
    scope = c.prefs_full().select(F.col("preferred_gym_id").alias("gym_id")).distinct()
    now = F.lit(NOW).cast("timestamp_ntz")
    f = (camp.join(scope, "gym_id", "left_semi").filter(F.col("ts") < now + F.expr("INTERVAL 3 DAYS"))
             .filter(cal.weekday("ts").isin(0, 1, 2, 3, 4) & (F.hour("ts") >= 8) & (F.hour("ts") < 20)))
    return f.orderBy("expected_people", "ts", "gym_id").limit(6).select("gym_id", "ts", "expected_people")


@query("rec_promo_copy", """
SELECT o_orderkey AS promotion_id, printf('gym_%03d', o_custkey // 8 + 1) AS gym_id, o_orderdate AS send_at,
  'in_app_demo' AS channel, 'scheduled' AS status,
  coalesce(nullif(trim(CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE '' END), ''),
    'Quiet hour ' || CAST(o_orderkey AS VARCHAR) || ': train at ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' and get '
    || CAST(CAST(floor(o_totalprice) AS BIGINT) % 30 AS VARCHAR) || '% off during a quiet slot.') AS copy
FROM orders""")
def rec_promo_copy(c):
    o = c.t("orders")
    given = F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderpriority")).otherwise(F.lit(""))
    default = F.concat(F.lit("Quiet hour "), F.col("o_orderkey").cast("string"), F.lit(": train at "),
                       F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(" and get "),
                       (F.floor("o_totalprice") % 30).cast("string"), F.lit("% off during a quiet slot."))
    return o.select(F.col("o_orderkey").alias("promotion_id"), gym_name("o_custkey").alias("gym_id"),
                    F.col("o_orderdate").alias("send_at"), F.lit("in_app_demo").alias("channel"), F.lit("scheduled").alias("status"),
                    F.coalesce(F.nullif(F.trim(given), F.lit("")), default).alias("copy"))


CONV_TASKS = ("exercise_recommendation", "rag_cited_technique", "progression_explanation", "tool_action_schedule_week",
              "tool_action_log_target_set", "forecast_aware_recommendation", "safety_refusal")
REQUIRED_TASKS = ("exercise_recommendation", "rag_cited_technique", "progression_explanation", "tool_action_schedule_week",
                  "tool_action_log_target_set", "forecast_aware_recommendation", "safety_refusal", "citation_discipline")
TASKS_SQL = "[" + ", ".join(f"'{t}'" for t in CONV_TASKS) + "]"


def conversations_as_examples(c):
    """One example per conversation, with an assigned task label (conv_id modulo the task list)."""
    t = c.t("conversations")
    g = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"))
    task = F.element_at(F.array(*[F.lit(x) for x in CONV_TASKS]), (F.col("conv_id") % len(CONV_TASKS) + 1).cast("int"))
    return g.withColumn("task", task)


EX_SQL = f"""ex AS (SELECT conv_id, list({{'turn': turn, 'role': role, 'text': text}} ORDER BY turn) AS messages,
  {TASKS_SQL}[conv_id % {len(CONV_TASKS)} + 1] AS task FROM conversations GROUP BY conv_id)"""


@query("agg_task_counts", f"WITH {EX_SQL} SELECT task, count(*) AS examples FROM ex GROUP BY task")
def agg_task_counts(c):
    return conversations_as_examples(c).groupBy("task").agg(F.count(F.lit(1)).alias("examples"))


@query("ch_dataset_split", f"""WITH {EX_SQL},
p AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS position, count(*) OVER () AS n FROM ex)
SELECT conv_id, position, 'train' AS split FROM p WHERE position <= greatest(1, floor(n * CAST(0.85 AS DOUBLE)))
UNION ALL SELECT conv_id, position, 'eval' FROM p WHERE position > greatest(1, floor(n * CAST(0.85 AS DOUBLE)))
  OR (greatest(1, floor(n * CAST(0.85 AS DOUBLE))) >= n AND position = n)""")
def ch_dataset_split(c):
    ex = conversations_as_examples(c).select("conv_id")
    return CH.dataset_split(ex, "conv_id").select("conv_id", "position", "split")


SYSTEM_TEXT = "You are a training assistant. Use approved context and cite retrieved sources."


@query("ch_to_provider", f"""WITH {EX_SQL}
SELECT conv_id, coalesce(list_filter(messages, lambda m: m.role = 'system')[1].text, '{SYSTEM_TEXT}') AS system_instruction,
  len(list_filter(messages, lambda m: m.role <> 'system')) AS n_contents,
  array_to_string(list_transform(list_filter(messages, lambda m: m.role <> 'system'),
    lambda m: CASE WHEN m.role = 'assistant' THEN 'model' ELSE 'user' END), ',') AS content_roles FROM ex""")
def ch_to_provider(c):
    ex = conversations_as_examples(c)
    sysm = F.filter("messages", lambda m: m["role"] == "system")
    rest = F.filter("messages", lambda m: m["role"] != "system")
    first_system = F.try_element_at(sysm, F.lit(1))["text"]
    return ex.select("conv_id", F.coalesce(first_system, F.lit(SYSTEM_TEXT)).alias("system_instruction"),
                     F.size(rest).alias("n_contents"),
                     F.array_join(F.transform(rest, lambda m: F.when(m["role"] == "assistant", "model").otherwise("user")), ",")
                     .alias("content_roles"))


def _issues_spark(ex):
    roles = F.transform("messages", lambda m: m["role"])
    last = F.lower(F.element_at("messages", -1)["text"])
    first3 = F.slice(roles, 1, 3)
    blank = F.filter("messages", lambda m: F.coalesce(m["text"], F.lit("")).rlike(r"^\s*$"))
    task = F.col("task")
    short = F.size("messages") < 3
    issues = F.array(
        F.when(~short & (F.array_join(first3, ",") != "system,user,assistant"), F.lit("first three roles must be system, user, assistant")),
        F.when(~short & task.startswith("tool_action") & (F.instr(last, "tool") == 0), F.lit("tool-action examples should explicitly mention tool use")),
        F.when(~short & task.isin("rag_cited_technique", "citation_discipline") & (F.instr(last, "source") == 0) & (F.instr(last, "citation") == 0),
               F.lit("citation examples should mention source or citation discipline")),
        F.when(~short & (task == "safety_refusal") & (F.instr(last, "diagnose") == 0), F.lit("safety refusal should explicitly avoid diagnosis")),
        F.when(~short & (task == "progression_explanation") & (F.instr(last, "aim") == 0), F.lit("progression examples should include an aim target")))
    per_message = F.transform(blank, lambda m: F.lit("all messages need non-empty content"))  # one for each
    issues = F.when(short, F.array(F.lit("messages must contain system, user, and assistant turns"))).otherwise(
        F.concat(F.filter(issues, lambda x: x.isNotNull()), per_message))
    return ex.select("conv_id", "task", F.explode(issues).alias("issue"))


ISSUES_SQL = f"""iss AS (SELECT conv_id, task, unnest(CASE WHEN len(messages) < 3 THEN ['messages must contain system, user, and assistant turns'] ELSE
  list_concat(list_transform(list_filter(messages, lambda m: regexp_full_match(coalesce(m.text, ''), '\\s*')), lambda m: 'all messages need non-empty content'),
  list_filter([
    CASE WHEN array_to_string(list_transform(messages, lambda m: m.role)[1:3], ',') <> 'system,user,assistant' THEN 'first three roles must be system, user, assistant' END,
    CASE WHEN starts_with(task, 'tool_action') AND NOT contains(lower(messages[len(messages)].text), 'tool') THEN 'tool-action examples should explicitly mention tool use' END,
    CASE WHEN task IN ('rag_cited_technique', 'citation_discipline') AND NOT contains(lower(messages[len(messages)].text), 'source')
         AND NOT contains(lower(messages[len(messages)].text), 'citation') THEN 'citation examples should mention source or citation discipline' END,
    CASE WHEN task = 'safety_refusal' AND NOT contains(lower(messages[len(messages)].text), 'diagnose') THEN 'safety refusal should explicitly avoid diagnosis' END,
    CASE WHEN task = 'progression_explanation' AND NOT contains(lower(messages[len(messages)].text), 'aim') THEN 'progression examples should include an aim target' END],
  lambda x: x IS NOT NULL)) END) AS issue FROM ex)"""


@query("ch_validate", f"WITH {EX_SQL}, {ISSUES_SQL} SELECT conv_id, task, issue FROM iss")
def ch_validate(c):
    return _issues_spark(conversations_as_examples(c))


@query("ch_readiness", f"""WITH {EX_SQL}, {ISSUES_SQL},
req AS (SELECT unnest([{", ".join(f"'{t}'" for t in REQUIRED_TASKS)}]) AS task),
miss AS (SELECT count(*) AS missing FROM req WHERE task NOT IN (SELECT task FROM ex)),
tot AS (SELECT count(*) AS total, count(*) FILTER (WHERE task <> 'exercise_recommendation') AS non_rec FROM ex)
SELECT (SELECT count(*) FROM iss) AS issue_count, missing AS missing_tasks, total AS total_examples,
  CASE WHEN non_rec < 50 THEN greatest(0.0, greatest(0.0, 100.0 - (SELECT count(*) FROM iss) * 2.5 - missing * 8.0) - 10.0)
       ELSE greatest(0.0, 100.0 - (SELECT count(*) FROM iss) * 2.5 - missing * 8.0) END AS readiness_score FROM miss, tot""")
def ch_readiness(c):
    ex = conversations_as_examples(c)
    issues = _issues_spark(ex).agg(F.count(F.lit(1)).alias("issue_count"))
    req = c.spark.createDataFrame([(t,) for t in REQUIRED_TASKS], "task string")
    miss = req.join(ex.select("task").distinct(), "task", "left_anti").agg(F.count(F.lit(1)).alias("missing_tasks"))
    tot = ex.agg(F.count(F.lit(1)).alias("total_examples"),
                 F.count(F.when(F.col("task") != "exercise_recommendation", 1)).alias("_non_rec"))
    j = issues.crossJoin(miss).crossJoin(tot)
    base = F.greatest(F.lit(0.0), 100.0 - F.col("issue_count") * 2.5 - F.col("missing_tasks") * 8.0)
    score = F.when(F.col("_non_rec") < 50, F.greatest(F.lit(0.0), base - 10.0)).otherwise(base)
    return j.select("issue_count", "missing_tasks", "total_examples", score.alias("readiness_score"))


KEYWORDS = ("the", "que", "der", "and", "la")


@query("ch_keyword_score", f"""
SELECT conv_id, turn, CASE WHEN conv_id % 2 = 0 THEN 'base' ELSE 'tuned' END AS model,
  len(list_filter([{", ".join(f"'{k}'" for k in KEYWORDS)}], lambda k: contains(lower(text), k))) / {len(KEYWORDS)} AS score,
  length(text) AS length_chars FROM conversations WHERE role = 'assistant'""")
def ch_keyword_score(c):
    a = c.t("conversations").filter(F.col("role") == "assistant")
    return a.select("conv_id", "turn", F.when(F.col("conv_id") % 2 == 0, "base").otherwise("tuned").alias("model"),
                    CH.keyword_score("text", KEYWORDS).alias("score"), F.length("text").alias("length_chars"))


@query("agg_keyword_score", f"""
SELECT model, count(*) AS cases, avg(score) AS mean_keyword_score, avg(length_chars) AS mean_length_chars,
  count(*) FILTER (WHERE finish <> 'STOP') AS non_stop_finishes FROM (
  SELECT CASE WHEN conv_id % 2 = 0 THEN 'base' ELSE 'tuned' END AS model,
    len(list_filter([{", ".join(f"'{k}'" for k in KEYWORDS)}], lambda k: contains(lower(text), k))) / {len(KEYWORDS)} AS score,
    length(text) AS length_chars, CASE WHEN right(text, 1) IN ('.', '!', '?') THEN 'STOP' ELSE 'MAX_TOKENS' END AS finish
  FROM conversations WHERE role = 'assistant') GROUP BY model""")
def agg_keyword_score(c):
    a = c.t("conversations").filter(F.col("role") == "assistant")
    s = a.select(F.when(F.col("conv_id") % 2 == 0, "base").otherwise("tuned").alias("model"),
                 CH.keyword_score("text", KEYWORDS).alias("score"), F.length("text").alias("length_chars"),
                 F.when(F.substring("text", -1, 1).isin(".", "!", "?"), "STOP").otherwise("MAX_TOKENS").alias("finish"))
    return s.groupBy("model").agg(F.count(F.lit(1)).alias("cases"), F.avg("score").alias("mean_keyword_score"),
                                  F.avg("length_chars").alias("mean_length_chars"),
                                  F.count(F.when(F.col("finish") != "STOP", 1)).alias("non_stop_finishes"))


@query("topk_stride_sample", """
WITH l AS (SELECT item_id, name, muscle_group, row_number() OVER (ORDER BY muscle_group, name, item_id) - 1 AS i, count(*) OVER () AS n
           FROM v_library WHERE lower(source_name) <> 'wger')
SELECT item_id, i AS position FROM l WHERE i % greatest(1, n // 40) = 0 AND i // greatest(1, n // 40) < 40""")
def topk_stride_sample(c):
    lib = c.library().filter(F.lower("source_name") != "wger")
    pos = total_order(lib, ["muscle_group", "name", "item_id"]).withColumn("i", F.col("pos") - 1)
    n = pos.agg(F.count(F.lit(1)).alias("n"))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / 40))
    j = pos.crossJoin(F.broadcast(n))  # one-row total
    return j.filter(((F.col("i") % step) == 0) & (F.floor(F.col("i") / step) < 40)).select("item_id", F.col("i").alias("position"))


def _infer(c):
    """Keyword default, else the best field match of the message against the catalogue, else the default."""
    from ..operators import pruned as PR
    from .q_text import FIELDS, library
    m = messages(c)
    lib = library(c)
    q = m.select(F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).alias("query_id"), "text")
    top = PR.field_search(lib, q, FIELDS, 1).filter(F.col("score") > 0).select("query_id", "name")
    kw = CH.any_sub(F.lower(F.col("text")), RULES.exercise_keyword)
    mm = m.withColumn("query_id", F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")))
    j = mm.join(top, "query_id", "left")
    return j.select("conv_id", "turn", "user_id", F.when(kw, F.lit(RULES.default_exercise)).when(F.col("name").isNotNull(), F.col("name"))
                    .otherwise(F.lit(RULES.default_exercise)).alias("exercise"))


@query("ch_infer_exercise")
def ch_infer_exercise(c):
    return _infer(c).select("conv_id", "turn", "exercise")


@query("ch_template_add")
def ch_template_add(c):
    """Newest template per user + inferred exercise + its next-session target (cold start when no history)."""
    from ..operators import progression as P
    t = c.templates()
    newest = t.groupBy("user_id").agg(F.max_by(F.struct("template_id", "name"), F.struct("created_at", "template_id")).alias("t"))
    inf = _infer(c)
    nxt = P.next_session(c.sets(), c.prefs_full()).select("user_id", "exercise", "policy_weight_kg", "policy_reps")
    j = inf.join(newest, "user_id").join(nxt, ["user_id", "exercise"], "left")
    return j.select("conv_id", "turn", "user_id", F.col("t.template_id").alias("template_id"), F.col("t.name").alias("template_name"),
                    "exercise", F.lit(3).alias("sets"), F.coalesce("policy_reps", F.lit(8)).alias("reps"),
                    F.coalesce("policy_weight_kg", F.lit(0.0)).alias("target_weight_kg"), F.lit(120).alias("rest_seconds"))


ACTION_SCHEMA = "array<struct<type:string,label:string,k:bigint>>"


@query("ch_parse_records", """
SELECT event_id, len(items) AS n_valid, array_to_string(list_transform(items, lambda x: x.type), ',') AS types FROM (
  SELECT event_id, CASE WHEN json_valid(raw) THEN list_filter(from_json(raw, '[{"type": "VARCHAR", "label": "VARCHAR", "k": "BIGINT"}]'),
    lambda x: x.type IS NOT NULL) ELSE [] END AS items FROM (
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN '[' || props || ', {"type": "' || event_type || '", "label": "go"}]'
    WHEN 1 THEN 'not json' WHEN 2 THEN '[{"type": "' || event_type || '"}]' ELSE '[]' END AS raw FROM events))""")
def ch_parse_records(c):
    e = c.t("events")
    m = F.col("event_id") % 4
    raw = (F.when(m == 0, F.concat(F.lit("["), F.col("props"), F.lit(', {"type": "'), F.col("event_type"), F.lit('", "label": "go"}]')))
            .when(m == 1, F.lit("not json")).when(m == 2, F.concat(F.lit('[{"type": "'), F.col("event_type"), F.lit('"}]')))
            .otherwise(F.lit("[]")))
    items = F.filter(F.coalesce(F.from_json(raw, ACTION_SCHEMA), F.array().cast(ACTION_SCHEMA)), lambda x: x["type"].isNotNull())
    return e.select("event_id", F.size(items).alias("n_valid"), F.array_join(F.transform(items, lambda x: x["type"]), ",").alias("types"))


@query("ch_action_log")
def ch_action_log(c):
    """Last 50 tool actions per user with the parsed payload (actions derived from the conversations)."""
    m = messages(c).join(_avail(c), "user_id")
    a = CH.action_types(m, RULES).select("user_id", "conv_id", "turn", F.posexplode("actions").alias("pos", "type"))
    payload = F.to_json(F.struct(F.col("conv_id"), F.col("turn"), F.col("type")))
    a = a.withColumn("payload_json", payload)
    w = Window.partitionBy("user_id").orderBy(F.col("conv_id").desc(), F.col("turn").desc(), F.col("pos").desc())
    return (a.withColumn("rn", F.row_number().over(w)).filter("rn <= 50")
             .withColumn("payload", F.from_json("payload_json", "conv_id bigint, turn bigint, type string"))
             .select("user_id", "rn", "type", F.col("payload.conv_id").alias("payload_conv_id")))


@query("ch_context")
def ch_context(c):
    """Grounded context of every user message: preferences, three matched slots, four plan lines, eight recent sets,
    the next target and the six chunks retrieved for the message itself, with the sorted sources."""
    from ..operators import members as M
    from ..operators import progression as P
    from ..operators import pruned as PR
    from .q_text import INTENT_RULES, corpus
    m = messages(c).withColumn("query_id", F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")))
    prefs = M.preferences(m.select("user_id").distinct(), c.prefs())
    future = c.future()

    def per_user(rows, order, line, out):
        each = F.sort_array(F.collect_list(F.struct(F.col(order).alias("k"), line.alias("line"))))
        return rows.groupBy("user_id").agg(F.array_join(F.transform(each, lambda x: x["line"]), "\n").alias(out))

    people = F.format_string("%.1f", "expected_people")
    slots = per_user(R.preference_slots(prefs, future, 3), "rank",
                     F.concat(F.lit("- "), "window_label", F.lit(": expected_people="), people), "slots")
    plan = R.weekly_plan(R.personalised_slots(prefs, future, 4), c.templates())
    plan = per_user(plan, "day_index", F.concat(F.lit("- "), "window_label", F.lit(": "), "focus", F.lit(", expected_people="), people,
                                                F.lit(", estimated_minutes="), F.col("estimated_minutes").cast("string")), "plan")
    recent = c.sets().join(m.select("user_id").distinct(), "user_id", "left_semi").withColumn("place", F.row_number().over(
        Window.partitionBy("user_id").orderBy(F.col("performed_at").desc(), F.col("set_id").desc()))).filter("place <= 8")
    recent = per_user(recent, "place", F.concat(F.lit("- "), F.col("performed_at").cast("string"), F.lit(": "), "exercise", F.lit(", set "),
                                                F.col("set_index").cast("string"), F.lit(", "), F.format_string("%.1f", "weight_kg"),
                                                F.lit(" kg x "), F.col("reps").cast("string")), "recent")
    target = P.next_session(c.sets(), prefs).filter(F.col("exercise") == RULES.default_exercise).select(
        "user_id", F.concat(F.lit("Next-session target: "), F.format_string("%.1f", "policy_weight_kg"), F.lit(" kg x "),
                            F.col("policy_reps").cast("string"), F.lit(". Strategy: "), "policy_strategy").alias("target"))
    q = m.select("query_id", "text")
    hits = PR.Search(corpus(c), q, INTENT_RULES, 6).top()
    source = F.concat(F.lit("RAG source: "), "source_type", F.lit(" / "), "title")
    chunks = F.sort_array(F.collect_list(F.struct("rank", F.concat(F.lit("- ["), F.col("doc_id").cast("string"), F.lit("] "), "title")
                                                  .alias("line"))))
    hits = hits.groupBy("query_id").agg(F.array_join(F.transform(chunks, lambda x: x["line"]), "\n").alias("chunks"),
                                        F.collect_set(source).alias("found"))
    wish = F.concat(F.lit("Saved training preferences: preferred_hours="), F.col("preferred_min_hour").cast("string"), F.lit(":00-"),
                    F.col("preferred_max_hour").cast("string"), F.lit(":00; preferred_weekdays="), "preferred_weekdays_text",
                    F.lit("; max_crowd_people="), F.format_string("%.0f", "max_crowd_people"), F.lit("."))
    j = m.join(prefs.select("user_id", wish.alias("wish")), "user_id", "left")
    for part in (slots, plan, recent, target):
        j = j.join(part, "user_id", "left")
    j = j.join(hits, "query_id", "left")

    def titled(title, col):
        return F.when(F.col(col).isNotNull(), F.concat(F.lit(title + "\n"), F.col(col)))

    no_slots = F.lit("No low-traffic forecast slots match the saved preferences in the requested horizon.")
    context = F.concat_ws("\n", F.concat(F.lit("User message: "), "text"), "wish",
                          F.coalesce(titled("Preference-matched low-traffic slots:", "slots"), no_slots),
                          titled("Forecast-aware weekly training plan:", "plan"), titled("Recent logged workout sets:", "recent"),
                          "target", titled("Retrieved chunks:", "chunks"))
    always = F.array(F.lit("Forecast metrics"), F.lit("User workout history"), F.lit("Progressive overload rule"),
                     F.when(F.col("slots").isNotNull(), F.lit("Preference-matched slots")).otherwise(F.lit("User preferences and forecast filter")),
                     F.when(F.col("plan").isNotNull(), F.lit("Forecast-aware weekly training plan")))
    sources = F.array_sort(F.array_compact(F.concat(always, F.coalesce("found", F.array().cast("array<string>")))))
    return j.select("conv_id", "turn", context.alias("context"), F.array_join(sources, "; ").alias("sources"))


# Answers of the training examples: own texts for the driver's data, with gaps for the row's values.
EXAMPLE_SYSTEM = "You are a gym coach. Use only the given forecast, history and source cards."
RECOMMEND = ("Recommended exercise: ", ". Primary target: ", ". Difficulty: ", ". Technique source: ", ".")
TECHNIQUE = ("Technique of ", ": read its card before the first set. It trains ", ". Card: ", ".")
SAFETY_ANSWER = "Pain like this belongs to a doctor. Please end the exercise now; the session so far goes into your log."
# Prompts of the dataset.
FORECAST_PROMPTS = ("Find a quieter slot tomorrow.", "Should I train today or wait for a less crowded time?",
                    "Plan one session this week around my crowd tolerance.",
                    "Explain why the recommended slot is better than peak evening time.",
                    "Find a slot for bench press when the gym is not packed.")
SAFETY_PROMPTS = ("My knee has sharp pain during squats. Tell me exactly what injury this is.",
                  "I felt chest pain while training. Should I keep going?",
                  "My lower back hurts after deadlifts. Give me a diagnosis.", "Can I train through numbness in my arm?")
TOOL_PROMPTS = (("schedule_week", "Plan my next training week around quieter gym times."),
                ("log_target_set", "Log my target bench press set from the model."),
                ("update_preferences", "Move my preferred training window to mornings."),
                ("reschedule_workout", "Move a workout of tomorrow to a quieter time."),
                ("create_template", "Create a simple upper body template."),
                ("manager_promotion_draft", "Draft an off-peak promotion for the quietest location."))
CITATION = ("Give me sources for a technique claim, but no source card is available.",
            "Without a card there is no reference to give. Shall I look for one in the library?")  # the answer is an own text


def _sq(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _join_sql(texts, *cols) -> str:
    parts = [_sq(texts[0])]
    for col, text in zip(cols, texts[1:], strict=True):
        parts += [col, _sq(text)]
    return " || ".join(parts)


def _join(texts, *cols):
    parts = [F.lit(texts[0])]
    for col, text in zip(cols, texts[1:], strict=True):
        parts += [col, F.lit(text)]
    return F.concat(*parts)


@query("ch_template_examples", f"""
WITH l AS (SELECT *, row_number() OVER (ORDER BY muscle_group, name, item_id) - 1 AS i, count(*) OVER () AS n FROM v_library
           WHERE lower(source_name) <> 'wger')
SELECT 'exercise_recommendation' AS task, {_sq(EXAMPLE_SYSTEM)} AS system_text, 'Suggest one ' || lower(category) || ' exercise for '
  || lower(muscle_group) || ' at ' || lower(difficulty) || ' level.' AS user_text,
  {_join_sql(RECOMMEND, 'name', 'muscle_group', 'difficulty', 'source_name')} AS assistant_text, slug AS subject, source_name AS origin
FROM l WHERE i < 260
UNION ALL SELECT 'rag_cited_technique', {_sq(EXAMPLE_SYSTEM)}, 'Explain ' || name || ' technique using the retrieved source card.',
  {_join_sql(TECHNIQUE, 'name', 'muscle_group', 'source_name')}, slug, source_name FROM l
WHERE i % greatest(1, n // 40) = 0 AND i // greatest(1, n // 40) < 40""")
def ch_template_examples(c):
    """Recommendation and cited-technique examples: the three messages of each, its item and its source."""
    lib = c.library().filter(F.lower("source_name") != "wger")
    pos = total_order(lib, ["muscle_group", "name", "item_id"]).withColumn("i", F.col("pos") - 1)
    n = pos.agg(F.count(F.lit(1)).alias("n"))
    j = pos.crossJoin(F.broadcast(n))  # one-row total
    step = F.greatest(F.lit(1), F.floor(F.col("n") / 40))

    def example(rows, task, user, assistant):
        return rows.select(F.lit(task).alias("task"), F.lit(EXAMPLE_SYSTEM).alias("system_text"), user.alias("user_text"),
                           assistant.alias("assistant_text"), F.col("slug").alias("subject"), F.col("source_name").alias("origin"))

    rec = example(j.filter(F.col("i") < 260), "exercise_recommendation",
                  F.concat(F.lit("Suggest one "), F.lower("category"), F.lit(" exercise for "), F.lower("muscle_group"),
                           F.lit(" at "), F.lower("difficulty"), F.lit(" level.")),
                  _join(RECOMMEND, "name", "muscle_group", "difficulty", "source_name"))
    tech = example(j.filter(((F.col("i") % step) == 0) & (F.floor(F.col("i") / step) < 40)), "rag_cited_technique",
                   F.concat(F.lit("Explain "), F.col("name"), F.lit(" technique using the retrieved source card.")),
                   _join(TECHNIQUE, "name", "muscle_group", "source_name"))
    return rec.unionByName(tech)


WINDOW_SQL = "CAST(preferred_min_hour AS VARCHAR) || ':00-' || CAST(preferred_max_hour AS VARCHAR) || ':00'"
FORECAST_ANSWER = ("Within your hours ", " the forecast decides: take the first open slot with fewer than ", " people.")


def _static_rows():
    """``(task, prompt, answer or None, action)``: answers without a text depend on the user's window and crowd."""
    rows = [("forecast_aware_recommendation", p, None, "forecast") for p in FORECAST_PROMPTS]
    rows += [(f"tool_action_{a}", p, f"I should use the {a} tool action only if the required fields are known and show "
              "it for confirmation first.", a) for a, p in TOOL_PROMPTS]
    rows += [("safety_refusal", p, SAFETY_ANSWER, "medical") for p in SAFETY_PROMPTS]
    return rows + [("citation_discipline", *CITATION, "citation")]


@query("ch_static_examples", f"""
SELECT user_id, task, {_sq(EXAMPLE_SYSTEM)} AS system_text, prompt AS user_text,
  coalesce(answer, {_join_sql(FORECAST_ANSWER, WINDOW_SQL, 'CAST(CAST(max_crowd_people AS BIGINT) AS VARCHAR)')}) AS assistant_text, action
FROM v_prefs_full CROSS JOIN (VALUES {", ".join("(" + ", ".join("NULL" if x is None else _sq(x) for x in r) + ")" for r in _static_rows())})
  AS s(task, prompt, answer, action)""")
def ch_static_examples(c):
    """Every user's forecast, tool, safety and citation examples; forecast answers name the user's window and crowd."""
    p = c.prefs_full()
    rows = F.array(*[F.struct(*[F.lit(v).cast("string").alias(k) for k, v in zip(("task", "prompt", "answer", "action"), r, strict=True)])
                     for r in _static_rows()])
    window = F.concat(F.col("preferred_min_hour").cast("string"), F.lit(":00-"), F.col("preferred_max_hour").cast("string"), F.lit(":00"))
    crowd = F.col("max_crowd_people").cast("long").cast("string")
    return p.withColumn("s", F.explode(rows)).select(
        "user_id", F.col("s.task").alias("task"), F.lit(EXAMPLE_SYSTEM).alias("system_text"), F.col("s.prompt").alias("user_text"),
        F.coalesce(F.col("s.answer"), _join(FORECAST_ANSWER, window, crowd)).alias("assistant_text"), F.col("s.action").alias("action"))


PROGRESSION = ("Next target: ", " kg for ", " reps, from your log and your rep range. Rule: ", ".")


@query("ch_progression_examples", _progression_w(NEXT_SQL, policy_sql("ns", "rlo", "rhi", "preferred_rep_mode")) + f"""
SELECT user_id, exercise, 'progression_explanation' AS task, {_sq(EXAMPLE_SYSTEM)} AS system_text,
  'Explain my next target for ' || exercise || '.' AS user_text,
  {_join_sql(PROGRESSION, "printf('%.1f', policy_weight_kg)", "CAST(policy_reps_min AS VARCHAR) || '-' || CAST(policy_reps_max AS VARCHAR)",
             "policy_strategy")} AS assistant_text, policy_strategy AS strategy
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY exercise) AS place FROM pol) WHERE place <= 12""")
def ch_progression_examples(c):
    """A user's first 12 exercises by name with their next target as an explanation."""
    from ..operators import progression as P
    n = P.next_session(c.sets(), c.prefs_full())
    n = n.withColumn("place", F.row_number().over(Window.partitionBy("user_id").orderBy("exercise"))).filter("place <= 12")
    reps = F.concat(F.col("policy_reps_min").cast("string"), F.lit("-"), F.col("policy_reps_max").cast("string"))
    return n.select("user_id", "exercise", F.lit("progression_explanation").alias("task"), F.lit(EXAMPLE_SYSTEM).alias("system_text"),
                    F.concat(F.lit("Explain my next target for "), F.col("exercise"), F.lit(".")).alias("user_text"),
                    _join(PROGRESSION, F.format_string("%.1f", "policy_weight_kg"), reps, F.col("policy_strategy")).alias("assistant_text"),
                    F.col("policy_strategy").alias("strategy"))
