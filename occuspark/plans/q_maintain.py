"""Queries for set operations and table maintenance and the registry rows of 2.9."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import aggregates as A
from ..operators import forecast as FC
from ..operators import maintain as MT
from ..operators import ml as ML
from ..operators import progression as P
from ..operators import recommend as R
from ..operators import series
from .registry import query
from .q_progression import CASES_SQL, POLICY_SQL, SPLIT_SQL
from .q_recommend import _pref_join_sql, _slots_sql
from .views import HOLIDAYS, sql_in_dates, sql_multiplier, sql_open

EXT_SQL = """
ext AS (SELECT ts, gym_id, CAST(active_people AS DOUBLE) AS active_people, 0 AS is_synthetic,
          'observation' AS generation_method FROM v_obs
        UNION ALL SELECT ts, gym_id, prediction, 1, 'calendar_profile' FROM v_future)"""


def _extended(c):
    real = c.obs().select("ts", "gym_id", F.col("active_people").cast("double").alias("active_people"),
                          F.lit(0).alias("is_synthetic"), F.lit("observation").alias("generation_method"))
    gen = c.future().select("ts", "gym_id", F.col("prediction").alias("active_people"), F.lit(1).alias("is_synthetic"),
                            F.lit("calendar_profile").alias("generation_method"))
    return real.unionByName(gen)


@query("set_union_extended", f"WITH {EXT_SQL} SELECT * FROM ext")
def set_union_extended(c):
    return _extended(c)


@query("join_meta_back", f"""
WITH {EXT_SQL}, feat AS (SELECT gym_id, ts, lag(active_people, 1) OVER (PARTITION BY gym_id ORDER BY ts) AS lag_1 FROM ext)
SELECT f.gym_id, f.ts, f.lag_1, e.is_synthetic, e.generation_method FROM feat f JOIN ext e USING (gym_id, ts)""")
def join_meta_back(c):
    ext = _extended(c)
    feat = series.over_chunks(ext.select("gym_id", "ts", "active_people"),
                              lambda w: {"lag_1": F.lag("active_people", 1).over(w)}, 1).drop("active_people")
    return feat.join(ext.select("gym_id", "ts", "is_synthetic", "generation_method"), ["gym_id", "ts"])


@query("set_union_train", """
SELECT CAST(seq AS DOUBLE) AS seq, gym_id, ts, CAST(active_people AS DOUBLE) AS active_people, lag_1, NULL::DOUBLE AS prediction_interval_high FROM v_split WHERE is_train = 1
UNION ALL SELECT NULL, gym_id, ts, prediction, NULL, prediction_interval_high FROM v_future""")
def set_union_train(c):
    # seq is DOUBLE: the supplement rows carry no sequence (NULL-able integers round-trip badly through pandas).
    real = c.split().filter("is_train = 1").select(F.col("seq").cast("double").alias("seq"), "gym_id", "ts", F.col("active_people").cast("double").alias("active_people"), "lag_1")
    sup = c.future().select("gym_id", "ts", F.col("prediction").alias("active_people"), "prediction_interval_high")
    return MT.union_tolerant(real, sup)


@query("topk_per_group_head", """
SELECT gym_id, ts, prediction FROM (SELECT *, row_number() OVER (PARTITION BY gym_id ORDER BY ts) AS rn FROM v_future)
WHERE rn <= (SELECT CAST(floor(0.5 * count(*) / count(DISTINCT gym_id)) AS BIGINT) FROM v_split WHERE is_train = 1)""")
def topk_per_group_head(c):
    # k = ratio x real train rows / groups (ratio 0.5): the supplement keeps the first k rows per gym.
    tr = c.split().filter("is_train = 1").agg(F.floor(0.5 * F.count(F.lit(1)) / F.countDistinct("gym_id")).alias("k"))
    w = Window.partitionBy("gym_id").orderBy("ts")
    f = c.future().withColumn("_rn", F.row_number().over(w)).crossJoin(F.broadcast(tr))  # one-row k
    return f.filter(F.col("_rn") <= F.col("k")).select("gym_id", "ts", "prediction")


REGISTRY_SQL = ",\n".join((CASES_SQL, POLICY_SQL, SPLIT_SQL)) + """,
board AS (SELECT model, count(e) AS rows, coalesce(avg(abs(e)), 0.0) AS mae, coalesce(sqrt(avg(e * e)), 0.0) AS rmse,
  CASE WHEN coalesce(sum(CASE WHEN e IS NOT NULL THEN abs(a) END), 0) = 0 THEN 0.0
       ELSE sum(abs(e)) / sum(CASE WHEN e IS NOT NULL THEN abs(a) END) END AS wape FROM (
  SELECT m.model, p.active_people AS a, p.active_people - CASE m.model WHEN 'previous_observation' THEN p.pred_previous
    WHEN 'seasonal_lag_1d' THEN p.pred_seasonal WHEN 'rolling_mean_16' THEN p.pred_rolling ELSE p.pred_calendar END AS e
  FROM v_pred p CROSS JOIN (VALUES ('previous_observation'), ('seasonal_lag_1d'), ('rolling_mean_16'),
    ('calendar_profile_gym_weekday_hour')) AS m(model)) GROUP BY model),
gymb AS (SELECT 'calendar_' || gym_id AS model, count(*) AS rows, avg(abs(active_people - pred_calendar)) AS mae,
           sqrt(avg(pow(active_people - pred_calendar, 2))) AS rmse,
           sum(abs(active_people - pred_calendar)) / sum(abs(active_people)) AS wape FROM v_pred GROUP BY gym_id),
arc AS (SELECT gym_id, regr_slope(CAST(active_people AS DOUBLE), lag_1) AS slope, regr_intercept(CAST(active_people AS DOUBLE), lag_1) AS intercept
        FROM v_split WHERE is_train = 1 GROUP BY gym_id),
are AS (SELECT t.active_people AS a, t.active_people - greatest(arc.intercept + arc.slope * t.lag_1, 0.0) AS e
        FROM v_split t JOIN arc USING (gym_id) WHERE t.is_train = 0 AND arc.intercept + arc.slope * t.lag_1 IS NOT NULL),
pge AS (SELECT weight_kg AS a, weight_kg - greatest(0.0, policy_weight_kg) AS e FROM spl WHERE is_train = 0),
reg AS (SELECT 'baseline' AS family, model, 'occupancy_people' AS target, 'real_holdout' AS dataset_scope, rows, mae, rmse, wape FROM board
        UNION ALL SELECT 'per_gym_profile', model, 'occupancy_people', 'single_gym', rows, mae, rmse, wape FROM gymb
        UNION ALL SELECT 'statistical_exogenous', 'ar1_per_gym', 'occupancy_people', 'real_holdout', count(*), avg(abs(e)),
          sqrt(avg(e * e)), sum(abs(e)) / sum(abs(a)) FROM are
        UNION ALL SELECT 'training_progression', 'rule_policy', 'next_set_weight_kg', 'demo_workout_history', count(*), avg(abs(e)),
          sqrt(avg(e * e)), sum(abs(e)) / sum(abs(a)) FROM pge)"""


def _registry(c):
    """One row per model from the metric sources: baselines, per-site profiles, the clipped per-site AR(1) and the progression policy."""
    cols = ["rows", "mae", "rmse", "wape"]

    def named(df, family, target, scope):
        return df.select(F.lit(family).alias("family"), "model", F.lit(target).alias("target"),
                         F.lit(scope).alias("dataset_scope"), *cols)

    p, split = c.pred(), c.split()
    gyms = A.metrics(p, pred="pred_calendar", by=["gym_id"]).withColumn("model", F.concat(F.lit("calendar_"), "gym_id"))
    ar = ML.ar1_per_series(split.filter("is_train = 1"), split.filter("is_train = 0"))
    ar = A.metrics(ar.filter(F.col("prediction").isNotNull()), ML.TARGET, "prediction", clip=True)
    pg = P.split(P.policy(P.cases(c.sets()))).filter("is_train = 0").withColumn(
        "prediction", F.greatest(F.lit(0.0), "policy_weight_kg"))
    pg = A.metrics(pg, "weight_kg", "prediction")
    return (named(FC.baseline_board(p), "baseline", "occupancy_people", "real_holdout")
            .unionByName(named(gyms, "per_gym_profile", "occupancy_people", "single_gym"))
            .unionByName(named(ar.withColumn("model", F.lit("ar1_per_gym")), "statistical_exogenous", "occupancy_people", "real_holdout"))
            .unionByName(named(pg.withColumn("model", F.lit("rule_policy")), "training_progression", "next_set_weight_kg",
                               "demo_workout_history")))


@query("set_union_registry", f"WITH {REGISTRY_SQL} SELECT * FROM reg", digits=6)
def set_union_registry(c):
    return _registry(c)


RANKED_SQL = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY mae, family, model) AS rank FROM reg) WHERE rank <= 12"


@query("topk_registry", f"WITH {REGISTRY_SQL} {RANKED_SQL}", digits=6)
def topk_registry(c):
    w = Window.partitionBy("target").orderBy("mae", "family", "model")
    return _registry(c).withColumn("rank", F.row_number().over(w)).filter("rank <= 12")


@query("ml_registry", f"""WITH {REGISTRY_SQL}
SELECT *, row_number() OVER (PARTITION BY target, dataset_scope ORDER BY mae, family, model) AS rank,
  row_number() OVER (PARTITION BY target, family ORDER BY mae, model) AS family_rank FROM reg""", digits=6)
def ml_registry(c):
    """The whole registry in its report order: rank of every model among its target's of the same scope and its family's."""
    w = Window.partitionBy("target", "dataset_scope").orderBy("mae", "family", "model")
    f = Window.partitionBy("target", "family").orderBy("mae", "model")
    return _registry(c).withColumns({"rank": F.row_number().over(w), "family_rank": F.row_number().over(f)})


@query("topk_best_model", f"""WITH {REGISTRY_SQL}
SELECT target, arg_min(family, (mae, rmse, family, model)) AS family, arg_min(model, (mae, rmse, family, model)) AS model,
  min(mae) AS mae, arg_min(rmse, (mae, rmse, family, model)) AS rmse FROM reg GROUP BY target""", digits=6)
def topk_best_model(c):
    best = F.min_by(F.struct("family", "model", "mae", "rmse"), F.struct("mae", "rmse", "family", "model"))
    return _registry(c).groupBy("target").agg(best.alias("b")).select("target", "b.*")


@query("ml_research_deltas", f"""WITH {REGISTRY_SQL},
occ AS (SELECT * FROM reg WHERE target = 'occupancy_people'),
best AS (SELECT family, arg_min(model, (mae, rmse, model)) AS best_model, min(mae) AS best_mae FROM occ GROUP BY family),
ref AS (SELECT max(CASE WHEN model = 'previous_observation' THEN mae END) AS base_mae FROM reg WHERE family = 'baseline')
SELECT family, best_model, best_mae, best_mae - base_mae AS mae_delta_vs_previous,
  best_mae - (SELECT min(mae) FROM occ) AS mae_delta_vs_best FROM best CROSS JOIN ref""", digits=6)
def ml_research_deltas(c):
    reg = _registry(c).filter(F.col("target") == "occupancy_people")
    best = reg.groupBy("family").agg(F.min_by("model", F.struct("mae", "rmse", "model")).alias("best_model"),
                                     F.min("mae").alias("best_mae"))
    ref = reg.filter(F.col("family") == "baseline").agg(
        F.max(F.when(F.col("model") == "previous_observation", F.col("mae"))).alias("base_mae"))
    overall = reg.agg(F.min("mae").alias("all_best"))
    j = best.crossJoin(F.broadcast(ref)).crossJoin(F.broadcast(overall))  # one-row scalars
    return j.select("family", "best_model", "best_mae", (F.col("best_mae") - F.col("base_mae")).alias("mae_delta_vs_previous"),
                    (F.col("best_mae") - F.col("all_best")).alias("mae_delta_vs_best"))


@query("ml_model_improvement", f"""WITH {REGISTRY_SQL}
SELECT model, mae, (b.base - mae) / b.base * 100 AS improvement_pct FROM reg
CROSS JOIN (SELECT mae AS base FROM reg WHERE family = 'baseline' AND model = 'previous_observation') b WHERE family = 'baseline'""")
def ml_model_improvement(c):
    reg = _registry(c).filter(F.col("family") == "baseline")
    base = reg.filter(F.col("model") == "previous_observation").select(F.col("mae").alias("base"))
    return reg.crossJoin(F.broadcast(base)).select(
        "model", "mae", ((F.col("base") - F.col("mae")) / F.col("base") * 100).alias("improvement_pct"))


@query("set_required_minus_present", """
SELECT r.role FROM (VALUES ('system'), ('user'), ('assistant'), ('tool')) AS r(role)
WHERE r.role NOT IN (SELECT DISTINCT role FROM conversations)""")
def set_required_minus_present(c):
    req = c.spark.createDataFrame([(r,) for r in ("system", "user", "assistant", "tool")], "role string")
    return req.join(c.t("conversations").select("role").distinct(), "role", "left_anti")


EVENTS_SQL = f"""
slots AS ({_slots_sql(_pref_join_sql(True), "user_id", "8").replace("SELECT user_id, rank", "SELECT user_id, gym_id, rank", 1)}),
existing AS (SELECT user_id, 'training_slot' AS recommendation_type, gym_id || ':' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS context_key,
  'shown' AS status, ts - INTERVAL 1 DAY AS created_at, score - 1 AS score FROM slots WHERE rank <= 5 AND rank % 2 = 1),
incoming AS (SELECT user_id, 'training_slot' AS recommendation_type, gym_id || ':' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS context_key,
  'new' AS status, TIMESTAMP '2024-02-01 08:00:00' AS created_at, score FROM slots WHERE rank >= 3),
up AS (SELECT coalesce(e.user_id, i.user_id) AS user_id, coalesce(e.recommendation_type, i.recommendation_type) AS recommendation_type,
  coalesce(e.context_key, i.context_key) AS context_key,
  CASE WHEN e.user_id IS NOT NULL THEN e.status ELSE i.status END AS status,
  CASE WHEN e.user_id IS NOT NULL THEN e.created_at ELSE i.created_at END AS created_at,
  CASE WHEN i.user_id IS NOT NULL THEN i.score ELSE e.score END AS score,
  CASE WHEN e.user_id IS NOT NULL AND i.user_id IS NOT NULL THEN 'updated' WHEN i.user_id IS NOT NULL THEN 'inserted' ELSE 'unchanged' END AS action
  FROM existing e FULL JOIN incoming i USING (user_id, recommendation_type, context_key))"""


def _events(c):
    slots = R.preference_slots(c.prefs_full(), c.future(), 8)
    key = F.concat(F.col("gym_id"), F.lit(":"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    base = slots.select("user_id", F.lit("training_slot").alias("recommendation_type"), key.alias("context_key"), "rank", "ts", "score")
    existing = base.filter((F.col("rank") <= 5) & (F.col("rank") % 2 == 1)).select(
        "user_id", "recommendation_type", "context_key", F.lit("shown").alias("status"),
        (F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("created_at"), (F.col("score") - 1).alias("score"))
    incoming = base.filter(F.col("rank") >= 3).select(
        "user_id", "recommendation_type", "context_key", F.lit("new").alias("status"),
        F.lit("2024-02-01 08:00:00").cast("timestamp_ntz").alias("created_at"), "score")
    return MT.upsert_keep(existing, incoming, ["user_id", "recommendation_type", "context_key"])


@query("set_upsert_events", f"WITH {EVENTS_SQL} SELECT * FROM up")
def set_upsert_events(c):
    return _events(c)


@query("rec_event_log", f"WITH {EVENTS_SQL} SELECT * FROM up")
def rec_event_log(c):
    return _events(c)


@query("rec_history", f"""WITH {EVENTS_SQL}
SELECT * FROM (SELECT user_id, context_key, status, created_at, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, context_key DESC) AS rn
FROM up) WHERE rn <= 50""")
def rec_history(c):
    w = Window.partitionBy("user_id").orderBy(F.col("created_at").desc(), F.col("context_key").desc())
    return (_events(c).select("user_id", "context_key", "status", "created_at").withColumn("rn", F.row_number().over(w))
            .filter("rn <= 50"))


LIB_COLS = "item_id, slug, name, muscle_group, category, difficulty, source_name"


@query("set_upsert_catalogue", f"""
WITH ex AS (SELECT {LIB_COLS} FROM v_library WHERE item_id % 3 <> 1),
inc AS (SELECT item_id, slug, upper(name) AS name, muscle_group, category, 'Advanced' AS difficulty, 'import v2' AS source_name
        FROM v_library WHERE item_id % 3 <> 2)
SELECT * FROM ex WHERE slug NOT IN (SELECT slug FROM inc) UNION ALL SELECT * FROM inc""")
def set_upsert_catalogue(c):
    lib = c.library().select(*LIB_COLS.split(", "))
    ex = lib.filter(F.col("item_id") % 3 != 1)
    inc = lib.filter(F.col("item_id") % 3 != 2).withColumns({"name": F.upper("name"), "difficulty": F.lit("Advanced"),
                                                             "source_name": F.lit("import v2")})
    return MT.replace_by_key(ex, inc, ["slug"])


MEDIA_COLS = "item_id, sort_order, media_type, media_url, source_name"


@query("set_replace_children", f"""
WITH new AS (SELECT item_id, sort_order, media_type, replace(media_url, 'https://', 'https://cdn.') AS media_url, 'reimport' AS source_name
             FROM v_media WHERE item_id % 3 = 0 AND sort_order <= 2)
SELECT {MEDIA_COLS} FROM v_media WHERE item_id NOT IN (SELECT item_id FROM new) UNION ALL SELECT * FROM new""")
def set_replace_children(c):
    m = c.media().select(*MEDIA_COLS.split(", "))
    new = (m.filter((F.col("item_id") % 3 == 0) & (F.col("sort_order") <= 2))
            .withColumns({"media_url": F.replace("media_url", F.lit("https://"), F.lit("https://cdn.")),
                          "source_name": F.lit("reimport")}))
    return MT.replace_children(m, new, "item_id")


@query("set_insert_missing", f"""
WITH ex AS (SELECT {MEDIA_COLS} FROM v_media WHERE sort_order % 2 = 1),
cand AS (SELECT {MEDIA_COLS} FROM v_media)
SELECT * FROM ex UNION ALL SELECT c.* FROM cand c WHERE NOT EXISTS (
  SELECT 1 FROM ex WHERE ex.item_id = c.item_id AND ex.media_url = c.media_url AND ex.source_name = c.source_name)""")
def set_insert_missing(c):
    m = c.media().select(*MEDIA_COLS.split(", "))
    return MT.insert_missing(m.filter(F.col("sort_order") % 2 == 1), m, ["item_id", "media_url", "source_name"])


@query("set_purge_source", f"SELECT {MEDIA_COLS} FROM v_media WHERE source_name IS NULL OR source_name <> 'generated reference'")
def set_purge_source(c):
    return MT.purge_source(c.media().select(*MEDIA_COLS.split(", ")), "generated reference")


@query("join_anti_backfill", """
WITH ex AS (SELECT user_id, exercise, performed_at, weight_kg, reps FROM v_sets WHERE set_id % 3 <> 1),
cand AS (SELECT user_id, exercise, performed_at, weight_kg, reps FROM v_sets WHERE set_id % 3 <> 2)
SELECT * FROM ex UNION ALL SELECT c.* FROM cand c ANTI JOIN ex USING (user_id, exercise, performed_at)""")
def join_anti_backfill(c):
    s = c.sets().select("set_id", "user_id", "exercise", "performed_at", "weight_kg", "reps")
    ex = s.filter(F.col("set_id") % 3 != 1).drop("set_id")
    cand = s.filter(F.col("set_id") % 3 != 2).drop("set_id")
    return MT.insert_missing(ex, cand, ["user_id", "exercise", "performed_at"])


@query("set_template_expand", """
SELECT o.o_orderkey AS template_id, o.o_custkey AS user_id, l.l_linenumber AS exercise_index, p.p_name AS exercise,
  unnest(range(1, CAST(l.l_quantity AS BIGINT) % 5 + 2)) AS set_number, CAST(5 + l.l_linenumber AS INTEGER) AS target_reps,
  floor(p.p_retailprice / 25.0) * 2.5 AS target_weight_kg
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey""")
def set_template_expand(c):
    o, li, p = c.t("orders"), c.t("lineitem"), c.t("part")
    items = (o.join(li, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("p_partkey") == F.col("l_partkey"))
              .select(F.col("o_orderkey").alias("template_id"), F.col("o_custkey").alias("user_id"),
                      F.col("l_linenumber").alias("exercise_index"), F.col("p_name").alias("exercise"),
                      (F.col("l_quantity").cast("long") % 5 + 1).alias("sets"),
                      (F.lit(5) + F.col("l_linenumber")).cast("int").alias("target_reps"),
                      (F.floor(F.col("p_retailprice") / 25.0) * 2.5).alias("target_weight_kg")))
    return MT.expand_sets(items).drop("sets")


def _hash_sql(*parts):
    return f"CAST('0x' || substr(md5({" || '|' || ".join(parts)}), 1, 8) AS BIGINT)"


def _normal_sql(*parts):
    u = [f"(({_hash_sql(repr(side), *parts)} + 0.5) / 4294967296.0)" for side in ("radius", "angle")]
    return f"(sqrt(-2.0 * ln({u[0]})) * cos(2.0 * 3.141592653589793 * {u[1]}))"


SCEN_SQL = f"""
WITH s AS (SELECT gym_id, unnest(range(st, st + INTERVAL 7 DAY, INTERVAL 20 MINUTE)) AS ts FROM (SELECT DISTINCT gym_id FROM v_obs)
           CROSS JOIN (SELECT max(ts) + INTERVAL 20 MINUTE AS st FROM v_obs)),
o AS (SELECT *, isodow(ts) - 1 AS dow, hour(ts) AS h FROM v_obs),
b AS (SELECT gym_id, dow, h, count(*) AS n, avg(active_people) AS m, coalesce(stddev_samp(active_people), 0.0) AS sd FROM o GROUP BY ALL),
gh AS (SELECT gym_id, h, count(*) AS n, avg(active_people) AS m, coalesce(stddev_samp(active_people), 0.0) AS sd FROM o GROUP BY ALL),
r AS (SELECT o.gym_id, o.dow, o.h, o.active_people - b.m AS r,
        row_number() OVER (PARTITION BY o.gym_id, o.dow, o.h ORDER BY ts, seq) - 1 AS i,
        row_number() OVER (PARTITION BY o.gym_id, o.h ORDER BY ts, seq) - 1 AS j FROM o JOIN b USING (gym_id, dow, h)),
s2 AS (SELECT *, isodow(ts) - 1 AS dow, hour(ts) AS h, row_number() OVER (PARTITION BY gym_id ORDER BY ts) - 1 AS step,
         count(*) OVER (PARTITION BY gym_id) AS steps, strftime(ts, '%Y-%m-%d %H:%M:%S') AS w FROM s),
s3 AS (SELECT *, {_hash_sql("'residual'", "gym_id", "w", f"'{FC.SEED}'")} AS pick FROM s2),
p AS (SELECT s3.*, coalesce(b.m, gh.m, a.m) AS mean, coalesce(b.sd, gh.sd, {FC.DEFAULT_PROFILE_STD}) AS sd,
        pick % b.n AS i, CASE WHEN b.n IS NULL THEN pick % gh.n END AS j FROM s3
  LEFT JOIN b ON b.gym_id = s3.gym_id AND b.dow = s3.dow AND b.h = s3.h
  LEFT JOIN gh ON gh.gym_id = s3.gym_id AND gh.h = s3.h CROSS JOIN (SELECT avg(active_people) AS m FROM v_obs) a),
d AS (SELECT p.*, coalesce(x.r, y.r, 0.0) AS r FROM p
  LEFT JOIN r x ON x.gym_id = p.gym_id AND x.dow = p.dow AND x.h = p.h AND x.i = p.i
  LEFT JOIN r y ON y.gym_id = p.gym_id AND y.h = p.h AND y.j = p.j)
SELECT gym_id, ts, CASE WHEN {sql_in_dates('ts', HOLIDAYS.closed)} = 1 OR {sql_open('ts')} = 0 THEN 0
  ELSE CAST(round_even(least(greatest(mean * ({sql_multiplier('ts', HOLIDAYS)})
    * (CASE WHEN month(ts) IN (6, 7, 8) THEN 0.92 WHEN month(ts) IN (10, 11) THEN 1.05 ELSE 1.0 END)
    * (1 + 0.004 * {_normal_sql("'trend'", "gym_id", f"'{FC.SEED}'")} * (step / steps)) + r * 0.35
    + {_normal_sql("'noise'", "gym_id", "w", f"'{FC.SEED}'")} * greatest(1.5, sd * 0.18), 0), 260), 0) AS BIGINT) END AS active_people FROM d"""


@query("ml_scenario_projection", SCEN_SQL)
def ml_scenario_projection(c):
    return FC.scenario_projection(c.obs(), HOLIDAYS)
