"""Queries for next-set progression and its scalar helpers (2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import progression as P
from .registry import query


def sql_round_load(x: str) -> str:
    return f"greatest(0.0, round_even(({x}) / 2.5, 0) * 2.5)"


def sql_epley(w: str, r: str) -> str:
    return f"({w} * (1.0 + greatest(1, {r}) / 30.0))"


def sql_load_for(e: str, r: str) -> str:
    return sql_round_load(f"({e}) / (1.0 + greatest(1, {r}) / 30.0)")


CASES_SQL = f"""
s AS (SELECT *, CAST(performed_at AS DATE) AS day, {sql_epley('weight_kg', 'reps')} AS e1rm FROM v_sets),
tails AS (SELECT user_id, exercise, day, list({{'performed_at': performed_at, 'set_index': set_index, 'weight_kg': weight_kg,
            'reps': reps, 'e1rm': e1rm}} ORDER BY performed_at, set_index) AS tail12 FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, exercise, day ORDER BY performed_at DESC, set_index DESC) AS t FROM s)
          WHERE t <= 12 GROUP BY ALL),
days AS (SELECT user_id, exercise, day, count(*) AS n, avg(reps) AS avg_reps, avg(weight_kg) AS avg_w, max(weight_kg) AS max_w,
           max(e1rm) AS max_e1rm, max(performed_at) AS last_ts FROM s GROUP BY ALL),
dj AS (SELECT * FROM days JOIN tails USING (user_id, exercise, day)),
hist AS (SELECT user_id, exercise, day,
           lag(day) OVER w AS prev_day, lag(n) OVER w AS prev_n, lag(avg_reps) OVER w AS prev_avg_reps,
           lag(avg_w) OVER w AS prev_avg_w, lag(max_w) OVER w AS prev_max_w, lag(max_e1rm) OVER w AS prev_max_e1rm,
           lag(last_ts) OVER w AS prev_last_ts,
           lag(tail12) OVER w AS prev_tail,
           sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS history_count,
           flatten(list(tail12) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)) AS flat
         FROM dj WINDOW w AS (PARTITION BY user_id, exercise ORDER BY day)),
h2 AS (SELECT * EXCLUDE (flat), CASE WHEN len(flat) > 12 THEN flat[len(flat) - 11:] ELSE flat END AS recent12
       FROM hist WHERE prev_day IS NOT NULL),
cur AS (SELECT user_id, exercise, day, set_id, set_index, performed_at, weight_kg, reps,
          lag(weight_kg) OVER sw AS prev1_w, lag(reps) OVER sw AS prev1_r, lag(reps, 2) OVER sw AS prev2_r,
          lag(performed_at) OVER sw AS prev1_ts, first_value(weight_kg) OVER sw AS first_w, first_value(reps) OVER sw AS first_r,
          set_index - 1 AS current_session_sets
        FROM s WINDOW sw AS (PARTITION BY user_id, exercise, day ORDER BY set_index)),
c AS (SELECT cur.*, h2.* EXCLUDE (user_id, exercise, day), m.weight_kg AS matching_weight_kg, m.reps AS matching_reps
      FROM cur JOIN h2 USING (user_id, exercise, day)
      JOIN s m ON m.user_id = cur.user_id AND m.exercise = cur.exercise AND m.day = h2.prev_day
        AND m.set_index = least(cur.set_index, h2.prev_n))"""

RAMP = P.PR_RAMP


def policy_sql(src: str, lo: str = "8", hi: str = "10", mode: str = "'auto'") -> str:
    """The policy decision list in DuckDB SQL over a case relation ``src``."""
    def ramp(k):
        vals = ", ".join(repr(r[k]) if not isinstance(r[k], str) else f"'{r[k]}'" for r in RAMP)
        return f"[{vals}][least(greatest(0, set_index - 1), {len(RAMP) - 1}) + 1]"
    has_tail = "prev_tail IS NOT NULL"
    is_pr = f"({mode}) = 'pr'"
    top_w = f"greatest(prev_max_w, {sql_load_for('top_e1rm', f'greatest(1, least(3, {hi}))')})"
    pr_reps = f"greatest({ramp(1)}, least({ramp(2)}, CAST(round_even(({ramp(1)} + {ramp(2)}) / 2.0, 0) AS INTEGER)))"
    return f"""
p0 AS (SELECT *, {lo} AS lo, {hi} AS hi, prev1_r IS NOT NULL AS has_prev,
         CASE WHEN prev2_r IS NOT NULL THEN greatest(0, prev2_r - prev1_r) WHEN prev1_r <= 10 THEN 1 ELSE 0 END AS fdrop,
         list_transform(CASE WHEN len(prev_tail) >= 3 THEN prev_tail[len(prev_tail) - 2:] ELSE prev_tail END, lambda x: x.e1rm) AS last3
       FROM {src}),
p1 AS (SELECT *, greatest(lo, least(hi, prev1_r - greatest(1, fdrop))) AS nxt,
         CASE WHEN len(last3) >= 2 THEN last3[len(last3)] - last3[1] ELSE 0.0 END AS trend, list_max(last3) AS top_e1rm,
         greatest(lo, least(hi, matching_reps)) AS mclamp FROM p0),
p2 AS (SELECT *, (set_index = 1 AND prev_avg_reps >= 10 AND trend >= -1.0) AS overload, prev_avg_reps < 7 AS backoff FROM p1),
pol AS (SELECT *,
  CASE WHEN has_prev AND prev1_r >= 12 THEN 'increase_load_after_high_reps' WHEN has_prev AND prev1_r <= lo THEN 'fatigue_deload'
       WHEN has_prev THEN 'same_load_fatigue_adjusted_reps' WHEN NOT ({has_tail}) THEN 'cold_start_reps_only'
       WHEN {is_pr} THEN {ramp(5)} WHEN overload THEN 'progressive_overload'
       WHEN backoff THEN 'load_backoff' ELSE 'repeat_matching_set' END AS policy_strategy,
  CASE WHEN has_prev AND prev1_r >= 12 THEN {sql_round_load('prev1_w + 2.5')}
       WHEN has_prev AND prev1_r <= lo THEN {sql_round_load('prev1_w - 2.5')}
       WHEN has_prev THEN {sql_round_load('prev1_w')} WHEN NOT ({has_tail}) THEN 0.0
       WHEN {is_pr} THEN {sql_round_load(f'{top_w} * {ramp(0)}')}
       WHEN overload THEN {sql_load_for('top_e1rm', 'lo')}
       WHEN backoff THEN {sql_round_load('greatest(0.0, matching_weight_kg - 2.5)')}
       ELSE {sql_load_for(sql_epley('matching_weight_kg', 'matching_reps'), 'mclamp')} END AS policy_weight_kg,
  CASE WHEN has_prev AND prev1_r >= 12 THEN lo WHEN has_prev THEN nxt WHEN NOT ({has_tail}) THEN greatest(lo, least(hi, 8))
       WHEN {is_pr} THEN {pr_reps} WHEN overload OR backoff THEN lo ELSE mclamp END AS policy_reps,
  CASE WHEN has_prev AND prev1_r < 12 THEN greatest(lo, nxt - 1) WHEN NOT has_prev AND {has_tail} AND {is_pr} THEN {ramp(1)} ELSE lo END AS policy_reps_min,
  CASE WHEN has_prev AND prev1_r < 12 THEN least(hi, nxt + 1) WHEN NOT has_prev AND {has_tail} AND {is_pr} THEN {ramp(2)} ELSE hi END AS policy_reps_max,
  CASE WHEN has_prev AND prev1_r >= 12 THEN 0.72 WHEN has_prev THEN 0.78 WHEN NOT ({has_tail}) THEN 0.35
       WHEN {is_pr} THEN {ramp(4)} WHEN overload THEN 0.68 WHEN backoff THEN 0.66 ELSE 0.7 END AS policy_confidence
  FROM p2)"""


POLICY_SQL = policy_sql("c")


def _w(*parts):
    return "WITH " + ",\n".join(parts) + "\n"


def _cases(c):
    return c._memo("pg_cases", lambda: P.cases(c.sets()))


def _policy(c):
    return c._memo("pg_policy", lambda: P.policy(_cases(c)))


@query("pg_cases", _w(CASES_SQL) + "SELECT user_id, exercise, day, set_id, set_index, weight_kg, reps, history_count FROM c")
def pg_cases(c):
    return _cases(c).select("user_id", "exercise", "day", "set_id", "set_index", "weight_kg", "reps", "history_count")


@query("pg_matching_set", _w(CASES_SQL) + "SELECT set_id, prev_day, prev_n, matching_weight_kg, matching_reps FROM c")
def pg_matching_set(c):
    return _cases(c).select("set_id", "prev_day", "prev_n", "matching_weight_kg", "matching_reps")


FEATURE_SQL = f"""
SELECT user_id, exercise, day, set_id, set_index, 'auto' AS preferred_rep_mode, 8 AS preferred_rep_min, 10 AS preferred_rep_max,
  history_count, prev_tail[len(prev_tail)].weight_kg AS latest_weight_kg, prev_tail[len(prev_tail)].reps AS latest_reps,
  prev_tail[len(prev_tail)].set_index AS latest_set_index, matching_weight_kg, matching_reps,
  list_sum(list_transform(recent12, lambda x: x.reps)) / greatest(1, len(recent12)) AS avg_recent_reps,
  list_sum(list_transform(recent12, lambda x: x.weight_kg)) / greatest(1, len(recent12)) AS avg_recent_weight_kg,
  prev_avg_reps AS avg_latest_session_reps, prev_avg_w AS avg_latest_session_weight_kg,
  list_max(list_transform(recent12, lambda x: x.weight_kg)) AS best_recent_weight_kg,
  list_max(list_transform(recent12, lambda x: x.e1rm)) AS best_recent_e1rm,
  CASE WHEN len(recent12) >= 2 THEN recent12[len(recent12)].e1rm - recent12[1].e1rm ELSE 0.0 END AS e1rm_trend,
  greatest(0.0, (epoch_us(coalesce(prev1_ts, prev_last_ts)) - epoch_us(prev_last_ts)) / CAST(8.64e10 AS DOUBLE)) AS days_since_last,
  current_session_sets, coalesce(prev1_w, 0.0) AS previous_current_weight_kg, coalesce(prev1_r, 0) AS previous_current_reps,
  weight_kg AS actual_weight_kg, reps AS actual_reps FROM c"""


@query("pg_features", _w(CASES_SQL) + FEATURE_SQL)
def pg_features(c):
    return P.features(_cases(c))


POLICY_COLS = "policy_strategy, policy_weight_kg, policy_reps, policy_reps_min, policy_reps_max, policy_confidence"


@query("pg_policy", _w(CASES_SQL, POLICY_SQL) + f"SELECT user_id, exercise, day, set_id, set_index, {POLICY_COLS} FROM pol")
def pg_policy(c):
    return _policy(c).select("user_id", "exercise", "day", "set_id", "set_index", *POLICY_COLS.split(", "))


@query("pg_backtest", _w(CASES_SQL, POLICY_SQL) + """
SELECT count(*) AS cases, avg(abs(weight_kg - policy_weight_kg)) AS weight_mae_kg, avg(abs(reps - policy_reps)) AS reps_mae FROM pol""")
def pg_backtest(c):
    return P.backtest(_policy(c))


@query("agg_strategy_counts", _w(CASES_SQL, POLICY_SQL) + "SELECT policy_strategy AS strategy, count(*) AS cases FROM pol GROUP BY ALL")
def agg_strategy_counts(c):
    return _policy(c).groupBy(F.col("policy_strategy").alias("strategy")).agg(F.count(F.lit(1)).alias("cases"))


SPLIT_SQL = """
sp AS (SELECT pol.*, row_number() OVER (ORDER BY day, exercise, set_index, user_id, set_id) AS case_no,
         count(*) OVER () AS total FROM pol),
spl AS (SELECT *, CAST(case_no <= greatest(1, floor(total * CAST(0.75 AS DOUBLE))) AS INTEGER) AS is_train FROM sp)"""


@query("pg_split", _w(CASES_SQL, POLICY_SQL, SPLIT_SQL) + "SELECT set_id, case_no, is_train FROM spl")
def pg_split(c):
    return P.split(_policy(c)).select("set_id", "case_no", "is_train")


@query("pg_eval", _w(CASES_SQL, POLICY_SQL, SPLIT_SQL) + """
SELECT count(*) AS cases, avg(abs(weight_kg - greatest(0.0, policy_weight_kg))) AS weight_mae,
  sqrt(avg(pow(weight_kg - greatest(0.0, policy_weight_kg), 2))) AS weight_rmse,
  avg(abs(reps - greatest(1, policy_reps))) AS reps_mae, sqrt(avg(pow(reps - greatest(1, policy_reps), 2))) AS reps_rmse,
  avg(CASE WHEN reps >= policy_reps_min AND reps <= policy_reps_max THEN 1.0 ELSE 0.0 END) AS reps_hit_rate
FROM spl WHERE is_train = 0""")
def pg_eval(c):
    return P.evaluate(P.split(_policy(c)).filter("is_train = 0"))


@query("pg_prediction_sample", _w(CASES_SQL, POLICY_SQL, SPLIT_SQL) + """
SELECT case_no, set_id, weight_kg AS actual_weight_kg, reps AS actual_reps, policy_weight_kg, policy_reps
FROM spl WHERE is_train = 0 ORDER BY case_no LIMIT 120""")
def pg_prediction_sample(c):
    s = P.split(_policy(c)).filter("is_train = 0")
    return s.orderBy("case_no").limit(120).select(
        "case_no", "set_id", F.col("weight_kg").alias("actual_weight_kg"), F.col("reps").alias("actual_reps"),
        "policy_weight_kg", "policy_reps")


@query("fn_epley", f"SELECT set_id, {sql_epley('weight_kg', 'reps')} AS e1rm FROM v_sets")
def fn_epley(c):
    return c.sets().select("set_id", S.epley("weight_kg", "reps").alias("e1rm"))


@query("fn_round_load", f"""
SELECT set_id, {sql_round_load('weight_kg * 1.1 + (set_id % 4) * 0.625')} AS nearest,
  greatest(0.0, floor((weight_kg * 1.1 + (set_id % 4) * 0.625) / 2.5) * 2.5) AS floored FROM v_sets""")
def fn_round_load(c):
    x = F.col("weight_kg") * 1.1 + (F.col("set_id") % 4) * 0.625
    return c.sets().select("set_id", S.round_load(x).alias("nearest"), S.round_load(x, floor=True).alias("floored"))


@query("fn_load_for_reps", f"SELECT set_id, {sql_load_for(sql_epley('weight_kg', 'reps'), '1 + set_id % 12')} AS load FROM v_sets")
def fn_load_for_reps(c):
    return c.sets().select("set_id", S.load_for_reps(S.epley("weight_kg", "reps"), 1 + F.col("set_id") % 12).alias("load"))


@query("fn_rep_range", """
SELECT user_id, CASE WHEN preferred_rep_mode = 'custom' THEN greatest(1, least(30, preferred_rep_min))
  WHEN preferred_rep_mode = 'pr' THEN 1 ELSE 8 END AS rep_low,
  CASE WHEN preferred_rep_mode = 'custom' THEN greatest(greatest(1, least(30, preferred_rep_min)), least(30, preferred_rep_max))
  WHEN preferred_rep_mode = 'pr' THEN 3 ELSE 10 END AS rep_high FROM v_prefs_full""")
def fn_rep_range(c):
    lo, hi = P.rep_range("preferred_rep_mode", "preferred_rep_min", "preferred_rep_max")
    return c.prefs_full().select("user_id", lo.alias("rep_low"), hi.alias("rep_high"))


NEXT_SQL = f"""
s AS (SELECT *, CAST(performed_at AS DATE) AS day, {sql_epley('weight_kg', 'reps')} AS e1rm FROM v_sets),
l6 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, exercise ORDER BY performed_at DESC, set_id DESC) AS rn FROM s)
       WHERE rn <= 6),
l6d AS (SELECT * FROM (SELECT *, max(day) OVER (PARTITION BY user_id, exercise) AS latest FROM l6) WHERE day = latest),
g AS (SELECT user_id, exercise, list({{'performed_at': performed_at, 'set_index': set_index, 'weight_kg': weight_kg, 'reps': reps,
        'e1rm': e1rm}} ORDER BY performed_at, set_index) AS prev_tail, avg(reps) AS prev_avg_reps, max(weight_kg) AS prev_max_w
      FROM l6d GROUP BY ALL),
ns AS (SELECT g.*, coalesce(list_filter(prev_tail, lambda x: x.set_index = 1)[1], prev_tail[1]).weight_kg AS matching_weight_kg,
         coalesce(list_filter(prev_tail, lambda x: x.set_index = 1)[1], prev_tail[1]).reps AS matching_reps, 1 AS set_index,
         NULL::INTEGER AS prev1_r, NULL::INTEGER AS prev2_r, NULL::DOUBLE AS prev1_w, pf.preferred_rep_mode,
         CASE WHEN pf.preferred_rep_mode = 'custom' THEN greatest(1, least(30, pf.preferred_rep_min))
              WHEN pf.preferred_rep_mode = 'pr' THEN 1 ELSE 8 END AS rlo,
         CASE WHEN pf.preferred_rep_mode = 'custom' THEN greatest(greatest(1, least(30, pf.preferred_rep_min)), least(30, pf.preferred_rep_max))
              WHEN pf.preferred_rep_mode = 'pr' THEN 3 ELSE 10 END AS rhi
       FROM g JOIN v_prefs_full pf USING (user_id))"""


def _next(c):
    return P.next_session(c.sets(), c.prefs_full())


@query("pg_next_session", _w(NEXT_SQL, policy_sql("ns", "rlo", "rhi", "preferred_rep_mode"))
       + f"SELECT user_id, exercise, preferred_rep_mode, {POLICY_COLS} FROM pol")
def pg_next_session(c):
    return _next(c).select("user_id", "exercise", "preferred_rep_mode", *POLICY_COLS.split(", "))


@query("pg_pr_ramp", _w(NEXT_SQL.replace("1 AS set_index", "unnest([1, 2, 3, 4, 5]) AS set_index"),
                        policy_sql("ns", "1", "3", "'pr'"))
       + f"SELECT user_id, exercise, set_index, {POLICY_COLS} FROM pol")
def pg_pr_ramp(c):
    g = _next(c).drop(*POLICY_COLS.split(", ")).drop("set_index")
    g = g.withColumn("set_index", F.explode(F.array(*[F.lit(i) for i in range(1, 6)])))
    return P.policy(g, 1, 3, "pr").select("user_id", "exercise", "set_index", *POLICY_COLS.split(", "))


@query("pg_guardrail", _w(CASES_SQL, POLICY_SQL) + f"""
SELECT set_id, CASE WHEN policy_strategy <> 'cold_start_reps_only' AND {sql_round_load('pw')} > 0 THEN {sql_round_load('pw')}
  ELSE policy_weight_kg END AS final_weight_kg, policy_reps AS final_reps,
  CASE WHEN policy_strategy <> 'cold_start_reps_only' AND {sql_round_load('pw')} > 0 THEN least(0.86, greatest(policy_confidence, 0.72))
  ELSE policy_confidence END AS final_confidence,
  CASE WHEN policy_strategy <> 'cold_start_reps_only' AND {sql_round_load('pw')} > 0 THEN 'supervised_next_set_regressor'
  ELSE policy_strategy END AS final_strategy
FROM (SELECT *, list_sum(list_transform(recent12, lambda x: x.weight_kg)) / greatest(1, len(recent12)) - 20.0 AS pw FROM pol)""")
def pg_guardrail(c):
    # The "model" here is the recent mean load minus 20 kg, so both the model and the fallback paths occur.
    p = _policy(c)
    r12 = F.col("recent12")
    pw = F.aggregate(r12, F.lit(0.0), lambda a, x: a + x["weight_kg"]) / F.greatest(F.lit(1), F.size(r12)) - 20.0
    g = P.guardrail(p.withColumn("pw", pw), "pw")
    return g.select("set_id", "final_weight_kg", "final_reps", "final_confidence", "final_strategy")


def _jsr(x):
    return f"greatest(0.0, floor(({x}) / 2.5 + 0.5) * 2.5)"


def _jsd(x):
    return f"greatest(0.0, floor(({x}) / 2.5) * 2.5)"


CLIENT_SQL = f"""
k0 AS (SELECT *, prev1_r IS NOT NULL AS has_prev,
         CASE WHEN prev2_r IS NOT NULL THEN greatest(1, prev2_r - prev1_r) ELSE 1 END AS sdrop,
         {sql_epley('first_w', 'first_r')} AS fe1, {sql_epley('prev1_w', 'prev1_r')} AS pe1,
         greatest(8, least(10, matching_reps)) AS t FROM c),
k1 AS (SELECT *, greatest(8, least(10, prev1_r - sdrop)) AS nxt,
         (prev1_r <= 8) OR (first_r - prev1_r >= 2) OR ((first_w - prev1_w >= 2.5)
           AND (prev1_r <= 8 OR (CASE WHEN fe1 > 0 THEN (fe1 - pe1) / fe1 ELSE 0.0 END) >= 0.03)) AS deload,
         (set_index = 1 AND prev_avg_reps >= 10) AS overload FROM k0)
SELECT user_id, exercise, day, set_id, set_index,
  CASE WHEN has_prev AND prev1_r >= 12 THEN 'increase_after_high_reps' WHEN has_prev AND deload THEN 'fatigue_deload'
       WHEN has_prev THEN 'same_session_pattern' WHEN overload THEN 'session_overload' ELSE 'matching_set' END AS client_strategy,
  CASE WHEN has_prev AND prev1_r >= 12 THEN {_jsr('prev1_w + 2.5')} WHEN has_prev AND deload THEN {_jsd('prev1_w - 2.5')}
       WHEN has_prev THEN {_jsd('prev1_w')}
       WHEN overload THEN greatest({_jsr('prev_max_w')}, {_jsr('prev_max_e1rm / (1.0 + greatest(1, 8) / 30.0)')})
       ELSE {_jsr(sql_epley('matching_weight_kg', 'matching_reps') + ' / (1.0 + greatest(1, t) / 30.0)')} END AS client_weight_kg,
  CASE WHEN has_prev AND prev1_r >= 12 THEN 8 WHEN has_prev THEN nxt WHEN overload THEN 8 ELSE t END AS client_reps,
  CASE WHEN has_prev AND prev1_r >= 12 THEN 8 WHEN has_prev THEN nxt WHEN overload THEN 8 ELSE greatest(8, t - 1) END AS client_reps_min,
  CASE WHEN has_prev AND prev1_r >= 12 THEN 10 WHEN has_prev THEN least(10, nxt + 2) WHEN overload THEN 10 ELSE least(10, t + 1) END AS client_reps_max
FROM k1"""


@query("pg_policy_client", _w(CASES_SQL, CLIENT_SQL.split("SELECT user_id, exercise, day, set_id")[0].rstrip().rstrip(","))
       + "SELECT user_id, exercise, day, set_id" + CLIENT_SQL.split("SELECT user_id, exercise, day, set_id")[1])
def pg_policy_client(c):
    p = P.policy_client(_cases(c))
    return p.select("user_id", "exercise", "day", "set_id", "set_index", "client_strategy", "client_weight_kg", "client_reps",
                    "client_reps_min", "client_reps_max")
