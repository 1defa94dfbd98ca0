"""Next-set progression: teacher-forced cases, features and the 8-way policy.

A case is one logged set on any day after the first day of its (user,
exercise).  History = every set of earlier days; the current session = the
earlier sets of the same day.  Nothing recurses, so the whole backtest is:

* a per-(user, exercise, day) table with bounded summaries (count, sums, max,
  the last 12 sets as an array of at most 12 structs);
* a window over *days* (lag, running sums, 12 preceding days' tails);
* a window over the sets of a day (the previous two sets);
* an equi-join for the "matching set" of the latest earlier session.

No array ever holds more than 12 sets, whatever the size of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import ordering

KEYS = ["user_id", "exercise"]
# PR warm-up ramp (ratio, reps_min, reps_max, kind, confidence, strategy) by set position.
PR_RAMP = (
    (0.50, 8, 10, "warmup", 0.55, "pr_ramp_50"),
    (0.70, 4, 6, "warmup", 0.6, "pr_ramp_70"),
    (0.85, 2, 3, "warmup", 0.65, "pr_ramp_85"),
    (1.00, 1, 3, "top", 0.7, "pr_top_set"),
)


def rep_range(mode, lo, hi) -> tuple[Column, Column]:
    """custom: clamp to 1..30 (high >= low); pr: 1..3; otherwise 8..10."""
    m = F.col(mode) if isinstance(mode, str) else mode
    lo_c = F.col(lo) if isinstance(lo, str) else lo
    hi_c = F.col(hi) if isinstance(hi, str) else hi
    clow = F.greatest(F.lit(1), F.least(F.lit(30), lo_c))
    chigh = F.greatest(clow, F.least(F.lit(30), hi_c))
    low = F.when(m == "custom", clow).when(m == "pr", F.lit(1)).otherwise(F.lit(8))
    high = F.when(m == "custom", chigh).when(m == "pr", F.lit(3)).otherwise(F.lit(10))
    return low, high


def cases(sets: DataFrame) -> DataFrame:
    """Sets with their day-level history summaries; only days after the first one per key."""
    s = sets.withColumn("day", F.to_date("performed_at")).withColumn("e1rm", S.epley("weight_kg", "reps"))
    tail_w = Window.partitionBy(*KEYS, "day").orderBy(F.col("performed_at").desc(), F.col("set_index").desc())
    tail = (s.withColumn("_t", F.row_number().over(tail_w)).filter(F.col("_t") <= 12)
             .groupBy(*KEYS, "day").agg(F.sort_array(F.collect_list(F.struct(
                 "performed_at", "set_index", "weight_kg", "reps", "e1rm"))).alias("tail12")))
    days = s.groupBy(*KEYS, "day").agg(
        F.count(F.lit(1)).alias("n"), F.avg("reps").alias("avg_reps"), F.avg("weight_kg").alias("avg_w"),
        F.max("weight_kg").alias("max_w"), F.max("e1rm").alias("max_e1rm"), F.max("performed_at").alias("last_ts")).join(tail, [*KEYS, "day"])
    dw = Window.partitionBy(*KEYS).orderBy("day")
    hist = days.select(
        *KEYS, "day",
        F.lag("day").over(dw).alias("prev_day"), F.lag("n").over(dw).alias("prev_n"),
        F.lag("avg_reps").over(dw).alias("prev_avg_reps"), F.lag("avg_w").over(dw).alias("prev_avg_w"),
        F.lag("max_w").over(dw).alias("prev_max_w"), F.lag("max_e1rm").over(dw).alias("prev_max_e1rm"),
        F.lag("last_ts").over(dw).alias("prev_last_ts"),
        F.lag("tail12").over(dw).alias("prev_tail"),
        F.sum("n").over(dw.rowsBetween(Window.unboundedPreceding, -1)).alias("history_count"),
        F.collect_list("tail12").over(dw.rowsBetween(-12, -1)).alias("_tails"))
    hist = hist.filter(F.col("prev_day").isNotNull()).withColumn("_flat", F.flatten("_tails")).withColumn(
        "recent12", F.when(F.size("_flat") > 12, F.slice("_flat", -12, 12)).otherwise(F.col("_flat"))).drop("_tails", "_flat")
    sw = Window.partitionBy(*KEYS, "day").orderBy("set_index")
    cur = s.select(*KEYS, "day", "set_id", "set_index", "performed_at", "weight_kg", "reps",
                   F.lag("weight_kg").over(sw).alias("prev1_w"), F.lag("reps").over(sw).alias("prev1_r"),
                   F.lag("reps", 2).over(sw).alias("prev2_r"), F.lag("performed_at").over(sw).alias("prev1_ts"),
                   F.first("weight_kg").over(sw).alias("first_w"), F.first("reps").over(sw).alias("first_r"),
                   (F.col("set_index") - 1).alias("current_session_sets"))
    c = cur.join(hist, [*KEYS, "day"])
    prev_sets = s.select(*KEYS, F.col("day").alias("prev_day"), F.col("set_index").alias("_mi"),
                         F.col("weight_kg").alias("matching_weight_kg"), F.col("reps").alias("matching_reps"))
    c = c.withColumn("_mi", F.least(F.col("set_index"), F.col("prev_n")))
    return c.join(prev_sets, [*KEYS, "prev_day", "_mi"]).drop("_mi")


def features(c: DataFrame) -> DataFrame:
    """The 22 feature columns of a case (auto rep mode: range 8..10)."""
    r12 = F.col("recent12")
    n12 = F.size(r12)
    last = F.element_at("prev_tail", -1)
    e1 = F.transform(r12, lambda x: x["e1rm"])
    today = F.coalesce(F.col("prev1_ts"), F.col("prev_last_ts"))
    return c.select(
        *KEYS, "day", "set_id", "set_index", F.lit("auto").alias("preferred_rep_mode"),
        F.lit(8).alias("preferred_rep_min"), F.lit(10).alias("preferred_rep_max"), "history_count",
        last["weight_kg"].alias("latest_weight_kg"), last["reps"].alias("latest_reps"),
        last["set_index"].alias("latest_set_index"), "matching_weight_kg", "matching_reps",
        (F.aggregate(r12, F.lit(0).cast("long"), lambda a, x: a + x["reps"]) / F.greatest(F.lit(1), n12)).alias("avg_recent_reps"),
        (F.aggregate(r12, F.lit(0.0), lambda a, x: a + x["weight_kg"]) / F.greatest(F.lit(1), n12)).alias("avg_recent_weight_kg"),
        F.col("prev_avg_reps").alias("avg_latest_session_reps"), F.col("prev_avg_w").alias("avg_latest_session_weight_kg"),
        F.array_max(F.transform(r12, lambda x: x["weight_kg"])).alias("best_recent_weight_kg"),
        F.array_max(e1).alias("best_recent_e1rm"),
        F.when(n12 >= 2, F.element_at(e1, -1) - F.element_at(e1, 1)).otherwise(F.lit(0.0)).alias("e1rm_trend"),
        F.greatest(F.lit(0.0), (F.unix_micros(today.cast("timestamp")) - F.unix_micros(F.col("prev_last_ts").cast("timestamp")))
                   / 8.64e10).alias("days_since_last"),
        "current_session_sets", F.coalesce("prev1_w", F.lit(0.0)).alias("previous_current_weight_kg"),
        F.coalesce("prev1_r", F.lit(0)).alias("previous_current_reps"),
        F.col("weight_kg").alias("actual_weight_kg"), F.col("reps").alias("actual_reps"))


def policy(c: DataFrame, rep_min: int | Column = 8, rep_max: int | Column = 10, mode: str | Column = "auto") -> DataFrame:
    """The reference decision list, in source order, as one ``when`` chain per output."""
    lo = F.lit(rep_min) if isinstance(rep_min, int) else rep_min
    hi = F.lit(rep_max) if isinstance(rep_max, int) else rep_max
    md = F.lit(mode) if isinstance(mode, str) else mode
    has_prev = F.col("prev1_r").isNotNull()
    drop = F.when(F.col("prev2_r").isNotNull(), F.greatest(F.lit(0), F.col("prev2_r") - F.col("prev1_r"))) \
            .otherwise(F.when(F.col("prev1_r") <= 10, 1).otherwise(0))
    high = F.col("prev1_r") >= 12
    deload = F.col("prev1_r") <= lo
    nxt = F.greatest(lo, F.least(hi, F.col("prev1_r") - F.greatest(F.lit(1), drop)))
    last3 = F.transform(F.slice("prev_tail", -3, 3), lambda x: x["e1rm"])
    last3 = F.when(F.size("prev_tail") >= 3, last3).otherwise(F.transform("prev_tail", lambda x: x["e1rm"]))
    trend = F.when(F.size(last3) >= 2, F.element_at(last3, -1) - F.element_at(last3, 1)).otherwise(F.lit(0.0))
    top_e1rm = F.array_max(last3)
    est_top = S.load_for_reps(top_e1rm, F.greatest(F.lit(1), F.least(F.lit(3), hi)))
    avg = F.col("prev_avg_reps")
    overload = (F.col("set_index") == 1) & (avg >= 10) & (trend >= -1.0)
    backoff = avg < 7
    mclamp = F.greatest(lo, F.least(hi, F.col("matching_reps")))
    ramp_i = F.least(F.greatest(F.lit(0), F.col("set_index") - 1), F.lit(len(PR_RAMP) - 1)) + 1

    def ramp(k):
        return F.element_at(F.array(*[F.lit(r[k]) for r in PR_RAMP]), ramp_i.cast("int"))

    top_w = F.greatest(F.col("prev_max_w"), est_top)
    is_pr = md == "pr"
    strategy = (F.when(has_prev & high, "increase_load_after_high_reps")
                 .when(has_prev & deload, "fatigue_deload").when(has_prev, "same_load_fatigue_adjusted_reps")
                 .when(F.col("prev_tail").isNull(), "cold_start_reps_only")
                 .when(is_pr, ramp(5)).when(overload, "progressive_overload")
                 .when(backoff, "load_backoff").otherwise("repeat_matching_set"))
    weight = (F.when(has_prev & high, S.round_load(F.col("prev1_w") + 2.5))
               .when(has_prev & deload, S.round_load(F.col("prev1_w") - 2.5))
               .when(has_prev, S.round_load(F.col("prev1_w")))
               .when(F.col("prev_tail").isNull(), F.lit(0.0))
               .when(is_pr, S.round_load(top_w * ramp(0)))
               .when(overload, S.load_for_reps(top_e1rm, lo))
               .when(backoff, S.round_load(F.greatest(F.lit(0.0), F.col("matching_weight_kg") - 2.5)))
               .otherwise(S.load_for_reps(S.epley("matching_weight_kg", "matching_reps"), mclamp)))
    pr_reps = F.greatest(ramp(1), F.least(ramp(2), F.bround((ramp(1) + ramp(2)) / 2.0, 0).cast("int")))
    reps = (F.when(has_prev & high, lo).when(has_prev, nxt)
             .when(F.col("prev_tail").isNull(), F.greatest(lo, F.least(hi, F.lit(8))))
             .when(is_pr, pr_reps).when(overload | backoff, lo).otherwise(mclamp))
    rmin = (F.when(has_prev & ~high, F.greatest(lo, nxt - 1)).when(is_pr & ~has_prev & F.col("prev_tail").isNotNull(),
                                                                   ramp(1)).otherwise(lo))
    rmax = (F.when(has_prev & ~high, F.least(hi, nxt + 1)).when(is_pr & ~has_prev & F.col("prev_tail").isNotNull(),
                                                                ramp(2)).otherwise(hi))
    conf = (F.when(has_prev & high, 0.72).when(has_prev, 0.78).when(F.col("prev_tail").isNull(), 0.35)
             .when(is_pr, ramp(4)).when(overload, 0.68).when(backoff, 0.66).otherwise(0.7))
    return c.withColumns({"policy_strategy": strategy, "policy_weight_kg": weight, "policy_reps": reps,
                          "policy_reps_min": rmin, "policy_reps_max": rmax, "policy_confidence": conf})


def backtest(p: DataFrame) -> DataFrame:
    """Weight / reps MAE of the policy over all cases."""
    return p.agg(F.count(F.lit(1)).alias("cases"),
                 F.avg(F.abs(F.col("weight_kg") - F.col("policy_weight_kg"))).alias("weight_mae_kg"),
                 F.avg(F.abs(F.col("reps") - F.col("policy_reps"))).alias("reps_mae"))


def split(p: DataFrame, ratio: float = 0.75) -> DataFrame:
    """Global chronological split: the first ``ratio`` of the cases by (day, exercise, set, user, id) train."""
    placed = ordering.total_order(p, ["day", "exercise", "set_index", "user_id", "set_id"], "case_no")
    total = placed.agg(F.count(F.lit(1)).alias("_total"))
    cut = F.greatest(F.lit(1), F.floor(F.col("_total") * ratio))
    return (placed.crossJoin(F.broadcast(total))  # one row
            .withColumn("is_train", (F.col("case_no") <= cut).cast("int")).drop("_total"))


def evaluate(p: DataFrame) -> DataFrame:
    """Policy MAE / RMSE for weight and reps and the hit rate (actual reps inside the policy range)."""
    we = F.col("weight_kg") - F.greatest(F.lit(0.0), F.col("policy_weight_kg"))
    re = F.col("reps") - F.greatest(F.lit(1), F.col("policy_reps"))
    hit = (F.col("reps") >= F.col("policy_reps_min")) & (F.col("reps") <= F.col("policy_reps_max"))
    return p.agg(F.count(F.lit(1)).alias("cases"), F.avg(F.abs(we)).alias("weight_mae"), F.sqrt(F.avg(we * we)).alias("weight_rmse"),
                 F.avg(F.abs(re)).alias("reps_mae"), F.sqrt(F.avg(re * re)).alias("reps_rmse"),
                 F.avg(hit.cast("double")).alias("reps_hit_rate"))


def next_session(sets: DataFrame, prefs: DataFrame, last_n: int = 6) -> DataFrame:
    """Policy target for the first set of the next session of every (user, exercise), from the
    last ``last_n`` logged sets and the user's rep preference."""
    s = sets.withColumn("e1rm", S.epley("weight_kg", "reps")).withColumn("day", F.to_date("performed_at"))
    w = Window.partitionBy(*KEYS).orderBy(F.col("performed_at").desc(), F.col("set_id").desc())
    last = s.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= last_n)
    last = last.withColumn("_latest", F.max("day").over(Window.partitionBy(*KEYS))).filter(F.col("day") == F.col("_latest"))
    g = last.groupBy(*KEYS).agg(
        F.sort_array(F.collect_list(F.struct("performed_at", "set_index", "weight_kg", "reps", "e1rm"))).alias("prev_tail"),
        F.avg("reps").alias("prev_avg_reps"), F.max("weight_kg").alias("prev_max_w"))
    first1 = F.filter("prev_tail", lambda x: x["set_index"] == 1)
    match = F.when(F.size(first1) > 0, F.element_at(first1, 1)).otherwise(F.element_at("prev_tail", 1))
    g = g.withColumns({"matching_weight_kg": match["weight_kg"], "matching_reps": match["reps"], "set_index": F.lit(1),
                       "prev1_r": F.lit(None).cast("int"), "prev2_r": F.lit(None).cast("int"),
                       "prev1_w": F.lit(None).cast("double")})
    p = prefs.select("user_id", "preferred_rep_mode", "preferred_rep_min", "preferred_rep_max")
    g = g.join(p, "user_id")
    lo, hi = rep_range("preferred_rep_mode", "preferred_rep_min", "preferred_rep_max")
    return policy(g, lo, hi, F.col("preferred_rep_mode"))


def guardrail(p: DataFrame, pred_weight: str, mode: str | Column = "auto", confidence: float = 0.72) -> DataFrame:
    """Model weight rounded to the plate step with policy reps; fall back to the policy for PR
    mode, cold starts and non-positive model weights."""
    md = F.lit(mode) if isinstance(mode, str) else mode
    w = S.round_load(F.col(pred_weight))
    use_model = (md != "pr") & (F.col("policy_strategy") != "cold_start_reps_only") & (w > 0)
    return p.withColumns({
        "final_weight_kg": F.when(use_model, w).otherwise(F.col("policy_weight_kg")),
        "final_reps": F.col("policy_reps"),
        "final_confidence": F.when(use_model, F.least(F.lit(0.86), F.greatest(F.col("policy_confidence"), F.lit(confidence))))
                             .otherwise(F.col("policy_confidence")),
        "final_strategy": F.when(use_model, F.lit("supervised_next_set_regressor")).otherwise(F.col("policy_strategy"))})


def _js_round_load(x: Column, step: float = 2.5) -> Column:
    """Client rounding: ``Math.round`` (half up) to the plate step, at least 0."""
    return F.greatest(F.lit(0.0), F.floor(x / step + 0.5) * step)


def _js_round_down(x: Column, step: float = 2.5) -> Column:
    return F.greatest(F.lit(0.0), F.floor(x / step) * step)


def policy_client(c: DataFrame, low: int = 8, high: int = 10) -> DataFrame:
    """Client-side variant: multi-signal fatigue (low reps, hard rep drop, load drop with
    strength loss), floor rounding for working sets, overload from the best set of the session."""
    lo, hi = F.lit(low), F.lit(high)
    has_prev = F.col("prev1_r").isNotNull()
    drop = F.when(F.col("prev2_r").isNotNull(), F.greatest(F.lit(1), F.col("prev2_r") - F.col("prev1_r"))).otherwise(F.lit(1))
    first_e1 = S.epley("first_w", "first_r")
    prev_e1 = S.epley("prev1_w", "prev1_r")
    strength_drop = F.when(first_e1 > 0, (first_e1 - prev_e1) / first_e1).otherwise(F.lit(0.0))
    acc_drop = (F.col("first_w") - F.col("prev1_w")) >= 2.5
    deload = ((F.col("prev1_r") <= lo) | ((F.col("first_r") - F.col("prev1_r")) >= 2)
              | (acc_drop & ((F.col("prev1_r") <= lo) | (strength_drop >= 0.03))))
    high_reps = F.col("prev1_r") >= 12
    nxt = F.greatest(lo, F.least(hi, F.col("prev1_r") - drop))
    overload = (F.col("set_index") == 1) & (F.col("prev_avg_reps") >= 10)
    t = F.greatest(lo, F.least(hi, F.col("matching_reps")))

    def load_for(e, r):
        return _js_round_load(e / (F.lit(1.0) + F.greatest(F.lit(1), r) / 30.0))
    weight = (F.when(has_prev & high_reps, _js_round_load(F.col("prev1_w") + 2.5))
               .when(has_prev & deload, _js_round_down(F.col("prev1_w") - 2.5))
               .when(has_prev, _js_round_down(F.col("prev1_w")))
               .when(overload, F.greatest(_js_round_load(F.col("prev_max_w")), load_for(F.col("prev_max_e1rm"), lo)))
               .otherwise(load_for(S.epley("matching_weight_kg", "matching_reps"), t)))
    reps = F.when(has_prev & high_reps, lo).when(has_prev, nxt).when(overload, lo).otherwise(t)
    rmin = F.when(has_prev & high_reps, lo).when(has_prev, nxt).when(overload, lo).otherwise(F.greatest(lo, t - 1))
    rmax = (F.when(has_prev & high_reps, hi).when(has_prev, F.least(hi, nxt + 2)).when(overload, hi)
             .otherwise(F.least(hi, t + 1)))
    kind = (F.when(has_prev & high_reps, "increase_after_high_reps").when(has_prev & deload, "fatigue_deload")
             .when(has_prev, "same_session_pattern").when(overload, "session_overload").otherwise("matching_set"))
    return c.withColumns({"client_strategy": kind, "client_weight_kg": weight, "client_reps": reps,
                          "client_reps_min": rmin, "client_reps_max": rmax})


def hybrid_choice(best: DataFrame, holdout: DataFrame) -> DataFrame:
    """``selected, weight_mae, reps_mae, confidence`` from the best ``(mae, model)`` of each target and the policy's
    errors on the holdout: its reps are taken unless a model's are better."""
    pol = holdout.agg(F.avg(F.abs(F.col("reps") - F.col("policy_reps"))).alias("policy_mae"), F.coalesce(F.avg(
        ((F.col("reps") >= F.col("policy_reps_min")) & (F.col("reps") <= F.col("policy_reps_max"))).cast("double")),
        F.lit(0.0)).alias("hit"))
    use_policy = F.col("policy_mae") <= F.col("reps.mae")
    reps = F.when(use_policy, F.col("policy_mae")).otherwise(F.col("reps.mae"))
    score = F.col("weight_kg.mae") + reps * 2.0 - F.col("hit")
    return best.crossJoin(pol).select(  # two one-row aggregates
        F.concat(F.lit("hybrid_"), F.col("weight_kg.model"), F.lit("_weight_"),
                 F.when(use_policy, F.lit("policy")).otherwise(F.col("reps.model")), F.lit("_reps")).alias("selected"),
        F.col("weight_kg.mae").alias("weight_mae"), reps.alias("reps_mae"),
        F.greatest(F.lit(0.55), F.least(F.lit(0.86), 1.0 - score / 25.0)).alias("confidence"))
