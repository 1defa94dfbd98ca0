import datetime as dt

from pyspark.sql import functions as F

from occuspark.functions import scalars as S
from occuspark.operators import progression as P


def _sets(spark, rows):
    return spark.createDataFrame(rows, "set_id long, user_id long, exercise string, weight_kg double, reps int, "
                                       "performed_at timestamp_ntz, set_index int")


def _mk(day, idx, w, r, sid):
    return (sid, 1, "bench", w, r, dt.datetime(2026, 5, day, 10, idx), idx)


def test_round_load_half_even(spark):
    df = spark.createDataFrame([(3.75,), (6.25,), (-4.0,), (101.3,)], "x double")
    out = [r.v for r in df.select(S.round_load("x").alias("v")).collect()]
    assert out == [5.0, 5.0, 0.0, 102.5]  # 1.5 -> 2, 2.5 -> 2 (half-even), clipped at 0


def test_policy_branches(spark):
    rows = [_mk(1, 1, 60.0, 11, 1), _mk(1, 2, 60.0, 12, 2),     # day 1: avg 11.5, rising e1RM -> overload next day
            _mk(2, 1, 62.5, 12, 3), _mk(2, 2, 65.0, 12, 4),     # set 2 follows 12 reps -> increase load
            _mk(2, 3, 65.0, 8, 5), _mk(2, 4, 62.5, 9, 6),       # after 12 reps -> increase; after 8 -> deload
            _mk(3, 1, 40.0, 5, 7),                               # day 3 set 1: day 2 e1RM falls -> repeat matching set
            _mk(4, 1, 40.0, 5, 8)]                               # day 4 set 1: day 3 avg 5 < 7 -> back-off
    p = {r.set_id: r for r in P.policy(P.cases(_sets(spark, rows))).collect()}
    assert p[3].policy_strategy == "progressive_overload"
    assert p[4].policy_strategy == "increase_load_after_high_reps" and p[4].policy_weight_kg == 65.0
    assert p[5].policy_strategy == "increase_load_after_high_reps"
    assert p[6].policy_strategy == "fatigue_deload" and p[6].policy_weight_kg == 62.5
    assert p[7].policy_strategy == "repeat_matching_set" and p[7].policy_reps == 10 and p[7].policy_weight_kg == 65.0
    assert p[8].policy_strategy == "load_backoff" and p[8].policy_weight_kg == 37.5
    assert 1 not in p  # the first day has no history


def test_repeat_matching_and_same_load(spark):
    rows = [_mk(1, 1, 80.0, 8, 1), _mk(1, 2, 80.0, 8, 2), _mk(2, 1, 80.0, 9, 3), _mk(2, 2, 80.0, 11, 4)]
    p = {r.set_id: r for r in P.policy(P.cases(_sets(spark, rows))).collect()}
    assert p[3].policy_strategy == "repeat_matching_set" and p[3].policy_reps == 8
    assert p[4].policy_strategy == "same_load_fatigue_adjusted_reps" and p[4].policy_weight_kg == 80.0


def test_next_session_cold_start_free_and_pr_ramp(spark):
    rows = [_mk(1, 1, 100.0, 5, 1), _mk(1, 2, 100.0, 5, 2)]
    prefs = spark.createDataFrame([(1, "pr", 8, 10)], "user_id long, preferred_rep_mode string, preferred_rep_min int, "
                                                       "preferred_rep_max int")
    r = P.next_session(_sets(spark, rows), prefs).first()
    assert r.policy_strategy == "pr_ramp_50" and (r.policy_reps_min, r.policy_reps_max) == (8, 10)
    # top weight = max(best 100, load for 3 reps from e1RM 116.67 = 105) -> 50 % ramp -> 52.5 kg, reps 9
    assert r.policy_weight_kg == 52.5 and r.policy_reps == 9


def test_epley_and_inverse(spark):
    df = spark.createDataFrame([(100.0, 5)], "w double, r int")
    r = df.select(S.epley("w", "r").alias("e")).first()
    assert abs(r.e - 100.0 * (1 + 5 / 30)) < 1e-9
    r2 = df.select(S.load_for_reps(S.epley("w", "r"), F.lit(5)).alias("l")).first()
    assert r2.l == 100.0
