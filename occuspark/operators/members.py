"""Member analytics for all users in one job.

Per-user request handlers of the reference become grouped aggregates over
every user; "n-th event" and "first crossing" rules are bounded per-user
windows.  Nothing is collected per user beyond a fixed number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import scalars
from ..session import ensure_checkpoint_dir
from . import series

# Preference defaults for users without a stored row.
PREF_DEFAULTS = {
    "preferred_min_hour": 9, "preferred_max_hour": 17, "max_crowd_people": 45.0,
    "weekly_goal_sessions": 3, "preferred_weekdays_text": "0,2,4", "off_peak_bonus_enabled": 1,
    "preferred_gym_id": "gym_008", "preferred_rep_mode": "auto", "preferred_rep_min": 8, "preferred_rep_max": 10,
}


def preferences(users: DataFrame, prefs: DataFrame) -> DataFrame:
    """Stored preferences with defaults for unknown users; weekdays parsed to ``ARRAY<INT>``."""
    p = users.select("user_id").distinct().join(prefs, "user_id", "left")
    cols = {k: F.coalesce(F.col(k), F.lit(v)) for k, v in PREF_DEFAULTS.items()}
    p = p.withColumns(cols)
    return p.withColumn("preferred_weekdays", scalars.parse_weekdays(F.col("preferred_weekdays_text")))


def _day(ts: str) -> Column:
    return F.to_date(F.col(ts))


def gamification(sets: DataFrame, prefs: DataFrame) -> DataFrame:
    """Weekly sessions, streak, consistency %, off-peak points x10 and level per user."""
    days = sets.select("user_id", _day("performed_at").alias("day")).distinct()
    latest = days.groupBy("user_id").agg(F.max("day").alias("latest"))
    weekly = (days.join(latest, "user_id").groupBy("user_id")
                  .agg(F.count(F.when(F.col("day") >= F.date_sub("latest", 6), 1)).alias("weekly_sessions")))
    streak = series.current_streak(days, "user_id", "day", "current_streak_days")
    p = prefs.select("user_id", "weekly_goal_sessions", "off_peak_bonus_enabled", "preferred_min_hour",
                     "preferred_max_hour")
    fh = cal.fractional_hour("performed_at")
    bonus = (sets.join(p.select("user_id", "preferred_min_hour", "preferred_max_hour", "off_peak_bonus_enabled"),
                       "user_id")
                 .groupBy("user_id").agg(F.count(F.when(
                     (F.col("off_peak_bonus_enabled") == 1) & (fh >= F.col("preferred_min_hour"))
                     & (fh < F.col("preferred_max_hour")), 1)).alias("_bonus")))
    out = (p.join(weekly, "user_id", "left").join(streak, "user_id", "left").join(bonus, "user_id", "left")
            .fillna(0, ["weekly_sessions", "current_streak_days", "_bonus"]))
    score = F.least(F.lit(100.0), F.col("weekly_sessions") / F.col("weekly_goal_sessions") * 100.0)
    return out.select("user_id", "weekly_goal_sessions", "weekly_sessions", "current_streak_days",
                      score.alias("consistency_score"), (F.col("_bonus") * 10).alias("off_peak_bonus_points"),
                      F.when(score >= 75, "Consistent Builder").otherwise("Momentum Starter").alias("level"))


def offpeak_visit(checked_in_at: str = "checked_in_at", crowd: str = "active_people_at_checkin") -> Column:
    """Achievement rule: 10 <= hour < 16 or crowd <= 45."""
    h = F.hour(F.col(checked_in_at))
    return ((h >= 10) & (h < 16)) | (F.col(crowd) <= 45)


# Achievement catalogue (id, code, target).
ACHIEVEMENTS = (
    (1, "consistency_builder", 4.0), (2, "off_peak_hero", 5.0), (3, "strength_master", 20.0),
    (4, "template_operator", 3.0), (5, "volume_builder", 50000.0), (6, "bench_milestone", 100.0),
    (7, "exercise_explorer", 6.0), (8, "set_specialist", 3.0), (9, "attendance_base", 3.0),
    (10, "secret_forecast", 1.0),
)


def tagged_events(sets: DataFrame, visits: DataFrame, templates: DataFrame, core_lifts, bench: str) -> DataFrame:
    """Sets, visits and templates as one stream ``user_id, rule, ts, id, amount, item``: an event once for each
    rule it counts for, with what it adds.  Rule 0 is every set.  Each fact table is read once."""
    ex = F.lower("exercise")
    of_set = F.array(F.struct(F.lit(0).alias("rule"), F.lit(1.0).alias("amount")),
                     F.struct(F.when(ex.isin(*[x.lower() for x in core_lifts]), 3).alias("rule"), F.lit(1.0).alias("amount")),
                     F.struct(F.lit(5).alias("rule"), (F.col("weight_kg") * F.col("reps")).cast("double").alias("amount")),
                     F.struct(F.when(ex == bench.lower(), 6).alias("rule"), F.col("weight_kg").cast("double").alias("amount")),
                     F.struct(F.when(F.coalesce("modifiers_json", F.lit("{}")) != "{}", 8).alias("rule"), F.lit(1.0).alias("amount")))
    of_visit = F.array(F.struct(F.lit(9).alias("rule"), F.lit(1.0).alias("amount")),
                       F.struct(F.when(offpeak_visit(), 2).alias("rule"), F.lit(1.0).alias("amount")))
    of_template = F.array(F.struct(F.lit(4).alias("rule"), F.lit(1.0).alias("amount")))

    def tagged(df: DataFrame, ts: str, key: str, rules, item) -> DataFrame:
        return (df.select("user_id", F.col(ts).cast("timestamp_ntz").alias("ts"), F.col(key).cast("long").alias("id"),
                          item.alias("item"), F.explode(rules).alias("x")).where(F.col("x.rule").isNotNull())
                .select("user_id", F.col("x.rule").alias("rule"), "ts", "id", F.col("x.amount").alias("amount"), "item"))

    none = F.lit(None).cast("string")
    return (tagged(sets, "performed_at", "set_id", of_set, F.col("exercise"))
            .unionByName(tagged(visits, "checked_in_at", "visit_id", of_visit, none))
            .unionByName(tagged(templates, "created_at", "template_id", of_template, none)))


def achievements(users: DataFrame, sets: DataFrame, visits: DataFrame, templates: DataFrame,
                 core_lifts=("barbell bench press", "back squat", "incline dumbbell press", "lat pulldown"),
                 bench="barbell bench press", targets: dict | None = None) -> DataFrame:
    """Ten achievement rules x user: progress (capped at target), target, unlocked_at.

    All rules are counters over one stream of tagged events (written once): day sums give
    the totals and the day on which a counter crosses its target, and only the events of
    those days are put in order.  ``targets`` overrides catalogue targets by code (the
    explorer rule needs as many distinct exercises as the data has).
    """
    tg = {code: t for _, code, t in ACHIEVEMENTS}
    tg.update(targets or {})
    goal = {aid: float(tg[code]) for aid, code, _ in ACHIEVEMENTS}
    counters = (2, 3, 4, 5, 8, 9)
    ensure_checkpoint_dir(sets.sparkSession)
    events = tagged_events(sets, visits, templates, core_lifts, bench).withColumn("day", F.to_date("ts")).checkpoint()
    days = events.groupBy("user_id", "rule", "day").agg(F.sum("amount").alias("s"), F.max("ts").alias("last"))
    line = Window.partitionBy("user_id", "rule").orderBy("day")  # a user's days
    target = F.element_at(F.create_map(*[x for r in counters for x in (F.lit(r), F.lit(goal[r]))]), F.col("rule"))
    run = days.where(F.col("rule").isin(*counters)).withColumns({
        "before": F.coalesce(F.sum("s").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), "goal": target})
    cross = run.where((F.col("before") < F.col("goal")) & (F.col("before") + F.col("s") >= F.col("goal")))
    inside = Window.partitionBy("user_id", "rule", "day").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    reached = (events.join(cross.select("user_id", "rule", "day", "before", "goal"), ["user_id", "rule", "day"])
               .withColumn("upto", F.col("before") + F.sum("amount").over(inside)).where(F.col("upto") >= F.col("goal"))
               .groupBy("user_id", "rule").agg(F.min("ts").alias("u")))
    none, no_p = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("double")

    def part(df: DataFrame, rule, p=no_p, u=none, last=none) -> DataFrame:
        return df.select("user_id", rule.alias("rule"), p.alias("p"), u.alias("u"), last.alias("last"))

    by_user = Window.partitionBy("user_id")
    sessions = (days.where("rule = 0").withColumns({"latest": F.max("day").over(by_user),
                                                    "place": F.row_number().over(by_user.orderBy("day"))})
                .groupBy("user_id").agg(F.count(F.when(F.col("day") >= F.date_sub("latest", 6), 1)).cast("double").alias("p"),
                                        F.max(F.when(F.col("place") == int(goal[1]), F.col("last"))).alias("u")))
    top = events.where("rule = 6").groupBy("user_id").agg(
        F.max("amount").alias("p"), F.min(F.when(F.col("amount") >= goal[6], F.col("ts"))).alias("u"))
    firsts = events.where("rule = 0 AND item IS NOT NULL").groupBy("user_id", "item").agg(F.min("ts").alias("ts"))
    explored = firsts.groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("p"),
                                             F.sort_array(F.collect_list("ts")).alias("a"))  # a user's distinct exercises
    long = (part(days.groupBy("user_id", "rule").agg(F.sum("s").alias("p"), F.max("last").alias("last")).where("rule <> 6"),
                 F.col("rule"), F.col("p"), none, F.col("last"))
            .unionByName(part(reached, F.col("rule"), no_p, F.col("u")))
            .unionByName(part(sessions, F.lit(1), F.col("p"), F.col("u")))
            .unionByName(part(top, F.lit(6), F.col("p"), F.col("u")))
            .unionByName(part(explored, F.lit(7), F.col("p"), F.get("a", F.lit(int(goal[7]) - 1)))))
    rule = F.col("rule")
    wide = long.groupBy("user_id").agg(
        *[F.max(F.when(rule == r, F.col("p"))).alias(f"p{r}") for r in range(1, 10)],
        *[F.max(F.when(rule == r, F.col("u"))).alias(f"u{r}") for r in range(1, 10)],
        F.max(F.when(rule.isin(0, 9), F.col("last"))).alias("_latest_activity"))
    wide = users.select("user_id").distinct().join(wide, "user_id", "left")
    rows = []
    for aid, code, _ in ACHIEVEMENTS:
        p = F.coalesce(F.col(f"p{aid}"), F.lit(0.0)) if aid != 10 else F.lit(0.0)
        u = F.col(f"u{aid}") if aid != 10 else none
        t = F.lit(goal[aid])
        rows.append(F.struct(F.lit(aid).alias("id"), F.lit(code).alias("code"), F.least(p, t).alias("progress"),
                             t.alias("target"),
                             F.when(p >= t, F.coalesce(u, F.col("_latest_activity"))).alias("unlocked_at")))
    return wide.select("user_id", F.inline(F.array(*rows)))


def activity(visits: DataFrame, sets: DataFrame, templates: DataFrame, ach: DataFrame,
             last_visits: int = 100, shown_visits: int = 5, shown_sets: int = 600) -> DataFrame:
    """Counts, unlocked achievements, the off-peak share (hour rule) of the latest visits, and the ids of the latest
    ``shown_visits`` visits and ``shown_sets`` sets, newest first."""
    def latest(df: DataFrame, ts: str, key: str, n: int) -> DataFrame:
        w = Window.partitionBy("user_id").orderBy(F.col(ts).desc(), F.col(key).desc())
        return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)

    def ids(key: str, n: int) -> Column:
        shown = F.sort_array(F.collect_list(F.when(F.col("_rn") <= n, F.struct("_rn", F.col(key).cast("string").alias("id")))))
        return F.array_join(F.transform(shown, lambda x: x["id"]), ",")

    h = F.hour("checked_in_at")
    v = latest(visits, "checked_in_at", "visit_id", last_visits).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("visits"), F.count(F.when((h >= 10) & (h < 16), 1)).alias("_off"),
        ids("visit_id", shown_visits).alias("recent_visits"))
    s = sets.groupBy("user_id").agg(F.count(F.lit(1)).alias("logged_sets"))
    r = latest(sets, "performed_at", "set_id", shown_sets).groupBy("user_id").agg(
        ids("set_id", shown_sets).alias("recent_workouts"))
    t = templates.groupBy("user_id").agg(F.count(F.lit(1)).alias("templates"))
    a = ach.groupBy("user_id").agg(F.count(F.col("unlocked_at")).alias("achievements_unlocked"))
    out = a.join(v, "user_id", "left").join(s, "user_id", "left").join(r, "user_id", "left").join(t, "user_id", "left") \
           .fillna(0, ["visits", "_off", "logged_sets", "templates"]).fillna("", ["recent_visits", "recent_workouts"])
    share = F.when(F.col("visits") > 0, F.col("_off") / F.col("visits") * 100).otherwise(F.lit(0.0))
    return out.select("user_id", "visits", "logged_sets", "templates", "achievements_unlocked",
                      share.alias("off_peak_visit_share"), "recent_visits", "recent_workouts")


def exercise_progress(sets: DataFrame) -> DataFrame:
    """Sets, best weight, volume and last date per (user, exercise)."""
    return sets.groupBy("user_id", "exercise").agg(
        F.count(F.lit(1)).alias("sets"), F.max("weight_kg").alias("best_weight_kg"),
        F.sum(F.col("weight_kg") * F.col("reps")).alias("total_volume_kg"),
        F.max("performed_at").alias("last_performed_at"))


def progress(sets: DataFrame) -> DataFrame:
    """Per-exercise progress plus per-user totals; rank by volume within the user."""
    ex = exercise_progress(sets)
    tot = sets.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_sets"),
                                      F.countDistinct("exercise").alias("tracked_exercises"))
    w = Window.partitionBy("user_id").orderBy(F.col("total_volume_kg").desc(), F.col("exercise"))
    return ex.join(tot, "user_id").withColumn("volume_rank", F.row_number().over(w))


PERIOD_DAYS = {"month": 31, "year": 365, "all": None}  # fixed values


def period_progress(sets: DataFrame, k: int = 8) -> DataFrame:
    """Per user, period (days back from the user's last set) and metric the ``k`` leading exercises."""
    last = sets.groupBy("user_id").agg(F.max("performed_at").alias("_last"))
    inside = [F.when(F.lit(True) if days is None else
                     F.col("performed_at") >= F.col("_last") - F.make_dt_interval(F.lit(days)), F.lit(name))
              for name, days in PERIOD_DAYS.items()]
    s = sets.join(last, "user_id").withColumn("period", F.explode(F.array_compact(F.array(*inside))))
    g = s.groupBy("period", "user_id", "exercise").agg(
        F.count(F.lit(1)).alias("sets"), F.sum(F.col("weight_kg") * F.col("reps")).alias("total_volume_kg"),
        F.max("weight_kg").alias("best_weight_kg"))
    g = g.withColumn("metric", F.explode(F.array(F.lit("sets"), F.lit("volume"), F.lit("best"))))
    by = F.when(F.col("metric") == "volume", F.col("total_volume_kg")).when(
        F.col("metric") == "best", F.col("best_weight_kg")).otherwise(F.col("sets").cast("double"))
    w = Window.partitionBy("period", "user_id", "metric").orderBy(by.desc(), "exercise")
    return g.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def daily_performance(sets: DataFrame, keep: int = 12) -> DataFrame:
    """Per user the last ``keep`` day buckets and month buckets with sets, volume, best, training days and seconds."""
    grains = F.array(*[F.struct(F.lit(g).alias("grain"), F.date_format("performed_at", p).alias("bucket"))
                       for g, p in (("day", "yyyy-MM-dd"), ("month", "yyyy-MM"))])
    s = sets.withColumn("_g", F.explode(grains))
    g = s.groupBy(F.col("_g.grain").alias("grain"), "user_id", F.col("_g.bucket").alias("bucket")).agg(
        F.count(F.lit(1)).alias("sets"), F.sum(F.col("weight_kg") * F.col("reps")).alias("volume"),
        F.max("weight_kg").alias("best"), F.countDistinct(F.to_date("performed_at")).alias("workouts"),
        F.sum("duration_seconds").alias("duration"))
    w = Window.partitionBy("grain", "user_id").orderBy(F.col("bucket").desc())
    return g.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= keep)
