"""Slot recommendation and network jobs -- every user / gym in one job.

The reference walks one sorted list per request and keeps the first slot of
each clock hour until k are found.  Here that is two bounded windows: the
best row per (entity, clock hour), then ``row_number() <= k`` per entity
(planned as WindowGroupLimit).  Joins on ``gym_id`` are shuffle joins; a gym
that many users prefer is split by AQE's skew-join handling rather than
broadcasting a forecast whose size grows with the number of gyms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal


def slot_score(pred) -> Column:
    """max(0, 100 - load)."""
    p = F.col(pred) if isinstance(pred, str) else pred
    return F.greatest(F.lit(0.0), F.lit(100.0) - p)


def open_slots(forecast: DataFrame) -> DataFrame:
    return forecast.filter((F.col("is_gym_closed_holiday") == 0) & (F.col("is_open_estimated") == 1)
                           & (cal.business_open("ts") == 1))


def quiet_slots(df: DataFrame, keys, k: int, pred="prediction", ts="ts", tiebreak=()) -> DataFrame:
    """Lowest predictions per key, at most one per clock hour, first ``k`` by (prediction, ts)."""
    order = [F.col(pred), F.col(ts), *[F.col(t) for t in tiebreak]]
    hour_key = F.date_trunc("hour", F.col(ts))
    per_hour = Window.partitionBy(*keys, hour_key).orderBy(*order)
    per_key = Window.partitionBy(*keys).orderBy(*order)
    best = df.withColumn("_h", F.row_number().over(per_hour)).filter("_h = 1").drop("_h")
    return (best.withColumn("rank", F.row_number().over(per_key)).filter(F.col("rank") <= k)
                .withColumns({"window_label": cal.training_window_label(ts),
                              "expected_people": F.col(pred), "score": slot_score(pred)}))


def clamp(v: int, lo: int, hi: int) -> int:
    return max(lo, min(v, hi))


def backtest_slots(predictions: DataFrame, k: int = 5, last_n: int = 240) -> DataFrame:
    """Quiet slots among the last ``last_n`` holdout predictions of each gym, open hours only."""
    w = Window.partitionBy("gym_id").orderBy(F.col("ts").desc())
    tail = predictions.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= last_n).drop("_rn")
    return quiet_slots(tail.filter(cal.business_open("ts") == 1), ["gym_id"], k)


def future_slots(forecast: DataFrame, k: int = 5, min_hour=None, max_hour=None) -> DataFrame:
    f = open_slots(forecast)
    fh = cal.fractional_hour("ts")
    if min_hour is not None:
        f = f.filter(fh >= min_hour)
    if max_hour is not None:
        f = f.filter(fh < max_hour)
    return quiet_slots(f, ["gym_id"], k)


def preference_slots(prefs: DataFrame, forecast: DataFrame, max_results: int = 5) -> DataFrame:
    """Per user: open slots of the preferred gym inside the hour window, weekday list and crowd cap."""
    k = clamp(max_results, 1, 20)
    f = open_slots(forecast).select("gym_id", "ts", "prediction")
    fh = cal.fractional_hour(F.col("ts"))
    cond = ((F.col("preferred_gym_id") == F.col("gym_id")) & (fh >= F.col("preferred_min_hour"))
            & (fh < F.col("preferred_max_hour")) & (F.col("prediction") <= F.col("max_crowd_people"))
            & F.array_contains(F.col("preferred_weekdays"), cal.weekday(F.col("ts"))))
    joined = prefs.select("user_id", "preferred_gym_id", "preferred_min_hour", "preferred_max_hour",
                          "max_crowd_people", "preferred_weekdays").join(f, cond)
    return quiet_slots(joined, ["user_id"], k)


def personalised_slots(prefs: DataFrame, forecast: DataFrame, max_results: int = 5) -> DataFrame:
    """Preference slots; users without any fall back to the hour window alone."""
    k = clamp(max_results, 1, 20)
    matched = preference_slots(prefs, forecast, max_results).withColumn("source", F.lit("preference"))
    missing = prefs.join(matched.select("user_id").distinct(), "user_id", "left_anti")
    f = open_slots(forecast).select("gym_id", "ts", "prediction")
    fh = cal.fractional_hour(F.col("ts"))
    cond = ((F.col("preferred_gym_id") == F.col("gym_id")) & (fh >= F.col("preferred_min_hour"))
            & (fh < F.col("preferred_max_hour")))
    fb = quiet_slots(missing.select("user_id", "preferred_gym_id", "preferred_min_hour", "preferred_max_hour")
                     .join(f, cond), ["user_id"], k).withColumn("source", F.lit("fallback"))
    cols = ["user_id", "gym_id", "ts", "rank", "window_label", "expected_people", "score", "source"]
    return matched.select(*cols).unionByName(fb.select(*cols))


def campaigns(forecast: DataFrame, max_results: int = 12) -> DataFrame:
    """Network-wide lowest predictions, one per (gym, clock hour), global top-k (no full sort)."""
    k = clamp(max_results, 1, 30)
    f = open_slots(forecast)
    w = Window.partitionBy("gym_id", F.date_trunc("hour", "ts")).orderBy("prediction", "ts")
    best = f.withColumn("_h", F.row_number().over(w)).filter("_h = 1")
    return (best.orderBy("prediction", "ts", "gym_id").limit(k)
                .select("gym_id", "city", "address", "ts", F.col("prediction").alias("expected_people"),
                        slot_score("prediction").alias("score"), F.lit("off_peak_bonus").alias("campaign_type")))


FOCUS_CYCLE = ("Upper Strength", "Lower Progression", "Recovery Cardio", "Full Body Technique")  # fixed values
DEFAULT_MINUTES = 55  # fixed value
MAX_SLOTS = 20  # a user's slots are clamped to this many


def weekly_plan(slots: DataFrame, templates: DataFrame) -> DataFrame:
    """Slot i gets template ``i mod n`` of the user's templates (ordered), else a 4-focus cycle."""
    tw = Window.partitionBy("user_id").orderBy("template_id")
    rn = F.row_number().over(tw)
    t = (templates.select("user_id", "template_id", "name", "estimated_minutes").withColumn("_rn", rn)
         .filter(F.col("_rn") <= MAX_SLOTS).withColumn("_ti", F.col("_rn") - 1).drop("_rn"))  # a slot's rank reaches no further
    n = templates.groupBy("user_id").agg(F.count(F.lit(1)).alias("_tn"))
    s = slots.join(n, "user_id", "left").withColumn("_ti", F.pmod(F.col("rank") - 1, F.col("_tn")))
    s = s.join(t, ["user_id", "_ti"], "left")
    focus = F.element_at(F.array(*[F.lit(x) for x in FOCUS_CYCLE]),
                         (F.pmod(F.col("rank") - 1, F.lit(len(FOCUS_CYCLE))) + 1).cast("int"))
    return s.select("user_id", F.col("rank").alias("day_index"), F.col("ts").alias("scheduled_at"), "window_label",
                    "expected_people", F.coalesce(F.col("name"), focus).alias("focus"),
                    F.coalesce(F.col("estimated_minutes"), F.lit(DEFAULT_MINUTES)).alias("estimated_minutes"))


def gym_directory(obs: DataFrame) -> DataFrame:
    """Distinct gyms with their last-seen city and address, sorted by (city, address)."""
    return (obs.groupBy("gym_id").agg(F.max_by("city", F.struct("ts", "seq")).alias("city"),
                                      F.max_by("address", F.struct("ts", "seq")).alias("address"))
               .orderBy("city", "address"))
