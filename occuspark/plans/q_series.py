"""Queries for SURVEY 2.2 (calendar) and 2.4 (time-series windows)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import series, topk
from .registry import query
from .views import HOLIDAYS, sql_calendar_cols, sql_holiday_cols, sql_open

FEATURE_COLS = ("seq ts gym_id city address active_people hour day_of_week is_weekend month day_of_month "
                "week_of_year is_open_estimated is_public_holiday is_gym_closed_holiday "
                "is_major_low_traffic_holiday is_major_holiday_window days_to_nearest_major_holiday "
                "holiday_effect_multiplier lag_1 lag_4 lag_96 rolling_mean_4 rolling_mean_16 "
                "rolling_mean_96").split()


@query("ts_feature_table", "SELECT * FROM v_feat")
def ts_feature_table(c):
    """Flagship: calendar + holiday + lag + rolling features; windows run on 50k-row chunks with a
    96-row halo, so one huge series is spread over many tasks (exact, see ts_feature_table_chunked)."""
    return c.feat().select(*FEATURE_COLS)


@query("ts_feature_table_chunked", "SELECT * FROM v_feat")
def ts_feature_table_chunked(c):
    """Chunked windows with tiny chunks (200 rows), so halos between chunks are exercised by the oracle."""
    return series.feature_table_chunked(c.obs(), HOLIDAYS, chunk_rows=200).select(*FEATURE_COLS)


@query("ts_feature_table_single_pass", "SELECT * FROM v_feat")
def ts_feature_table_single_pass(c):
    """One shared window spec per entity: a single Exchange + Sort + Window (best when entities are many and even)."""
    return series.feature_table(c.obs(), HOLIDAYS).select(*FEATURE_COLS)


@query("cal_features", f"SELECT seq, gym_id, ts, {sql_calendar_cols('ts')} FROM v_obs")
def cal_features(c):
    return c.obs().select("seq", "gym_id", "ts", *[v.alias(k) for k, v in cal.calendar_columns("ts").items()])


@query("cal_business_open", f"""
SELECT seq, ts, {sql_open('ts')} AS is_open,
  CASE WHEN isodow(ts) >= 6 THEN '09:00-18:00' ELSE '07:00-22:00' END AS hours_label
FROM v_obs""")
def cal_business_open(c):
    return c.obs().select("seq", "ts", cal.business_open("ts").alias("is_open"),
                          cal.business_label("ts").alias("hours_label"))


@query("cal_holiday_flags", f"SELECT seq, ts, {sql_holiday_cols('ts')} FROM v_obs")
def cal_holiday_flags(c):
    return c.obs().select("seq", "ts", *[v.alias(k) for k, v in cal.holiday_columns("ts", HOLIDAYS).items()])


@query("cal_season", """
SELECT seq, ts,
  CASE WHEN month(ts + INTERVAL (seq % 12) MONTH) IN (6, 7, 8) THEN 'summer'
       WHEN month(ts + INTERVAL (seq % 12) MONTH) IN (9, 10, 11) THEN 'autumn' ELSE 'spring' END AS season,
  CASE WHEN month(ts + INTERVAL (seq % 12) MONTH) IN (6, 7, 8) THEN 0.92
       WHEN month(ts + INTERVAL (seq % 12) MONTH) IN (10, 11) THEN 1.05 ELSE 1.0 END AS season_factor
FROM v_obs""")
def cal_season(c):
    # Events span one January; shifting by seq % 12 months exercises every month.
    shifted = F.add_months(F.col("ts"), (F.col("seq") % 12).cast("int"))
    return c.obs().select("seq", "ts", cal.season_label(shifted).alias("season"),
                          cal.season_factor(shifted).alias("season_factor"))


@query("cal_hour_floor", "SELECT seq, date_trunc('hour', ts) AS ts_hour FROM v_obs")
def cal_hour_floor(c):
    return c.obs().select("seq", cal.hour_floor("ts").alias("ts_hour"))


@query("ts_lag_features", """
SELECT seq, gym_id, ts, active_people,
  CAST(lag(active_people, 1) OVER w AS DOUBLE) AS lag_1, CAST(lag(active_people, 4) OVER w AS DOUBLE) AS lag_4,
  CAST(lag(active_people, 96) OVER w AS DOUBLE) AS lag_96
FROM v_obs WINDOW w AS (PARTITION BY gym_id ORDER BY ts)""")
def ts_lag_features(c):
    return series.lag_features(c.obs().select("seq", "gym_id", "ts", "active_people"))


@query("ts_rolling_features", """
SELECT seq, gym_id, ts, active_people,
  avg(active_people) OVER (PARTITION BY gym_id ORDER BY ts ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS rolling_mean_4,
  avg(active_people) OVER (PARTITION BY gym_id ORDER BY ts ROWS BETWEEN 16 PRECEDING AND 1 PRECEDING) AS rolling_mean_16,
  avg(active_people) OVER (PARTITION BY gym_id ORDER BY ts ROWS BETWEEN 96 PRECEDING AND 1 PRECEDING) AS rolling_mean_96
FROM v_obs""")
def ts_rolling_features(c):
    return series.rolling_features(c.obs().select("seq", "gym_id", "ts", "active_people"))


@query("topk_dedupe_last", """
SELECT seq, ts, gym_id, city, address, active_people FROM (
  SELECT *, row_number() OVER (PARTITION BY gym_id, ts ORDER BY seq DESC) AS rn FROM v_obs_raw) WHERE rn = 1""")
def topk_dedupe_last(c):
    return topk.dedupe_last(c.obs_raw(), ["gym_id", "ts"], "seq")
