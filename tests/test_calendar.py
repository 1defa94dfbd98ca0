import datetime as dt

from pyspark.sql import functions as F

from occuspark.functions import calendar as cal

# Opening-hour boundary instants and the expected flag.
BOUNDARY_CASES = [
    ("2026-05-20 06:59:00", 0), ("2026-05-20 07:00:00", 1), ("2026-05-20 21:59:00", 1), ("2026-05-20 22:00:00", 0),
    ("2026-05-23 08:59:00", 0), ("2026-05-23 09:00:00", 1), ("2026-05-23 17:59:00", 1), ("2026-05-23 18:00:00", 0),
]

# The reference calendar for 2026 (public, major low-traffic, closed, special 0.68 day).
REF_2026 = cal.HolidayCalendar.of(
    public=("2026-01-01", "2026-03-08", "2026-04-12", "2026-05-01", "2026-05-08", "2026-05-31", "2026-06-28",
            "2026-07-15", "2026-08-24", "2026-10-01", "2026-12-25"),
    major=("2026-01-01", "2026-04-12", "2026-05-31", "2026-12-25"),
    closed=("2026-01-01", "2026-04-12", "2026-12-25"),
    special=("2026-05-31",))


def _df(spark, values):
    return spark.createDataFrame([(v,) for v in values], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))


def test_business_hours_boundaries(spark):
    rows = _df(spark, [c for c, _ in BOUNDARY_CASES]).select(cal.business_open("ts").alias("o")).collect()
    assert [r.o for r in rows] == [e for _, e in BOUNDARY_CASES]


def test_business_label(spark):
    rows = _df(spark, ["2026-05-20 10:00:00", "2026-05-23 10:00:00"]).select(cal.business_label("ts").alias("l")).collect()
    assert [r.l for r in rows] == ["07:00-22:00", "09:00-18:00"]


def test_holiday_multiplier_cascade(spark):
    days = ["2026-01-01 10:00:00", "2026-05-31 10:00:00", "2026-03-08 10:00:00", "2026-04-10 10:00:00", "2026-02-10 10:00:00"]
    rows = _df(spark, days).select(cal.holiday_multiplier("ts", REF_2026).alias("m"),
                                   cal.holiday_distance("ts", REF_2026.major).alias("d")).collect()
    assert [r.m for r in rows] == [0.0, 0.68, 0.78, 0.86, 1.0]
    assert rows[3].d == 2 and rows[0].d == 0


def test_holiday_distance_empty_list(spark):
    r = _df(spark, ["2026-02-10 10:00:00"]).select(cal.holiday_distance("ts", ()).alias("d")).first()
    assert r.d == 365


def test_training_window_rounding(spark):
    vals = ["2026-05-20 10:15:00", "2026-05-20 10:16:00", "2026-05-20 10:45:00", "2026-05-20 10:46:00"]
    rows = _df(spark, vals).select(cal.training_window_label("ts").alias("l"),
                                   cal.training_window_label("ts", strict=True).alias("s")).collect()
    assert [r.l for r in rows] == ["Wednesday 10:00-11:30", "Wednesday 10:30-12:00", "Wednesday 10:30-12:00",
                                   "Wednesday 11:00-12:30"]
    assert rows[0].s == "Wednesday 10:30-12:00"


def test_season(spark):
    vals = [f"2026-{m:02d}-10 10:00:00" for m in (1, 6, 9, 10, 12)]
    rows = _df(spark, vals).select(cal.season_label("ts").alias("l"), cal.season_factor("ts").alias("f")).collect()
    assert [(r.l, r.f) for r in rows] == [("spring", 1.0), ("summer", 0.92), ("autumn", 1.0), ("autumn", 1.05), ("spring", 1.0)]


def test_hour_floor_keeps_ntz(spark):
    df = _df(spark, ["2026-05-20 10:47:13"]).select(cal.hour_floor("ts").alias("h"))
    assert df.schema["h"].dataType.simpleString() == "timestamp_ntz"
    assert df.first().h == dt.datetime(2026, 5, 20, 10, 0)


def test_a_union_without_the_time_column_has_constraints(spark):
    start = F.lit("2026-01-03 10:00:00").cast("timestamp_ntz")
    rows = spark.range(2).select((start + F.make_dt_interval(F.col("id").cast("int"))).alias("ts"))
    days = rows.withColumn("days", cal.holiday_distance("ts", REF_2026.major)).checkpoint().select("days")
    both = days.unionByName(days)  # a lambda over the dates hid ``ts`` here: key not found
    assert both._jdf.queryExecution().optimizedPlan().constraints().size() >= 0
    assert sorted(r.days for r in both.collect()) == [2, 2, 3, 3]
    one = rows.select(cal.holiday_distance("ts", sorted(REF_2026.major)[:1]).alias("days")).collect()
    assert [r.days for r in one] == [2, 3]
