from pyspark.sql import functions as F

from occuspark.functions import scalars as S
from occuspark.operators import chat as CH

RULES = CH.ChatRules()


def test_safety_terms_are_substrings(spark):
    df = spark.createDataFrame([("My heartland run",), ("Біль у коліні",), ("plan my week",)], "text string")
    out = [r.s for r in df.select(CH.safety_level("text", RULES).alias("s")).collect()]
    assert out == ["medical_refusal", "medical_refusal", "safe"]


def test_whole_word_intents(spark):
    df = spark.createDataFrame([("bench day",), ("benchmark it",), ("next set please",), ("é-press",)], "text string")
    out = [r.progression for r in CH.intents(df, RULES).collect()]
    assert out == [1, 0, 1, 1]


def test_preference_update_overwrites(spark):
    df = spark.createDataFrame([("I prefer morning or evening, less crowd",), ("hello",)], "text string")
    r = df.select(CH.preference_update("text", RULES).alias("u")).collect()
    assert (r[0].u.preferred_min_hour, r[0].u.preferred_max_hour, r[0].u.max_crowd_people) == (18, 22, 30)
    assert r[1].u is None


def test_actions_first_three(spark):
    df = spark.createDataFrame([("plan my week, log target set, new template, prefer morning", True, True, True)],
                               "text string, has_slot boolean, has_planned boolean, has_template boolean")
    r = CH.action_types(df, RULES).first()
    assert r.actions == ["schedule_week", "log_target_set", "create_workout_template"]


def test_weekdays_parse_and_sanitize(spark):
    df = spark.createDataFrame([("1, 3,x,9",), ("",), (None,)], "t string")
    out = [r.w for r in df.select(S.parse_weekdays(F.col("t")).alias("w")).collect()]
    assert out == [[1, 3, 9], [0, 2, 4], [0, 2, 4]]
    r = df.limit(1).select(S.sanitize_weekdays(S.parse_weekdays(F.col("t"))).alias("w")).first()
    assert r.w == [1, 3]


def test_safe_int_rules(spark):
    df = spark.createDataFrame([("12.9",), ("-3",), ("bad",), ("inf",), ("nan",), (None,)], "x string")
    out = [r.v for r in df.select(S.safe_int(F.col("x")).alias("v")).collect()]
    assert out == [12, 0, 0, 0, 0, 0]


def test_strip_html_and_steps(spark):
    html = "<p>1. Grip the bar.</p><p>2. Press up &amp; lock out.</p>"
    df = spark.createDataFrame([(html,), ("<div>Stand tall</div><div>and brace</div><div>Lower slowly</div>",)], "h string")
    rows = df.select(S.instruction_steps(F.col("h")).alias("s")).collect()
    assert rows[0].s == ["Grip the bar.", "Press up & lock out."]
    assert rows[1].s == ["Stand tall and brace", "Lower slowly"]


def test_title_and_display_names(spark):
    df = spark.createDataFrame([("ez_bar-curl",), ("pull-up with the band",), ("Bench Press",)], "n string")
    rows = df.select(S.title_name("n").alias("t"), S.display_name(F.col("n")).alias("d")).collect()
    assert rows[0].t == "EZ Bar Curl"
    assert rows[1].d == "Pull-Up with the Band"
    assert rows[2].d == "Bench Press"


def test_every_empty_message_is_an_issue(spark):
    from occuspark.plans.q_chat import _issues_spark
    m = [("system", "s"), ("user", " \n\t"), ("assistant", "")]
    ex = spark.createDataFrame([(1, "t", m)], "conv_id long, task string, messages array<struct<role:string,text:string>>")
    assert [r.issue for r in _issues_spark(ex).collect()] == ["all messages need non-empty content"] * 2


def test_strip_takes_white_space_off_both_ends_without_a_regular_expression(spark):
    spaces = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    texts = ["", " ", "a", "a b", "x\n", "\n\n x \u2028", "\u200bz\u200b", "é\u3000", *[s + "a" + s + "b" + s for s in spaces], "".join(spaces)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", S.py_strip("t").alias("s"))
    got = df.collect()
    assert [r["s"] for r in got] == [None if r["t"] is None else r["t"].strip() for r in got]
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()
