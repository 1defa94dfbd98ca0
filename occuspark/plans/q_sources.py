"""Queries for sources and sinks: round trips through files in the shared scratch
folder under ``spark.checkpoint.dir`` (never a machine-local folder on a cluster)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import files as FS
from .q_chat import EX_SQL
from .q_forecast import BOARD_SQL
from .registry import query


def _scratch(c, name):
    base = ensure_checkpoint_dir(c.spark).rstrip("/")
    return f"{base}/occuspark-io/{name}-{uuid.uuid4().hex}"


@query("src_observation_clean", """
SELECT seq, ts, gym_id, CASE WHEN seq % 7 = 0 THEN 0 ELSE greatest(active_people - 20, 0) END AS active_people,
  0 AS is_synthetic, 'observation' AS generation_method FROM v_obs""")
def src_observation_clean(c):
    # Bad counts (every 7th row arrives unparsable) -> 0, negatives clipped, origin flags added.
    o = c.obs()
    raw = F.when(F.col("seq") % 7 == 0, F.lit("n/a")).otherwise((F.col("active_people") - 20).cast("string"))
    cnt = F.expr("try_cast(raw_count AS DOUBLE)")
    return (o.withColumn("raw_count", raw)
             .select("seq", "ts", "gym_id", F.greatest(F.coalesce(cnt, F.lit(0.0)), F.lit(0.0)).cast("long").alias("active_people"),
                     F.lit(0).alias("is_synthetic"), F.lit("observation").alias("generation_method")))


@query("src_raw_csv", """
SELECT date_trunc('second', ts) AS ts, city, address, CASE WHEN seq % 9 = 0 THEN 0 ELSE greatest(active_people, 0) END AS active_people,
  'events.parquet' AS source_file, CAST(year(ts) = 2024 AS INTEGER) AS year_ok FROM v_obs""")
def src_raw_csv(c):
    path = _scratch(c, "raw_obs")
    o = c.obs().select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), F.concat(F.lit(" "), "city").alias("city"),
                       "address", F.when(F.col("seq") % 9 == 0, F.lit("bad")).otherwise(F.col("active_people").cast("string"))
                       .alias("active_people"), F.lit("events.parquet").alias("source_file"))
    FS.write_csv(o, path)
    return FS.read_raw_observations(c.spark, path, year=2024)


@query("src_feature_csv", """
SELECT CAST(seq AS VARCHAR) AS seq, ts, gym_id, CAST(hour AS DOUBLE) AS hour, lag_1, rolling_mean_16,
  CAST(active_people AS DOUBLE) AS active_people FROM v_feat""")
def src_feature_csv(c):
    path = _scratch(c, "features")
    FS.write_csv(c.feat().select("seq", "ts", "gym_id", "hour", "lag_1", "rolling_mean_16", "active_people"), path)
    return FS.read_features(c.spark, path, ["hour", "lag_1", "rolling_mean_16", "active_people"])


@query("src_json_preview", """
SELECT 'preview' AS status, 'catalogue' AS source_name, slug, name, category, muscle_group, difficulty FROM v_library""")
def src_json_preview(c):
    path = _scratch(c, "preview")
    # one preview document per page of 48 consecutive items: every item is in one
    doc = c.library().groupBy(F.floor(F.col("item_id") / 48).alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("slug", "name", "category", "muscle_group", "difficulty"))).alias("records"))
    doc = doc.select(F.lit("preview").alias("status"), F.lit("catalogue").alias("source_name"),
                     F.lit("public").alias("source_license"), F.lit("").alias("note"), "records")
    doc.write.mode("overwrite").json(path)
    return FS.read_json_preview(c.spark, path, "slug string, name string, category string, muscle_group string, difficulty string",
                                multi_line=False)


@query("src_jsonl_chat", """
SELECT CASE WHEN turn % 11 <> 5 THEN CAST(conv_id AS DOUBLE) END AS conv_id, CASE WHEN turn % 11 <> 5 THEN CAST(turn AS DOUBLE) END AS turn,
  CASE WHEN turn % 11 <> 5 THEN role END AS role, CAST(turn % 11 = 5 AS INTEGER) AS is_corrupt FROM conversations""")
def src_jsonl_chat(c):
    path = _scratch(c, "chat_jsonl")
    conv = c.t("conversations")
    line = F.when(F.col("turn") % 11 == 5, F.lit("{not json")).otherwise(
        F.to_json(F.struct("conv_id", "turn", "role", "text")))
    conv.select(line.alias("value")).write.mode("overwrite").text(path)
    df = FS.read_jsonl(c.spark, path, "conv_id bigint, turn bigint, role string, text string")
    # ids are DOUBLE: a corrupt line has none (NULL-able integers round-trip badly through pandas)
    return df.select(F.col("conv_id").cast("double").alias("conv_id"), F.col("turn").cast("double").alias("turn"), "role",
                     F.col("_corrupt").isNotNull().cast("int").alias("is_corrupt"))


@query("sink_csv", "SELECT seq, ts, gym_id, city, address, active_people FROM v_obs")
def sink_csv(c):
    path = _scratch(c, "sink_csv")
    FS.write_csv(c.obs(), path)
    return c.spark.read.options(header=True, **FS.CSV_TIMES).schema(c.obs().schema).csv(path)


@query("sink_json_report", BOARD_SQL)
def sink_json_report(c):
    from ..operators import forecast as FC
    path = _scratch(c, "report_json")
    FS.write_json(FC.baseline_board(c.pred()), path)
    return c.spark.read.json(path)


@query("sink_jsonl_chat", f"""WITH {EX_SQL}
SELECT conv_id, task, len(messages) AS n_messages,
  array_to_string(list_transform(messages, lambda m: m.role || ': ' || coalesce(m.text, '')), chr(10)) AS transcript FROM ex""")
def sink_jsonl_chat(c):
    from .q_chat import conversations_as_examples
    path = _scratch(c, "sink_jsonl")
    ex = conversations_as_examples(c).select("conv_id", "task", "messages")
    FS.write_jsonl_text(ex, path)
    back = c.spark.read.schema("conv_id bigint, task string, messages array<struct<turn:bigint,role:string,text:string>>").json(path)
    line = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), F.coalesce(m["text"], F.lit(""))))
    return back.select("conv_id", "task", F.size("messages").alias("n_messages"), F.array_join(line, "\n").alias("transcript"))


@query("sink_markdown_table", """
SELECT '| ' || model || ' | ' || printf('%.4f', mae) || ' | ' || printf('%.4f', rmse) || ' |' AS line FROM (
  SELECT model, coalesce(avg(abs(e)), 0.0) AS mae, coalesce(sqrt(avg(e * e)), 0.0) AS rmse FROM (
    SELECT m.model, p.active_people - CASE m.model WHEN 'previous_observation' THEN p.pred_previous
      WHEN 'seasonal_lag_1d' THEN p.pred_seasonal WHEN 'rolling_mean_16' THEN p.pred_rolling ELSE p.pred_calendar END AS e
    FROM v_pred p CROSS JOIN (VALUES ('previous_observation'), ('seasonal_lag_1d'), ('rolling_mean_16'),
      ('calendar_profile_gym_weekday_hour')) AS m(model)) GROUP BY model)""")
def sink_markdown_table(c):
    from ..operators import forecast as FC
    return FS.markdown_rows(FC.baseline_board(c.pred()), ["model", "mae", "rmse"], ["%s", "%.4f", "%.4f"])
