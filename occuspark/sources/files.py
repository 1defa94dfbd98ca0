"""File sources and sinks: typed CSV / JSON / JSONL readers and guarded writers.

Readers take an explicit schema (no inference pass over the data); every
"bad value -> default" rule uses ``try_`` functions because ANSI mode is on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S

RAW_OBS_COLUMNS = ("timestamp", "city", "address", "active_people", "source_file")
WEATHER_NUMERIC = ("temperature_2m", "apparent_temperature", "precipitation", "rain", "snowfall", "weather_code",
                   "cloud_cover", "wind_speed_10m")


#: Whole microseconds: the writer's default would cut them to milliseconds.
CSV_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _strip_bom(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])


def read_raw_observations(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """Header CSV of raw observations: BOM-tolerant, strings trimmed, strict timestamp, counts
    clamped at 0 (bad -> 0).  Rows outside ``year`` are flagged in ``year_ok`` (see dq_year_guard)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in RAW_OBS_COLUMNS])
    raw = _strip_bom(spark.read.option("header", True).option("encoding", "UTF-8").schema(schema).csv(path))
    ts = F.try_to_timestamp(F.trim("timestamp"), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    out = raw.select(ts.alias("ts"), F.trim("city").alias("city"), F.trim("address").alias("address"),
                     S.safe_int(F.trim(F.coalesce(F.col("active_people"), F.lit("0")))).cast("int").alias("active_people"),
                     F.trim("source_file").alias("source_file"))
    if year is not None:
        out = out.withColumn("year_ok", (F.year("ts") == year).cast("int"))
    return out


def read_features(spark: SparkSession, path: str, numeric) -> DataFrame:
    """Feature CSV with numeric coercion (unparsable -> NULL), ordered by entity and time."""
    raw = _strip_bom(spark.read.option("header", True).csv(path))
    cols = {c: F.expr(f"try_cast(nullif(trim(`{c}`), '') AS DOUBLE)") for c in numeric if c in raw.columns}
    out = raw.withColumns(cols)
    if "ts" in out.columns:
        out = out.withColumn("ts", F.try_to_timestamp("ts").cast("timestamp_ntz"))
    return out


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    raw = _strip_bom(spark.read.option("header", True).csv(path))
    return raw.withColumns({"timestamp_hour": F.try_to_timestamp("timestamp_hour").cast("timestamp_ntz"),
                            **{c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in WEATHER_NUMERIC},
                            "seq": F.col("seq").cast("long")})


def read_json_preview(spark: SparkSession, path: str, record_schema: str, multi_line: bool = True) -> DataFrame:
    """Nested JSON documents ``{status, source_name, records: [...]}`` -> one row per record.

    ``multi_line``: one document per file, over several lines; else one document per line.
    """
    schema = f"status string, source_name string, source_license string, note string, records array<struct<{record_schema}>>"
    doc = spark.read.option("multiLine", multi_line).schema(schema).json(path)
    return doc.select("status", "source_name", F.inline_outer("records"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with line-level error detection: malformed lines keep their text in ``_corrupt``."""
    return (spark.read.schema(f"{schema}, _corrupt string").option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", "_corrupt").json(path))


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    """Relational table through the JDBC source (driver jar supplied by the deployment)."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {})).load()


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV; refuses to write an empty result (cheap ``isEmpty`` probe, one row)."""
    if df.isEmpty():
        raise ValueError(f"No rows to write: {path}")
    df.write.mode(mode).options(header=True, **CSV_TIMES).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_jsonl_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line built with ``to_json`` (the row struct), written as text."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode(mode).text(path)


def markdown_rows(df: DataFrame, cols, formats) -> DataFrame:
    """Table rows rendered as ``| a | b |`` text lines (``formats`` are printf formats per column)."""
    parts = [F.format_string(f, F.col(c)) for c, f in zip(cols, formats)]
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *parts), F.lit(" |")).alias("line"))
