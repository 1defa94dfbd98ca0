"""Run the observation feed as a Structured Streaming job.

Each micro-batch is de-duplicated (last write per (gym_id, ts) by sequence) and
merged into a date-partitioned Parquet table with dynamic partition overwrite:
only the dates touched by the batch are rewritten, and a replayed batch
produces the same table (idempotent), so the job survives restarts from its
checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.topk import dedupe_last

KEYS = ["gym_id", "ts"]


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the target holds a partition, asked of the path's own file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.globStatus(hadoop.Path(path, "obs_date=*"))) > 0


def merge_batch(batch: DataFrame, target_path: str, seq: str = "seq") -> None:
    """Last-write-wins merge of one batch into the date-partitioned target.

    A batch whose columns differ from the table's is refused before anything is written.
    """
    spark = batch.sparkSession
    batch = batch.withColumn("obs_date", F.to_date("ts"))
    dates = [r["obs_date"] for r in batch.select("obs_date").distinct().collect()]  # dates of one micro-batch (bounded)
    if not dates:
        return
    if table_exists(spark, target_path):
        existing = spark.read.parquet(target_path)
        if set(existing.columns) != set(batch.columns):
            raise ValueError(f"batch columns {sorted(batch.columns)} differ from the table's {sorted(existing.columns)}")
        merged = existing.filter(F.col("obs_date").isin(dates)).unionByName(batch)
    else:  # first batch
        merged = batch
    out = dedupe_last(merged, KEYS, seq)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("obs_date").parquet(target_path))


def start(spark: SparkSession, source_path: str, schema: str, target_path: str, checkpoint_path: str,
          available_now: bool = True):
    """Stream Parquet observation files from ``source_path`` into ``target_path``."""
    stream = spark.readStream.schema(schema).parquet(source_path)
    writer = stream.writeStream.foreachBatch(lambda df, _epoch: merge_batch(df, target_path)) \
                   .option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
