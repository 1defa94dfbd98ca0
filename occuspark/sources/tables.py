"""Driver Parquet tables.  Column pruning and filters reach the scan through Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return with_min_parallelism(df) if name in TEXT_TABLES else df


# Tables whose rows carry long texts: per-row work (tokenising, regex) dominates, so a scan
# that arrives in fewer splits than the cluster has cores is spread out once.
TEXT_TABLES = ("documents", "pages", "conversations", "benchmark")


def with_min_parallelism(df: DataFrame) -> DataFrame:
    """Round-robin repartition only when the scan has fewer partitions than the default
    parallelism (a single-file table); a large multi-file scan is left untouched."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
