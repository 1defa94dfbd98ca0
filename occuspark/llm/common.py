"""Shared helpers of the training-data operators."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable ``checkpoint()`` into the shared folder, so a lost executor never replays the jobs above."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let the driver collect plans whose lineage was cut: Spark's cleaner then deletes their shuffle files.

    For loops that run many jobs; otherwise the files stay until the driver happens to collect its garbage.
    The driver's Java objects are let go a moment after their Python ones, hence the pauses; the collection
    also makes the heap smaller that the jobs before have widened.
    """
    for pause in (0.7, 0.3):
        gc.collect()
        time.sleep(pause)
        spark._jvm.System.gc()
    trim()


def trim() -> None:
    """Give memory that a task has freed back to the system: worker processes live on from stage to stage."""
    import ctypes

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def documents_of(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` as long and ``text`` with null read as empty; every other column is ignored."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       *[F.col(c) for c in extra])


def held_out(modulus: int, remainder: int, key: str = "doc_id") -> Column:
    """True where ``crc32`` of the id's decimal text leaves ``remainder`` (null ids count as false)."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(modulus)) == remainder,
                      F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, rows: int) -> DataFrame:
    """Texts of at most ``rows`` labelled documents, chosen by id hash among those that ``keep`` admits.

    The bound is the only limit on what a model is fitted on; ``rows`` ids are
    broadcast, so the documents are scanned once and never shuffled.  An id with
    several labels counts once, with its largest label.
    """
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).where(keep)
              .groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return documents_of(docs).join(F.broadcast(chosen), "doc_id")


def sub_blocks(rows: int, per_block: int) -> int:
    """Number of hash buckets that keeps each near ``per_block`` rows at every size."""
    return max(1, -(-rows // per_block))
