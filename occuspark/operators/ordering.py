"""Total orders and exact quantiles without a window over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def total_order(df: DataFrame, order: list, out: str = "pos") -> DataFrame:
    """1-based position of each row in a total order.

    Rows are range-partitioned by sampled splitters and sorted inside their partition;
    a partition's offset is the number of rows in those before it.  The order is written
    once, so that a repeated read cannot see other splitters.  One number for each
    partition reaches the driver.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    at = F.monotonically_increasing_id()  # partition and place in it
    laid = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", at).checkpoint()
    laid = laid.withColumn("_part", F.shiftright("_at", 33))
    counts = sorted(laid.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, before = [], 0
    for part, n in counts:
        offsets.append((part, before))
        before += n
    known = spark.createDataFrame(offsets, "_part long, _before long")
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return laid.join(known, "_part").withColumn(out, place).drop("_at", "_part", "_before")


def keyed_quantiles(rows: DataFrame, q: float, key: str = "key", value: str = "value", accuracy: int = 2000,
                    ranges: int = 64) -> DataFrame:
    """``key, quantile``: exact (linearly interpolated) quantile of every key in two passes over the rows.

    The first pass brackets the wanted rank of all keys at once with a quantile sketch; the
    second counts what lies under the bracket and the distinct values inside it (some
    ``6 / accuracy`` of a key's rows; all of a key of fewer than ``4 * accuracy`` rows).
    The rank is looked up by ranges of the bracket, so no task orders a whole one.
    """
    v = rows.where(F.col(value).isNotNull()).select(F.col(key).alias("_k"), F.col(value).cast("double").alias("_v"))
    low, high = max(0.0, q - 3 / accuracy), min(1.0, q + 3 / accuracy)
    sketch = v.groupBy("_k").agg(F.percentile_approx("_v", [low, high], accuracy).alias("b"), F.count("_v").alias("_total"),
                                 F.min("_v").alias("least"), F.max("_v").alias("most"))
    small = F.col("_total") < 4 * accuracy
    bracket = sketch.select(F.col("_k").alias("_bk"), "_total", F.when(small, F.col("least")).otherwise(F.col("b")[0]).alias("_low"),
                            F.when(small, F.col("most")).otherwise(F.col("b")[1]).alias("_high"))
    met = v.join(bracket, F.col("_k").eqNullSafe(F.col("_bk"))).where(F.col("_v") <= F.col("_high"))
    slot = F.when(F.col("_v") >= F.col("_low"), F.col("_v"))
    width = F.col("_high") - F.col("_low")
    piece = F.when(slot.isNull(), -1).when(width > 0, F.least(F.lit(ranges - 1), F.floor((slot - F.col("_low")) / width * ranges))
                                           ).otherwise(0).cast("int")
    counted = (met.withColumns({"_s": slot, "_p": piece}).groupBy("_k", "_p", "_s")
               .agg(F.count(F.lit(1)).alias("_n"), F.first("_total").alias("_total")))
    by_piece = counted.groupBy("_k", "_p").agg(F.sum("_n").alias("_pn"), F.first("_total").alias("_total"))
    before = F.sum("_pn").over(Window.partitionBy("_k").orderBy("_p")) - F.col("_pn")  # at most ``ranges`` + 1 rows a key
    by_piece = by_piece.withColumn("_from", before)
    rank = (F.col("_total") - 1) * q
    floor, ceil = F.floor(rank), F.ceil(rank)
    holds = ((F.col("_from") <= floor) & (floor < F.col("_from") + F.col("_pn"))) | (
        (F.col("_from") <= ceil) & (ceil < F.col("_from") + F.col("_pn")))
    wanted = by_piece.where(holds & (F.col("_p") >= 0)).select(F.col("_k").alias("_wk"), F.col("_p").alias("_wp"), "_from")
    some = counted.join(wanted, F.col("_k").eqNullSafe(F.col("_wk")) & (F.col("_p") == F.col("_wp")))
    upto = F.col("_from") + F.sum("_n").over(Window.partitionBy("_k", "_p").orderBy("_s"))
    some = some.withColumns({"_to": upto, "_r": rank})

    def at(r: Column) -> Column:
        return F.min(F.when(r < F.col("_to"), F.col("_s")))

    found = some.groupBy("_k").agg(at(F.floor("_r")).alias("_a"), at(F.ceil("_r")).alias("_z"), F.first("_r").alias("_r"))
    exact = F.col("_a") + (F.col("_z") - F.col("_a")) * (F.col("_r") - F.floor("_r"))
    return found.select(F.col("_k").alias(key), exact.alias("quantile"))
