"""Mixing sources to target weights with Sainte-Laguë quotas of equal-token blocks.

Light rows (id, source, size) are computed once from the texts; everything after
runs on them.  Sources get integer quotas of blocks by highest quotients
``target / (2 a + 1)``; a source's quota is dealt to its hash shards in the same
way, by shard size.  Within a shard the documents stand in a seeded order on one
line of words; the quota's whole passes take every document, and the remaining
blocks are a run of blocks from a seeded start, around the end of the line.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, sub_blocks

#: A run of anything but ASCII white space is a word.
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: np.ndarray, weights: np.ndarray, most: float = 3.0) -> np.ndarray:
    """Share ``sizes.sum()`` by weight; a target stops at ``most`` times its source, the rest is shared again."""
    sizes = np.asarray(sizes, dtype=float)
    out, open_ = np.zeros(len(sizes)), np.ones(len(sizes), dtype=bool)
    rest = sizes.sum()
    while open_.any():
        share = np.where(open_, weights * rest / weights[open_].sum(), 0.0)
        over = open_ & (share > most * sizes)
        if not over.any():
            out[open_] = share[open_]
            break
        out[over] = most * sizes[over]
        open_ &= ~over
        rest = max(0.0, sizes.sum() - out[~open_].sum())
    return out


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by highest quotients ``votes / (2 a + 1)``, none above ``most``; ties go to the earlier entry.

    All but the last few seats come from a divisor found by bisection, so the work
    does not grow with ``seats``.
    """
    votes, most = np.asarray(votes, dtype=float), np.asarray(most, dtype=np.int64)
    seats = int(min(seats, most[votes > 0].sum()))
    got = np.zeros(len(votes), dtype=np.int64)
    if seats <= 0:
        return got

    def at(divisor: float) -> np.ndarray:
        return np.minimum(most, np.floor(np.minimum(votes / divisor + 0.5, 9e18)).astype(np.int64))

    low, high = 0.0, 4.0 * votes.max()  # more seats than wanted, none
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if at(mid).sum() <= seats:
            high = mid
        else:
            low = mid
    got = np.where(votes > 0, at(high), 0)
    while got.sum() < seats:
        quotient = np.where((votes > 0) & (got < most), votes / (2.0 * got + 1), -1.0)
        got[int(np.argmax(quotient))] += 1
    return got


def block_size(target: np.ndarray, blocks: int = 200, largest: int = 1024) -> int:
    """Words of a block: the smallest source's target is worth ``blocks`` blocks, if that many words exist."""
    positive = target[target > 0]
    return int(min(largest, max(1, positive.min() // blocks))) if len(positive) else 1


def light_rows(docs: DataFrame, word: str = WORD) -> DataFrame:
    """``doc_id, source, size``: words of each whole text (null: 0)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(word)), F.lit(0)).cast("long")
                       .alias("size"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: int = 3, seed: int = 42,
        shard_words: int = 200_000, shard_rows: int = 2_000) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, taken``.

    Sources in code-point order (null last) weigh ``weights`` in turn.  ``taken``
    counts words with repeats, at most ``most`` times ``size``; a source's taken
    words miss its target by about a block.  Empty and null texts have size 0
    and give nothing; repeated rows stand side by side on their shard's line; an
    empty table gives an empty result.  One row per source and per shard reaches
    the driver or a join; shards hold some 200,000 words at every corpus size.
    """
    spark = docs.sparkSession
    light = cut_lineage(light_rows(docs))
    by_source = (light.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
                 .orderBy(F.col("source").asc_nulls_last()).collect())
    size = np.array([r["size"] for r in by_source], dtype=np.int64)
    weight = np.array([weights[i % len(weights)] for i in range(len(size))])
    target = targets(size, weight, most)
    block = block_size(target)
    quota = sainte_lague(target, int(round(target.sum() / block)), np.ceil(most * size / block).astype(np.int64))
    shards = [max(sub_blocks(int(s), shard_words), sub_blocks(r["rows"], shard_rows))
              for s, r in zip(size, by_source, strict=True)]
    known = spark.createDataFrame(
        [(i, r["source"], int(size[i]), float(target[i]), int(quota[i]) * block, int(shards[i]))
         for i, r in enumerate(by_source)],
        "k int, source string, source_size long, target double, quota long, shards int")
    # one row per source, whose names are distinct: bounded by the number of sources
    seeded = light.join(F.broadcast(known.withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s")))
    seeded = (seeded.drop("s").withColumn("order", F.xxhash64("doc_id", "size", F.lit(seed)))
              .withColumn("shard", F.pmod(F.col("order"), F.col("shards")).cast("int")))
    per_shard = shard_quotas(seeded, block, most)
    line = Window.partitionBy("k", "shard").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (seeded.withColumn("end", F.sum("size").over(line)).join(per_shard, ["k", "shard"]))
    a, b, whole = F.col("end") - F.col("size"), F.col("end"), F.col("shard_size")
    rest = F.when(whole > 0, F.col("shard_quota") % whole).otherwise(F.lit(0))
    passes = F.when(whole > 0, F.floor(F.col("shard_quota") / whole)).otherwise(F.lit(0))
    begin = F.pmod(F.xxhash64("k", "shard", F.lit(seed)), F.greatest(F.lit(1), F.floor(whole / F.lit(block)))) * block
    zero = F.lit(0).cast("long")
    here = F.greatest(zero, F.least(b, begin + rest) - F.greatest(a, begin))
    around = F.greatest(zero, F.least(b, begin + rest - whole) - a)
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         (passes * F.col("size") + here + around).cast("long").alias("taken"))


def deal(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Blocks of each child: its parent's ``blocks`` by highest quotients of the children's ``size``.

    The share rounds to the nearest integer, which is the method's answer up to a
    few seats; those go to the highest next quotients, or are taken back from the
    lowest last ones.
    """
    whole = Window.partitionBy(*parent)
    share = F.when(F.col("of") > 0, F.col("blocks") * F.col("size") / F.col("of")).otherwise(F.lit(0.0))
    rounded = (children.withColumn("of", F.sum("size").over(whole)).withColumn("share", share)
               .withColumn("seats", F.floor(F.col("share") + 0.5))
               .withColumn("missing", F.col("blocks") - F.sum("seats").over(whole)))
    up = Window.partitionBy(*parent).orderBy((F.col("share") / (2 * F.col("seats") + 1)).desc(), F.col(child))
    down = Window.partitionBy(*parent).orderBy(
        F.when(F.col("seats") > 0, F.col("share") / (2 * F.col("seats") - 1)).asc_nulls_last(), F.col(child))
    rounded = rounded.withColumn("up", F.row_number().over(up)).withColumn("down", F.row_number().over(down))
    seats = (F.col("seats") + F.when(F.col("up") <= F.col("missing"), 1).otherwise(0)
             - F.when(F.col("down") <= -F.col("missing"), 1).otherwise(0))
    return rounded.select(*parent, child, "size", F.greatest(F.lit(0).cast("long"), seats).alias("blocks"))


def shard_quotas(seeded: DataFrame, block: int, most: int, per_group: int = 1000) -> DataFrame:
    """Words each (source, shard) gives.

    The source's blocks are dealt to groups of ``per_group`` shards, and each
    group's to its shards, so no window holds all shards of a source.  Both deals
    start from one written row a shard, so that their plan, which the driver holds,
    does not repeat the documents' sums.
    """
    shard = cut_lineage(seeded.groupBy("k", "shard").agg(F.sum("size").alias("size"), F.first("quota").alias("quota"))
                        .withColumn("g", F.floor(F.col("shard") / per_group).cast("int")))
    group = shard.groupBy("k", "g").agg(F.sum("size").alias("size"), F.floor(F.first("quota") / block).alias("blocks"))
    given = deal(group, ["k"], "g").select("k", "g", "blocks")
    dealt = deal(shard.drop("quota").join(given, ["k", "g"]), ["k", "g"], "shard")
    words = F.least(F.col("blocks") * block, F.col("size") * most).cast("long")
    return dealt.select("k", "shard", F.col("size").alias("shard_size"), words.alias("shard_quota"))


def copies(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus as documents: each row as often as its taken words make it up, rounded half up.

    Texts stay whole; rows that the mix leaves out are gone, repeated ones appear
    two or three times.  Rows of the same id and size share one decision.
    """
    cols = docs.columns
    mixed = mix(docs, **options)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(F.lit(0)).cast("int")
    decided = (mixed.select("doc_id", "source", "size", times.alias("times")).groupBy("doc_id", "source", "size")
               .agg((F.sum("times") / F.count("*")).alias("mean_times")))
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"),
                        F.col("doc_id").cast("long").alias("i"), F.col("source").cast("string").alias("s"),
                        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
                        .alias("n"))
    kept = sized.join(decided, F.col("i").eqNullSafe(F.col("doc_id")) & F.col("s").eqNullSafe(F.col("source"))
                      & (F.col("n") == F.col("size")))
    n = F.floor(F.col("mean_times") + 0.5).cast("int")
    return (kept.where(n > 0).select("row", F.explode(F.sequence(F.lit(1), n)).alias("copy"))
            .select(*[F.col("row").getField(c).alias(c) for c in cols]))
