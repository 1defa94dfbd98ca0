"""Best match by token overlap as a set-similarity join.

Tokens stand in global frequency order, rarest first.  Two sets that share ``o`` tokens also
share one among the first ``n - o + 1`` of each (prefix filter), and must be long enough to
share ``o`` at all (length filter).  One shared token needs no pairs: the best record for it
is a look-up in a table of the smallest id by (token, set size, group), whose score is a
bound from below.  Pairs are only formed for two shared tokens or more, with the prefix that
this bound leaves, so the most frequent token of a set is never a join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-9


def signatures(df: DataFrame, tokens: str, group: str, *aggregates) -> DataFrame:
    """Distinct ``(sig, grp)``: sorted tokens as one string, and the group (null groups equal nothing)."""
    named = df.where(F.size(tokens) > 0).withColumns({
        "sig": F.array_join(F.array_sort(F.array_distinct(tokens)), " "),
        "grp": F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))})
    return named.groupBy("sig", "grp").agg(*aggregates) if aggregates else named.select("sig", "grp").distinct()


def placed(sets: DataFrame) -> DataFrame:
    """``sig, t, p, n``: the tokens of distinct sets with their place in frequency order (from 0) and the set's size."""
    rows = sets.select("sig").distinct().withColumn("t", F.explode(F.split("sig", " ")))
    counted = rows.join(rows.groupBy("t").agg(F.count(F.lit(1)).alias("df")), "t")
    own = F.array_sort(F.collect_list(F.struct("df", "t")))  # a set has a handful of tokens
    return (counted.groupBy("sig").agg(own.alias("a"))
            .select("sig", F.size("a").alias("n"), F.posexplode(F.transform("a", lambda x: x["t"])).alias("p", "t")))


def same(left: str = "grp", right: str = "rgrp"):
    return ((F.col(left) == F.col(right)) & (F.col(left) != "-")).cast("double")


def by_one_token(wanted: DataFrame, records: DataFrame, record: str) -> DataFrame:
    """``sig, grp, bound, rec``: the best record by one shared token, ties to the smaller id."""
    any_group = records.groupBy("t", "n").agg(F.min(record).alias("rec")).withColumn("plus", F.lit(0.0))
    own_group = (records.where(F.col("grp") != "-").groupBy("t", "n", "grp").agg(F.min(record).alias("rec"))
                 .withColumn("plus", F.lit(1.0)))
    w = wanted.select("sig", "grp", F.col("n").alias("size"), "t")
    found = w.join(any_group, "t").unionByName(w.join(own_group, ["t", "grp"]))
    score = F.lit(1) / F.greatest("size", "n") + F.col("plus")
    return (found.groupBy("sig", "grp").agg(F.min(F.struct((-score).alias("s"), "rec")).alias("b"))
            .select("sig", "grp", (-F.col("b.s")).alias("bound"), F.col("b.rec").alias("rec")))


def pairs(wanted: DataFrame, records: DataFrame, bounds: DataFrame, record: str, threshold: float) -> DataFrame:
    """Pairs that can share two tokens or more and reach the set's bound: ``sig, grp, rsig, rgrp, rec``."""
    least = F.greatest(F.col("bound"), F.lit(threshold))
    own = wanted.join(bounds.select("sig", "grp", "bound"), ["sig", "grp"])
    # at least as many shared tokens as a record of the set's own size and group would need
    need = F.greatest(F.lit(2), F.ceil(F.col("n") * (least - 1) - EPS))
    left = own.where(F.col("p") <= F.col("n") - need).select("sig", "grp", "n", "p", "t", "bound")
    right = records.where(F.col("p") <= F.col("n") - 2).select(
        F.col("sig").alias("rsig"), F.col("grp").alias("rgrp"), F.col("n").alias("m"), F.col("p").alias("rp"), "t",
        F.col(record).alias("rec"))
    needed = F.greatest(F.lit(2), F.ceil(F.greatest("n", "m") * (least - same()) - EPS))
    return (left.join(right, "t")
            .where((needed <= F.least("n", "m")) & (F.col("p") <= F.col("n") - needed) & (F.col("rp") <= F.col("m") - needed))
            .select("sig", "grp", "rsig", "rgrp", "rec").distinct())


def best_match(wanted: DataFrame, records: DataFrame, threshold: float, record: str) -> DataFrame:
    """``sig, grp, rec, score``: each set's best record of the same token, by shared tokens over the larger
    set's size, plus one in the same group; ties to the smaller id; from ``threshold`` on.

    ``wanted`` and ``records`` are :func:`signatures`, the latter with the smallest ``record`` id.
    """
    place = placed(wanted.select("sig").unionByName(records.select("sig")))
    w, r = wanted.join(place, "sig"), records.join(place, "sig")
    bounds = by_one_token(w, r, record)
    formed = pairs(w, r, bounds, record, threshold)
    a, b = F.split("sig", " "), F.split("rsig", " ")
    score = F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b)) + same()
    both = formed.select("sig", "grp", "rec", score.alias("score")).unionByName(
        bounds.select("sig", "grp", "rec", F.col("bound").alias("score")))
    return (both.groupBy("sig", "grp").agg(F.min(F.struct((-F.col("score")).alias("s"), "rec")).alias("b"))
            .select("sig", "grp", F.col("b.rec").alias("rec"), (-F.col("b.s")).alias("score"))
            .where(F.col("score") >= threshold))
