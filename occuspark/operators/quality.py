"""Data-quality operators: each returns violation rows or counts, computed
with conditional aggregates in one pass (no per-rule scans)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rule_counts(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """``rules`` = [(name, violation predicate)] -> one row per rule with its violation count."""
    agg = df.agg(*[F.count(F.when(cond, 1)).alias(f"_r{i}") for i, (_, cond) in enumerate(rules)],
                 F.count(F.lit(1)).alias("checked_rows"))
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").alias("violations"))
                     for i, (name, _) in enumerate(rules)])
    return agg.select(F.inline(rows), "checked_rows")


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def key_difference(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Rows of keys present on one side only (multiset difference both ways)."""
    ka, kb = a.select(*keys), b.select(*keys)
    return (ka.exceptAll(kb).withColumn("side", F.lit("only_left"))
              .unionByName(kb.exceptAll(ka).withColumn("side", F.lit("only_right"))))
