"""Set operations and table maintenance.

Upserts are expressed as joins + unions that produce the next version of a
table (written with overwrite, or MERGE INTO where the table format allows);
all of them are single-shuffle plans keyed by the natural key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_tolerant(a: DataFrame, b: DataFrame) -> DataFrame:
    """Schema-tolerant union: missing columns become NULL."""
    return a.unionByName(b, allowMissingColumns=True)


def upsert_keep(existing: DataFrame, incoming: DataFrame, keys, keep_existing=("created_at", "status")) -> DataFrame:
    """Upsert by natural key: incoming values win, except ``keep_existing`` columns of rows
    that already exist; unmatched existing rows stay."""
    cols = [c for c in incoming.columns if c not in keys]
    e = existing.select(*keys, *[F.col(c).alias(f"_e_{c}") for c in cols], F.lit(1).alias("_e"))
    i = incoming.select(*keys, *[F.col(c).alias(f"_i_{c}") for c in cols], F.lit(1).alias("_i"))
    j = e.join(i, keys, "full")
    out = []
    for c in cols:
        if c in keep_existing:
            out.append(F.when(F.col("_e") == 1, F.col(f"_e_{c}")).otherwise(F.col(f"_i_{c}")).alias(c))
        else:
            out.append(F.when(F.col("_i") == 1, F.col(f"_i_{c}")).otherwise(F.col(f"_e_{c}")).alias(c))
    action = (F.when((F.col("_e") == 1) & (F.col("_i") == 1), "updated").when(F.col("_i") == 1, "inserted")
               .otherwise("unchanged"))
    return j.select(*keys, *out, action.alias("action"))


def replace_by_key(existing: DataFrame, incoming: DataFrame, keys) -> DataFrame:
    """Upsert that replaces every column of matching rows."""
    return existing.join(incoming.select(*keys), keys, "left_anti").unionByName(incoming)


def replace_children(children: DataFrame, new_children: DataFrame, parent_key: str) -> DataFrame:
    """Delete all children of the parents present in ``new_children``, then insert the new ones."""
    touched = new_children.select(parent_key).distinct()
    return children.join(touched, parent_key, "left_anti").unionByName(new_children)


def insert_missing(existing: DataFrame, candidates: DataFrame, keys) -> DataFrame:
    """Insert only candidate rows whose key is absent (anti-join), keep everything that exists."""
    return existing.unionByName(candidates.join(existing.select(*keys), keys, "left_anti"))


def purge_source(df: DataFrame, source: str, col: str = "source_name") -> DataFrame:
    return df.filter(F.col(col).isNull() | (F.col(col) != source))


def expand_sets(items: DataFrame, sets_col: str = "sets") -> DataFrame:
    """One row per planned set: ``explode(sequence(1, sets))``."""
    return items.withColumn("set_number", F.explode(F.sequence(F.lit(1), F.greatest(F.col(sets_col), F.lit(1)))))
