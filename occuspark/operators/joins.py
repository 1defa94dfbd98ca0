"""Join patterns.

Broadcasts are used only for sides with a proven size bound (a 1-row
aggregate, a constant table, a fixed dimension).  Everything else is left to
Catalyst + AQE, which converts a join to broadcast at runtime when the
*measured* side is small and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_fallback(facts: DataFrame, levels: list[tuple[list[str], DataFrame, str]],
                    out: str, default: Column | None = None) -> DataFrame:
    """Hierarchical lookup: first level whose key matches wins, then the default.

    ``levels`` is a list of ``(keys, table, value_col)``; a level with no keys
    is a one-row global table, broadcast (it has exactly one row).
    """
    vals = []
    for i, (keys, table, col) in enumerate(levels):
        alias = f"_lv{i}"
        t = table.select(*keys, F.col(col).alias(alias))
        if keys:
            facts = facts.join(t, keys, "left")
        else:
            facts = facts.crossJoin(F.broadcast(t))
        vals.append(F.col(alias))
    if default is not None:
        vals.append(default)
    return facts.withColumn(out, F.coalesce(*vals)).drop(*[f"_lv{i}" for i in range(len(levels))])
