"""What the two searches share: clean vectors, identical vectors folded, queries in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clean(vectors: DataFrame, nonzero: bool = False) -> DataFrame:
    """``vec_id, v``: rows with an id and a vector of finite components (not all zero, if asked)."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("embedding").cast("array<double>").alias("v"))
    v = v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    v = v.where(F.forall("v", finite))
    return v.where(F.exists("v", lambda x: x != 0)) if nonzero else v


def fold_identical(vectors: DataFrame, k: int) -> DataFrame:
    """Of identical vectors only the ``2 * k`` first rows by id, of one id at most ``k``.

    A search for ``k`` neighbours loses nothing: equal vectors score alike, ties go
    to smaller ids, and without the rows of any one id (a query's own) ``k`` are
    left.  The limits work before the shuffle, so a vector that a third of the rows
    share is cut down where it is read.
    """
    for keys, keep in ((["v", "vec_id"], k), (["v"], 2 * k)):
        w = Window.partitionBy(*keys).orderBy("vec_id")
        vectors = vectors.withColumn("r", F.row_number().over(w)).where(F.col("r") <= keep).drop("r")
    return vectors


def blocks(queries: DataFrame, rows: int) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Query blocks of at most ``rows`` vectors, by dimension: ``{d: (ids, matrix)}``.

    Streams partition by partition; one block at a time travels with the tasks.
    """
    ids, vecs = [], []

    def pack() -> dict[int, tuple[np.ndarray, np.ndarray]]:
        sizes = np.array([len(v) for v in vecs])
        return {int(d): (np.array([i for i, v in zip(ids, vecs, strict=True) if len(v) == d], dtype=np.int64),
                         np.array([v for v in vecs if len(v) == d])) for d in np.unique(sizes)}

    for r in queries.dropDuplicates(["vec_id"]).toLocalIterator():
        ids.append(r["vec_id"])
        vecs.append(r["v"])
        if len(ids) == rows:
            yield pack()
            ids, vecs = [], []
    if ids:
        yield pack()


def by_dimension(ids: np.ndarray, vecs) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A batch's ids and vectors, grouped by dimension."""
    sizes = np.array([len(v) for v in vecs])
    for d in np.unique(sizes):
        pick = np.flatnonzero(sizes == d)
        yield int(d), ids[pick], np.array([vecs[i] for i in pick])


def ranked(found: DataFrame, k: int, best_first: Column) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(best_first, "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
