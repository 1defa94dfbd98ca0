"""Exact top-k by integer inner product with a vector-approximation file.

The file holds one byte per component: the number of the cell the component's
value falls into, of 256 between the dimension's smallest and largest value.  A
scan of the cells bounds every inner product from above and below; a row whose
upper bound is under a query's k-th best lower bound is out.  Exact vectors are
then read in the order of their bounds until the k-th exact score is no less than
every bound left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vectors as V
from .common import cut_lineage

CELLS = 256
RESULT = "query_id long, rank int, vec_id long, score long"


def integers(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id, v``: components as ``floor(scale * x)`` in double precision, of rows with finite components only."""
    return V.clean(vectors).select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def cell_ranges(exact: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Smallest and largest value of each component, by dimension (a few rows, however many vectors)."""
    rows = (exact.select(F.size("v").alias("d"), F.posexplode("v").alias("i", "x")).groupBy("d", "i")
            .agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("d", "i").collect())
    return {d: (np.array([r["lo"] for r in rows if r["d"] == d], dtype=np.int64),
                np.array([r["hi"] for r in rows if r["d"] == d], dtype=np.int64)) for d in {r["d"] for r in rows}}


def cell_of(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    width = np.maximum(1, -(-(hi - lo + 1) // CELLS))
    return ((x - lo) // width).astype(np.uint8)


def cell_bounds(cells: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest integer that a cell can stand for."""
    width = np.maximum(1, -(-(hi - lo + 1) // CELLS))
    low = lo + cells.astype(np.int64) * width
    return low, np.minimum(hi, low + width - 1)


def approximate(exact: DataFrame, ranges: dict) -> DataFrame:
    """The approximation file: ``vec_id, cells``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for d, ids, x in V.by_dimension(b["vec_id"].to_numpy(), b["v"].tolist()):
                yield pd.DataFrame({"vec_id": ids, "cells": [c.tobytes() for c in cell_of(x, *ranges[d])]})

    return exact.mapInPandas(run, "vec_id long, cells binary")


def scan(cells: DataFrame, block: dict, ranges: dict, k: int, step: int = 1024) -> DataFrame:
    """``query_id, vec_id, low, high`` of the rows that a task's own k-th best lower bounds leave."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = {d: np.full((len(q), k), -np.inf) for d, (q, _) in block.items()}
        kept: list[tuple] = []
        for b in batches:
            for d, ids, x in V.by_dimension(b["vec_id"].to_numpy(), [np.frombuffer(c, np.uint8) for c in b["cells"]]):
                if d not in block:
                    continue
                q, query = block[d]
                up, down = np.maximum(query, 0).astype(float), np.minimum(query, 0).astype(float)
                for at in range(0, len(ids), step):
                    some = ids[at:at + step]
                    a, z = (y.astype(float).T for y in cell_bounds(x[at:at + step], *ranges[d]))
                    high, low = up @ z + down @ a, up @ a + down @ z
                    slack = 1e-12 * (np.abs(query).sum(1) * max(np.abs(a).max(), np.abs(z).max()))[:, None]
                    exact = slack.max() < 1e-12 * 2.0 ** 52  # whole numbers in double precision
                    high, low = (high, low) if exact else (high + slack, low - slack)
                    low[q[:, None] == some[None, :]] = -np.inf
                    high[q[:, None] == some[None, :]] = -np.inf
                    best[d] = -np.partition(-np.concatenate([best[d], low], axis=1), k - 1, axis=1)[:, :k]
                    i, j = np.nonzero((high >= best[d].min(1)[:, None]) & np.isfinite(high))
                    kept.append((d, i, q[i], some[j], low[i, j], high[i, j]))
        for d, i, qs, ids, low, high in kept:
            ok = high >= best[d].min(1)[i]
            yield pd.DataFrame({"query_id": qs[ok], "vec_id": ids[ok], "low": low[ok], "high": high[ok]})

    return cells.mapInPandas(run, "query_id long, vec_id long, low double, high double")


def read_exact(pairs: DataFrame, exact: DataFrame, block: dict) -> DataFrame:
    """``query_id, vec_id, score`` of candidate pairs, from the exact vectors."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {int(i): (m, n) for _, (q, m) in block.items() for n, i in enumerate(q)}
        for b in batches:
            score = [int(np.dot(place[i][0][place[i][1]], np.asarray(v, dtype=np.int64)))
                     for i, v in zip(b["query_id"], b["v"], strict=True)]
            yield pd.DataFrame({"query_id": b["query_id"], "vec_id": b["vec_id"], "score": score})

    return (pairs.select("query_id", "vec_id").join(exact, "vec_id").select("query_id", "vec_id", "v")
            .mapInPandas(run, "query_id long, vec_id long, score long"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, block_rows: int = 2048,
           first: int = 32) -> DataFrame:
    """Each query's ``k`` rows of highest integer inner product: ``query_id, rank, vec_id, score``.

    Exact; ties go to the smaller id.  A row with the query's id is the query's
    own and no candidate.  Rows without an id, with a null vector or with null or
    non-finite components take no part; vectors of another dimension than a
    query's do not meet it; repeated rows rank side by side; without queries or
    candidates the result is empty.  Sums must fit 64 bits.  ``vectors`` and
    ``queries`` hold ``vec_id`` and ``embedding``; other columns are ignored.
    """
    spark = vectors.sparkSession
    exact = cut_lineage(V.fold_identical(integers(vectors, scale), k))
    ranges = cell_ranges(exact)
    cells = cut_lineage(approximate(exact, ranges))
    found = None
    for block in V.blocks(integers(queries, scale), block_rows):
        kept = cut_lineage(scan(cells, block, ranges, k))
        by_low = Window.partitionBy("query_id").orderBy(F.col("low").desc())
        certain = (kept.withColumn("r", F.row_number().over(by_low)).where(F.col("r") <= k).groupBy("query_id")
                   .agg(F.when(F.count("*") == k, F.min("low")).otherwise(F.lit(float("-inf"))).alias("floor")))
        by_high = Window.partitionBy("query_id").orderBy(F.col("high").desc(), "vec_id")
        ids = kept.groupBy("query_id", "vec_id").agg(F.max("high").alias("high"))  # rows that share an id are read together
        order = cut_lineage(ids.join(certain, "query_id").where(F.col("high") >= F.col("floor"))
                            .withColumn("r", F.row_number().over(by_high)))
        near = cut_lineage(read_exact(order.where(F.col("r") <= first), exact, block))
        by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc())
        kth = (near.withColumn("r", F.row_number().over(by_score)).where(F.col("r") <= k).groupBy("query_id")
               .agg(F.when(F.count("*") == k, F.min("score").cast("double")).otherwise(F.lit(float("-inf")))
                    .alias("kth")))
        open_ = order.where(F.col("r") > first).join(kth, "query_id").where(F.col("high") >= F.col("kth"))
        part = cut_lineage(V.ranked(near.unionByName(read_exact(open_, exact, block)), k, F.col("score").desc()))
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], RESULT)
