"""Approximate nearest neighbours from stable projections indexed by kd-trees.

Gaussian projections to a few dimensions are 2-stable: the squared projected
distance over the squared distance is chi-square with that many degrees of
freedom.  Each task indexes its rows by a kd-tree over the projections and visits
leaves in the order of projected distance.  A row is verified on the original
vectors only while its projected distance passes the chi-square test against the
k-th distance found so far: a row that fails is as near as that with a probability
of at most ``1 - certainty``.  When a leaf's box fails, so does every later one.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .common import cut_lineage

RESULT = "query_id long, rank int, vec_id long, score double"


def chi_square_cdf(x: float, m: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    half = x / 2
    return 1.0 - math.exp(-half) * sum(half ** i / math.factorial(i) for i in range(m // 2))


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, m) < p else (low, mid)
    return high


def projections(d: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, d]).standard_normal((d, m))


class Tree:
    """A kd-tree over points: halves at the median of the widest side, with each node's bounding box."""

    def __init__(self, points: np.ndarray, leaf: int = 64):
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray | None] = []
        self.points = points
        self._add(points, np.arange(len(points)), leaf)

    def _add(self, points: np.ndarray, rows: np.ndarray, leaf: int) -> int:
        here = points[rows]
        low, high = here.min(0), here.max(0)
        k = len(self.boxes)
        self.boxes.append((low, high))
        self.children.append(None)
        self.rows.append(None)
        side = int(np.argmax(high - low))
        if len(rows) <= leaf or high[side] == low[side]:
            self.rows[k] = rows
            return k
        order = np.argpartition(here[:, side], len(rows) // 2)
        half = len(rows) // 2
        self.children[k] = (self._add(points, rows[order[:half]], leaf), self._add(points, rows[order[half:]], leaf))
        return k

    def finish(self) -> Tree:
        self.low = np.array([b[0] for b in self.boxes])
        self.high = np.array([b[1] for b in self.boxes])
        return self

    def leaves(self, point: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """Leaves' rows in the order of the squared distance of their boxes."""
        gap = np.maximum(0.0, np.maximum(self.low - point, point - self.high))
        far = np.einsum("ij,ij->i", gap, gap).tolist()
        heap = [(far[0], 0)]
        while heap:
            at, k = heapq.heappop(heap)
            if self.children[k] is None:
                yield at, self.rows[k]
            else:
                for c in self.children[k]:
                    heapq.heappush(heap, (far[c], c))


def nearest(tree: Tree, ids: np.ndarray, x: np.ndarray, own: int, query: np.ndarray, projected: np.ndarray, k: int,
            limit: float, known: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and squared distances of up to ``k`` near rows, and the number of rows verified.

    ``known``: a squared distance that k rows of the table are within; it only serves the
    test, so that every tree gives ``k`` rows if it has them.
    """
    best_i, best_d, verified = np.empty(0, dtype=np.int64), np.empty(0), 0
    for at, rows in tree.leaves(projected):
        own_kth = best_d[-1] if len(best_d) == k else math.inf
        kth = min(known, own_kth) if len(best_d) == k else math.inf
        if at > limit * kth:
            break
        gap = tree.points[rows] - projected
        rows = rows[np.einsum("ij,ij->i", gap, gap) <= limit * kth]
        verified += len(rows)
        gap = x[rows] - query
        dist, new = np.einsum("ij,ij->i", gap, gap), ids[rows]
        ok = (dist <= own_kth) & (new != own)
        if ok.any():
            best_i, best_d = np.concatenate([best_i, new[ok]]), np.concatenate([best_d, dist[ok]])
            order = np.lexsort((best_i, best_d))[:k]
            best_i, best_d = best_i[order], best_d[order]
    return best_i, best_d, verified


def sample_bounds(sample: dict, block: dict, k: int) -> dict[int, np.ndarray]:
    """For each query the k-th squared distance in a bounded sample, an upper bound of the k-th of all."""
    out = {}
    for d, (q, queries) in block.items():
        ids, x = sample.get(d, (np.empty(0, dtype=np.int64), np.empty((0, d))))
        bounds = np.full(len(q), np.inf)
        for n, (own, query) in enumerate(zip(q, queries, strict=True)):
            gap = x - query
            dist = np.einsum("ij,ij->i", gap, gap)
            ok = ids != own
            if ok.sum() >= k:
                bounds[n] = np.partition(dist[ok], k - 1)[k - 1]
        out[d] = bounds
    return out


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, dimensions: int = 32, certainty: float = 0.93,
           seed: int = 11, block_rows: int = 2048, sample_rows: int = 4096, tree_rows: int = 32768) -> DataFrame:
    """Each query's ``k`` nearest rows found: ``query_id, rank, vec_id, score`` (Euclidean distance).

    Every row is indexed; a sample of at most ``sample_rows`` only bounds the
    k-th distance from above, its rows are found like all others.  A row with the query's id is the query's own.  Rows
    without an id, with a null or zero vector or with null or non-finite
    components take no part; vectors of another dimension do not meet a query;
    equal distances go to the smaller id; repeated rows rank side by side; without
    queries or candidates the result is empty.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(V.fold_identical(V.clean(vectors, nonzero=True), k))
    sample = next(V.blocks(rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows), sample_rows), {})
    limit = chi_square_quantile(certainty, dimensions)
    found = None
    for block in V.blocks(V.clean(queries, nonzero=True), block_rows):
        known = sample_bounds(sample, block, k)

        def run(batches: Iterator[pd.DataFrame], block=block, known=known) -> Iterator[pd.DataFrame]:
            flat = {d: projections(d, dimensions, seed) for d in block}
            cast = {d: m @ flat[d] for d, (_, m) in block.items()}
            held: list[pd.DataFrame] = []

            def index() -> Iterator[pd.DataFrame]:
                b = pd.concat(held)
                for d, ids, x in V.by_dimension(b["vec_id"].to_numpy(), b["v"].tolist()):
                    if d not in block:
                        continue
                    tree, out = Tree(x @ flat[d]).finish(), []
                    for n, own in enumerate(block[d][0]):
                        i, s, _ = nearest(tree, ids, x, own, block[d][1][n], cast[d][n], k, limit, known[d][n])
                        out.append(pd.DataFrame({"query_id": own, "vec_id": i, "score": np.sqrt(s)}))
                    yield pd.concat(out)

            for b in batches:
                held.append(b)
                if sum(map(len, held)) >= tree_rows:
                    yield from index()
                    held = []
            if held:
                yield from index()

        seen = rows.mapInPandas(run, "query_id long, vec_id long, score double")
        part = cut_lineage(V.ranked(seen, k, F.col("score").asc()))
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], RESULT)
