"""Approximate nearest neighbours: stable projections in a kd-tree, verified until a chi-square test holds.

A Gaussian (2-stable) projection to m dimensions scales the squared distance of two points by a chi-square variable with m
degrees of freedom.  A kd-tree over the projected points yields leaves in order of projected distance; their points are
verified at their true distance.  Once the next leaf lies so far out that a point as near as the k-th best found would have
come earlier with probability ``CONFIDENCE``, the search stops.

Rows are split into blocks and queries into chunks by a hash of the id; every pair of a block and a chunk is one bounded
task, and the best of all blocks are merged.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

PROJECTED = 8  # even, so that the chi-square distribution has a closed form
CONFIDENCE = 0.97
LEAF = 64
BLOCK_ROWS = 20_000
CHUNK_QUERIES = 2_000
SEED = 11


def chi_square_cdf(x: float, freedom: int) -> float:
    """For an even number of degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(freedom // 2))


def stop_ratio(confidence: float = CONFIDENCE, freedom: int = PROJECTED) -> float:
    """Smallest squared projected over squared true distance at which the test holds."""
    low, high = 0.0, 1000.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if chi_square_cdf(middle, freedom) >= confidence else (middle, high)
    return high


class ProjectedTree:
    """kd-tree over projected points; nodes keep the bounding box of their points."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.root = self._node(np.arange(len(points)))

    def _node(self, rows: np.ndarray) -> tuple:
        own = self.points[rows]
        low, high = own.min(axis=0), own.max(axis=0)
        if len(rows) <= LEAF or (low == high).all():
            return low, high, rows, None
        axis = int((high - low).argmax())
        order = rows[np.argpartition(own[:, axis], len(rows) // 2)]
        half = len(rows) // 2
        return low, high, None, (self._node(order[:half]), self._node(order[half:]))

    def leaves(self, query: np.ndarray):
        """(squared projected distance, rows) of the leaves, nearest first."""
        count, queue = 0, [(0.0, 0, self.root)]
        while queue:
            distance, _, (_, _, rows, children) = heapq.heappop(queue)
            if children is None:
                yield distance, rows
                continue
            for child in children:
                gap = np.maximum(0, np.maximum(child[0] - query, query - child[1]))
                count += 1
                heapq.heappush(queue, (float(gap @ gap), count, child))


def _without_surplus(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows to index: of equal vectors only the k + 1 smallest ids can be among anyone's k nearest."""
    weights = np.random.default_rng(SEED).integers(0, 1 << 63, vectors.shape[1], dtype=np.uint64) | np.uint64(1)
    key = (vectors.view(np.uint64) * weights).sum(axis=1)
    order = np.lexsort((ids, key))
    same = np.concatenate(([False], (key[order][1:] == key[order][:-1]) & (vectors[order][1:] == vectors[order][:-1]).all(axis=1)))
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    return order[np.arange(len(order)) - start <= k]


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple]:
    """(query_id, id, distance) of the k nearest found in one block for every query, itself excluded."""
    rows = _without_surplus(ids, vectors, k)
    ids, vectors = ids[rows], vectors[rows]
    projection = np.random.default_rng(SEED).standard_normal((vectors.shape[1], PROJECTED))
    tree, ratio = ProjectedTree(vectors @ projection), stop_ratio()
    out = []
    for query_id, query, projected in zip(query_ids, queries, queries @ projection, strict=True):
        best, best_ids = np.empty(0), np.empty(0, np.int64)
        for distance, leaf in tree.leaves(projected):
            if len(best) == k and distance > ratio * best[-1] ** 2:
                break
            leaf = leaf[ids[leaf] != query_id]
            best = np.append(best, np.sqrt(((vectors[leaf] - query) ** 2).sum(axis=1)))
            best_ids = np.append(best_ids, ids[leaf])
            order = np.lexsort((best_ids, best))[:k]
            best, best_ids = best[order], best_ids[order]
        out += [(query_id, i, d) for i, d in zip(best_ids, best, strict=True)]
    return out


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v, dims) in double precision, without null, empty, zero or non-finite vectors and rows without an id."""
    limit = "double('infinity')"
    return (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
        .filter(f"vec_id IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = {limit})")
        .filter("exists(v, x -> x <> 0)").withColumn("dims", F.size("v"))
    )


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest among ``vectors``, ties to the smaller id.

    Both come from :func:`usable`; only vectors of the query's length are compared, and a query's own id is left out.
    Fewer candidates give fewer rows; repeated ids count as separate rows.
    """
    counts = vectors.agg(F.count(F.lit(1))).first()[0], queries.agg(F.count(F.lit(1))).first()[0]
    blocks, chunks = max(1, -(-counts[0] // BLOCK_ROWS)), max(1, -(-counts[1] // CHUNK_QUERIES))
    spread = "explode(sequence(0, {})) AS {}"
    rows = vectors.selectExpr("vec_id", "v", "dims", f"pmod(xxhash64(vec_id), {blocks}) AS block", spread.format(chunks - 1, "chunk"))
    asked = queries.selectExpr("vec_id", "v", "dims", f"pmod(xxhash64(vec_id), {chunks}) AS chunk", spread.format(blocks - 1, "block"))

    def matrix(part: pd.DataFrame) -> np.ndarray:
        return np.stack(part["v"].to_numpy()).astype(np.float64) + 0.0

    def search(own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(asking):
            found = search_block(own["vec_id"].to_numpy(), matrix(own), asking["vec_id"].to_numpy(), matrix(asking), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    key = [F.col("dims").cast("long"), F.col("block").cast("long"), F.col("chunk").cast("long")]
    found = rows.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(search, "query_id long, vec_id long, score double")
    place = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
