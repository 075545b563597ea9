"""Approximate nearest neighbours by low-dimensional stable projections, kd-trees and a chi-square stopping test.

Vectors are scaled to length one, so that the largest cosine is the smallest distance, and projected by a few Gaussian
directions. For two vectors at distance d, the squared projected distance over d**2 follows a chi-square law. A query walks
through the projected points from near to far and verifies them on the original vectors; it stops when a vector closer
than the k-th found so far would, with the chosen confidence, have been projected nearer than what is still unvisited.

The upper levels of the tree are fitted on a bounded sample and split all vectors into cells, and large cells into blocks that fit
a task; the lower levels are built in each block. A query first searches its own cell, and then those cells that its stopping
test doesn't exclude.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.storage import stored

#: Projected dimensions (even, for the closed form of the chi-square law).
DIRECTIONS = 8
#: Rows that the upper levels are fitted on, at most; cells at most; rows of a block; rows of a leaf; queries of a block.
SAMPLE, CELLS, BLOCK, LEAF, QUERIES = 20_000, 1024, 16_384, 64, 8_192


def chi_square_cdf(x: np.ndarray, m: int = DIRECTIONS) -> np.ndarray:
    half = np.asarray(x, dtype=float) / 2
    terms = sum(half**i / math.factorial(i) for i in range(m // 2))
    return 1 - np.exp(-half) * terms


def projection(dim: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, DIRECTIONS))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Row by row in one order of summation, so that equal vectors get equal scores."""
    return (vectors * query).sum(axis=1) / (np.sqrt((vectors * vectors).sum(axis=1)) * math.sqrt((query * query).sum()))


class Splits:
    """The upper levels: a heap of (dimension, threshold), depth levels deep, and the region of each cell."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.dims, self.at = np.zeros(2**depth, dtype=int), np.zeros(2**depth)
        self.low, self.high = (np.full((2**depth, DIRECTIONS), s * np.inf) for s in (-1, 1))
        self._split(1, 0, points, self.low[0].copy(), self.high[0].copy())

    def _split(self, node: int, level: int, points: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        if level == self.depth:
            cell = node - 2**self.depth
            self.low[cell], self.high[cell] = low, high
            return
        dim = int(np.argmax(points.max(axis=0) - points.min(axis=0))) if len(points) else 0
        at = float(np.median(points[:, dim])) if len(points) else 0.0
        self.dims[node], self.at[node] = dim, at
        left = points[:, dim] <= at
        upper, lower = high.copy(), low.copy()
        upper[dim], lower[dim] = min(at, high[dim]), max(at, low[dim])
        self._split(2 * node, level + 1, points[left], low, upper)
        self._split(2 * node + 1, level + 1, points[~left], lower, high)

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), dtype=int)
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), self.dims[node]] > self.at[node])
        return node - 2**self.depth

    def squared_distance(self, point: np.ndarray) -> np.ndarray:
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return (gap * gap).sum(axis=1)


def _leaves(points: np.ndarray) -> list[np.ndarray]:
    """Row numbers of each leaf of a kd-tree."""
    out, waiting = [], [np.arange(len(points))]
    while waiting:
        rows = waiting.pop()
        here = points[rows]
        spread = here.max(axis=0) - here.min(axis=0)
        if len(rows) <= LEAF or not spread.any():
            out.append(rows)
            continue
        order = np.argpartition(here[:, int(np.argmax(spread))], len(rows) // 2)
        waiting += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search_block(ids, vectors, query_ids, queries, bounds, k: int, seed: int, confidence: float):
    """(query id, id, score) of the nearest found; ``bounds``: squared distance of the k-th found elsewhere, or infinity."""
    directions = projection(vectors.shape[1], seed)
    points = _unit(vectors) @ directions
    leaves = _leaves(points)
    low = np.array([points[rows].min(axis=0) for rows in leaves])
    high = np.array([points[rows].max(axis=0) for rows in leaves])
    out = []
    for query_id, query, point, bound in zip(query_ids, queries, _unit(queries) @ directions, bounds):
        gap = np.maximum(np.maximum(low - point, point - high), 0)
        distance = (gap * gap).sum(axis=1)
        order = np.argsort(distance, kind="stable")
        found_ids, found_scores, at, step = np.zeros(0, dtype=np.int64), np.zeros(0), 0, 1
        while at < len(order):
            kth = 2 - 2 * found_scores[-1] if len(found_ids) == k else np.inf
            kth = max(0.0, min(kth, bound))
            nearest = distance[order[at]]
            if np.isfinite(kth) and nearest > 0 and (kth <= 1e-15 or chi_square_cdf(nearest / kth) >= confidence):
                break
            rows = np.concatenate([leaves[i] for i in order[at : at + step]])
            at, step = at + step, min(2 * step, 32)
            rows = rows[ids[rows] != query_id]
            all_ids = np.concatenate([found_ids, ids[rows]])
            scores = np.concatenate([found_scores, cosines(vectors[rows], query)])
            best = _best(scores, all_ids, k)
            found_ids, found_scores = all_ids[best], scores[best]
        out += [(query_id, i, s) for i, s in zip(found_ids, found_scores)]
    return out


def usable(vector: Column) -> Column:
    """Neither null, zero nor empty, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5, seed: int = 3,
    confidence: float = 0.98,
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): the k nearest found for each query row, by cosine.

    Rows without a key, or whose vector isn't usable or has another length than most, take no part. A query's own key is no candidate
    for it; a key that repeats gives each of its rows, and a repeated query one answer. No rows give no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col(key).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asks"))
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, count = sizes[0]["dim"], sizes[0]["count"]
    rows = rows.where(F.size("v") == dim)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()
    depth = min(int(math.log2(CELLS)), max(0, math.ceil(math.log2(max(1, count / BLOCK)))))
    directions = projection(dim, seed)
    splits = Splits(_unit(_matrix(sample.column("v").combine_chunks())) @ directions, depth)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = splits.cell(_unit(_matrix(batch.column(1))) @ directions) if len(batch) else np.zeros(0, dtype=int)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], names=["id", "v", "asks", "cell"])

    placed = stored(rows.mapInArrow(place, "id long, v array<double>, asks boolean, cell int"), "vectors")
    blocks = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))  # at most CELLS rows
    placed = placed.join(F.broadcast(blocks), "cell")
    queries = placed.where("asks").dropDuplicates(["id"]).select("id", "v", "cell")
    groups = max(1, math.ceil(queries.count() / QUERIES))
    data = placed.select(
        "cell", F.pmod(F.xxhash64(F.lit(9), "id", F.monotonically_increasing_id()), "blocks").cast("int").alias("block"), "id", "v")
    data = stored(data, "blocks")
    data = data.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))) if groups > 1 else data.withColumn("part", F.lit(0))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            found = search_block(
                left.column("id").to_numpy(), _matrix(left.column("v").combine_chunks()), right.column("id").to_numpy(),
                _matrix(right.column("v").combine_chunks()), right.column("bound").to_numpy(), k, seed, confidence)
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    def visit(asked: DataFrame) -> DataFrame:
        """``asked``: id, v, cell, bound."""
        asked = asked.join(F.broadcast(blocks), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        asked = asked.select("cell", "block", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("part"), "id", "v", "bound")
        by = ["cell", "block", "part"]
        return data.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(search, "query_id long, vec_id long, score double")

    place_of = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    top = lambda found: found.withColumn("rank", place_of).where(F.col("rank") <= k)
    home = stored(top(visit(queries.withColumn("bound", F.lit(float("inf"))))).drop("rank"), "found")
    bounds = home.groupBy(F.col("query_id").alias("id")).agg(
        F.when(F.count("*") >= k, F.greatest(F.lit(0.0), 2 - 2 * F.min("score"))).otherwise(F.lit(float("inf"))).alias("bound"))

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            take, cells = [], []
            points = _unit(_matrix(batch.column(1))) @ directions
            for row, (point, home_cell, bound) in enumerate(zip(points, batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                distance = splits.squared_distance(point)
                open_ = distance <= 0
                if not math.isfinite(bound):
                    open_[:] = True
                elif bound > 1e-15:
                    open_ |= chi_square_cdf(distance / bound) < confidence
                open_[home_cell] = False
                chosen = np.flatnonzero(open_)
                take += [row] * len(chosen)
                cells += chosen.tolist()
            kept = batch.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1), pa.array(cells, pa.int32()), kept.column(3)], names=["id", "v", "cell", "bound"])

    others = queries.join(bounds, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    others = others.select("id", "v", "cell", "bound").mapInArrow(elsewhere, "id long, v array<double>, cell int, bound double")
    return top(home.unionByName(visit(others))).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
