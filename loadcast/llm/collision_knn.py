"""Nearest neighbours by largest inner product through collision counting.

Vectors are scaled by the largest norm and given one more component, so that a larger inner product is a smaller
distance. Each of `PROJECTIONS` random lines holds a block's vectors as a sorted array. A query opens a window around
its own place on every line and widens all windows step by step (virtual rehashing). A vector that lies in enough
windows is verified by its exact inner product. A query ends when a vector at the distance of its k-th best so far
would in three of four cases already have been verified; nearer ones are surer.

Vectors that are null, zero, or hold null or non-finite components take no part; vectors are compared within their
length only. The index is not fitted on data: lines come from a fixed seed, and every vector is in it. Ties go to the
smaller id, and equal vectors are neighbours like any other; rows that share an id are rows of their own, but never
neighbours of that id. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.llm.common import store

PROJECTIONS = 64
# Share of the lines on which a vector must fall into the window to be verified.
COLLISIONS = 0.7
# First half-width of the windows, and its growth from step to step.
FIRST_WIDTH, GROWTH = 1.0, 1.12
# Standard deviations by which a vector as far as the k-th best must be over the collision threshold: three in four.
CERTAINTY = 0.7
BLOCK_ROWS, QUERY_ROWS = 65536, 1024
SEED = 7


def _erf(x: float) -> float:
    return math.erf(x / math.sqrt(2))


class LineIndex:
    """The sorted projections of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, scale: float):
        # Lines and bounds see the vectors in units of the largest component, so that no square leaves the range.
        self.ids, self.vectors, self.largest, self.scale = ids, vectors, largest, scale
        vectors = vectors / largest
        self.scaled = vectors
        lines = np.random.default_rng(SEED).standard_normal((vectors.shape[1] + 1, PROJECTIONS))
        square = np.minimum((vectors * vectors).sum(1) / scale**2, 1.0)
        full = np.concatenate((vectors / scale, np.sqrt(1 - square)[:, None]), 1)
        places = full @ lines
        self.order = np.ascontiguousarray(np.argsort(places, axis=0, kind="stable").T)
        self.places = np.take_along_axis(places, self.order.T, 0).T.copy()
        self.lines = lines

    def _bounds(self, centres: np.ndarray, width: float) -> np.ndarray:
        """Per query and line, the first place inside the window and the first behind it."""
        out = np.empty((len(centres), PROJECTIONS, 2), np.int64)
        for j in range(PROJECTIONS):
            out[:, j, 0] = np.searchsorted(self.places[j], centres[:, j] - width, "left")
            out[:, j, 1] = np.searchsorted(self.places[j], centres[:, j] + width, "right")
        return out

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """For every query the ids and inner products of its `k` nearest verified vectors."""
        units = queries / np.abs(queries).max(1, keepdims=True)
        units /= np.sqrt((units * units).sum(1))[:, None]
        centres = units @ self.lines[:-1]
        threshold = math.ceil(COLLISIONS * PROJECTIONS)
        n = len(self.ids)
        state = [None] * len(queries)
        active = np.arange(len(queries))
        width, before = FIRST_WIDTH, None
        while len(active):
            bounds = self._bounds(centres[active], width)
            going = []
            for row, q in enumerate(active.tolist()):
                if state[q] is None:
                    state[q] = [self._first_count(bounds[row]), np.zeros(n, bool), [], []]
                else:
                    self._widen(state[q][0], before[row], bounds[row])
                done = self._verify(state[q], query_ids[q], units[q], threshold)
                inside = bool((bounds[row, :, 1] - bounds[row, :, 0] == n).all())
                if inside or done >= k and self._certain(state[q], k, width):
                    yield q, *self._best(state[q], k, queries[q])
                    state[q] = False
                else:
                    going.append(row)
            before, active = bounds[going], active[going]
            width *= GROWTH

    def _first_count(self, bounds: np.ndarray) -> np.ndarray:
        """Windows that each vector is in; lines with wide windows are counted by what is outside."""
        n = len(self.ids)
        slices, outside, wide = [], [], 0
        for j, (low, high) in enumerate(bounds.tolist()):
            if 2 * (high - low) <= n:
                slices.append(self.order[j, low:high])
            else:
                wide += 1
                outside += [self.order[j, :low], self.order[j, high:]]
        count = np.full(n, wide, np.int64)
        if slices:
            count += np.bincount(np.concatenate(slices), minlength=n)
        if outside:
            count -= np.bincount(np.concatenate(outside), minlength=n)
        return count

    def _widen(self, count: np.ndarray, old: np.ndarray, new: np.ndarray) -> None:
        rings = []
        for j, ((a, b), (c, d)) in enumerate(zip(old.tolist(), new.tolist())):
            rings += [self.order[j, c:a], self.order[j, b:d]]
        count += np.bincount(np.concatenate(rings), minlength=len(count))

    def _verify(self, state: list, query_id: int, unit: np.ndarray, threshold: int) -> int:
        count, seen, found, scores = state
        fresh = np.flatnonzero((count >= threshold) & ~seen)
        seen[fresh] = True
        fresh = fresh[self.ids[fresh] != query_id]
        if len(fresh):
            found.append(fresh)
            scores.append(self.scaled[fresh] @ unit)
        return sum(map(len, found))

    def _certain(self, state: list, k: int, width: float) -> bool:
        scores = np.concatenate(state[3])
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        distance = math.sqrt(max(2 - 2 * kth / self.scale, 1e-12))
        chance = _erf(width / distance)
        spread = math.sqrt(PROJECTIONS * chance * (1 - chance))
        return PROJECTIONS * chance - CERTAINTY * spread >= COLLISIONS * PROJECTIONS

    def _best(self, state: list, k: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not state[2]:
            return self.ids[:0], np.zeros(0)
        found, scores = np.concatenate(state[2]), np.concatenate(state[3])
        with np.errstate(over="ignore", invalid="ignore"):
            exact = (self.vectors[found] * query).sum(1)
        if len(found) > k and np.isfinite(exact).all():
            # The product of a matrix may round equal rows differently; near the k-th place all are computed anew.
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            near = scores >= kth - 1e-9 * (abs(kth) + 1e-9 * self.scale)
            found, exact = found[near], exact[near]
        # Products beyond the range of doubles are infinite and tie; one without a value counts as lowest.
        scores = np.where(np.isnan(exact), -np.inf, exact)
        order = np.lexsort((self.ids[found], -scores))[:k]
        return self.ids[found[order]], scores[order]


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """`(vec_id, vector, dim)` of the vectors that take part."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0)
    ).withColumn("dim", F.size("vector"))


FOUND = "query_id long, vec_id long, score double"


def nearest(
    df: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: the `k` nearest found of every row for which `is_query` holds. The
    condition is on `vec_id`."""
    vectors = store(usable(df, vec_id, vector), "vectors")
    largest = vectors.groupBy("dim").agg(F.max(F.aggregate("vector", F.lit(0.0), lambda t, x: F.greatest(t, F.abs(x)))).alias("largest"))
    vectors = store(vectors.join(F.broadcast(largest), "dim"), "measured")
    sizes = vectors.groupBy("dim", "largest").agg(
        F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"),
        F.greatest(F.ceil(F.count_if(is_query) / QUERY_ROWS), F.lit(1)).alias("parts"),
        F.sqrt(F.max(F.aggregate(
            "vector", F.lit(0.0), lambda t, x: t + (x / F.col("largest")) * (x / F.col("largest"))
        ))).alias("scale"),
    )
    sized = vectors.join(sizes, ["dim", "largest"])
    part = F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1))
    block = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    data = sized.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), "blocks").cast("int"))
    data = data.select("dim", "block", part.alias("part"), "vec_id", "vector", "largest", "scale")
    asked = sized.filter(is_query).withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts").cast("int"))
    asked = asked.select("dim", block.alias("block"), "part", "vec_id", "vector")
    # Fresh columns: both sides come from the same table.
    asked = asked.toDF("dim", "block", "part", "vec_id", "vector")

    def matrix(table: pa.Table) -> np.ndarray:
        return table.column("vector").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if rows.num_rows and queries.num_rows:
            largest, scale = rows.column("largest")[0].as_py(), rows.column("scale")[0].as_py()
            index = LineIndex(rows.column("vec_id").to_numpy(), matrix(rows), largest, scale)
            ids = queries.column("vec_id").to_numpy()
            for q, near, scores in index.search(ids, matrix(queries), k):
                found.append((np.full(len(near), ids[q]), near, scores))
        columns = [np.concatenate(c) for c in zip(*found)] or [np.zeros(0)] * 3
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"])

    keys = ("dim", "block", "part")
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, FOUND)
    # Each task keeps the best k of a query before the shuffle.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
