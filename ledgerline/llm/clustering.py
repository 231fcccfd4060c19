"""Clusters of vectors around centroids, exact in integers.

Every round builds a vantage-point tree over the centroids on the driver and broadcasts it.
A node holds one centroid (the vantage point), the others split at their median distance to
it, and the least and greatest distance in each half.  For a vector, a subtree can hold
nothing nearer than ``low - d`` or ``d - high``, d its distance to the vantage point.  Each
vector visits the open subtree of its smallest such bound first, and leaves out only those
whose bound is above its best distance: a bound that equals it stays open (inclusive), since
a centroid of a smaller number may lie there.  Bounds are floats and get a slack for their
rounding; distances to centroids, ties and sums are integers.  The vectors of a batch search
at the same time: each step takes one node for every vector.

Vectors never move.  A task sums its vectors by cluster and component, and only those sums
(clusters x components, both parameters) are added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written
from .words import return_memory

DIMENSIONS, SCALE, CLUSTERS, ROUNDS = 64, 64, 16, 3
#: Scaled components are below this in size, so that squared distances fit 64 bits (for 4,096 components at most).
LARGEST = 1 << 24
#: Centroids in a leaf, and vectors that search at once.
LEAF, AT_ONCE = 4, 4096
#: Bounds are lowered by this share of the distances they come from.
SLACK = 1e-9


@dataclass
class Node:
    """``vantage`` and the children for an inner node, ``members`` for a leaf; ``low`` and ``high`` are
    the distances of the subtree's centroids to the parent's vantage point."""

    low: float
    high: float
    members: list[int]
    vantage: int = -1
    children: tuple[int, ...] = ()


class VantageTree:
    """Nearest centroid search; ``nodes[0]`` is the root."""

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids, self.leaf, self.nodes = centroids, leaf, []
        self._grow(list(range(len(centroids))), 0.0, np.inf)

    def _grow(self, members: list[int], low: float, high: float) -> int:
        own = len(self.nodes)
        node = Node(low, high, members)
        self.nodes.append(node)
        if len(members) > self.leaf:
            # the member of the greatest spread of distances to the others
            points = self.centroids[members].astype(np.float64)
            spreads = [np.sqrt(((points - p) ** 2).sum(1)).var() for p in points]
            node.vantage = members[int(np.argmax(spreads))]
            rest = [m for m in members if m != node.vantage]
            away = np.sqrt(squared(self.centroids[rest], self.centroids[node.vantage]).astype(np.float64))
            order = np.argsort(away, kind="stable")
            halves = [h for h in (order[:len(order) // 2], order[len(order) // 2:]) if len(h)]
            node.members = []
            node.children = tuple(self._grow([rest[i] for i in h.tolist()], float(away[h].min()), float(away[h].max())) for h in halves)
        return own

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(cluster, squared distance, distances computed); of equal distances the smaller number."""
        n = len(vectors)
        cluster, best = np.full(n, len(self.centroids), np.int64), np.full(n, np.iinfo(np.int64).max, np.int64)
        bound = np.full((n, len(self.nodes)), np.inf)  # of open subtrees
        bound[:, 0] = 0
        work = 0

        def look(rows: np.ndarray, number: int) -> np.ndarray:
            nonlocal work
            found = squared(vectors[rows], self.centroids[number])
            work += len(rows)
            better = (found < best[rows]) | ((found == best[rows]) & (number < cluster[rows]))
            cluster[rows[better]], best[rows[better]] = number, found[better]
            return np.sqrt(found.astype(np.float64))

        active = np.arange(n)
        while len(active):
            next_ = bound[active].argmin(1)
            open_ = bound[active, next_] <= np.sqrt(best[active].astype(np.float64)) * (1 + SLACK)
            open_ &= np.isfinite(bound[active, next_])
            active, next_ = active[open_], next_[open_]
            order = np.argsort(next_, kind="stable")
            taken, first = np.unique(next_[order], return_index=True)
            for at, rows in zip(taken.tolist(), np.split(active[order], first[1:])):
                node, here = self.nodes[at], bound[rows, at]
                bound[rows, at] = np.inf
                for number in node.members:
                    look(rows, number)
                if node.children:
                    away = look(rows, node.vantage)
                    for child in node.children:
                        low, high = self.nodes[child].low, self.nodes[child].high
                        nearer = np.maximum(low - away, away - high) - SLACK * (away + high)
                        bound[rows, child] = np.maximum(np.maximum(nearer, here), 0)
        return cluster, best, work


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors x to y."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


def integer_vectors(rows: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors of exactly ``dimensions`` components, none null or non-finite, as
    floor(scale * component)."""
    vector = F.col(vector_col)
    whole = (F.size(vector) == dimensions) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    return rows.where(F.coalesce(whole, F.lit(False))).select(F.col(id_col).alias("vec_id"), v.alias("v"))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    out = np.asarray(column.flatten()).reshape(-1, dimensions)
    if len(out) and np.abs(out).max() >= LARGEST:
        raise ValueError(f"scaled components must be below {LARGEST} in size")
    return out


def first_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    """The k vectors of the smallest sha256 of ``1:<vec_id>`` (a null id: ``1:``); of equal ones the
    smaller vector first.  Fewer vectors are fewer centroids."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def _moved(vectors: DataFrame, centroids: np.ndarray, dimensions: int, leaf: int) -> np.ndarray:
    """The centroids after a round: floor(sum / count) of each cluster, empty ones as they were."""
    tree = vectors.sparkSession.sparkContext.broadcast(VantageTree(centroids, leaf))
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            v = _matrix(batch.column(0), dimensions)
            for at in range(0, len(v), AT_ONCE):
                some = v[at:at + AT_ONCE]
                cluster, _, _ = tree.value.nearest(some)
                np.add.at(sums, cluster, some)
                counts += np.bincount(cluster, minlength=k)
        full = np.flatnonzero(counts)
        grid = np.repeat(full, dimensions), np.tile(np.arange(dimensions), len(full))
        yield pa.RecordBatch.from_arrays([pa.array(grid[0]), pa.array(grid[1]), pa.array(sums[grid]), pa.array(counts[grid[0]])],
                                         ["cluster", "place", "total", "n"])
        return_memory()

    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("total", "n")]
    parts = vectors.select("v").mapInArrow(run, "cluster long, place long, total long, n long")
    out = centroids.copy()
    for r in parts.groupBy("cluster", "place").agg(*exact).collect():
        out[r.cluster, r.place] = int(r.total) // int(r.n)
    tree.unpersist()
    return out


def clusters(rows: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE,
             leaf: int = LEAF, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per kept vector.

    * Null vectors, and vectors with another number of components or a null or non-finite one,
      are left out.  Scaled components must be below 2**24 in size, else an error names the bound.
    * Ties: the cluster of the smaller number.  Rows that repeat an id each count; ids may be null.
    * With fewer than k vectors there are fewer clusters; an empty table gives an empty result.
    * Other columns are ignored.
    """
    vectors = written(integer_vectors(rows, dimensions, scale, id_col, vector_col), "vectors")
    centroids = first_centroids(vectors, k)
    schema = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema + ", cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = _moved(vectors, centroids, dimensions, leaf)
    tree = vectors.sparkSession.sparkContext.broadcast(VantageTree(centroids, leaf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), dimensions)
            for at in range(0, len(v), AT_ONCE):
                cluster, distance, _ = tree.value.nearest(v[at:at + AT_ONCE])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, AT_ONCE), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                                 ["vec_id", "cluster", "distance"])
        return_memory()

    assigned = written(vectors.mapInArrow(run, schema), "assigned")
    # one row a cluster
    sums = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    named = [(c, total, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, total in sums.items()]
    labels = vectors.sparkSession.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(labels), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
