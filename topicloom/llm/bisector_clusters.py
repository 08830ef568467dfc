"""Centroid clustering of integer vectors by a tournament over bisecting planes.

A vector is nearer to centroid ``j`` than to ``i`` exactly if it lies beyond the plane halfway
between them: ``2 x . (c_j - c_i) > |c_j|^2 - |c_i|^2``. Normals and thresholds of all pairs
are computed once a round. A vector starts with centroid 0 and meets 1, 2, ... in turn; each
test removes one of two centroids, so ``k - 1`` linear tests leave the nearest. On the plane
itself the smaller number stays. All of it is integer arithmetic, so ties are exact, and the
squared distance is computed for the winner alone.

A round is one pass over the vectors. A task returns a count and a sum of every centroid, so
``k`` rows a task are shuffled and ``k * dims`` numbers reach the driver, however many vectors
there are.

Defined cases: vectors that are null, of another length, or hold a null or non-finite
component take no part; nor do those with a component of 2 ** 21 or more in size, whose
squared distances may not fit a long. Rows that repeat an id are vectors of their own; among
equal hashes the first centroids are taken in order of components. A vector without an id is
clustered, but is no first centroid. With fewer than ``k`` vectors that have an id all of
them are centroids; without any the result is empty. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicloom.llm.common import stored

#: Components from this size on are left out: 64 * (2 * 64 * 2 ** 21) ** 2 still fits a long.
TOO_LARGE = 2**21


@dataclass(frozen=True)
class BisectorClusters:
    """``k`` centroids of ``dims`` components, each scaled by ``scale`` and rounded down."""

    k: int = 16
    dims: int = 64
    scale: int = 64
    rounds: int = 3
    seed: str = "1"


class Tournament:
    """Planes between all pairs of integer centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.normals = 2 * (centroids[None] - centroids[:, None])
        squares = (centroids * centroids).sum(axis=1)
        self.thresholds = squares[None] - squares[:, None]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of every row; the smaller one where two are as near."""
        won = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            # one product for each centroid that still leads somewhere, rather than a gathered normal a row
            for i in np.unique(won):
                rows = np.flatnonzero(won == i)
                beyond = x[rows] @ self.normals[i, j] > self.thresholds[i, j]
                won[rows[beyond]] = j
        return won

    def distances(self, x: np.ndarray, won: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[won]
        return (apart * apart).sum(axis=1)


def integer_vectors(rows: DataFrame, how: BisectorClusters) -> DataFrame:
    """``(vec_id, x)`` of the vectors that take part, ``x`` as longs."""
    v = F.transform("embedding", lambda c: c.cast("double"))
    # NaN is larger than any number
    usable = F.forall(v, lambda c: F.coalesce(F.abs(c) < TOO_LARGE, F.lit(False)))
    return rows.where((F.size("embedding") == how.dims) & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, lambda c: F.floor(c * how.scale)).alias("x")
    )


def first_centroids(vectors: DataFrame, how: BisectorClusters) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hashes."""
    name = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    picked = vectors.where("vec_id is not null").select(name.alias("name"), "x").orderBy("name", "x").limit(how.k)
    return np.array([r.x for r in picked.collect()], np.int64).reshape(-1, how.dims)


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index("x"))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def moved(vectors: DataFrame, centroids: np.ndarray, how: BisectorClusters) -> np.ndarray:
    """The centroids after one round; those without vectors stay."""
    planes = Tournament(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            x = _matrix(batch, how.dims)
            won = planes.nearest(x)
            for i in np.unique(won):
                sums[i] += x[won == i].sum(axis=0)
            counts += np.bincount(won, minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"],
        )

    parts = vectors.select("x").mapInArrow(add, "cluster int, n bigint, sums array<bigint>")
    # decimals, as the sum over all tasks may not fit a long
    spread = parts.select("cluster", "n", F.posexplode("sums").alias("pos", "s"))
    total = spread.groupBy("cluster", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    after = centroids.copy()
    for row in total.collect():
        after[row.cluster, row.pos] = int(row.s) // row.n
    return after


def assigned(vectors: DataFrame, centroids: np.ndarray, how: BisectorClusters) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every vector."""
    planes = Tournament(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, how.dims)
            won = planes.nearest(x)
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(won.astype(np.int32)), pa.array(planes.distances(x, won))], ["vec_id", "cluster", "distance"]
            )

    return vectors.select("vec_id", "x").mapInArrow(place, "vec_id bigint, cluster int, distance bigint")


def clustered(rows: DataFrame, how: BisectorClusters = BisectorClusters()) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid)`` of ``(vec_id, embedding)``.

    ``centroid`` holds the components of the vector's final centroid.
    """
    vectors = stored(integer_vectors(rows, how), "integer_vectors")
    centroids = first_centroids(vectors, how)
    if not len(centroids):
        # nobody has an id that could name a first centroid
        vectors, centroids = vectors.limit(0), np.zeros((1, how.dims), np.int64)
    for _ in range(how.rounds):
        centroids = moved(vectors, centroids, how)
    placed = stored(assigned(vectors, centroids, how), "assigned_vectors")
    # one row a centroid, so k rows are sent to every task
    sums = {r.cluster: r.inertia for r in placed.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    told = rows.sparkSession.createDataFrame(
        [(i, sums[i], sum(sums.values()), centroids[i].tolist()) for i in sorted(sums)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>",
    )
    return placed.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def centroid_name(centroid: str = "centroid"):
    """SHA-256 of the components as decimal numbers joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda c: c.cast("string")), ",").cast("binary"), 256)
