"""Centroid clustering in whole numbers with exponion search.

Vectors become integers, so that assignments, centroids and sums are exact and the same at every partitioning. Each vector
carries its centroid, an upper bound of the distance to it and a lower bound of the distance to all others. When centroids
move, bounds move with them; a vector whose upper bound stays under the lower one, or under half the gap to the next
centroid, keeps its centroid unseen. Of the others only centroids inside a ball around their own one are looked at: the
ball's radius is twice the upper bound plus the gap to the next centroid, and each centroid has a list of all others by
distance, of which the ball is a prefix. The radius is inclusive, so that centroids that tie are looked at and the smaller
number wins. Bounds are rounded outwards.

A round is one pass over the vectors, written with their bounds to the shared folder, and one sum by centroid, added up
before it is shuffled. The driver holds centroids and their lists: `k` * `k` numbers, k being MOST_CENTROIDS at most.

Defined results: vectors that are null, of another length, or with a null or non-finite component are left out; components
beyond +-LIMIT (after scaling) count as LIMIT; rows that repeat an id are vectors of their own; a null id is kept and
ranks as an empty one among the seeds, and equal ids rank by their vectors; with fewer vectors than k there are as many
centroids as vectors; an empty table gives an empty result. Sums beyond a long are null. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import removed, written

#: Largest component: squared distances of 256 components stay within a long.
LIMIT = 1 << 26
MOST_DIMENSIONS = 256
#: The driver's lists are k * k numbers: 64 MB.
MOST_CENTROIDS = 2048
#: Bounds are widened by this part of themselves, which is far more than their rounding.
SLACK = 1e-12
#: Components of vectors that one vectorised step takes at most.
STEP = 1 << 20

_STATE = "vec_id long, v array<int>, cluster int, upper double, lower double, distance long"


class Ball:
    """Centroids, the gaps between them, and for each the others in order of their gap."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids, k = centroids, len(centroids)
        gaps = np.stack([np.sqrt(squared(centroids, c)) for c in centroids])
        gaps[np.arange(k), np.arange(k)] = -1  # first of its own list, which then leaves it out
        self.order = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
        self.gaps = np.take_along_axis(gaps, self.order, axis=1)
        self.near = self.gaps[:, 0] if k > 1 else np.full(k, np.inf)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to a vector, or to rows."""
    diff = v - c
    return np.einsum("ij,ij->i", diff, diff)


def assign(v: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, ball: Ball, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Clusters, bounds and distances after a search, and how many distances it took.

    Rows that keep their centroid unseen have the distance 0, unless `whole`.
    """
    cluster, upper, lower, distance = cluster.copy(), upper.copy(), lower.copy(), np.zeros(len(v), np.int64)
    free = np.maximum(lower, (ball.near * (0.5 * (1 - SLACK)))[cluster])  # under it no other centroid is as near
    seen = np.arange(len(v)) if whole else np.flatnonzero(upper >= free)
    distance[seen] = squared(v[seen], ball.centroids[cluster[seen]])
    upper[seen] = np.sqrt(distance[seen]) * (1 + SLACK)
    rest, looked = seen[upper[seen] >= free[seen]], len(seen)
    for c in np.unique(cluster[rest]).tolist():
        rows = rest[cluster[rest] == c]
        inside = np.searchsorted(ball.gaps[c], (2 * upper[rows] + ball.near[c]) * (1 + 4 * SLACK), side="right")
        widest = np.argsort(-inside, kind="stable")
        rows, inside = rows[widest], inside[widest]
        at, best, second = np.full(len(rows), c), distance[rows], np.full(len(rows), np.iinfo(np.int64).max)
        for place, j in enumerate(ball.order[c][: inside[0]].tolist()):
            m = int(np.searchsorted(-inside, -place, side="left"))  # rows whose ball holds this centroid
            x = squared(v[rows[:m]], ball.centroids[j])
            looked += m
            better = (x < best[:m]) | ((x == best[:m]) & (j < at[:m]))
            second[:m] = np.where(better, best[:m], np.minimum(second[:m], x))
            best[:m], at[:m] = np.where(better, x, best[:m]), np.where(better, j, at[:m])
        cluster[rows], distance[rows] = at, best
        upper[rows], lower[rows] = np.sqrt(best) * (1 + SLACK), np.where(second == np.iinfo(np.int64).max, np.inf, np.sqrt(second) * (1 - SLACK))
    return cluster, upper, lower, distance, looked


def _search(shared):
    """A pass over the vectors. shared: the centroids' ball, how far each has moved since the last pass, and whether all
    distances are wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ball, moved, last = shared.value
        dims = ball.centroids.shape[1]
        most = np.max(moved)
        second = np.partition(moved, -2)[-2] if len(moved) > 1 else 0.0
        others = np.where((moved == most) & (np.count_nonzero(moved == most) == 1), second, most)  # the farthest of all others
        for whole in batches:
            for begin in range(0, whole.num_rows, max(1, STEP // dims)):
                batch = whole.slice(begin, max(1, STEP // dims))
                v = batch.column("v").flatten().to_numpy().astype(np.int64).reshape(-1, dims)
                cluster = batch.column("cluster").to_numpy().astype(np.int64)
                upper = (batch.column("upper").to_numpy() + moved[cluster]) * (1 + SLACK)
                lower = batch.column("lower").to_numpy() * (1 - SLACK) - others[cluster] * (1 + SLACK)
                cluster, upper, lower, distance, _ = assign(v, cluster, upper, lower, ball, last)
                found = [pa.array(cluster.astype(np.int32)), pa.array(upper), pa.array(lower), pa.array(distance)]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), *found], names=["vec_id", "v", "cluster", "upper", "lower", "distance"])

    return run


def whole_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: int = 64) -> DataFrame:
    """vec_id and v, the components as integers floor(scale * x), of the vectors that count."""
    x = F.col(vector_col).cast("array<double>")
    odd = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    v = F.transform(x, lambda e: F.floor(F.least(F.greatest(e * float(scale), F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int"))
    return vectors.where((F.size(x) == dims) & ~odd).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def cluster(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: str = "1") -> tuple[DataFrame, list[tuple[int, ...]]]:
    """(vec_id, cluster, distance) of every vector that counts, in a written table, and the centroids.

    The first centroids are the k vectors whose ids have the smallest hashes. Every round assigns all vectors and moves
    each centroid that has any to the floor of their mean; then vectors are assigned once more.
    """
    if not (0 < k <= MOST_CENTROIDS and 0 < dims <= MOST_DIMENSIONS):
        raise ValueError(f"1 to {MOST_CENTROIDS} centroids of 1 to {MOST_DIMENSIONS} components")
    spark = vectors.sparkSession
    kept = whole_vectors(vectors, id_col=id_col, vector_col=vector_col, dims=dims, scale=scale)
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    found = kept.orderBy(rank, "v").limit(k).collect()
    if not found:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    centroids = np.array([r.v for r in found], np.int64)
    moved = np.zeros(len(centroids))
    state = kept.withColumns({"cluster": F.lit(0), "upper": F.lit(float("inf")), "lower": F.lit(0.0), "distance": F.lit(0).cast("long")})
    for n in range(rounds + 1):
        before = state
        state = written(state.mapInArrow(_search(spark.sparkContext.broadcast((Ball(centroids), moved, n == rounds))), _STATE), f"clusters{n}")
        if n:
            removed(before)
        if n < rounds:
            sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(dims)]).collect()
            old, centroids = centroids, centroids.copy()
            for r in sums:
                centroids[r.cluster] = [r[f"s{i}"] // r.n for i in range(dims)]
            moved = np.sqrt(squared(centroids, old)) * (1 + SLACK)
    return state.select("vec_id", "cluster", "distance"), [tuple(c) for c in centroids.tolist()]


def clusters(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that counts."""
    state, centroids = cluster(vectors, **options)
    sums = {r.cluster: r.s for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    as_long = lambda x: int(x) if x < 1 << 63 else None
    whole = as_long(sum(sums.values()))
    rows = [(c, as_long(s), whole, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in sums.items()]
    facts = state.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # a row a centroid
