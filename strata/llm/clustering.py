"""Exact k-means rounds with Orchard's search for the nearest centroid (operator 13).

Vectors become integers, so that distances and means are exact whatever the order of the tasks. Every
round each vector looks for its nearest centroid by Orchard's search (:func:`nearest`): each centroid
has a list of the other centroids by rising distance; a vector walks the list of the closest centroid
found so far, measures the centroids it has not visited, jumps to the list of a closer one as soon as it
finds it, and stops where the list's distance is strictly more than twice its own (a centroid beyond that
cannot be nearer, nor as near, by the triangle inequality). Tasks walk all vectors of an Arrow batch in
step with numpy; centroids and lists (``k`` x ``k``, a bound that does not depend on the input) go with
the task.

A task returns one row of counts and sums per centroid; Spark adds them up (``k`` rows of ``dims`` sums
reach the driver, never vectors). The integer vectors are staged once in the shared folder; every round
reads them from there and the copy is deleted when the last assignment is written.

Defined cases: a vector that is null, has another length, or holds a null, NaN or infinite component is
left out; a component beyond +-:func:`component_limit` (about 184,000 as a float for 64 dimensions), whose
distances would not fit in 64 bits, fails the job with a message; a null id hashes as empty text; repeated
rows are vectors of their own (equal hashes in the order of their components); ties go to the smaller
centroid; with fewer vectors than ``k`` every vector is a first centroid; no vectors give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.layout import materialize
from ..session import fresh_path, release

SCALE = 256
_ASSIGNED = "cluster int, distance long"


def component_limit(dims: int) -> int:
    """Largest integer component for which four times any squared distance fits in 64 bits."""
    return math.isqrt(2**62 // (16 * dims))


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """``id_col`` and ``v`` (array of ``dims`` integers) of the vectors that are whole and finite."""
    v, limit = F.col(vector_col), component_limit(dims)

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    def scaled(x: Column) -> Column:
        y = F.floor(F.lit(float(SCALE)) * x.cast("double"))
        bad = F.raise_error(F.lit(f"a component beyond {limit // SCALE} has no exact distances"))
        return F.when(F.abs(F.lit(float(SCALE)) * x.cast("double")) < limit, y).otherwise(bad.cast("long")).cast("int")

    whole = vectors.where(F.coalesce(F.size(v) == dims, F.lit(False))).where(F.forall(v, finite))
    return whole.select(F.col(id_col), F.transform(v, scaled).alias("v"))


def first_centroids(vectors: DataFrame, id_col: str, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:id``, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(name.cast("binary"), 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


@dataclass(frozen=True)
class Centroids:
    """Centroids with, for each, the others by rising squared distance (ties: smaller number)."""

    points: np.ndarray
    neighbours: np.ndarray
    gaps: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray) -> "Centroids":
        k = len(points)
        apart = np.stack([squared(points, p) for p in points])
        neighbours = np.argsort(apart, axis=1, kind="stable")
        others = neighbours != np.arange(k)[:, None]
        neighbours = neighbours[others].reshape(k, k - 1)
        return cls(points, neighbours, np.take_along_axis(apart, neighbours, axis=1))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` to ``b`` (one point, or one for each row), exact."""
    difference = a - b
    return np.einsum("ij,ij->i", difference, difference)


def _guess(vectors: np.ndarray, points: np.ndarray, parts: int = 8) -> np.ndarray:
    """Where to start: the centroid nearest in the first few components. It only shortens the walk."""
    a, b = vectors[:, :parts].astype(np.float64), points[:, :parts].astype(np.float64)
    return ((b * b).sum(axis=1) - 2.0 * (a @ b.T)).argmin(axis=1)


def nearest(vectors: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Number of, and squared distance to, the nearest centroid of each vector (ties: smaller number)."""
    n, last = len(vectors), centroids.neighbours.shape[1]
    current = _guess(vectors, centroids.points)
    best = squared(vectors, centroids.points[current])
    visited = np.zeros((n, len(centroids.points)), dtype=bool)
    visited[np.arange(n), current] = True
    place = np.zeros(n, dtype=np.int64)
    walking = np.arange(n if last else 0)
    while walking.size:
        at, step = current[walking], place[walking]
        within = centroids.gaps[at, step] <= 4 * best[walking]  # squares: twice the distance
        walking, at, step = walking[within], at[within], step[within]
        place[walking] += 1
        met = centroids.neighbours[at, step]
        fresh = ~visited[walking, met]
        who, met = walking[fresh], met[fresh]
        visited[who, met] = True
        distance = squared(vectors[who], centroids.points[met])
        closer = (distance < best[who]) | ((distance == best[who]) & (met < current[who]))
        who = who[closer]
        current[who], best[who], place[who] = met[closer], distance[closer], 0
        walking = walking[place[walking] < last]
    return current, best


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _sums(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """Number and componentwise sum of the vectors of each non-empty centroid, ``k`` rows at most."""
    k, dims = centroids.points.shape

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for batch in batches:
            rows = _matrix(batch.column(0), dims)
            cluster, _ = nearest(rows, centroids)
            count += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                total[c] += rows[cluster == c].sum(axis=0)
        used = np.flatnonzero(count)
        sums = pa.ListArray.from_arrays(np.arange(0, dims * len(used) + 1, dims, dtype=np.int32), total[used].ravel())
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used]), sums], ["cluster", "n", "s"])

    parts = vectors.select("v").mapInArrow(added, "cluster int, n long, s array<long>")
    exact = [F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact)


def moved(vectors: DataFrame, points: np.ndarray) -> np.ndarray:
    """One round: centroids replaced by the floor of the mean of their vectors; empty ones stay."""
    out = points.copy()
    for row in _sums(vectors, Centroids.of(points)).collect():  # k rows at most
        out[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(points.shape[1])]
    return out


def assign(vectors: DataFrame, points: np.ndarray) -> DataFrame:
    """Columns of ``vectors`` without ``v``, with ``cluster`` and the squared ``distance``."""
    centroids, dims = Centroids.of(points), points.shape[1]
    kept = [c for c in vectors.columns if c != "v"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = nearest(_matrix(batch.column(len(kept)), dims), centroids)
            columns = [*batch.columns[: len(kept)], pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "cluster", "distance"])

    schema = ", ".join([*(f"`{c}` {dict(vectors.dtypes)[c]}" for c in kept), _ASSIGNED])
    return vectors.select(*kept, "v").mapInArrow(found, schema)


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    k: int = 40,
    rounds: int = 5,
    seed: int = 2,
) -> DataFrame:
    """``id_col``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` per vector."""
    spark = vectors.sparkSession
    copy = fresh_path(spark, "vectors")
    staged = materialize(integer_vectors(vectors, id_col, vector_col, dims), copy)
    points = first_centroids(staged, id_col, k, seed)
    if not len(points):
        points = np.zeros((1, dims), dtype=np.int64)
    for _ in range(rounds):
        points = moved(staged, points)
    assigned = materialize(assign(staged, points))
    release(spark, copy)
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r["s"]) for r in sums)
    digests = [hashlib.sha256(",".join(map(str, p.tolist())).encode()).hexdigest() for p in points]
    table = [(r["cluster"], int(r["s"]), total, digests[r["cluster"]]) for r in sums]  # k rows at most
    facts = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
