"""Exact integer k-means with centroids filtered by n-simplex projection.

A few pivots span a simplex. A vector's distances to the pivots, worked out once and kept, make it the apex over that
base: its coordinates in the base's space and a height above it. For two apexes the true distance is at least the
Euclidean distance with both heights on one side, and at most that with the heights on opposite sides. In every round
the centroids get apexes of their own, a vector keeps the centroids whose lower bound is not above the least upper
bound, and only where several remain are exact integer distances compared. Tasks add up whole vectors per centroid, so
a round shuffles one row of sums per centroid and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm.storage import Scratch

PIVOTS = 16
# Bounds leave this share of the squared lengths as room for rounding, so no nearest centroid is lost.
ROOM = 1e-6
# Beyond this a squared distance might leave 64 bits.
LARGEST = 1 << 27


class Simplex:
    """Apex coordinates over the base that the pivots span."""

    def __init__(self, pivots: np.ndarray) -> None:
        """``pivots`` are distinct integer vectors; those close to the span of earlier ones are left out."""
        vectors = pivots.astype(np.float64)
        scale = max(1.0, float(np.abs(vectors).max(initial=0)))
        kept: list[int] = []
        base = np.zeros((0, 0))
        for k in range(len(vectors)):
            apex = self._project(vectors[kept], base, vectors[k : k + 1])[0] if kept else np.zeros(0)
            # The new pivot's height over the base so far becomes a coordinate of its own.
            if kept and apex[-1] <= 1e-3 * scale:
                continue
            base = np.vstack([np.c_[base, np.zeros((len(kept), 1))], apex]) if kept else np.zeros((1, 0))
            if kept:
                base = base[:, : len(kept)]
            kept.append(k)
        self.pivots, self.base = vectors[kept], base

    @staticmethod
    def _project(pivots: np.ndarray, base: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Coordinates of apexes: from the distances to the pivots, row by row of the triangular base, then the height."""
        squared = ((vectors[:, None, :] - pivots[None]) ** 2).sum(axis=2)
        out = np.zeros((len(vectors), len(pivots)))
        lengths = (base**2).sum(axis=1)
        for k in range(1, len(pivots)):
            # |x - p0|^2 - |x - pk|^2 = 2 x.pk - |pk|^2, with p0 at the origin and pk having k coordinates.
            rest = (squared[:, 0] - squared[:, k] + lengths[k]) / 2 - out[:, : k - 1] @ base[k, : k - 1]
            out[:, k - 1] = rest / base[k, k - 1]
        out[:, -1] = np.sqrt(np.maximum(squared[:, 0] - (out[:, :-1] ** 2).sum(axis=1), 0))
        return out

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        return self._project(self.pivots, self.base, vectors.astype(np.float64))


def bounds(apexes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared lower and upper bounds of the distances between two sets of apexes, with room for rounding."""
    flat = ((apexes[:, None, :-1] - centroids[None, :, :-1]) ** 2).sum(axis=2)
    high, other = apexes[:, -1:], centroids[:, -1][None]
    room = ROOM * ((apexes**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1)[None] + 1)
    return flat + (high - other) ** 2 - room, flat + (high + other) ** 2 + room


def nearest(
    vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector (ties: the smaller number), its squared distance, and the exact comparisons made."""
    lower, upper = bounds(apexes, simplex.apexes(centroids))
    open_ = lower <= upper.min(axis=1, keepdims=True)
    row, centroid = np.nonzero(open_)
    exact = ((vectors[row] - centroids[centroid]) ** 2).sum(axis=1)
    # Pairs come by row, then number, so the first of the least is the tie's winner.
    order = np.lexsort((centroid, exact, row))
    first = order[np.r_[True, row[order][1:] != row[order][:-1]]] if len(order) else order
    return centroid[first], exact[first], len(row)


def _integers(scale: int, size: int, vector: Column) -> Column:
    """``floor(scale * x)`` of a vector of ``size`` finite components, else null; too large ones fail the job."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(
        vector,
        lambda x: F.when(F.abs(x) * scale < LARGEST, F.floor(x * scale).cast("int")).otherwise(
            F.raise_error(F.lit(f"a component beyond {LARGEST} / {scale} has no exact squared distance in 64 bits")).cast("int")
        ),
    )
    return F.when(F.coalesce((F.size(vector) == size) & finite, F.lit(False)), whole)


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _packed(matrix: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in matrix], pa.binary())


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def integer_kmeans(
    spark: SparkSession, rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = 8,
    rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3, pivots: int = PIVOTS,
) -> DataFrame:
    """``(id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every usable row.

    Usable are vectors of exactly ``size`` finite components; each component becomes ``floor(scale * x)``. The first
    centroids are the ``clusters`` usable rows with the smallest sha256 of ``seed:id`` (fewer rows give fewer
    centroids); of rows with one id the smaller vector comes first, and rows without id come last. ``rounds`` times every row goes
    to its nearest centroid and a centroid with rows becomes their componentwise floored mean; then rows are assigned
    once more. Repeated rows count as often as they occur. Other columns are not read. Without usable rows the result
    is empty. A component whose integer reaches 2^27 fails the job, as its distances might leave 64 bits.
    """
    scratch = Scratch(spark, "simplex")
    whole = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    id_type = whole.schema["id"].dataType.simpleString()
    whole = scratch.store(whole.select("id", _integers(scale, size, F.col("x")).alias("v")).where("v IS NOT NULL"), "integers")

    # The first centroids, and the first pivots: a fixed number of vectors, taken by every task from its own smallest.
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = whole.select(key.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(max(clusters, pivots)).collect()
    if not chosen:
        return whole.select(
            F.col("id").alias(id_col), F.lit(0).alias("cluster"), *[F.lit(0).cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"),
        ).where("false")
    first = np.array([r["v"] for r in chosen], np.int64)
    centroids, simplex = first[:clusters], Simplex(first[:pivots])
    width = len(simplex.pivots)

    def project(batches):
        for part in _parts(batches):
            v = np.array(part.column(1).flatten().to_numpy(zero_copy_only=False)).reshape(-1, size)
            yield pa.RecordBatch.from_arrays([part.column(0), _packed(v.astype(np.int32)), _packed(simplex.apexes(v))], names=["id", "v", "apex"])

    points = scratch.store(whole.mapInArrow(project, f"id {id_type}, v binary, apex binary"), "apexes")
    scratch.drop(whole)

    def assigned(part, centres):
        v = _matrix(part.column("v"), size, np.int32).astype(np.int64)
        return v, *nearest(v, _matrix(part.column("apex"), width, np.float64), centres, simplex)[:2]

    def moved(centres: np.ndarray) -> np.ndarray:
        def add(batches):
            sums, counts = np.zeros(centres.shape, np.int64), np.zeros(len(centres), np.int64)
            for part in _parts(batches):
                v, cluster, _ = assigned(part, centres)
                np.add.at(sums, cluster, v)
                counts += np.bincount(cluster, minlength=len(centres))
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"]
            )

        # One row of sums per centroid and task; Spark adds them up by centroid and component.
        partial = points.select("v", "apex").mapInArrow(add, "cluster int, n bigint, sums array<bigint>")
        added = partial.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(size)])
        out = centres.copy()
        for r in added.collect():
            out[r["cluster"]] = [r[f"s{k}"] // r["n"] for k in range(size)]
        return out

    for _ in range(rounds):
        centroids = moved(centroids)

    def assign(batches):
        for part in _parts(batches):
            _, cluster, distance = assigned(part, centroids)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster, pa.int32()), pa.array(distance)], names=["id", "cluster", "distance"])

    found = scratch.store(points.mapInArrow(assign, f"id {id_type}, cluster int, distance bigint"), "assigned")
    scratch.drop(points)
    inertia = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    by_cluster = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    return found.select(
        F.col("id").alias(id_col), "cluster", "distance",
        by_cluster([inertia.get(k, 0) for k in range(len(centroids))]).cast("bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"), by_cluster(digests).alias("centroid_sha256"),
    )
