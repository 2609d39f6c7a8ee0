"""Integer k-means against brute force, and the bounds of the projection."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from shelfwatch.llm.simplex import Simplex, bounds, integer_kmeans, nearest

SCHEMA = "vec_id long, embedding array<double>, cluster int, apex string"


def brute(rows, clusters, rounds, size, scale=1024, seed=3):
    usable = [
        (i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]

    def order(row):
        return (row[0] is None, hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest(), row[1])

    centres = [v for _, v in sorted(usable, key=order)[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres)) for _, v in usable]

    for _ in range(rounds):
        found = assign()
        for k in range(len(centres)):
            mine = [v for (_, v), (_, c) in zip(usable, found) if c == k]
            if mine:
                centres[k] = tuple(sum(x) // len(mine) for x in zip(*mine))
    found = assign()
    total = sum(d for d, _ in found)
    by = {k: sum(d for d, c in found if c == k) for k in range(len(centres))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i is None, i, c, d, by[c], total, digest[c]) for (i, _), (d, c) in zip(usable, found)), key=str)


def rows_of(df):
    return sorted(((r.vec_id is None, r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect()), key=str)


def test_kmeans_equals_brute_force(spark):
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(k, [x + rng.gauss(0, 0.3) for x in rng.choice(centres)]) for k in range(300)]
    rows += [(300 + k, rows[7][1]) for k in range(150)] + [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1])]
    rows += [(900, None), (901, []), (902, [1.0] * 5), (903, [1.0] * 5 + [None]), (904, [1.0] * 5 + [float("nan")]), (905, [float("-inf")] * 6)]
    frame = spark.createDataFrame([(i, v, -1, "x") for i, v in rows], SCHEMA).repartition(7)
    assert rows_of(integer_kmeans(spark, frame, size=6)) == brute(rows, 8, 10, 6)
    assert rows_of(integer_kmeans(spark, frame, size=6, clusters=3, rounds=0, pivots=1)) == brute(rows, 3, 0, 6)


def test_few_equal_and_no_rows(spark):
    equal = [(k, [0.5, -0.5]) for k in range(5)]
    frame = spark.createDataFrame([(i, v, 0, None) for i, v in equal], SCHEMA)
    found = integer_kmeans(spark, frame, size=2)
    assert rows_of(found) == brute(equal, 8, 10, 2)
    empty = integer_kmeans(spark, frame, size=3)
    assert empty.count() == 0 and empty.dtypes == found.dtypes


def test_distances_that_leave_64_bits_fail(spark):
    frame = spark.createDataFrame([(1, [1e9, 0.0], 0, None)], SCHEMA)
    with pytest.raises(PySparkException, match="64 bits"):
        integer_kmeans(spark, frame, size=2).collect()


def test_bounds_hold_and_exclude():
    rng = np.random.default_rng(1)
    middles = rng.integers(-900, 900, (12, 64))
    x = (middles[rng.integers(0, 12, 500)] + rng.integers(-40, 40, (500, 64))).astype(np.int64)
    simplex = Simplex(np.vstack([x[:16], x[:3]]))
    assert len(simplex.pivots) <= 16
    a, c = simplex.apexes(x), simplex.apexes(middles)
    lower, upper = bounds(a, c)
    true = ((x[:, None] - middles[None]) ** 2).sum(axis=2)
    assert (lower <= true).all() and (true <= upper).all()
    cluster, distance, compared = nearest(x, a, middles, simplex)
    assert (cluster == true.argmin(axis=1)).all() and (distance == true.min(axis=1)).all()
    # Most centroids fall to the bounds alone.
    assert compared < true.size / 4
