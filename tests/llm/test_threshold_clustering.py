import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import threshold_clustering
from ordermill.llm.registered import op12_threshold_clusters
from tests.llm.helpers import CLASHING

SCHEMA = "vec_id long, embedding array<float>"


def whole(vector):
    return [math.floor(Fraction(float(np.float32(x))) * 1024) for x in vector]


def brute(rows, k=8, rounds=10, dimensions=64):
    held = [(i, whole(v)) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    starts = sorted(((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in held if i is not None))[:k]
    centroids = [v for _, v in starts]

    def assign():
        out = []
        for _, v in held:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)))
        return out

    if not centroids:
        return []
    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (_, n) in zip(held, found, strict=True) if n == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assign()
    fitting = lambda x: x if x < 1 << 63 else None
    inertia = {c: sum(d for d, n in found if n == c) for c in range(len(centroids))}
    total = sum(inertia.values())
    lost = any(d >= 1 << 63 for d, _ in found)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    lost_in = {c: any(d >= 1 << 63 for d, n in found if n == c) for c in inertia}
    return sorted(
        ((i, n, fitting(d), None if lost_in[n] else fitting(inertia[n]), None if lost else fitting(total), sha[n]) for (i, _), (d, n) in zip(held, found, strict=True)), key=str,
    )


def result(frame):
    return sorted((tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in frame.collect()), key=str)


def vectors(n, seed, dimensions=64, grain=None):
    r = random.Random(seed)
    draw = (lambda: r.gauss(0, 0.2)) if grain is None else (lambda: r.randrange(grain) / 8)
    return [(i, [draw() for _ in range(dimensions)]) for i in range(n)]


def test_as_brute_force(spark):
    good = vectors(150, 1)
    rows = [*good, (1, None), (2, []), (3, [0.1] * 63), (4, [0.1] * 65), (5, [None] + [0.1] * 63), (6, [float("nan")] + [0.1] * 63), (7, [float("inf")] + [0.1] * 63),
            (200, [0.0] * 64), good[3], (3, good[4][1]), (None, good[5][1]), (None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(n) for n in CLASHING], F.lit(9).alias("cluster"), F.lit(9).alias("vector"))
    assert result(threshold_clustering.clustered(docs)) == brute(rows)


@pytest.mark.parametrize("grain", [2, 3])
def test_ties(spark, grain):
    rows = vectors(120, 2, 4, grain)
    got = threshold_clustering.clustered(spark.createDataFrame(rows, SCHEMA), clusters=6, dimensions=4, rounds=3)
    assert result(got) == brute(rows, 6, 3, 4)


def test_numbers_beyond_64_bits(spark):
    rows = [*vectors(30, 3), (100, [3e38] * 64), (101, [-3e38] * 32 + [1e20] * 32), (102, [2e5] * 64), (103, [1e6] + [0.0] * 63)]
    got = result(threshold_clustering.clustered(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows)
    assert {r[0]: r[2] for r in got}[103] is not None


def test_few_and_no_vectors(spark):
    rows = vectors(3, 4)
    assert result(threshold_clustering.clustered(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert threshold_clustering.clustered(spark.createDataFrame([], SCHEMA)).count() == 0
    assert threshold_clustering.clustered(spark.createDataFrame([(None, rows[0][1]), (1, None)], SCHEMA)).count() == 0


def test_walk_ends_before_all_centroids_are_measured():
    rng = np.random.default_rng(6)
    centroids = rng.integers(-50_000, 50_000, (40, 8))
    values = centroids[rng.integers(0, 40, 500)] + rng.integers(-300, 300, (500, 8))
    cluster, distance, measured = threshold_clustering.nearest(values, centroids)
    exact = ((values[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert measured.mean() < 20
    slow = threshold_clustering.nearest(values[:50].astype(object), centroids.astype(object))
    assert slow[0].tolist() == cluster[:50].tolist() and slow[1].tolist() == distance[:50].tolist()


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert result(op12_threshold_clusters(spark, sf_dir)) == brute(rows)
