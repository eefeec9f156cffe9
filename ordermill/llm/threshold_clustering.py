"""Clustering around centroids, with the nearest centroid found by the threshold algorithm.

Components become whole numbers, so that sums, means and distances are exact in any order and on any number of tasks.

Every dimension has a list of the centroids sorted by their value in it. For a vector, all lists are walked
outward from its own value, one centroid per list and step. A centroid met for the first time gets its exact
distance. The distances of the walks' frontiers, squared and summed, bound all centroids not met yet; the walk
ends once that sum strictly exceeds the best exact distance (not before, so that ties go to the smaller number).

A round is one scan: tasks assign their vectors and hand on sums per centroid and dimension, which Spark adds
up; the driver sees one row per centroid and dimension. No vector is shuffled.
"""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.storage import kept

CLUSTERS, DIMENSIONS, ROUNDS, SCALE, SEED = 8, 64, 10, 1024, 3
#: Vectors assigned at once inside a task.
BLOCK = 4096
#: Sums travel as decimals in parts of this size.
_PART = 10**30


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest centroid, squared distance, centroids measured) per row; arrays of int64, or of Python integers."""
    (n, d), k = values.shape, len(centroids)
    beyond = 1 << 62 if values.dtype == np.int64 else 1 << 4096  # more than any distance
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    dims = np.arange(d)
    cluster, best, measured = np.full(n, k, np.int64), np.full(n, beyond, values.dtype), np.zeros(n, np.int64)
    live = np.arange(n)
    up = np.zeros((n, d), np.int64)  # place of the next larger value of each list
    for place in range(k):
        up += (lists[place] < values).astype(np.int64)
    down, met = up - 1, np.zeros((n, k), bool)
    for _ in range(k):
        own = values[live]
        below = np.where(down >= 0, own - lists[np.maximum(down, 0), dims], beyond)
        above = np.where(up < k, lists[np.minimum(up, k - 1), dims] - own, beyond)
        lower = (below <= above).astype(bool)
        frontier = np.where(lower, below, above)
        found = np.zeros((len(live), k), bool)
        found[np.arange(len(live))[:, None], order[np.where(lower, down, up), dims]] = True
        found &= ~met
        met |= found
        for c in np.flatnonzero(found.any(axis=0)):
            rows = np.flatnonzero(found[:, c])
            distance = ((own[rows] - centroids[c]) ** 2).sum(axis=1)
            at = live[rows]
            better = ((distance < best[at]) | ((distance == best[at]) & (c < cluster[at]))).astype(bool)
            best[at[better]], cluster[at[better]] = distance[better], c
            measured[at] += 1
        go_on = ((frontier**2).sum(axis=1) <= best[live]).astype(bool)
        down, up = (down - lower)[go_on], (up + ~lower)[go_on]
        live, met = live[go_on], met[go_on]
        if not len(live):
            break
    return cluster, best, measured


def usable(vector: str, dimensions: int = DIMENSIONS):
    """Whether a vector has exactly so many components, none null or non-finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def _whole(column: pa.Array, dimensions: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that are usable, and floor(scale * x) of their components as doubles."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(lists), dimensions), False).to_numpy(zero_copy_only=False))
    flat = lists.take(pa.array(rows)).flatten().cast(pa.float64())
    with np.errstate(over="ignore"):
        values = np.floor(pc.fill_null(flat, math.nan).to_numpy(zero_copy_only=False).reshape(len(rows), dimensions) * float(scale))
    finite = np.isfinite(values / scale).all(axis=1)
    return rows[finite], values[finite]


def _assigned(column: pa.Array, centroids: list[list[int]], dimensions: int, scale: int):
    """Blocks of (rows, values, cluster, distance). Numbers that int64 could not square and sum are Python integers."""
    limit = math.isqrt((1 << 62) // dimensions) // 2
    small = all(abs(x) <= limit for c in centroids for x in c)
    exact = np.array(centroids, object)
    rows, values = _whole(column, dimensions, scale)
    fits = (np.abs(values) <= limit).all(axis=1) & small
    for chosen, fast in ((np.flatnonzero(fits), True), (np.flatnonzero(~fits), False)):
        for at in range(0, len(chosen), BLOCK):
            part = chosen[at: at + BLOCK]
            if fast:
                block = values[part].astype(np.int64)
                yield (rows[part], block, *nearest(block, exact.astype(np.int64))[:2])
            else:
                block = np.array([[int(x) for x in row] for row in values[part]], object)
                yield (rows[part], block, *nearest(block, exact)[:2])


def _sums(centroids: list[list[int]], dimensions: int, scale: int):
    def run(batches):
        k = len(centroids)
        sums, counts = np.zeros((k, dimensions), object), np.zeros(k, np.int64)
        for batch in batches:
            for _, block, cluster, _ in _assigned(batch.column("vector"), centroids, dimensions, scale):
                for c in range(k):
                    own = block[cluster == c]
                    if len(own):
                        sums[c] += own.sum(axis=0).astype(object)
                        counts[c] += len(own)
        rows = []
        for c in np.flatnonzero(counts):
            for dim in range(dimensions):
                rest, part, n = int(sums[c][dim]), 0, int(counts[c])
                while rest or not part:
                    rest, low = divmod(rest, _PART) if abs(rest) >= _PART else (0, rest)
                    rows.append((int(c), dim, part, Decimal(low), n if not part else 0))
                    part += 1
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["cluster", "dim", "part", "total", "n"])

    return run


def _final(centroids: list[list[int]], dimensions: int, scale: int):
    def run(batches):
        for batch in batches:
            for rows, _, cluster, distance in _assigned(batch.column("vector"), centroids, dimensions, scale):
                fitting = [int(x) if x < 1 << 63 else None for x in distance]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), pa.array(cluster, pa.int32()), pa.array(fitting, pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def clustered(
    vectors: DataFrame, clusters: int = CLUSTERS, dimensions: int = DIMENSIONS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED, vector: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per usable row of ``vectors``.

    Starts are the vectors whose sha256 of ``seed:vec_id`` is smallest, fewer than ``clusters`` if there
    are fewer; rows of the same vec_id are told apart by their vectors, and rows without vec_id start
    nothing but are assigned. Without a start there are no rows. An empty cluster keeps its centroid.
    A distance or inertia beyond 64 bits is null (assignment and centroids stay exact).
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = rows.where("vec_id IS NOT NULL").where(usable("vector", dimensions)).orderBy(draw, "vector").limit(clusters).collect()
    if not starts:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = [[math.floor(Decimal(float(x)) * scale) for x in r.vector] for r in starts]
    for _ in range(rounds):
        sums = rows.mapInArrow(_sums(centroids, dimensions, scale), "cluster int, dim int, part int, total decimal(38,0), n long")
        added = sums.groupBy("cluster", "dim", "part").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()  # clusters x dimensions
        total, count = {}, {}
        for r in added:
            total[r.cluster, r.dim] = total.get((r.cluster, r.dim), 0) + int(r.total) * _PART**r.part
            count[r.cluster, r.dim] = count.get((r.cluster, r.dim), 0) + r.n
        centroids = [[total[c, d] // count[c, d] if (c, d) in total else x for d, x in enumerate(own)] for c, own in enumerate(centroids)]
    final = kept(rows.mapInArrow(_final(centroids, dimensions, scale), "vec_id long, cluster int, distance long"), "assigned-vectors")
    whole = F.when(F.count("*") == F.count("distance"), F.sum(F.col("distance").cast("decimal(38,0)")))
    by_cluster = final.groupBy("cluster").agg(whole.alias("inertia")).collect()  # at most ``clusters`` rows
    every = None if any(r.inertia is None for r in by_cluster) else sum(int(r.inertia) for r in by_cluster)
    fitting = lambda x: None if x is None or int(x) >= 1 << 63 else int(x)
    told = [(r.cluster, fitting(r.inertia), fitting(every), hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()) for r in by_cluster]
    told = spark.createDataFrame(told, "told_cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return final.join(F.broadcast(told), F.col("cluster") == F.col("told_cluster")).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
