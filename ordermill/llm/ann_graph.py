"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

Distinct vectors are dealt to shards of bounded size. A shard's graph starts from drawn edges; greedy
searches propose neighbours for every vector, and relaxed distance pruning keeps the diverse ones: a
candidate goes if an already kept neighbour is closer to it, by the factor ALPHA, than the vector itself.
Kept edges are offered in reverse. A query block is answered by a beam search in every shard, with exact
distances in double precision; the shards' best are merged per query.

Searches and pruning run over arrays, many vectors in lock step. Finished graphs are rows of a table in
the shared folder, so a lost executor costs a shard, not the index.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.storage import kept

SHARD_ROWS = 8192
DEGREE, BEAM, ALPHA = 24, 64, 1.2
#: Beam of a query; wider than in building, as a query costs far less than a graph.
QUERY_BEAM = 192
#: Nodes each search expands per step, vectors worked on in lock step, queries per block.
EXPANDED, LOCKSTEP, QUERY_BLOCK = 4, 256, 16_384


def usable(embedding: Column) -> Column:
    """True for a vector without null or non-finite components that is not empty and not zero."""
    e = embedding.cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(e.isNotNull() & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def greedy(x: np.ndarray, graph: np.ndarray, entry: np.ndarray, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beams (node numbers, squared distances; nearest first, -1 and inf as filling) of the queries ``q``."""
    n, rows = len(q), np.arange(len(q))[:, None]
    ids = np.full((n, beam), -1, np.int32)
    far = np.full((n, beam), np.inf, np.float32)
    first = entry[:beam]
    d = ((x[first][None] - q[:, None]) ** 2).sum(axis=2)
    order = np.argsort(d, axis=1, kind="stable")
    ids[:, : len(first)] = first[order]
    far[:, : len(first)] = np.take_along_axis(d, order, 1)
    done = ids < 0
    while True:
        order = np.argsort(done, axis=1, kind="stable")[:, :EXPANDED]  # nearest that are not expanded yet
        live = ~np.take_along_axis(done, order, 1)
        active = np.flatnonzero(live.any(axis=1))
        if not len(active):
            return ids, far
        order, live = order[active], live[active]
        nodes = np.where(live, ids[active[:, None], order], -1)
        done[active[:, None], order] = True
        near = np.where((nodes >= 0)[:, :, None], graph[nodes], -1).reshape(len(active), -1)
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        held = ids[active]
        known = np.zeros(near.shape, bool)
        for k in range(0, near.shape[1], 24):
            known[:, k: k + 24] = (near[:, k: k + 24, None] == held[:, None, :]).any(axis=2)
        near[known] = -1
        diff = x[near] - q[active][:, None]
        d = np.einsum("qrd,qrd->qr", diff, diff)
        d[near < 0] = np.inf
        every, dist = np.concatenate([held, near], axis=1), np.concatenate([far[active], d], axis=1)
        best = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        flags = np.concatenate([done[active], near < 0], axis=1)
        ids[active], far[active] = np.take_along_axis(every, best, 1), np.take_along_axis(dist, best, 1)
        done[active] = np.take_along_axis(flags, best, 1) | (ids[active] < 0)


def pruned(x: np.ndarray, own: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours kept of the candidates [vector, candidate] (-1: none): at most ``degree`` each."""
    diff = x[cand] - x[own][:, None]
    d = np.einsum("qrd,qrd->qr", diff, diff)
    d[(cand < 0) | (cand == own[:, None])] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
    held = x[cand]
    norm = np.einsum("qrd,qrd->qr", held, held)
    between = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(held, held.transpose(0, 2, 1))
    alive = np.isfinite(d)
    same = np.zeros(cand.shape, bool)
    same[:, 1:] = (cand[:, 1:] == cand[:, :-1]) & alive[:, 1:]
    alive &= ~same
    out = np.full((len(own), degree), -1, np.int32)
    rows = np.arange(len(own))
    for k in range(degree):
        pick = alive.argmax(axis=1)
        some = alive[rows, pick]
        if not some.any():
            break
        out[some, k] = cand[rows, pick][some]
        alive &= ~(some[:, None] & (alpha * alpha * between[rows, pick] <= d))
        alive[rows[some], pick[some]] = False
    return out


def build(x: np.ndarray, seed: int = 5, degree: int = DEGREE, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(neighbours [node, degree] with -1 as filling, entry nodes) of the vectors ``x`` (float32)."""
    n, rng = len(x), np.random.default_rng(seed)
    graph = rng.integers(0, max(1, n), (n, degree)).astype(np.int32)
    graph[graph == np.arange(n)[:, None]] = -1
    middle = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    entry = np.unique(np.append(rng.integers(0, n, 7), middle)).astype(np.int32)
    if n <= degree:
        full = np.tile(np.arange(n, dtype=np.int32), (n, 1))
        full[np.arange(n), np.arange(n)] = -1
        return full, entry
    for alpha in (1.0, ALPHA):
        order = rng.permutation(n)
        for at in range(0, n, LOCKSTEP):
            own = order[at: at + LOCKSTEP]
            ids, _ = greedy(x, graph, entry, x[own], beam)
            graph[own] = pruned(x, own, np.concatenate([ids, graph[own]], axis=1), degree, alpha)
            _offer_back(x, graph, own, degree, alpha)
    return graph, entry


def _offer_back(x: np.ndarray, graph: np.ndarray, own: np.ndarray, degree: int, alpha: float) -> None:
    """Each new edge is also offered in reverse; a node with more offers than room is pruned again."""
    target, source = graph[own].ravel(), np.repeat(own, graph.shape[1])
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(first, count)
    for step in range(0, int(place.max(initial=-1)) + 1, degree):  # a hub takes its offers in several turns
        part = (place >= step) & (place < step + degree)
        some = np.unique(target[part])
        cand = np.full((len(some), 2 * degree), -1, np.int32)
        cand[:, :degree] = graph[some]
        cand[np.searchsorted(some, target[part]), degree + place[part] - step] = source[part]
        for k in range(0, len(some), 1024):
            graph[some[k: k + 1024]] = pruned(x, some[k: k + 1024], cand[k: k + 1024], degree, alpha)


_GRAPH = "dim int, shard int, rows int, core int, vectors binary, edges binary, entry binary, ids binary, id_ends binary"
#: A vector is searched in single precision if its largest component is within these factors of the shard's median one.
LARGEST, SMALLEST = 1e4, 1e-12


def _sizes(x: np.ndarray) -> np.ndarray:
    return np.abs(x).max(axis=1)


def _like(sizes: np.ndarray, scale: float) -> np.ndarray:
    return (sizes <= scale * LARGEST) & (sizes >= scale * SMALLEST)


def _build_shard(key, table):
    dim, shard = key[0].as_py(), key[1].as_py()
    lists = table.column("ids").combine_chunks()
    x = np.array(table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
    counts = np.array([len(v) for v in lists], np.int64)
    ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.lexsort((np.minimum.reduceat(ids, np.cumsum(counts) - counts),))  # the same graph whatever order rows came in
    starts = np.cumsum(counts) - counts
    x = x[order]
    # Vectors of another order of size than most go behind the graph's; searches measure them all.
    scale = float(np.median(_sizes(x)))
    like = _like(_sizes(x), scale)
    place, core = np.argsort(~like, kind="stable"), int(like.sum())
    x, order = x[place], order[place]
    flat = np.concatenate([ids[starts[i]: starts[i] + counts[i]] for i in order])
    graph, entry = build((x[:core] / scale).astype(np.float32))
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "rows": pa.array([len(x)], pa.int32()), "core": pa.array([core], pa.int32()),
        **{k: pa.array([v.tobytes()], pa.binary()) for k, v in (("vectors", x), ("edges", graph), ("entry", entry), ("ids", flat), ("id_ends", np.cumsum(counts[order])))},
    })


def _search_shard(k: int, beam: int):
    def run(key, graphs, queries):
        out_q, out_id, out_score = [], [], []
        if graphs.num_rows and queries.num_rows:
            dim = key[0].as_py()
            row = {c: graphs.column(c)[0].as_py() for c in ("core", "vectors", "edges", "entry", "ids", "id_ends")}
            x, core = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim), row["core"]
            graph = np.frombuffer(row["edges"], np.int32).reshape(core, -1)
            entry, ids, ends = np.frombuffer(row["entry"], np.int32), np.frombuffer(row["ids"], np.int64), np.frombuffer(row["id_ends"], np.int64)
            starts, scale, rest = np.append(0, ends[:-1]), float(np.median(_sizes(x))), np.arange(core, len(x))
            small = (x[:core] / scale).astype(np.float32)
            q = np.array(queries.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
            own = queries.column("query_id").to_numpy()
            for at in range(0, len(q), LOCKSTEP):
                part = q[at: at + LOCKSTEP]
                like = _sizes(part) <= scale * LARGEST
                found, _ = greedy(small, graph, entry, (np.where(like[:, None], part, 0) / scale).astype(np.float32), max(beam, k + 1))
                for i, nodes in enumerate(found):
                    nodes = np.concatenate([nodes[nodes >= 0], rest]) if like[i] else np.arange(len(x))
                    score = np.sqrt(((x[nodes] - q[at + i]) ** 2).sum(axis=1))
                    flat = np.concatenate([ids[starts[v]: ends[v]] for v in nodes])
                    score = np.repeat(score, ends[nodes] - starts[nodes])
                    other = flat != own[at + i]
                    flat, score = flat[other], score[other]
                    best = np.lexsort((flat, score))[:k]
                    out_q.append(np.full(len(best), own[at + i]))
                    out_id.append(flat[best])
                    out_score.append(score[best])
        joined = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0, kind))
        return pa.table({"query_id": joined(out_q, np.int64), "vec_id": joined(out_id, np.int64), "score": joined(out_score, np.float64)})

    return run


def index(vectors: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A table of shard graphs over (vec_id, vector). Equal vectors are one node with its k + 1 smallest ids: a k-nearest answer needs no more."""
    near = Window.partitionBy("vector").orderBy("vec_id")
    nodes = vectors.withColumn("place", F.row_number().over(near)).where(F.col("place") <= k + 1)
    nodes = kept(nodes.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "distinct-vectors")
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.select(F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), "vector", "ids")
    return kept(dealt.groupBy("dim", "shard").applyInArrow(_build_shard, _GRAPH), "shard-graphs")


def search(graphs: DataFrame, queries: DataFrame, k: int = 10, beam: int = QUERY_BEAM, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row of ``queries`` (query_id, vector), ties to smaller vec_id."""
    blocks = max(1, -(-queries.count() // block))
    shards = graphs.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0] + 1
    asked = queries.select(
        "query_id", "vector", F.size("vector").alias("dim"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_search_shard(k, beam), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, is_query: Column, k: int = 10, shard_rows: int = SHARD_ROWS, beam: int = QUERY_BEAM) -> DataFrame:
    """The k nearest found of every query row among all other rows of (vec_id, embedding).

    Unusable vectors and rows without vec_id take no part. Of rows with the same vec_id the
    smallest vector counts. Vectors of different lengths are not compared.
    """
    rows = embeddings.where("vec_id IS NOT NULL").where(usable(F.col("embedding")))
    rows = kept(rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(F.col("embedding").cast("array<double>")).alias("vector")), "vectors")
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector")
    return search(index(rows, k, shard_rows), queries, k, beam)
