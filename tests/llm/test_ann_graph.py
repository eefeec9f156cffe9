import numpy as np
from pyspark.sql import functions as F

from ordermill.llm import ann_graph
from ordermill.llm.registered import op1_ann_graph


def brute(rows, k):
    """{query: [(score, vec_id)]}; of rows with one id the smallest vector counts."""
    held = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            held[i] = min(held.get(i, list(v)), list(v))
    out = {}
    for q in held:
        if q % 100 == 0:
            near = [(float(np.sqrt(((np.array(held[q]) - np.array(v)) ** 2).sum())), i) for i, v in held.items() if i != q and len(v) == len(held[q])]
            out[q] = sorted(near)[:k]
    return out


def recall(got, expected):
    mine = {}
    for r in got:
        mine.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = total = 0
    for q, near in expected.items():
        found = sorted(mine.get(q, []))
        assert [r for r, _, _ in found] == list(range(1, len(near) + 1))
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        hit += len({i for _, i, _ in found} & {i for _, i in near})
        total += len(near)
    assert set(mine) <= set(expected)
    return hit / total


def test_edges_ties_and_shards(spark):
    r = np.random.default_rng(3)
    rows = [(int(i), r.normal(size=6).tolist()) for i in range(900)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(1000, 1100)]  # one vector many times: ties by id
    rows += [(2000, None), (2100, []), (2200, [0.0] * 6), (2300, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2400, [float("nan")] * 6), (2500, [float("inf")] * 6)]
    rows += [(2600, [1.0, 2.0]), (2601, [1.0, 3.0]), (None, [1.0] * 6), rows[5], (7, rows[900][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x")).withColumn("vector", F.lit(0))
    got = ann_graph.nearest(table, F.col("vec_id") % 100 == 0, shard_rows=200).collect()
    expected = brute(rows, 10)
    assert recall(got, expected) >= 0.98
    for q in (1000, 2600):
        assert [(r.score, r.vec_id) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == expected[q]
    assert [i for _, i in expected[1000]] == list(range(1001, 1011)) and expected[2600] == [(1.0, 2601)]
    assert ann_graph.nearest(table.where("false"), F.col("vec_id") % 100 == 0).count() == 0


def test_vectors_of_other_sizes_hide_nothing(spark):
    r = np.random.default_rng(8)
    rows = [(int(i), r.normal(size=6).tolist()) for i in range(1500)]
    rows += [(1600, [1e30] * 6), (1601, [-1e30, 1e29, 0.0, 0.0, 0.0, 1.0]), (1602, [1e-25] * 6), (1700, [1e5] * 6), (1701, [1.1e5] * 6)]
    rows += [(2000 + i, (1e-30 * r.normal(size=6)).tolist()) for i in range(20)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for shard_rows in (8192, 300):
        got = ann_graph.nearest(table, F.col("vec_id") % 100 == 0, shard_rows=shard_rows).collect()
        assert recall(got, brute(rows, 10)) >= 0.98


def test_graph_keeps_degree_and_reaches_all():
    r = np.random.default_rng(1)
    x = r.normal(size=(700, 8)).astype(np.float32)
    graph, entry = ann_graph.build(x, degree=12, beam=32)
    assert graph.shape == (700, 12) and all(len(set(g[g >= 0])) == (g >= 0).sum() and i not in g for i, g in enumerate(graph))
    seen, todo = set(entry.tolist()), list(entry)
    while todo:
        for j in graph[todo.pop()]:
            if j >= 0 and j not in seen:
                seen.add(int(j))
                todo.append(j)
    assert len(seen) >= 0.99 * 700


def test_query(spark, sf_dir):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert recall(op1_ann_graph(spark, sf_dir).collect(), brute(rows, 10)) >= 0.95
