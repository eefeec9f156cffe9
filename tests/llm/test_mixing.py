import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import mixing
from ordermill.llm.registered import op10_mixing
from tests.llm.helpers import SCHEMA, documents, words


def brute_targets(sizes):
    """Water filling, step by step: {source: size} -> {source: target}."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > 3 * sizes[s]}
        if not full:
            return target | {s: share * weight[s] for s in open_}
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], SCHEMA)


def test_targets_and_shares(spark):
    r = [(i, words(20 + 37 * (i % 9), i), ("big", "a", "b", None, "é")[min(4, i % 29)]) for i in range(400)]
    r += [(1000, None, "nothing"), (1001, " \t", "nothing"), (None, "some words", "a"), (1002, "one", "tiny"), r[5]]
    docs = rows_of(spark, r).withColumn("size", F.lit("x")).withColumn("start", F.lit(1))
    got = mixing.taken_words(docs, shard_words=2000).collect()
    assert len(got) == len(r)
    sizes, taken = {}, {}
    for x in got:
        sizes[x.source] = sizes.get(x.source, 0) + x.size
        taken[x.source] = taken.get(x.source, 0) + x.taken
        assert 0 <= x.taken <= 3 * x.size
    expected = brute_targets(sizes)
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(expected[x.source])
    for s, t in expected.items():
        assert abs(taken[s] - t) <= max(2, 0.01 * t), (s, taken[s], t)
    assert sorted(map(str, got)) == sorted(map(str, mixing.taken_words(docs, shard_words=2000).collect()))


def test_shards_share_no_draw_and_hold_their_quotas(spark):
    docs = rows_of(spark, [(i, words(50 + i % 60, i), f"s{i % 4}") for i in range(300)])
    pieces = mixing.mixed(docs, shard_words=3000).toPandas()
    assert pieces["shard"].nunique() > 4
    assert not pieces.duplicated(["doc_id", "pass", "first_word"]).any()
    sizes = mixing.sized(docs)
    targets = mixing.source_targets(sizes).toPandas().set_index("place")
    levels = int(np.ceil(np.log2(sizes.agg(F.sum("size")).first()[0] / 3000)))
    quotas = {r.place: r.quotas for r in mixing.shard_quotas(mixing.source_targets(sizes), levels, 17).collect()}
    for place, q in quotas.items():
        assert sum(q) == targets.draws[place]
        ranks = pieces[pieces.source == targets.source[place]].groupby("shard")["turn"].nunique()
        assert {s: n for s, n in enumerate(q) if n} == ranks.to_dict()
    totals = np.array(list(quotas.values())).sum(axis=0)
    assert totals.max() - totals.min() <= 2 * levels


def test_permutation():
    for n in (1, 2, 3, 10, 1000):
        keys = np.full(n, 12345, np.uint64)
        assert sorted(mixing.permuted(np.arange(n), np.full(n, n), keys)) == list(range(n))


def test_urns_of_any_size():
    """Inversion against exact probabilities in whole numbers; large urns against mean and deviation."""
    for good, bad, wanted in ((0, 5, 3), (5, 0, 3), (4, 6, 5), (1, 9, 10), (30, 7, 20), (2, 300, 151)):
        weights = {x: math.comb(good, x) * math.comb(bad, wanted - x) for x in range(max(0, wanted - bad), min(good, wanted) + 1)}
        assert sum(weights.values()) == math.comb(good + bad, wanted)
        edge, total = 0, math.comb(good + bad, wanted)
        for x, w in weights.items():
            if w / total > 1e-9:
                assert mixing._urn(good, bad, wanted, (edge + w / 2) / total) == x
            edge += w
    rng = np.random.default_rng(3)
    for good, bad in ((10**9 - 1, 10**9 - 1), (10**9, 10**9 + 1), (10**11, 3 * 10**11), (5, 10**12), (10**12, 0)):
        total = good + bad
        wanted, draws = total // 2, 40
        got = np.array([mixing._urn(good, bad, wanted, u) for u in rng.random(draws)], np.float64)
        deviation = math.sqrt(wanted * (good / total) * (bad / total) * ((total - wanted) / (total - 1)))
        assert abs(got.mean() - wanted * (good / total)) <= 5 * deviation / math.sqrt(draws)
        assert deviation * 0.5 <= got.std() <= deviation * 1.6 or deviation == 0
        assert ((0 <= got) & (got <= min(good, wanted))).all()
    counts = np.array([7 * 10**10, 0, 3, 10**9, 10**9 + 7])
    left = mixing._hypergeometric(counts, rng)
    assert left.sum() == counts.sum() // 2 and (left >= 0).all() and (left <= counts).all()


def test_empty_table_and_query(spark, sf_dir):
    assert mixing.taken_words(documents(spark, [(1, "a")]).where("false")).count() == 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = op10_mixing(spark, sf_dir).toPandas().set_index("doc_id")
    sizes = {r.doc_id: (len((r.text or "").encode().split()), r.source) for r in docs.collect()}
    assert {i: s for i, (s, _) in sizes.items()} == got["size"].to_dict()
    by_source = {}
    for s, name in sizes.values():
        by_source[name] = by_source.get(name, 0) + s
    targets = brute_targets(by_source)
    for i, (_, name) in sizes.items():
        assert got.target[i] == pytest.approx(targets[name])
    taken = got.groupby("target")["taken"].sum()
    wanted = {}
    for t in targets.values():
        wanted[t] = wanted.get(t, 0) + t
    for t, w in wanted.items():
        near = taken[np.isclose(taken.index, t)].sum()
        assert abs(near - w) <= max(2, 0.02 * w)
