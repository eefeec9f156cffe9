import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ordermill.llm import ranked_search
from ordermill.llm.registered import op13_best_positions
from ordermill.llm.text import equal_spans, span_hashes
from tests.llm.helpers import CLASHING, documents, edges_of, words

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOW) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    """[(item_id, rank, doc_id, score)] by scoring every document for every item."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            if c:
                m = 100 - 25 + (25 * sum(c.values()) * n) // total
                scored.append((sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t]), i))
        scored = sorted((x for x in scored if x[0] > 0), key=lambda x: (-x[0], x[1] is None, x[1]))[:k]
        out += [(item, r + 1, i, score) for r, (score, i) in enumerate(scored)]
    return sorted(out, key=str)


def result(frame):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect()), key=str)


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def corpus(n, seed, vocabulary=40):
    r = random.Random(seed)
    return [(i, " ".join(f"w{int(vocabulary * r.random() ** 3)}" for _ in range(r.randint(1, 60)))) for i in range(n)]


def test_as_brute_force(spark):
    docs = edges_of([*corpus(300, 1), (400, "Ünder_the É w1"), (401, "ünder the"), (402, "W1 w1\x00w1 w2"), (403, "w39 " * 20_000), (404, "w1"), (405, "w1")])
    items = [(1, "w1 w1 W3 w17"), (2, "w0 w1 w2 w3 w4 w5"), (3, None), (4, "..."), (5, "nowhere at all"), (None, "w39"), (6, "the É"), (6, "w38"), (6, "w38"), (7, docs[3][1] * 40)]
    for extra in (False, True):
        got = ranked_search.best_documents(documents(spark, docs, extra), table(spark, items).select("*", *[F.lit("x").alias(n) for n in CLASHING if n not in ("item_id",)]))
        assert result(got) == brute(docs, items)


def test_small_shards_and_passes(spark, monkeypatch):
    docs, items = corpus(200, 2), [(i, t) for i, t in corpus(12, 3)]
    expected = brute(docs, items)
    monkeypatch.setattr(ranked_search, "SHARD_DOCUMENTS", 7)
    assert result(ranked_search.best_documents(documents(spark, docs).coalesce(2), table(spark, items))) == expected
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", 30)
    monkeypatch.setattr(ranked_search, "ITEM_BYTES", 300)
    assert result(ranked_search.best_documents(documents(spark, docs), table(spark, items))) == expected


def test_ties_go_to_smaller_ids(spark):
    docs = [(i, "same words here") for i in range(60, 0, -1)]
    got = ranked_search.best_documents(documents(spark, docs + [(99, "other")]), table(spark, [(1, "same words")]))
    assert [r[2] for r in sorted(result(got), key=lambda r: r[1])] == list(range(1, 21))


def test_empty_tables(spark):
    docs, items = documents(spark, [(1, "a b")]), table(spark, [(1, "a")])
    assert ranked_search.best_documents(docs.where("false"), items).count() == 0
    assert ranked_search.best_documents(docs, items.where("false")).count() == 0
    assert ranked_search.best_documents(documents(spark, [(1, None), (2, " ")]), items).count() == 0


def test_stops_before_the_lists_end():
    """Steep lists: the best positions' impacts fall below the kth score long before the end; ties are still met."""
    rng = np.random.default_rng(5)
    n = 5000
    lists = []
    for t in range(3):
        value = np.sort((1e6 / (1 + np.arange(n)) ** 0.7).astype(np.int64))[::-1]
        lists.append((rng.permutation(n) if t else np.arange(n), value))
    total = np.zeros(n, np.int64)
    for docs, value in lists:
        total[docs] += value
    order = np.lexsort((np.arange(n), -total))[:20]
    found, scores, read = ranked_search.best_of(lists, n, 20, first=8)
    assert found.tolist() == order.tolist() and scores.tolist() == total[order].tolist()
    assert read < 3 * n / 3
    flat = [(np.arange(50), np.full(50, 7)), (np.arange(50), np.full(50, 5))]
    assert ranked_search.best_of(flat, 50, 20, first=1)[0].tolist() == list(range(20))


def test_terms_with_the_same_hash_are_told_apart():
    known = ranked_search.Terms.of([b"alpha", b"beta", b"gamma"])
    blind = ranked_search.Terms(known.data, known.starts, known.lengths, np.zeros(3, np.uint64))
    text = np.frombuffer(b"gamma alpha delta beta", np.uint8)
    at, to = np.array([0, 6, 12, 18]), np.array([5, 11, 17, 22])
    real = ranked_search.span_hashes
    ranked_search.span_hashes = lambda d, a, b: np.zeros(len(a), np.uint64)
    try:
        names = [known.data[s: s + n].tobytes() for s, n in zip(known.starts, known.lengths, strict=True)]
        assert [names[i] if i >= 0 else None for i in blind.numbers(text, at, to)] == [b"gamma", b"alpha", None, b"beta"]
    finally:
        ranked_search.span_hashes = real


def test_hashes_of_repeating_structure():
    a = "a"
    for _ in range(10):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    for size in (len(a), 64, 300):
        data = np.frombuffer((a[:size] + b[:size]).encode(), np.uint8)
        cuts = np.array([0, size, 2 * size])
        assert len(set(span_hashes(data, cuts[:-1], cuts[1:]).tolist())) == 2
        assert equal_spans(data, np.array([0, 0]), data, np.array([0, size]), np.array([size, size])).tolist() == [True, False]


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert result(op13_best_positions(spark, sf_dir)) == brute(docs, items)
