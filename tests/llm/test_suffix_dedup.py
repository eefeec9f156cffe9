import hashlib
import random
import sys

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermill.llm import suffix_dedup, suffix_sort
from ordermill.llm.registered import op4_suffix_dedup
from ordermill.llm.suffix_sort import common_prefixes, suffix_array
from tests.llm.helpers import documents, edges_of, words


def brute(rows, width=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - width + 1):
            if i is not None:
                first[b[k: k + width]] = min(i, first.get(b[k: k + width], i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if i is not None and first[b[k: k + width]] < i:
                gone[k: k + width] = b"\1" * width
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def passages():
    r = random.Random(5)
    shared = [words(n, 70 + n) for n in (9, 14, 30, 60)] + ["ab" * 60, "a" * 130, "é" * 40]
    rows = []
    for i in range(40):
        parts = [words(r.randint(1, 20), 300 + i)]
        for _ in range(r.randint(0, 4)):
            s = r.choice(shared)
            a = r.randint(0, max(0, len(s) // 3))
            parts += [s[a: len(s) - r.randint(0, 20)], words(r.randint(0, 6), r.randint(0, 10**6))]
        rows.append((i, r.choice(["", " ", "\n"]).join(parts)))
    return edges_of(rows) + [(950, rows[3][1]), (951, rows[3][1] + "."), (952, "x" * 49), (953, "x" * 49), (954, "y" * 50), (955, "y" * 50)]


def test_as_brute_force(spark):
    rows = passages()
    assert result(suffix_dedup.without_repeats(documents(spark, rows, extra=True))) == brute(rows)


def test_hot_anchors_and_chunks(spark, monkeypatch):
    rows = passages()
    assert result(suffix_dedup.without_repeats(documents(spark, rows), hot_groups=3)) == brute(rows)
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 64)
    assert result(suffix_dedup.without_repeats(documents(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert suffix_dedup.without_repeats(documents(spark, [(1, "a")]).where("false")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.integers(1, 3))
def test_suffix_array(numbers, times):
    s = np.array(numbers * times + [0], np.int64)
    array = suffix_array(s, int(s.max()) + 1)
    assert array.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    prefixes = common_prefixes(s, array, 5)
    for a, b in zip(array[:-1], array[1:], strict=True):
        n = 0
        while n < 5 and max(a, b) + n < len(s) and s[a + n] == s[b + n]:
            n += 1
        assert prefixes[b] == n


def test_many_names():
    r = np.random.default_rng(2)
    s = np.append(r.integers(1, 6000, 4000), 0)
    s[200:900] = s[1500:2200]
    assert suffix_array(s, 6001).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert result(op4_suffix_dedup(spark, sf_dir)) == brute(rows)


def test_suffixes_by_counting_and_doubling():
    """Text of bytes is sorted with symbols of two bytes, names by doubling: no step for each entry in Python, so half a megabyte takes a few seconds at most."""
    r = np.random.default_rng(3)
    copies = r.integers(2, 100, (600, 90))
    s = np.concatenate([np.append(copies[i], 1) for i in r.integers(0, 600, 5500)] + [[0]])
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(1) if event in ("call", "c_call") else None)
    try:
        array = suffix_array(s, 258)
    finally:
        sys.setprofile(None)
    assert len(calls) < len(s)
    plain = s.astype(np.uint8).tobytes()
    some = array[r.integers(1, len(s), 3000)]
    place = np.empty(len(s), np.int64)
    place[array] = np.arange(len(s))
    assert sorted(array.tolist()) == list(range(len(s)))
    assert all(plain[a:] < plain[array[place[a] + 1]:] for a in some if place[a] + 1 < len(s))
    assert type(s[0]) is np.int64 and {a.dtype for a in _symbols(s)} == {np.dtype(np.uint16)}


def _symbols(s):
    """What the induced sorting of ``s`` is given as its string."""
    seen, plain = [], suffix_sort._induced
    suffix_sort._induced = lambda s, *rest: (seen.append(s), plain(s, *rest))[1]
    try:
        suffix_array(s, 258)
    finally:
        suffix_sort._induced = plain
    return seen


def test_segments_are_hashed_only_at_wanted_anchors():
    rows = [words(60, n) + " " + words(30, 900) for n in range(30)] + ["", "short"]
    table = pa.table({"doc_id": pa.array(range(len(rows)), pa.int64()), "text": rows})
    whole = suffix_dedup.Anchors(table, 50)
    assert len(whole.mark) == 0
    keys, count = np.unique(whole.key, return_counts=True)
    wanted = keys[count > 1]
    some = suffix_dedup.Anchors(table, 50, wanted)
    at = np.flatnonzero(np.isin(whole.key, wanted))
    for name in ("row", "low", "high", "place", "key"):
        assert getattr(some, name).tolist() == getattr(whole, name)[at].tolist()
    assert len(some.mark) == len(at) > 0
    # All strings that fit their row, each once.
    strings = np.concatenate([np.arange(a, b + 1) for a, b in zip(whole.low, whole.high, strict=True)])
    ends = np.cumsum([len(x) for x in rows])
    expected = [p for e, x in zip(ends, rows, strict=True) for p in range(e - len(x), e - 50 + 1)]
    assert sorted(strings.tolist()) == expected
