import re

import pyarrow as pa
from ordermill.llm import minhash_bayes
from ordermill.llm.components import components
from ordermill.llm.registered import op2_minhash_bayes
from tests.llm.helpers import documents, edges_of, words


def shingles(text):
    w = [x for x in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if x]
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    """[(doc_id, n_shingles, component)] by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(rows[a][0]), find(rows[b][0])
                    root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def result(frame):
    rows = frame.collect()
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def edited(text, every, seed):
    w = text.split()
    for k in range(seed % every, len(w), every):
        w[k] = f"z{seed}"
    return " ".join(w)


def test_as_brute_force(spark):
    base = words(300, 1)
    texts = [(i, words(40 + i, i)) for i in range(2, 12)] + [(20, base), (21, base.upper()), (22, base + "\n")]
    texts += [(100 + k, edited(base, 60 + 3 * k, k)) for k in range(60)]  # around the threshold
    texts += [(300, "one two"), (301, "one\ttwo "), (302, "one"), (303, "one two three"), (304, "é è"), (305, "É è")]
    rows = edges_of(texts)
    got = minhash_bayes.clustered(documents(spark, rows, extra=True))
    assert result(got) == brute(rows)
    assert len({c for _, _, c in result(got)}) < len(rows) - 30


def test_blocks_of_a_large_cluster(spark, monkeypatch):
    monkeypatch.setattr(minhash_bayes, "BLOCK", 64)
    base = words(120, 7)
    rows = [(i, base + " " + words(3 + i % 9, 1000 + i)) for i in range(150)]
    assert result(minhash_bayes.clustered(documents(spark, rows))) == brute(rows)


def test_rows_of_one_id_are_one_document(spark):
    a, b = words(40, 21), words(40, 22)
    rows = [(3, a), (5, a), (5, b), (9, b), (11, words(30, 23)), (11, ""), (12, None), (12, words(30, 23) + " more"), (13, a + " " + b)]
    assert result(minhash_bayes.clustered(documents(spark, rows))) == brute(rows)
    assert {i: c for i, _, c in brute(rows)} | {9: 3, 5: 3, 11: 11} == {i: c for i, _, c in brute(rows)}


def test_words_of_repeating_structure_differ(spark):
    a = "a"
    for _ in range(10):
        a += a.translate(str.maketrans("ab", "ba"))
    rows = [(1, a), (2, a.translate(str.maketrans("ab", "ba")))]
    assert result(minhash_bayes.clustered(documents(spark, rows))) == [(1, 1, 1), (2, 1, 2)]


def test_empty_table(spark):
    assert minhash_bayes.clustered(documents(spark, [(1, "a")]).where("false")).count() == 0
    assert result(minhash_bayes.clustered(documents(spark, [(1, None), (2, "")]))) == [(1, 0, 1), (2, 0, 2)]


def test_bounds_keep_pairs_at_the_threshold():
    for n, fewest in minhash_bayes.fewest_matches(85, 1e-6):
        assert fewest < 0.85 * n
    tight, loose = minhash_bayes.fewest_matches(85, 1e-2), minhash_bayes.fewest_matches(85, 1e-9)
    assert all(a[1] >= b[1] for a, b in zip(tight, loose, strict=True))


def test_shingles_of_pieces():
    texts = [words(30, 1), None, "a b", "x" * (1 << 21) + " a b c d e", words(6, 2)]
    assert [len(s) for s in minhash_bayes.shingle_sets(pa.array(texts))] == [len(shingles(t)) for t in texts]


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (5, 6), (6, 5), (7, 7), (None, 4), *[(20 + i, 21 + i) for i in range(40)], *[(100, 200 + i) for i in range(50)]]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5} | {20 + i: 20 for i in range(41)} | {200 + i: 100 for i in range(50)} | {100: 100}
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert result(op2_minhash_bayes(spark, sf_dir)) == brute(rows)
