import hashlib
from collections import defaultdict

import pytest

from ordermill.llm import line_dedup
from ordermill.llm.registered import op9_line_dedup
from tests.llm.helpers import CLASHING, documents, edges_of, words

BLANK = " \t\n\x0b\x0c\r"


def brute(rows, points=40, least=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(BLANK).translate(low)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= points:
                holders[key(line)].add(i)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= least}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if i is None or gone.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def result(frame):
    return sorted(((r.doc_id, r.line_count, r.lines_lost, r.text or "") for r in frame.collect()), key=str)


def test_as_brute_force(spark):
    common, accents, short = words(12, 1), "É" + words(10, 2) + " Ñandú", "x" * 39
    rows = [(i, "\n".join([words(9, 50 + i), f"  {common.upper() if i % 2 else common}\t", accents if i < 4 else accents.replace("É", "É"), short, common])) for i in range(9)]
    rows = edges_of(rows)
    assert result(line_dedup.without_repeated_lines(documents(spark, rows))) == brute(rows)


def test_rows_of_one_id_lose_their_own_lines(spark):
    common = words(12, 1)
    rows = [(1, f"begin\n{common}\nend"), (2, f"first\n{common}"), (2, "keep this first\nkeep this second"), (2, f"{common}\nkeep"), *[(i, common) for i in range(3, 7)], (6, f"last\n{common}")]
    assert result(line_dedup.without_repeated_lines(documents(spark, rows))) == brute(rows)


def test_clashing_columns_and_empty_table(spark):
    rows = [(i, words(12, 1)) for i in range(6)]
    got = line_dedup.without_repeated_lines(documents(spark, rows, extra=True))
    assert set(CLASHING) <= set(got.columns) and sum(r.lines_lost for r in got.collect()) == 5
    assert line_dedup.without_repeated_lines(documents(spark, [(1, "a")]).where("false")).count() == 0


def test_full_filter_only_shuffles_more(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "LEAST_BITS", 24 * 8)
    monkeypatch.setattr(line_dedup, "BITS_PER_DOCUMENT", 1)
    rows = [(i, "\n".join([words(12, 1), *(words(12, 100 * i + k) for k in range(20))])) for i in range(8)]
    assert result(line_dedup.without_repeated_lines(documents(spark, rows))) == brute(rows)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op9_line_dedup(spark, sf_dir).collect()}
    assert got == {i: (n, lost, hashlib.sha256(t.encode()).hexdigest()) for i, n, lost, t in brute(rows)}
    with pytest.raises(KeyError):
        got[-1]
