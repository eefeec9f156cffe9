import hashlib
import math
import re
import time
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.llm import disclosure
from ordermill.llm.registered import op11_disclosure
from tests.llm.helpers import CLASHING, documents, edges_of, words

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub(r"[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base(text):
    found = [(m.start(), n, k, m.end()) for n, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if passes(k, m.group())]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def named(spans):
    return [(disclosure.KINDS[k], a, b) for k, a, b in spans]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aZ09145.@+-() %_é\n", max_size=60))
def test_base_as_the_patterns(text):
    assert named(disclosure.base_spans(text)) == base(text)


@pytest.mark.parametrize("text", [
    "a@b.c@d.e x..%@y-.z-", "1.2.3.4.5.6.7.8 0255.1.1.1 256.1.1.1.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1111", "+1 (017) 555-7713. +4930 1234567", "+1", "+1 2", "+12", "+1 )))2345678901(",
    "é" * 300 + " a@b.co " + "ß" * 300, "4111111111111111 5500005555555559", "٣٤٥.1.2.3.4",
])
def test_base_cases(text):
    assert named(disclosure.base_spans(text)) == base(text)


def test_hostile_texts_take_linear_time():
    started = time.perf_counter()
    for text in ("a" * 10**6, "1" * 10**6, "1." * 10**6, "+1" + " " * 10**6, "@a" * 10**5, "1 " * 10**6, "+1(" * 10**5, "a@" * 10**5):
        disclosure.base_spans(text)
    assert time.perf_counter() - started < 20


def brute(rows, threshold=0.95, surroundings=3):
    """[(doc_id, base, all spans)]: the definition, document by document."""
    word = re.compile(r"\w+")
    held = [(i, t, base(t)) for i, t in rows]
    n = sum(t is not None for _, t, _ in held)
    normal = lambda k, v: f"{k}:{v.lower() if k in ('email', 'ip') else re.sub('[^0-9]', '', v)}"
    entities, terms, both, around = Counter(), Counter(), Counter(), defaultdict(set)
    for _, t, spans in held:
        terms.update({w.lower() for w in word.findall(t or "")})
        entities.update({normal(k, t[a:b]) for k, a, b in spans})
        pairs = set()
        for k, a, b in spans:
            ws = [m for m in word.finditer(t) if a - 200 <= m.start() and m.end() <= b + 200 and not any(x <= m.start() < y for _, x, y in spans)]
            names = [m.group().lower() for m in [m for m in ws if m.end() <= a][-8:] + [m for m in ws if m.start() >= b][:8]]
            for i, name in enumerate(names):
                pairs.add((normal(k, t[a:b]), name))
                around[normal(k, t[a:b]), name].add((names[i - 1] if i else "", names[i + 1] if i + 1 < len(names) else ""))
        both.update(pairs)
    told = {t for (e, t), m in both.items() if len(around[e, t]) >= surroundings and entities[e] < n and math.log(m * n / (terms[t] * entities[e])) / math.log(n / entities[e]) >= threshold}
    out = []
    for i, t, spans in held:
        more = [("term", m.start(), m.end()) for m in word.finditer(t or "") if m.group().lower() in told]
        order = [*PATTERNS, "term"]
        out.append((i, joined(spans), joined(sorted(spans + more, key=lambda s: (s[1], order.index(s[0]))))))
    return sorted(out, key=str)


def result(frame):
    rows = frame.collect()
    return sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in rows), key=str)


def expected(rows, **options):
    out = []
    for i, plain, spans in brute(rows, **options):
        kinds = Counter(s.split(":")[0] for s in plain.split(",") if s)
        out.append((i, *[kinds[k] for k in PATTERNS], hashlib.sha256(plain.encode()).hexdigest(), spans))
    return sorted(out, key=str)


def corpus():
    """Doctor Zhivkova and room 4711 stand near one address only; "hello" stands everywhere."""
    rows = [(i, f"{words(6, i)} hello {words(5, 50 + i)}") for i in range(40)]
    for i in range(16):
        rows.append((200 + i, f"{words(4, 200 + i)} Zhivkova {words(2, 300 + i)} 4711 {words(1, 350 + i)} j.z@clinic.example.org hello {words(3, 400 + i)}"))
    rows += [(110, f"{words(5, 500)} ZHIVKOVA {words(5, 501)}"), (111, "call +1 (017) 555-7713 or 10.0.0.1 hello"), (112, "4111 1111 1111 1111")]
    rows += [(120 + i, "the same passage about Petrov p@q.example.net twice over") for i in range(6)]  # one surrounding: no evidence
    return edges_of(rows)


def test_as_brute_force(spark):
    rows = corpus()
    for extra in (False, True):
        docs = documents(spark, rows, extra)
        assert result(disclosure.digest_columns(disclosure.found(docs))) == expected(rows)
    spans = {r[0]: r[-1] for r in expected(rows)}
    assert "term" in spans[110] and "term" not in spans[120] and spans[0] == ""
    for options in ({"threshold": 0.5, "surroundings": 1}, {"threshold": 0.8, "surroundings": 2}):
        assert result(disclosure.digest_columns(disclosure.found(documents(spark, rows), **options))) == expected(rows, **options)


def test_more_terms_than_are_sent(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(disclosure, "SENT_TERMS", 1)
    monkeypatch.setattr(disclosure, "CHUNK_TERMS", 10)
    assert result(disclosure.digest_columns(disclosure.found(documents(spark, rows)))) == expected(rows)


def test_rows_of_one_id_keep_their_own_spans(spark):
    rows = [*corpus(), (110, "nothing here"), (111, "a@b.co")]
    assert result(disclosure.digest_columns(disclosure.found(documents(spark, rows)))) == expected(rows)


def test_sanitised(spark):
    rows = corpus()
    docs = documents(spark, rows, extra=True)
    got = disclosure.sanitised(docs)
    assert got.columns == docs.columns and set(CLASHING) <= set(got.columns)
    texts = {r.doc_id: r.text for r in got.collect()}
    assert len(texts) and not any(disclosure.base_spans(t) for t in texts.values() if t)
    assert not any("zhivkova" in (t or "").lower() for t in texts.values())
    assert texts[112] == "[CARD]" and texts[900] is None and texts[901] == ""
    assert "[WORD]" in texts[200] and "[EMAIL]" in texts[200] and "4711" not in texts[200]
    untouched = {r[0] for r in expected(rows) if not r[-1]}
    assert all(texts[i] == t for i, t in rows if i in untouched)


def test_empty_table(spark):
    docs = documents(spark, [(1, "a")])
    assert disclosure.found(docs.where("false")).count() == 0
    assert disclosure.sanitised(documents(spark, [(1, None), (2, "")])).select(F.count("text")).first()[0] == 1


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert result(op11_disclosure(spark, sf_dir)) == expected(rows)
