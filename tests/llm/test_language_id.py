import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from ordermill.llm import language_id
from ordermill.llm.registered import op6_language_id
from tests.llm.helpers import CLASHING

SYLLABLES = {"aa": "ing the er and on th".split(), "bb": "ich der sch und en ü".split(), "cc": "ción que los ra ñ de".split()}


def sample(n):
    rows = []
    for i in range(n):
        r = random.Random(i)
        lang = sorted(SYLLABLES)[i % 3]
        text = " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(3, 60)))
        rows.append((i, text, lang))
    return rows


def test_held_out_accuracy_and_edges(spark):
    rows = sample(300) + [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !?", "bb"), (1003, "Ж", None), (1004, "ing" * 4000, None), (None, "der sch", None), (0, sample(1)[0][1], "aa"), (1005, "the and", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").select("*", *[F.lit("x").alias(n) for n in CLASHING])
    got = language_id.identified(docs, keep=("doc_id", "text", "lang", "best")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.best == "x"
        lettered = bool(r.text) and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not lettered)
        if lettered:
            assert r.lang_pred in SYLLABLES
    out = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)
    assert {r.lang_pred for r in got if r.doc_id in (1004, 1005)} == {"aa"}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language_id.identified(docs).collect()] == [("und", 0.0)] * 2
    assert language_id.identified(docs.where("false")).count() == 0


def test_forward_sums_all_segmentations():
    vocab = language_id.vocabulary(language_id.VOCABULARY)
    known = {p: i for i, p in enumerate(vocab.names)}
    rng = np.random.default_rng(1)
    probability = np.vstack([rng.random((len(vocab.names), 2)) / 50, np.zeros((1, 2))])

    def total(rest):
        if not rest:
            return np.ones(2)
        out = np.zeros(2)
        for n in range(1, min(len(rest), vocab.longest) + 1):
            piece = rest[:n]
            if piece in known or n == 1:
                out += probability[known.get(piece, 0)] * total(rest[n:])
        return out

    units = [b" the", b" and", b" \xc3\xbcber", b" x\xffq", b"a", " größ".encode()]
    assert np.allclose(np.exp(language_id.forward(units, vocab, probability)), [total(u) for u in units])
    counts = np.ones((len(units), 2))
    uses = language_id.expected_uses(units, counts, vocab, probability)
    assert np.allclose((uses * np.array([max(1, len(p)) for p in vocab.names])[:, None]).sum(axis=0), sum(map(len, units)))


def plain_forward(unit, known, longest, probability):
    """log of the sum over all segmentations, one column after the other, with exponents kept apart."""
    from fractions import Fraction

    alpha = [Fraction(1)] + [Fraction(0)] * len(unit)
    for e in range(1, len(unit) + 1):
        for n in range(1, min(e, longest) + 1):
            piece = unit[e - n: e]
            if piece in known or n == 1:
                alpha[e] += alpha[e - n] * Fraction(probability[known.get(piece, 0)])
    top = alpha[len(unit)]
    return np.log(float(top.numerator >> max(0, top.numerator.bit_length() - 60))) + np.log(2) * max(0, top.numerator.bit_length() - 60) - (
        np.log(float(top.denominator >> max(0, top.denominator.bit_length() - 60))) + np.log(2) * max(0, top.denominator.bit_length() - 60))


def test_long_and_foreign_words_have_finite_scores():
    vocab = language_id.vocabulary(language_id.VOCABULARY)
    known = {p: i for i, p in enumerate(vocab.names)}
    assert vocab.longest > language_id.COMMON_PIECE
    rng = np.random.default_rng(2)
    probability = np.vstack([10.0 ** -rng.integers(2, 10, (len(vocab.names), 1)), np.zeros((1, 1))])
    longest = max(vocab.names, key=len)
    words = [b"internationalization", longest, longest * 3, "ᚠᚢᚦᚨᚱᚲ".encode() * 20, "𐍈𐌰𐌹".encode() * 20, b"a" * 150, "größenordnung".encode() * 9, b"x" * 39, "国際連合安全保障理事会".encode() * 6]
    for word in words:
        units = language_id.units_of(word, vocab)
        assert b"".join(units) == b" " + word
        got = sum(language_id.forward([u], vocab, probability)[0, 0] for u in units)
        assert np.isclose(got, plain_forward(b" " + word, known, vocab.longest, probability[:, 0]), rtol=1e-9)
    together = sorted((u for w in words for u in language_id.units_of(w, vocab)), key=len)
    assert np.allclose(language_id.forward(together, vocab, probability)[:, 0], [language_id.forward([u], vocab, probability)[0, 0] for u in together])


def test_foreign_scripts_score_between_0_and_1(spark):
    rows = [*sample(120), (500, "ᚠᚢᚦᚨᚱᚲ" * 20, None), (501, "𐍈𐌰𐌹" * 20, None), (502, "the and of " * 9 + "ᚠᚢᚦᚨᚱᚲ" * 30, None), (503, "日本語" * 3000, None), (504, "ab1" * 60, "aa"), (505, "ᚠᚢ" * 50, None)]
    got = {r.doc_id: r for r in language_id.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(0 <= r.score <= 1 and r.lang_pred in SYLLABLES for r in got.values())
    assert got[502].lang_pred == "aa"


def test_prediction_reads_text_only(spark):
    rows = sample(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    other = docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit(None).cast("string").alias("lang"))
    one = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identified(docs).collect()}
    two = {r.doc_id - 1000: (r.lang_pred, r.score) for r in language_id.identified(other, labelled=docs).collect()}
    assert one == two


def test_query(spark, sf_dir):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op6_language_id(spark, sf_dir).collect()
    out = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert len(got) == len(lang) and sum(lang[r.doc_id] == r.lang_pred for r in out) >= 0.95 * len(out)
