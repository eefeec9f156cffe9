from pyspark.sql import functions as F

from ordermill.llm import decontaminate
from ordermill.llm.registered import op8_decontaminate
from tests.llm.helpers import documents, words

ITEM = "A train leaves Berlin at 9 and travels 120 km in 3 hours while Anna waits at the station for 20 minutes. How fast does the train go after 120 km have passed?"
SAME = ITEM.replace("Berlin", "Lisbon").replace("Anna", "Petra Maria").replace("120", "75.5").replace("3 hours", "4 minutes").replace("at 9", "at 11")
MIXED = SAME.replace("after 75.5 km", "after 80 km")


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(frame):
    return sorted((r.doc_id, r.item_id) for r in frame.collect())


def test_reparameterised_questions(spark):
    benchmark = items(spark, [(1, ITEM), (2, words(30, 1)), (3, None), (None, "x y"), (4, "too short"), (1, ITEM)])
    texts = [
        (10, words(50, 2) + ". " + ITEM + " " + words(20, 3)), (11, words(9, 4) + ". " + SAME), (12, words(40, 5)), (13, ITEM.upper()),
        (14, words(15, 6) + " " + words(30, 1) + "\n" + words(3, 7)), (15, None), (16, ""), (None, ITEM), (17, " ".join(ITEM.split()[:8])), (10, words(5, 8)),
        (18, (words(30, 9) + " ") * 3000 + words(30, 1)), (19, words(30, 1) + " " + words(30, 1)),
    ]
    got = decontaminate.contaminated(documents(spark, texts, extra=True), benchmark)
    assert found(got) == [(10, 1), (11, 1), (13, 1), (14, 2), (18, 2), (19, 2)]
    changed = {r.doc_id: r.n_changed for r in got.collect()}
    assert changed[10] == 0 and changed[11] >= 3
    clean = decontaminate.clean_documents(documents(spark, texts, extra=True), benchmark)
    assert sorted(map(str, (r.doc_id for r in clean.collect()))) == ["12", "15", "16", "17", "None"]


def test_slots_must_be_consistent(spark):
    benchmark = items(spark, [(1, ITEM)])
    tokens = {r.doc_id: r.n_tokens for r in decontaminate.contaminated(documents(spark, [(1, SAME), (2, MIXED)]), benchmark, covered=1).collect()}
    assert tokens[2] < tokens[1]


SHORT, LONG_NAMES = "What is the capital city of France?", "Anna Berg met Omar Hale in Oslo on 3 May 1999 with Ines Roth, Ivo 12, Uwe 13, Lea 14, Max 15 and Eva 16."
EDGE = "Which planet in our system is the largest one?"


def test_every_verbatim_item_is_found(spark):
    """Short items, dense numbers and names, an edge that is a sentence in one text only, any case; against a plain search for the words."""
    rows = [(1, SHORT), (2, LONG_NAMES), (3, EDGE), (4, "12 13 14 15 16 17 18 19 20 21"), (5, "Why?"), (6, "..."), (7, "Wer fährt über Ärmelkanal, Straße und Øresund?")]
    around = [("", ""), (words(9, 30) + " ", " " + words(9, 31)), ("Then Bob Lee asked ", " Nobody Knew."), ("so \u201c", "\u201d\u2014and"), ("\u0130 \u1e9e \u023a. " + words(5, 32) + " ", " \u0130")]
    changed = [str, str.lower, str.upper]
    texts = [(1000 * i + 10 * a + c, before + change(item) + after) for i, item in rows for a, (before, after) in enumerate(around) for c, change in enumerate(changed) if "ß" not in item or c < 2]
    expected = set()
    for d, _ in texts:
        i = d // 1000
        if i != 6:
            expected.add((d, i))
    got = decontaminate.contaminated(documents(spark, texts), items(spark, rows))
    assert found(got) == sorted(expected)
    near = [(1, "What is the capital of France?"), (2, " ".join(LONG_NAMES.split()[:9])), (3, EDGE.replace("largest", "smallest")), (4, "12 13 14 15 16 17 18 19 20"), (5, "whys"), (6, words(40, 33))]
    assert found(decontaminate.contaminated(documents(spark, near), items(spark, rows))) == []


def test_edge_word_is_plain_or_a_name(spark):
    asked = [(1, "Which planet near Paris is the very largest one of all?"), (2, "Maria walks along the river and never looks back at us.")]
    texts = [(1, "we asked Which planet near London is the very largest one of all?"), (2, "so Petra walks along the river and never looks back at us."), (3, "Petra walks along the river and never looks back at us.")]
    got = decontaminate.contaminated(documents(spark, texts), items(spark, asked))
    assert found(got) == [(1, 1), (2, 2), (3, 2)] and all(r.n_changed >= 1 for r in got.collect())


def test_names_are_typed_beside_any_character(spark):
    """A character whose lower case has another length in bytes leaves the templates of its document as they are."""
    item = "Ask Anna, then Omar, then Ines, then Ivo, then Uwe, then Lea, then Max, then Eva, then Tom, who was there first of all."
    other = item.replace("Anna", "Petra").replace("Omar", "Luis").replace("Ines", "Mona").replace("Lea", "Rita").replace("Uwe", "Kurt").replace("Max", "Jan").replace("Ivo", "Udo")
    odd = "Why did Anna tell Omar that Ines saw the old boat near Oslo before the long winter came to them?"
    copy = odd.replace("Anna", "Petra").replace("Omar", "Luis").replace("Ines", "Mona").replace("Oslo", "Rome")
    signs = ("", "\u0130 ", "\u1e9e ", "\u023a ", "\u0130 \u1e9e ")
    texts = [(10 * k + j, sign + ". " + text + " " + sign) for k, sign in enumerate(signs) for j, text in enumerate((item, copy, other))]
    got = {(d, i) for d, i in found(decontaminate.contaminated(documents(spark, texts), items(spark, [(1, item), (2, odd)])))}
    plain = {(d % 10, i) for d, i in got if d < 10}
    assert {(0, 1), (1, 2)} <= plain and got == {(10 * k + j, i) for k in range(len(signs)) for j, i in plain}


def test_empty_tables(spark):
    docs, benchmark = documents(spark, [(1, ITEM)]), items(spark, [(1, ITEM)])
    assert decontaminate.contaminated(docs.where("false"), benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.where("false")).count() == 0
    assert decontaminate.clean_documents(docs.withColumn("id", F.lit(5)), benchmark.where("false")).count() == 1


def test_query(spark, sf_dir):
    """Planted items against a plain search for eight equal words in a row."""
    bench = {r.item_id: r.text.lower().split() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    grams = {}
    for i, w in bench.items():
        for k in range(len(w) - 7):
            grams.setdefault(tuple(w[k: k + 8]), set()).add(i)
    expected = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        w = (r.text or "").lower().split()
        for k in range(len(w) - 7):
            expected |= {(r.doc_id, i) for i in grams.get(tuple(w[k: k + 8]), ())}
    assert found(op8_decontaminate(spark, sf_dir)) == sorted(expected)
