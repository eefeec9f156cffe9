from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from ordermill.llm import minhash_bayes
from ordermill.llm.storage import kept
from tests.llm.helpers import documents, edges_of, words
from tests.llm.test_decontaminate import ITEM
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_minhash_bayes import brute as brute_groups
from tests.llm.test_minhash_bayes import shingles


def test_registered_once_each():
    names = queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and [len(x) for x in corpus_pipeline.STAGES] == [2] * 5
    assert set(oracle_sql()) <= set(names)


def test_every_stage_decides_as_its_operator_says(spark, tmp_path):
    common = words(12, 1)
    texts = [(i, "\n".join([words(60, 10 + i), common, words(30, 200 + i)])) for i in range(12)]
    texts += [(20, texts[3][1] + " end"), (21, "12 34 ..."), (22, words(20, 5) + " " + ITEM + " " + words(20, 6))]
    docs = kept(documents(spark, edges_of(texts)), "stage-test")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        columns = docs.columns
        docs = kept(stage(spark, docs, str(tmp_path)), "stage-test")
        rows = docs.collect()
        if name != "mixing":
            assert docs.columns == columns
        seen[name] = sorted(((r.doc_id, r.text) for r in rows), key=str) if name != "mixing" else rows
        if name == "language_id":
            assert seen[name] == sorted(((i, t) for i, t in before if t and any(c.isalpha() for c in t)), key=str)
        elif name == "line_dedup":
            assert seen[name] == sorted(((i, t) for i, _, _, t in brute_lines(before)), key=str)
            assert all(r.n_chars == len(r.text) for r in rows)
        elif name == "minhash_bayes":
            stays = {i for i, _, c in brute_groups(before, corpus_pipeline.NEAR_PERCENT) if i == c and i is not None}
            assert seen[name] == sorted({(i, t) for i, t in before if i in stays}, key=str) + [x for x in before if x[0] is None]
        elif name == "decontaminate":
            assert seen[name] == [x for x in seen["minhash_bayes"] if x[0] != 22]
        else:
            assert len(rows) == len(before) and all(0 <= r.taken <= 3 * r.size for r in rows)


def test_near_copies_from_a_similarity_of_80(spark, tmp_path):
    """Against all pairs at 80 percent; the operator's own query stays at 85."""
    texts = []
    for k, changed in enumerate((9, 10, 11, 12)):
        base = words(100, 300 + k).split()
        texts += [(10 * k, " ".join(base)), (10 * k + 1, " ".join(base[:-changed] + words(changed, 400 + k).split()))]
    sets = {i: shingles(t) for i, t in texts}
    alike = {10 * k: len(sets[10 * k] & sets[10 * k + 1]) / len(sets[10 * k] | sets[10 * k + 1]) for k in range(4)}
    assert sum(0.8 <= x < 0.85 for x in alike.values()) >= 2 and min(alike.values()) < 0.8
    docs = kept(documents(spark, texts), "stage-test")
    got = {r.doc_id for r in corpus_pipeline.no_near_copies(spark, docs, str(tmp_path)).collect()}
    assert got == {i for i, _ in texts} - {i + 1 for i, x in alike.items() if x >= 0.8}
    assert sum(r.kept for r in minhash_bayes.clustered(docs).collect()) == 8


def test_documents_without_labels_stay(spark, tmp_path):
    texts = [(i, words(20, 500 + i)) for i in range(6)] + [(6, None), (7, "12 ..."), (8, ""), (None, "some words")]
    docs = kept(documents(spark, texts).withColumn("lang", F.lit(None).cast("string")), "stage-test")
    got = corpus_pipeline.known_language(spark, docs, str(tmp_path))
    assert got.columns == docs.columns and sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(texts[:6] + texts[9:], key=str)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(spark, [(1, "a")]).where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = kept(stage(spark, docs, str(tmp_path)), "stage-test")
        assert docs.count() == 0


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and len(ids) > 100
    assert sum(r.taken for r in rows) <= 1.02 * sum(r.size for r in rows)
