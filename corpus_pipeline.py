"""A training corpus from raw documents: language, repeated lines, near copies, benchmark leaks, mix.

Every stage works on all its predecessor kept and is written as Parquet before the next one reads it. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm import decontaminate, language_id, line_dedup, minhash_bayes, mixing
from ordermill.llm.storage import kept, ship_package

#: Near copies share this percentage of their five-word shingles or more; op2's 85 is of that query alone.
NEAR_PERCENT = 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without text or letters (``und``) go. Labels stay as they are.

    Without labels to learn from all scores are 0; then every document with a letter stays.
    """
    found = language_id.identified(docs, keep=tuple(docs.columns))
    unlearned = (F.col("score") == 0) & language_id.has_letter()
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) | unlearned).select(docs.columns)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines many share; ``n_chars`` follows the text."""
    shorter = line_dedup.without_repeated_lines(docs).select(docs.columns)
    return shorter.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else shorter


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id; of rows with the same doc_id one stays.

    Documents without words and rows without doc_id are in no group and stay.
    """
    stays = minhash_bayes.clustered(docs, percent=NEAR_PERCENT).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("stays_doc_id")).distinct()
    named = docs.where("doc_id IS NOT NULL").join(stays, F.col("doc_id") == F.col("stays_doc_id"), "left_semi")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    single = named.withColumn("row_of_doc_id", F.row_number().over(first)).where("row_of_doc_id = 1")
    return single.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))


def no_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_of_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.taken_words(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("language_id", known_language),
    ("line_dedup", unrepeated_lines),
    ("minhash_bayes", no_near_copies),
    ("decontaminate", no_benchmark_leaks),
    ("mixing", mix_of_sources),
]

#: Trained models and drawn permutations have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
