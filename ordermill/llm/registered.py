"""The queries of this subpackage over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import (
    ann_graph, decontaminate, disclosure, html_tree, language_id, line_dedup, minhash_bayes, mixing, ranked_search, suffix_dedup,
    threshold_clustering, url_filter, warc_fixity,
)
from ordermill.llm.storage import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ann_graph(spark: SparkSession, folder: str) -> DataFrame:
    return ann_graph.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_minhash_bayes(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_bayes.clustered(_table(spark, folder, "documents").select("doc_id", "text"))


def op3_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as WARC records against a replica in which every 97th page has a changed byte, every 389th is gone, and every 401st is filed once more under -1 - page_id."""
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    damaged = F.when(F.col("page_id") % 97 == 5, F.concat(F.lit("?"), F.substr("html", F.lit(2)))).otherwise(F.col("html"))
    replica = pages.where(~F.coalesce(F.col("page_id") % 389 == 7, F.lit(False))).withColumn("html", damaged)
    added = pages.where(F.col("page_id") % 401 == 11).withColumn("page_id", -1 - F.col("page_id"))
    return warc_fixity.audited(warc_fixity.records(pages), warc_fixity.records(replica.unionByName(added))).drop("copy")


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.without_repeats(_table(spark, folder, "documents").select("doc_id", "text"))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(_table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identified(_table(spark, folder, "documents"))


def op7_html_tree(spark: SparkSession, folder: str) -> DataFrame:
    return html_tree.extracted(_table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.without_repeated_lines(docs).select(
        "doc_id", F.col("line_count").alias("n_lines"), F.col("lines_lost").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    return disclosure.digest_columns(disclosure.found(_table(spark, folder, "documents")))


def op12_threshold_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return threshold_clustering.clustered(_table(spark, folder, "embeddings"))


def op13_best_positions(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.best_documents(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_ann_graph": op1_ann_graph,
    "op2_minhash_bayes": op2_minhash_bayes,
    "op3_warc_fixity": op3_warc_fixity,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_language_id": op6_language_id,
    "op7_html_tree": op7_html_tree,
    "op8_decontaminate": op8_decontaminate,
    "op9_line_dedup": op9_line_dedup,
    "op10_mixing": op10_mixing,
    "op11_disclosure": op11_disclosure,
    "op12_threshold_clusters": op12_threshold_clusters,
    "op13_best_positions": op13_best_positions,
}

OP9_SQL = r"""
WITH split_lines AS (
  SELECT r, doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents))
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM split_lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT s.r, s.doc_id, s.i, s.line, h.key IS NOT NULL AND s.doc_id <> h.keeper AS lost FROM split_lines s LEFT JOIN shared h ON s.key = h.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

OP3_SQL = r"""
WITH whole AS (
  SELECT page_id, concat('WARC/1.1', e, 'WARC-Type: resource', e, 'WARC-Record-ID: <urn:uuid:', substr(m, 1, 8), '-', substr(m, 9, 4), '-', substr(m, 13, 4), '-', substr(m, 17, 4), '-', substr(m, 21, 12), '>', e,
    'WARC-Date: 1970-01-01T00:00:00Z', e, 'WARC-Target-URI: ', regexp_replace(coalesce(url, ''), '[\r\n]', ' ', 'g'), e, 'Content-Type: text/html', e, 'Content-Length: ', strlen(coalesce(html, '')), e, e, coalesce(html, ''), e, e) AS record
  FROM (SELECT *, chr(13) || chr(10) AS e, md5(concat(page_id, ' ', coalesce(url, ''))) AS m
    FROM (SELECT page_id, url, html FROM pages WHERE page_id IS NOT NULL UNION ALL SELECT -1 - page_id, url, html FROM pages WHERE page_id % 401 = 11))
), placed AS (
  SELECT page_id, strlen(record) AS length, sha256(record) AS sha256, sum(strlen(record)) OVER (ORDER BY page_id) - strlen(record) AS start FROM whole WHERE page_id >= 0
)
SELECT page_id, CAST(start // 67108864 AS BIGINT) AS archive, CAST(start - min(start) OVER (PARTITION BY start // 67108864) AS BIGINT) AS "offset", length, sha256,
  CASE WHEN page_id % 389 = 7 THEN 'missing' WHEN page_id % 97 = 5 THEN 'damaged' ELSE 'intact' END AS status
FROM placed
UNION ALL SELECT page_id, 0, NULL, strlen(record), sha256(record), 'extra' FROM whole WHERE page_id < 0
"""

OP13_SQL = r"""
WITH terms AS (
  SELECT id, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS id, doc_id, text FROM documents)
), frequencies AS (
  SELECT id, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), lengths AS (
  SELECT id, sum(tf) AS n FROM frequencies GROUP BY id
), totals AS (
  SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS all_terms FROM lengths
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM frequencies, totals GROUP BY term, documents
), asked AS (
  SELECT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)
), scored AS (
  SELECT item, item_id, f.id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * CAST(n AS BIGINT) * documents) // all_terms)))) AS BIGINT) AS score
  FROM asked JOIN frequencies f USING (term) JOIN weights USING (term) JOIN lengths l ON f.id = l.id, totals
  GROUP BY item, item_id, f.id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20
"""

def _op12_sql(rounds: int = 10) -> str:
    """One step of assignment and one of centroids per round, over rows of single components."""
    steps = [r"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), components AS MATERIALIZED (
  SELECT id, unnest(generate_series(1, 64)) AS dim, CAST(floor(1024 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM vectors
), starts AS (
  SELECT id, row_number() OVER (ORDER BY sha256('3:' || vec_id), embedding) - 1 AS cluster FROM vectors WHERE vec_id IS NOT NULL
), centroids_0 AS MATERIALIZED (
  SELECT cluster, dim, x FROM starts JOIN components USING (id) WHERE cluster < 8
)"""]
    for r in range(rounds + 1):
        steps.append(f"""assigned_{r} AS MATERIALIZED (
  SELECT id, cluster, distance FROM (
    SELECT id, cluster, distance, row_number() OVER (PARTITION BY id ORDER BY distance, cluster) AS place
    FROM (SELECT id, cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS distance FROM components v JOIN centroids_{r} c USING (dim) GROUP BY id, cluster)
  ) WHERE place = 1
)""")
        if r < rounds:
            steps.append(f"""centroids_{r + 1} AS MATERIALIZED (
  SELECT c.cluster, c.dim, CAST(coalesce((total - ((total % n) + n) % n) // n, c.x) AS BIGINT) AS x
  FROM centroids_{r} c LEFT JOIN (
    SELECT cluster, dim, CAST(sum(x) AS BIGINT) AS total, count(*) AS n FROM assigned_{r} JOIN components USING (id) GROUP BY cluster, dim
  ) s ON s.cluster = c.cluster AND s.dim = c.dim
)""")
    return ", ".join(steps) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM assigned_{rounds} JOIN vectors USING (id)
JOIN (SELECT cluster, sha256(string_agg(x, ',' ORDER BY dim)) AS centroid_sha256 FROM centroids_{rounds} GROUP BY cluster) USING (cluster)
"""


SQL: dict[str, str] = {
    "op3_warc_fixity": OP3_SQL,
    "op9_line_dedup": OP9_SQL,
    "op12_threshold_clusters": _op12_sql(),
    "op13_best_positions": OP13_SQL,
}
