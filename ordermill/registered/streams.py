"""Streaming jobs run to the end of their input; the result is what the sink holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.expr import shaped
from ordermill.registered import Entries
from ordermill.registered.metrics import _TXN, transaction_log
from ordermill.registered.transactions import ORDER_SQL, document_tables, order_requests
from ordermill.sources.schemas import text_dates
from ordermill.sources.store import loaded_store
from ordermill.sources.workspace import fresh_path
from ordermill.streaming import jobs
from ordermill.twin_sql import with_views

c = F.col


def _ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders filed as JSON arrive in a columnar table."""
    source, target, checkpoint = (fresh_path(spark, n) for n in ("landing", "ingested", "ingest-checkpoint"))
    text_dates("orders", loaded_store(spark, sf_dir).table("orders")).write.json(source)
    jobs.ingest_documents(spark, source, target, checkpoint, "orders", files_per_batch=4).awaitTermination()
    lines = spark.read.parquet(target).select("o_id", "o_w_id", "o_entry_d", F.explode_outer("o_orderline").alias("ol"))
    return shaped(
        lines.groupBy("o_id", "o_w_id", "o_entry_d").agg(F.count("ol").alias("lines"), F.sum("ol.ol_quantity").alias("pieces")),
        "o_id bigint, o_w_id bigint, o_entry_d timestamp_ntz, lines bigint, pieces bigint",
    )


def _apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order requests filed in number order, applied batch by batch."""
    tables = document_tables(spark, sf_dir)
    source, folder, checkpoint = (fresh_path(spark, n) for n in ("requests", "applied", "apply-checkpoint"))
    requests = order_requests(tables)
    # The lower half of the numbers is filed and applied first, then the stream goes on from its checkpoint.
    middle = requests.agg(F.expr("percentile_approx(seq, 0.5)")).first()[0]
    applied = jobs.ChangedTables(spark, folder, tables)
    for part in (requests.where(c("seq") <= middle), requests.where(c("seq") > middle)):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(requests.schema).parquet(source)
        jobs.apply_orders(stream, applied, checkpoint).awaitTermination()
    return shaped(
        applied.results().withColumn("left_in_part", F.aggregate("items.left_in_stock", F.lit(0).cast("bigint"), lambda s, x: s + x))
        .groupBy("seq", "w_id", "d_id", "o_id", "total").agg(F.sum("left_in_part").alias("left_in_stock")),
        "seq bigint, w_id bigint, d_id bigint, o_id bigint, total double, left_in_stock bigint",
    )


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed counts per hour; the last windows stay open until the watermark passes them, so
    one late marker row closes them."""
    source, target, checkpoint = (fresh_path(spark, n) for n in ("txnlog", "rates", "rates-checkpoint"))
    log = transaction_log(spark, sf_dir).select("ts", "txn", "duration")
    log.sortWithinPartitions("ts").write.parquet(source)
    stream = spark.readStream.schema(log.schema).parquet(source)
    jobs.rate_to_files(jobs.transaction_rate(_utc(stream)), target, checkpoint).awaitTermination()
    end = log.agg(F.max("ts") + F.expr("INTERVAL 1 DAY")).first()[0]
    marker = spark.createDataFrame([(end, "end", 0.0)], log.schema)
    marker.write.mode("append").parquet(source)
    jobs.rate_to_files(jobs.transaction_rate(_utc(stream)), target, checkpoint).awaitTermination()
    return shaped(
        spark.read.parquet(target).withColumns({n: c(n).cast("timestamp_ntz") for n in ("window_start", "window_end")}),
        "window_start timestamp_ntz, window_end timestamp_ntz, txn string, executed bigint, total_seconds double, per_second double",
    )


def _utc(df: DataFrame) -> DataFrame:
    """Event time as an instant: watermarks need one."""
    return df.withColumn("ts", c("ts").cast("timestamp"))


def entries() -> Entries:
    level = "CASE WHEN s_quantity - taken >= 10 THEN s_quantity - taken ELSE 10 + (((s_quantity - taken - 10) % 91) + 91) % 91 END"
    return {
        "stream_ingest_documents": (_ingest, with_views(
            """SELECT h.o_id, h.o_w_id, h.o_entry_d, count(ol_i_id) AS lines, CAST(sum(ol_quantity) AS BIGINT) AS pieces
            FROM d_header h LEFT JOIN d_ol l ON l.o_id = h.o_id GROUP BY 1, 2, 3""")),
        "stream_apply_orders": (_apply, with_views(
            f"""SELECT p.seq, p.w_id, p.d_id, p.o_id,
            CAST(sum(amount) AS DOUBLE) * (CAST(1 AS DOUBLE) - CAST(c_discount AS DOUBLE)) * (CAST(1 AS DOUBLE) + CAST(w_tax AS DOUBLE) + CAST(d_tax AS DOUBLE)) AS total,
            CAST(sum({level}) AS BIGINT) AS left_in_stock
            FROM placed p JOIN lines l ON l.seq = p.seq GROUP BY p.seq, p.w_id, p.d_id, p.o_id, c_discount, w_tax, d_tax""", ORDER_SQL)),
        "stream_txn_rate": (_rates,
            f"""WITH log AS ({_TXN}) SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
            txn, count(*) AS executed, CAST(sum(CAST(duration AS DECIMAL(24,6))) AS DOUBLE) AS total_seconds,
            round(count(*) / CAST(3600 AS DOUBLE), 6) AS per_second FROM log GROUP BY 1, 2, 3"""),
    }
