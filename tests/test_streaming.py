"""Streams give what the batch form gives, also over restarts."""

from pyspark.sql import functions as F

from ordermill.operators.reshape import once_each
from ordermill.plans import transactions as txn
from ordermill.sources.schemas import text_dates
from ordermill.streaming import jobs
from ordermill.synth.requests import request_mix, requests_of
from ordermill.synth.tables import Scale


def test_ingest_takes_each_file_once(spark, documents, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    docs = text_dates("orders", documents["orders"])
    for part in (docs.where("o_id <= 10"), docs.where("o_id > 10")):
        part.write.mode("append").json(source)
        jobs.ingest_documents(spark, source, target, checkpoint, "orders").awaitTermination()
    jobs.ingest_documents(spark, source, target, checkpoint, "orders").awaitTermination()
    assert sorted(once_each(spark.read.parquet(target)).toJSON().collect()) == sorted(documents["orders"].toJSON().collect())


def test_order_batches_equal_one_batch(spark, documents, tmp_path):
    source, folder, checkpoint = (str(tmp_path / n) for n in ("in", "tables", "cp"))
    requests = requests_of(request_mix(spark, 240, Scale(2, divisor=100), seed=8), "new_order").cache()
    changed, result = txn.new_order(documents, requests)
    base, since = documents, 0
    for low, high in ((0, 80), (80, 160), (160, 240)):
        requests.where(f"seq > {low} and seq <= {high}").coalesce(1).write.mode("append").parquet(source)
        # a fresh object each time: all state is in the folder
        tables = jobs.ChangedTables(spark, folder, base, since, fan_in=2)
        stream = spark.readStream.schema(requests.schema).parquet(source)
        jobs.apply_orders(stream, tables, checkpoint).awaitTermination()
        if high == 160:
            tables = tables.compacted(2, str(tmp_path / "compact"))
            base, since = tables.base, tables.since
    assert sorted(tables.results().toJSON().collect()) == sorted(result.toJSON().collect())
    for name in ("stock", "district", "neworder", "orders"):
        assert sorted(tables.table(name, 3).toJSON().collect()) == sorted(changed[name].select(tables.table(name, 3).columns).toJSON().collect()), name


def test_rates_close_with_the_watermark(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows = [("2024-01-01 00:10:00", "payment", 1.0), ("2024-01-01 00:20:00", "payment", 2.0), ("2024-01-01 03:00:00", "delivery", 1.0)]
    df = spark.createDataFrame(rows, "t string, txn string, duration double").select(F.col("t").cast("timestamp").alias("ts"), "txn", "duration")
    df.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    jobs.rate_to_files(jobs.transaction_rate(stream), target, checkpoint).awaitTermination()
    got = spark.read.parquet(target).collect()
    assert [(r.txn, r.executed, r.total_seconds) for r in got] == [("payment", 2, 3.0)]
    batch = jobs.transaction_rate(df)
    assert batch.count() == 2


def test_runs_stay_few(spark, documents, tmp_path):
    """Fifty batches: the runs read before each grow with the logarithm, and the latest rows win, also after a repeated batch."""
    base = spark.range(12).select((F.col("id") % 3).alias("d_w_id"), F.floor(F.col("id") / 3).alias("d_id"), F.lit(-1).cast("bigint").alias("d_next_o_id")).cache()
    latest = {(r.d_w_id, r.d_id): -1 for r in base.collect()}
    added = []
    for n in range(50):
        tables = jobs.ChangedTables(spark, str(tmp_path), {"district": base, "neworder": base.select("d_id").where("false")})
        runs = tables.runs(n)
        assert len(runs) <= 9 and [s for s, _ in runs] == [0, *[e for _, e in runs]][:len(runs)] and (not runs or runs[-1][1] == n)
        key = (n % 3, n % 4)
        change = spark.createDataFrame([(*key, n)], "d_w_id bigint, d_id bigint, d_next_o_id bigint").coalesce(1)
        for _ in range(2 if n in (15, 47) else 1):  # a batch that was interrupted comes again
            tables.commit(n, {"district": change, "neworder": change.select("d_id")})
        latest[key] = n
        added.append(key[1])
    for before in (1, 16, 50):
        asof = {(r.d_w_id, r.d_id): r.d_next_o_id for r in tables.table("district", before).collect()}
        assert asof == latest if before == 50 else max(asof.values()) == before - 1
    assert len(tables._together("district", tables.runs(50)).inputFiles()) <= 9
    assert sorted(r.d_id for r in tables.table("neworder", 50).collect()) == sorted(added)
