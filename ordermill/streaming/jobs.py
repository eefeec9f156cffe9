"""Structured Streaming jobs: file ingest, micro-batches of orders, rates per window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill.operators.changes import overlay
from ordermill.operators.reshape import with_parts
from ordermill.plans.transactions import new_order_changes
from ordermill.sources.schemas import PRIMARY_KEYS, document_schema, typed_dates

c = F.col


def ingest_documents(spark: SparkSession, source: str, target: str, checkpoint: str, table: str, files_per_batch: int = 1000) -> StreamingQuery:
    """New JSON document files into a columnar table, each exactly once.

    The file source logs which files it took and the sink commits per batch, so a restart from
    the same checkpoint neither repeats nor skips a file.
    """
    rows = spark.readStream.schema(document_schema(table, parts=True)).option("maxFilesPerTrigger", files_per_batch).json(source)
    return (
        typed_dates(table, rows).writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


class ChangedTables:
    """Base tables and the changes of each micro-batch, kept apart in one folder.

    A batch writes only the rows it changes, as a run of its own number. Whenever ``fan_in`` runs of one
    length are complete, the batch that completes them merges them into one run ``fan_in`` times as long (the latest row of each key,
    or all new rows), so that a table as of any batch is its base and a number of runs that grows
    with the logarithm of the batches. The lengths follow from the batch numbers alone and nothing is kept in memory: a
    restarted driver continues from the folder, and a repeated batch reads only runs that ended before it and rewrites its own part.
    The base holds everything before batch ``since``. Shorter runs stay where they are after merging.
    """

    REPLACED = ("district", "stock")
    APPENDED = ("orders", "neworder")

    def __init__(self, spark: SparkSession, folder: str, base: dict[str, DataFrame], since: int = 0, fan_in: int = 4):
        self.spark = spark
        self.folder = folder
        self.base = base | {name: with_parts(base[name]) for name in ("orders",) if name in base}
        self.since = since
        self.fan_in = fan_in

    def _path(self, name: str, start: int, end: int) -> str:
        return f"{self.folder}/{name}/batch={start}" if end - start == 1 else f"{self.folder}/merged/{name}/{start}-{end}"

    def runs(self, before: int) -> list[tuple[int, int]]:
        """The longest runs (first batch, end) that make up the batches from ``since`` to ``before``."""
        found, at = [], self.since
        while at < before:
            width = 1
            while at % (width * self.fan_in) == 0 and at + width * self.fan_in <= before:
                width *= self.fan_in
            found.append((at, at + width))
            at += width
        return found

    def _together(self, name: str, runs: list[tuple[int, int]]) -> DataFrame:
        """Rows of several runs as one: of a replaced table the latest of each key."""
        if name in self.APPENDED:
            return self.spark.read.parquet(*[self._path(name, *run) for run in runs])
        keys = PRIMARY_KEYS[name]
        read = [self.spark.read.parquet(self._path(name, *run)) for run in runs]
        if len(read) == 1:
            return read[0]
        rows = reduce(DataFrame.unionByName, [rows.withColumn("_run", F.lit(n)) for n, rows in enumerate(read)])
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*read[0].columns), "_run").alias("row")).select("row.*")

    def table(self, name: str, before: int) -> DataFrame:
        """The table as the batch numbered ``before`` finds it."""
        base = self.base[name]
        if before == self.since or name not in self.REPLACED + self.APPENDED:
            return base
        changes = self._together(name, self.runs(before))
        if name in self.APPENDED:
            return base.select(changes.columns).unionByName(changes)
        return overlay(base, changes, PRIMARY_KEYS[name])

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        def keep(rows: DataFrame, label: str) -> DataFrame:
            path = f"{self.folder}/work/{label}/batch={batch_id}"
            rows.write.mode("overwrite").parquet(path)
            return self.spark.read.parquet(path)

        needed = ("district", "stock", "warehouse", "customer", "item")
        changes, result = new_order_changes({n: self.table(n, batch_id) for n in needed}, batch, keep)
        result.write.mode("overwrite").parquet(self._path("result", batch_id, batch_id + 1))
        self.commit(batch_id, changes)

    def commit(self, batch_id: int, changes: dict[str, DataFrame]) -> None:
        """Write the changes of a batch as its run, then every longer run that ends with it."""
        end = batch_id + 1
        for name, rows in changes.items():
            rows.write.mode("overwrite").parquet(self._path(name, batch_id, end))
            width = self.fan_in
            while end % width == 0 and end - width >= self.since:
                step = width // self.fan_in
                parts = [(start, start + step) for start in range(end - width, end, step)]
                self._together(name, parts).write.mode("overwrite").parquet(self._path(name, end - width, end))
                width *= self.fan_in

    def compacted(self, before: int, target: str) -> ChangedTables:
        """Write the tables as of a batch below ``target`` and go on from them: reading then lays
        only later changes over the base. The changes stay where they are."""
        written = {}
        for name in self.REPLACED + self.APPENDED:
            self.table(name, before).write.mode("overwrite").parquet(f"{target}/{name}")
            written[name] = self.spark.read.parquet(f"{target}/{name}")
        return ChangedTables(self.spark, self.folder, self.base | written, before)

    def results(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/result").drop("batch")


def apply_orders(requests: DataFrame, tables: ChangedTables, checkpoint: str) -> StreamingQuery:
    """A stream of new-order requests, each micro-batch applied with the batch function.

    ``seq`` must grow from batch to batch; the parts of one request come in one batch.
    """
    return (
        requests.writeStream.foreachBatch(tables.apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def transaction_rate(events: DataFrame, width: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Transactions per type and tumbling window, with their total time and rate per second.

    ``events``: ts, txn, duration. Works on a stream, where the watermark bounds the state, and
    on a batch.
    """
    timed = events.withWatermark("ts", lateness)
    sums = timed.groupBy(F.window("ts", width).alias("w"), "txn").agg(
        F.count("*").alias("executed"), F.sum(c("duration").cast("decimal(24,6)")).cast("double").alias("total_seconds")
    )
    span = c("window_end").cast("timestamp").cast("long") - c("window_start").cast("timestamp").cast("long")
    return sums.select(
        c("w.start").alias("window_start"), c("w.end").alias("window_end"), "txn", "executed", "total_seconds"
    ).withColumn("per_second", F.round(c("executed") / span, 6))


def rate_to_files(rates: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write finished windows; a window is written once, after the watermark has passed it."""
    return (
        rates.writeStream.outputMode("append").format("parquet").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
