"""Timing summaries over logs that the given events stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.expr import ts
from ordermill.plans import metrics
from ordermill.registered import Entries
from ordermill.sources.workspace import fresh_path

c = F.col
WARMUP = 3600.0


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three clients run sets of 22 queries, some of them one twice in place of another; two event types report milliseconds."""
    turn = F.floor(c("event_id") / 3)
    turn = F.when(c("event_id") % 500 == 11, turn - 1).otherwise(turn)
    milli = c("event_type").isin("error", "signup")
    elapsed = F.when(milli, F.concat((c("value") * 1000).cast("bigint").cast("string"), F.lit("ms"))).otherwise(
        F.concat(c("value").cast("string"), F.lit("s")))
    return _events(spark, sf_dir).select(
        (c("event_id") % 3).alias("client"), F.format_string("Q%02d", 1 + F.pmod(turn, F.lit(22))).alias("query"),
        (1 + F.floor(F.floor(c("event_id") / 3) / 22)).alias("loop"), elapsed.alias("elapsed"),
    )


_LOG = {"log": """SELECT event_id % 3 AS client, printf('Q%02d', 1 + (event_id // 3 - CASE WHEN event_id % 500 = 11 THEN 1 ELSE 0 END) % 22) AS query, 1 + (event_id // 3) // 22 AS loop,
    CASE WHEN event_type IN ('error', 'signup') THEN CAST(trunc(value * 1000) AS BIGINT) / CAST(1000 AS DOUBLE) ELSE value END AS sec FROM events"""}
_COMPLETE = {"complete": "SELECT client, loop FROM log WHERE loop > 1 GROUP BY client, loop HAVING count(DISTINCT query) = 22",
             "means": """SELECT query, CAST(sum(CAST(round(sec, 2) AS DECIMAL(24,6))) AS DOUBLE) / count(*) AS avg_seconds, count(*) AS runs
                FROM log SEMI JOIN complete ON complete.client = log.client AND complete.loop = log.loop GROUP BY query"""}


def result_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result files of 22 timings each, with a footer; the last file stops early, some files
    repeat a query, and some have a timing that is no number."""
    e = _events(spark, sf_dir).withColumn("config", F.concat(F.lit("run"), F.floor(c("event_id") / 22).cast("string")))
    number = F.when((c("event_id") % 1000 == 7), 1 + (c("event_id") + 21) % 22).otherwise(1 + c("event_id") % 22)
    spoilt = F.when(c("event_id") % 777 == 5, F.lit(".5")).otherwise(F.lit(""))
    timing = F.concat(F.format_string("Q%02d\t", number), c("value").cast("string"), spoilt)
    footer = F.concat(F.lit("QUERIES PER HOUR (Qph) = "), c("value").cast("string"))
    return e.select("config", F.explode(F.array(timing, F.when(c("event_id") % 22 == 0, footer))).alias("line")).where("line IS NOT NULL")


_LINES = {
    "labelled": """SELECT 'run' || (event_id // 22) AS config, value AS seconds, event_id % 777 = 5 AS spoilt,
        printf('Q%02d', CASE WHEN event_id % 1000 = 7 THEN 1 + (event_id + 21) % 22 ELSE 1 + event_id % 22 END) AS query FROM events""",
    "found": "SELECT config, query, seconds FROM labelled WHERE NOT spoilt",
    "present": "SELECT config, list(query) FILTER (NOT spoilt) AS queries FROM labelled GROUP BY config",
    "wanted": "SELECT config, printf('Q%02d', n) AS query FROM present CROSS JOIN range(1, 23) r(n)",
    "problems": """SELECT config,
        (SELECT coalesce(string_agg(w.query, ',' ORDER BY w.query), '') FROM wanted w WHERE w.config = p.config AND NOT list_contains(queries, w.query)) AS missing,
        (SELECT coalesce(string_agg(query, ',' ORDER BY query), '') FROM (SELECT query FROM found g WHERE g.config = p.config GROUP BY query HAVING count(*) > 1)) AS repeated,
        (SELECT coalesce(string_agg(DISTINCT l.query, ',' ORDER BY l.query), '') FROM labelled l WHERE l.config = p.config AND spoilt) AS unreadable
        FROM present p""",
}


def transaction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.create_map(*[F.lit(x) for pair in (("click", "new_order"), ("view", "payment"), ("purchase", "delivery"),
                                                ("signup", "order_status"), ("error", "stock_level")) for x in pair])
    status = F.when(c("event_id") % 50 == 0, "aborted").when(c("event_id") % 9 == 0, "retried").otherwise("ok")
    started = F.timestamp_diff("MICROSECOND", ts("1970-01-01 00:00:00"), c("ts")) / F.lit(1000000.0)
    return _events(spark, sf_dir).select(
        "ts", kinds[c("event_type")].alias("txn"), started.alias("started_at"), (c("value") / 1000.0).alias("duration"), status.alias("status")
    )


_TXN = """SELECT ts, CASE event_type WHEN 'click' THEN 'new_order' WHEN 'view' THEN 'payment' WHEN 'purchase' THEN 'delivery'
    WHEN 'signup' THEN 'order_status' ELSE 'stock_level' END AS txn, value / 1000.0 AS duration,
    CASE WHEN event_id % 50 = 0 THEN 'aborted' WHEN event_id % 9 = 0 THEN 'retried' ELSE 'ok' END AS status FROM events"""
_SUM = "CAST(sum(CAST({} AS DECIMAL(24,6))) AS DOUBLE)"


def lookup_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        F.concat(F.lit("table_"), (c("user_id") % 10).cast("string")).alias("dataset"), (c("value") - 5.0).alias("seconds")
    )


_LOOKUPS = {"log": "SELECT 'table_' || (user_id % 10) AS dataset, value - 5.0 AS seconds FROM events"}


CONFIGS = ("click", "error", "purchase", "signup", "view")


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean time per query of the five event types as configurations, by way of their result files."""
    turn = F.floor(c("event_id") / 3)
    timings = _events(spark, sf_dir).groupBy(F.format_string("Q%02d", 1 + turn % 22).alias("query"), c("event_type").alias("config")).agg(
        F.round(metrics.total(c("value")) / F.count("*"), 4).alias("seconds"))
    path = fresh_path(spark, "results")
    timings.select("config", F.concat_ws("\t", "query", c("seconds").cast("string")).alias("line")).write.partitionBy("config").text(path)
    return metrics.compare_configs(metrics.query_lines(metrics.read_result_files(spark, path)), list(CONFIGS))


def _run_span(log: DataFrame) -> tuple[Column, Column]:
    """First and last start in a log."""
    return log.agg(F.min("started_at")).scalar(), log.agg(F.max("started_at")).scalar()


def _wall_seconds(spark: SparkSession, sf_dir: str) -> Column:
    """From the first to the last event."""
    micros = F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts"))
    return _events(spark, sf_dir).agg((micros / F.lit(1000000.0)).alias("wall")).scalar()


def entries() -> Entries:
    geo = "exp(avg(ln({})))"
    ctes = lambda parts, sql: "WITH " + ", ".join(f"{n} AS ({b})" for n, b in parts.items()) + " " + sql
    config = {"t": f"""SELECT printf('Q%02d', 1 + (event_id // 3) % 22) AS query, event_type AS config,
        round({_SUM.format('value')} / count(*), 4) AS seconds FROM events GROUP BY 1, 2"""}
    return {
        "metrics_parse_log": (
            lambda s, d: metrics.parsed_results(result_lines(s, d)),
            ctes(_LINES, "SELECT config, query, seconds FROM found ANTI JOIN (SELECT config FROM problems WHERE missing <> '' OR repeated <> '' OR unreadable <> '') p ON p.config = found.config"),
        ),
        "metrics_log_problems": (
            lambda s, d: metrics.log_problems(result_lines(s, d)),
            ctes(_LINES, "SELECT config, missing, repeated, unreadable FROM problems WHERE missing <> '' OR repeated <> '' OR unreadable <> ''"),
        ),
        "metrics_footers": (
            lambda s, d: metrics.footer_lines(result_lines(s, d)).select("config", "qph"),
            "SELECT 'run' || (event_id // 22) AS config, max(CASE WHEN event_id % 22 = 0 THEN value END) AS qph FROM events GROUP BY 1",
        ),
        "metrics_result_summaries": (
            lambda s, d: metrics.result_summaries(metrics.parsed_results(result_lines(s, d))),
            ctes(_LINES, f"""SELECT config, round({geo.format('seconds')}, 2) AS geometric_mean, round({_SUM.format('seconds')}, 2) AS set_seconds,
                round(count(*) * CAST(3600 AS DOUBLE) / {_SUM.format('seconds')}, 2) AS qph FROM found
                ANTI JOIN (SELECT config FROM problems WHERE missing <> '' OR repeated <> '' OR unreadable <> '') p ON p.config = found.config GROUP BY config"""),
        ),
        "metrics_loop": (
            lambda s, d: metrics.loop_summaries(query_log(s, d), 1),
            ctes(_LOG, f"""SELECT client, loop, count(*) AS queries, round({_SUM.format('sec')}, 2) AS total_seconds,
                round({geo.format('sec')}, 2) AS geometric_mean, round({_SUM.format('sec')} / count(*) + CAST('1e-9' AS DOUBLE), 2) AS arithmetic_mean
                FROM log WHERE loop > 1 GROUP BY client, loop"""),
        ),
        "metrics_query_avg": (
            lambda s, d: metrics.query_averages(query_log(s, d), 1),
            ctes(_LOG | _COMPLETE, "SELECT query, avg_seconds, runs FROM means"),
        ),
        "metrics_overall": (
            lambda s, d: metrics.overall(query_log(s, d), 1, clients=3),
            ctes(_LOG | _COMPLETE, f"""SELECT round({geo.format('avg_seconds')}, 2) AS geometric_mean, round({_SUM.format('avg_seconds')}, 2) AS set_seconds,
                round(count(*) * CAST(3600 AS DOUBLE) / {_SUM.format('avg_seconds')} * 3, 2) AS qph FROM means"""),
        ),
        "metrics_txn": (
            lambda s, d: metrics.transaction_summary(transaction_log(s, d), *_run_span(transaction_log(s, d)), WARMUP),
            f"""WITH log AS ({_TXN}), run AS (SELECT min(ts) AS first, (epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(1000000 AS DOUBLE) - {WARMUP} AS span FROM log)
                SELECT coalesce(txn, 'TOTAL') AS txn, count(*) FILTER (status <> 'aborted') AS executed,
                round(coalesce({_SUM.format("CASE WHEN status <> 'aborted' THEN duration END")}, 0) * 1000000, 3) AS micros,
                round(count(*) FILTER (status <> 'aborted') / (SELECT span FROM run), 2) AS per_second,
                count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'retried') AS retried, count(*) FILTER (status = 'aborted') AS aborted
                FROM log WHERE ts >= (SELECT first FROM run) + INTERVAL 1 HOUR GROUP BY ROLLUP (txn)""",
        ),
        "metrics_by_dataset": (
            lambda s, d: metrics.dataset_summary(lookup_log(s, d)),
            ctes(_LOOKUPS, f"""SELECT dataset, count(*) AS lookups, round({_SUM.format('seconds')}, 4) AS sum_seconds,
                round(exp(avg(CASE WHEN seconds > 0 THEN ln(seconds) END)), 6) AS geometric_mean FROM log GROUP BY dataset"""),
        ),
        "metrics_failed_lookups": (
            lambda s, d: metrics.failed_lookups(lookup_log(s, d).withColumn("seconds", F.when(c("seconds") > -5.0, c("seconds")))),
            ctes(_LOOKUPS, "SELECT dataset, count(*) AS lookups, count(*) FILTER (seconds <= -5.0) AS failed FROM log GROUP BY dataset"),
        ),
        "metrics_lookup_rates": (
            lambda s, d: metrics.lookup_rates(lookup_log(s, d), _wall_seconds(s, d)),
            ctes(_LOOKUPS, f"""SELECT count(*) AS lookups, round({_SUM.format('seconds')}, 4) AS sum_seconds,
                round(exp(avg(CASE WHEN seconds > 0 THEN ln(seconds) END)), 6) AS geometric_mean,
                round(count(*) * CAST(3600 AS DOUBLE) / (SELECT (epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(1000000 AS DOUBLE) FROM events), 2) AS qph_wall,
                round(count(*) * CAST(3600 AS DOUBLE) / {_SUM.format('seconds')}, 2) AS qph_sum FROM log"""),
        ),
        "metrics_compare_config": (
            _compared,
            ctes(config, "SELECT query, " + ", ".join(f"max(seconds) FILTER (config = '{x}') AS {x}" for x in CONFIGS) + ", " + ", ".join(
                f"round(max(seconds) FILTER (config = '{x}') / max(seconds) FILTER (config = 'click'), 4) AS {x}_ratio" for x in CONFIGS[1:]) + " FROM t GROUP BY query"),
        ),
    }
