"""Time the analytical queries; prints one JSON line.

The document tables are loaded first (time reported as ``load_sec``), as a data set is loaded
before it is queried; then each query runs twice to warm up, and the median of its next three runs counts,
with the result written to the no-op sink.
"""

from __future__ import annotations

import json
import math
import os
import sys
import tempfile
import time
from statistics import median

from pyspark.sql import SparkSession

from ordermill.plans.catalog import ANALYTIC
from ordermill.plans.layouts import LAYOUTS
from ordermill.plans.fixture_params import FIXTURE_PARAMS
from ordermill.sources.store import loaded_store

TABLES = ("orders", "orders_header", "orders_orderline", "customer", "item", "stock", "supplier", "nation", "region", "neworder")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ordermill-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    started = time.perf_counter()
    store = loaded_store(spark, sf_dir)
    for table in TABLES:
        store.table(table)
    load = time.perf_counter() - started

    def timed(name: str, layout: str) -> float:
        t = time.perf_counter()
        ANALYTIC[name](LAYOUTS[layout](store), **FIXTURE_PARAMS[name]).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    names = [q for q in ANALYTIC if q != "q21_lines"]
    layouts = {"nested": "", "flat": "_flat"} if "--flat" in sys.argv else {"nested": ""}
    times = {}
    for layout, suffix in layouts.items():
        for name in names + names:
            timed(name, layout)
        for name in names:
            times[f"{name}{suffix}"] = round(median(timed(name, layout) for _ in range(3)), 4)
    nested = [times[n] for n in names]
    total = sum(nested)
    print(json.dumps({
        "metric": "time per set of 22 queries on nested documents", "value": round(total, 3), "unit": "sec", "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "load_sec": round(load, 2), "load_and_set_sec": round(load + total, 2),
        "geometric_mean_sec": round(math.exp(sum(map(math.log, nested)) / len(nested)), 4),
        "queries_per_hour": round(len(nested) * 3600 / total, 2),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
