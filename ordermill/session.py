"""Session settings the jobs are meant to run with on a cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

CLUSTER_CONF = {
    # Re-plan from measured sizes: broadcasts only what turned out small, splits skewed join
    # partitions, merges small ones. Partition counts therefore only need an upper bound.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Semi-joins of large tables send a filter ahead to the other side's scan.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.cbo.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    return builder
