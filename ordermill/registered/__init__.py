"""Registered queries: name -> (callable(spark, sf_dir), SQL each must agree with or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
Entries = dict[str, tuple[Query, str | None]]


def entries() -> Entries:
    from ordermill.registered import analytic, files, lookups, metrics, reshape, streams, transactions

    found: Entries = {}
    for part in (analytic, reshape, transactions, lookups, metrics, files, streams):
        found.update(part.entries())
    return found


def registered() -> dict[str, Query]:
    return {name: query for name, (query, _) in entries().items()}


def twin_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in entries().items() if sql is not None}
