"""Queries that SQL can say as well, in another engine."""

import duckdb
import pytest

from ordermill.llm.registered import QUERIES, SQL
from tests.conftest import rows_of


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees(name, spark, sf_dir):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    ours, theirs = QUERIES[name](spark, sf_dir), con.execute(SQL[name]).df()
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string"}
    assert dict(ours.dtypes) == {c: kinds[k] for c, k, *_ in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert rows_of(ours.toPandas()) == rows_of(theirs)
