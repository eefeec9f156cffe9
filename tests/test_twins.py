"""Every registered query against the same question asked in SQL of another engine."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ordermill.registered import registered, twin_sql
from tests.conftest import rows_of

QUERIES, SQL = registered(), twin_sql()
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def test_each_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees(name, spark, sf_dir, duck):
    result = QUERIES[name](spark, sf_dir)
    ours = result.toPandas()
    described = duck.execute(f"DESCRIBE {SQL[name]}").fetchall()
    assert dict(result.dtypes) == {column: TYPES[kind] for column, kind, *_ in described}
    theirs = duck.execute(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


def test_entry_runs(spark):
    assert entry(spark).count() > 0
