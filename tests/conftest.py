import os
import sys
import tempfile

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
GIVEN = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ordermill-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def given_views(folder):
    con = duckdb.connect()
    for table in GIVEN:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


@pytest.fixture(scope="session")
def duck(sf_dir):
    return given_views(sf_dir)


@pytest.fixture(scope="session")
def documents(spark):
    """A small synthesised data set: two warehouses, thirty customers per district."""
    from ordermill.synth.tables import Scale, Synth

    synth = Synth(spark, Scale(2, divisor=100), seed=11, suppliers=50)
    names = ("warehouse", "district", "customer", "orders", "neworder", "stock", "item", "history", "supplier", "nation", "region")
    return {name: synth.table(name).cache() for name in names}


def rows_of(frame):
    """Rows as plain values in a fixed order, nulls as None."""
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object)
    plain = plain.where(plain.notna(), None)
    return sorted((tuple(r) for r in plain.itertuples(index=False, name=None)), key=lambda r: tuple(map(str, r)))
