"""Changes laid over large tables: results of plain joins, and only possible rows in the exchange."""

import pytest
from pyspark.sql import functions as F

from ordermill.operators.changes import key_filter, laid_over, overlay, possible, without_keys


@pytest.fixture(scope="module")
def base(spark):
    rows = [(n % 7, n, n * 1.5) for n in range(5000)] + [(None, 1, 0.0), (3, None, 0.0)]
    return spark.createDataFrame(rows, "a bigint, b bigint, v double").cache()


@pytest.mark.parametrize("bits", [64, 1 << 14])
@pytest.mark.parametrize("count", [0, 400])
def test_same_as_a_plain_join(spark, base, bits, count):
    # an integer key of another width finds its partner too
    changes = base.where(f"b < {count} and a is not null").select(F.col("a").cast("int").alias("a"), "b", (F.col("v") + 1).alias("w"))
    change = lambda rows: rows.withColumn("v", F.coalesce("w", "v"))
    plain = change(base.join(changes, ["a", "b"], "left")).select("a", "b", "v")
    order = lambda df: sorted(df.collect(), key=str)
    assert order(laid_over(base, changes, ["a", "b"], change, bits)) == order(plain)
    assert order(overlay(base, changes.withColumnRenamed("w", "v"), ["a", "b"], bits)) == order(plain)
    assert order(without_keys(base, changes, ["a", "b"], bits)) == order(base.join(changes, ["a", "b"], "left_anti").select("a", "b", "v"))
    assert order(possible(base, changes, ["a", "b"], bits).join(changes, ["a", "b"])) == order(base.join(changes, ["a", "b"]))


def test_few_rows_take_the_join(base):
    few = base.where("b in (10, 2000, 4999)").select("a", "b")
    taken = possible(base, few, ["a", "b"])
    assert 3 <= taken.count() <= 10
    assert base.where(~key_filter(base, few, ["a", "b"])).count() >= 4990
