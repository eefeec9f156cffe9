"""Sliced operators against the plain computation on one hot key among others."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermill.operators.ordering import middle_row, running_total, smallest_rows


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "a", "b"]), n, rng.randint(1, 50)) for n in range(500)]
    return spark.createDataFrame(rows, "k string, n bigint, v bigint").cache()


@pytest.mark.parametrize("width", [1, 7, 64, 10_000])
def test_running_total(skewed, width):
    plain = F.coalesce(F.sum("v").over(Window.partitionBy("k").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    got = running_total(skewed, ["k"], ["n"], {"before": "v", "place": F.lit(1)}, width)
    expected = skewed.withColumn("before", plain).withColumn("place", F.row_number().over(Window.partitionBy("k").orderBy("n")) - 1)
    assert sorted(got.select("k", "n", "v", "before", "place").collect()) == sorted(expected.collect())


@pytest.mark.parametrize("bound", [20, 10_000])
def test_middle_row(spark, bound):
    rng = random.Random(9)
    rows = [(rng.choice("xyz"), "".join(rng.choice("ab") for _ in range(rng.randint(1, 6))), n) for n in range(301)]
    rows += [("single", "q", 1), ("pair", "b", 2), ("pair", "a", 3)]
    got = middle_row(spark.createDataFrame(rows, "k string, t string, id bigint"), ["k"], "t", "id", bound)
    expected = []
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        expected.append(group[(len(group) - 1) // 2])
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


@pytest.mark.parametrize("n", [0, 17, 500, 501])
def test_smallest_rows(spark, n):
    rows = spark.range(500).withColumn("t", F.md5(F.col("id").cast("string")))
    got = smallest_rows(rows, n, "t", "id", bound=100)
    assert sorted(got.collect(), key=lambda r: r.t) == rows.orderBy("t").limit(n).collect()


@pytest.mark.parametrize("broadcast", [True, False])
def test_selection_among_names_that_begin_alike(spark, monkeypatch, broadcast):
    """All names share 30 characters: the sort still sees only a few rows of a key."""
    if not broadcast:
        monkeypatch.setattr("ordermill.operators.ordering.BROADCAST_BYTES", 0)
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 5 == 0, "cold").otherwise("hot").alias("k"), F.concat(F.lit("x" * 30), F.md5((F.col("id") % 700).cast("string"))).alias("t"), "id")
    got = middle_row(rows, ["k"], "t", "id", 200)
    plain = rows.withColumns({"r": F.row_number().over(Window.partitionBy("k").orderBy("t", "id")), "n": F.count("*").over(Window.partitionBy("k"))})
    expected = plain.where("r - 1 = floor((n - 1) / 2)").select("k", "t", "id")
    assert sorted(got.collect()) == sorted(expected.collect())
    sizes = row_at_sizes(spark, got)
    assert sizes <= 200


def row_at_sizes(spark, got):
    """Rows the last sort of a selection reads, at most per key."""
    from pyspark.sql import DataFrame
    plan = got._jdf.queryExecution().analyzed()
    while "Window" != plan.nodeName():
        plan = plan.children().head()
    below = plan.children().head()
    jdf = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, below)
    return DataFrame(jdf, spark).groupBy("k").count().agg(F.max("count")).first()[0]


def test_rows_that_cannot_be_cut(spark):
    rows = spark.range(500).select(F.lit("a").alias("k"), F.lit("same").alias("t"), F.lit(1).alias("id"))
    assert [tuple(r) for r in middle_row(rows, ["k"], "t", "id", 10).collect()] == [("a", "same", 1)]
    assert middle_row(rows.where("false"), ["k"], "t", "id", 10).count() == 0
