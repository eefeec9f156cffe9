import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ordermill.plans import lookups
from ordermill.plans.metrics import seconds


def blocks(spark, ranges):
    rows = spark.createDataFrame(ranges, "low long, high long").select("low", "high", lookups.dyadic_cover(F.col("low"), F.col("high")).alias("blocks"))
    return {(r.low, r.high): [(b.level, b.block) for b in r.blocks] for r in rows.collect()}


def test_dyadic_cover_is_exact_and_short(spark):
    r = random.Random(1)
    ranges = [(0, 0), (5, 4), (-7, 9), (1, 6), (0, 1023), (1, 1023), *[(a := r.randint(-3000, 3000), a + r.randint(0, 2000)) for _ in range(40)]]
    for (low, high), found in blocks(spark, ranges).items():
        covered = [x for level, block in found for x in range(block << level, (block + 1) << level)]
        assert sorted(covered) == list(range(low, high + 1)) and len(found) <= 2 * max(1, (max(0, high - low) + 2).bit_length())
    assert len(blocks(spark, [(300_001, 387_600)])[300_001, 387_600]) <= 34


@pytest.mark.parametrize("bin_minutes", [1, 60])
def test_windows_as_brute_force(spark, bin_minutes):
    r = random.Random(2)
    start = dt.datetime(1969, 12, 20)
    orders = [(i, start + dt.timedelta(minutes=r.randint(0, 60_000))) for i in range(400)]
    windows = [(i, low := start + dt.timedelta(minutes=r.randint(-5000, 60_000)), low + dt.timedelta(minutes=r.choice([0, 1, 30, 600, 40_000, 5_000_000]))) for i in range(60)]
    windows += [(100, orders[0][1], orders[0][1] + dt.timedelta(minutes=1)), (101, start + dt.timedelta(days=9), start)]
    o = spark.createDataFrame(orders, "o_id long, o_entry_d timestamp_ntz")
    w = spark.createDataFrame(windows, "n long, low timestamp_ntz, high timestamp_ntz")
    expected = {(n, i) for n, low, high in windows for i, at in orders if low < at < high}
    got = [(x.n, x.o_id) for x in lookups.orders_in_windows(o, w, bin_minutes).collect()]
    assert set(got) == expected and len(got) == len(expected)
    counts = {x.n: x.orders for x in lookups.window_counts(o, w, ["n"], bin_minutes).collect()}
    assert counts == {n: sum(m == n for m, _ in expected) for n, _, _ in windows}
    assert lookups.orders_in_windows(o, w.where("false")).count() == 0


def test_times_that_are_none_are_null(spark):
    rows = spark.createDataFrame([("12ms",), ("1.5s",), ("1.2.3s",), ("s",), (None,)], "t string")
    assert [r[0] for r in rows.select(seconds(F.col("t"))).collect()] == [0.012, 1.5, None, None, None]
