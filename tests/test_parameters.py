import pytest

from ordermill.functions.draws import Draw
from ordermill.plans.parameters import Domains, draw


@pytest.mark.parametrize("name", [f"q{n:02d}" for n in range(1, 23)])
def test_defaults_draw_for_every_query(name):
    runs = [draw(name, Domains(), seed) for seed in range(20)]
    assert runs == [draw(name, Domains(), seed) for seed in range(20)]
    assert all(runs) and all(set(r) == set(runs[0]) for r in runs)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 997])
def test_permutation(spark, n):
    from pyspark.sql import functions as F

    rows = spark.range(n).select(*[Draw(seed, "t").permuted(F.col("id"), n, "p").alias(f"p{seed}") for seed in range(3)]).collect()
    for seed in range(3):
        assert sorted(r[seed] for r in rows) == list(range(n))
    if n > 100:
        assert len({tuple(r[seed] for r in rows) for seed in range(3)}) == 3
