"""Column statistics of whole tables and of merged pieces against plain counts."""

import pytest
from pyspark.sql import functions as F

from ordermill.sources.statistics import column_statistics, described, merged


@pytest.mark.parametrize("pieces", [1, 3])
def test_against_plain_counts(spark, documents, pieces):
    orders = documents["orders"].withColumn("piece", F.pmod(F.xxhash64("o_id"), F.lit(pieces)))
    parts = [column_statistics("orders", orders.where(f"piece = {n}").drop("piece")) for n in range(pieces)]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    got = {r.column_name: r for r in described(merged(both)).collect()}
    lines = documents["orders"].select(F.explode("o_orderline").alias("l")).select("l.*")
    assert set(got) == {n for n in documents["orders"].columns if n != "o_orderline"} | {f"o_orderline[].{n}" for n in lines.columns}
    for frame, prefix in ((documents["orders"].drop("o_orderline"), ""), (lines, "o_orderline[].")):
        rows = frame.toPandas()
        for name in frame.columns:
            r, values = got[prefix + name], rows[name].dropna()
            assert (r.row_count, r.null_count) == (len(rows), len(rows) - len(values)), name
            distinct = values.nunique()
            assert abs(r.distinct_estimate - distinct) <= 0.1 * distinct, name
            if dict(frame.dtypes)[name] in ("bigint", "double"):
                assert (r.min_number, r.max_number) == (values.min(), values.max()), name
                for rank, quantile in zip((0.25, 0.5, 0.75), r.quantiles):
                    assert (values < quantile).mean() - 0.03 <= rank <= (values <= quantile).mean() + 0.03, name
            elif len(values):
                assert (r.min_text, r.max_text) == (str(values.min()), str(values.max())), name


def test_structs_scalars_in_arrays_and_empty_tables(spark, documents):
    got = {r.column_name: r for r in described(column_statistics("customer", documents["customer"])).collect()}
    assert got["c_name.c_last"].min_text == documents["customer"].agg(F.min("c_name.c_last")).first()[0]
    assert got["c_item_categories[]"].row_count == documents["customer"].agg(F.sum(F.size("c_item_categories"))).first()[0]
    assert "c_addresses[].c_city" in got and "c_phones[].c_phone_number" in got
    for r in described(column_statistics("customer", documents["customer"].where("false"))).collect():
        assert (r.row_count, r.null_count, r.min_number, r.max_text, r.distinct_estimate, r.quantiles) == (0, 0, None, None, 0, None)
