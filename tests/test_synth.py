"""Rules of the synthesised data set, as aggregates over whole tables."""

import pytest
from pyspark.sql import functions as F

from ordermill.functions.draws import last_name, nurand
from ordermill.sources.files import check_row_counts, expected_counts
from ordermill.sources.schemas import DOCUMENT_TABLES, document_schema
from ordermill.synth.requests import SHARES, request_mix
from ordermill.synth.tables import Scale, Synth


def one(df, *exprs):
    return df.agg(*[F.expr(e) for e in exprs]).first()


def test_counts(spark, documents):
    expected = expected_counts(2, items=1000, suppliers=50, customers=30, new_orders=9)
    assert check_row_counts(spark, documents, expected).where("not matches").count() == 0


@pytest.mark.parametrize("table", DOCUMENT_TABLES)
def test_schema(table, documents):
    wanted = {f.name: f.dataType for f in document_schema(table, "TIMESTAMP_NTZ").fields}
    got = {f.name: f.dataType for f in documents[table].schema.fields}
    assert {n: t.simpleString() for n, t in wanted.items()} == {n: got[n].simpleString() for n in wanted}


def test_items_and_stock(documents):
    r = one(documents["item"], "min(i_price) >= 1", "max(i_price) <= 100", "sum(int(i_data like '%ORIGINAL%'))",
            "min(length(i_data)) >= 26", "max(length(i_data)) <= 50", "min(size(array_distinct(i_categories)) = size(i_categories))",
            "max(size(i_categories))")
    assert list(r) == [True, True, 100, True, True, True, 2]
    r = one(documents["stock"], "min(s_quantity) >= 10", "max(s_quantity) <= 100", "sum(int(s_data like '%ORIGINAL%'))",
            "min(size(s_dists))", "min(s_remote_cnt = floor(s_order_cnt / 10))", "count(distinct s_w_id, s_i_id)")
    assert list(r) == [True, True, 200, 10, True, 2000]


def test_customers(documents):
    r = one(documents["customer"], "sum(int(c_credit = 'BC'))", "min(c_addresses[0].c_address_kind = 'shipping')",
            "max(size(filter(c_addresses, a -> a.c_address_kind = 'shipping')))", "max(size(c_addresses)) <= 4",
            "min(c_phones[0].c_phone_kind = 'contact')", "max(size(c_item_categories)) <= 14",
            "min(size(array_distinct(c_item_categories)) = size(c_item_categories))", "min(c_name.c_last rlike '^[A-Z]+$')")
    assert list(r) == [60, True, 1, True, True, True, True, True]


def test_orders(documents):
    orders = documents["orders"]
    r = one(orders, "min(size(o_orderline)) >= 5", "max(size(o_orderline)) <= 15", "min(size(o_orderline) = o_ol_cnt)",
            "count(distinct o_w_id, o_d_id, o_c_id)", "sum(int(o_carrier_id = 0))", "min(o_orderline[0].ol_number)")
    assert list(r) == [True, True, True, 600, 180, 0]
    lines = orders.select("o_id", "o_w_id", "o_carrier_id", "o_entry_d", F.inline("o_orderline"))
    free = "o_carrier_id > 0 and o_id % 5 <> 0"
    r = one(lines, f"min(if({free}, ol_amount = 0, ol_amount > 0))", "min((o_carrier_id = 0) = (ol_delivery_d is null))",
            "min(ol_delivery_d is null or ol_delivery_d >= o_entry_d + interval 2 days)",
            "min(ol_delivery_d is null or ol_delivery_d < o_entry_d + interval 151 days)", "min(ol_supply_w_id = o_w_id)")
    assert list(r) == [True] * 5
    since = documents["customer"].select(F.col("c_w_id").alias("o_w_id"), F.col("c_d_id").alias("o_d_id"), F.col("c_id").alias("o_c_id"), "c_since")
    assert orders.join(since, ["o_w_id", "o_d_id", "o_c_id"]).where("o_entry_d <> c_since").count() == 0


def test_balance_is_the_running_district_total(documents):
    totals = documents["orders"].select("o_w_id", "o_d_id", "o_id", "o_c_id", "o_carrier_id",
                                        F.expr("aggregate(o_orderline.ol_amount, 0D, (s, x) -> s + x)").alias("t")).collect()
    running, want = {}, {}
    for r in sorted(totals, key=lambda r: r.o_id):
        district = (r.o_w_id, r.o_d_id)
        running[district] = running.get(district, 0.0) + r.t
        want[(*district, r.o_c_id)] = round(running[district] - 10, 2) if r.o_carrier_id else -10.0
    for r in documents["customer"].select("c_w_id", "c_d_id", "c_id", "c_balance").collect():
        assert r.c_balance == pytest.approx(want[(r.c_w_id, r.c_d_id, r.c_id)], abs=0.005)


def test_year_to_date_sums(documents):
    paid = documents["history"].groupBy(F.col("h_w_id").alias("w_id")).agg(F.sum("h_amount").alias("paid"))
    assert documents["warehouse"].join(paid, "w_id").where("abs(w_ytd - paid) > 0.001").count() == 0
    assert one(documents["district"], "sum(d_ytd)")[0] == one(documents["warehouse"], "sum(w_ytd)")[0]


def test_suppliers(spark):
    suppliers = Synth(spark, Scale(1), seed=3).table("supplier").cache()
    r = one(suppliers, "count(*)", "sum(int(su_comment like '%Customer%Recommends%'))", "sum(int(su_comment like '%Customer%Complaints%'))",
            "min(length(su_comment)) >= 25", "max(length(su_comment)) <= 100")
    assert list(r) == [10000, 5, 5, True, True]
    assert suppliers.groupBy("su_nationkey").count().agg(F.max("count"), F.count("*")).first()[:] == (162, 62)


def test_same_seed_same_rows_in_any_partitioning(spark):
    a = Synth(spark, Scale(1, divisor=300), seed=2).table("orders")
    b = Synth(spark, Scale(1, divisor=300), seed=2).table("orders").repartition(5)
    assert sorted(a.toJSON().collect()) == sorted(b.toJSON().collect())
    c = Synth(spark, Scale(1, divisor=300), seed=3).table("orders")
    assert sorted(a.toJSON().collect()) != sorted(c.toJSON().collect())


def test_extra_fields(spark):
    table = Synth(spark, Scale(1, divisor=300), extra_fields=3).table("item")
    assert set(table.columns) == set(document_schema("item", extra_fields=3).fieldNames())
    assert table.where("not i_extra_003 rlike '^[0-9a-f]{32}$'").count() == 0


def test_last_name_and_nurand(spark):
    names = spark.range(1000).select("id", last_name(F.col("id")).alias("n")).where("id in (0, 371, 999)").orderBy("id")
    assert [r.n for r in names.collect()] == ["BARBARBAR", "PRICALLYOUGHT", "EINGEINGEING"]
    drawn = spark.range(20000).select(nurand(F.col("id") % 1024, 1 + F.col("id") % 3000, 259, 1, 3000).alias("x"))
    assert one(drawn, "min(x) >= 1", "max(x) <= 3000")[:] == (True, True)


def test_request_mix_shares(spark):
    scale = Scale(3, first_warehouse=5, divisor=100)
    mix = request_mix(spark, 20000, scale, seed=1).cache()
    counts = {r.txn: r["count"] for r in mix.groupBy("txn").count().collect()}
    for name, share in SHARES:
        assert counts[name] == pytest.approx(200 * share, rel=0.15)
    paid = mix.where("txn = 'payment'")
    r = one(paid, "avg(int(c_last is not null))", "avg(int(c_w_id <> w_id))", "min(w_id)", "max(c_w_id)", "min((c_id is null) = (c_last is not null))")
    assert r[0] == pytest.approx(0.6, abs=0.03) and r[1] == pytest.approx(0.15, abs=0.03)
    assert r[2:] == (5, 7, True)
    lines = mix.where("txn = 'new_order'").select("w_id", F.inline("lines").alias("i_id", "s_w_id", "qty"))
    assert one(lines, "avg(int(s_w_id <> w_id))")[0] == pytest.approx(0.01, abs=0.005)
