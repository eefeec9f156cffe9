"""Batch transactions against a request-by-request model on a small data set."""

import collections

import pytest
from pyspark.sql import functions as F

from ordermill.plans import transactions as txn
from ordermill.synth.requests import request_mix, requests_of
from ordermill.synth.tables import Scale


@pytest.fixture(scope="module")
def mix(spark):
    return request_mix(spark, 1500, Scale(2, divisor=100), seed=5).cache()


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict(recursive=True) for r in df.collect()}


def test_stock_rule_matches_single_steps(spark):
    rows = [(start, step) for start in range(10, 101) for step in range(1, 51)]
    df = spark.createDataFrame(rows, "s bigint, q bigint").select("s", "q", *[
        txn.stock_after(F.col("s"), F.col("q") * n).alias(f"after{n}") for n in range(1, 8)
    ])
    for r in df.collect():
        level = r.s
        for n in range(1, 8):
            level = level - r.q if level >= r.q + 10 else level + 91 - r.q
            assert r[f"after{n}"] == level, r


def test_new_order(spark, documents, mix):
    requests = requests_of(mix, "new_order")
    # one unknown item, one empty request, and the hottest item in every request of a third
    bad = requests.limit(1).withColumn("seq", F.lit(10_001).cast("bigint")).withColumn(
        "lines", F.transform("lines", lambda x: x.withField("i_id", F.lit(10**9).cast("bigint"))))
    empty = requests.limit(1).withColumn("seq", F.lit(10_002).cast("bigint")).withColumn("lines", F.slice("lines", 1, 0))
    hot = requests.withColumn("lines", F.when(F.col("seq") % 3 == 0, F.transform(
        "lines", lambda x: x.withField("i_id", F.lit(7).cast("bigint")))).otherwise(F.col("lines")))
    requests = hot.unionByName(bad).unionByName(empty).cache()
    changed, result = txn.new_order(documents, requests)

    items = by_key(documents["item"], "i_id")
    stock = by_key(documents["stock"], "s_w_id", "s_i_id")
    districts = by_key(documents["district"], "d_w_id", "d_id")
    taxes = by_key(documents["warehouse"], "w_id")
    people = by_key(documents["customer"], "c_w_id", "c_d_id", "c_id")
    expected, placed = {}, {}
    for r in sorted(requests.collect(), key=lambda r: r.seq):
        if not r.lines or any((x.i_id,) not in items for x in r.lines):
            continue
        d = districts[(r.w_id, r.d_id)]
        o_id = d["d_next_o_id"]
        d["d_next_o_id"] += 1
        total, left, lines = 0.0, [], []
        for n, x in enumerate(r.lines, 1):
            s = stock[(x.w_id, x.i_id)]
            q = s["s_quantity"]
            s["s_quantity"] = q - x.qty if q >= x.qty + 10 else q + 91 - x.qty
            s["s_ytd"] += x.qty
            s["s_order_cnt"] += 1
            s["s_remote_cnt"] += x.w_id != r.w_id
            amount = round(x.qty * items[(x.i_id,)]["i_price"], 2)
            total += amount
            left.append(s["s_quantity"])
            lines.append((n, x.i_id, x.w_id, x.qty, amount, s["s_dists"][r.d_id - 1]))
        c = people[(r.w_id, r.d_id, r.c_id)]
        factor = (1 - c["c_discount"]) * (1 + taxes[(r.w_id,)]["w_tax"] + d["d_tax"])
        expected[r.seq] = (o_id, left, round(total * factor, 4))
        placed[(r.w_id, r.d_id, o_id)] = lines
    got = {r.seq: (r.o_id, [x.left_in_stock for x in r["items"]], round(r.total, 4)) for r in result.collect()}
    assert got.keys() == expected.keys()
    for seq in got:
        assert got[seq][:2] == expected[seq][:2]
        assert got[seq][2] == pytest.approx(expected[seq][2], abs=0.001)
    assert by_key(changed["stock"], "s_w_id", "s_i_id") == stock
    assert by_key(changed["district"], "d_w_id", "d_id") == districts
    new_docs = changed["orders"].where("o_id > 30").collect()
    got_docs = {(r.o_w_id, r.o_d_id, r.o_id): [
        (x.ol_number, x.ol_i_id, x.ol_supply_w_id, x.ol_quantity, x.ol_amount, x.ol_dist_info) for x in r.o_orderline] for r in new_docs}
    assert got_docs == placed
    assert changed["neworder"].count() == documents["neworder"].count() + len(placed)


def test_stock_out_of_range_is_refused(documents, mix):
    requests = requests_of(mix, "new_order").limit(1).withColumn(
        "lines", F.transform("lines", lambda x: x.withField("qty", F.lit(500).cast("bigint"))))
    with pytest.raises(Exception, match="out of range"):
        txn.new_order(documents, requests)[1].collect()


def test_payment(documents, mix):
    requests = requests_of(mix, "payment").withColumn(
        "c_id", F.when(F.col("seq") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("c_id"))).cache()
    changed, result = txn.payment(documents, requests)
    people = by_key(documents["customer"], "c_w_id", "c_d_id", "c_id")
    named = collections.defaultdict(list)
    for (w, d, k), p in people.items():
        named[(w, d, p["c_name"]["c_last"])].append((p["c_name"]["c_first"], k))
    w_ytd = {k[0]: r["w_ytd"] for k, r in by_key(documents["warehouse"], "w_id").items()}
    applied = 0
    for r in sorted(requests.collect(), key=lambda r: r.seq):
        k = r.c_id
        if k is None:
            group = sorted(named.get((r.c_w_id, r.c_d_id, r.c_last), []))
            if not group:
                continue
            k = group[(len(group) - 1) // 2][1]
        p = people[(r.c_w_id, r.c_d_id, k)]
        applied += 1
        p["c_balance"] = round(p["c_balance"] - r.h_amount, 2)
        p["c_ytd_payment"] = round(p["c_ytd_payment"] + r.h_amount, 2)
        p["c_payment_cnt"] += 1
        if p["c_credit"] == "BC":
            note = " ".join(map(str, [k, r.c_d_id, r.c_w_id, r.d_id, r.w_id, r.h_amount]))
            p["c_data"] = (note + "|" + p["c_data"])[:500]
        w_ytd[r.w_id] = round(w_ytd[r.w_id] + r.h_amount, 2)
    assert by_key(changed["customer"], "c_w_id", "c_d_id", "c_id") == people
    assert {r.w_id: r.w_ytd for r in changed["warehouse"].collect()} == w_ytd
    assert changed["district"].agg(F.round(F.sum("d_ytd"), 2)).first()[0] == pytest.approx(sum(w_ytd.values()))
    assert changed["history"].count() == documents["history"].count() + applied == documents["history"].count() + result.where("status = 'booked'").count()
    assert result.count() == requests.count()


def test_delivery(documents, mix):
    requests = requests_of(mix, "delivery").cache()
    changed, result = txn.delivery(documents, requests)
    waiting = collections.defaultdict(list)
    for r in documents["neworder"].collect():
        waiting[(r.no_w_id, r.no_d_id)].append(r.no_o_id)
    orders = by_key(documents["orders"], "o_w_id", "o_d_id", "o_id")
    expected, owed = set(), collections.Counter()
    for r in sorted(requests.collect(), key=lambda r: r.seq):
        for d in range(1, 11):
            queue = sorted(waiting[(r.w_id, d)])
            if not queue:
                continue
            o = orders[(r.w_id, d, queue[0])]
            waiting[(r.w_id, d)].remove(queue[0])
            o["o_carrier_id"] = r.o_carrier_id
            for x in o["o_orderline"]:
                x["ol_delivery_d"] = r.ol_delivery_d
            owed[(r.w_id, d, o["o_c_id"])] += round(100 * sum(x["ol_amount"] for x in o["o_orderline"]))
            expected.add((r.seq, d, queue[0]))
    assert {(r.seq, r.d_id, r.o_id) for r in result.collect()} == expected
    assert by_key(changed["orders"], "o_w_id", "o_d_id", "o_id") == orders
    assert {(r.no_w_id, r.no_d_id, r.no_o_id) for r in changed["neworder"].collect()} == {(*k, o) for k, v in waiting.items() for o in v}
    before = by_key(documents["customer"], "c_w_id", "c_d_id", "c_id")
    for key, p in by_key(changed["customer"], "c_w_id", "c_d_id", "c_id").items():
        assert round(100 * p["c_balance"]) == round(100 * before[key]["c_balance"]) + owed[key]


def test_order_status_and_stock_level(documents, mix):
    _, status = txn.order_status(documents, requests_of(mix, "order_status"))
    orders = by_key(documents["orders"], "o_w_id", "o_d_id", "o_id")
    newest = {}
    for (w, d, o), doc in orders.items():
        newest[(w, d, doc["o_c_id"])] = max(o, newest.get((w, d, doc["o_c_id"]), 0))
    assert {r.seq for r in status.collect()} == {r.seq for r in requests_of(mix, "order_status").collect()}
    nobody = requests_of(mix, "order_status").limit(2).withColumns({"c_id": F.lit(None).cast("bigint"), "c_last": F.lit("NOBODY")})
    assert {(r.status, r.c_last, r.o_id) for r in txn.order_status(documents, nobody)[1].collect()} == {("no customer", "NOBODY", None)}
    rows = status.where("status = 'found'").collect()
    assert rows and all(r.o_id == newest[(r.w_id, r.d_id, r.c_id)] for r in rows)
    requests = requests_of(mix, "stock_level")
    _, levels = txn.stock_level(documents, requests)
    stock = {k: r["s_quantity"] for k, r in by_key(documents["stock"], "s_w_id", "s_i_id").items()}
    next_id = {k: r["d_next_o_id"] for k, r in by_key(documents["district"], "d_w_id", "d_id").items()}
    for r in levels.collect():
        seen = {x["ol_i_id"] for (w, d, o), doc in orders.items() for x in doc["o_orderline"]
                if (w, d) == (r.w_id, r.d_id) and next_id[(w, d)] - 20 <= o < next_id[(w, d)]}
        assert r.low_stock == sum(stock[(r.w_id, i)] < r.threshold for i in seen)


def test_orders_by_district_pairs_match_their_counts(documents):
    pairs = txn.orders_by_district(documents, 3).groupBy("d_w_id").count().collect()
    counts = txn.district_order_counts(documents).where("d_id = 3").collect()
    assert {r.d_w_id: r["count"] for r in pairs} == {r.d_w_id: r.orders for r in counts}
