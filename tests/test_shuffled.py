"""How many rows the exchanges of a plan write when nothing may be broadcast."""

import pytest
from pyspark.sql import functions as F

from ordermill.operators import ordering
from ordermill.operators.reshape import PART, in_parts, nest
from ordermill.plans.transactions import new_order_changes
from ordermill.sources.bridge import Bridge


@pytest.fixture
def unbroadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows_shuffled(frame):
    """Rows the exchanges of a plan have written, after it has run; those of scalar subqueries do not count."""
    frame.collect()
    todo, found = [frame._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        elif node.nodeName() == "Exchange":
            found += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_children_of_whole_documents_are_dealt_where_they_are(unbroadcast):
    """Only the document of several parts has its children shuffled; children without a key go with part 0."""
    spark = unbroadcast
    parent = spark.range(200).selectExpr("id as o_id", "if(id = 5, 40L, 10L) as n")
    child = spark.range(2000).selectExpr("id % 200 as o_id", "id as x").unionByName(
        spark.range(30).selectExpr("5L as o_id", "id + 2000 as x")).unionByName(spark.range(3).selectExpr("cast(null as bigint) as o_id", "id + 9000 as x"))
    parents, dealt = in_parts(parent, child, ["o_id"], "n", F.xxhash64("x"), 10)
    assert parents.count() == 203 and dealt.count() == 2033 and dealt.columns == ["o_id", "x", PART]
    parts = {r.o_id: r.n for r in dealt.groupBy("o_id").agg(F.countDistinct(PART).alias("n")).collect()}
    assert parts[5] == 4 and parts[None] == 1 and {n for k, n in parts.items() if k != 5} == {1}
    assert rows_shuffled(dealt) <= 100


def test_lines_of_new_orders_are_shuffled_for_stock_and_running_total_only(unbroadcast):
    """No exchange of lines to find their item or their request; one with an unknown or no item is still not placed."""
    spark = unbroadcast
    n, per, items = 200, 20, 50
    line = "struct(if((id = 7 and k = 3), 999L, if(id = 8 and k = 4, null, (id * 7 + k) % 50)) as i_id, 1L as w_id, 1 + (id + k) % 9 as qty)"
    requests = spark.range(n).selectExpr("id as seq", "1L as w_id", "1L as d_id", "id % 5 as c_id", "timestamp_ntz'2020-01-01' as o_entry_d",
                                         f"transform(sequence(0, {per - 1}), k -> {line}) as lines")
    tables = {
        "item": spark.range(items).selectExpr("id as i_id", "'i' as i_name", "2.5d as i_price", "'ORIGINAL' as i_data"),
        "stock": spark.range(items).selectExpr("id as s_i_id", "1L as s_w_id", "50L as s_quantity", "0L as s_ytd", "0L as s_order_cnt", "0L as s_remote_cnt", "'ORIGINAL' as s_data",
                                               "transform(sequence(1, 10), x -> concat('D', x)) as s_dists"),
        "customer": spark.range(5).selectExpr("id as c_id", "1L as c_d_id", "1L as c_w_id", "0.1d as c_discount", "named_struct('c_last', 'x') as c_name", "'GC' as c_credit"),
        "district": spark.range(1).selectExpr("1L as d_id", "1L as d_w_id", "0.1d as d_tax", "1L as d_next_o_id"),
        "warehouse": spark.range(1).selectExpr("1L as w_id", "0.1d as w_tax"),
    }
    tables = {name: rows.localCheckpoint() for name, rows in tables.items()}
    kept = {}

    def keep(rows, label):
        kept[label] = rows
        return rows.localCheckpoint()

    changes, result = new_order_changes(tables, requests.localCheckpoint(), keep)
    assert result.count() == n - 2 and not {7, 8} & {r.seq for r in result.select("seq").collect()}
    assert changes["orders"].select(F.sum(F.size("o_orderline")), F.max("o_orderline.ol_dist_info")).first()[:] == ((n - 2) * per, ["D1"] * per)
    assert rows_shuffled(kept["lines"]) <= 3.5 * n * per
    assert rows_shuffled(kept["placed"]) <= 0.6 * n * per


@pytest.mark.parametrize("hot", [False, True])
def test_lines_of_new_orders_are_shuffled_once(unbroadcast, monkeypatch, hot):
    """Once to their stock row and not again for requests or the running total, which is that of a plain window; lines of
    stock rows with very many lines go on to slices. Lines of a request whose customer is unknown or that is not numbered take nothing."""
    spark = unbroadcast
    n, per, items = 300, 20, 60
    line = f"struct(if({str(hot).lower()} and k < 4, 7L, (id * 7 + k) % {items}) as i_id, 1L as w_id, 1 + (id + k) % 9 as qty)"
    requests = spark.range(n).selectExpr("if(id = 11, null, id) as seq", "1L as w_id", "1L as d_id", "if(id = 9, 77, id % 5) as c_id", "timestamp_ntz'2020-01-01' as o_entry_d",
                                         f"transform(sequence(0, {per - 1}), k -> {line}) as lines").localCheckpoint()
    tables = {
        "item": spark.range(items).selectExpr("id as i_id", "'i' as i_name", "2.5d as i_price", "'ORIGINAL' as i_data"),
        "stock": spark.range(items).selectExpr("id as s_i_id", "1L as s_w_id", "50L as s_quantity", "0L as s_ytd", "0L as s_order_cnt", "0L as s_remote_cnt", "'ORIGINAL' as s_data",
                                               "transform(sequence(1, 10), x -> concat('D', x)) as s_dists"),
        "customer": spark.range(5).selectExpr("id as c_id", "1L as c_d_id", "1L as c_w_id", "0.1d as c_discount", "named_struct('c_last', 'x') as c_name", "'GC' as c_credit"),
        "district": spark.range(1).selectExpr("1L as d_id", "1L as d_w_id", "0.1d as d_tax", "1L as d_next_o_id"),
        "warehouse": spark.range(1).selectExpr("1L as w_id", "0.1d as w_tax"),
    }
    tables = {name: rows.localCheckpoint() for name, rows in tables.items()}
    if hot:
        monkeypatch.setattr(ordering.crowded, "__defaults__", (300, ordering.BUCKETS))
    kept = {}

    def keep(rows, label):
        kept[label] = rows
        return rows.localCheckpoint()

    new_order_changes(tables, requests, keep)
    done = kept["lines"].select("seq", "s_i_id", "ol_number", "left_in_stock").collect()
    left = {}
    for r in sorted((r for r in requests.collect() if r.seq is not None and r.seq != 9), key=lambda r: r.seq):
        for k, x in enumerate(r.lines, 1):
            s = left[x.i_id] = (lambda s, q: s - q if s >= q + 10 else s - q + 91)(left.get(x.i_id, 50), x.qty)
            left[r.seq, k] = (r.seq, x.i_id, k, s)
    assert sorted(tuple(r) for r in done) == sorted(v for v in left.values() if isinstance(v, tuple))
    again = 2 * 4 * n if hot else 0  # lines of item 7: to their stock row twice, to their slices
    assert rows_shuffled(kept["lines"]) <= 1.2 * n * per + 2 * again


def test_requests_in_one_part_are_not_shuffled_for_their_sizes(unbroadcast):
    """A district's count needs requests at their customer and in their slice only; those in several parts, or with a number that comes twice, meet their sizes."""
    spark = unbroadcast
    n = 400
    line = "named_struct('i_id', 1L, 'w_id', 1L, 'qty', 2L, 'n', k)"
    requests = spark.range(n).selectExpr("id as seq", "1L as w_id", "1L as d_id", "id % 5 as c_id", "timestamp_ntz'2020-01-01' as o_entry_d",
                                         f"transform(sequence(0L, 2L), k -> {line}) as lines", "0L as o_part", "1L as o_parts")
    several = requests.where("seq = 3").select("seq", "w_id", "d_id", "c_id", "o_entry_d", "lines", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(1).cast("bigint"))).alias("o_part"), F.lit(2).cast("bigint").alias("o_parts"))
    requests = requests.where("seq <> 3").unionByName(several).localCheckpoint()
    tables = {
        "item": spark.range(2).selectExpr("id as i_id", "'i' as i_name", "2.5d as i_price", "'x' as i_data"),
        "stock": spark.range(2).selectExpr("id as s_i_id", "1L as s_w_id", "50L as s_quantity", "0L as s_ytd", "0L as s_order_cnt", "0L as s_remote_cnt", "'x' as s_data", "array('D') as s_dists"),
        "customer": spark.range(5).selectExpr("id as c_id", "1L as c_d_id", "1L as c_w_id", "0.1d as c_discount", "named_struct('c_last', 'x') as c_name", "'GC' as c_credit"),
        "district": spark.range(1).selectExpr("1L as d_id", "1L as d_w_id", "0.1d as d_tax", "1L as d_next_o_id"),
        "warehouse": spark.range(1).selectExpr("1L as w_id", "0.1d as w_tax"),
    }
    tables = {name: rows.localCheckpoint() for name, rows in tables.items()}
    kept = {}

    def keep(rows, label):
        kept[label] = rows
        return rows.localCheckpoint()

    changes, _ = new_order_changes(tables, requests, keep)
    assert {r.seq: r.n_lines for r in kept["placed"].select("seq", "n_lines").collect()} == {k: 6 if k == 3 else 3 for k in range(n)}
    assert changes["district"].select("d_next_o_id").first()[0] == n + 1
    assert rows_shuffled(kept["placed"]) <= 6.5 * n


def test_lines_travel_as_given_to_the_range_of_their_order(spark, sf_dir):
    """Orders are put in ranges with plain arrays of what is given of their lines, and are the same documents after it."""
    bridge = Bridge(spark, sf_dir)
    header = bridge.table("order_header")
    gathered = bridge.gathered(header)
    assert not any("struct" in kind for _, kind in gathered.dtypes) and dict(gathered.dtypes)["_all__days"] == "array<smallint>"
    plain = nest(header.join(bridge._lines(), "o_id", "left"), header.columns, bridge._line_fields(), "lines", present=F.col("ol_number").isNotNull())
    rows = bridge.nested(gathered.repartitionByRange(7, "o_entry_d")).select(*header.columns, F.col("o_orderline").alias("lines"))
    assert rows.schema["lines"].dataType.simpleString() == plain.schema["lines"].dataType.simpleString()
    assert rows.exceptAll(plain).count() == plain.exceptAll(rows).count() == 0
