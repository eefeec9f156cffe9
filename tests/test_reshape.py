from pyspark.sql import functions as F

from ordermill.operators.reshape import explode_children, flatten_structs, keep_first, nest_children, to_flat, to_toplevel
from ordermill.sources.schemas import key_projection


def same(a, b):
    return sorted(a.toJSON().collect()) == sorted(b.select(a.columns).toJSON().collect())


def test_explode_then_nest_is_identity(documents):
    flat = to_flat("orders", documents["orders"])
    again = nest_children(flat["orders"], flat["orders_orderline"], ["o_id", "o_d_id", "o_w_id"], "o_orderline")
    assert same(documents["orders"], again)


def test_parent_without_children_gets_an_empty_array(documents):
    flat = to_flat("orders", documents["orders"])
    lines = flat["orders_orderline"].where("o_id <> 4")
    docs = nest_children(flat["orders"], lines, ["o_id", "o_d_id", "o_w_id"], "o_orderline")
    assert docs.where("o_id = 4 and size(o_orderline) = 0").count() == 20


def test_children_carry_the_parent_key(documents):
    children = explode_children("customer", documents["customer"])
    sizes = documents["customer"].agg(*[F.sum(F.size(a)) for a in ("c_addresses", "c_phones", "c_item_categories")]).first()
    assert [children[n].count() for n in ("customer_addresses", "customer_phones", "customer_item_categories")] == list(sizes)
    assert children["customer_item_categories"].columns == ["c_id", "c_d_id", "c_w_id", "c_item_category"]


def test_toplevel_and_single(documents):
    top = to_toplevel("customer", documents["customer"])
    assert {"c_first", "c_last", "c_city", "c_phone"} <= set(top.columns) and not {"c_addresses", "c_phones", "c_item_categories"} & set(top.columns)
    single = keep_first("customer", documents["customer"])
    assert "c_item_categories" not in single.columns and single.where("size(c_addresses) <> 1 or size(c_phones) <> 1").count() == 0
    joined = top.join(single.select("c_w_id", "c_d_id", "c_id", F.expr("c_addresses[0].c_state").alias("s")), ["c_w_id", "c_d_id", "c_id"])
    assert joined.where("s <> c_state").count() == 0


def test_flat_structs(documents):
    assert flatten_structs("warehouse", documents["warehouse"]).columns[-5:] == ["w_street_1", "w_street_2", "w_city", "w_state", "w_zip"]
    assert "s_dist_10" in flatten_structs("stock", documents["stock"]).columns


def test_key_projection(documents):
    keyed = key_projection("stock", documents["stock"])
    assert keyed.where("s_w_id = 2 and s_i_id = 15").first().doc_key == "2.15"
    assert keyed.select("doc_key").distinct().count() == 2000
