"""Layout changes on the whole document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.expr import shaped
from ordermill.operators.reshape import explode_children, flatten_structs, folded, keep_first, nest_children, to_flat, to_toplevel
from ordermill.registered import Entries, Query
from ordermill.sources.schemas import key_projection
from ordermill.sources.store import loaded_store
from ordermill.twin_sql import with_views

c = F.col
CUSTOMER = "c_id bigint, c_d_id bigint, c_w_id bigint"


def _on(table: str, step) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = loaded_store(spark, sf_dir)
        return step(store.table(table))

    return run


def _nested_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat header and child table back to documents (in parts), shown by what each document holds."""
    store = loaded_store(spark, sf_dir)
    header, keys = store.table("orders_header"), ["o_id", "o_d_id", "o_w_id"]
    docs = nest_children(header, store.table("orders_orderline"), keys, "o_orderline", store.part_lines, "o_ol_cnt")
    pieces = F.aggregate("o_orderline.ol_quantity", F.lit(0).cast("bigint"), lambda s, q: s + q)
    shown = folded(docs, keys, {
        "lines": (F.size("o_orderline"), F.sum), "pieces": (pieces, F.sum),
        "first": (F.get("o_orderline", F.lit(0)), F.min), "last": (F.get("o_orderline", F.size("o_orderline") - 1), F.max),
    })
    return shaped(
        shown.withColumns({"first_item": c("first.ol_i_id"), "last_item": c("last.ol_i_id")}),
        "o_id bigint, o_w_id bigint, o_d_id bigint, lines bigint, first_item bigint, last_item bigint, pieces bigint",
    )


def entries() -> Entries:
    first_kind = "c_custkey"
    kinds = "[{}][1:{}]"
    address_kinds = kinds.format("'home', 'work', 'billing'", f"{first_kind} % 4")
    phone_kinds = kinds.format("'home', 'work', 'mobile'", f"{first_kind} % 3")
    category = "'category_' || lpad(CAST(1 + ({}) % 127 AS VARCHAR), 3, '0')"
    return {
        "reshape_nested_to_toplevel": (
            _on("customer", lambda df: shaped(
                to_toplevel("customer", df), CUSTOMER + ", c_first string, c_last string, c_city string, c_state string, c_phone string, c_balance double")),
            with_views("SELECT c_id, c_d_id, c_w_id, c_first, c_last, c_city, c_state, c_phone_number AS c_phone, c_balance FROM d_customer"),
        ),
        "reshape_nested_to_single": (
            _on("customer", lambda df: shaped(
                keep_first("customer", df).select(
                    "c_id", "c_d_id", "c_w_id", F.size("c_addresses").alias("addresses"), F.size("c_phones").alias("phones"),
                    F.get("c_addresses", F.lit(0))["c_state"].alias("c_state")),
                CUSTOMER + ", addresses int, phones int, c_state string")),
            with_views("SELECT c_id, c_d_id, c_w_id, 1 AS addresses, 1 AS phones, c_state FROM d_customer"),
        ),
        "reshape_explode_orderline": (
            _on("orders", lambda df: shaped(
                explode_children("orders", df)["orders_orderline"],
                "o_id bigint, o_d_id bigint, o_w_id bigint, ol_number bigint, ol_i_id bigint, ol_supply_w_id bigint,"
                " ol_delivery_d timestamp_ntz, ol_quantity bigint, ol_amount double")),
            with_views("SELECT o_id, o_d_id, o_w_id, ol_number, ol_i_id, ol_supply_w_id, ol_delivery_d, ol_quantity, ol_amount FROM d_ol"),
        ),
        "reshape_explode_addresses": (
            _on("customer", lambda df: explode_children("customer", df)["customer_addresses"].select(
                "c_id", "c_d_id", "c_w_id", "c_address_kind", "c_city", "c_state")),
            with_views(f"""SELECT c_id, c_d_id, c_w_id, 'shipping' AS c_address_kind, c_city, c_state FROM d_customer
                UNION ALL SELECT c_id, c_d_id, c_w_id, unnest({address_kinds}), c_city, 'zz' FROM d_customer"""),
        ),
        "reshape_explode_phones": (
            _on("customer", lambda df: explode_children("customer", df)["customer_phones"]),
            with_views(f"""SELECT c_id, c_d_id, c_w_id, 'contact' AS c_phone_kind, c_phone_number FROM d_customer
                UNION ALL SELECT c_id, c_d_id, c_w_id, kind, '9-' || kind FROM (SELECT c_id, c_d_id, c_w_id, unnest({phone_kinds}) AS kind FROM d_customer)"""),
        ),
        "reshape_explode_customer_categories": (
            _on("customer", lambda df: explode_children("customer", df)["customer_item_categories"]),
            with_views(f"""SELECT c_id, c_d_id, c_w_id, {category.format('c_custkey + n * 5')} AS c_item_category
                FROM (SELECT *, unnest(range(1, CAST(2 + c_custkey % 3 AS BIGINT))) AS n FROM d_customer)"""),
        ),
        "reshape_explode_item_categories": (
            _on("item", lambda df: explode_children("item", df)["item_categories"]),
            with_views(f"""SELECT i_id, {category.format('i_id + n * 13')} AS i_category FROM (SELECT *, unnest(range(0, CAST(1 + i_id % 2 AS BIGINT))) AS n FROM d_item)"""),
        ),
        "reshape_flatten_structs": (
            _on("stock", lambda df: flatten_structs("stock", df).select("s_i_id", "s_w_id", "s_quantity", "s_dist_01", "s_dist_10")),
            with_views("SELECT s_i_id, s_w_id, s_quantity, 'D1-' || s_i_id || '-' || s_w_id AS s_dist_01, 'D10-' || s_i_id || '-' || s_w_id AS s_dist_10 FROM d_stock"),
        ),
        "reshape_flat_supplier": (
            _on("supplier", lambda df: to_flat("supplier", df)["supplier"].select("su_suppkey", "su_name", "su_city", "su_state", "su_nationkey")),
            with_views("""SELECT su_suppkey, su_name, 'CITY' || (su_suppkey % 50) AS su_city,
                chr(CAST(su_nationkey AS INT)) || chr(CAST(97 + su_suppkey % 26 AS INT)) AS su_state, su_nationkey FROM d_supplier"""),
        ),
        "reshape_nest": (
            _nested_again,
            with_views("""SELECT h.o_id, h.o_w_id, h.o_d_id, count(ol_i_id) AS lines, first(ol_i_id ORDER BY ol_number, ol_i_id, ol_supply_w_id) AS first_item,
                last(ol_i_id ORDER BY ol_number, ol_i_id, ol_supply_w_id) AS last_item, CAST(coalesce(sum(ol_quantity), 0) AS BIGINT) AS pieces
                FROM d_header h LEFT JOIN d_ol l ON l.o_id = h.o_id GROUP BY h.o_id, h.o_w_id, h.o_d_id"""),
        ),
        "key_projection": (
            _on("orders", lambda df: key_projection("orders", df).select("doc_key", "o_c_id")),
            with_views("SELECT o_w_id || '.' || o_d_id || '.' || o_id AS doc_key, o_c_id FROM d_header"),
        ),
    }
