"""The transactions on whole tables: requests follow from the given orders and customers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.expr import plus_days, shaped
from ordermill.operators.reshape import folded, once_each
from ordermill.plans import transactions as txn
from ordermill.registered import Entries, Query
from ordermill.sources.store import loaded_store
from ordermill.twin_sql import with_views

c = F.col
LOOKED_AT = 2000  # order numbers are global in the given tables, so a district owns few of them
TABLES = ("district", "warehouse", "orders", "neworder", "customer", "stock", "item", "history")


def document_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    store = loaded_store(spark, sf_dir)
    return {name: store.table(name) for name in names}


# -- requests -----------------------------------------------------------------------------


def level_requests(t: dict[str, DataFrame]) -> DataFrame:
    w, d = c("d_w_id"), c("d_id")
    return t["district"].select(
        (w * 100 + d).alias("seq"), w.alias("w_id"), d, (40 + (w * 7 + d * 3) % 41).alias("threshold")
    )


LEVEL_SQL = "SELECT d_w_id * 100 + d_id AS seq, d_w_id AS w_id, d_id, 40 + (d_w_id * 7 + d_id * 3) % 41 AS threshold, d_next_o_id FROM d_district"


def status_requests(t: dict[str, DataFrame]) -> DataFrame:
    """Every customer asks once: by name where the number is even, else by number."""
    by_name = c("c_id") % 2 == 0
    return t["customer"].select(
        ((c("c_id") * 10 + c("c_w_id")) * 100 + c("c_d_id")).alias("seq"), c("c_w_id").alias("w_id"), c("c_d_id").alias("d_id"),
        F.when(~by_name, c("c_id")).alias("c_id"), F.when(by_name, c("c_name.c_last")).alias("c_last"),
    )


def delivery_requests(t: dict[str, DataFrame]) -> DataFrame:
    """Three deliveries per warehouse."""
    n = c("n")
    return t["warehouse"].select("w_id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n")).select(
        (n * 1000 + c("w_id")).alias("seq"), "w_id", (1 + (n + c("w_id")) % 10).alias("o_carrier_id"),
        plus_days(F.lit("2002-01-01 00:00:00").cast("timestamp_ntz"), n).alias("ol_delivery_d"),
    )


DELIVERY_SQL = {
    "requests": """SELECT n * 1000 + w_id AS seq, w_id, 1 + (n + w_id) % 10 AS o_carrier_id, n,
        CAST('2002-01-01' AS TIMESTAMP) + to_days(CAST(n AS INT)) AS ol_delivery_d
        FROM d_warehouse CROSS JOIN (VALUES (1), (2), (3)) v(n)""",
    "taken": """SELECT seq, w_id, no_d_id AS d_id, no_o_id AS o_id, r.o_carrier_id AS carrier, ol_delivery_d AS delivered
        FROM (SELECT *, row_number() OVER (PARTITION BY no_w_id, no_d_id ORDER BY no_o_id) AS place FROM d_neworder) q
        JOIN requests r ON r.w_id = no_w_id AND r.n = place""",
    "amounts": "SELECT t.*, o_c_id, sum(CAST(ol_amount AS DECIMAL(18,2))) AS amount FROM taken t JOIN d_ol USING (o_id) GROUP BY ALL",
}
# An order without lines is delivered as well, with nothing to pay.
DELIVERY_SQL["amounts"] = """SELECT t.seq, t.w_id, t.d_id, t.o_id, h.o_c_id,
        coalesce((SELECT sum(CAST(ol_amount AS DECIMAL(18,2))) FROM d_ol l WHERE l.o_id = t.o_id), 0) AS amount
        FROM taken t JOIN d_header h ON h.o_id = t.o_id"""


def payment_requests(t: dict[str, DataFrame]) -> DataFrame:
    """One payment per order; three in five by name, one in seven at a remote warehouse."""
    o, w = c("o_id"), c("o_w_id")
    by_name = o % 5 < 3
    return once_each(t["orders"]).select(
        o.alias("seq"), w.alias("w_id"), c("o_d_id").alias("d_id"),
        F.when(o % 7 == 0, 1 + w % 4).otherwise(w).alias("c_w_id"), c("o_d_id").alias("c_d_id"),
        F.when(~by_name, c("o_c_id")).alias("c_id"),
        F.when(by_name, F.concat(F.lit("LAST"), (c("o_c_id") % 7).cast("string"))).alias("c_last"),
        (((o * 37) % 500000 + 100) / F.lit(100.0)).alias("h_amount"), c("o_entry_d").alias("h_date"),
    )


_MIDDLE = """SELECT * FROM (SELECT c_w_id, c_d_id, c_last, c_id,
        row_number() OVER (PARTITION BY c_w_id, c_d_id, c_last ORDER BY c_first, c_id) - 1 AS place,
        (count(*) OVER (PARTITION BY c_w_id, c_d_id, c_last) - 1) // 2 AS middle FROM d_customer) m WHERE place = middle"""
PAYMENT_SQL = {
    "middle": _MIDDLE,
    "requests": """SELECT o_id AS seq, o_w_id AS w_id, o_d_id AS d_id,
        CASE WHEN o_id % 7 = 0 THEN 1 + o_w_id % 4 ELSE o_w_id END AS c_w_id, o_d_id AS c_d_id,
        CASE WHEN o_id % 5 >= 3 THEN o_c_id END AS c_id, CASE WHEN o_id % 5 < 3 THEN 'LAST' || (o_c_id % 7) END AS c_last,
        ((o_id * 37) % 500000 + 100) / CAST(100 AS DOUBLE) AS h_amount, o_entry_d AS h_date FROM d_header""",
    "booked": """SELECT r.seq, r.w_id, r.d_id, k.c_w_id, k.c_d_id, k.c_id, r.h_amount, r.h_date, k.c_credit
        FROM requests r LEFT JOIN middle m ON r.c_id IS NULL AND m.c_w_id = r.c_w_id AND m.c_d_id = r.c_d_id AND m.c_last = r.c_last
        JOIN d_customer k ON k.c_w_id = r.c_w_id AND k.c_d_id = r.c_d_id AND k.c_id = coalesce(r.c_id, m.c_id)""",
}


def order_requests(t: dict[str, DataFrame]) -> DataFrame:
    """Every order is placed once more; one in 97 asks for an item that does not exist."""
    shift = F.when(c("o_id") % 97 == 0, F.lit(1_000_000_000_000)).otherwise(F.lit(0))
    return t["orders"].select(
        c("o_id").alias("seq"), c("o_w_id").alias("w_id"), c("o_d_id").alias("d_id"), c("o_c_id").alias("c_id"), "o_entry_d",
        F.transform("o_orderline", lambda ol: F.struct(
            (ol["ol_i_id"] + shift).alias("i_id"), ol["ol_supply_w_id"].alias("w_id"), ol["ol_quantity"].alias("qty"), ol["ol_number"].alias("n"))).alias("lines"),
        "o_part", "o_parts",
    )


# The level after taking pieces one order after another, as the sum of all pieces taken tells it.
def _level(start: str, taken: str) -> str:
    left = f"({start} - {taken})"
    return f"CASE WHEN {left} >= 10 THEN {left} ELSE 10 + ((({left} - 10) % 91) + 91) % 91 END"


ORDER_SQL = {
    "placed": """SELECT h.o_id AS seq, o_w_id AS w_id, o_d_id AS d_id, c_id, o_entry_d, c_last, c_credit, c_discount, w_tax, d_tax,
        d_next_o_id - 1 + row_number() OVER (PARTITION BY o_w_id, o_d_id ORDER BY h.o_id) AS o_id
        FROM d_header h JOIN d_district ON d_w_id = o_w_id AND d_id = o_d_id JOIN d_warehouse ON w_id = o_w_id
        JOIN d_customer ON c_w_id = o_w_id AND c_d_id = o_d_id AND c_id = o_c_id
        WHERE o_ol_cnt > 0 AND h.o_id % 97 <> 0""",
    "lines": """SELECT p.seq, p.w_id, p.d_id, p.o_id, ol_i_id, ol_supply_w_id, ol_quantity, i_price, i_data, s_quantity, s_data,
        CAST(ol_quantity * CAST(i_price AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS amount,
        CAST(sum(ol_quantity) OVER (PARTITION BY ol_supply_w_id, ol_i_id
          ORDER BY p.seq, ol_number, ol_delivery_d, ol_quantity, l.ol_amount ROWS UNBOUNDED PRECEDING) AS BIGINT) AS taken
        FROM placed p JOIN d_ol l ON l.o_id = p.seq JOIN d_item ON i_id = ol_i_id
        JOIN d_stock ON s_w_id = ol_supply_w_id AND s_i_id = ol_i_id""",
}


def _run(step: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(document_tables(spark, sf_dir))


def _batch(step, requests, show: Callable[[dict[str, DataFrame], DataFrame], DataFrame]) -> Query:
    """One batch of requests; the entries that show its outputs share the intermediate results, written once."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store, t = loaded_store(spark, sf_dir), document_tables(spark, sf_dir)
        return show(*step(t, requests(t), lambda rows, label: store.kept(rows, f"{step.__name__}-{label}")))

    return run


def _status(t: dict[str, DataFrame]) -> DataFrame:
    _, result = txn.order_status(t, status_requests(t))
    amount = F.aggregate("o_orderline.ol_amount", F.lit(0).cast("decimal(28,2)"), lambda s, a: (s + a.cast("decimal(18,2)")).cast("decimal(28,2)"))
    header = ["seq", "w_id", "d_id", "c_id", "c_first", "c_last", "c_balance", "o_id", "o_carrier_id", "o_entry_d"]
    parts = result.withColumns({"in_part": F.size(F.coalesce("o_orderline", F.array())), "of_part": amount})
    return shaped(
        parts.groupBy(*header).agg(F.sum("in_part").alias("lines"), F.sum("of_part").alias("amount")),
        "seq bigint, w_id bigint, d_id bigint, c_id bigint, c_first string, c_last string, c_balance double, o_id bigint,"
        " o_carrier_id bigint, o_entry_d timestamp_ntz, lines bigint, amount double",
    )


def _delivered_orders(changed: dict[str, DataFrame], _: DataFrame) -> DataFrame:
    stamped = F.filter("o_orderline", lambda ol: ol["ol_delivery_d"] >= F.lit("2002-01-01").cast("timestamp_ntz"))
    return shaped(
        folded(changed["orders"], ["o_id", "o_w_id", "o_d_id", "o_carrier_id"], {"stamped": (F.size(stamped), F.sum)}), "o_id bigint, o_w_id bigint, o_d_id bigint, o_carrier_id bigint, stamped bigint"
    )


def _new_order_result(_: dict[str, DataFrame], result: DataFrame) -> DataFrame:
    parts = result.withColumns({
        "in_part": F.size("items"),
        "left_in_part": F.aggregate("items.left_in_stock", F.lit(0).cast("bigint"), lambda s, x: s + x),
        "branded_in_part": F.size(F.filter("items.brand", lambda b: b == "B")),
    })
    return shaped(
        parts.groupBy("seq", "w_id", "d_id", "c_id", "o_id", "c_last", "c_credit", "total").agg(
            F.sum("in_part").alias("lines"), F.sum("left_in_part").alias("left_in_stock"), F.sum("branded_in_part").alias("branded")),
        "seq bigint, w_id bigint, d_id bigint, c_id bigint, o_id bigint, c_last string, c_credit string, total double,"
        " lines bigint, left_in_stock bigint, branded bigint",
    )


def _changed(step, requests, table: str, columns: str) -> Query:
    return _batch(step, requests, lambda changed, _: shaped(once_each(changed[table]), columns))


def entries() -> Entries:
    level = "SELECT count(DISTINCT ol_i_id) FROM d_ol, d_stock WHERE o_w_id = r.w_id AND o_d_id = r.d_id" \
        f" AND o_id < r.d_next_o_id AND o_id >= r.d_next_o_id - {LOOKED_AT} AND s_i_id = ol_i_id AND s_quantity < r.threshold"
    found: Entries = {
        "txn_stock_level": (
            _run(lambda t: txn.stock_level(t, level_requests(t), LOOKED_AT)[1]),
            with_views(f"SELECT seq, w_id, d_id, threshold, ({level} AND s_w_id = r.w_id) AS low_stock FROM requests r", {"requests": LEVEL_SQL}),
        ),
        "aux_stock_count_join": (
            _run(lambda t: txn.stock_count_join(t, level_requests(t), LOOKED_AT)),
            with_views(f"SELECT seq, ({level} AND s_w_id = o_w_id) AS low_stock FROM requests r", {"requests": LEVEL_SQL}),
        ),
        "aux_orders_by_district": (
            _run(txn.district_order_counts),
            with_views("""SELECT d_w_id, d_id, d_next_o_id, count(*) AS orders, CAST(sum(o_ol_cnt) AS BIGINT) AS lines, max(o_entry_d) AS latest
                FROM d_district JOIN d_header ON d_id = o_d_id GROUP BY d_w_id, d_id, d_next_o_id"""),
        ),
        "aux_customers_with_orders": (
            _run(txn.customers_with_orders),
            with_views("SELECT c_d_id, count(DISTINCT c_id) AS customers FROM d_customer JOIN d_header ON c_id = o_c_id GROUP BY c_d_id"),
        ),
        "txn_order_status": (
            _run(_status),
            with_views(
                """SELECT r.seq, r.w_id, r.d_id, k.c_id, k.c_first, k.c_last, k.c_balance, h.o_id, h.o_carrier_id, h.o_entry_d,
                  coalesce(h.o_ol_cnt, 0) AS lines,
                  CAST(CASE WHEN h.o_id IS NULL THEN NULL ELSE coalesce((SELECT sum(CAST(ol_amount AS DECIMAL(18,2))) FROM d_ol l WHERE l.o_id = h.o_id), 0) END AS DOUBLE) AS amount
                FROM requests r LEFT JOIN middle m ON r.c_id IS NULL AND m.c_w_id = r.w_id AND m.c_d_id = r.d_id AND m.c_last = r.c_last
                JOIN d_customer k ON k.c_w_id = r.w_id AND k.c_d_id = r.d_id AND k.c_id = coalesce(r.c_id, m.c_id)
                LEFT JOIN newest n ON n.o_w_id = k.c_w_id AND n.o_d_id = k.c_d_id AND n.o_c_id = k.c_id
                LEFT JOIN d_header h ON h.o_id = n.o_id""",
                {
                    "middle": _MIDDLE,
                    "requests": """SELECT (c_id * 10 + c_w_id) * 100 + c_d_id AS seq, c_w_id AS w_id, c_d_id AS d_id,
                        CASE WHEN c_id % 2 <> 0 THEN c_id END AS c_id, CASE WHEN c_id % 2 = 0 THEN c_last END AS c_last FROM d_customer""",
                    "newest": "SELECT o_w_id, o_d_id, o_c_id, max(o_id) AS o_id FROM d_header GROUP BY 1, 2, 3",
                },
            ),
        ),
        "txn_delivery": (
            _batch(txn.delivery, delivery_requests, lambda _, result: shaped(result, "seq bigint, w_id bigint, d_id bigint, o_id bigint, amount double")),
            with_views("SELECT CAST(seq AS BIGINT) AS seq, w_id, d_id, o_id, CAST(amount AS DOUBLE) AS amount FROM amounts", DELIVERY_SQL),
        ),
        "txn_delivery_orders": (
            _batch(txn.delivery, delivery_requests, _delivered_orders),
            with_views("""SELECT h.o_id, o_w_id, o_d_id, CAST(coalesce(carrier, o_carrier_id) AS BIGINT) AS o_carrier_id,
                CASE WHEN carrier IS NULL THEN 0 ELSE o_ol_cnt END AS stamped FROM d_header h LEFT JOIN taken t ON t.o_id = h.o_id""", DELIVERY_SQL),
        ),
        "txn_delivery_customer": (
            _changed(txn.delivery, delivery_requests, "customer", "c_w_id bigint, c_d_id bigint, c_id bigint, c_balance double"),
            with_views("""SELECT c_w_id, c_d_id, c_id, CAST(CAST(c_balance AS DECIMAL(18,2)) + coalesce(
                (SELECT sum(amount) FROM amounts WHERE w_id = c_w_id AND d_id = c_d_id AND o_c_id = c_id), 0) AS DOUBLE) AS c_balance FROM d_customer""", DELIVERY_SQL),
        ),
        "txn_delivery_neworder": (
            _changed(txn.delivery, delivery_requests, "neworder", "no_o_id bigint, no_d_id bigint, no_w_id bigint"),
            with_views("SELECT no_o_id, no_d_id, no_w_id FROM d_neworder WHERE no_o_id NOT IN (SELECT o_id FROM taken)", DELIVERY_SQL),
        ),
        "txn_payment": (
            _batch(txn.payment, payment_requests, lambda _, result: shaped(result, "seq bigint, w_id bigint, d_id bigint, c_w_id bigint, c_d_id bigint, c_id bigint, h_amount double, status string")),
            with_views("""SELECT r.seq, r.w_id, r.d_id, r.c_w_id, r.c_d_id, coalesce(r.c_id, m.c_id) AS c_id, r.h_amount,
                CASE WHEN k.c_id IS NULL THEN 'no customer' ELSE 'booked' END AS status
                FROM requests r LEFT JOIN middle m ON r.c_id IS NULL AND m.c_w_id = r.c_w_id AND m.c_d_id = r.c_d_id AND m.c_last = r.c_last
                LEFT JOIN d_customer k ON k.c_w_id = r.c_w_id AND k.c_d_id = r.c_d_id AND k.c_id = coalesce(r.c_id, m.c_id)""", PAYMENT_SQL),
        ),
        "txn_payment_customer": (
            _changed(txn.payment, payment_requests, "customer",
                     "c_w_id bigint, c_d_id bigint, c_id bigint, c_balance double, c_ytd_payment double, c_payment_cnt bigint, c_data string"),
            with_views("""SELECT k.c_w_id, k.c_d_id, k.c_id,
                CAST(CAST(c_balance AS DECIMAL(18,2)) - coalesce(paid, 0) AS DOUBLE) AS c_balance,
                CAST(CAST(10 AS DECIMAL(18,2)) + coalesce(paid, 0) AS DOUBLE) AS c_ytd_payment, 1 + coalesce(times, 0) AS c_payment_cnt,
                CASE WHEN k.c_credit = 'BC' AND notes IS NOT NULL THEN substr(notes || c_data, 1, 500) ELSE c_data END AS c_data
                FROM d_customer k LEFT JOIN sums s ON s.c_w_id = k.c_w_id AND s.c_d_id = k.c_d_id AND s.c_id = k.c_id""",
                PAYMENT_SQL | {"sums": """SELECT c_w_id, c_d_id, c_id, sum(CAST(h_amount AS DECIMAL(18,2))) AS paid, count(*) AS times,
                    string_agg(c_id || ' ' || c_d_id || ' ' || c_w_id || ' ' || d_id || ' ' || w_id || ' ' || CAST(h_amount AS VARCHAR) || '|', '' ORDER BY seq DESC) AS notes
                    FROM booked GROUP BY 1, 2, 3"""}),
        ),
        "txn_payment_warehouse": (
            _changed(txn.payment, payment_requests, "warehouse", "w_id bigint, w_ytd double"),
            with_views("""SELECT w_id, CAST(CAST(w_ytd AS DECIMAL(18,2)) + (SELECT sum(CAST(h_amount AS DECIMAL(18,2))) FROM booked b WHERE b.w_id = d_warehouse.w_id) AS DOUBLE) AS w_ytd
                FROM d_warehouse""", PAYMENT_SQL),
        ),
        "txn_payment_district": (
            _changed(txn.payment, payment_requests, "district", "d_w_id bigint, d_id bigint, d_ytd double"),
            with_views("""SELECT d_w_id, d_id, CAST(CAST(d_ytd AS DECIMAL(18,2)) + coalesce((SELECT sum(CAST(h_amount AS DECIMAL(18,2))) FROM booked b
                WHERE b.w_id = d_w_id AND b.d_id = d_district.d_id), 0) AS DOUBLE) AS d_ytd FROM d_district""", PAYMENT_SQL),
        ),
        "txn_payment_history": (
            _changed(txn.payment, payment_requests, "history",
                     "h_c_id bigint, h_c_d_id bigint, h_c_w_id bigint, h_d_id bigint, h_w_id bigint, h_date timestamp_ntz, h_amount double, h_data string"),
            with_views("""SELECT c_id AS h_c_id, c_d_id AS h_c_d_id, c_w_id AS h_c_w_id, c_d_id AS h_d_id, c_w_id AS h_w_id, c_since AS h_date,
                CAST(10 AS DOUBLE) AS h_amount, 'H' || c_custkey AS h_data FROM d_customer
                UNION ALL SELECT c_id, c_d_id, c_w_id, d_id, w_id, h_date, h_amount, 'WH' || w_id || '    ' || 'DI' || d_id FROM booked""", PAYMENT_SQL),
        ),
        "txn_new_order": (
            _batch(txn.new_order, order_requests, _new_order_result),
            with_views(f"""SELECT p.seq, p.w_id, p.d_id, p.c_id, p.o_id, c_last, c_credit,
                CAST(sum(amount) AS DOUBLE) * (CAST(1 AS DOUBLE) - CAST(c_discount AS DOUBLE)) * (CAST(1 AS DOUBLE) + CAST(w_tax AS DOUBLE) + CAST(d_tax AS DOUBLE)) AS total,
                count(*) AS lines, CAST(sum({_level('s_quantity', 'taken')}) AS BIGINT) AS left_in_stock,
                CAST(sum(CASE WHEN i_data LIKE '%ORIGINAL%' AND s_data LIKE '%ORIGINAL%' THEN 1 ELSE 0 END) AS BIGINT) AS branded
                FROM placed p JOIN lines l ON l.seq = p.seq GROUP BY p.seq, p.w_id, p.d_id, p.c_id, p.o_id, c_last, c_credit, c_discount, w_tax, d_tax""", ORDER_SQL),
        ),
        "txn_new_order_stock": (
            _changed(txn.new_order, order_requests, "stock",
                     "s_w_id bigint, s_i_id bigint, s_quantity bigint, s_ytd bigint, s_order_cnt bigint, s_remote_cnt bigint"),
            with_views(f"""SELECT s_w_id, s_i_id, {_level('s_quantity', 'coalesce(pieces, 0)')} AS s_quantity, coalesce(pieces, 0) AS s_ytd,
                s_order_cnt + coalesce(n, 0) AS s_order_cnt, s_remote_cnt + coalesce(remote, 0) AS s_remote_cnt
                FROM d_stock LEFT JOIN used ON ol_supply_w_id = s_w_id AND ol_i_id = s_i_id""",
                ORDER_SQL | {"used": """SELECT ol_supply_w_id, ol_i_id, CAST(sum(ol_quantity) AS BIGINT) AS pieces, count(*) AS n,
                    CAST(sum(CASE WHEN ol_supply_w_id <> w_id THEN 1 ELSE 0 END) AS BIGINT) AS remote FROM lines GROUP BY 1, 2"""}),
        ),
        "txn_new_order_district": (
            _changed(txn.new_order, order_requests, "district", "d_w_id bigint, d_id bigint, d_next_o_id bigint"),
            with_views("""SELECT d_w_id, d_id, d_next_o_id + (SELECT count(*) FROM placed p WHERE p.w_id = d_w_id AND p.d_id = d_district.d_id) AS d_next_o_id
                FROM d_district""", ORDER_SQL),
        ),
        "txn_new_order_orders": (
            _changed(txn.new_order, order_requests, "orders", "o_w_id bigint, o_d_id bigint, o_id bigint, o_c_id bigint, o_carrier_id bigint, o_ol_cnt bigint, o_entry_d timestamp_ntz"),
            with_views("""SELECT o_w_id, o_d_id, o_id, o_c_id, CAST(o_carrier_id AS BIGINT) AS o_carrier_id, o_ol_cnt, o_entry_d FROM d_header
                UNION ALL SELECT p.w_id, p.d_id, p.o_id, p.c_id, 0, h.o_ol_cnt, p.o_entry_d FROM placed p JOIN d_header h ON h.o_id = p.seq""", ORDER_SQL),
        ),
        "txn_new_order_neworder": (
            _changed(txn.new_order, order_requests, "neworder", "no_o_id bigint, no_d_id bigint, no_w_id bigint"),
            with_views("SELECT no_o_id, no_d_id, no_w_id FROM d_neworder UNION ALL SELECT o_id, d_id, w_id FROM placed", ORDER_SQL),
        ),
    }
    return found
