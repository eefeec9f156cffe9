"""Key lookups and time ranges with keys and windows taken from the given tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.draws import last_name, nurand
from ordermill.functions.expr import shaped
from ordermill.operators.reshape import once_each
from ordermill.plans import lookups
from ordermill.plans.layouts import Nested
from ordermill.registered import Entries, Query
from ordermill.sources.schemas import PRIMARY_KEYS
from ordermill.sources.store import LoadedStore, loaded_store
from ordermill.twin_sql import with_views

c = F.col

# table -> (key expressions over the order lines, result columns, SQL view, SQL keys)
# Every order line asks for the rows it touches, so keys repeat and some do not exist.
_LINE_KEYS = {
    "warehouse": (["o_w_id + 1 AS w_id"], "w_id bigint, w_tax double", "d_warehouse", "o_w_id + 1 AS w_id"),
    "district": (
        ["o_w_id AS d_w_id", "o_d_id + 1 AS d_id"], "d_w_id bigint, d_id bigint, d_next_o_id bigint", "d_district",
        "o_w_id AS d_w_id, o_d_id + 1 AS d_id",
    ),
    "customer": (
        ["o_w_id AS c_w_id", "o_d_id AS c_d_id", "o_c_id + 1 AS c_id"],
        "c_w_id bigint, c_d_id bigint, c_id bigint, c_balance double, c_credit string", "d_customer",
        "o_w_id AS c_w_id, o_d_id AS c_d_id, o_c_id + 1 AS c_id",
    ),
    "stock": (
        ["ol_supply_w_id AS s_w_id", "ol_i_id + 1 AS s_i_id"], "s_w_id bigint, s_i_id bigint, s_quantity bigint, s_order_cnt bigint",
        "d_stock", "ol_supply_w_id AS s_w_id, ol_i_id + 1 AS s_i_id",
    ),
    "orders": (
        ["o_w_id", "o_d_id", "o_id + ol_number AS o_id"], "o_w_id bigint, o_d_id bigint, o_id bigint, o_c_id bigint, o_entry_d timestamp_ntz",
        "d_header", "o_w_id, o_d_id, o_id + ol_number AS o_id",
    ),
    "neworder": (
        ["o_w_id AS no_w_id", "o_d_id AS no_d_id", "o_id AS no_o_id"], "no_w_id bigint, no_d_id bigint, no_o_id bigint",
        "d_neworder", "o_w_id AS no_w_id, o_d_id AS no_d_id, o_id AS no_o_id",
    ),
    "item": (["ol_i_id + 1 AS i_id"], "i_id bigint, i_name string, i_price double", "d_item", "ol_i_id + 1 AS i_id"),
    "supplier": (["ol_i_id AS su_suppkey"], "su_suppkey bigint, su_name string, su_phone string", "d_supplier", "ol_i_id AS su_suppkey"),
    "nation": (["90 + ol_quantity AS n_nationkey"], "n_nationkey bigint, n_name string", "d_nation", "90 + ol_quantity AS n_nationkey"),
    "region": (["ol_number AS r_regionkey"], "r_regionkey bigint, r_name string", "d_region", "ol_number AS r_regionkey"),
}


def _keys(store: LoadedStore, table: str) -> DataFrame:
    """Distinct keys with the number of lookups each stands for."""
    keys = Nested(store).lines().selectExpr(*_LINE_KEYS[table][0])
    return keys.groupBy(*PRIMARY_KEYS[table]).agg(F.count("*").alias("lookups"))


def _lookup(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = loaded_store(spark, sf_dir)
        found = lookups.lookup(table, store.table(table), _keys(store, table))
        return shaped(found, _LINE_KEYS[table][1] + ", lookups bigint")

    return run


def _lookup_sql(table: str) -> str:
    _, columns, view, keys = _LINE_KEYS[table]
    pk = PRIMARY_KEYS[table]
    names = [item.split()[0] for item in columns.split(",")]
    return with_views(
        f"SELECT {', '.join('t.' + n for n in names)}, lookups FROM k JOIN {view} t ON "
        + " AND ".join(f"t.{p} = k.{p}" for p in pk),
        {"k": f"SELECT {', '.join(pk)}, count(*) AS lookups FROM (SELECT {keys} FROM d_ol) GROUP BY {', '.join(pk)}"},
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = loaded_store(spark, sf_dir)
    found = lookups.order_lines_by_key(store.table("orders"), _keys(store, "orders"))
    lines = found.select("o_w_id", "o_d_id", "o_id", "o_entry_d", F.explode("o_orderline").alias("ol"))
    return lines.select("o_w_id", "o_d_id", "o_id", "o_entry_d", c("ol.ol_number").alias("ol_number"), c("ol.ol_i_id").alias("ol_i_id"), c("ol.ol_amount").alias("ol_amount"))


def _order_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order number from 1 up to the next one of a district is asked for in its warehouse; numbers of other districts find nothing."""
    store = loaded_store(spark, sf_dir)
    numbered = store.table("district").where("d_w_id = 2 and d_id = 3").agg(F.max("d_next_o_id")).first()[0] or 1
    keys = lookups.key_range(spark, 1, numbered - 1, o_w_id=2, o_d_id=3).withColumnRenamed("k", "o_id")
    found = lookups.order_lines_by_key(store.table("orders"), keys)
    parts = found.select("o_id", "o_entry_d", F.size("o_orderline").cast("bigint").alias("in_part"))
    return parts.groupBy("o_id", "o_entry_d").agg(F.sum("in_part").alias("lines"))


def _newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order with the last number of every district, asked for by its key."""
    store = loaded_store(spark, sf_dir)
    keys = store.table("district").select(c("d_w_id").alias("o_w_id"), c("d_id").alias("o_d_id"), (c("d_next_o_id") - 1).alias("o_id"))
    return shaped(once_each(lookups.lookup_points(store, "orders", keys)), "o_w_id bigint, o_d_id bigint, o_id bigint, o_c_id bigint, o_entry_d timestamp_ntz")


MINUTES = (1, 5, 15, 60)


def _windows(store: LoadedStore) -> DataFrame:
    """For every order date, one window of each width: around midnight, or starting at it, which
    an open bound excludes."""
    days = store.table("orders").select("o_entry_d").distinct()
    rows = days.select("o_entry_d", F.explode(F.array(*[F.lit(m) for m in MINUTES])).alias("minutes"))
    shift = F.when(F.dayofmonth("o_entry_d") % 3 == 0, 0).otherwise(c("minutes") * 30)
    low = F.timestamp_add("SECOND", -shift, c("o_entry_d"))
    return rows.select("minutes", low.alias("low"), F.timestamp_add("MINUTE", c("minutes"), low).alias("high"))


def _range_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = loaded_store(spark, sf_dir)
    counts = lookups.window_counts(once_each(store.table("orders")).select("o_entry_d"), _windows(store), ["minutes", "low", "high"])
    return shaped(counts, "minutes int, low timestamp_ntz, high timestamp_ntz, orders bigint")


def _range_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = loaded_store(spark, sf_dir)
    found = lookups.orders_in_windows(once_each(store.table("orders")).select("o_id", "o_entry_d"), _windows(store))
    return shaped(found, "minutes int, o_id bigint, o_entry_d timestamp_ntz")


_WINDOWS_SQL = {
    "windows": """SELECT CAST(m AS INT) AS minutes, low, low + to_minutes(m) AS high FROM
        (SELECT m, o_entry_d - to_seconds(CASE WHEN day(o_entry_d) % 3 = 0 THEN 0 ELSE m * 30 END) AS low
         FROM (SELECT DISTINCT o_entry_d FROM d_header) CROSS JOIN (VALUES (1), (5), (15), (60)) v(m))"""
}


def _sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the keys of the box that the given customers span, looked up."""
    customers = loaded_store(spark, sf_dir).table("customer")
    names = PRIMARY_KEYS["customer"]
    box = customers.agg(*[f(k).alias(f"{n}_{k}") for k in names for n, f in (("lo", F.min), ("hi", F.max))]).first()
    spans = [(box[f"lo_{k}"], box[f"hi_{k}"]) for k in names]
    n = math.prod(high - low + 1 for low, high in spans) // 3
    keys = lookups.sample_key_space(spark, n, *spans, seed=5, names=names)
    return shaped(lookups.lookup("customer", customers, keys), "c_w_id bigint, c_d_id bigint, c_id bigint, c_balance double")


_SAMPLE_SQL = with_views("""SELECT c_w_id, c_d_id, c_id, c_balance FROM d_customer CROSS JOIN box
    JOIN (SELECT i FROM (SELECT i, row_number() OVER (ORDER BY md5('5:' || i), i) AS r, total // 3 AS n
      FROM (SELECT unnest(range(CAST(total AS BIGINT))) AS i, total FROM box)) WHERE r <= n) s
      ON s.i = ((c_w_id - w0) * d_span + (c_d_id - d0)) * c_span + (c_id - c0)""",
    {"box": """SELECT min(c_w_id) AS w0, min(c_d_id) AS d0, min(c_id) AS c0, max(c_d_id) - min(c_d_id) + 1 AS d_span,
       max(c_id) - min(c_id) + 1 AS c_span,
       (max(c_w_id) - min(c_w_id) + 1) * (max(c_d_id) - min(c_d_id) + 1) * (max(c_id) - min(c_id) + 1) AS total FROM d_customer"""})


def _skewed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-uniform customer numbers from the line keys, and how often each comes up."""
    lines = loaded_store(spark, sf_dir).table("orders_orderline")
    key = nurand(c("ol_i_id") % 1024, 1 + c("o_id") % 3000, 259, 1, 3000)
    return shaped(lines.select(key.alias("c_id")).groupBy("c_id").agg(F.count("*").alias("draws")), "c_id bigint, draws bigint")


def _last_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = once_each(loaded_store(spark, sf_dir).table("orders"))
    names = orders.select(last_name(c("o_id") % 1000).alias("last_name")).groupBy("last_name").agg(F.count("*").alias("n"))
    return shaped(names, "last_name string, n bigint")


def entries() -> Entries:
    found: Entries = {f"lookup_{t}": (_lookup(t), _lookup_sql(t)) for t in _LINE_KEYS}
    found["lookup_orders_by_key"] = (_order_lines, with_views(
        "SELECT l.o_w_id, l.o_d_id, l.o_id, o_entry_d, ol_number, ol_i_id, ol_amount FROM k JOIN d_ol l ON l.o_w_id = k.o_w_id AND l.o_d_id = k.o_d_id AND l.o_id = k.o_id",
        {"k": "SELECT DISTINCT o_w_id, o_d_id, o_id + ol_number AS o_id FROM d_ol"}))
    found["lookup_orders_id_range"] = (_order_range, with_views("SELECT o_id, o_entry_d, o_ol_cnt AS lines FROM d_header WHERE o_w_id = 2 AND o_d_id = 3"))
    found["lookup_newest_orders"] = (_newest, with_views(
        "SELECT o_w_id, o_d_id, o_id, o_c_id, o_entry_d FROM d_header JOIN d_district ON o_w_id = d_w_id AND o_d_id = d_id AND o_id = d_next_o_id - 1"))
    found["range_orders_by_entry"] = (_range_counts, with_views(
        "SELECT minutes, low, high, (SELECT count(*) FROM d_header WHERE o_entry_d > low AND o_entry_d < high) AS orders FROM windows", _WINDOWS_SQL))
    found["range_orders_rows"] = (_range_orders, with_views(
        "SELECT minutes, o_id, o_entry_d FROM windows JOIN d_header ON o_entry_d > low AND o_entry_d < high", _WINDOWS_SQL))
    found["sample_key_space"] = (_sample, _SAMPLE_SQL)
    found["gen_skewed_key"] = (_skewed_keys, with_views(
        "SELECT (((ol_i_id % 1024) | (1 + o_id % 3000)) + 259) % 3000 + 1 AS c_id, count(*) AS draws FROM d_ol GROUP BY 1"))
    syllable = "list_extract(['BAR', 'OUGHT', 'ABLE', 'PRI', 'PRES', 'ESE', 'ANTI', 'CALLY', 'ATION', 'EING'], CAST(1 + {} AS INT))"
    number = "(o_orderkey % 1000)"
    name = " || ".join(syllable.format(x) for x in (f"{number} // 100", f"({number} // 10) % 10", f"{number} % 10"))
    found["gen_last_name"] = (_last_names, f"SELECT {name} AS last_name, count(*) AS n FROM orders GROUP BY 1")
    return found
