"""Round trips through the file formats, and checks on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.expr import shaped
from ordermill.operators.reshape import once_each, to_flat
from ordermill.registered import Entries
from ordermill.sources import files
from ordermill.sources.schemas import PRIMARY_KEYS, text_dates
from ordermill.sources.statistics import column_statistics, described
from ordermill.sources.store import loaded_store
from ordermill.sources.workspace import fresh_path
from ordermill.twin_sql import with_views

c = F.col
HEADER = "o_id bigint, o_c_id bigint, o_d_id bigint, o_w_id bigint, o_carrier_id bigint, o_ol_cnt bigint, o_entry_d timestamp_ntz"
HEADER_SQL = with_views("SELECT o_id, o_c_id, o_d_id, o_w_id, CAST(o_carrier_id AS BIGINT) AS o_carrier_id, o_ol_cnt, o_entry_d FROM d_header")
CUSTOMER = "c_id bigint, c_d_id bigint, c_w_id bigint, c_balance double, c_last string, c_state string"
CUSTOMER_SQL = with_views("SELECT c_id, c_d_id, c_w_id, c_balance, c_last, c_state FROM d_customer")


def _json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as filed JSON shards, read back typed."""
    root = fresh_path(spark, "json")
    files.write_json_shards(text_dates("orders", loaded_store(spark, sf_dir).table("orders")), f"{root}/orders", order=PRIMARY_KEYS["orders"])
    docs = files.read_documents(spark, root, "orders")
    lines = docs.select("o_id", "o_w_id", "o_entry_d", F.explode("o_orderline").alias("ol"))
    return shaped(
        lines.select("o_id", "o_w_id", "o_entry_d", "ol.ol_number", "ol.ol_i_id", "ol.ol_delivery_d", "ol.ol_amount"),
        "o_id bigint, o_w_id bigint, o_entry_d timestamp_ntz, ol_number bigint, ol_i_id bigint, ol_delivery_d timestamp_ntz, ol_amount double",
    )


def _json_flat_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "flatjson")
    text_dates("customer", loaded_store(spark, sf_dir).table("customer")).write.json(folder)
    docs = files.read_flat_directory(spark, folder, "customer")
    address = F.get("c_addresses", F.lit(0))
    return shaped(docs.select("*", "c_name.c_last", address["c_state"].alias("c_state")), CUSTOMER)


def _json_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in shards, and that no file is larger than the bound."""
    path = fresh_path(spark, "shards")
    files.write_json_shards(text_dates("orders", loaded_store(spark, sf_dir).table("orders")), path, order=PRIMARY_KEYS["orders"])
    # A document of several parts is told by its part 0; others carry no part number.
    first = F.coalesce(F.get_json_object("value", "$.o_part"), F.lit("0")) == "0"
    sizes = spark.read.text(path).select(c("_metadata.file_path").alias("file"), c("_metadata.file_size").alias("size"), first.alias("first"))
    per_file = sizes.groupBy("file", "size").agg(F.count(F.when(c("first"), 1)).alias("n"))
    return per_file.agg(F.sum("n").alias("documents"), (F.max("size") <= files.SHARD_BYTES).alias("bounded"))


def _csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    header = to_flat("orders", loaded_store(spark, sf_dir).table("orders"))["orders"]
    files.write_csv_quoted(text_dates("orders", header), path)
    read = spark.read.schema(", ".join(f"{n} STRING" for n in header.columns)).csv(path)
    return shaped(read, HEADER)


def _object_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "objectcsv")
    header = to_flat("orders", loaded_store(spark, sf_dir).table("orders"))["orders"]
    files.write_object_csv(text_dates("orders", header), path)
    return shaped(spark.read.option("header", True).csv(path), HEADER)


def _object_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "objectjson")
    files.write_object_json(loaded_store(spark, sf_dir).table("stock"), path)
    read = spark.read.schema("s_i_id BIGINT, s_w_id BIGINT, s_quantity BIGINT, s_order_cnt BIGINT").json(path)
    counted = read.select("*", c("_metadata.file_path").alias("file")).groupBy("file").agg(
        F.count("*").alias("n"), F.sum("s_quantity").alias("q"), F.sum("s_order_cnt").alias("o"))
    return counted.agg(
        F.sum("n").alias("documents"), F.sum("q").alias("quantity"), F.sum("o").alias("orders"), (F.max("n") <= files.ROWS_PER_OBJECT).alias("bounded"))


def _columnar(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "columnar")
    files.write_columnar(loaded_store(spark, sf_dir).table("customer"), path, "customer")
    address = F.get("c_addresses", F.lit(0))
    return shaped(spark.read.parquet(path).select("*", "c_name.c_last", address["c_state"].alias("c_state")), CUSTOMER)


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "ordermill_orders_header"
    header = loaded_store(spark, sf_dir).table("orders_header").drop("o_entry_d")
    files.save_bucketed(header, name, fresh_path(spark, "bucketed"), ["o_w_id", "o_d_id", "o_id"], 8)
    return files.table_stats(spark, name)


_STAT_COLUMNS = {"o_id": "o_id", "o_c_id": "o_c_id", "o_d_id": "o_d_id", "o_w_id": "o_w_id", "o_carrier_id": "o_carrier_id",
                 "o_all_local": "1", "o_ol_cnt": "o_ol_cnt"}


# Columns of all tables that the SQL views hold, as path and view expression; other columns of the documents are texts put together in the bridge.
_ALL_COLUMNS = {
    "region": ("d_region", "r_regionkey r_name"),
    "nation": ("d_nation", "n_nationkey n_name n_regionkey"),
    "supplier": ("d_supplier", "su_suppkey su_name su_nationkey su_phone su_acctbal su_comment"),
    "item": ("d_item", "i_id i_name i_price i_data i_im_id"),
    "customer": ("d_customer", "c_id c_d_id c_w_id c_discount c_credit c_name.c_first c_name.c_last c_balance c_data c_since"),
    "stock": ("d_stock", "s_i_id s_w_id s_quantity s_order_cnt s_remote_cnt s_data"),
    "neworder": ("d_neworder", "no_o_id no_d_id no_w_id"),
    "district": ("d_district", "d_id d_w_id d_ytd d_tax d_next_o_id"),
    "warehouse": ("d_warehouse", "w_id w_ytd w_tax"),
    "history": ("(SELECT c_id AS h_c_id, c_d_id AS h_c_d_id, c_w_id AS h_c_w_id, c_since AS h_date, 10 AS h_amount, 'H' || c_custkey AS h_data FROM d_customer)",
                "h_c_id h_c_d_id h_c_w_id h_date h_amount h_data"),
    "orders": ("d_header", "o_id o_c_id o_d_id o_w_id o_carrier_id o_ol_cnt o_entry_d"),
    "orders ": ("d_ol", " ".join(f"o_orderline[].{n}" for n in "ol_number ol_i_id ol_supply_w_id ol_delivery_d ol_quantity ol_amount".split())),
}


def _all_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the eleven tables; header columns of orders once per order, line fields of all its parts."""
    store = loaded_store(spark, sf_dir)
    found = None
    for name in _COUNTED:
        rows = store.table(name)
        one = column_statistics(name, once_each(rows), rows)
        found = one if found is None else found.unionByName(one)
    shown = [(table.strip(), path) for table, (_, paths) in _ALL_COLUMNS.items() for path in paths.split()]
    known = F.struct("table_name", "column_name").isin([F.struct(F.lit(t).alias("table_name"), F.lit(p).alias("column_name")) for t, p in shown])
    return shaped(described(found).where(known), "table_name string, column_name string, row_count bigint, null_count bigint,"
                  " min_number double, max_number double, min_text string, max_text string")


def _all_stats_sql() -> str:
    rows = []
    for table, (view, paths) in _ALL_COLUMNS.items():
        for path in paths.split():
            name = path.split(".")[-1]
            text = name.endswith(("_name", "_phone", "_comment", "_data", "_credit", "_first", "_last", "_since", "_date", "_entry_d", "_delivery_d"))
            number, words = (("NULL", "NULL"), (f"min({name})", f"max({name})")) if text else ((f"min({name})", f"max({name})"), ("NULL", "NULL"))
            rows.append(f"SELECT '{table.strip()}' AS table_name, '{path}' AS column_name, count(*) AS row_count, count(*) - count({name}) AS null_count, "
                        + ", ".join(f"CAST({x} AS DOUBLE) AS {n}_number" for x, n in zip(number, ("min", "max"))) + ", "
                        + ", ".join(f"CAST({x} AS VARCHAR) AS {n}_text" for x, n in zip(words, ("min", "max"))) + f" FROM {view}")
    return " UNION ALL ".join(rows)


#: Rows of a document table for those of the table it comes from; places are four warehouses of ten districts.
_COUNTED = {"customer": ("customer", "count(*)"), "history": ("customer", "count(*)"), "orders": ("orders", "count(*)"), "neworder": ("orders", "count_if(o_orderstatus = 'O')"),
            "item": ("part", "count(*)"), "stock": ("part", "4 * count(*)"), "supplier": ("supplier", "count(*)"), "nation": ("nation", "count(*)"), "region": ("region", "count(*)"),
            "warehouse": ("customer", "least(4, count(*))"), "district": ("customer", "count(DISTINCT struct(c_custkey % 4, floor(c_custkey / 4) % 10))")}


def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all document tables against those that follow from the tables they come from."""
    store = loaded_store(spark, sf_dir)
    expected = None
    for name, (given, rule) in _COUNTED.items():
        row = store.bridge.given(given).agg(F.expr(rule).cast("bigint").alias("expected")).select(F.lit(name).alias("table_name"), "expected")
        expected = row if expected is None else expected.unionByName(row)
    return files.check_row_counts(spark, {n: once_each(store.table(n)) for n in _COUNTED}, expected)


def _key_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers filed in the order of their number, checked line by line."""
    path = fresh_path(spark, "ordered")
    customers = loaded_store(spark, sf_dir).table("customer")
    text_dates("customer", customers).repartitionByRange("c_id").sortWithinPartitions("c_id").write.json(path)
    checked = files.check_key_order(spark, path, "c_id")
    return shaped(checked.agg(
        F.sum("records").alias("records"), F.sum("unkeyed").alias("unkeyed"), F.sum("breaks").alias("breaks")), "records bigint, unkeyed bigint, breaks bigint")


def _key_order_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers filed by warehouse in the order of their last name: how often their numbers go down."""
    path = fresh_path(spark, "unordered")
    customers = loaded_store(spark, sf_dir).table("customer")
    filed = text_dates("customer", customers).withColumn("part", c("c_w_id")).repartition("part").sortWithinPartitions("part", "c_name.c_last", "c_id")
    filed.write.partitionBy("part").json(path)
    checked = files.check_key_order(spark, path, "c_id").withColumn("w_id", F.regexp_extract("file", "part=([0-9]+)", 1))
    return shaped(checked.select("w_id", "records", "breaks", "line", "key", "previous"), "w_id bigint, records bigint, breaks bigint, line bigint, key bigint, previous bigint")


_BROKEN = """SELECT CAST(c_w_id AS BIGINT) AS w_id, count(*) AS records, count(*) FILTER (c_id < previous) AS breaks, max(broken) AS line,
      max(c_id) FILTER (line = broken) AS key, max(previous) FILTER (line = broken) AS previous
    FROM (SELECT *, min(CASE WHEN c_id < previous THEN line END) OVER (PARTITION BY c_w_id) AS broken
      FROM (SELECT c_w_id, c_id, row_number() OVER w AS line, lag(c_id) OVER w AS previous FROM d_customer WINDOW w AS (PARTITION BY c_w_id ORDER BY c_last, c_id)))
    GROUP BY c_w_id"""


def entries() -> Entries:
    stats = " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, count(*) AS row_count, count(*) - count({e}) AS null_count, CAST(min({e}) AS VARCHAR) AS min_value, CAST(max({e}) AS VARCHAR) AS max_value FROM d_header"
        for n, e in _STAT_COLUMNS.items())
    rule = {n: (t, r.replace("struct(", "(").replace("floor(c_custkey / 4)", "(c_custkey // 4)").replace("count_if(o_orderstatus = 'O')", "count(*) FILTER (o_orderstatus = 'O')")) for n, (t, r) in _COUNTED.items()}
    rows = [f"SELECT '{n}' AS table_name, CAST({r} AS BIGINT) AS expected, CAST({r} AS BIGINT) AS actual, true AS matches FROM {t}" for n, (t, r) in rule.items()]
    return {
        "src_json_documents": (_json_documents, with_views("SELECT o_id, o_w_id, o_entry_d, ol_number, ol_i_id, ol_delivery_d, ol_amount FROM d_ol")),
        "src_json_flat_dir": (_json_flat_directory, CUSTOMER_SQL),
        "sink_json_shards": (_json_shards, "SELECT count(*) AS documents, true AS bounded FROM orders"),
        "sink_csv_quoted": (_csv_quoted, HEADER_SQL),
        "sink_object_store_csv": (_object_csv, HEADER_SQL),
        "sink_object_store_json": (_object_json, with_views(
            "SELECT count(*) AS documents, CAST(sum(s_quantity) AS BIGINT) AS quantity, CAST(sum(s_order_cnt) AS BIGINT) AS orders, true AS bounded FROM d_stock")),
        "sink_columnar": (_columnar, CUSTOMER_SQL),
        "table_stats": (_stats, with_views(stats)),
        "table_stats_all": (_all_stats, with_views(_all_stats_sql())),
        "check_row_counts": (_row_counts, " UNION ALL ".join(rows)),
        "check_key_order_broken": (_key_order_broken, with_views(_BROKEN)),
        "check_key_order": (_key_order, "SELECT count(*) AS records, CAST(0 AS BIGINT) AS unkeyed, CAST(0 AS BIGINT) AS breaks FROM customer"),
    }
