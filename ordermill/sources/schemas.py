"""Schemas, keys and fixed values of the order documents.

``DOCUMENTS`` holds the typed schema of the eleven data sets in nested form. JSON files keep
dates as text (``YYYY-MM-DD HH:MM:SS``); ``typed_dates`` turns them into timestamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators.reshape import PART, PARTS, filed_parts, once_each, read_parts

# Data volume per warehouse.
ITEMS = 100_000
SUPPLIERS = 10_000
DISTRICTS_PER_WAREHOUSE = 10
CUSTOMERS_PER_DISTRICT = 3_000
NEW_ORDERS_PER_DISTRICT = 900

# Note length limit, credit codes, marker text.
MAX_CUSTOMER_NOTE = 500
BAD_CREDIT = "BC"
GOOD_CREDIT = "GC"
ORIGINAL = "ORIGINAL"
NO_CARRIER = 0


def _address(prefix: str, kind: str = "") -> str:
    parts = [f"{prefix}_street_1", f"{prefix}_street_2", f"{prefix}_city", f"{prefix}_state", f"{prefix}_zip"]
    if kind:
        parts.insert(0, kind)
    return "STRUCT<" + ", ".join(f"{p}: STRING" for p in parts) + ">"


ORDERLINE = (
    "STRUCT<ol_number: BIGINT, ol_i_id: BIGINT, ol_supply_w_id: BIGINT, ol_delivery_d: {date},"
    " ol_quantity: BIGINT, ol_amount: DOUBLE, ol_dist_info: STRING>"
)

_DDL = {
    "warehouse": f"w_id BIGINT, w_ytd DOUBLE, w_tax DOUBLE, w_name STRING, w_address {_address('w')}",
    "district": "d_id BIGINT, d_w_id BIGINT, d_ytd DOUBLE, d_tax DOUBLE, d_next_o_id BIGINT, d_name STRING,"
    f" d_address {_address('d')}",
    "customer": "c_id BIGINT, c_d_id BIGINT, c_w_id BIGINT, c_discount DOUBLE, c_credit STRING,"
    " c_name STRUCT<c_first: STRING, c_middle: STRING, c_last: STRING>, c_credit_lim DOUBLE,"
    " c_balance DOUBLE, c_ytd_payment DOUBLE, c_payment_cnt BIGINT, c_delivery_cnt BIGINT,"
    f" c_addresses ARRAY<{_address('c', 'c_address_kind')}>,"
    " c_phones ARRAY<STRUCT<c_phone_kind: STRING, c_phone_number: STRING>>,"
    " c_since {date}, c_item_categories ARRAY<STRING>, c_data STRING",
    "history": "h_c_id BIGINT, h_c_d_id BIGINT, h_c_w_id BIGINT, h_d_id BIGINT, h_w_id BIGINT,"
    " h_date {date}, h_amount DOUBLE, h_data STRING",
    "neworder": "no_o_id BIGINT, no_d_id BIGINT, no_w_id BIGINT",
    "orders": "o_id BIGINT, o_c_id BIGINT, o_d_id BIGINT, o_w_id BIGINT, o_carrier_id BIGINT, o_ol_cnt BIGINT,"
    f" o_all_local BIGINT, o_entry_d {{date}}, o_orderline ARRAY<{ORDERLINE}>",
    "stock": "s_i_id BIGINT, s_w_id BIGINT, s_quantity BIGINT, s_ytd BIGINT, s_order_cnt BIGINT,"
    " s_remote_cnt BIGINT, s_data STRING, s_dists ARRAY<STRING>",
    "item": "i_id BIGINT, i_name STRING, i_price DOUBLE, i_categories ARRAY<STRING>, i_data STRING, i_im_id BIGINT",
    "supplier": f"su_suppkey BIGINT, su_name STRING, su_address {_address('su')}, su_nationkey BIGINT,"
    " su_phone STRING, su_acctbal DOUBLE, su_comment STRING",
    "nation": "n_nationkey BIGINT, n_name STRING, n_regionkey BIGINT, n_comment STRING",
    "region": "r_regionkey BIGINT, r_name STRING, r_comment STRING",
}

PRIMARY_KEYS = {
    "warehouse": ["w_id"],
    "district": ["d_w_id", "d_id"],
    "customer": ["c_w_id", "c_d_id", "c_id"],
    "history": ["h_c_w_id", "h_c_d_id", "h_c_id"],
    "neworder": ["no_w_id", "no_d_id", "no_o_id"],
    "orders": ["o_w_id", "o_d_id", "o_id"],
    "stock": ["s_w_id", "s_i_id"],
    "item": ["i_id"],
    "supplier": ["su_suppkey"],
    "nation": ["n_nationkey"],
    "region": ["r_regionkey"],
    # child tables of the fully flat form
    "orders_orderline": ["o_w_id", "o_d_id", "o_id", "ol_number"],
    "customer_addresses": ["c_w_id", "c_d_id", "c_id", "c_address_kind"],
    "customer_phones": ["c_w_id", "c_d_id", "c_id", "c_phone_number"],
    "customer_item_categories": ["c_w_id", "c_d_id", "c_id", "c_item_category"],
    "item_categories": ["i_id", "i_category"],
}

DATE_COLUMNS = {"customer": ["c_since"], "history": ["h_date"], "orders": ["o_entry_d"]}


def document_ddl(table: str, date_type: str = "STRING") -> str:
    """DDL text of one data set; ``date_type`` is STRING as filed or TIMESTAMP_NTZ as queried."""
    return _DDL[table].replace("{date}", date_type)


def document_schema(table: str, date_type: str = "STRING", extra_fields: int = 0, parts: bool = False) -> T.StructType:
    """StructType of one data set, with the numbered filler columns and the part numbers of orders where the files carry them."""
    schema = T.StructType.fromDDL(document_ddl(table, date_type))
    if parts and table == "orders":
        schema = schema.add(PART, T.LongType()).add(PARTS, T.LongType())
    prefix = {"customer": "c", "orders": "o", "item": "i"}.get(table)
    if extra_fields and prefix:
        for n in range(1, extra_fields + 1):
            schema = schema.add(f"{prefix}_extra_{n:03d}", T.StringType())
    return schema


DOCUMENT_TABLES = list(_DDL)


def typed_dates(table: str, df: DataFrame) -> DataFrame:
    """Text dates to TIMESTAMP_NTZ, inside the order lines too, and part numbers of whole documents."""
    for name in DATE_COLUMNS.get(table, []):
        df = df.withColumn(name, F.col(name).cast("timestamp_ntz"))
    if table == "orders" and "o_orderline" in df.columns:
        df = df.withColumn("o_orderline", F.col("o_orderline").cast(f"ARRAY<{ORDERLINE.format(date='TIMESTAMP_NTZ')}>"))
    return read_parts(df)


def text_dates(table: str, df: DataFrame) -> DataFrame:
    """Timestamps back to the filed text form, and no part numbers for whole documents."""

    def text(c):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")

    for name in DATE_COLUMNS.get(table, []):
        df = df.withColumn(name, text(F.col(name)))
    if table == "orders" and "o_orderline" in df.columns:
        df = df.withColumn(
            "o_orderline",
            F.transform("o_orderline", lambda ol: ol.withField("ol_delivery_d", text(ol["ol_delivery_d"]))),
        )
    return filed_parts(df)


def key_projection(table: str, df: DataFrame, name: str = "doc_key") -> DataFrame:
    """Add the document key: primary-key values joined by dots. Documents in parts are named once."""
    return once_each(df).withColumn(name, F.concat_ws(".", *[F.col(c).cast("string") for c in PRIMARY_KEYS[table]]))
