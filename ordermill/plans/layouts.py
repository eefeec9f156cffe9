"""One reading interface over the layouts, so that each query is written once.

A layout answers what the queries ask: orders by date, their lines, the total or the latest
delivery of an order, customers with their shipping address. The nested layout answers per-order
questions inside the document, without a shuffle; orders of several parts are folded inside the parts, and
only these meet in a grouping. The flat layout aggregates the child table by the
order key throughout, so no order is ever gathered in one place.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.expr import cents, cents_total, code_point, supplier_key
from ordermill.operators.reshape import LAST_DELIVERY, PART, PARTS, ZONES, folded, in_zone, once_each, with_parts

ORDER_KEY = ["o_w_id", "o_d_id", "o_id"]
CUSTOMER_KEY = ["c_w_id", "c_d_id", "c_id"]
Period = tuple[Column | None, Column | None]
_OF_PARTS = ("o_orderline", PART, PARTS, *ZONES)
LINE = ("ol_number", "ol_i_id", "ol_supply_w_id", "ol_delivery_d", "ol_quantity", "ol_amount")


def unnest(rows: DataFrame, array: str, fields: tuple[str, ...], keep: list[str]) -> DataFrame:
    """One row per element of an array of structs, with some fields of the element.

    The fields are picked from the array before it is exploded, as the scan then reads only
    these: pruning stops at a generator that more than one field is taken from. Rows without
    elements go after the explode, since testing for them before would zip the fields twice.
    """
    zipped = F.arrays_zip(*[F.col(f"{array}.{f}").alias(f) for f in fields])
    wide = rows.select(*keep, F.explode_outer(zipped).alias("_element")).where(F.col("_element").isNotNull())
    return wide.select(*keep, *[F.col("_element")[f].alias(f) for f in fields])


class Store(Protocol):
    suppliers: int

    def table(self, name: str) -> DataFrame: ...

    def zoned(self, name: str) -> DataFrame: ...


class Nested:
    """Documents as filed: struct name, arrays of addresses, phones and order lines."""

    def __init__(self, store: Store):
        self.store = store
        self.suppliers = store.suppliers

    def table(self, name: str) -> DataFrame:
        return self.store.table(name)

    def stock(self) -> DataFrame:
        """Stock with its supplier, stored as a generated column or else computed."""
        stock = self.store.table("stock")
        if "s_suppkey" in stock.columns:
            return stock
        return stock.withColumn("s_suppkey", supplier_key(F.col("s_w_id"), F.col("s_i_id"), self.suppliers))

    # -- orders ---------------------------------------------------------------------------

    def orders(self) -> DataFrame:
        """Orders by part: a condition on columns of the order holds for all its parts."""
        return with_parts(self.store.zoned("orders"))

    def once_each(self, orders: DataFrame) -> DataFrame:
        """One row per order, for counting."""
        return once_each(orders)

    def lines(self, orders: DataFrame | None = None, fields: tuple[str, ...] = LINE, delivered: Period = (None, None)) -> DataFrame:
        """One row per order line: the asked line fields beside the columns of the order.

        ``delivered`` bounds the deliveries the caller will ask for: orders, and files, whose zones are outside are not read.
        """
        orders = in_zone(self.orders() if orders is None else orders, *delivered)
        return unnest(orders, "o_orderline", fields, [c for c in orders.columns if c not in _OF_PARTS])

    def with_total(self, orders: DataFrame | None = None) -> DataFrame:
        """Orders (all without an argument) that have lines, one row each, with the sum of their amounts in cents as ``o_total``."""
        orders = self.orders() if orders is None else orders
        add = F.aggregate("o_orderline.ol_amount", F.lit(0).cast("bigint"), lambda total, amount: total + cents(amount))
        columns = [c for c in orders.columns if c not in _OF_PARTS]
        return folded(orders.where(F.size("o_orderline.ol_amount") > 0), columns, {"o_total": (add, F.sum)})

    def with_latest(self, orders: DataFrame) -> DataFrame:
        """Orders by part that have a delivered line in any part, with the latest delivery of the order as ``o_latest``."""
        known = LAST_DELIVERY in orders.columns
        inside = orders.withColumn("o_latest", F.col(LAST_DELIVERY) if known else F.array_max("o_orderline.ol_delivery_d"))
        whole = inside.where((F.col(PARTS) == 1) & F.col("o_latest").isNotNull())
        several = inside.where(F.col(PARTS) > 1)
        latest = several.where(F.col("o_latest").isNotNull()).groupBy(*ORDER_KEY).agg(F.max("o_latest").alias("o_latest"))
        return whole.unionByName(several.drop("o_latest").join(latest, ORDER_KEY))

    # -- customers ------------------------------------------------------------------------

    def customer_keys(self) -> DataFrame:
        return self.store.table("customer").select(*CUSTOMER_KEY)

    def customer_names(self) -> DataFrame:
        return self.store.table("customer").select(*CUSTOMER_KEY, F.col("c_name.c_last").alias("c_last"))

    def customers(self, fields: tuple[str, ...] = ("c_state",)) -> DataFrame:
        """Keys of the customers unnested with the asked fields of their shipping address."""
        rows = unnest(self.store.table("customer"), "c_addresses", ("c_address_kind", *fields), CUSTOMER_KEY)
        return rows.where(F.col("c_address_kind") == "shipping").drop("c_address_kind")

    def reachable_customers(self) -> DataFrame:
        """Customers with balance, last name, shipping city and state, and contact phone."""
        rows = self.store.table("customer").withColumn("c_last", F.col("c_name.c_last"))
        plain = [*CUSTOMER_KEY, "c_balance", "c_last"]
        rows = unnest(rows, "c_addresses", ("c_address_kind", "c_city", "c_state"), [*plain, "c_phones"])
        rows = rows.where(F.col("c_address_kind") == "shipping").drop("c_address_kind")
        rows = unnest(rows, "c_phones", ("c_phone_kind", "c_phone_number"), [*plain, "c_city", "c_state"])
        return rows.where(F.col("c_phone_kind") == "contact").drop("c_phone_kind")

    def contact_balances(self) -> DataFrame:
        """Balance and contact phone only, for questions that need no address."""
        rows = unnest(self.store.table("customer"), "c_phones", ("c_phone_kind", "c_phone_number"), ["c_balance"])
        return rows.where(F.col("c_phone_kind") == "contact").drop("c_phone_kind")


class TopLevel(Nested):
    """One address and phone per customer as plain columns; orders stay nested."""

    def customer_names(self) -> DataFrame:
        return self.store.table("toplevel_customer").select(*CUSTOMER_KEY, "c_last")

    def customers(self, fields: tuple[str, ...] = ("c_state",)) -> DataFrame:
        return self.store.table("toplevel_customer").select(*CUSTOMER_KEY, *fields)

    def reachable_customers(self) -> DataFrame:
        return self.store.table("toplevel_customer").select(
            *CUSTOMER_KEY, "c_balance", "c_last", "c_city", "c_state", F.col("c_phone").alias("c_phone_number")
        )

    def contact_balances(self) -> DataFrame:
        return self.store.table("toplevel_customer").select("c_balance", F.col("c_phone").alias("c_phone_number"))


class Flat(Nested):
    """Child tables in place of every array."""

    def orders(self) -> DataFrame:
        return self.store.table("orders_header")

    def once_each(self, orders: DataFrame) -> DataFrame:
        return orders

    def lines(self, orders: DataFrame | None = None, fields: tuple[str, ...] = LINE, delivered: Period = (None, None)) -> DataFrame:
        rows = self.store.table("orders_orderline").select(*ORDER_KEY, *fields)
        return rows if orders is None else orders.join(rows, ORDER_KEY)

    def _lines_of(self, orders: DataFrame | None) -> DataFrame:
        """Lines of the asked orders alone: what a filter on orders leaves out is not aggregated."""
        rows = self.lines()
        return rows if orders is None else rows.join(orders.select(*ORDER_KEY), ORDER_KEY, "left_semi")

    def with_total(self, orders: DataFrame | None = None) -> DataFrame:
        totals = self._lines_of(orders).groupBy(*ORDER_KEY).agg(cents_total(F.col("ol_amount")).alias("o_total"))
        return (self.orders() if orders is None else orders).join(totals, ORDER_KEY)

    def with_latest(self, orders: DataFrame) -> DataFrame:
        delivered = self._lines_of(orders).where(F.col("ol_delivery_d").isNotNull())
        latest = delivered.groupBy(*ORDER_KEY).agg(F.max("ol_delivery_d").alias("o_latest"))
        return orders.join(latest, ORDER_KEY)

    def customer_keys(self) -> DataFrame:
        return self.store.table("customer_flat").select(*CUSTOMER_KEY)

    def customer_names(self) -> DataFrame:
        return self.store.table("customer_flat").select(*CUSTOMER_KEY, "c_last")

    def customers(self, fields: tuple[str, ...] = ("c_state",)) -> DataFrame:
        addresses = self.store.table("customer_addresses").where(F.col("c_address_kind") == "shipping")
        return self.customer_keys().join(addresses.select(*CUSTOMER_KEY, *fields), CUSTOMER_KEY)

    def _phones(self) -> DataFrame:
        phones = self.store.table("customer_phones").where(F.col("c_phone_kind") == "contact")
        return phones.select(*CUSTOMER_KEY, "c_phone_number")

    def reachable_customers(self) -> DataFrame:
        plain = self.store.table("customer_flat").select(*CUSTOMER_KEY, "c_balance", "c_last")
        return plain.join(self.customers(("c_city", "c_state")), CUSTOMER_KEY).join(self._phones(), CUSTOMER_KEY)

    def contact_balances(self) -> DataFrame:
        balances = self.store.table("customer_flat").select(*CUSTOMER_KEY, "c_balance")
        return balances.join(self._phones(), CUSTOMER_KEY).select("c_balance", "c_phone_number")


LAYOUTS = {"nested": Nested, "toplevel": TopLevel, "flat": Flat}


# -- pieces several queries share ---------------------------------------------------------


def nations_of(t: Nested, region: str) -> DataFrame:
    """Key and name of the nations of the regions whose name matches a LIKE pattern."""
    regions = t.table("region").where(F.col("r_name").like(region))
    return t.table("nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi").select(
        "n_nationkey", "n_name"
    )


def suppliers_of(t: Nested, nations: DataFrame) -> DataFrame:
    """Supplier keys with the nation they belong to."""
    return t.table("supplier").select("su_suppkey", "su_nationkey").join(
        nations, F.col("su_nationkey") == F.col("n_nationkey")
    )


def belongs_to_customer():
    return (
        (F.col("o_w_id") == F.col("c_w_id"))
        & (F.col("o_d_id") == F.col("c_d_id"))
        & (F.col("o_c_id") == F.col("c_id"))
    )


def state_nation():
    return code_point(F.col("c_state")) == F.col("n_nationkey")


def in_stock(rows: DataFrame, t: Nested, w_id: str, i_id: str) -> DataFrame:
    """Rows whose (warehouse, item) has a stock row. The stock key is unique and the supplier
    follows from it by arithmetic, so this is a semi-join; callers pre-aggregate to few rows
    per key before it."""
    stock = t.table("stock").select("s_w_id", "s_i_id")
    return rows.join(stock, (F.col(w_id) == F.col("s_w_id")) & (F.col(i_id) == F.col("s_i_id")), "left_semi")
