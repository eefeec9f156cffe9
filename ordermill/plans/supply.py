"""Queries around stock and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.expr import cents_total, from_cents, months_after, plus_days, shaped, supplier_key, ts, within
from ordermill.plans.layouts import ORDER_KEY, Nested, in_stock, nations_of, suppliers_of

c = F.col


def named_nation(t: Nested, name: str) -> DataFrame:
    return t.table("nation").where(c("n_name") == name).select("n_nationkey", "n_name")


def q02(t: Nested, region: str = "Europ%", suffix: str = "b", k: int = 100) -> DataFrame:
    """Suppliers of a region holding the region's smallest stock of an item.

    The smallest stock only matters for the items asked for, so they restrict the stock rows
    before the minimum is taken.
    """
    items = t.table("item").where(c("i_data").endswith(suffix)).select("i_id", "i_name")
    regional = suppliers_of(t, nations_of(t, region)).select("su_suppkey", "n_name")
    stock = (
        t.stock().select("s_i_id", "s_quantity", "s_suppkey")
        .join(items.select("i_id"), c("s_i_id") == c("i_id"), "left_semi")
        .join(regional, c("s_suppkey") == c("su_suppkey"))
    )
    least = stock.groupBy(c("s_i_id").alias("m_i_id")).agg(F.min("s_quantity").alias("m_quantity"))
    details = t.table("supplier").select("su_suppkey", "su_name", "su_address", "su_phone", "su_comment")
    rows = (
        stock.join(least, (c("s_i_id") == c("m_i_id")) & (c("s_quantity") == c("m_quantity")))
        .join(items, c("s_i_id") == c("i_id"))
        .join(details, "su_suppkey")
    )
    top = rows.orderBy("n_name", "su_name", "i_id", "su_suppkey").limit(k)
    return top.select("su_suppkey", "su_name", "n_name", "i_id", "i_name", "su_address", "su_phone", "su_comment")


def q11(t: Nested, nation: str = "Germany", fraction: float = 0.00005) -> DataFrame:
    """Items whose order count is more than a fraction of all, in the stock of one nation."""
    suppliers = suppliers_of(t, named_nation(t, nation)).select("su_suppkey")
    counts = (
        t.stock().select("s_i_id", "s_order_cnt", "s_suppkey")
        .join(suppliers, c("s_suppkey") == c("su_suppkey"), "left_semi")
        .groupBy("s_i_id").agg(F.sum("s_order_cnt").alias("ordercount"))
    )
    whole = counts.agg(F.sum("ordercount").cast("double") * fraction).scalar()
    important = counts.where(c("ordercount").cast("double") > whole)
    return shaped(important, "s_i_id bigint, ordercount bigint").orderBy(c("ordercount").desc(), "s_i_id")


def q15(t: Nested, start: str = "2018-01-01 00:00:00", months: int = 3) -> DataFrame:
    """The supplier, or suppliers, with the highest revenue of a period.

    Revenue is summed in whole cents, so the comparison with its own maximum is exact however often
    the sum is computed.
    """
    lines = t.lines(None, ("ol_i_id", "ol_supply_w_id", "ol_delivery_d", "ol_amount"), (ts(start), months_after(start, months))).where(
        within(c("ol_delivery_d"), ts(start), months_after(start, months))
    )
    per_stock = lines.groupBy("ol_supply_w_id", "ol_i_id").agg(cents_total(c("ol_amount")).alias("amount"))
    supplier_no = supplier_key(c("ol_supply_w_id"), c("ol_i_id"), t.suppliers).alias("supplier_no")
    revenue = in_stock(per_stock, t, "ol_supply_w_id", "ol_i_id").groupBy(supplier_no).agg(
        F.sum("amount").alias("total_revenue")
    )
    best = revenue.where(c("total_revenue") == revenue.agg(F.max("total_revenue")).scalar())
    rows = t.table("supplier").join(best, c("su_suppkey") == c("supplier_no"))
    return rows.select(
        "su_suppkey", "su_name", "su_address", "su_phone", from_cents(c("total_revenue")).alias("total_revenue")
    ).orderBy("su_suppkey")


def q16(t: Nested, not_prefix: str = "zz", comment: str = "%Customer%Complaints%") -> DataFrame:
    """Number of suppliers per item name, brand and price, without the complained-about ones."""
    complained = t.table("supplier").where(c("su_comment").like(comment)).select("su_suppkey")
    items = t.table("item").where(~c("i_data").startswith(not_prefix)).select(
        "i_id", "i_name", F.substring("i_data", 1, 3).alias("brand"), "i_price"
    )
    stock = t.stock().select("s_i_id", "s_suppkey").join(
        complained, c("s_suppkey") == c("su_suppkey"), "left_anti"
    )
    counts = stock.join(items, c("s_i_id") == c("i_id")).groupBy("i_name", "brand", "i_price").agg(
        F.countDistinct("s_suppkey").alias("supplier_cnt")
    )
    return shaped(counts, "i_name string, brand string, i_price double, supplier_cnt bigint").orderBy(
        c("supplier_cnt").desc(), "i_name", "brand", "i_price"
    )


def q20(t: Nested, prefix: str = "co", nation: str = "Germany", start: str = "2016-01-01 12:00:00", months: int = 12) -> DataFrame:
    """Suppliers of a nation with more of some item in stock than its orders of a year call for.

    Ordered quantity belongs to the item alone (all warehouses), so it is summed per item and
    meets stock as one row per item.
    """
    items = t.table("item").where(c("i_data").startswith(prefix)).select("i_id")
    lines = t.lines(None, ("ol_i_id", "ol_delivery_d", "ol_quantity"), (ts(start), months_after(start, months))).where(
        within(c("ol_delivery_d"), ts(start), months_after(start, months))
    )
    ordered = lines.join(items, c("ol_i_id") == c("i_id"), "left_semi").groupBy("ol_i_id").agg(
        F.sum("ol_quantity").alias("ordered")
    )
    spare = (
        t.stock().select("s_i_id", "s_quantity", "s_suppkey")
        .join(ordered, c("s_i_id") == c("ol_i_id"))
        .where(20 * c("s_quantity") > c("ordered"))
        .select("s_suppkey").distinct()
    )
    suppliers = t.table("supplier").join(named_nation(t, nation), c("su_nationkey") == c("n_nationkey"), "left_semi")
    rows = suppliers.join(spare, c("su_suppkey") == c("s_suppkey"), "left_semi")
    return rows.orderBy("su_name", "su_suppkey").select("su_name", "su_address")


def _late_lines(t: Nested, nation: str, first: str, last: str, days: int) -> DataFrame:
    """Late lines served by suppliers of a nation, with the latest delivery of their order."""
    orders = t.orders().where(c("o_entry_d").between(ts(first), ts(last)))
    lines = t.lines(t.with_latest(orders), ("ol_i_id", "ol_delivery_d")).where(c("ol_delivery_d") > plus_days(c("o_entry_d"), days))
    lines = lines.withColumn("supplier_no", supplier_key(c("o_w_id"), c("ol_i_id"), t.suppliers))
    suppliers = suppliers_of(t, named_nation(t, nation)).select("su_suppkey")
    return lines.join(suppliers, c("supplier_no") == c("su_suppkey"), "left_semi")


def _waiting(t: Nested, counted: DataFrame, k: int) -> DataFrame:
    names = t.table("supplier").select("su_suppkey", "su_name")
    waits = (
        counted.join(names, c("supplier_no") == c("su_suppkey"))
        .groupBy("su_name").agg(F.sum("n").alias("numwait"))
        .orderBy(c("numwait").desc(), "su_name").limit(k)
    )
    return shaped(waits, "su_name string, numwait bigint")


def q21(t: Nested, nation: str = "Peru", first: str = "2017-12-01 00:00:00", last: str = "2017-12-31 00:00:00",
        days: int = 150, k: int = 100) -> DataFrame:
    """Suppliers that kept whole orders waiting, counting (order, stock row) once.

    A stock row counts when no line of the order came later than any of its late lines, that is
    when even the earliest of them is the latest of the order. No self-join is needed.
    """
    late = _late_lines(t, nation, first, last, days)
    groups = late.groupBy(*ORDER_KEY, "ol_i_id", "supplier_no", "o_latest").agg(F.min("ol_delivery_d").alias("earliest"))
    last_ones = groups.where(c("earliest") == c("o_latest"))
    per_stock = last_ones.groupBy("o_w_id", "ol_i_id", "supplier_no").agg(F.count("*").alias("n"))
    return _waiting(t, in_stock(per_stock, t, "o_w_id", "ol_i_id"), k)


def q21_lines(t: Nested, nation: str = "Peru", first: str = "2017-12-01 00:00:00", last: str = "2017-12-31 00:00:00",
              days: int = 150, k: int = 100) -> DataFrame:
    """As ``q21``, counting every late line that no other line of its order follows."""
    last_ones = _late_lines(t, nation, first, last, days).where(c("ol_delivery_d") == c("o_latest"))
    per_stock = last_ones.groupBy("o_w_id", "ol_i_id", "supplier_no").agg(F.count("*").alias("n"))
    return _waiting(t, in_stock(per_stock, t, "o_w_id", "ol_i_id"), k)
