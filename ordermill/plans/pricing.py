"""Queries over orders and their lines, with at most the item table beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.expr import (
    cents_total, from_cents, months_after, plus_days, shaped, share, ts, within, year_range,
)
from ordermill.plans.layouts import ORDER_KEY, Nested, belongs_to_customer

c = F.col


def q01(t: Nested, since: str = "2014-07-01 00:00:00") -> DataFrame:
    """Quantity and amount per line number, for lines delivered after a date."""
    lines = t.lines(None, ("ol_number", "ol_delivery_d", "ol_quantity", "ol_amount"), (ts(since), None)).where(c("ol_delivery_d") > ts(since))
    sums = lines.groupBy("ol_number").agg(
        F.sum("ol_quantity").alias("sum_qty"),
        cents_total(c("ol_amount")).alias("cents"),
        F.count("*").alias("count_order"),
    ).withColumn("sum_amount", from_cents(c("cents")))
    averages = sums.withColumns({
        "avg_qty": share(c("sum_qty"), c("count_order")),
        "avg_amount": share(c("sum_amount"), c("count_order")),
    })
    return shaped(
        averages,
        "ol_number bigint, sum_qty bigint, sum_amount double, avg_qty double, avg_amount double, count_order bigint",
    ).orderBy("ol_number")


def q04(t: Nested, start: str = "2015-07-01 00:00:00", months: int = 3, weeks: int = 1) -> DataFrame:
    """Orders of a period with any line delivered at least so many weeks later, by line count.

    Some line is that late exactly when the latest one is.
    """
    orders = t.orders().where(within(c("o_entry_d"), ts(start), months_after(start, months)))
    late = t.once_each(t.with_latest(orders).where(c("o_latest") >= plus_days(c("o_entry_d"), 7 * weeks)))
    counts = late.groupBy("o_ol_cnt").agg(F.count("*").alias("order_count"))
    return shaped(counts, "o_ol_cnt bigint, order_count bigint").orderBy("o_ol_cnt")


def q06(t: Nested, year: int = 2016, min_amount: float = 600.0) -> DataFrame:
    """Revenue of the lines delivered in a year above an amount."""
    lines = t.lines(None, ("ol_delivery_d", "ol_amount"), (ts(f"{year}-01-01 00:00:00"), ts(f"{year + 1}-01-01 00:00:00"))).where(
        year_range(c("ol_delivery_d"), year) & (c("ol_amount") > min_amount)
    )
    return shaped(lines.agg(from_cents(cents_total(c("ol_amount"))).alias("revenue")), "revenue double")


def q12(t: Nested, year: int = 2016, carriers: tuple[int, int] = (1, 2)) -> DataFrame:
    """Lines on two chosen carriers against all others, by line count of the order.

    The order date bound follows from the delivery bound and is added so that orders can be
    pruned before their lines are read.
    """
    upper = ts(f"{year + 1}-01-01 00:00:00")
    orders = t.orders().where(c("o_entry_d") < upper)
    lines = t.lines(orders, ("ol_delivery_d",), (ts(f"{year}-01-01 00:00:00"), upper)).where(
        year_range(c("ol_delivery_d"), year) & (c("o_entry_d") <= c("ol_delivery_d"))
    )
    high = c("o_carrier_id").isin(*carriers)
    counts = lines.groupBy("o_ol_cnt").agg(
        F.sum(F.when(high, 1).otherwise(0)).alias("high_line_count"),
        F.sum(F.when(~high, 1).otherwise(0)).alias("low_line_count"),
    )
    return shaped(counts, "o_ol_cnt bigint, high_line_count bigint, low_line_count bigint").orderBy("o_ol_cnt")


def q13(t: Nested, carrier_above: int = 8) -> DataFrame:
    """How many customer numbers have how many orders on high carriers; none counts as zero.

    Orders are counted per customer before the outer join, so a customer with very many orders
    meets the join as one row.
    """
    customers = t.customer_keys()
    counted = t.once_each(t.orders()).where(c("o_carrier_id") > carrier_above).groupBy("o_w_id", "o_d_id", "o_c_id").agg(
        F.count("*").alias("orders")
    )
    per_number = customers.join(counted, belongs_to_customer(), "left").groupBy("c_id").agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("c_count")
    )
    histogram = per_number.groupBy("c_count").agg(F.count("*").alias("custdist"))
    return shaped(histogram, "c_count bigint, custdist bigint").orderBy(c("custdist").desc(), c("c_count").desc())


def q14(t: Nested, start: str = "2017-09-01 00:00:00", months: int = 1, prefix: str = "pr") -> DataFrame:
    """Share of promoted items in a month's revenue, in percent."""
    lines = t.lines(None, ("ol_i_id", "ol_delivery_d", "ol_amount"), (ts(start), months_after(start, months))).where(
        within(c("ol_delivery_d"), ts(start), months_after(start, months))
    )
    per_item = lines.groupBy("ol_i_id").agg(cents_total(c("ol_amount")).alias("amount"))
    priced = per_item.join(t.table("item").select("i_id", "i_data"), c("ol_i_id") == c("i_id"))
    promo = F.sum(F.when(c("i_data").startswith(prefix), c("amount")).otherwise(0))
    result = F.lit(100.0) * from_cents(promo) / (F.lit(1.0) + from_cents(F.sum("amount")))
    return shaped(priced.agg(result.alias("promo_revenue")), "promo_revenue double")


def q17(t: Nested, suffix: str = "b") -> DataFrame:
    """Half the revenue of lines below the average quantity of their item.

    Lines are counted per item and quantity first: quantities are few, so the average of an item
    and the lines below it both come from that small histogram, and lines are read once.
    """
    items = t.table("item").where(c("i_data").endswith(suffix)).select("i_id")
    histogram = (
        t.lines(None, ("ol_i_id", "ol_quantity", "ol_amount")).join(items, c("ol_i_id") == c("i_id"), "left_semi")
        .groupBy("ol_i_id", "ol_quantity")
        .agg(cents_total(c("ol_amount")).alias("amount"), F.count("*").alias("n"))
    )
    item = Window.partitionBy("ol_i_id")
    below = histogram.withColumns({
        "lines": F.sum("n").over(item), "quantity": F.sum(c("n") * c("ol_quantity")).over(item),
    }).where(c("ol_quantity") * c("lines") < c("quantity"))
    return shaped(
        below.agg((from_cents(F.sum("amount")) / 2.0).alias("avg_yearly")), "avg_yearly double"
    )


def q18(t: Nested, total_above: float = 200.0, k: int = 100) -> DataFrame:
    """Orders with the largest totals and their customers."""
    totals = t.with_total().where(c("o_total") > round(total_above * 100))
    rows = totals.join(t.customer_names(), belongs_to_customer()).select(
        "c_last", "c_id", *ORDER_KEY, "o_entry_d", "o_ol_cnt", c("o_total").alias("ol_sum")
    )
    top = rows.orderBy(c("ol_sum").desc(), "o_entry_d", *ORDER_KEY).limit(k).withColumn("ol_sum", from_cents(c("ol_sum")))
    return shaped(top, "c_last string, c_id bigint, o_id bigint, o_entry_d timestamp_ntz, o_ol_cnt bigint, ol_sum double")


Q19_BRANCHES = (
    ("h", 7, 17, 5.0, (37, 29, 70)),
    ("t", 16, 26, 10.0, (78, 17, 6)),
    ("m", 24, 34, 15.0, (91, 95, 15)),
)


def q19(t: Nested, branches=Q19_BRANCHES) -> DataFrame:
    """Revenue under any of several (item suffix, quantity, price, warehouse) conditions.

    What the branches ask of the item alone filters the item side, and what they ask of the
    line alone filters the lines, before the join; the exact disjunction remains on top.
    """
    def on_item(b):
        return c("i_data").endswith(b[0]) & c("i_price").between(1.0, b[3])

    def on_line(b):
        return c("ol_quantity").between(b[1], b[2]) & c("o_w_id").isin(*b[4])

    def any_of(conditions):
        first, *rest = conditions
        for other in rest:
            first = first | other
        return first

    items = t.table("item").where(any_of([on_item(b) for b in branches])).select("i_id", "i_data", "i_price")
    warehouses = sorted({w for b in branches for w in b[4]})
    lines = t.lines(None, ("ol_i_id", "ol_quantity", "ol_amount")).where(c("o_w_id").isin(*warehouses) & any_of([on_line(b) for b in branches]))
    matched = lines.join(items, (c("ol_i_id") == c("i_id")) & any_of([on_item(b) & on_line(b) for b in branches]))
    return shaped(matched.agg(from_cents(cents_total(c("ol_amount"))).alias("revenue")), "revenue double")
