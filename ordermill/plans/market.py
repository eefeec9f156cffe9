"""Queries that bring customers, orders, suppliers and nations together.

The supplier of a line follows from its warehouse and item by arithmetic. Suppliers and items,
which remove most lines, are therefore joined first, where the lines are scanned. What is left is
summed per customer and stock row before customers and then stock are joined: a customer with very
many orders meets the join with no more rows than there are items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.expr import (
    cents, cents_total, code_point, from_cents, initial, months_after, shaped, share, supplier_key, ts, within, year_range,
)
from ordermill.plans.layouts import (
    CUSTOMER_KEY, ORDER_KEY, Nested, belongs_to_customer, in_stock, nations_of, state_nation, suppliers_of,
)

c = F.col


BUYER = ["o_w_id", "o_d_id", "o_c_id"]


def customers_of(t: Nested, nations: DataFrame) -> DataFrame:
    """Customer keys and shipping state with the nation of that state."""
    return t.customers().select(*CUSTOMER_KEY, "c_state").join(nations, state_nation())


def q03(t: Nested, state: str = "a", before: str = "2017-03-15 00:00:00", limit: int | None = None) -> DataFrame:
    """Revenue of orders not delivered yet, for customers of some states.

    Totals are taken first: only keys and totals travel to the joins, not order lines.
    """
    buyers = t.customers().where(c("c_state").startswith(state)).select(*CUSTOMER_KEY)
    waiting = t.table("neworder")
    totals = t.with_total(t.orders().where(c("o_entry_d") < ts(before)))
    orders = (
        totals.select(*ORDER_KEY, "o_c_id", "o_entry_d", "o_total")
        .join(waiting, (c("no_w_id") == c("o_w_id")) & (c("no_d_id") == c("o_d_id")) & (c("no_o_id") == c("o_id")), "left_semi")
        .join(buyers, belongs_to_customer(), "left_semi")
    )
    rows = orders.withColumn("revenue", from_cents(c("o_total"))).orderBy(c("revenue").desc(), "o_entry_d", *ORDER_KEY)
    rows = rows if limit is None else rows.limit(limit)
    return shaped(rows, "o_id bigint, o_w_id bigint, o_d_id bigint, revenue double, o_entry_d timestamp_ntz")


def q05(t: Nested, region: str = "Asia", year: int = 2016) -> DataFrame:
    """Revenue per nation of a region where customer and supplier share the nation."""
    nations = nations_of(t, region)
    sellers = suppliers_of(t, nations).select("su_suppkey", "su_nationkey", "n_name")
    buyers = t.customers().select(*CUSTOMER_KEY, code_point(c("c_state")).alias("c_nationkey"))
    orders = t.orders().where(year_range(c("o_entry_d"), year))
    lines = t.lines(orders, ("ol_i_id", "ol_amount")).withColumn("supplier_no", supplier_key(c("o_w_id"), c("ol_i_id"), t.suppliers))
    sold = lines.join(sellers, c("supplier_no") == c("su_suppkey"))
    per_buyer = sold.groupBy(*BUYER, "ol_i_id", "su_nationkey", "n_name").agg(cents_total(c("ol_amount")).alias("amount"))
    local = per_buyer.join(buyers, belongs_to_customer() & (c("su_nationkey") == c("c_nationkey")))
    per_stock = local.groupBy("o_w_id", "ol_i_id", "n_name").agg(F.sum("amount").alias("amount"))
    result = in_stock(per_stock, t, "o_w_id", "ol_i_id").groupBy("n_name").agg(from_cents(F.sum("amount")).alias("revenue"))
    return shaped(result, "n_name string, revenue double").orderBy(c("revenue").desc(), "n_name")


def q07(t: Nested, nation_a: str = "Germany", nation_b: str = "Cambodia", first: str = "2017-01-01 00:00:00",
        last: str = "2018-12-31 00:00:00") -> DataFrame:
    """Revenue between two nations in both directions, by supplier nation, customer state and year.

    The opposite of each nation is known by name, so the nation pair is an equi-join.
    """
    opposite = F.when(c("n_name") == nation_a, nation_b).otherwise(nation_a)
    pair = t.table("nation").where(c("n_name").isin(nation_a, nation_b)).select("n_nationkey", "n_name")
    sellers = suppliers_of(t, pair).select("su_suppkey", c("su_nationkey").alias("supp_nation"), opposite.alias("to_name"))
    buyers = customers_of(t, pair).select(*CUSTOMER_KEY, initial(c("c_state")).alias("cust_nation"), c("n_name").alias("c_name"))
    lines = t.lines(t.orders(), ("ol_i_id", "ol_supply_w_id", "ol_delivery_d", "ol_amount"), (ts(first), ts(last))).where(
        c("ol_delivery_d").between(ts(first), ts(last))
    ).withColumn("supplier_no", supplier_key(c("ol_supply_w_id"), c("ol_i_id"), t.suppliers))
    sold = lines.join(sellers, c("supplier_no") == c("su_suppkey")).withColumn("l_year", F.year("o_entry_d"))
    stock_row = ["ol_supply_w_id", "ol_i_id"]
    per_buyer = sold.groupBy(*BUYER, *stock_row, "supp_nation", "to_name", "l_year").agg(cents_total(c("ol_amount")).alias("amount"))
    traded = per_buyer.join(buyers, belongs_to_customer() & (c("c_name") == c("to_name")))
    keys = ["supp_nation", "cust_nation", "l_year"]
    per_stock = traded.groupBy(*stock_row, *keys).agg(F.sum("amount").alias("amount"))
    result = in_stock(per_stock, t, *stock_row).groupBy(*keys).agg(from_cents(F.sum("amount")).alias("revenue"))
    return shaped(result, "supp_nation bigint, cust_nation string, l_year int, revenue double").orderBy(*keys)


def q08(t: Nested, region: str = "Europe", nation: str = "Germany", suffix: str = "b", item_below: int = 1000,
        first: str = "2017-01-01 00:00:00", last: str = "2018-12-31 00:00:00") -> DataFrame:
    """Share of one nation's suppliers in what a region bought, by year."""
    buyers = customers_of(t, nations_of(t, region)).select(*CUSTOMER_KEY)
    items = t.table("item").where(c("i_data").endswith(suffix) & (c("i_id") < item_below)).select("i_id")
    sellers = suppliers_of(t, t.table("nation").select("n_nationkey", "n_name")).select("su_suppkey", "n_name")
    orders = t.orders().where(c("o_entry_d").between(ts(first), ts(last)))
    lines = t.lines(orders, ("ol_i_id", "ol_supply_w_id", "ol_amount")).where(c("ol_i_id") < item_below)
    lines = lines.join(items, c("ol_i_id") == c("i_id"), "left_semi").withColumn(
        "supplier_no", supplier_key(c("ol_supply_w_id"), c("ol_i_id"), t.suppliers)
    )
    sold = lines.join(sellers, c("supplier_no") == c("su_suppkey"))
    own = F.when(c("n_name") == nation, cents(c("ol_amount"))).otherwise(0)
    stock_row = ["ol_supply_w_id", "ol_i_id"]
    per_buyer = sold.groupBy(*BUYER, *stock_row, F.year("o_entry_d").alias("l_year")).agg(
        F.sum(own).alias("own"), cents_total(c("ol_amount")).alias("whole")
    )
    per_stock = per_buyer.join(buyers, belongs_to_customer(), "left_semi").groupBy(*stock_row, "l_year").agg(
        F.sum("own").alias("own"), F.sum("whole").alias("whole")
    )
    years = in_stock(per_stock, t, *stock_row).groupBy("l_year").agg(
        F.round(share(from_cents(F.sum("own")), from_cents(F.sum("whole"))), 2).alias("mkt_share")
    )
    return shaped(years, "l_year int, mkt_share double").orderBy("l_year")


def q09(t: Nested, suffix: str = "bb") -> DataFrame:
    """Revenue of some items by supplier nation and year."""
    items = t.table("item").where(c("i_data").endswith(suffix)).select("i_id")
    suppliers = suppliers_of(t, t.table("nation").select("n_nationkey", "n_name")).select("su_suppkey", "n_name")
    lines = t.lines(t.orders(), ("ol_i_id", "ol_supply_w_id", "ol_amount")).join(items, c("ol_i_id") == c("i_id"), "left_semi")
    per_stock = lines.groupBy("ol_supply_w_id", "ol_i_id", F.year("o_entry_d").alias("l_year")).agg(
        cents_total(c("ol_amount")).alias("amount")
    ).withColumn("supplier_no", supplier_key(c("ol_supply_w_id"), c("ol_i_id"), t.suppliers))
    sold = in_stock(per_stock, t, "ol_supply_w_id", "ol_i_id").join(suppliers, c("supplier_no") == c("su_suppkey"))
    result = sold.groupBy("n_name", "l_year").agg(from_cents(F.sum("amount")).alias("sum_profit"))
    return shaped(result, "n_name string, l_year int, sum_profit double").orderBy("n_name", c("l_year").desc())


def q10(t: Nested, start: str = "2015-10-01 00:00:00", months: int = 3, k: int = 20) -> DataFrame:
    """Customers with the highest revenue in a period.

    Order totals are summed per customer before customers are joined, so the join sees each
    customer once. Equal customer numbers with equal details merge, as the grouping says.
    """
    orders = t.orders().where(within(c("o_entry_d"), ts(start), months_after(start, months)))
    spent = t.with_total(orders).groupBy("o_w_id", "o_d_id", "o_c_id").agg(F.sum("o_total").alias("amount"))
    nations = t.table("nation").select("n_nationkey", "n_name")
    details = ["c_id", "c_last", "c_city", "c_phone_number", "n_name"]
    rows = (
        spent.join(t.reachable_customers(), belongs_to_customer())
        .join(nations, state_nation())
        .groupBy(*details).agg(F.sum("amount").alias("revenue"))
    )
    top = rows.orderBy(c("revenue").desc(), *details).limit(k).withColumn("revenue", from_cents(c("revenue")))
    return shaped(top, "c_id bigint, c_last string, revenue double, c_city string, c_phone_number string, n_name string")


def q22(t: Nested, digits: tuple[str, ...] = ("1", "2", "3", "4", "5", "6", "7"),
        idle: tuple[str, str] | None = ("2013-12-01 00:00:00", "2013-12-31 00:00:00"),
        average_digits: tuple[str, ...] | None = None) -> DataFrame:
    """Customers above the average balance that ordered nothing in a month, by state.

    ``idle=None`` asks for customers that never ordered. The average may be taken over phone
    digits of its own.
    """
    def chosen(rows: DataFrame, wanted: tuple[str, ...]) -> DataFrame:
        return rows.where(initial(c("c_phone_number")).isin(*wanted))

    average = chosen(t.contact_balances(), average_digits or digits).where(c("c_balance") > 0.0).agg(
        share(from_cents(cents_total(c("c_balance"))), F.count("*"))
    ).scalar()
    orders = t.orders()
    if idle is not None:
        orders = orders.where(c("o_entry_d").between(ts(idle[0]), ts(idle[1])))
    active = orders.select("o_w_id", "o_d_id", "o_c_id").distinct()
    rows = (
        chosen(t.reachable_customers(), digits).where(c("c_balance") > average)
        .join(active, belongs_to_customer(), "left_anti")
        .groupBy(initial(c("c_state")).alias("country"))
        .agg(F.count("*").alias("numcust"), from_cents(cents_total(c("c_balance"))).alias("totacctbal"))
    )
    return shaped(rows, "country string, numcust bigint, totacctbal double").orderBy("country")
