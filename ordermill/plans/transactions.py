"""The five business transactions as set-based batch jobs.

Each function takes the document tables by name and a DataFrame of requests, and returns the new
versions of the tables it changes together with one result row per request. ``seq`` numbers the
requests; the outcome equals applying them one after the other in that order. Where one request
depends on the ones before it (order numbers, stock levels, notes), the dependency is expressed
by sums and ranks, not by a loop.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.expr import MONEY_SUM, money, money_total
from ordermill.operators.changes import key_filter, laid_over, overlay, possible, without_keys
from ordermill.operators.ordering import crowded, middle_row, running_total, total_in_one_task
from ordermill.operators.reshape import PART, PARTS, folded, once_each, with_parts
from ordermill.plans.layouts import ORDER_KEY
from ordermill.sources.schemas import BAD_CREDIT, MAX_CUSTOMER_NOTE, NO_CARRIER, ORDERLINE, ORIGINAL, PRIMARY_KEYS
from ordermill.sources.workspace import fresh_path

Tables = dict[str, DataFrame]
# Writes an intermediate result under a label and gives it back as read, or gives it back as it is.
Keep = Callable[[DataFrame, str], DataFrame]
c = F.col

# Fixed values of the restocking rule: stock stays at ten or more, and refills by 91.
STOCK_FLOOR = 10
STOCK_REFILL = 91
# A note has six numbers, five blanks and a bar: at least 12 characters.
SHORTEST_NOTE = 12
ORDERS_LOOKED_AT = 20


def _named_customers(customers: DataFrame, requests: DataFrame, w_id: str, d_id: str) -> DataFrame:
    """Fill in the customer number of requests that give only a last name.

    Of all customers of the district with that name, the middle one by first name is meant.
    Requests for which there is no such customer keep a null number.
    """
    names = customers.select(
        c("c_w_id").alias(w_id), c("c_d_id").alias(d_id), c("c_name.c_last").alias("c_last"),
        c("c_name.c_first").alias("_first"), c("c_id").alias("_named_id"),
    )
    asked = requests.where(c("c_id").isNull()).select(w_id, d_id, "c_last").distinct()
    keys = [w_id, d_id, "c_last"]
    middle = middle_row(names.join(asked, keys, "left_semi"), keys, "_first", "_named_id").drop("_first")
    return requests.join(middle, keys, "left").withColumn("c_id", F.coalesce("c_id", "_named_id")).drop("_named_id")


def stock_level(tables: Tables, requests: DataFrame, looked_at: int = ORDERS_LOOKED_AT) -> tuple[Tables, DataFrame]:
    """Distinct items of a district's latest orders whose stock is below a threshold.

    The order numbers looked at are spelled out, so orders are found by their key instead of
    by a range condition within a district.
    """
    districts = tables["district"].select(c("d_w_id").alias("w_id"), c("d_id"), "d_next_o_id")
    known = requests.join(districts, ["w_id", "d_id"])
    wanted = known.select(
        "seq", c("w_id").alias("o_w_id"), c("d_id").alias("o_d_id"), "threshold",
        F.explode(F.sequence(c("d_next_o_id") - looked_at, c("d_next_o_id") - 1)).alias("o_id"),
    )
    documents = possible(tables["orders"], wanted, ORDER_KEY).select(*ORDER_KEY, "o_orderline.ol_i_id")
    lines = wanted.join(documents, ORDER_KEY).select("seq", "threshold", "o_w_id", F.explode("ol_i_id").alias("ol_i_id")).distinct()
    stock = tables["stock"].select("s_w_id", "s_i_id", "s_quantity")
    low = lines.join(
        stock, (c("o_w_id") == c("s_w_id")) & (c("ol_i_id") == c("s_i_id")) & (c("s_quantity") < c("threshold")), "left_semi"
    )
    counts = low.groupBy("seq").agg(F.count("*").alias("low_stock"))
    return {}, known.join(counts, "seq", "left").select("seq", "w_id", "d_id", "threshold", F.coalesce("low_stock", F.lit(0)).alias("low_stock"))


def order_status(tables: Tables, requests: DataFrame) -> tuple[Tables, DataFrame]:
    """A customer, by number or by name, with their latest order and its lines.

    One row per request, or per part of a latest order that has several. ``status`` is ``found``, ``no order``
    or ``no customer``.
    """
    asked = _named_customers(tables["customer"], requests, "w_id", "d_id")
    people = tables["customer"].select(
        c("c_w_id").alias("w_id"), c("c_d_id").alias("d_id"), "c_id", "c_name.c_first", "c_name.c_middle",
        c("c_name.c_last").alias("last_name"), "c_balance",
    )
    found = asked.withColumnRenamed("c_last", "asked_name").join(people.withColumn("_known", F.lit(True)), ["w_id", "d_id", "c_id"], "left")
    owners = found.where("_known").select("w_id", "d_id", "c_id").distinct()
    orders = with_parts(tables["orders"])
    owned = (
        (c("o_w_id") == c("w_id")) & (c("o_d_id") == c("d_id")) & (c("o_c_id") == c("c_id"))
    )
    latest = orders.join(owners, owned, "left_semi").groupBy("o_w_id", "o_d_id", "o_c_id").agg(F.max("o_id").alias("o_id"))
    documents = latest.join(
        possible(orders, latest, ORDER_KEY).select(*ORDER_KEY, "o_carrier_id", "o_entry_d", PART, "o_orderline"), ORDER_KEY
    )
    status = F.when(c("_known").isNull(), "no customer").when(c("o_id").isNull(), "no order").otherwise("found")
    result = found.join(documents, owned, "left").select(
        "seq", "w_id", "d_id", "c_id", "c_first", "c_middle", F.coalesce("last_name", "asked_name").alias("c_last"), "c_balance",
        "o_id", "o_carrier_id", "o_entry_d", PART, "o_orderline", status.alias("status"),
    )
    return {}, result


def _as_is(rows: DataFrame, label: str) -> DataFrame:
    return rows


def delivery(tables: Tables, requests: DataFrame, keep: Keep = _as_is) -> tuple[Tables, DataFrame]:
    """Deliver the oldest waiting order of every district of a warehouse.

    The n-th request for a warehouse takes the n-th oldest order of each of its districts.
    Requests: seq, w_id, o_carrier_id, ol_delivery_d. Result: one row per delivered order.
    Documents, customers and waiting orders that do not change are not shuffled. All outputs follow from the orders taken
    and what is owed for them; ``keep`` may write these two, see ``new_order_changes``.
    """
    numbered = running_total(requests, ["w_id"], ["seq"], {"place": F.lit(1)})
    waiting = tables["neworder"].join(requests.select(c("w_id").alias("no_w_id")).distinct(), "no_w_id", "left_semi")
    queue = running_total(waiting, ["no_w_id", "no_d_id"], ["no_o_id"], {"place": F.lit(1)})
    taken = queue.withColumnRenamed("no_w_id", "w_id").join(numbered, ["w_id", "place"]).select(
        "seq", c("w_id").alias("o_w_id"), c("no_d_id").alias("o_d_id"), c("no_o_id").alias("o_id"),
        c("o_carrier_id").alias("_carrier"), c("ol_delivery_d").alias("_delivered"),
    )
    taken = keep(taken, "taken")
    key = {"no_w_id": "o_w_id", "no_d_id": "o_d_id", "no_o_id": "o_id"}
    left_over = without_keys(tables["neworder"], taken.select(*[c(v).alias(k) for k, v in key.items()]), list(key))

    def stamp(orders: DataFrame) -> DataFrame:
        hit = c("_carrier").isNotNull()
        stamped = F.transform("o_orderline", lambda ol: ol.withField("ol_delivery_d", c("_delivered")))
        return orders.withColumns({
            "o_carrier_id": F.when(hit, c("_carrier")).otherwise(c("o_carrier_id")),
            "o_orderline": F.when(hit, stamped).otherwise(c("o_orderline")),
        })

    orders = laid_over(tables["orders"], taken.drop("seq"), ORDER_KEY, stamp)

    add = F.aggregate("o_orderline.ol_amount", F.lit(0).cast(MONEY_SUM), lambda t, a: (t + money(a)).cast(MONEY_SUM))
    # Money per part, then per order.
    priced = possible(tables["orders"], taken, ORDER_KEY).select(*ORDER_KEY, "o_c_id", add.alias("amount"))
    delivered = taken.join(priced, ORDER_KEY).groupBy("seq", *ORDER_KEY, "o_c_id").agg(F.sum("amount").alias("amount"))
    delivered = keep(delivered, "delivered")
    owed = delivered.groupBy(c("o_w_id").alias("c_w_id"), c("o_d_id").alias("c_d_id"), c("o_c_id").alias("c_id")).agg(
        F.sum("amount").alias("_owed")
    )
    customers = laid_over(tables["customer"], owed, ["c_w_id", "c_d_id", "c_id"], lambda rows: rows.withColumn(
        "c_balance", (money(c("c_balance")) + F.coalesce("_owed", F.lit(0))).cast("double")))
    result = delivered.select(
        "seq", c("o_w_id").alias("w_id"), c("o_d_id").alias("d_id"), "o_id", c("amount").cast("double").alias("amount")
    )
    return {"neworder": left_over, "orders": orders, "customer": customers}, result


def payment(tables: Tables, requests: DataFrame, keep: Keep = _as_is) -> tuple[Tables, DataFrame]:
    """Book payments on customers, districts and warehouses, and append them to history.

    The paying customer is the one of ``c_w_id`` and ``c_d_id``. A customer with bad credit gets
    a note in front of their text, cut to its longest length: only the newest notes can be part
    of what remains, so no more than those are brought together per customer. The result has a row for every request;
    ``status`` is ``booked`` or ``no customer``. Customers that do not pay are not shuffled; ``keep`` may write the answered
    requests and the changes per customer, from which all outputs follow.
    """
    named = _named_customers(tables["customer"], requests, "c_w_id", "c_d_id")
    person = ["c_w_id", "c_d_id", "c_id"]
    credit = possible(tables["customer"], named, person).select(*person, "c_credit")
    answered = keep(named.join(credit.withColumn("_known", F.lit(True)), person, "left"), "answered")
    booked = answered.where("_known")

    def added(old: str, plus: str) -> Column:
        return (money(c(old)) + F.coalesce(plus, F.lit(0))).cast("double")

    sums = booked.groupBy(*person).agg(money_total(c("h_amount")).alias("_paid"), F.count("*").alias("_times"))
    newest = Window.partitionBy(*person).orderBy(c("seq").desc())
    enough = -(-MAX_CUSTOMER_NOTE // SHORTEST_NOTE)
    note = F.concat_ws(" ", *[c(n).cast("string") for n in ("c_id", "c_d_id", "c_w_id", "d_id", "w_id", "h_amount")])
    notes = (
        booked.where(c("c_credit") == BAD_CREDIT)
        .select(*person, "seq", F.concat(note, F.lit("|")).alias("note"))
        .withColumn("_rank", F.row_number().over(newest)).where(c("_rank") <= enough)
        .groupBy(*person)
        .agg(F.sort_array(F.collect_list(F.struct("_rank", "note"))).alias("_notes"))
        .select(*person, F.array_join("_notes.note", "").alias("_notes"))
    )
    paid = keep(sums.join(notes, person, "left"), "paid")
    customers = laid_over(tables["customer"], paid, person, lambda rows: rows.withColumns({
        "c_balance": (money(c("c_balance")) - F.coalesce("_paid", F.lit(0))).cast("double"),
        "c_ytd_payment": added("c_ytd_payment", "_paid"),
        "c_payment_cnt": c("c_payment_cnt") + F.coalesce("_times", F.lit(0)),
        "c_data": F.when(c("_notes").isNotNull(), F.substring(F.concat("_notes", "c_data"), 1, MAX_CUSTOMER_NOTE)).otherwise(c("c_data")),
    }))

    paid_w = booked.groupBy("w_id").agg(money_total(c("h_amount")).alias("_paid"))
    warehouses = tables["warehouse"].join(paid_w, "w_id", "left").withColumn("w_ytd", added("w_ytd", "_paid"))
    paid_d = booked.groupBy(c("w_id").alias("d_w_id"), "d_id").agg(money_total(c("h_amount")).alias("_paid"))
    districts = tables["district"].join(paid_d, ["d_w_id", "d_id"], "left").withColumn("d_ytd", added("d_ytd", "_paid"))

    w_names = tables["warehouse"].select("w_id", "w_name")
    d_names = tables["district"].select(c("d_w_id").alias("w_id"), "d_id", "d_name")
    entries = booked.join(w_names, "w_id").join(d_names, ["w_id", "d_id"])
    history = entries.select(
        c("c_id").alias("h_c_id"), c("c_d_id").alias("h_c_d_id"), c("c_w_id").alias("h_c_w_id"),
        c("d_id").alias("h_d_id"), c("w_id").alias("h_w_id"), c("h_date"), c("h_amount"),
        F.concat("w_name", F.lit("    "), "d_name").alias("h_data"),
    )
    return {
        "customer": customers,
        "warehouse": warehouses.select(tables["warehouse"].columns),
        "district": districts.select(tables["district"].columns),
        "history": tables["history"].unionByName(history),
    }, answered.select("seq", "w_id", "d_id", *person, "h_amount", F.when(c("_known"), "booked").otherwise("no customer").alias("status"))


def stock_after(start: Column, taken: Column) -> Column:
    """Stock after orders of ``taken`` pieces in all.

    One order of q pieces leaves s - q, or s - q + 91 if that would be below ten. As the level
    stays within 10..100, its residue modulo 91 tells it: the outcome of any number of orders
    follows from their sum alone.
    """
    plain = start - taken
    return F.when(plain >= STOCK_FLOOR, plain).otherwise(STOCK_FLOOR + F.pmod(plain - STOCK_FLOOR, F.lit(STOCK_REFILL)))


def _checked_quantity(quantity: Column, stock: Column) -> Column:
    """The rule above holds for quantities up to 81 on a stock that is not negative."""
    valid = quantity.between(1, STOCK_REFILL - STOCK_FLOOR) & (stock >= 0)
    return F.when(valid, quantity).otherwise(F.raise_error(F.lit("order quantity or stock level out of range")).cast("bigint"))


def _written(rows: DataFrame, label: str) -> DataFrame:
    rows.write.parquet(path := fresh_path(rows.sparkSession, label))
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def new_order(tables: Tables, requests: DataFrame, keep: Keep = _written) -> tuple[Tables, DataFrame]:
    """Place orders and return whole new table versions; see ``new_order_changes``."""
    changes, result = new_order_changes(tables, requests, keep)
    return {
        "district": overlay(tables["district"], changes["district"], PRIMARY_KEYS["district"]),
        "stock": overlay(tables["stock"], changes["stock"], PRIMARY_KEYS["stock"]),
        "orders": with_parts(tables["orders"]).select(changes["orders"].columns).unionByName(changes["orders"]),
        "neworder": tables["neworder"].select(changes["neworder"].columns).unionByName(changes["neworder"]),
    }, result


def new_order_changes(tables: Tables, requests: DataFrame, keep: Keep = _written) -> tuple[Tables, DataFrame]:
    """Place orders: number them per district, take the pieces from stock, price the lines.

    Returns only what changes: new ``orders`` and ``neworder`` rows, and the ``district`` and
    ``stock`` rows with new values, so that a small batch costs little on large tables. All
    outputs follow from two intermediate results, which are written once (with the numbers of the few requests not simply
    placed) and read back: by ``keep``, or below the shared folder of the session.

    Requests: seq, w_id, d_id, c_id, o_entry_d, lines ARRAY<STRUCT<i_id, w_id, qty>>. A request
    without lines, with an unknown item or for an unknown customer is not placed and takes no
    number. A line without a stock row is left out of the order.

    Lines are taken as they stand. A request with very many lines comes in parts (``o_part``, ``o_parts``, the other
    columns repeated) whose lines have a number ``n`` (from 0) as a further field; all parts must be in one batch. Orders and result then have a row per part too, and
    ``total`` is that of the whole order.
    """
    requests = with_parts(requests)
    numbered = "n" in requests.schema["lines"].dataType.elementType.names
    number = F.when(c(PARTS) > 1, c("line.n")).otherwise(c("pos")) if numbered else c("pos")
    items = tables["item"].select(c("i_id").alias("s_i_id"), "i_name", "i_price", c("i_data").contains(ORIGINAL).alias("_i_original"))

    def lines_of(rows: DataFrame, *columns: str) -> DataFrame:
        """A row per line of requests, under the key of its stock row."""
        return rows.select("seq", PARTS, PART, *columns, F.posexplode("lines").alias("pos", "line")).select(
            "seq", PART, *columns, "pos", (number + 1).cast("bigint").alias("ol_number"),
            c("line.w_id").alias("s_w_id"), c("line.i_id").alias("s_i_id"), c("line.qty").alias("ol_quantity"),
        )

    # Items are looked up as distinct numbers; of the lines, only those that may ask for a missing one are shuffled.
    asked = lines_of(requests).select("seq", "s_i_id")
    missing = asked.select("s_i_id").distinct().join(items, "s_i_id", "left").where(c("i_price").isNull()).select("s_i_id").distinct()
    suspects = asked.where(key_filter(asked, missing, ["s_i_id"]) | c("s_i_id").isNull()).distinct()
    unknown = suspects.join(missing.withColumn("_missing", F.lit(True)), "s_i_id", "left").where(
        c("_missing") | c("s_i_id").isNull()).select("seq").distinct()

    # A request in one part has its sizes in its own row; those in several, of a repeated number or an unknown item are put together.
    sizes = {"n_lines": (F.size("lines").cast("bigint"), F.sum), "all_local": (F.forall("lines", lambda line: line["w_id"] == c("w_id")).cast("bigint"), F.min)}
    repeated = requests.where(c(PART) == 0).groupBy("seq").agg(F.count("*").alias("_n")).where(c("_n") > 1).select("seq")
    apart = (c(PARTS) > 1) | key_filter(requests, repeated.unionByName(unknown), ["seq"])
    several = requests.where(apart)
    head = requests.where(~apart & c("seq").isNotNull() & (c(PART) == 0)).withColumns(
        {name: value for name, (value, _) in sizes.items()}).drop("lines", PART).unionByName(
        several.where(c(PART) == 0).drop("lines", PART).join(folded(several, ["seq"], sizes), "seq").join(unknown, "seq", "left_anti"))

    people = tables["customer"].select(
        c("c_w_id").alias("w_id"), c("c_d_id").alias("d_id"), "c_id", "c_discount", "c_name.c_last", "c_credit"
    )
    rates = tables["district"].select(c("d_w_id").alias("w_id"), "d_id", "d_tax", "d_next_o_id").join(
        tables["warehouse"].select("w_id", "w_tax"), "w_id"
    )
    valid = head.where(c("n_lines") > 0).join(rates, ["w_id", "d_id"]).join(people, ["w_id", "d_id", "c_id"])
    placed = running_total(valid, ["w_id", "d_id"], ["seq"], {"_earlier": F.lit(1)}).withColumn(
        "o_id", c("d_next_o_id") + c("_earlier")
    )
    placed = keep(placed, "placed")

    # Nearly all requests with lines are placed, once: only the others meet what was placed with all their lines.
    times = placed.groupBy("seq").agg(F.count("*").alias("_times"))
    other = requests.where(F.size("lines") > 0).select("seq").distinct().join(times, "seq", "left").where(
        F.coalesce("_times", F.lit(0)) != 1).select("seq")
    other = keep(other, "other")
    may = key_filter(requests, other, ["seq"])
    wanted = requests.select("seq", "w_id", "d_id", PART, PARTS, "lines")
    ordered = wanted.where(~may & c("seq").isNotNull()).unionByName(
        wanted.where(may).join(possible(placed.select("seq"), other, ["seq"]), "seq").select(wanted.columns))

    # Wide stock rows are shuffled once, under the key of lines: items go there with the distinct keys of stock. The running
    # total needs no further exchange but for stock rows of very many lines, which are counted and summed in slices.
    stock_key = ["s_w_id", "s_i_id"]
    stock = tables["stock"].select(*stock_key, "s_quantity", "s_dists", c("s_data").contains(ORIGINAL).alias("_s_original"))
    goods = stock.select(*stock_key).repartition("s_i_id").distinct().join(items, "s_i_id")
    hot = crowded(lines_of(requests), [c(k).cast("bigint") for k in stock_key])

    def met(which: Column) -> DataFrame:
        """Lines of some stock rows beside what they take."""
        rows = lines_of(ordered, "w_id", "d_id").where(which).join(stock.where(which), stock_key).join(goods.where(which), stock_key)
        return rows.withColumns({
            "ol_quantity": _checked_quantity(c("ol_quantity"), c("s_quantity")),
            "ol_dist_info": F.get("s_dists", (c("d_id") - 1).cast("int")),
            "brand": F.when(c("_i_original") & c("_s_original"), "B").otherwise("G"),
        }).drop("s_dists", "d_id", "_i_original", "_s_original")

    order, taken = ["seq", "ol_number", PART, "pos"], {"_taken": c("ol_quantity")}
    lines = total_in_one_task(met(F.lit(True) if hot is None else ~hot), stock_key, order, taken)
    if hot is not None:
        lines = lines.unionByName(running_total(met(hot), stock_key, order, taken))
    lines = lines.withColumn("left_in_stock", stock_after(c("s_quantity"), c("_taken") + c("ol_quantity")))
    lines = keep(lines.drop("s_quantity", "_taken", "pos"), "lines").withColumn(
        "ol_amount", money(c("ol_quantity") * money(c("i_price"))).cast("double"))

    # One group per part of a request, which already holds its lines in one row.
    line_fields = ["ol_number", c("s_i_id").alias("ol_i_id"), c("s_w_id").alias("ol_supply_w_id"), "ol_quantity", "ol_amount", "ol_dist_info"]
    grouped = lines.groupBy("seq", PART).agg(
        F.sort_array(F.collect_list(F.struct(*line_fields))).alias("o_orderline"),
        F.sort_array(F.collect_list(F.struct(
            "ol_number", "i_name", "left_in_stock", "brand", "i_price", "ol_amount"))).alias("items"),
        money_total(c("ol_amount")).alias("_sum"),
    )
    parts = placed.withColumn(PART, F.explode(F.sequence(F.lit(0).cast("bigint"), c(PARTS) - 1)))
    full = parts.join(grouped, ["seq", PART], "left")
    delivered = F.transform("o_orderline", lambda ol: F.struct(
        *[ol[n].alias(n) for n in ("ol_number", "ol_i_id", "ol_supply_w_id")], c("o_entry_d").alias("ol_delivery_d"),
        *[ol[n].alias(n) for n in ("ol_quantity", "ol_amount", "ol_dist_info")]))
    documents = full.select(
        "o_id", c("c_id").alias("o_c_id"), c("d_id").alias("o_d_id"), c("w_id").alias("o_w_id"),
        F.lit(NO_CARRIER).cast("bigint").alias("o_carrier_id"), c("n_lines").alias("o_ol_cnt"),
        c("all_local").alias("o_all_local"), "o_entry_d", PART, PARTS,
        F.coalesce(delivered, F.array().cast(f"ARRAY<{ORDERLINE.format(date='TIMESTAMP_NTZ')}>")).alias("o_orderline"),
    )
    waiting = placed.select(c("o_id").alias("no_o_id"), c("d_id").alias("no_d_id"), c("w_id").alias("no_w_id"))

    counts = placed.groupBy(c("w_id").alias("d_w_id"), "d_id").agg(F.count("*").alias("_orders"))
    districts = tables["district"].join(counts, ["d_w_id", "d_id"]).withColumn(
        "d_next_o_id", c("d_next_o_id") + c("_orders")
    ).select(tables["district"].columns)
    remote = F.when(c("s_w_id") != c("w_id"), 1).otherwise(0)
    used = lines.groupBy(*stock_key).agg(
        F.sum("ol_quantity").alias("_pieces"), F.count("*").alias("_lines"), F.sum(remote).alias("_remote")
    )
    stocks = tables["stock"].join(used, stock_key).withColumns({
        "s_quantity": stock_after(c("s_quantity"), c("_pieces")),
        "s_ytd": c("s_ytd") + c("_pieces"),
        "s_order_cnt": c("s_order_cnt") + c("_lines"),
        "s_remote_cnt": c("s_remote_cnt") + c("_remote"),
    }).select(tables["stock"].columns)

    # The whole sum of an order of several parts beside each of them.
    several = full.where(c(PARTS) > 1).groupBy("seq").agg(F.sum("_sum").alias("_whole"))
    full = full.join(several, "seq", "left").withColumn("_sum", F.coalesce("_whole", "_sum"))
    result = full.select(
        "seq", "w_id", "d_id", "c_id", "o_id", PART, "c_last", "c_credit", "c_discount", "w_tax", "d_tax",
        (F.coalesce("_sum", F.lit(0)).cast("double") * (1.0 - c("c_discount")) * (1.0 + c("w_tax") + c("d_tax"))).alias("total"),
        "items",
    )
    return {"district": districts, "stock": stocks, "orders": documents, "neworder": waiting}, result


# -- smaller questions on the same tables --------------------------------------------------


def stock_count_join(tables: Tables, requests: DataFrame, looked_at: int = ORDERS_LOOKED_AT) -> DataFrame:
    """Stock level written as one join: stock of the warehouse the order line belongs to,
    with no warehouse parameter of its own."""
    districts = tables["district"].select(c("d_w_id").alias("w_id"), "d_id", "d_next_o_id")
    known = requests.join(districts, ["w_id", "d_id"])
    wanted = known.select(
        "seq", c("w_id").alias("o_w_id"), c("d_id").alias("o_d_id"), "threshold",
        F.explode(F.sequence(c("d_next_o_id") - looked_at, c("d_next_o_id") - 1)).alias("o_id"),
    )
    lines = wanted.join(tables["orders"].select(*ORDER_KEY, "o_orderline.ol_i_id"), ORDER_KEY).select(
        "seq", "threshold", c("o_w_id").alias("s_w_id"), F.explode("ol_i_id").alias("s_i_id")
    )
    low = lines.join(tables["stock"].select("s_w_id", "s_i_id", "s_quantity"), ["s_w_id", "s_i_id"])
    counts = low.where(c("s_quantity") < c("threshold")).groupBy("seq").agg(F.countDistinct("s_i_id").alias("low_stock"))
    return known.select("seq").join(counts, "seq", "left").fillna(0, ["low_stock"])


def orders_by_district(tables: Tables, d_id: int) -> DataFrame:
    """Orders of a district number beside every district of that number, whatever the warehouse.

    A row per order and warehouse, by definition of the question; see ``district_order_counts``
    for its totals without the pairs.
    """
    districts = tables["district"].where(c("d_id") == d_id).drop("d_address")
    return once_each(tables["orders"]).where(c("o_d_id") == d_id).drop("o_orderline").join(districts, c("o_d_id") == c("d_id"))


def district_order_counts(tables: Tables) -> DataFrame:
    """Per district, how many orders and lines ``orders_by_district`` puts beside it.

    Orders are summed per district number first: ten rows meet the districts.
    """
    per_number = once_each(tables["orders"]).groupBy("o_d_id").agg(
        F.count("*").alias("orders"), F.sum("o_ol_cnt").alias("lines"), F.max("o_entry_d").alias("latest")
    )
    joined = tables["district"].select("d_w_id", "d_id", "d_next_o_id").join(per_number, c("o_d_id") == c("d_id"))
    return joined.drop("o_d_id")


def customers_with_orders(tables: Tables) -> DataFrame:
    """Per district number, the distinct customer numbers that occur on any order.

    Both sides shrink to distinct numbers first.
    """
    numbers = tables["customer"].select("c_d_id", "c_id").distinct()
    ordering = tables["orders"].select("o_c_id").distinct()
    matched = numbers.join(ordering, c("c_id") == c("o_c_id"), "left_semi")
    return matched.groupBy("c_d_id").agg(F.count("*").alias("customers"))
