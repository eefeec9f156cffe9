"""The document data set as a Spark job: rows from ``range``, values from hashes of their keys.

No table is built on the driver and none but ``customer`` needs a shuffle. Rules of the data set
(counts, shares, ranges) are kept; its exact random stream is not.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.functions.draws import Draw, last_name, nurand
from ordermill.functions.expr import MONEY_SUM, money, months_after, plus_days, ts
from ordermill.sources.schemas import (
    BAD_CREDIT, CUSTOMERS_PER_DISTRICT, DISTRICTS_PER_WAREHOUSE, GOOD_CREDIT, ITEMS, NEW_ORDERS_PER_DISTRICT,
    NO_CARRIER, ORIGINAL, SUPPLIERS,
)

c = F.col

# Nation key (code point of a letter or digit), name, region key.
NATIONS = [
    (48, "Algeria", 0), (49, "Argentina", 1), (50, "Brazil", 1), (51, "Canada", 1), (52, "Egypt", 4),
    (53, "Ethiopia", 0), (54, "France", 3), (55, "Germany", 3), (56, "India", 2), (57, "Indonesia", 2),
    (65, "Iran", 4), (66, "Iraq", 4), (67, "Japan", 2), (68, "Jordan", 4), (69, "Kenya", 0),
    (70, "Morocco", 0), (71, "Mozambique", 0), (72, "Peru", 1), (73, "China", 2), (74, "Kuwait", 4),
    (75, "Saudi Arabia", 4), (76, "Vietnam", 2), (77, "Russia", 3), (78, "United Kingdom", 3),
    (79, "United States", 1), (80, "Lebanon", 4), (81, "Oman", 4), (82, "Qatar", 4), (83, "Mexico", 1),
    (84, "Turkey", 4), (85, "Chile", 1), (86, "Italy", 3), (87, "South Africa", 0), (88, "South Korea", 2),
    (89, "Colombia", 1), (90, "Spain", 3), (97, "Ukraine", 3), (98, "Ecuador", 1), (99, "Sudan", 0),
    (100, "Uzbekistan", 2), (101, "Malaysia", 2), (102, "Venezuela", 1), (103, "Tanzania", 0),
    (104, "Afghanistan", 2), (105, "North Korea", 2), (106, "Taiwan", 2), (107, "Ghana", 0),
    (108, "Ivory Coast", 0), (109, "Syria", 4), (110, "Madagascar", 0), (111, "Cameroon", 0),
    (112, "Nigeria", 0), (113, "Bolivia", 1), (114, "Netherlands", 3), (115, "Cambodia", 2),
    (116, "Belgium", 3), (117, "Greece", 3), (118, "Uruguay", 1), (119, "Israel", 4), (120, "Finland", 3),
    (121, "Singapore", 2), (122, "Norway", 3),
]
REGIONS = ["Africa", "America", "Asia", "Europe", "Middle East"]
# Initial amounts, categories, delivery delay in days.
HISTORY_AMOUNT = 10.0
CREDIT_LIMIT = 50000.0
FIRST_BALANCE = -10.0
CATEGORIES = 127
DELIVERY_DAYS = (2, 151)
SECONDS_PER_DAY = 86_400

ROWS_PER_TASK = 200_000


@dataclass(frozen=True)
class Scale:
    """Row counts from the number of warehouses; ``divisor`` shrinks items, customers and new orders."""

    warehouses: int
    first_warehouse: int = 1
    divisor: float = 1.0

    def __post_init__(self):
        if self.warehouses < 1 or self.divisor < 1.0:
            raise ValueError("warehouses and divisor must be at least 1")

    @property
    def items(self) -> int:
        return max(1, int(ITEMS / self.divisor))

    @property
    def customers(self) -> int:
        return max(1, int(CUSTOMERS_PER_DISTRICT / self.divisor))

    @property
    def new_orders(self) -> int:
        return int(NEW_ORDERS_PER_DISTRICT / self.divisor)

    @property
    def districts(self) -> int:
        return DISTRICTS_PER_WAREHOUSE


class Synth:
    """Tables of one data set by name: ``Synth(spark, Scale(10), seed=7).table("orders")``."""

    def __init__(self, spark: SparkSession, scale: Scale, seed: int = 0, run_date: str = "2021-01-01 00:00:00",
                 extra_fields: int = 0, suppliers: int = SUPPLIERS):
        self.spark, self.scale, self.seed = spark, scale, seed
        self.run_date, self.extra_fields, self.suppliers = run_date, extra_fields, suppliers

    def table(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    # -- dates ----------------------------------------------------------------------------

    @property
    def start(self) -> Column:
        """Seven years before the run date."""
        return months_after(self.run_date, -84)

    @property
    def end(self) -> Column:
        """Last order date: a day and the longest delivery before the run date."""
        return plus_days(ts(self.run_date), -1 - DELIVERY_DAYS[1])

    def _since(self, w: Column, d: Column, customer: Column) -> Column:
        """A customer's first date, which is also the entry date of the customer's order."""
        span = F.timestamp_diff("SECOND", self.start, self.end)
        seconds = Draw(self.seed, "customer", w, d, customer).below("since", span)
        return F.timestamp_add("SECOND", seconds, self.start)

    # -- shared pieces --------------------------------------------------------------------

    def _numbers(self, n: int, first: int = 0) -> DataFrame:
        """Row numbers, in as many tasks as keep each task's output moderate."""
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK))
        return self.spark.range(first, first + n, 1, tasks)

    def _district_rows(self, per_district: int, number: str) -> DataFrame:
        """One row per (warehouse, district, number), numbered from one."""
        districts = self.scale.districts
        n = c("id")
        return self._numbers(self.scale.warehouses * districts * per_district).select(
            (self.scale.first_warehouse + F.floor(n / (districts * per_district))).alias("w"),
            (1 + F.floor(n / per_district) % districts).alias("d"),
            (1 + n % per_district).alias(number),
        )

    @staticmethod
    def _address(draw: Draw, prefix: str, kind: Column | None = None) -> Column:
        parts = [] if kind is None else [kind.alias(f"{prefix}_address_kind")]
        parts += [
            draw.letters("street_1", 10, 20).alias(f"{prefix}_street_1"),
            draw.letters("street_2", 10, 20).alias(f"{prefix}_street_2"),
            draw.letters("city", 10, 20).alias(f"{prefix}_city"),
            draw.letters("state", 2, 2).alias(f"{prefix}_state"),
            F.concat(draw.digits("zip", 4), F.lit("11111")).alias(f"{prefix}_zip"),
        ]
        return F.struct(*parts)

    @staticmethod
    def _data(draw: Draw, original: Column) -> Column:
        """26 to 50 letters; marked rows carry the marker at a drawn place."""
        text = draw.letters("data", 26, 50)
        place = (F.lit(1) + draw.below("place", F.length(text) - len(ORIGINAL) + 1)).cast("int")
        return F.when(original, F.overlay(text, F.lit(ORIGINAL), place)).otherwise(text)

    def _filler(self, prefix: str, table: str, *keys: Column) -> list[Column]:
        return [
            F.md5(F.concat_ws("/", F.lit(f"{self.seed}/{table}/{n}"), *[k.cast("string") for k in keys])).alias(f"{prefix}_extra_{n:03d}")
            for n in range(1, self.extra_fields + 1)
        ]

    # -- small tables ---------------------------------------------------------------------

    def _region(self) -> DataFrame:
        rows = self.spark.createDataFrame(list(enumerate(REGIONS)), "r_regionkey bigint, r_name string")
        draw = Draw(self.seed, "region", c("r_regionkey"))
        return rows.withColumn("r_comment", draw.alphanumeric("comment", draw.number("length", 31, 115)))

    def _nation(self) -> DataFrame:
        rows = self.spark.createDataFrame(NATIONS, "n_nationkey bigint, n_name string, n_regionkey bigint")
        draw = Draw(self.seed, "nation", c("n_nationkey"))
        return rows.withColumn("n_comment", draw.alphanumeric("comment", draw.number("length", 31, 114)))

    def _supplier(self) -> DataFrame:
        """Nations are dealt out in turn along a permutation, so none gets more than its share."""
        k = c("su_suppkey")
        draw = Draw(self.seed, "supplier", k)
        place = Draw(self.seed, "supplier.nation").permuted(k - 1, self.suppliers, "place")
        nations = F.array(*[F.lit(key).cast("bigint") for key, _, _ in NATIONS])
        length = draw.number("length", 25, 100)

        def marked(second: str) -> Column:
            room = length - len("Customer") - len(second)
            left = draw.below("left", room + 1)
            middle = draw.below("middle", room - left + 1)
            return F.concat(
                draw.alphanumeric("c1", left), F.lit("Customer"), draw.alphanumeric("c2", middle), F.lit(second),
                draw.alphanumeric("c3", room - left - middle),
            )

        comment = (
            F.when(place < 5, marked("Recommends")).when(place < 10, marked("Complaints"))
            .otherwise(draw.alphanumeric("comment", length))
        )
        return self._numbers(self.suppliers, 1).select(c("id").alias("su_suppkey")).select(
            k, F.concat(F.lit("Supplier#"), F.lpad(k.cast("string"), 9, "0")).alias("su_name"),
            self._address(draw, "su").alias("su_address"),
            F.element_at(nations, (F.lit(1) + place % len(NATIONS)).cast("int")).alias("su_nationkey"),
            draw.digits("phone", 16).alias("su_phone"), draw.fixed("acctbal", 2, -999.99, 9999.99).alias("su_acctbal"),
            comment.alias("su_comment"),
        )

    def _item(self) -> DataFrame:
        i = c("i_id")
        draw = Draw(self.seed, "item", i)
        categories = F.transform(draw.subset("category", draw.number("categories", 1, 2), CATEGORIES), _category)
        return self._numbers(self.scale.items, 1).select(c("id").alias("i_id")).select(
            i, draw.letters("name", 14, 24).alias("i_name"), draw.fixed("price", 2, 1.0, 100.0).alias("i_price"),
            *self._filler("i", "item", i), categories.alias("i_categories"),
            self._data(draw, draw.one_in_ten("original", i)).alias("i_data"), draw.number("im", 1, 10000).alias("i_im_id"),
        )

    def _warehouse(self) -> DataFrame:
        w = c("w_id")
        draw = Draw(self.seed, "warehouse", w)
        paid = HISTORY_AMOUNT * self.scale.customers * self.scale.districts
        return self._numbers(self.scale.warehouses).select((self.scale.first_warehouse + c("id")).alias("w_id")).select(
            w, F.lit(paid).alias("w_ytd"), draw.fixed("tax", 4, 0.0, 0.2).alias("w_tax"),
            draw.letters("name", 6, 10).alias("w_name"), self._address(draw, "w").alias("w_address"),
        )

    def _district(self) -> DataFrame:
        draw = Draw(self.seed, "district", c("w"), c("d"))
        return self._district_rows(1, "one").select(
            c("d").alias("d_id"), c("w").alias("d_w_id"), F.lit(HISTORY_AMOUNT * self.scale.customers).alias("d_ytd"),
            draw.fixed("tax", 4, 0.0, 0.2).alias("d_tax"), F.lit(self.scale.customers + 1).cast("bigint").alias("d_next_o_id"),
            draw.letters("name", 6, 10).alias("d_name"), self._address(draw, "d").alias("d_address"),
        )

    def _stock(self) -> DataFrame:
        i, w = c("s_i_id"), c("s_w_id")
        draw = Draw(self.seed, "stock", w, i)
        orders = draw.number("orders", self.scale.districts, CUSTOMERS_PER_DISTRICT)
        remote = F.floor(orders / 10) if self.scale.warehouses > 1 else F.lit(0).cast("bigint")
        items = self.scale.items
        dists = F.array(*[draw.letters(f"dist{n}", 24, 24) for n in range(1, self.scale.districts + 1)])
        return self._numbers(self.scale.warehouses * items).select(
            (1 + c("id") % items).alias("s_i_id"), (self.scale.first_warehouse + F.floor(c("id") / items)).alias("s_w_id")
        ).select(
            i, w, draw.number("quantity", 10, 100).alias("s_quantity"), F.lit(0).cast("bigint").alias("s_ytd"),
            orders.alias("s_order_cnt"), remote.alias("s_remote_cnt"),
            self._data(draw, draw.one_in_ten("original", i)).alias("s_data"), dists.alias("s_dists"),
            ((w * i) % self.suppliers).alias("s_suppkey"),
        )

    # -- orders ---------------------------------------------------------------------------

    def _order_rows(self) -> DataFrame:
        """Order keys with their customer: a permutation of the customers in each district."""
        n = self.scale.customers
        customer = Draw(self.seed, "orders.customer", c("w"), c("d")).permuted(c("o_id") - 1, n, "place")
        rows = self._district_rows(n, "o_id")
        draw = Draw(self.seed, "orders", c("w"), c("d"), c("o_id"))
        return rows.withColumns({
            "o_c_id": 1 + customer,
            "is_new": c("o_id") > n - self.scale.new_orders,
            "lines": draw.number("lines", 5, 15),
        })

    def _amount(self, line: Draw) -> Column:
        """Only new orders and every fifth old one have priced lines."""
        priced = c("is_new") | (c("o_id") % 5 == 0)
        return F.when(priced, line.fixed("amount", 2, 0.01, 5000.0)).otherwise(0.0)

    def _orders(self) -> DataFrame:
        w, d, o = c("w"), c("d"), c("o_id")
        draw = Draw(self.seed, "orders", w, d, o)
        low, high = DELIVERY_DAYS

        def line(n: Column) -> Column:
            at = draw.at(n)
            delay = low * SECONDS_PER_DAY + at.below("delay", (high - low) * SECONDS_PER_DAY)
            delivered = F.timestamp_add("SECOND", delay, c("o_entry_d"))
            return F.struct(
                n.alias("ol_number"), at.number("item", 1, self.scale.items).alias("ol_i_id"), w.alias("ol_supply_w_id"),
                F.when(~c("is_new"), delivered).alias("ol_delivery_d"), at.number("quantity", 1, 50).alias("ol_quantity"),
                self._amount(at).alias("ol_amount"), at.letters("dist", 24, 24).alias("ol_dist_info"),
            )

        carrier = F.when(c("is_new"), F.lit(NO_CARRIER).cast("bigint")).otherwise(draw.number("carrier", 1, 10))
        return self._order_rows().withColumn("o_entry_d", self._since(w, d, c("o_c_id"))).select(
            o, "o_c_id", d.alias("o_d_id"), w.alias("o_w_id"), carrier.alias("o_carrier_id"), c("lines").alias("o_ol_cnt"),
            F.lit(1).cast("bigint").alias("o_all_local"), "o_entry_d", *self._filler("o", "orders", w, d, o),
            F.transform(F.sequence(F.lit(0).cast("bigint"), c("lines") - 1), line).alias("o_orderline"),
        )

    def _neworder(self) -> DataFrame:
        return self._order_rows().where("is_new").select(
            c("o_id").alias("no_o_id"), c("d").alias("no_d_id"), c("w").alias("no_w_id")
        )

    def _running_totals(self) -> DataFrame:
        """Per customer with a delivered order: the district's amounts up to that order.

        A district holds at most a few thousand orders by definition, so it is one window.
        """
        draw = Draw(self.seed, "orders", c("w"), c("d"), c("o_id"))
        total = F.aggregate(
            F.transform(F.sequence(F.lit(0).cast("bigint"), c("lines") - 1), lambda n: self._amount(draw.at(n))),
            F.lit(0).cast(MONEY_SUM), lambda t, a: (t + money(a)).cast(MONEY_SUM),
        )
        so_far = F.sum("total").over(Window.partitionBy("w", "d").orderBy("o_id"))
        sums = self._order_rows().withColumn("total", total).withColumn("so_far", so_far)
        return sums.where(~c("is_new")).select("w", "d", c("o_c_id").alias("c_id"), "so_far")

    # -- customers ------------------------------------------------------------------------

    def _customer(self) -> DataFrame:
        w, d, k = c("w"), c("d"), c("c_id")
        draw = Draw(self.seed, "customer", w, d, k)
        highest = min(999, self.scale.customers - 1)
        constant = Draw(self.seed, "nurand").below("last", 256)
        skewed = nurand(draw.below("last_a", 256), draw.number("last_x", 0, highest), constant, 0, highest)
        name = F.struct(
            draw.letters("first", 6, 10).alias("c_first"), F.lit("OE").alias("c_middle"),
            last_name(F.when(k <= 1000, k - 1).otherwise(skewed)).alias("c_last"),
        )
        addresses = F.concat(
            F.array(self._address(draw.at(F.lit("shipping")), "c", F.lit("shipping"))),
            F.transform(draw.arrangement("address", ["home", "work", "billing"], 3), lambda kind: self._address(draw.at(kind), "c", kind)),
        )

        def phone(kind: Column) -> Column:
            return F.struct(kind.alias("c_phone_kind"), draw.at(kind).digits("phone", 16).alias("c_phone_number"))

        phones = F.concat(
            F.array(phone(F.lit("contact"))), F.transform(draw.arrangement("phone", ["home", "work", "mobile"], 3), phone)
        )
        categories = F.transform(draw.subset("category", draw.number("categories", 0, 14), CATEGORIES), _category)
        rows = self._district_rows(self.scale.customers, "c_id").join(self._running_totals(), ["w", "d", "c_id"], "left")
        had_order = c("so_far").isNotNull()
        balance = F.when(had_order, (c("so_far") - F.lit(HISTORY_AMOUNT).cast("decimal(18,2)")).cast("double")).otherwise(FIRST_BALANCE)
        return rows.select(
            k, d.alias("c_d_id"), w.alias("c_w_id"), draw.fixed("discount", 4, 0.0, 0.5).alias("c_discount"),
            F.when(draw.one_in_ten("credit", k), BAD_CREDIT).otherwise(GOOD_CREDIT).alias("c_credit"), name.alias("c_name"),
            F.lit(CREDIT_LIMIT).alias("c_credit_lim"), balance.alias("c_balance"), F.lit(HISTORY_AMOUNT).alias("c_ytd_payment"),
            F.lit(1).cast("bigint").alias("c_payment_cnt"), F.lit(0).cast("bigint").alias("c_delivery_cnt"),
            *self._filler("c", "customer", w, d, k), addresses.alias("c_addresses"), phones.alias("c_phones"),
            self._since(w, d, k).alias("c_since"), categories.alias("c_item_categories"),
            draw.letters("data", 300, 500).alias("c_data"),
        )

    def _history(self) -> DataFrame:
        w, d, k = c("w"), c("d"), c("c_id")
        return self._district_rows(self.scale.customers, "c_id").select(
            k.alias("h_c_id"), d.alias("h_c_d_id"), w.alias("h_c_w_id"), d.alias("h_d_id"), w.alias("h_w_id"),
            self._since(w, d, k).alias("h_date"), F.lit(HISTORY_AMOUNT).alias("h_amount"),
            Draw(self.seed, "history", w, d, k).letters("data", 12, 24).alias("h_data"),
        )


def _category(n: Column) -> Column:
    return F.concat(F.lit("category_"), F.lpad(n.cast("string"), 3, "0"))
