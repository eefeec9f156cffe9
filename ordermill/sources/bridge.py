"""The given relational tables seen as order documents.

``customer``, ``orders``, ``lineitem``, ``part``, ``supplier``, ``nation`` and ``region`` carry
the same business as the documents but not the same columns. This module derives every document
field by arithmetic on the given keys, so that any engine can derive the same values (the SQL
twin is ``plans/twin_sql.py``). Four warehouses with ten districts each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.expr import plus_days, supplier_key, ts
from ordermill.operators.reshape import PART, PART_LINES, PARTS, in_parts

WAREHOUSES = 4
DISTRICTS = 10
FIRST_NATION = 97  # code point of "a": nation 0 owns the states starting with "a"
# Given rows that one task turns into documents and sorts: at most about two kilobytes each when wide.
ROWS_PER_TASK = 1 << 16
# What ``Bridge._lines`` gives of a line, beside its order.
_GIVEN_LINE = ("ol_number", "ol_i_id", "_remote", "_days", "ol_quantity", "ol_amount")


def _c(name: str) -> Column:
    return F.col(name)


def _big(c: Column) -> Column:
    return c.cast("bigint")


def _text(c: Column) -> Column:
    return c.cast("string")


def _letter(n: Column) -> Column:
    return F.char(_big(F.lit(97) + n))


def warehouse_of(custkey: Column) -> Column:
    return F.lit(1) + custkey % WAREHOUSES


def district_of(custkey: Column) -> Column:
    return F.lit(1) + _big(F.floor(custkey / WAREHOUSES)) % DISTRICTS


def customer_of(custkey: Column) -> Column:
    """Customer numbers repeat in every district, as in the documents."""
    return F.lit(1) + _big(F.floor(custkey / (WAREHOUSES * DISTRICTS)))


class Bridge:
    """Derived tables by name; ``table("orders")`` and so on."""

    def __init__(self, spark: SparkSession, sf_dir: str, rows_per_task: int = ROWS_PER_TASK):
        self.spark = spark
        self.sf_dir = sf_dir
        self.rows_per_task = rows_per_task
        self._supplier_count: int | None = None

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def spread(self, name: str, *keys: Column) -> DataFrame:
        """Given rows in ranges of ``keys``, one per ``rows_per_task`` rows (counted from file footers).

        Wide documents take many times the bytes of the rows they come from, and a given file of a few megabytes is one
        split: the narrow rows are dealt to tasks before they are widened. Where a row stands splits a key of very many rows.
        """
        rows = self.given(name)
        tasks = -(-rows.count() // self.rows_per_task)
        if tasks <= 1:
            return rows
        placed = rows.select("*", _c("_metadata.file_name").alias("_file"), _c("_metadata.row_index").alias("_row"))
        return placed.repartitionByRange(tasks, *keys, "_file", "_row").drop("_file", "_row")

    @property
    def suppliers(self) -> int:
        """Number of suppliers, the modulus of the supplier rule (answered from file footers)."""
        if self._supplier_count is None:
            self._supplier_count = self.given("supplier").count()
        return self._supplier_count

    def table(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    # -- small tables ---------------------------------------------------------------------

    def _region(self) -> DataFrame:
        return self.given("region").select(
            _big(_c("r_regionkey")).alias("r_regionkey"), "r_name", F.lit("").alias("r_comment")
        )

    def _nation(self) -> DataFrame:
        return self.given("nation").select(
            _big(FIRST_NATION + _c("n_nationkey")).alias("n_nationkey"),
            "n_name",
            _big(_c("n_regionkey")).alias("n_regionkey"),
            F.lit("").alias("n_comment"),
        )

    def _supplier(self) -> DataFrame:
        k = _c("s_suppkey")
        address = F.struct(
            F.concat(F.lit("S1-"), _text(k)).alias("su_street_1"),
            F.concat(F.lit("S2-"), _text(k % 10)).alias("su_street_2"),
            F.concat(F.lit("CITY"), _text(k % 50)).alias("su_city"),
            F.concat(_letter(_c("s_nationkey")), _letter(k % 26)).alias("su_state"),
            F.concat(F.lpad(_text(k % 10000), 4, "0"), F.lit("11111")).alias("su_zip"),
        )
        return self.given("supplier").select(
            k.alias("su_suppkey"),
            _c("s_name").alias("su_name"),
            address.alias("su_address"),
            _big(FIRST_NATION + _c("s_nationkey")).alias("su_nationkey"),
            F.concat(_text(1 + k % 9), F.lit("-000")).alias("su_phone"),
            _c("s_acctbal").alias("su_acctbal"),
            F.when(k % 7 == 3, "x Customer y Complaints").otherwise("z").alias("su_comment"),
        )

    def _item(self) -> DataFrame:
        k = _c("p_partkey")
        label = F.concat_ws(" ", F.lower("p_type"), "p_name")
        data = F.concat(
            label, F.lit(" "), _letter(_big(F.floor(k / 26)) % 26), _letter(k % 26)
        )
        return self.given("part").select(
            k.alias("i_id"),
            _c("p_name").alias("i_name"),
            F.round(_c("p_retailprice") - 899.0, 2).alias("i_price"),
            F.transform(F.sequence(F.lit(0), _big(k % 2)), lambda n: F.concat(
                F.lit("category_"), F.lpad(_text(1 + (k + n * 13) % 127), 3, "0"))).alias("i_categories"),
            F.when(k % 10 == 0, F.concat(F.lit("ORIGINAL "), data)).otherwise(data).alias("i_data"),
            (1 + k % 10000).alias("i_im_id"),
        )

    # -- customers and what follows from them ---------------------------------------------

    def _customer(self) -> DataFrame:
        k = _c("c_custkey")

        def address(kind: Column, street: str, state: Column) -> Column:
            return F.struct(
                kind.alias("c_address_kind"),
                F.concat(F.lit(street), _text(k)).alias("c_street_1"),
                F.concat(F.lit("U"), _text(k % 7)).alias("c_street_2"),
                F.concat(F.lit("CITY"), _text(k % 50)).alias("c_city"),
                state.alias("c_state"),
                F.concat(F.lpad(_text(k % 10000), 4, "0"), F.lit("11111")).alias("c_zip"),
            )

        state = F.concat(_letter(_c("c_nationkey")), _letter(k % 26))
        others = F.slice(F.array(F.lit("home"), F.lit("work"), F.lit("billing")), F.lit(1), (k % 4).cast("int"))
        phones = F.slice(F.array(F.lit("home"), F.lit("work"), F.lit("mobile")), F.lit(1), (k % 3).cast("int"))
        phone = F.concat(_text(1 + k % 9), F.lit("-555"))
        return self.spread("customer", warehouse_of(k), district_of(k), customer_of(k)).select(
            customer_of(k).alias("c_id"),
            district_of(k).alias("c_d_id"),
            warehouse_of(k).alias("c_w_id"),
            ((k % 50) / F.lit(100.0)).alias("c_discount"),
            F.when(k % 10 == 0, "BC").otherwise("GC").alias("c_credit"),
            F.struct(
                F.concat(F.lit("F"), F.lpad(_text((k * 7919) % 100003), 6, "0")).alias("c_first"),
                F.lit("OE").alias("c_middle"),
                F.concat(F.lit("LAST"), _text(customer_of(k) % 7)).alias("c_last"),
            ).alias("c_name"),
            F.lit(50000.0).alias("c_credit_lim"),
            _c("c_acctbal").alias("c_balance"),
            F.lit(10.0).alias("c_ytd_payment"),
            _big(F.lit(1)).alias("c_payment_cnt"),
            _big(F.lit(0)).alias("c_delivery_cnt"),
            F.concat(
                F.array(address(F.lit("shipping"), "A", state)),
                F.transform(others, lambda kind: address(kind, "B", F.lit("zz"))),
            ).alias("c_addresses"),
            F.concat(
                F.array(F.struct(F.lit("contact").alias("c_phone_kind"), phone.alias("c_phone_number"))),
                F.transform(phones, lambda kind: F.struct(
                    kind.alias("c_phone_kind"), F.concat(F.lit("9-"), kind).alias("c_phone_number"))),
            ).alias("c_phones"),
            plus_days(ts("1995-01-01 00:00:00"), k % 1000).alias("c_since"),
            F.transform(F.sequence(F.lit(1), _big(1 + k % 3)), lambda n: F.concat(
                F.lit("category_"), F.lpad(_text(1 + (k + n * 5) % 127), 3, "0"))).alias("c_item_categories"),
            F.concat(F.lit("note "), F.repeat(_letter(k % 26), 490)).alias("c_data"),
        )

    def _history(self) -> DataFrame:
        k = _c("c_custkey")
        return self.given("customer").select(
            customer_of(k).alias("h_c_id"), district_of(k).alias("h_c_d_id"), warehouse_of(k).alias("h_c_w_id"),
            district_of(k).alias("h_d_id"), warehouse_of(k).alias("h_w_id"),
            plus_days(ts("1995-01-01 00:00:00"), k % 1000).alias("h_date"),
            F.lit(10.0).alias("h_amount"), F.concat(F.lit("H"), _text(k)).alias("h_data"),
        )

    def _warehouse(self) -> DataFrame:
        w = _c("w_id")
        address = F.struct(*[
            F.concat(F.lit(f"{p}-"), _text(w)).alias(f"w_{p}") for p in ("street_1", "street_2", "city", "state", "zip")
        ])
        return (
            self._history().groupBy(_c("h_w_id").alias("w_id"))
            .agg(F.sum(_c("h_amount").cast("decimal(18,2)")).cast("double").alias("w_ytd"))
            .select("w_id", "w_ytd", (w / F.lit(100.0)).alias("w_tax"), F.concat(F.lit("WH"), _text(w)).alias("w_name"),
                    address.alias("w_address"))
        )

    def _district(self) -> DataFrame:
        w, d = _c("d_w_id"), _c("d_id")
        address = F.struct(*[
            F.concat(F.lit(f"{p}-"), _text(d)).alias(f"d_{p}") for p in ("street_1", "street_2", "city", "state", "zip")
        ])
        k = _c("o_custkey")
        latest = self.given("orders").groupBy(warehouse_of(k).alias("d_w_id"), district_of(k).alias("d_id")).agg(
            F.max("o_orderkey").alias("last_o_id")
        )
        paid = self._history().groupBy(_c("h_w_id").alias("d_w_id"), _c("h_d_id").alias("d_id")).agg(
            F.sum(_c("h_amount").cast("decimal(18,2)")).cast("double").alias("d_ytd")
        )
        return paid.join(latest, ["d_w_id", "d_id"], "left").select(
            d, w, "d_ytd", ((d + w) / F.lit(200.0)).alias("d_tax"),
            (1 + F.coalesce("last_o_id", F.lit(0))).alias("d_next_o_id"),
            F.concat(F.lit("DI"), _text(d)).alias("d_name"), address.alias("d_address"),
        )

    # -- stock ----------------------------------------------------------------------------

    def _stock(self) -> DataFrame:
        """Every item in every warehouse; ``s_suppkey`` is the generated supplier column."""
        i, w = _c("s_i_id"), _c("s_w_id")
        rows = self.spread("part", _c("p_partkey")).select(
            _c("p_partkey").alias("s_i_id"),
            F.explode(F.sequence(_big(F.lit(1)), _big(F.lit(WAREHOUSES)))).alias("s_w_id"),
        )
        return rows.select(
            i, w,
            (10 + (i * 7 + w * 13) % 91).alias("s_quantity"),
            _big(F.lit(0)).alias("s_ytd"),
            (10 + (i * 11 + w * 17) % 2991).alias("s_order_cnt"),
            _big(F.floor((10 + (i * 11 + w * 17) % 2991) / 10)).alias("s_remote_cnt"),
            F.when((i + w) % 10 == 0, "ORIGINAL stock").otherwise("stock").alias("s_data"),
            F.transform(F.sequence(F.lit(1), F.lit(10)), lambda n: F.concat(
                F.lit("D"), _text(n), F.lit("-"), _text(i), F.lit("-"), _text(w))).alias("s_dists"),
            supplier_key(w, i, self.suppliers).alias("s_suppkey"),
        )

    # -- orders ---------------------------------------------------------------------------

    def _header(self) -> DataFrame:
        k, o = _c("o_custkey"), _c("o_orderkey")
        return self.given("orders").select(
            o.alias("o_id"),
            customer_of(k).alias("o_c_id"),
            district_of(k).alias("o_d_id"),
            warehouse_of(k).alias("o_w_id"),
            F.when(_c("o_orderstatus") == "O", _big(F.lit(0))).otherwise(1 + o % 10).alias("o_carrier_id"),
            _big(F.lit(1)).alias("o_all_local"),
            _c("o_orderdate").alias("o_entry_d"),
        )

    def _lines(self, placed: bool = False) -> DataFrame:
        """Given lines under the document names; delivery as days after the order date; ``placed`` adds where a line stands."""
        p, n = _c("l_partkey"), _c("l_linenumber")
        where = [_c("_metadata.file_name").alias("_file"), _c("_metadata.row_index").alias("_row")] if placed else []
        return self.given("lineitem").select(
            *where,
            _c("l_orderkey").alias("o_id"),
            _big(n - 1).alias("ol_number"),
            p.alias("ol_i_id"),
            (n % 5 == 0).alias("_remote"),
            (2 + (p * 7 + _c("l_suppkey") * 3 + n * 13) % 150).alias("_days"),
            _big(_c("l_quantity")).alias("ol_quantity"),
            _c("l_extendedprice").alias("ol_amount"),
        )

    @staticmethod
    def _line_fields(line: Callable[[str], Column] = _c) -> list[Column]:
        """Fields of an order line; ``line`` gives the columns of ``_lines`` by name."""
        w = _c("o_w_id")
        delivered = F.when(_c("o_carrier_id") > 0, plus_days(_c("o_entry_d"), line("_days")))
        return [
            line("ol_number").alias("ol_number"),
            line("ol_i_id").alias("ol_i_id"),
            F.when(line("_remote"), 1 + w % WAREHOUSES).otherwise(w).alias("ol_supply_w_id"),
            delivered.alias("ol_delivery_d"),
            line("ol_quantity").alias("ol_quantity"),
            line("ol_amount").alias("ol_amount"),
            F.concat(F.lit("D"), _text(_c("o_d_id"))).alias("ol_dist_info"),
        ]

    def documents(self, header: DataFrame, part_lines: int = PART_LINES) -> DataFrame:
        """Nested orders, in parts of about ``part_lines`` lines."""
        return self.nested(self.gathered(header, part_lines))

    def gathered(self, header: DataFrame, part_lines: int = PART_LINES) -> DataFrame:
        """Orders with their lines as given, a plain array per column: what need travel where documents are put in another order.

        Lines are dealt to parts by where they stand in their file, so that also lines that look alike spread. Both
        sides hash on order and part once; the grouping reuses that layout.
        """
        place = F.xxhash64("_file", "_row")
        parents, lines = in_parts(header, self._lines(placed=True), ["o_id"], "o_ol_cnt", place, part_lines)
        joined = parents.join(lines, ["o_id", PART], "left")
        # Days are from -147 to 151, whatever the keys.
        line = F.struct(*[_c(n).cast("smallint").alias(n) if n == "_days" else _c(n) for n in _GIVEN_LINE])
        grouped = joined.groupBy(*parents.columns).agg(F.collect_list(F.when(_c("ol_number").isNotNull(), line)).alias("_line"))
        return grouped.select(*parents.columns, *[_c("_line")[n].alias(f"_all_{n}") for n in _GIVEN_LINE])

    def nested(self, gathered: DataFrame) -> DataFrame:
        """Orders of ``gathered`` as documents, their lines in order."""
        lines = F.arrays_zip(*[f"_all_{n}" for n in _GIVEN_LINE])
        docs = gathered.withColumn("o_orderline", F.sort_array(F.transform(lines, lambda x: F.struct(*self._line_fields(lambda n: x[f"_all_{n}"])))))
        return docs.select(
            "o_id", "o_c_id", "o_d_id", "o_w_id", "o_carrier_id", "o_ol_cnt", "o_all_local", "o_entry_d", PART, PARTS, "o_orderline"
        )

    def _order_header(self) -> DataFrame:
        """Parent of the flat layout: line counts are aggregated, lines never gathered."""
        counts = self.given("lineitem").groupBy(_c("l_orderkey").alias("o_id")).agg(F.count("*").alias("o_ol_cnt"))
        return self._header().join(counts, "o_id", "left").fillna(0, ["o_ol_cnt"])

    def _orders_orderline(self) -> DataFrame:
        return self._header().join(self._lines(), "o_id").select("o_id", "o_d_id", "o_w_id", *self._line_fields())

    def _neworder(self) -> DataFrame:
        k = _c("o_custkey")
        return self.given("orders").where(_c("o_orderstatus") == "O").select(
            _c("o_orderkey").alias("no_o_id"), district_of(k).alias("no_d_id"), warehouse_of(k).alias("no_w_id")
        )
