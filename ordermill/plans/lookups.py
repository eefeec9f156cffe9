"""Key lookups and time ranges: all requests of a workload answered by one job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.expr import epoch_seconds
from ordermill.operators.ordering import smallest_rows
from ordermill.sources.schemas import PRIMARY_KEYS
from ordermill.sources.store import ROW_KEY, key_hash

c = F.col


def lookup(table: str, rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of a table by primary key. ``keys`` has the key columns and whatever identifies the
    request; equal keys are answered once each. Catalyst broadcasts the keys if they are few and
    otherwise joins by key, with a runtime filter on the scan."""
    return keys.join(rows, PRIMARY_KEYS[table])


#: Up to so many keys, a lookup tells the scan which key hashes it wants. Scans compare at most ten values of one IN with Bloom filters.
MOST_POINTS, VALUES_OF_IN = 200, 10


def lookup_points(store, table: str, keys: DataFrame) -> DataFrame:
    """``lookup`` in a stored table, made for few keys (hand them over as a table that is cheap to read).

    With MOST_POINTS keys at most, their hashes go into the scan's filter, and row groups whose Bloom filter holds none
    of them are skipped; the join by key decides. More keys, or a table without hashes, make it the plain lookup. Rows with null keys match nothing.
    """
    rows = store.keyed(table)
    if ROW_KEY in rows.columns:
        few = keys.dropna(subset=PRIMARY_KEYS[table]).select(key_hash(table).alias(ROW_KEY)).limit(MOST_POINTS + 1).collect()
        if len(few) <= MOST_POINTS:
            wanted = sorted({r[0] for r in few})
            runs = [c(ROW_KEY).isin(wanted[i: i + VALUES_OF_IN]) for i in range(0, len(wanted), VALUES_OF_IN)]
            rows = rows.where(reduce(Column.__or__, runs, F.lit(False)))
        rows = rows.drop(ROW_KEY)
    return lookup(table, rows, keys)


def order_lines_by_key(orders: DataFrame, keys: DataFrame) -> DataFrame:
    """Order lines and entry date of orders by (warehouse, district, order)."""
    return lookup("orders", orders.select(*PRIMARY_KEYS["orders"], "o_orderline", "o_entry_d"), keys)


def key_range(spark, first: int, last: int, **fixed: int) -> DataFrame:
    """Key table for a workload over a run of ids: ``key_range(spark, 1, 100, o_w_id=1, o_d_id=1)``
    gives ``k`` with the fixed key columns beside it."""
    return spark.range(first, last + 1).select(c("id").alias("k"), *[F.lit(v).cast("bigint").alias(n) for n, v in fixed.items()])


def sample_key_space(spark, n: int, w: tuple[int, int], d: tuple[int, int], o: tuple[int, int], seed: int = 0,
                     names: list[str] = PRIMARY_KEYS["orders"]) -> DataFrame:
    """``n`` distinct keys drawn evenly from a box of (warehouse, district, order) numbers.

    Every position of the box gets a digest; the ``n`` smallest digests win. Warehouse varies
    slowest, order fastest.
    """
    d_span, o_span = d[1] - d[0] + 1, o[1] - o[0] + 1
    total = (w[1] - w[0] + 1) * d_span * o_span
    if not 1 <= n <= total:
        raise ValueError(f"n must be between 1 and {total}")
    flat = spark.range(total).withColumn("digest", F.md5(F.concat(F.lit(f"{seed}:"), c("id").cast("string"))))
    chosen = smallest_rows(flat, n, "digest", "id")
    rest = F.floor(c("id") / o_span)
    return chosen.select(
        (w[0] + F.floor(rest / d_span)).alias(names[0]),
        (d[0] + rest % d_span).alias(names[1]),
        (o[0] + c("id") % o_span).alias(names[2]),
    )


#: Levels that any range of 64-bit numbers is covered by.
_LEVELS = 63


def dyadic_cover(low: Column, high: Column) -> Column:
    """The whole numbers from ``low`` to ``high`` as few blocks (level, block): ``block`` spans 2**level of them and starts at a multiple.

    From level to level an end that is no boundary of the next level gives its block away, so that a range of n
    numbers has at most two blocks per level, and about log2(n) levels. An empty range has none.
    """
    def step(state: Column, level: Column) -> Column:
        a, b = state["a"], state["b"]
        left = (a <= b) & (F.pmod(a, F.lit(2)) == 1)
        rest = F.when(left, a + 1).otherwise(a)
        right = (rest <= b) & (F.pmod(b, F.lit(2)) == 0)
        back = F.when(right, b - 1).otherwise(b)
        blocks = F.filter(
            F.array(F.when(left, F.struct(level.alias("level"), a.alias("block"))), F.when(right, F.struct(level.alias("level"), b.alias("block")))),
            lambda x: x.isNotNull(),
        )
        over = rest > back
        return F.struct(
            F.when(over, F.lit(1).cast("bigint")).otherwise(F.shiftright(rest, 1)).alias("a"),
            F.when(over, F.lit(0).cast("bigint")).otherwise(F.shiftright(back, 1)).alias("b"),
            F.concat(state["blocks"], blocks).alias("blocks"),
        )

    empty = F.array().cast("array<struct<level:int,block:bigint>>")
    start = F.struct(low.cast("bigint").alias("a"), high.cast("bigint").alias("b"), empty.alias("blocks"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(_LEVELS)), start, step, lambda state: state["blocks"])


def orders_in_windows(orders: DataFrame, windows: DataFrame, bin_minutes: int = 60) -> DataFrame:
    """Orders strictly inside time windows (columns ``low`` and ``high``).

    Time is cut into bins. The bins a window touches are covered by few dyadic blocks, an order lies in one
    block of every level, and the two meet by equality on level and block before the exact comparison: a window of
    ten years is tens of rows. Orders are repeated only for the levels that occur, which is one if all windows are short.
    """
    width = bin_minutes * 60

    def bin_of(ts):
        return F.floor(epoch_seconds(ts) / width)

    spread = windows.withColumn("_at", F.explode(dyadic_cover(bin_of(c("low")), bin_of(c("high")))))
    spread = spread.withColumns({"_level": c("_at.level"), "_block": c("_at.block")}).drop("_at")
    levels = sorted(r[0] for r in spread.select("_level").distinct().collect())  # 64 at most
    here = [F.struct(F.lit(n).alias("level"), F.shiftright(bin_of(c("o_entry_d")), n).alias("block")) for n in levels or [0]]
    placed = orders.withColumn("_at", F.explode(F.array(*here)))
    placed = placed.withColumns({"_level": c("_at.level"), "_block": c("_at.block")}).drop("_at")
    inside = (c("o_entry_d") > c("low")) & (c("o_entry_d") < c("high"))
    return placed.join(spread, ["_level", "_block"]).where(inside).drop("_level", "_block")


def window_counts(orders: DataFrame, windows: DataFrame, by: list[str], bin_minutes: int = 60) -> DataFrame:
    """Number of orders per window. Orders are counted per exact time first, so that many orders
    at one time meet the windows as one row. Windows without orders count zero."""
    per_time = orders.groupBy("o_entry_d").agg(F.count("*").alias("_n"))
    found = orders_in_windows(per_time, windows, bin_minutes).groupBy(*by).agg(F.sum("_n").alias("orders"))
    return windows.select(*by).join(found, by, "left").fillna(0, ["orders"])
