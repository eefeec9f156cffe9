"""Order-dependent operators that never sort one whole key in one task.

A plain window over ``partitionBy(key).orderBy(n)`` hands all rows of a key to one task. These
operators cut every key into slices of the ordering column, work inside the slices, and combine
the slices by their (few) totals. Results are the same as those of the plain window.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.operators.changes import among_places
from ordermill.sources.workspace import fresh_path

SLICE = 65_536
# Keys are counted by a hash of so many values to find those that may have very many rows.
BUCKETS = 1 << 16
# A selection cuts a key at about this many of the rows it draws.
CUTS = 32
DRAWN = 256
BROADCAST_BYTES = 8 << 20


def running_total(rows: DataFrame, keys: list[str], order: list[str], values: dict[str, Column | str], slice_width: int = SLICE) -> DataFrame:
    """Add, per entry of ``values``, the sum over the earlier rows of the same key.

    ``order[0]`` is a running number (request number, order number); a slice spans
    ``slice_width`` of them. Further order columns break ties inside one number. The row itself
    is not included.
    """
    sliced = rows.withColumn("_slice", F.floor(F.col(order[0]) / slice_width))
    totals = sliced.groupBy(*keys, "_slice").agg(
        *[F.sum(F.expr(v) if isinstance(v, str) else v).alias(f"_sum_{n}") for n, v in values.items()]
    )
    slices = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys, "_slice", *[F.coalesce(F.sum(f"_sum_{n}").over(slices), F.lit(0)).alias(f"_start_{n}") for n in values]
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = sliced.join(starts, [*keys, "_slice"])
    out = {}
    for name, value in values.items():
        value = F.expr(value) if isinstance(value, str) else value
        out[name] = F.col(f"_start_{name}") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return joined.withColumns(out).drop("_slice", *[f"_start_{n}" for n in values])


def crowded(rows: DataFrame, keys: list[Column], bound: int = SLICE, buckets: int = BUCKETS) -> Column | None:
    """Whether a key may have more than ``bound`` of ``rows``, never false for one that has; none if no key has so many.

    Counted are the hashes of keys, at most ``buckets`` numbers per task, so that keys themselves are not shuffled.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    counts = rows.groupBy(place.alias("place")).agg(F.count("*").alias("_n"))
    many = counts.where(F.col("_n") > bound).select("place")
    return None if many.isEmpty() else among_places(many, place, buckets)


def total_in_one_task(rows: DataFrame, keys: list[str], order: list[str], values: dict[str, Column]) -> DataFrame:
    """``running_total`` by a plain window, for keys that are not ``crowded``: rows that already lie by key stay there."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns({name: F.coalesce(F.sum(value).over(before), F.lit(0)) for name, value in values.items()})


def row_at(rows: DataFrame, keys: list[str], text: str, tie: str, place: Column, bound: int = SLICE) -> DataFrame:
    """The row at a 0-based place of each key, ordered by ``text`` then ``tie`` (unique within its key).

    ``place`` is an expression of ``_n``, the rows of the key; keys without that place have no row. Keys of more
    than ``bound`` rows are cut at rows drawn by a hash, the pieces are counted, and only the piece that
    holds the place goes on, until all pieces are small enough to be sorted: an exact selection in a few rounds,
    whatever the texts look like. Rows that are equal in ``text`` and ``tie`` cannot be cut; they end up in one sort.
    """
    spark = rows.sparkSession
    groups = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.max(F.octet_length(F.col(text).cast("string"))).alias("_longest"))
    groups = groups.withColumn("_offset", place.cast("bigint")).where((F.col("_offset") >= 0) & (F.col("_offset") < F.col("_n")))
    state, width = rows, None
    for turn in itertools.count():
        # What the small sides of the joins below hold: known before they may be broadcast.
        known = groups.agg(F.max("_n"), F.count("*"), F.max("_longest")).first()
        largest, count, longest = known[0] or 0, known[1], known[2] or 0
        small = F.broadcast if count * CUTS * (longest + 64) <= BROADCAST_BYTES else lambda side: side
        state = state.join(small(groups.drop("_longest")), keys)
        if largest <= bound or largest == width:
            break
        width = largest
        row = F.struct(text, tie)
        drawn = state.where((F.col("_n") > bound) & (F.pmod(F.xxhash64(F.lit(turn), text, tie), F.ceil(F.col("_n") / DRAWN)) == 0))
        drawn = drawn.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("_drawn"))
        step = F.greatest(F.lit(1), F.ceil(F.size("_drawn") / CUTS)).cast("int")
        cuts = drawn.select(*keys, F.filter("_drawn", lambda x, i: i % step == 0).alias("_cuts"))
        # Piece 2 i lies behind i cuts, piece 2 i + 1 is the cut behind them itself.
        passed = F.size(F.filter("_cuts", lambda x: x < row)) * 2
        piece = F.coalesce(passed + F.exists("_cuts", lambda x: x == row).cast("int"), F.lit(0)).alias("_piece")
        pieces = state.join(small(cuts), keys, "left").select(*rows.columns, *[n for n in ("_offset",) if n not in rows.columns], piece)
        pieces.write.parquet(path := fresh_path(spark, "selection"))
        pieces = spark.read.parquet(path)
        counts = pieces.groupBy(*keys, "_offset", "_piece").agg(F.count("*").alias("_n"), F.max(F.octet_length(F.col(text).cast("string"))).alias("_longest"))
        before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        counts = counts.where((F.col("_before") <= F.col("_offset")) & (F.col("_offset") < F.col("_before") + F.col("_n")))
        chosen = counts.select(*keys, "_piece", "_n", "_longest", (F.col("_offset") - F.col("_before")).alias("_offset"))
        state = pieces.drop("_offset").join(small(chosen.select(*keys, "_piece")), [*keys, "_piece"], "left_semi").drop("_piece")
        groups = chosen.drop("_piece")
    ranked = state.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(text, tie)))
    return ranked.where(F.col("_rank") - 1 == F.col("_offset")).select(rows.columns)


def middle_row(rows: DataFrame, keys: list[str], text: str, tie: str, bound: int = SLICE) -> DataFrame:
    """The row at 0-based place floor((n - 1) / 2) of each key, ordered by ``text`` then ``tie``."""
    return row_at(rows, keys, text, tie, F.floor((F.col("_n") - 1) / 2), bound)


def smallest_rows(rows: DataFrame, n: int, text: str, tie: str, bound: int = SLICE) -> DataFrame:
    """The ``n`` smallest rows by ``text`` then ``tie`` (neither null), without gathering them in one task: those up to the n-th."""
    last = row_at(rows.select(text, tie).withColumn("_all", F.lit(0)), ["_all"], text, tie, F.lit(n - 1), bound).first()
    if last is None:
        return rows if n > 0 else rows.where("false")
    return rows.where(F.struct(text, tie) <= F.struct(F.lit(last[text]).alias(text), F.lit(last[tie]).alias(tie)))
