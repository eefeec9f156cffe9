"""Statistics of every column of a table, nested fields included, that can be merged over pieces of a table.

Per column: rows, nulls, smallest and largest value exactly; the number of distinct values and quantiles from sketches, which
are of bounded size and merge. A column is named by its path, ``c_name.c_last`` or, inside an array,
``o_orderline[].ol_amount``, whose rows are the elements. Plain and struct columns are one aggregate over the
table, each array one more over its elements; as columns are read apart, every one of them is read once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

c = F.col
_VALUES = ["column_name", "row_count", "null_count", "min_number", "max_number", "min_text", "max_text", "distinct_sketch", "quantile_sketch"]


def _leaves(schema: T.StructType, path: str = "") -> list[tuple[str, T.DataType]]:
    """Paths and types of the columns below ``schema``; an array is one."""
    found = []
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            found += _leaves(field.dataType, f"{path}{field.name}.")
        else:
            found.append((f"{path}{field.name}", field.dataType))
    return found


def _quoted(path: str) -> Column:
    return c(".".join(f"`{name}`" for name in path.split(".")))


def _summed(rows: DataFrame, columns: list[tuple[str, Column, T.DataType]]) -> DataFrame:
    """One aggregate over ``rows``, turned into a row per column."""
    flat = rows.select(*[value.alias(f"v{n}") for n, (_, value, _) in enumerate(columns)])
    sums: list[Column] = [F.count("*").alias("_rows")]
    shown = []
    for n, (name, _, kind) in enumerate(columns):
        value, number = c(f"v{n}"), isinstance(kind, T.NumericType)
        text = value.cast("string")
        sums += [F.count(value).alias(f"n{n}"), F.min(value).alias(f"lo{n}"), F.max(value).alias(f"hi{n}"), F.hll_sketch_agg(text).alias(f"d{n}")]
        if number:
            sums.append(F.kll_sketch_agg_double(value.cast("double")).alias(f"q{n}"))
        low, high = c(f"lo{n}"), c(f"hi{n}")
        nothing = F.lit(None)
        shown.append(F.struct(
            F.lit(name).alias("column_name"), c("_rows").alias("row_count"), (c("_rows") - c(f"n{n}")).alias("null_count"),
            (low if number else nothing).cast("double").alias("min_number"), (high if number else nothing).cast("double").alias("max_number"),
            (nothing if number else low).cast("string").alias("min_text"), (nothing if number else high).cast("string").alias("max_text"),
            c(f"d{n}").alias("distinct_sketch"), (c(f"q{n}") if number else nothing).cast("binary").alias("quantile_sketch"),
        ))
    return flat.agg(*sums).select(F.explode(F.array(*shown)).alias("s")).select("s.*")


def column_statistics(table: str, rows: DataFrame, elements: DataFrame | None = None) -> DataFrame:
    """A row per column of ``rows``. Arrays are read from ``elements`` where a table holds some rows in parts."""
    elements = rows if elements is None else elements
    plain = [(path, kind) for path, kind in _leaves(rows.schema) if not isinstance(kind, (T.ArrayType, T.MapType))]
    pieces = [_summed(rows, [(path, _quoted(path), kind) for path, kind in plain])] if plain else []
    for path, kind in _leaves(elements.schema):
        if isinstance(kind, T.ArrayType):
            inside = kind.elementType
            item = elements.select(F.explode(_quoted(path)).alias("item"))
            if isinstance(inside, T.StructType):
                held = [(f"{path}[].{p}", _quoted(f"item.{p}"), k) for p, k in _leaves(inside) if not isinstance(k, (T.ArrayType, T.MapType))]
            else:
                held = [(f"{path}[]", c("item"), inside)]
            if held:
                pieces.append(_summed(item, held))
    return reduce(DataFrame.unionByName, pieces).select(F.lit(table).alias("table_name"), *_VALUES)


def merged(pieces: DataFrame) -> DataFrame:
    """Statistics of several pieces of the same tables as those of the whole. At most one row per column and piece meets."""
    return pieces.groupBy("table_name", "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"),
        F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.reduce(F.collect_list("quantile_sketch"), F.lit(None).cast("binary"),
                 lambda a, b: F.when(a.isNull(), b).otherwise(F.kll_sketch_merge_double(a, b))).alias("quantile_sketch"),
    )


def described(statistics: DataFrame, ranks: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The sketches as numbers: ``distinct_estimate`` and the quantiles at ``ranks`` (null for texts and columns without values)."""
    filled = c("quantile_sketch").isNotNull() & (c("row_count") > c("null_count"))
    quantiles = F.when(filled, F.array(*[F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(r)) for r in ranks]))
    return statistics.withColumns({"distinct_estimate": F.hll_sketch_estimate("distinct_sketch"), "quantiles": quantiles}).drop("distinct_sketch", "quantile_sketch")
