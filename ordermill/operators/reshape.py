"""Moving documents between the nested and the flat layouts.

Four layouts of the same data:

=========  ==================================================================
nested     structs and arrays as filed
single     nested, but only the first address and phone; no categories
toplevel   name, first address and first phone as plain columns; order lines nested
flat       everything plain; arrays become child tables keyed by the parent
=========  ==================================================================

All are map-side projections except ``nest``, which groups rows into documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators.changes import key_filter

_STRUCTS = {
    "warehouse": ["w_address"],
    "district": ["d_address"],
    "supplier": ["su_address"],
    "customer": ["c_name"],
}
# table -> [(child table, array column, key columns, name of a scalar element)]
_CHILDREN = {
    "orders": [("orders_orderline", "o_orderline", ["o_id", "o_d_id", "o_w_id"], None)],
    "customer": [
        ("customer_addresses", "c_addresses", ["c_id", "c_d_id", "c_w_id"], None),
        ("customer_phones", "c_phones", ["c_id", "c_d_id", "c_w_id"], None),
        ("customer_item_categories", "c_item_categories", ["c_id", "c_d_id", "c_w_id"], "c_item_category"),
    ],
    "item": [("item_categories", "i_categories", ["i_id"], "i_category")],
}
_CATEGORIES = {"customer": "c_item_categories", "item": "i_categories"}
DISTS = 10


def flatten_structs(table: str, df: DataFrame) -> DataFrame:
    """Struct columns become their fields; the ten district texts of stock become columns."""
    wide: list[Column | str] = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType) and field.name in _STRUCTS.get(table, []):
            wide += [F.col(f"{field.name}.{inner}").alias(inner) for inner in field.dataType.fieldNames()]
        elif table == "stock" and field.name == "s_dists":
            wide += [F.get("s_dists", F.lit(n)).alias(f"s_dist_{n + 1:02d}") for n in range(DISTS)]
        else:
            wide.append(F.col(field.name))
    return df.select(*wide)


def keep_first(table: str, df: DataFrame) -> DataFrame:
    """Nested form with only the first address and phone and without categories."""
    if table == "customer":
        df = df.withColumns({a: F.slice(a, 1, 1) for a in ("c_addresses", "c_phones")})
    return df.drop(_CATEGORIES[table]) if table in _CATEGORIES else df


def to_toplevel(table: str, df: DataFrame) -> DataFrame:
    """One row, one address, one phone: arrays of a customer shrink to their first element.

    The single phone column is called ``c_phone``, and the address kind is dropped, as every
    first address is the shipping one. The supplier keeps one address text.
    """
    if table == "customer":
        first, phone = F.get("c_addresses", F.lit(0)), F.get("c_phones", F.lit(0))
        parts = ["c_street_1", "c_street_2", "c_city", "c_state", "c_zip"]
        df = df.withColumns({p: first[p] for p in parts} | {"c_phone": phone["c_phone_number"]})
        df = df.drop("c_addresses", "c_phones")
    if table == "supplier":
        df = df.withColumn("su_address", F.concat_ws(" ", "su_address.*"))
    if table in _CATEGORIES:
        df = df.drop(_CATEGORIES[table])
    return flatten_structs(table, df)


def explode_children(table: str, df: DataFrame) -> dict[str, DataFrame]:
    """Child tables of one document table, each row carrying the key of its parent."""
    children = {}
    for name, array, keys, scalar in _CHILDREN.get(table, []):
        element = F.explode(array).alias(scalar or "element")
        rows = df.select(*keys, element)
        children[name] = rows if scalar else rows.select(*keys, "element.*")
    return children


def to_flat(table: str, df: DataFrame) -> dict[str, DataFrame]:
    """The fully flat form: the parent without its arrays, and the child tables."""
    arrays = [array for _, array, _, _ in _CHILDREN.get(table, [])]
    return {table: flatten_structs(table, once_each(df).drop(*arrays))} | explode_children(table, df)


def nest(rows: DataFrame, parent: list[str], fields: list[Column | str], into: str, present: Column | None = None) -> DataFrame:
    """Rows to documents: one row per ``parent`` with a sorted array of structs.

    ``present`` marks rows that stand for an element; a parent whose rows are all absent gets
    an empty array, so an outer join can feed this directly. Elements sort by their fields in
    the given order. A parent may have any number of rows only where it is cut into parts first, see ``in_parts``.
    """
    element = F.struct(*fields)
    if present is not None:
        element = F.when(present, element)
    return rows.groupBy(*parent).agg(F.sort_array(F.collect_list(element)).alias(into))


# -- documents in parts --------------------------------------------------------------------
#
# A document may have more elements than one row should hold. It is then filed as several rows of the same key,
# numbered by ``o_part`` from 0, each with about PART_LINES elements and all other columns of the
# document; ``o_parts`` is their number. What is asked of a document is folded inside its parts, and only documents
# of several parts meet in a grouping.

PART_LINES = 10_000
PART, PARTS = "o_part", "o_parts"


def number_of_parts(elements: Column, part_lines: int = PART_LINES) -> Column:
    """Parts of a document of so many elements: one at least."""
    return F.greatest(F.lit(1), F.ceil(elements / part_lines)).cast("bigint")


def in_parts(parent: DataFrame, child: DataFrame, keys: list[str], count: str, spread: Column, part_lines: int = PART_LINES) -> tuple[DataFrame, DataFrame]:
    """Both sides with the number of their part: ``parent`` once per part, ``child`` rows dealt by the hash ``spread``.

    ``count`` is the column of ``parent`` with the number of children. The keys of documents that have several parts are
    joined to the child rows that may be theirs (see ``operators/changes.py``); all others are part 0. A key with very many rows so meets its parent in as many groups as it has parts.
    """
    numbered = parent.withColumn(PARTS, number_of_parts(F.col(count), part_lines))
    several = numbered.where(F.col(PARTS) > 1).select(*keys, F.col(PARTS).alias("_parts"))
    # Children that cannot be of a document of several parts are not shuffled to find that out; null keys have no document.
    may = F.coalesce(key_filter(child, several, keys), F.lit(False))
    dealt = child.where(may).join(several, keys, "left").withColumn(PART, F.coalesce(F.pmod(spread, F.col("_parts")), F.lit(0)).cast("bigint"))
    dealt = dealt.select(*child.columns, PART).unionByName(child.where(~may).withColumn(PART, F.lit(0).cast("bigint")))
    return numbered.withColumn(PART, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(PARTS) - 1))), dealt


def with_parts(docs: DataFrame) -> DataFrame:
    """Documents with the part columns; a table without them holds whole documents."""
    return docs if PART in docs.columns else docs.withColumns({PART: F.lit(0).cast("bigint"), PARTS: F.lit(1).cast("bigint")})


def filed_parts(docs: DataFrame) -> DataFrame:
    """The part columns null for whole documents, as file formats leave out null fields."""
    several = F.col(PARTS) > 1
    return docs.withColumns({name: F.when(several, F.col(name)) for name in (PART, PARTS)}) if PART in docs.columns else docs


def read_parts(docs: DataFrame) -> DataFrame:
    """Inverse of ``filed_parts``."""
    return docs.withColumns({PART: F.coalesce(PART, F.lit(0)), PARTS: F.coalesce(PARTS, F.lit(1))}) if PART in docs.columns else docs


# -- delivery zones ------------------------------------------------------------------------
#
# Scans cannot skip rows by what is inside an array. A stored order therefore carries the first and the last delivery
# of its lines (of its part) as plain columns; files that are ranged by entry date have narrow zones.

FIRST_DELIVERY, LAST_DELIVERY = "o_first_delivery", "o_last_delivery"
ZONES = (FIRST_DELIVERY, LAST_DELIVERY)


def with_zones(orders: DataFrame) -> DataFrame:
    deliveries = "o_orderline.ol_delivery_d"
    return orders.withColumns({FIRST_DELIVERY: F.array_min(deliveries), LAST_DELIVERY: F.array_max(deliveries)})


def in_zone(orders: DataFrame, low: Column | None, high: Column | None) -> DataFrame:
    """Orders that may have a line delivered from ``low`` to ``high``; all where zones are not known."""
    if FIRST_DELIVERY not in orders.columns:
        return orders
    orders = orders if low is None else orders.where(F.col(LAST_DELIVERY) >= low)
    return orders if high is None else orders.where(F.col(FIRST_DELIVERY) <= high)


def once_each(docs: DataFrame) -> DataFrame:
    """One row per document, without the part columns: that of part 0."""
    return docs.where(F.col(PART) == 0).drop(PART, PARTS) if PART in docs.columns else docs


def folded(docs: DataFrame, columns: list[str], values: dict[str, tuple[Column, Callable[[str], Column]]]) -> DataFrame:
    """One row per document: ``columns`` and, per entry of ``values``, a fold of the document.

    A value is (fold inside a part, aggregate that joins the parts' results). Whole documents are projected
    alone; those of several parts are grouped by ``columns``, which must determine the document.
    """
    inside = with_parts(docs).withColumns({name: value for name, (value, _) in values.items()})
    whole = inside.where(F.col(PARTS) == 1).select(*columns, *values)
    several = inside.where(F.col(PARTS) > 1).groupBy(*columns).agg(*[merge(name).alias(name) for name, (_, merge) in values.items()])
    return whole.unionByName(several)


def nest_children(parent: DataFrame, child: DataFrame, keys: list[str], into: str, part_lines: int | None = None, count: str | None = None) -> DataFrame:
    """Inverse of ``explode_children``: attach a child table to its parent as an array.

    With ``part_lines`` documents are in parts; ``count`` then names the parent's column with the number of children.
    """
    fields = [c for c in child.columns if c not in keys]
    if part_lines is not None:
        parent, child = in_parts(parent, child, keys, count, F.xxhash64(*fields), part_lines)
        keys = [*keys, PART]
    marked = child.withColumn("_there", F.lit(True))
    joined = parent.join(marked, keys, "left")
    return nest(joined, parent.columns, fields, into, present=F.col("_there").isNotNull())
