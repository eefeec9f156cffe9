"""Stored document tables: loaded once, then queried many times.

A store hands out tables by name. Two kinds:

``FolderStore``   reads Parquet tables under one folder (for example the output of ``synth``)
``LoadedStore``   derives tables from the given relational ones and writes each, on first use,
                  below the shared folder of the session; every later query scans the file

Loading first is how the data is used at size: the shuffle that groups lines into documents is
paid once and not by each of the queries, and scans can prune columns and row groups.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.reshape import PART, PART_LINES, ZONES, to_flat, to_toplevel, with_zones
from ordermill.sources.bridge import Bridge
from ordermill.sources.schemas import PRIMARY_KEYS, SUPPLIERS
from ordermill.sources.workspace import fresh_path

# Row order inside each file, so that min/max statistics let date ranges skip row groups.
CLUSTERING = {
    "orders": ["o_entry_d"],
    "orders_header": ["o_entry_d"],
    "orders_orderline": ["ol_delivery_d"],
    "stock": ["s_w_id", "s_i_id"],
    "customer": ["c_w_id", "c_d_id", "c_id"],
}

_FLAT_PARTS = {
    "customer_flat": ("customer", "customer"),
    "customer_addresses": ("customer", "customer_addresses"),
    "customer_phones": ("customer", "customer_phones"),
    "customer_item_categories": ("customer", "customer_item_categories"),
    "item_flat": ("item", "item"),
    "item_categories": ("item", "item_categories"),
    "stock_flat": ("stock", "stock"),
    "supplier_flat": ("supplier", "supplier"),
    "warehouse_flat": ("warehouse", "warehouse"),
    "district_flat": ("district", "district"),
}


# Files of these tables are ranges of their rows; the key behind the date splits a date of very many rows.
RANGED = {"orders": ["o_entry_d", "o_w_id", "o_d_id", "o_id", PART]}


# Large tables that are asked for single keys: their rows carry a hash of the key, which Parquet keeps Bloom filters of.
KEYED = ("customer", "item", "neworder", "orders", "stock")
ROW_KEY = "row_key"
COMPRESSION = "zstd"


def key_hash(table: str) -> Column:
    return F.xxhash64(*[F.col(k).cast("bigint") for k in PRIMARY_KEYS[table]])


def as_stored(df: DataFrame, table: str) -> DataFrame:
    """Rows with the plain columns that let scans skip files and row groups: delivery zones of orders, hashes of keys."""
    if table == "orders" and "o_orderline" in df.columns:
        df = with_zones(df)
    return df.withColumn(ROW_KEY, key_hash(table)) if table in KEYED and set(PRIMARY_KEYS[table]) <= set(df.columns) else df


def write_table(df: DataFrame, path: str, table: str = "", finished: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Parquet rows in clustering order, orders in date ranges, with the columns of ``as_stored``.

    ``finished`` makes the rows of the table from those of ``df`` when they are in their range: derived columns do not travel.
    Every row group has a Bloom filter of its key hashes, of at most Parquet's one megabyte. Hashes are not
    put in a dictionary, which would be as large as they are.
    """
    if table in RANGED:
        df = df.repartitionByRange(*[c for c in RANGED[table] if c in df.columns])
    df = as_stored(finished(df), table)
    keys = [c for c in CLUSTERING.get(table, []) if c in df.columns]
    writer = (df.sortWithinPartitions(*keys) if keys else df).write.option("compression", COMPRESSION)
    if ROW_KEY in df.columns:
        bloom = {"bloom.filter.enabled": "true", "bloom.filter.adaptive.enabled": "true", "enable.dictionary": "false"}
        writer = writer.options(**{f"parquet.{k}" + ("" if "adaptive" in k else f"#{ROW_KEY}"): v for k, v in bloom.items()})
    writer.parquet(path)


class FolderStore:
    """Parquet tables under one folder; ``suppliers`` is the modulus of the supplier rule.
    Its documents are whole or in parts, see ``operators/reshape.py``."""

    def __init__(self, spark: SparkSession, folder: str, suppliers: int = SUPPLIERS):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.suppliers = suppliers
        self._tables: dict[str, DataFrame] = {}

    def keyed(self, name: str) -> DataFrame:
        """The table as written, with delivery zones and key hashes if it has them."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}")
        return self._tables[name]

    def zoned(self, name: str) -> DataFrame:
        return self.keyed(name).drop(ROW_KEY)

    def table(self, name: str) -> DataFrame:
        return self.zoned(name).drop(*ZONES)


class LoadedStore:
    """Document tables of one folder of given tables, written on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, part_lines: int = PART_LINES):
        self.spark = spark
        self.part_lines = part_lines
        self.bridge = Bridge(spark, sf_dir)
        self.folder = fresh_path(spark, "store")
        self._tables: dict[str, DataFrame] = {}
        self._lock = RLock()

    @property
    def suppliers(self) -> int:
        return self.bridge.suppliers

    def _derive(self, name: str) -> DataFrame:
        if name == "orders_header":
            return self.bridge.table("order_header")
        if name == "orders":
            return self.bridge.gathered(self.table("orders_header"), self.part_lines)
        if name == "toplevel_customer":
            return to_toplevel("customer", self.table("customer"))
        if name in _FLAT_PARTS:
            parent, part = _FLAT_PARTS[name]
            return to_flat(parent, self.table(parent))[part]
        return self.bridge.table(name)

    def _finished(self, name: str) -> Callable[[DataFrame], DataFrame]:
        """What is left to do when the rows of ``_derive`` are where they are stored."""
        return self.bridge.nested if name == "orders" else lambda rows: rows

    def kept(self, rows: DataFrame, label: str) -> DataFrame:
        """``rows`` as written under this label: by the first call; later ones read what that wrote."""
        with self._lock:
            key = f"kept/{label}"
            if key not in self._tables:
                rows.write.option("compression", COMPRESSION).parquet(f"{self.folder}/{key}")
                self._tables[key] = self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{key}")
            return self._tables[key]

    def close(self) -> None:
        """Delete what was written; tables handed out earlier cannot be read any more."""
        with self._lock:
            self._tables.clear()
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def table(self, name: str) -> DataFrame:
        return self.zoned(name).drop(*ZONES)

    def zoned(self, name: str) -> DataFrame:
        """The table with delivery zones if it has them."""
        return self.keyed(name).drop(ROW_KEY)

    def keyed(self, name: str) -> DataFrame:
        """The table as written; files are listed once and the schema is known without reading."""
        with self._lock:
            if name not in self._tables:
                path = f"{self.folder}/{name}"
                derived, finished = self._derive(name), self._finished(name)
                write_table(derived, path, name, finished)
                self._tables[name] = self.spark.read.schema(as_stored(finished(derived), name).schema).parquet(path)
            return self._tables[name]


_stores: dict[tuple[str, str], LoadedStore] = {}
_stores_lock = RLock()


def loaded_store(spark: SparkSession, sf_dir: str) -> LoadedStore:
    """The store of this session for one folder of given tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _stores_lock:
        if key not in _stores:
            _stores[key] = LoadedStore(spark, sf_dir)
        return _stores[key]


def refresh(spark: SparkSession, sf_dir: str) -> None:
    """Forget the store of a folder whose given tables have changed; its files are deleted and the next use loads anew."""
    with _stores_lock:
        store = _stores.pop((spark.sparkContext.applicationId, sf_dir), None)
    if store is not None:
        store.close()
