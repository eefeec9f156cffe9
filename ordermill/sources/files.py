"""Reading and writing the document files, and checks on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.sources.schemas import (
    CUSTOMERS_PER_DISTRICT, DISTRICTS_PER_WAREHOUSE, ITEMS, NEW_ORDERS_PER_DISTRICT, PRIMARY_KEYS, SUPPLIERS,
    document_schema, typed_dates,
)

c = F.col

# Shard bound of the document writer, objects per store upload.
SHARD_BYTES = 256 * 1024
ROWS_PER_OBJECT = 10_000


# -- sources ----------------------------------------------------------------------------------


def read_documents(spark: SparkSession, root: str, table: str, extra_fields: int = 0, typed: bool = True) -> DataFrame:
    """JSON-lines shards of one data set from ``root/table``, in folders or not, read with its schema."""
    rows = spark.read.schema(document_schema(table, extra_fields=extra_fields, parts=True)).option("recursiveFileLookup", True).json(f"{root.rstrip('/')}/{table}")
    return typed_dates(table, rows) if typed else rows


def read_flat_directory(spark: SparkSession, folder: str, table: str, extra_fields: int = 0, typed: bool = True) -> DataFrame:
    """All ``*.json`` files of one flat folder as one data set."""
    reader = spark.read.schema(document_schema(table, extra_fields=extra_fields, parts=True))
    rows = reader.option("pathGlobFilter", "*.json").json(folder)
    return typed_dates(table, rows) if typed else rows


# -- sinks ------------------------------------------------------------------------------------


def write_json_shards(df: DataFrame, path: str, shard_bytes: int = SHARD_BYTES, order: list[str] | None = None) -> None:
    """JSON lines in files of at most ``shard_bytes`` (or one document, if that is larger), one folder per shard.

    One pass: every task of the scan adds up the bytes of its documents, in the order of the columns ``order`` if given, and cuts
    the running total at every half bound. A shard begins inside one half and ends with a document no longer than that, so it
    keeps the bound; a longer document has a shard of its own and concerns no other. A split writes as many
    files as its bytes need.
    """
    size = F.octet_length(F.to_json(F.struct(*df.columns))) + 1
    half = max(1, shard_bytes // 2)
    placed = df.withColumns({"_split": F.spark_partition_id(), "_row": F.monotonically_increasing_id(), "_size": size.cast("bigint")})
    by = [*(order or []), "_row"]
    earlier = Window.partitionBy("_split").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    packed = F.when(c("_size") <= half, c("_size")).otherwise(0)
    number = F.floor(F.coalesce(F.sum(packed).over(earlier), F.lit(0)) / half)
    alone = F.when(c("_size") > half, F.format_string("-%d", "_row")).otherwise("")
    sharded = placed.withColumn("shard", F.concat(F.format_string("%06d-%08d", "_split", number), alone))
    sharded.sortWithinPartitions("shard", *by).drop("_split", "_row", "_size").write.partitionBy("shard").json(path)


def write_csv_quoted(df: DataFrame, path: str) -> None:
    """Every field quoted, no header."""
    df.write.option("quoteAll", True).option("escape", '"').csv(path)


def write_object_csv(df: DataFrame, path: str, rows: int = ROWS_PER_OBJECT) -> None:
    """Objects with a header line and a bounded number of rows."""
    df.write.option("header", True).option("escape", '"').option("maxRecordsPerFile", rows).csv(path)


def write_object_json(df: DataFrame, path: str, rows: int = ROWS_PER_OBJECT) -> None:
    """Objects with a bounded number of documents, one per line."""
    df.write.option("maxRecordsPerFile", rows).json(path)


def write_columnar(df: DataFrame, path: str, table: str) -> None:
    """Parquet with rows in key order inside each file, for row-group pruning by key."""
    df.sortWithinPartitions(*PRIMARY_KEYS[table]).write.parquet(path)


def save_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> None:
    """Catalog table bucketed and sorted by ``keys``: two tables bucketed alike join on these
    keys without a shuffle."""
    df.write.option("path", path).bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").saveAsTable(name)


def table_stats(spark: SparkSession, name: str) -> DataFrame:
    """Collect statistics of a catalog table for the cost-based planner and show them."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    count = spark.table(name).count()
    described = []
    for field in spark.table(name).schema.fields:
        if field.dataType.typeName() in ("array", "struct", "map"):
            continue
        facts = spark.sql(f"DESCRIBE EXTENDED {name} {field.name}").where(c("info_name").isin("min", "max", "num_nulls"))
        described.append(facts.groupBy().pivot("info_name", ["min", "max", "num_nulls"]).agg(F.first("info_value")).select(
            F.lit(field.name).alias("column_name"), F.lit(count).cast("bigint").alias("row_count"),
            c("num_nulls").cast("bigint").alias("null_count"),
            F.when(c("min") != "NULL", c("min")).alias("min_value"), F.when(c("max") != "NULL", c("max")).alias("max_value"),
        ))
    return reduce(DataFrame.unionByName, described)


# -- checks -----------------------------------------------------------------------------------


def expected_counts(warehouses: int, items: int = ITEMS, suppliers: int = SUPPLIERS,
                    customers: int = CUSTOMERS_PER_DISTRICT, new_orders: int = NEW_ORDERS_PER_DISTRICT) -> dict[str, int]:
    districts = DISTRICTS_PER_WAREHOUSE * warehouses
    return {
        "warehouse": warehouses, "district": districts, "history": customers * districts,
        "neworder": new_orders * districts, "stock": items * warehouses, "customer": customers * districts,
        "orders": customers * districts, "item": items, "supplier": suppliers, "nation": 62, "region": 5,
    }


def check_row_counts(spark: SparkSession, tables: dict[str, DataFrame], expected: dict[str, int] | DataFrame) -> DataFrame:
    """Expected (by name, or as rows table_name, expected) against actual rows: every table counts to one row, in one job."""
    counts = reduce(DataFrame.union, [
        df.agg(F.count("*").alias("actual")).select(F.lit(name).alias("table_name"), "actual") for name, df in tables.items()
    ])
    wanted = expected if isinstance(expected, DataFrame) else spark.createDataFrame(list(expected.items()), "table_name string, expected bigint")
    return wanted.join(counts, "table_name").withColumn("matches", c("expected") == c("actual"))


def check_key_order(spark: SparkSession, path: str, key: str = "c_id", max_lines: int | None = None, strict: bool = False) -> DataFrame:
    """Is ``key`` non-decreasing (or strictly increasing) down each JSON-lines file?

    One row per file: records checked, lines without an integer key, number of breaks, and the first break with its
    line number. A file is cut into the blocks it is read in: order is checked inside blocks, then
    between the last key of the earlier blocks and the first of a block.
    """
    lines = spark.read.text(path).select(
        "value", c("_metadata.file_path").alias("file"), c("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )
    in_block = Window.partitionBy("file", "block").orderBy("pos")
    numbered = lines.withColumn("n", F.row_number().over(in_block))
    blocks = numbered.groupBy("file", "block").agg(F.max("n").alias("size"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file", "block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    records = numbered.join(offsets, ["file", "block"]).where(F.trim("value") != "").select(
        "file", "block", (c("offset") + c("n")).alias("line"),
        F.get_json_object("value", f"$.{key}").try_cast("bigint").alias("key"),
    )
    if max_lines is not None:
        records = records.where(c("line") <= max_lines)
    before = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    pairs = records.withColumns({
        "previous": F.last("key", ignorenulls=True).over(before),
    })
    breaks = (c("key") <= c("previous")) if strict else (c("key") < c("previous"))
    broken = F.when(breaks, F.struct("line", "key", "previous"))
    per_block = pairs.groupBy("file", "block").agg(
        F.count("*").alias("records"), F.sum(F.when(c("key").isNull(), 1).otherwise(0)).alias("unkeyed"),
        F.count(broken).alias("breaks"), F.min(broken).alias("first_break"),
        F.min_by("key", F.when(c("key").isNotNull(), c("line"))).alias("first_key"),
        F.min(F.when(c("key").isNotNull(), c("line"))).alias("first_line"),
        F.max_by("key", F.when(c("key").isNotNull(), c("line"))).alias("last_key"),
    )
    seam = per_block.withColumn("previous", F.last("last_key", ignorenulls=True).over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ))
    crossing = (c("first_key") <= c("previous")) if strict else (c("first_key") < c("previous"))
    at_seam = F.when(crossing, F.struct(c("first_line").alias("line"), c("first_key").alias("key"), "previous"))
    return seam.withColumn("seam_break", at_seam).groupBy("file").agg(
        F.sum("records").alias("records"), F.sum("unkeyed").alias("unkeyed"),
        (F.sum("breaks") + F.count("seam_break")).alias("breaks"),
        F.min(F.least("first_break", "seam_break")).alias("first_break"),
    ).select("file", "records", "unkeyed", "breaks", "first_break.line", "first_break.key", "first_break.previous")
