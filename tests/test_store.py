import os

import pytest
from pyspark.sql import functions as F

from ordermill.plans import lookups
from ordermill.sources.schemas import PRIMARY_KEYS
from ordermill.sources.store import FolderStore, LoadedStore, loaded_store, refresh, write_table


def test_refresh_loads_changed_tables(spark, tmp_path):
    spark.range(3).selectExpr("cast(id as int) as n_nationkey", "'x' as n_name", "0 as n_regionkey").write.parquet(str(tmp_path / "nation.parquet"))
    spark.range(5).selectExpr("id as s_suppkey", "'s' as s_name", "0 as s_nationkey", "1.0d as s_acctbal").write.parquet(str(tmp_path / "supplier.parquet"))
    store = loaded_store(spark, str(tmp_path))
    table = store.table("nation")
    assert table.count() == 3 and loaded_store(spark, str(tmp_path)) is store and os.path.isdir(store.folder)
    spark.range(4).selectExpr("cast(id as int) as n_nationkey", "'x' as n_name", "0 as n_regionkey").write.mode("overwrite").parquet(str(tmp_path / "nation.parquet"))
    assert loaded_store(spark, str(tmp_path)).table("nation").count() == 3
    refresh(spark, str(tmp_path))
    assert not os.path.exists(store.folder) and loaded_store(spark, str(tmp_path)).table("nation").count() == 4
    with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|does not exist"):
        table.count()


def rows_read(frame):
    """Rows the file scans of a plan have handed on, after it has run."""
    frame.collect()
    todo, found = [frame._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        elif node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_single_keys_skip_row_groups(spark, tmp_path):
    """Row groups whose Bloom filter has none of the asked keys are not read; the result is that of the plain lookup."""
    n, files = 8000, 16
    stock = spark.range(n).select((F.col("id") % 8).alias("s_w_id"), F.floor(F.col("id") / 8).alias("s_i_id"), F.md5(F.col("id").cast("string")).alias("s_data"))
    write_table(stock.repartition(files), f"{tmp_path}/stock", "stock")
    stock.write.parquet(f"{tmp_path}/plain/stock")
    store, plain = FolderStore(spark, str(tmp_path)), FolderStore(spark, f"{tmp_path}/plain")
    assert store.table("stock").columns == stock.columns and store.zoned("stock").columns == stock.columns
    names = PRIMARY_KEYS["stock"]
    asked = {"one": [(3, 77)], "none there": [(9, 5), (-1, -1)], "repeated, null": [(3, 77), (3, 77), (None, 5), (1, None)], "no key": [], "many": [(i % 8, i) for i in range(300)]}
    for kind, keys in asked.items():
        wanted = spark.createDataFrame([(*k, i) for i, k in enumerate(keys)], "s_w_id int, s_i_id long, request long").coalesce(1)
        found = lookups.lookup_points(store, "stock", wanted)
        expected = lookups.lookup("stock", stock, wanted)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.select(found.columns).collect())), kind
        assert sorted(map(tuple, lookups.lookup_points(plain, "stock", wanted).collect())) == sorted(map(tuple, found.collect())), kind
        scanned = rows_read(found)
        assert scanned <= {"one": 2, "none there": 1, "repeated, null": 2, "no key": 0}.get(kind, files) * n // files, (kind, scanned)
    one = spark.createDataFrame(asked["one"], names)
    assert rows_read(lookups.lookup("stock", store.table("stock"), one)) == n and rows_read(lookups.lookup_points(store, "stock", one)) > 0
    twenty = spark.createDataFrame([(5, 40 * i) for i in range(25)], names)
    assert lookups.lookup_points(store, "stock", twenty).count() == 25
    text = lookups.lookup_points(store, "stock", twenty)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in text and text.split("PushedFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("name", ["stock", "customer"])
def test_wide_tables_are_widened_and_sorted_in_pieces(spark, tmp_path, name):
    """However small the given file, no task sorts more documents than those of its share of the rows; one key in all rows is cut too."""
    spark.range(400).selectExpr("if(id < 200, id, 7) as p_partkey").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    spark.range(30).selectExpr("id as s_suppkey").write.parquet(str(tmp_path / "supplier.parquet"))
    spark.range(400).selectExpr("if(id < 200, id, 7) as c_custkey", "'c' as c_name", "cast(id % 25 as int) as c_nationkey", "id / 4 as c_acctbal").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    store, whole = LoadedStore(spark, str(tmp_path)), LoadedStore(spark, str(tmp_path))
    store.bridge.rows_per_task = 50
    pieces = store.table(name).groupBy(F.input_file_name()).count().collect()
    share = 50 * (4 if name == "stock" else 1)
    assert len(pieces) >= 8 and max(n for _, n in pieces) <= 2 * share
    assert sorted(map(str, store.table(name).collect())) == sorted(map(str, whole.table(name).collect()))
    assert whole.table(name).count() == 8 * share
