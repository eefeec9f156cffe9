"""Shape of the plans, and answers under skew and with every join shuffled."""

import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ordermill import twin_sql
from ordermill.plans.catalog import ANALYTIC
from ordermill.plans.fixture_params import FIXTURE_PARAMS
from ordermill.operators.reshape import ZONES
from ordermill.plans.layouts import LAYOUTS
from ordermill.registered import registered
from ordermill.registered import twin_sql as twin_sql_of
from ordermill.sources import store as store_module
from ordermill.sources.store import FolderStore, LoadedStore, loaded_store, write_table
from ordermill.synth.tables import Scale, Synth
from tests.conftest import GIVEN, given_views, rows_of


@pytest.fixture
def shuffled(spark):
    """Data too large to broadcast, as far as the planner knows."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("layout", ["nested", "flat"])
@pytest.mark.parametrize("name", sorted(ANALYTIC))
def test_no_pairs_and_no_python(name, layout, spark, sf_dir, shuffled):
    text = plan(ANALYTIC[name](LAYOUTS[layout](loaded_store(spark, sf_dir)), **FIXTURE_PARAMS[name]))
    assert not re.search(r"CartesianProduct|NestedLoopJoin|BroadcastExchange|BatchEvalPython|ArrowEvalPython|MapInPandas", text)


def test_scans_are_pruned(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    store = loaded_store(spark, sf_dir)
    physical = lambda q: ANALYTIC[q](LAYOUTS["nested"](store), **FIXTURE_PARAMS[q])._jdf.queryExecution().executedPlan().toString()
    assert "o_orderline:array<struct<ol_delivery_d:timestamp_ntz,ol_amount:double>>" in physical("q06")
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(o_entry_d[^]]*EqualTo\(o_parts,1\)", physical("q04"))
    assert "c_addresses:array<struct<c_address_kind:string,c_state:string>>" in physical("q03")


def test_a_month_reads_few_files(spark, tmp_path):
    """Orders of seven years, stored in date ranges: what one month of entries or deliveries concerns, by the files' own statistics."""
    days = "cast(date_add(date'2012-01-01', cast(pmod(id * 7919, 2500) as int)) as timestamp_ntz)"
    lines = f"transform(sequence(0, 3), n -> struct(cast(n as bigint) as ol_number, {days} + make_dt_interval(2 + pmod(id + n * 37, 150)) as ol_delivery_d, 1.0D as ol_amount))"
    orders = spark.range(20_000).selectExpr("id as o_id", "1L as o_d_id", "1L as o_w_id", f"{days} as o_entry_d", f"{lines} as o_orderline")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the data are small: as many files as ranges
    write_table(orders.repartition(8), f"{tmp_path}/orders", "orders")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for column, low, high, most in (("o_entry_d", "2015-03-01", "2015-04-01", 2), ("delivery", "2015-03-01", "2015-04-01", 3)):
        read = 0
        files = sorted(tmp_path.glob("orders/*.parquet"))
        for file in files:
            groups = pq.ParquetFile(file).metadata
            first, last = (column, column) if column == "o_entry_d" else ZONES
            statistics = [{g.column(i).path_in_schema: g.column(i).statistics for i in range(g.num_columns)} for g in map(groups.row_group, range(groups.num_row_groups))]
            read += any(str(s[first].min) < high and str(s[last].max) >= low for s in statistics)
        assert len(files) == 8 and 1 <= read <= most, column
    store = FolderStore(spark, str(tmp_path))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    month = LAYOUTS["nested"](store).lines(None, ("ol_delivery_d", "ol_amount"), tuple(F.lit(x).cast("timestamp_ntz") for x in ("2015-03-01", "2015-04-01")))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_last_delivery.*LessThanOrEqual\(o_first_delivery", month._jdf.queryExecution().executedPlan().toString())
    inside = "ol_delivery_d >= '2015-03-01' AND ol_delivery_d < '2015-04-01'"
    assert month.where(inside).count() == orders.selectExpr("inline(o_orderline)").where(inside).count() > 0
    assert "o_first_delivery" not in store.table("orders").columns


def test_synthesised_documents_answer_alike_in_all_layouts(spark, tmp_path):
    """The reference parameters on the document data set: nested, top-level and flat agree."""
    from ordermill.operators.reshape import to_flat, to_toplevel

    synth = Synth(spark, Scale(2, divisor=60), seed=21, run_date="2021-01-01 00:00:00", suppliers=60)
    for name in ("orders", "customer", "item", "stock", "supplier", "nation", "region", "neworder"):
        synth.table(name).write.parquet(f"{tmp_path}/{name}")
    read = lambda n: spark.read.parquet(f"{tmp_path}/{n}")
    flat = to_flat("orders", read("orders")) | to_flat("customer", read("customer"))
    renamed = {"orders": "orders_header", "customer": "customer_flat"}
    for name, df in flat.items():
        df.write.parquet(f"{tmp_path}/{renamed.get(name, name)}")
    to_toplevel("customer", read("customer")).write.parquet(f"{tmp_path}/toplevel_customer")
    store = FolderStore(spark, str(tmp_path), suppliers=60)
    wide = {"q19": {"branches": (("h", 1, 50, 80.0, (1,)), ("t", 1, 50, 80.0, (2,)))}, "q03": {"state": ""}, "q21": {"nation": "Ukraine", "days": 60},
            "q11": {"nation": "Ukraine"}, "q20": {"prefix": "", "nation": "Ukraine"}, "q07": {"nation_a": "Ukraine", "nation_b": "Ecuador"}}
    filled = 0
    for name, query in ANALYTIC.items():
        results = [rows_of(query(LAYOUTS[layout](store), **wide.get(name, {})).toPandas().map(str)) for layout in LAYOUTS]
        assert results[0] == results[1] == results[2], name
        filled += bool(results[0])
    assert filled >= 18


@pytest.fixture(scope="module")
def hot_dir(spark, sf_dir, tmp_path_factory):
    """The given tables with a third of all orders on one customer, a third of all lines on one
    order, and another third on one part."""
    folder = tmp_path_factory.mktemp("hot")
    con = given_views(sf_dir)
    hot = {
        "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey) FROM orders",
        "lineitem": """SELECT * EXCLUDE (n) REPLACE (CASE WHEN n % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey,
            CASE WHEN n % 3 = 1 THEN 7 ELSE l_partkey END AS l_partkey) FROM (SELECT *, row_number() OVER () AS n FROM lineitem)""",
    }
    for table in GIVEN:
        con.execute(f"COPY ({hot.get(table, f'SELECT * FROM {table}')}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("layout", ["nested", "flat"])
def test_answers_under_skew_with_shuffled_joins(layout, spark, hot_dir, shuffled):
    """With parts of about 100 lines the hot order is many rows; its lines have equal numbers."""
    con = given_views(hot_dir)
    store = LoadedStore(spark, hot_dir, 100)
    if layout == "nested":
        most = store.table("orders").agg(F.max("o_parts"), F.max(F.size("o_orderline"))).first()
        assert most[0] > 15 and most[1] < 200
    for name, query in ANALYTIC.items():
        got = query(LAYOUTS[layout](store), **FIXTURE_PARAMS[name])
        if dict(got.dtypes).get("su_address", "").startswith("struct"):
            got = got.withColumn("su_address", F.concat_ws(", ", "su_address.*"))
        expected = con.execute(twin_sql.analytic_sql(name, FIXTURE_PARAMS[name])).df()
        assert rows_of(got.toPandas()) == rows_of(expected), name


@pytest.fixture(scope="module")
def large_order_dir(spark, sf_dir, tmp_path_factory):
    """The given tables with a third of all lines on one order, each with its own number, in parts of about 100 lines."""
    folder = str(tmp_path_factory.mktemp("large"))
    con = given_views(sf_dir)
    lines = """SELECT * EXCLUDE (n) REPLACE (CASE WHEN n % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey,
        CAST(CASE WHEN n % 3 = 0 OR l_orderkey = 1 THEN 10 + n ELSE l_linenumber END AS INT) AS l_linenumber)
        FROM (SELECT *, row_number() OVER () AS n FROM lineitem)"""
    for table in GIVEN:
        con.execute(f"COPY ({lines if table == 'lineitem' else f'SELECT * FROM {table}'}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    key = (spark.sparkContext.applicationId, folder)
    store_module._stores[key] = LoadedStore(spark, folder, 100)
    yield folder
    store_module.refresh(spark, folder)


@pytest.mark.parametrize("name", sorted(n for n in twin_sql_of() if not n.startswith(("metrics_", "gen_", "params_"))))
def test_every_query_with_an_order_of_many_parts(name, spark, large_order_dir):
    got, expected = registered()[name](spark, large_order_dir), given_views(large_order_dir).execute(twin_sql_of()[name]).df()
    assert rows_of(got.toPandas()) == rows_of(expected)
