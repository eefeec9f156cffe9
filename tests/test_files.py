import json

import pytest
from pyspark.sql import functions as F

from ordermill.operators.reshape import once_each
from ordermill.sources import files
from ordermill.sources.schemas import text_dates


def lines(path, values):
    path.write_text("".join(v if isinstance(v, str) else json.dumps({"c_id": v}) + "\n" for v in values))


def checked(spark, path, **options):
    return files.check_key_order(spark, str(path), "c_id", **options).first()


def test_key_order(spark, tmp_path):
    lines(tmp_path / "ok.json", [1, 1, 2, "\n", 5])
    r = checked(spark, tmp_path / "ok.json")
    assert (r.records, r.unkeyed, r.breaks) == (4, 0, 0)
    r = checked(spark, tmp_path / "ok.json", strict=True)
    assert (r.breaks, r.line, r.key, r.previous) == (1, 2, 1, 1)
    lines(tmp_path / "bad.json", [1, 5, 4, 6, 2])
    r = checked(spark, tmp_path / "bad.json")
    assert (r.breaks, r.line, r.key, r.previous) == (2, 3, 4, 5)
    r = checked(spark, tmp_path / "bad.json", max_lines=2)
    assert (r.records, r.breaks) == (2, 0)
    lines(tmp_path / "odd.json", [1, '{"x": 1}\n', '{"c_id": "z"}\n', 2])
    assert checked(spark, tmp_path / "odd.json").unkeyed == 2


def test_key_order_across_blocks(spark, tmp_path):
    values = list(range(4000))
    values[2500] = 7
    lines(tmp_path / "long.json", values)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        r = checked(spark, tmp_path / "long.json")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert (r.records, r.breaks, r.line, r.key, r.previous) == (4000, 1, 2501, 7, 2499)


def test_json_shards_are_bounded_and_complete(spark, documents, tmp_path):
    path = tmp_path / "root" / "orders"
    files.write_json_shards(text_dates("orders", documents["orders"]), str(path), 20_000, ["o_w_id", "o_d_id", "o_id"])
    shards = list(path.glob("shard=*/*.json"))
    sizes = [f.stat().st_size for f in shards]
    assert max(sizes) <= 20_000 and len(shards) > 10 and len({f.parent for f in shards}) == len(shards)
    assert sum(sizes) / len(sizes) > 7_000
    for f in shards:
        keys = [(r["o_w_id"], r["o_d_id"], r["o_id"]) for r in map(json.loads, f.read_text().splitlines())]
        assert keys == sorted(keys)
    again = files.read_documents(spark, str(tmp_path / "root"), "orders")
    assert sorted(once_each(again).toJSON().collect()) == sorted(documents["orders"].toJSON().collect())


def test_a_large_document_concerns_its_own_shard(spark, tmp_path):
    """Documents around the bound: each file holds it, or is one document; the small ones are packed as without the large."""
    texts = [(n, "x" * (5_000 if n in (3, 40) else 900 if n == 41 else 10 + n % 7)) for n in range(200)]
    rows = spark.createDataFrame(texts, "id bigint, t string").coalesce(1)
    written = {}
    for name, df in (("all", rows), ("small", rows.where("length(t) < 500"))):
        files.write_json_shards(df, str(tmp_path / name), 1_000, ["id"])
        written[name] = [f.read_text().splitlines() for f in sorted((tmp_path / name).glob("shard=*/*.json"))]
        assert all(len(lines) == 1 or sum(len(x) + 1 for x in lines) <= 1_000 for lines in written[name])
    assert sorted(len(x) for x in written["all"]) == sorted([*(len(x) for x in written["small"]), 1, 1, 1])
    assert sorted(json.loads(x)["id"] for lines in written["all"] for x in lines) == list(range(200))


def test_shards_read_their_input_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = spark.range(1000).withColumn("t", F.repeat(F.lit("a"), 50)).mapInPandas(counted, "id bigint, t string")
    files.write_json_shards(rows, str(tmp_path / "s"), 5_000)
    assert read.value == 1000


def test_empty_shards(spark, documents, tmp_path):
    files.write_json_shards(documents["nation"].where("false"), str(tmp_path / "none"))
    assert spark.read.schema("n_name string").json(str(tmp_path / "none")).count() == 0


def test_flat_directory(spark, documents, tmp_path):
    documents["region"].write.json(str(tmp_path / "r"))
    (tmp_path / "r" / "notes.txt").write_text("not a document")
    assert files.read_flat_directory(spark, str(tmp_path / "r"), "region").count() == 5


def test_quoted_csv(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'say "hi", ok', None), (2, "plain", "x")], "a int, b string, c string")
    files.write_csv_quoted(rows.coalesce(1), str(tmp_path / "q"))
    text = "".join(f.read_text() for f in (tmp_path / "q").glob("*.csv"))
    assert '"2","plain","x"' in text and not text.startswith('"a"')
    back = spark.read.schema("a int, b string, c string").option("escape", '"').csv(str(tmp_path / "q"))
    assert sorted(r.b for r in back.collect()) == ["plain", 'say "hi", ok']


def test_objects_hold_a_bounded_number_of_rows(spark, documents, tmp_path):
    files.write_object_csv(documents["stock"].select("s_i_id", "s_w_id").coalesce(1), str(tmp_path / "o"), 300)
    counts = [len(f.read_text().splitlines()) - 1 for f in (tmp_path / "o").glob("*.csv")]
    assert max(counts) == 300 and sum(counts) == 2000


@pytest.mark.parametrize("warehouses", [1, 5])
def test_expected_counts(warehouses):
    counts = files.expected_counts(warehouses)
    assert counts["customer"] == 30_000 * warehouses and counts["neworder"] == 9_000 * warehouses and counts["stock"] == 100_000 * warehouses


def test_bucketed_tables_join_without_a_shuffle(spark, documents, tmp_path):
    keys = ["o_w_id", "o_d_id", "o_id"]
    for name in ("bucket_a", "bucket_b"):
        files.save_bucketed(documents["orders"].drop("o_orderline"), name, str(tmp_path / name), keys, 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucket_a").join(spark.table("bucket_b").select(*keys), keys)
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 600
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in ("bucket_a", "bucket_b"):
            spark.sql(f"DROP TABLE {name}")
