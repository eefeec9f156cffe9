import hashlib

from pyspark.sql import functions as F

from ordermill.llm import warc_fixity
from ordermill.llm.registered import op3_warc_fixity


def pages(spark, n=400):
    rows = [(i, f"http://h/{i}", "<p>" + "é" * (i % 37) + "x" * (i * 13 % 900)) for i in range(n)]
    rows += [(1000, None, None), (1001, "", ""), (None, "http://h/", "lost"), (5, "http://h/again", "other"), rows[7], (1002, "http://h/\r\n", "y" * 300_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").select("*", *[F.lit("z").alias(c) for c in ("offset", "digest", "node", "copy", "length")])


def test_damage_is_located(spark):
    original = warc_fixity.records(pages(spark))
    broken = original.where("page_id <> 33").withColumn("record", F.when(F.col("page_id").isin(12, 200, 1002), F.concat("record", F.lit("!"))).otherwise(F.col("record")))
    got = warc_fixity.audited(original, broken, archive_bytes=100_000).collect()
    assert len(got) == 405
    status = {}
    for r in got:
        status.setdefault(r.status, set()).add(r.page_id)
    assert status["missing"] == {33} and status["damaged"] == {12, 200, 1002}
    held = {}
    for r in original.collect():
        held.setdefault(r.page_id, []).append((r.record + "\r\n\r\n").encode())
    at = {}
    for r in sorted(got, key=lambda r: (r.page_id, r.copy)):
        raw = next(x for x in held[r.page_id] if hashlib.sha256(x).hexdigest() == r.sha256)
        held[r.page_id].remove(raw)
        assert r.length == len(raw) and r.offset == at.get(r.archive, 0)
        at[r.archive] = r.offset + len(raw)
    assert len(at) == 3
    assert {r.status for r in warc_fixity.audited(original, original, archive_bytes=100_000).collect()} == {"intact"}
    assert warc_fixity.audited(original.where("false"), original.where("false")).count() == 0


def test_records_only_the_replica_has(spark):
    """Added records are reported, wherever they sort, and make no other record look damaged; so with two copies of a page."""
    original = warc_fixity.records(pages(spark))
    more = [(-5, "a", "first"), (3, "zz", "a second page 3"), (150, "h", "x" * 70_000), (5000, "h", "last")] + [(9000 + i, "h", "many") for i in range(700)]
    gone = original.where("page_id not in (0, 33, 150, 399)")
    replica = gone.unionByName(warc_fixity.records(spark.createDataFrame(more, "page_id long, url string, html string")))
    status = {}
    for r in warc_fixity.audited(original, replica, archive_bytes=100_000).collect():
        status.setdefault(r.status, []).append(r.page_id)
        assert (r.offset is None) == (r.status == "extra") and r.archive is not None and len(r.sha256) == 64
    assert sorted(status["missing"]) == [0, 33, 399] and 150 in status["damaged"] and set(status["damaged"]) <= {3, 150}
    assert sorted(status["extra"]) == [-5, 3, 5000, *range(9000, 9700)]
    assert sum(map(len, status.values())) == 405 + 703
    assert [r.status for r in warc_fixity.audited(original.where("false"), original.where("page_id < 3")).collect()] == ["extra"] * 3
    assert {r.status for r in warc_fixity.audited(original, original.where("false")).collect()} == {"missing"}


def test_only_differing_branches_are_followed(spark):
    """A changed, lost or added record changes one node per level; siblings keep their hashes."""
    held = warc_fixity.digests(warc_fixity.records(pages(spark))).cache()
    placed = warc_fixity.layout(held, 1 << 22).cache()
    one = warc_fixity.Tree(placed, 1 << 22)
    assert one.levels[0].count() > 3
    added = held.where("page_id = 3").withColumn("copy", F.lit(1).cast("long"))
    for other in (held.withColumn("digest", F.when(F.col("page_id") == 3, F.lit("0")).otherwise(F.col("digest"))), held.where("page_id <> 3"), held.unionByName(added)):
        two = warc_fixity.Tree(warc_fixity.fitted(other, placed), 1 << 22)
        for a, b in zip(one.levels, two.levels, strict=True):
            assert a.exceptAll(b).count() == b.exceptAll(a).count() == 1
        assert [(r.archive, r.node) for r in warc_fixity.differing(one, two).collect()] == [(r.archive, r.range) for r in placed.where("page_id = 3").collect()]
    assert one.levels[-1].count() == placed.select("archive").distinct().count()
    assert warc_fixity.differing(one, warc_fixity.Tree(warc_fixity.fitted(held, placed), 1 << 22)).count() == 0


def test_files_round_trip(spark, tmp_path):
    given = pages(spark).where("page_id is not null and coalesce(url, '') not like '%\r%'")
    warc_fixity.write_warc(given, str(tmp_path / "w"), 3)
    read = warc_fixity.read_warc(spark, str(tmp_path / "w")).collect()
    assert all(r.complete for r in read)
    assert sorted((r.url, r.html) for r in read) == sorted((r.url or "", r.html or "") for r in given.collect())
    raw = next((tmp_path / "w").glob("part-*")).read_bytes()
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: resource\r\n") and raw.endswith(b"\r\n\r\n")


def test_query(spark, sf_dir):
    ids = [r.page_id for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    got = {r.page_id: r.status for r in op3_warc_fixity(spark, sf_dir).collect()}
    assert {i for i, status in got.items() if status == "extra"} == {-1 - i for i in ids if i % 401 == 11}
    assert {i: status for i, status in got.items() if i >= 0} == {i: "missing" if i % 389 == 7 else "damaged" if i % 97 == 5 else "intact" for i in ids}
