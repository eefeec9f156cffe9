"""WARC records and a Merkle fixity audit of replicas.

Records are laid out in archives of bounded size, one after the other; that is the catalogue. Each replica gets a tree
of hashes per archive, made from its own records alone: a record's SHA-256, then the hash of all records in a range of
RANGE_BYTES offsets, then of FAN ranges in offset order, up to the archive's root. Another replica learns only which
record each range of the catalogue begins with, and its records fall into ranges by their order, so that a record lost or
added changes one range and shifts no other. The audit compares roots and follows only branches that differ, level by
level; records meet each other only below ranges that differ. Record bytes are hashed where they are read; only digests
are shuffled, and no group holds more than a range's records or FAN children.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.storage import kept
from ordermill.operators.ordering import running_total

ARCHIVE_BYTES, RANGE_BYTES, FAN = 1 << 26, 1 << 16, 16
#: No range of a catalogue has as many records, as each has a header of over 128 bytes. A replica's range of more differs unread.
MOST_IN_RANGE = RANGE_BYTES // 128
DATE = "1970-01-01T00:00:00Z"
END = "\r\n\r\n"
_VERSION = "WARC/1.1\r\n"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """A WARC resource record (without the two line ends behind it); null url and html count as empty.

    The record id is made from page_id and url, so that writing again gives the same bytes.
    """
    url, html = F.coalesce(url, F.lit("")), F.coalesce(html, F.lit(""))
    m = F.md5(F.concat(page_id.cast("string"), F.lit(" "), url))
    uuid = F.concat_ws("-", *[F.substring(m, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return F.concat(
        F.lit(_VERSION + "WARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:"), uuid, F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        F.regexp_replace(url, r"[\r\n]", " "), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html,
    )


def records(pages: DataFrame) -> DataFrame:
    """(page_id, url, record); rows without page_id are left out."""
    rows = pages.where("page_id IS NOT NULL")
    return rows.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))


def write_warc(pages: DataFrame, path: str, archives: int) -> None:
    """WARC files, one per task: the text sink's line separator is the two line ends behind a record."""
    body = F.when(F.contains(F.coalesce("html", F.lit("")), F.lit(END + _VERSION)), F.raise_error(F.lit("a page contains a record boundary"))).otherwise(record(F.col("page_id"), F.col("url"), F.col("html")))
    pages.where("page_id IS NOT NULL").repartition(archives, "page_id").select(body.alias("value")).write.option("lineSep", END).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, url, html, complete) of every record; files are split at record boundaries, so large files are read in parallel."""
    lines = spark.read.option("lineSep", END + _VERSION).text(path)
    header = F.regexp_extract("value", r"(?s)^(.*?)\r\n\r\n", 1)
    body = F.regexp_replace(F.regexp_extract("value", r"(?s)^.*?\r\n\r\n(.*)$", 1), r"\r\n\r\n\z", "")
    field = lambda name: F.regexp_extract(header, rf"(?im)^{name}:[ \t]*(.*?)\r?$", 1)
    return lines.select(
        field("WARC-Record-ID").alias("record_id"), field("WARC-Target-URI").alias("url"), body.alias("html"),
        (F.octet_length(body) == F.expr("try_cast(" + "regexp_extract(value, '(?i)Content-Length:[ \\\\t]*([0-9]+)', 1) AS long)")).alias("complete"),
    )


def digests(rows: DataFrame) -> DataFrame:
    """(page_id, copy, length, digest) of records; the length counts the two line ends behind a record.

    Records of the same page_id are numbered from 0 by url and digest. Only digests are shuffled for that.
    """
    whole = F.concat(F.col("record"), F.lit(END)).cast("binary")
    held = kept(rows.select("page_id", "url", F.octet_length(whole).cast("long").alias("length"), F.sha2(whole, 256).alias("digest")), "record-digests")
    repeated = kept(held.groupBy("page_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("page_id").alias("again")), "repeated-pages")
    single = held.join(repeated, F.col("page_id") == F.col("again"), "left_anti").withColumn("copy", F.lit(0).cast("long"))
    several = held.join(repeated, F.col("page_id") == F.col("again"), "left_semi")
    # Slices by the url's hash keep a page_id of very many rows out of one task.
    several = running_total(several.withColumn("slice_by", F.pmod(F.xxhash64("url"), F.lit(1 << 20))), ["page_id"], ["slice_by", "url", "digest"], {"copy": F.lit(1)}, slice_width=1 << 10)
    columns = ["page_id", F.col("copy").cast("long").alias("copy"), "length", "digest"]
    return single.select(*columns).unionByName(several.select(*columns))


def _slice_width(held: DataFrame) -> int:
    low, high, n = held.agg(F.coalesce(F.min("page_id"), F.lit(0)), F.coalesce(F.max("page_id"), F.lit(0)), F.count("*")).first()
    return -(-(high - low + 1) // max(1, min(1 << 16, n // 256)))


def layout(held: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """``held`` with archive, offset and range: records in page_id order; an archive takes those that start in its share of all bytes."""
    placed = running_total(held.withColumn("one", F.lit(0)), ["one"], ["page_id", "copy"], {"start": F.col("length")}, slice_width=_slice_width(held))
    placed = placed.withColumn("archive", F.floor(F.col("start") / archive_bytes).cast("long"))
    firsts = placed.groupBy("archive").agg(F.min("start").alias("first")).withColumnRenamed("archive", "of")
    offset = (F.col("start") - F.col("first")).cast("long")
    return placed.join(firsts, F.col("archive") == F.col("of")).select(
        "page_id", "copy", "archive", offset.alias("offset"), F.floor(offset / RANGE_BYTES).cast("long").alias("range"), "length", "digest"
    )


def fitted(held: DataFrame, catalogue: DataFrame) -> DataFrame:
    """``held`` with the archive and range of a catalogue that its records fall into by (page_id, copy).

    Only the first record of each range comes from the catalogue. Ranges and records are numbered in one order: a record
    belongs to the last range that begins at or before it, and to the first range if there is none. In an empty catalogue all belong to range 0 of archive 0.
    """
    first = F.min(F.struct("page_id", "copy")).alias("first")
    marks = catalogue.groupBy("archive", "range").agg(first).select("first.*", "archive", "range", F.lit(1).alias("mark"))
    rows = kept(marks.unionByName(held.withColumn("mark", F.lit(0)), allowMissingColumns=True).withColumn("one", F.lit(0)).withColumn("behind", 1 - F.col("mark")), "ordered")
    counted = kept(running_total(rows, ["one"], ["page_id", "copy", "behind"], {"seen": F.col("mark")}, slice_width=_slice_width(rows)), "counted")
    ranges = counted.where("mark = 1").select("archive", "range", F.col("seen").alias("number"))
    records = counted.where("mark = 0").drop("archive", "range").withColumn("of", F.greatest(F.col("seen") - 1, F.lit(0)))
    placed = records.join(ranges, F.col("of") == F.col("number"), "left")
    return placed.select("page_id", "copy", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("archive", "range")], "length", "digest")


class Tree:
    """Hashes of one replica: ``levels[0]`` of ranges, the last level of archives (their roots); ``records`` lie below the ranges."""

    def __init__(self, placed: DataFrame, archive_bytes: int = ARCHIVE_BYTES, label: str = "tree"):
        """``placed``: page_id, copy, archive, range, digest."""
        self.records = placed
        full = placed.groupBy("archive", "range").agg(F.count("*").alias("n")).where(F.col("n") > MOST_IN_RANGE)
        full = kept(full.select(F.col("archive").alias("f_archive"), F.col("range").alias("f_range"), "n"), label)
        fits = placed.join(full, (F.col("archive") == F.col("f_archive")) & (F.col("range") == F.col("f_range")), "left_anti")
        line = lambda *names: F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct(*names))), lambda x: F.concat_ws(" ", *[x[n].cast("string") for n in names])))
        hashed = fits.groupBy("archive", F.col("range").alias("node")).agg(F.sha2(line("page_id", "copy", "digest"), 256).alias("digest"))
        overfull = full.select(F.col("f_archive").alias("archive"), F.col("f_range").alias("node"), F.concat(F.lit("records: "), F.col("n").cast("string")).alias("digest"))
        self.levels = [kept(hashed.unionByName(overfull), label)]
        ranges = -(-archive_bytes // RANGE_BYTES) + 1
        while ranges > 1:
            above = self.levels[-1].groupBy("archive", F.floor(F.col("node") / FAN).cast("long").alias("up")).agg(F.sha2(line("node", "digest"), 256).alias("digest"))
            self.levels.append(kept(above.select("archive", F.col("up").alias("node"), "digest"), label))
            ranges = -(-ranges // FAN)


def _below(rows: DataFrame, branch: DataFrame, place: Column) -> DataFrame:
    under = branch.select(F.col("archive").alias("in_archive"), F.col("node").alias("in_node"))
    return rows.join(under, (F.col("archive") == F.col("in_archive")) & (place == F.col("in_node")), "left_semi")


def differing(one: Tree, two: Tree) -> DataFrame:
    """(archive, node, one, two): ranges whose hashes differ or that one replica lacks, found by following differing branches from the roots."""
    branch = None
    for level in range(len(one.levels) - 1, -1, -1):
        a, b = (t.levels[level].select("archive", "node", F.col("digest").alias(name)) for t, name in ((one, "one"), (two, "two")))
        if branch is not None:
            a, b = (_below(rows, branch, F.floor(F.col("node") / FAN)) for rows in (a, b))  # noqa: B023
        branch = kept(a.join(b, ["archive", "node"], "full").where(~F.col("one").eqNullSafe(F.col("two"))), "differing")
    return branch


def audited(original: DataFrame, replica: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(page_id, copy, archive, offset, length, sha256, status) per record of ``original`` (page_id, url, record), and per record only ``replica`` has.

    status is ``intact``, ``damaged`` or ``missing`` in the replica, or ``extra``: such a record has its own
    length and sha256, the archive it falls into, and no offset. Records of one page_id are told apart by their copy number.
    """
    placed = kept(layout(digests(original), archive_bytes), "catalogue")
    other = kept(fitted(digests(replica), placed), "replica")
    ranges = differing(Tree(placed, archive_bytes), Tree(other, archive_bytes))
    marked = ranges.select(F.col("archive").alias("d_archive"), F.col("node").alias("d_range"))
    flagged = placed.join(marked, (F.col("archive") == F.col("d_archive")) & (F.col("range") == F.col("d_range")), "left")
    same = flagged.where("d_range IS NULL").withColumn("status", F.lit("intact"))
    theirs = _below(other, ranges, F.col("range")).select(
        "page_id", "copy", F.col("archive").alias("r_archive"), F.col("length").alias("r_length"), F.col("digest").alias("r_digest")
    )
    met = flagged.where("d_range IS NOT NULL").join(theirs, ["page_id", "copy"], "full")
    status = F.when(F.col("digest").isNull(), "extra").when(F.col("r_digest").isNull(), "missing").when(F.col("digest") == F.col("r_digest"), "intact").otherwise("damaged")
    met = met.withColumn("status", status).withColumns({"archive": F.coalesce("archive", "r_archive"), "length": F.coalesce("length", "r_length"), "digest": F.coalesce("digest", "r_digest")})
    columns = ["page_id", "copy", "archive", "offset", "length", F.col("digest").alias("sha256"), "status"]
    return same.select(*columns).unionByName(met.select(*columns))
