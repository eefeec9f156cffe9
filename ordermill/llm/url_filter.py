"""URL filter: rules first, then a logistic regression on hashed character n-grams of host and path.

Everything is column expressions. The labelled table is small (its bound is a parameter), so gradient
descent runs in one expression over the table's Gram matrix: the weights stay in the span of the
training rows, w = sum of a_i x_i, and a step changes the a_i alone. The finished model is one array of
``BUCKETS`` weights; scoring a URL is a sum over its n-grams in its own row, without a shuffle.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 4096
GRAMS = (3, 4, 5)
EPOCHS, RATE, SHRINK = 1200, 0.3, 0.0005
#: Labelled rows used for training; more are refused.
MOST_LABELLED = 500


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))

#: A small invented table of URLs with labels (1: unwanted).
LABELLED = (
    *((f"https://{h}/{p}", 1) for h, p in (
        ("cheap-pills.example.org", "en/1"), ("www.best-pills-online.example.net", "de/order.html"), ("pills-discount.example.com", "fr/77/"), ("shop.pharma-pills.example.org", "en/4?x=1"),
        ("casino-win.example.net", "en/9"), ("www.casino-royal-win.example.com", "es/2.html"), ("mega-casino.example.org", "en/55/"), ("win-slots.example.net", "en/3"),
        ("free-bets.example.com", "de/12"), ("m.free-bets-now.example.org", "en/27"), ("sports-bets.example.net", "fr/8/"), ("bets-bonus.example.com", "en/6.html"),
        ("spam-farm.example.org", "en/728"), ("spam-links.example.net", "en/41"), ("link-farm.example.com", "es/5/"), ("content-farm.example.org", "en/98"),
        ("ads-track.example.net", "en/584"), ("www.ads-click.example.com", "de/3"), ("track-pixel.example.org", "en/71"), ("click-ads-server.example.net", "fr/2/"),
        ("blog.casino-win-big.example.com", "de/31"), ("m.casino-win.example.org", "en/8.html"), ("www.cheap-pills-now.example.net", "en/19"), ("cheap-pills.example.org", "es/3"),
        ("ads-track.example.com", "en/2"), ("www.ads-track.example.net", "en/5/"), ("m.ads-tracker.example.org", "de/8.html"), ("ads-track.example.net", "fr/6"), ("my-ads.example.com", "en/4"),
        ("www.spam-farm.example.com", "fr/7"), ("ads-track-now.example.com", "en/66"), ("blog.ads-track.example.org", "es/2"),
        ("xxx-adult-cams.example.com", "en/1"), ("adult-cams.example.org", "en/14"), ("fast-loans.example.net", "en/30"), ("payday-loans-now.example.com", "de/1"),
    )),
    *((f"https://{h}/{p}", 0) for h, p in (
        ("thther.example.org", "en/685"), ("therha.example.net", "en/676"), ("blog.ththan.example.com", "en/960"), ("m.therou.example.org", "en/474.html"), ("www.ththen.example.net", "en/148.html"),
        ("blog.tionsh.example.com", "es/533/"), ("news.erand.example.org", "de/61"), ("library.onthe.example.net", "en/12/"), ("ththed.example.com", "de/257?page=2"), ("therin.example.org", "fr/770"),
        ("blog.weather-report.example.net", "en/4"), ("city-library.example.com", "fr/35/"), ("www.school-garden.example.org", "en/81"), ("museum.history.example.net", "de/2"), ("docs.python-guide.example.com", "en/10"),
        ("recipes.kitchen.example.org", "es/9.html"), ("thering.example.net", "en/328/"), ("blog.theres.example.com", "en/518"), ("thther.university.example.org", "de/7"), ("science-journal.example.net", "en/3"),
        ("thonth.example.com", "en/8"), ("blog.therhe.example.net", "de/4.html"), ("theresing.example.org", "fr/52"), ("www.thinon.example.com", "en/91/"), ("erththe.example.org", "es/6"),
        ("m.ththing.example.com", "en/2"), ("ondres.example.net", "fr/3"), ("weather.north.example.com", "de/50"), ("open-data.example.org", "en/7"),
        ("river-walks.example.com", "fr/64.html"), ("m.train-times.example.org", "en/25"), ("poetry.onand.example.net", "es/784"), ("www.therti.example.com", "en/334/"),
    )),
)


def host(url: Column) -> Column:
    """From behind the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """From behind the host to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_: Column, path_: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None)
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host_ == r.host) | host_.endswith("." + r.host)) & path_.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def gram_buckets(host_: Column, path_: Column) -> Column:
    """Bucket numbers of the distinct character n-grams of host and path, each in its own name space."""
    def grams(text: Column, name: str) -> Column:
        text = F.concat(F.lit("^"), F.regexp_replace(text, "[0-9]+", "0"), F.lit("$"))  # page numbers say nothing
        parts = [
            F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i, n=n: F.substring(text, i, F.lit(n))))
            .otherwise(F.array().cast("array<string>"))
            for n in GRAMS
        ]
        return F.transform(F.concat(*parts), lambda g: F.pmod(F.xxhash64(F.lit(name), g), F.lit(BUCKETS)).cast("int"))

    return F.array_distinct(F.concat(grams(host_, "host"), grams(path_, "path")))


def train(labelled: DataFrame) -> DataFrame:
    """One row, ``weights`` array<double> of BUCKETS + 1 entries (the last is the constant), from (url, label 0/1).

    Rows with a null url or label are left out; a table without usable rows gives zero weights.
    """
    rows = labelled.where("url IS NOT NULL AND label IS NOT NULL").select(F.col("label").cast("double").alias("y"), gram_buckets(host(F.col("url")), path(F.col("url"))).alias("x"))
    rows = rows.select("y", "x", F.greatest(F.sqrt(F.size("x").cast("double")), F.lit(1.0)).alias("norm"))
    table = rows.agg(F.array_sort(F.collect_list(F.struct("y", "norm", "x"))).alias("rows")).select(
        F.when(F.size("rows") <= MOST_LABELLED, F.col("rows")).otherwise(F.raise_error(F.lit(f"more than {MOST_LABELLED} labelled rows"))).alias("rows")
    )
    table = table.withColumn("gram", F.transform("rows", lambda a: F.transform(
        "rows", lambda b: F.size(F.array_intersect(a["x"], b["x"])) / (a["norm"] * b["norm"]) + F.lit(0.1)
    ))).agg(F.first("rows").alias("rows"), F.first("gram").alias("gram"))  # an aggregate's result is computed once; a projection would be inlined into every step

    def step(alpha: Column) -> Column:
        def moved(a: Column, i: Column) -> Column:
            score = F.aggregate(F.zip_with(alpha, F.get("gram", i), lambda p, g: p * g), F.lit(0.0), lambda s, v: s + v)
            error = F.get("rows", i)["y"] - F.lit(1.0) / (F.lit(1.0) + F.exp(-score))
            return a * (1.0 - RATE * SHRINK) + F.lit(RATE) * error
        return F.transform(alpha, moved)

    trained = table.withColumn("alpha", F.aggregate(F.sequence(F.lit(1), F.lit(EPOCHS)), F.transform("rows", lambda r: F.lit(0.0)), lambda alpha, e: step(alpha)))
    pairs = F.arrays_zip(F.col("rows"), F.col("alpha"))
    constant = trained.select(F.lit(BUCKETS).alias("bucket"), (F.aggregate("alpha", F.lit(0.0), lambda s, v: s + v) * 0.1).alias("weight"))
    entries = trained.select(F.explode(pairs).alias("p")).select(F.explode("p.rows.x").alias("bucket"), (F.col("p.alpha") / F.col("p.rows.norm")).alias("weight"))
    summed = entries.groupBy("bucket").agg(F.sum("weight").alias("weight")).unionByName(constant)
    by_bucket = summed.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("bucket", "weight")))).alias("held"))
    return by_bucket.select(F.transform(F.sequence(F.lit(0), F.lit(BUCKETS)), lambda b: F.coalesce(F.element_at("held", b), F.lit(0.0))).alias("weights"))


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = json.dumps([{"url": u, "label": y} for u, y in LABELLED])
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<url:string,label:int>>")))


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, score): every row of ``pages`` judged.

    The longest fitting rule decides; without one, ``block`` if the model's probability is 0.5
    or more. A null url, or one without ``://``, has empty host and path, fits no rule that asks
    for a path, and is judged by the model's constant and the marks of emptiness.
    """
    spark = pages.sparkSession
    model = train(labelled if labelled is not None else labelled_urls(spark)).first()["weights"]
    weights = F.from_json(F.lit(json.dumps(list(model))), "array<double>")  # a constant of fixed length
    named = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    featured = named.select("*", gram_buckets(F.col("host"), F.col("path")).alias("grams"), rule_of(F.col("host"), F.col("path")).alias("fit") if rules is RULES else rule_of(F.col("host"), F.col("path"), rules).alias("fit"))
    total = F.aggregate("grams", F.lit(0.0), lambda s, b: s + F.get(weights, b)) / F.greatest(F.sqrt(F.size("grams").cast("double")), F.lit(1.0)) + F.get(weights, F.lit(BUCKETS))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-total))
    return featured.select("page_id", "url", "host", "path", F.col("fit.rule").alias("rule"), score.alias("score"), "fit").select(
        "page_id", "url", "host", "path", "rule", F.coalesce("fit.verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score"
    )
