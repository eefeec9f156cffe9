import math

from ordermill.llm import url_filter
from ordermill.llm.registered import op5_url_filter


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    return "".join(c.lower() if c.isascii() else c for c in host), rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]


def ruled(host, path):
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return (best.text, best.verdict) if best else (None, None)


URLS = [
    "http://A.Example.NET/en/x?y=/de/", "https://example.net/en", "http://net/", "http://net", "http://xnet/", "http://foo.org/fr/1#a", "http://org/fr/", "ftp://example.com/de/?q",
    "http://example.com?x=/de/", "no scheme", None, "", "://", "a://b://c/d", "http://É.Org/fr/é\n2", "https://cheap-pills.example.com/en/1", "https://blog.library.example.com/en/2", "http://x/" + "a" * 5000,
]


def test_parts_and_rules(spark):
    rows = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[0], "x"), (0, URLS[0], "x")], "page_id long, url string, rule string")
    got = url_filter.judged(rows).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        assert (r.host, r.path) == split(r.url), r.url
        rule, verdict = ruled(*split(r.url))
        assert r.rule == rule and (verdict is None or r.verdict == verdict) and r.verdict in ("allow", "block")
    by = {r.url: r.verdict for r in got}
    assert by[URLS[15]] == "block" and by[URLS[16]] == "allow"
    assert url_filter.judged(rows.where("false")).count() == 0


def test_training_is_gradient_descent(spark):
    """The same weights from plain Python over the grams that Spark made."""
    table = spark.createDataFrame([("http://aab.x/1", 1), ("http://bbc.y/22", 0), ("http://aac.x/3", 1), (None, 1), ("http://q/", None)], "url string, label int")
    from pyspark.sql import functions as F

    rows = table.where("url is not null and label is not null").select("label", url_filter.gram_buckets(url_filter.host(F.col("url")), url_filter.path(F.col("url"))).alias("x")).collect()
    w, b = {}, 0.0
    for _ in range(url_filter.EPOCHS):
        errors = []
        for r in rows:
            scale = math.sqrt(len(r.x))
            score = sum(w.get(g, 0.0) for g in r.x) / scale + b
            errors.append((r, scale, r.label - 1 / (1 + math.exp(-score))))
        keep = 1 - url_filter.RATE * url_filter.SHRINK
        w, b = {g: v * keep for g, v in w.items()}, b * keep
        for r, scale, e in errors:
            for g in r.x:
                w[g] = w.get(g, 0.0) + url_filter.RATE * e / scale
            b += url_filter.RATE * e * 0.1
    got = url_filter.train(table).first().weights
    assert abs(got[-1] - b) < 1e-8 and all(abs(got[g] - v) < 1e-8 for g, v in w.items())
    assert url_filter.train(table.where("false")).first().weights == [0.0] * (url_filter.BUCKETS + 1)


def test_query(spark, sf_dir):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = op5_url_filter(spark, sf_dir)
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()
    rows = got.collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path) == split(urls[r.page_id]) and r.rule == ruled(r.host, r.path)[0]
        if r.rule is None and any(s in r.host for s in ("casino-win", "free-bets", "spam-farm")):
            assert r.verdict == "block"
