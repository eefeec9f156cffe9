import html
import itertools
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from ordermill.llm import html_tree as H
from ordermill.llm.registered import op7_html_tree


def text(page):
    return H.trained().text(page)


S = "The river walked along the old road and nobody in the town could say where it went. "


def test_parts_that_are_not_the_article():
    page = f"""<html><head><title>t</title><style>x{{}}</style></head><body><header><h1><a href=/>Site</a></h1></header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
    <div class="cookie-notice"><p>{S}</p><button>OK</button></div><article><h1>Head&amp;line</h1><p>{S * 3}</p><p>Short.</p><p>A&nbsp;b <b>c</b>
    d<br>e &lt;f&gt; &eacute;&#233;&#xe9;</p><script>var a = "</p>";</script><div class="advert">{S}</div><p>{S * 2}</p></article>
    <aside class="sidebar"><p>{S}</p></aside><section class="comments"><p>{S * 2}</p></section><form><label>Name</label><input></form><footer>&copy; {S}</footer></body></html>"""
    s = " ".join(S.split())
    assert text(page).split("\n") == ["Head&line", " ".join([s] * 3), "Short.", "A b c d e <f> ééé", " ".join([s] * 2)]


@pytest.mark.parametrize("tag", ["svg", "math", "object", "canvas", "xmp"])
@pytest.mark.parametrize("end", [True, False])
def test_drawings_formulas_and_fallback_are_text(tag, end):
    """Their text reaches the model, and a missing end tag costs nothing behind it."""
    s = " ".join(S.split())
    close = f"</{tag}>" if end else ""
    page = f"<body><article><h1>Head</h1><p>{S * 3}</p><p>{S}<{tag} class=x>inner words {close}</p><p>{S * 2}</p><p>{s} Last.</p></article><footer>{S}</footer></body>"
    got = text(page)
    assert "inner words" in got and got.startswith("Head") and got.endswith(f"{s} Last.") and f"{s} {s}" in got.split("\n")
    tags = [n[0] for n in H.parse(page)]
    assert tags.count("p") == 4 and "footer" in tags


def test_linked_lists_of_the_article_stay():
    s = " ".join(S.split())
    items = ["Alpha beta gamma", "Delta", "Epsilon zeta eta theta", "Iota kappa"]
    listed = "<ul>" + "".join(f"<li><a href={i}>{x}</a></li>" for i, x in enumerate(items)) + "</ul>"
    for before in ("", f"<p>{S * 3}</p>"):
        page = f"<body><nav>{listed}</nav><article><h1>Head of it</h1>{before}{listed}<p>{S}</p></article><footer>{listed}</footer></body>"
        assert text(page).split("\n") == ["Head of it", *[" ".join((S * 3).split())] * bool(before), *items, s]


def test_hostile_pages_take_linear_time():
    started = time.perf_counter()
    for page in ("<p a='x " * 20_000, '<p a="x' * 20_001 + ">", "<div>" * 20_000 + "</p>" * 20_000, "<div><li>" * 8_000 + S, "<a b=\"'" * 20_000 + ">" * 20_000):
        H.parse(page)
    assert time.perf_counter() - started < 8
    assert [("".join(n[3]) if n[3] else n[0]) for n in H.parse("<p title='a>b'>x</p><p a=\"1>y<p b='>z")] == ["html", "p", "x", "p", "y", "p", "z"]


def test_literal_text_and_parts_of_drawings():
    def parsed(page):
        return ["".join(n[3]) for n in H.parse(page) if not n[0]]

    assert parsed("<xmp><b>x</b> &amp;</xmp>after") == ["<b>x</b> &amp;", "after"]
    assert parsed("<p>a<svg><title>t</title><style>s</style><text>b</text><text>c</text></svg>d") == ["a b cd"]
    assert parsed("<object data=x><p>fall back</p></object>") == ["fall back"] and parsed("<svg/>a<canvas>b") == ["ab"]


@pytest.mark.parametrize("page", ["", None, "<p>", "<", "<a", "<!-- x", "<script>", "</p></div>", "<p a='x", "<div " * 50, "\0", "<![CDATA[x]]>", "<p hidden>x", "&#xD800;&#0;&bogus;", "<b></b>" * 10])
def test_odd_pages_do_not_fail(page):
    assert isinstance(text(page), str)


def test_deep_and_long_pages():
    assert text("<div>" * 3000 + S * 4 + "</div>" * 3000) is not None
    long = "<article>" + f"<p>{S}</p>" * 5000 + "</article>"
    assert text(long).count("\n") == 4999


def test_implied_ends():
    tags = [(n[0], n[1]) for n in H.parse("<ul><li>a<li>b<ul><li>c</ul></ul><p>d<p>e<div>f</div><table><tr><td>g<td>h<tr><td>i</table>")]
    assert [t for t, _ in tags] == ["html", "ul", "li", "", "li", "", "ul", "li", "", "p", "", "p", "", "div", "", "table", "tr", "td", "", "td", "", "tr", "td", ""]
    assert tags[4][1] == 1 and tags[11][1] == 0 and tags[13][1] == 0 and tags[21][1] == tags[16][1] == 15


def test_marginals_are_exact():
    """Against the sum over all labelings of a small tree."""
    r = random.Random(4)
    nodes = [["html", -1, (), None, 0]] + [["p" if i % 2 else "", r.randrange(0, i), (), None, 0] for i in range(1, 8)]
    unary = [r.uniform(-2, 2) for _ in nodes]
    edge = {(k, p, c): r.uniform(-1, 1) for k in (False, True) for p in (0, 1) for c in (0, 1)}
    weight = {}
    for y in itertools.product((0, 1), repeat=len(nodes)):
        weight[y] = math.exp(sum(u for u, b in zip(unary, y) if b) + sum(edge[not nodes[i][0], y[nodes[i][1]], y[i]] for i in range(1, len(nodes))))
    z = sum(weight.values())
    chance, pairs = H.marginals(nodes, unary, edge)
    for i in range(len(nodes)):
        assert chance[i] == pytest.approx(sum(w for y, w in weight.items() if y[i]) / z)
        if i:
            assert pairs[i][3] == pytest.approx(sum(w for y, w in weight.items() if y[i] and y[nodes[i][1]]) / z)


def test_training_raises_the_likelihood_and_holds_out():
    pages = list(H.LABELLED)
    wrong = total = 0
    for k in range(0, len(pages), 4):
        model = H.train(tuple(p for i, p in enumerate(pages) if i % 4 != k % 4), rounds=120)
        for p in pages[k % 4:: 4]:
            page = H._filled(p)
            nodes, label = H.labels_of(page)
            texts = [H._text(n) if not n[0] and n[3] else "" for n in nodes]
            chance, _ = H.marginals(nodes, model.unary(H.features(nodes, texts)), model.edge)
            wrong += sum((c >= 0.5) != y for n, c, y in zip(nodes, chance, label) if not n[0])
            total += sum(not n[0] for n in nodes)
    assert wrong <= 0.3 * total  # templates unlike any it was trained on


def test_query_and_edges(spark, sf_dir):
    rows = [(1, "u", None), (2, None, ""), (None, "v", f"<article><p>{S * 3}</p></article>"), (1, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("kept_0", F.lit("y"))
    assert sorted((r.text for r in H.extracted(pages).collect())) == ["", "", "", " ".join((S * 3).split())]
    assert H.extracted(pages.where("false")).count() == 0
    given = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in op7_html_tree(spark, sf_dir).collect():
        body = re.search(r"<article>(.*?)</article>", given[r.page_id], re.S)[1]
        lines = re.sub(r"</?(?:p|h1)>", "\n", re.sub(r"</?b>", "", body.replace("<br>", " "))).split("\n")
        assert r.text == "\n".join(x for x in (" ".join(html.unescape(line).split()) for line in lines) if x) and r.n_chars == len(r.text)
