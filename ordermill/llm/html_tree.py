"""Main text of HTML pages: content marginals of a tree-structured graphical model over the DOM.

Nodes are block elements and the runs of text between them; each is content or not. A node's potential
comes from its tag, class words, text length and link share, an edge's from the labels of parent and child.
Messages passed up and then down give exact marginals; text runs that are more likely content than not make
the output. Weights are fitted to a small set of labelled pages by gradient ascent on their likelihood,
whose gradient is observed minus expected features, both from the same message passing.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

_BLOCKS = frozenset(
    "html body head div section article main aside nav header footer form fieldset ul ol li dl dt dd p h1 h2 h3 h4 h5 h6 table thead tbody tfoot tr td th caption "
    "blockquote pre xmp figure figcaption details summary address hgroup search menu dialog button select option label legend noscript template video audio center".split()
)
_CLOSES_P = frozenset(
    "div section article main aside nav header footer form fieldset ul ol dl p h1 h2 h3 h4 h5 h6 table blockquote pre figure figcaption details address hgroup search menu dialog hr center xmp".split()
)
#: Start tags that end an open element of these names, unless one of the others stands between.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "body": ({"head"}, set()),
}
#: Elements whose content is no text of the page. Formulas, drawings and fallback content (math, svg, canvas, object) are text like any other.
_RAW = frozenset("script style title textarea iframe noembed noframes".split())
_SPACED = frozenset("br hr img input wbr text mtd".split()) - {"wbr"}
#: Elements that say what part of the page their descendants belong to.
_PARTS = frozenset("article main nav aside header footer form section".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)""", re.S)
_MARKS = re.compile(r"""[>"']""")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_XMP_END = re.compile(r"</xmp(?=[\s/>])", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

TAG, PARENT, NAMES, PIECES, LINKED = range(5)


def tag_ends(page: str) -> tuple[list[int], list[int]]:
    """Places of all ``>`` and quotes, and for each the place of the ``>`` that ends a tag whose attributes go on there, -1 if none does.

    Quoted text is skipped as a whole. Found from the end of the page backwards, in one pass.
    """
    marks = [(m.start(), m.group()) for m in _MARKS.finditer(page)]
    ends, later = [-1] * (len(marks) + 1), {}
    for i in range(len(marks) - 1, -1, -1):
        place, mark = marks[i]
        if mark == ">":
            ends[i] = place
        else:
            ends[i] = ends[later[mark] + 1] if mark in later else -1
            later[mark] = i
    return [place for place, _ in marks], ends


def parse(page: str) -> list[list]:
    """Nodes in page order as [tag, parent, names, text pieces, linked characters]; the root is node 0, text runs have tag ''."""
    nodes: list[list] = [["html", -1, (), None, 0]]
    stack, run, in_link, at = [0], -1, False, 0
    opened: Counter = Counter()  # open elements by name
    marks, ends = tag_ends(page)

    def add_text(raw: str, literal: bool = False) -> None:
        nonlocal run
        if raw:
            if run < 0:
                if raw.isspace():
                    return
                nodes.append(["", stack[-1], (), [], 0])
                run = len(nodes) - 1
            text = html.unescape(raw) if "&" in raw and not literal else raw
            nodes[run][PIECES].append(text)
            if in_link:
                nodes[run][LINKED] += len(text)

    def cut(depth: int) -> None:
        opened.subtract(nodes[i][TAG] for i in stack[depth:])
        del stack[depth:]

    def open_at(names, stops) -> int:
        if not any(opened[name] for name in names):
            return 0
        for depth in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[depth]][TAG]
            if tag in names:
                return depth
            if tag in stops:
                break
        return 0

    while at < len(page):
        m = _TAG.search(page, at)
        if m is None:
            add_text(page[at:])
            break
        if m.group(2) is None:
            add_text(page[at: m.start()])
            at = m.end()
            continue
        end = ends[bisect_left(marks, m.end())]
        if end < 0:  # a quote that is never closed is no quote
            end = page.find(">", m.end())
        if end < 0:
            add_text(page[at:])
            break
        add_text(page[at: m.start()])
        name, closing, attributes, at = m.group(2).lower(), m.group(1), page[m.end(): end], end + 1
        if name == "a":
            in_link = not closing
        elif name in _RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
        elif closing:
            if name in _BLOCKS:
                depth = open_at({name}, set() if name != "p" else _CLOSES_P - {"p"})
                if depth:
                    cut(depth)
                    run = -1
        elif name in _BLOCKS or name == "hr":
            run = -1
            if name in _CLOSES_P and (depth := open_at({"p"}, {"td", "th", "button", "template"})):
                cut(depth)
            if name in _CLOSES:
                names, stops = _CLOSES[name]
                while depth := open_at(names, stops):
                    cut(depth)
            if name in ("html", "hr"):
                continue
            found = [x for g in _NAMES.findall(attributes) for x in g if x] if attributes else []
            words = {p.lower() for x in found for p in _PART.findall(x)}
            if attributes and _HIDDEN.search(attributes):
                words.add("hidden!")
            nodes.append([name, stack[-1], tuple(sorted(words)), None, 0])
            stack.append(len(nodes) - 1)
            opened[name] += 1
            if name == "xmp" and (end := _XMP_END.search(page, at)):  # tags and references in it are its text
                add_text(page[at: end.start()], literal=True)
                at = end.start()
        elif name in _SPACED:
            add_text(" ")
    return nodes


def _text(node: list) -> str:
    return " ".join("".join(node[PIECES]).split())


def features(nodes: list[list], texts: list[str]) -> list[list[str]]:
    """Names of the features of each node that are set."""
    n = len(nodes)
    length, linked = [len(t) for t in texts], [node[LINKED] for node in nodes]
    for i in range(n - 1, 0, -1):
        length[nodes[i][PARENT]] += length[i]
        linked[nodes[i][PARENT]] += linked[i]
    out, part = [], [""] * n
    for i, node in enumerate(nodes):
        tag = node[TAG]
        part[i] = tag if tag in _PARTS or not i else part[node[PARENT]]
        size = min(8, length[i].bit_length())
        share = min(3, 4 * linked[i] // max(1, length[i])) if length[i] else 0
        found = ["all", f"tag {tag}", f"part {part[i]}"]
        if tag:
            found += [f"block size {size // 2}", f"block links {share}"]
            found += [f"name {w}" for w in node[NAMES]] + [f"stem {w[:4]}" for w in node[NAMES] if len(w) > 3]
        else:
            above = nodes[node[PARENT]][TAG]
            found += [f"text size {size // 2}", f"text links {share}", f"text links {share} part {part[i]}", f"text in {'h' if above in _HEADINGS else above}"]
            if texts[i][-1:] in ".!?…":
                found.append("text stop")
        out.append(found)
    return out


def marginals(nodes: list[list], unary: list[float], edge: dict[tuple[bool, int, int], float]) -> tuple[list[float], list[tuple[float, float, float, float]]]:
    """P(content) of each node, and of each edge to the parent P(parent, child) for (0,0), (0,1), (1,0), (1,1)."""
    n = len(nodes)
    up, kinds = list(unary), [not node[TAG] for node in nodes]
    message = [0.0] * n

    def sent(odds: float, kind: bool) -> float:
        """Log odds that a node with these odds (without the receiver's message) gives to its neighbour over an edge."""
        one = _log_sum(edge[kind, 1, 0], odds + edge[kind, 1, 1])
        return one - _log_sum(edge[kind, 0, 0], odds + edge[kind, 0, 1])

    for i in range(n - 1, 0, -1):  # children come after their parents
        message[i] = sent(up[i], kinds[i])
        up[nodes[i][PARENT]] += message[i]
    belief, pairs = list(up), [(0.0, 0.0, 0.0, 0.0)] * n
    for i in range(1, n):
        rest = belief[nodes[i][PARENT]] - message[i]
        k = kinds[i]
        a, b, c, d = edge[k, 0, 0], edge[k, 0, 1] + up[i], edge[k, 1, 0] + rest, edge[k, 1, 1] + rest + up[i]
        top = max(a, b, c, d)
        a, b, c, d = math.exp(a - top), math.exp(b - top), math.exp(c - top), math.exp(d - top)
        total = a + b + c + d
        pairs[i] = (a / total, b / total, c / total, d / total)
        belief[i] = math.log(max(b + d, 1e-300)) - math.log(max(a + c, 1e-300))
    return [1 / (1 + math.exp(-max(-500.0, min(500.0, b)))) for b in belief], pairs


def _log_sum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a >= b else b + math.log1p(math.exp(a - b))


class Model:
    def __init__(self, weights: dict[str, float], edge: dict[tuple[bool, int, int], float]):
        self.weights, self.edge = weights, edge

    def unary(self, found: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum(get(f, 0.0) for f in fs) for fs in found]

    def text(self, page: str | None) -> str:
        """Blocks of main text in page order, joined by line feeds; empty for an empty or null page."""
        if not page:
            return ""
        nodes = parse(page)
        texts = [_text(node) if not node[TAG] and node[PIECES] else "" for node in nodes]
        chance, _ = marginals(nodes, self.unary(features(nodes, texts)), self.edge)
        return "\n".join(t for t, p in zip(texts, chance, strict=True) if t and p >= 0.5)


#: Invented pages. In the element marked data-main text is content, except inside elements marked data-not.
#: Braces stand for paragraphs of 60, 20 and 4 words, {w} for one word.
LABELLED = (
    '<html><head><title>{s}</title></head><body><nav><ul><li><a href=1>{w}</a></li><li><a href=2>{w}</a></li></ul></nav><div class="ad">{m}</div><article data-main><h1>{m}</h1><p>{l}</p><p>{w}.</p><p>{m}</p><p>{w}.</p></article><footer>&copy; {s} {m}</footer></body></html>',
    '<body><header><h1><a href=/>{w}</a></h1><p>{s}</p></header><main data-main><h2>{s}</h2><p>{l}</p><ul><li>{m}</li><li>{s}</li></ul><p>{m}</p><aside data-not><h3>{s}</h3><p>{m}</p></aside><p>{w}.</p></main><footer><p>{m}</p></footer></body>',
    '<body><div id="header">{s}</div><div class="menu"><a href=1>{w}</a> <a href=2>{w}</a></div><div class="cookie-notice"><p>{m}</p><button>{w}</button></div><div id="content" data-main><h1>{s}</h1><p>{l}</p><p>{l}</p><blockquote>{m}</blockquote></div><div class="sidebar"><h3>{s}</h3><p>{m}</p><ul><li><a href=1>{s}</a></li></ul></div><div id="footer">{m}</div></body>',
    '<body><nav><a href=1>{w}</a><a href=2>{w}</a></nav><article data-main><h1>{s}</h1><p>{m}</p><div class="ad" data-not>{m}</div><p>{l}</p><h2>{s}</h2><p>{m}</p></article><section class="comments"><h2>{s}</h2><div class="comment"><p>{m}</p></div><div class="comment"><p>{l}</p></div><form><label>{w}</label><textarea>{s}</textarea><button>{w}</button></form></section><footer>{s}</footer></body>',
    '<body><div class="banner notice">{m}</div><header>{s}</header><div class="post-body entry" data-main>{l}<br>{m}<p>{l}</p><table><tr><th>{w}</th><td>{s}</td></tr></table></div><div id="comments"><ol><li>{m}</li><li>{l}</li></ol></div><aside class="widget"><p>{m}</p></aside><footer><ul><li><a href=1>{s}</a></li></ul><p>{m}</p></footer></body>',
    '<body><form class="search"><input><button>{w}</button></form><div class="newsletter-signup"><h3>{s}</h3><p>{m}</p><form><label>{s}</label><input><button>{w}</button></form></div><article class="story" data-main><h1>{s}</h1><p>{w}.</p><p>{w}.</p><p>{l}</p><pre>{m}</pre></article><div class="related"><h3>{s}</h3><ul><li><a href=1>{m}</a></li><li><a href=2>{m}</a></li></ul></div><div class="promo advert">{m}</div><footer>&copy; {s}</footer></body>',
    '<body><div role="navigation"><ul><li><a href=1>{s}</a></li><li><a href=2>{s}</a></li></ul></div><div class="alert"><p>{m}</p></div><div class="article-text" data-main><p>{l}</p><p>{s}.</p><p>{l}</p></div><div class="share social"><a href=1>{w}</a><a href=2>{w}</a></div><div class="sponsored ads">{l}</div><div class="footer">{m}</div></body>',
    '<body><nav class="breadcrumb"><a href=1>{w}</a> / <a href=2>{w}</a></nav><main><article data-main><h1>{s}</h1><p>{l}</p><figure><figcaption>{s}</figcaption></figure><p>{m}</p><ol><li>{s}</li><li>{m}</li></ol></article><section id="reader-comments"><article class="comment"><p>{m}</p></article><article class="comment"><p>{l}</p></article></section></main><aside><p>{l}</p></aside><footer><p>{m}</p><p>{s}</p></footer></body>',
    '<body><div class="page"><div class="top"><a href=1>{w}</a></div><p class="notice">{m}</p><div class="text" data-main><h1>{s}</h1><p>{l}<p>{m}<p>{w}.</div><form action=x><p>{m}</p><select><option>{w}<option>{w}</select></form></div><footer>{m}</footer></body>',
    '<body><article data-main><p><b>{m}<br><p>{m}</p><p>{w}.</p><p>{w}.</p><p><b>{l}<br><p>{m}</p></article><footer>&copy; {w} &middot; {m}</footer>',
    '<body><nav><ul><li><a href=1>{w}</a></li></ul></nav><div class="ad">{m}</div><article data-main><h1>{s}</h1><p>{w}.</p></article><footer>{m}</footer></body>',
    '<body><div class="sidebar"><p>{l}</p><p>{m}</p></div><div class="notice">{m}</div><article data-main><h1>{m}</h1><p>{l}</p></article><div class="comments"><p>{l}</p><p>{m}</p></div><div class="reply"><p>{m}</p></div><form><p>{s}</p></form><footer>{s}</footer></body>',
    '<body><header><nav><a href=1>{w}</a></nav></header><div id="main" data-main><p>{m}</p><p>{l}</p><p>{m}</p></div><div id="disqus-thread" class="discussion"><div class="response"><p>{l}</p></div></div><div class="popup modal consent"><p>{m}</p></div><footer>{m}</footer></body>',
    '<body><header><h1>{s}</h1><p>{m}</p></header><article data-main><h1>{s}</h1><p>{l}</p><p>{w}.</p><p>{m}</p></article><ol class="comment-list"><li><p>{m}</p></li><li><p>{l}</p></li></ol><footer><p>{m}</p></footer></body>',
    '<body><header id="top"><div><a href=/>{w}</a></div><p>{s}</p></header><div class="advertisement"><p>{l}</p></div><div data-main><h1>{s}</h1><p>{l}</p><p>{w}.</p><p>{l}</p></div><div class="replies"><ul class="reply-list"><li><p>{l}</p></li><li>{m}</li></ul></div></body>',
    '<body><header class="site"><h2>{s}</h2><nav><ul><li><a href=1>{w}</a></li></ul></nav></header><main data-main><p>{l}</p><div class="advertising" data-not><p>{m}</p></div><ul><li>{s}</li><li>{m}</li></ul><ol><li>{s}</li></ol><p>{l}</p></main><div class="feedback"><h3>{s}</h3><ol><li><p>{l}</p></li></ol></div></body>',
    '<body><div class="navbar topbar"><p>{s}</p></div><div class="subscribe signup"><p>{m}</p></div><article data-main><h1>{s}</h1><p>{l}</p></article><div class="widget adbox"><p>{l}</p></div><section class="user-comments discussion"><p>{l}</p><p>{m}</p></section><div class="disclaimer warning"><p>{m}</p></div></body>',
    '<body><header><h1>{w}</h1><p>{m}</p></header><div data-main><h1>{s}</h1><p>{l}</p><p>{w}.</p></div><footer><p>{s}</p></footer></body>',
    '<body><header><h1>{w}</h1><p>{s}</p><p>{m}</p></header><nav><a href=1>{w}</a></nav><main data-main><p>{l}</p><ul><li>{s}</li></ul></main><aside><h2>{w}</h2><p>{m}</p></aside><footer><h3>{w}</h3><p>{m}</p></footer></body>',
    '<body><div class="header"><h1>{w}</h1><p>{m}</p></div><article data-main><h1>{w}</h1><p>{m}</p><p>{w}.</p></article><header><h2>{w}</h2><p>{m}</p></header></body>',
    '<body><p>{s}</p><article><header data-not><p>{s}</p></header><div data-main><p>{l}</p><p>{m}</p></div><footer data-not><p>{s}</p></footer></article><aside class="warning notice">{m}</aside></body>',
    '<body><nav><ul><li><a href=1>{w}</a></li><li><a href=2>{s}</a></li></ul></nav><article data-main><h1>{s}</h1><p>{m}</p><ul><li><a href=1>{s}</a></li><li><a href=2>{w}</a></li><li><a href=3>{s}</a></li></ul><p>{l}</p></article><footer><ul><li><a href=1>{w}</a></li></ul></footer></body>',
    '<body><header><p>{s}</p></header><main data-main><h1>{s}</h1><p>{l}</p><h2>{w}</h2><ol><li><a href=1>{s}</a></li><li><a href=2>{m}</a> {s}</li></ol><table><tr><td><a href=3>{s}</a></td><td>{w}</td></tr></table></main><aside><ul><li><a href=1>{s}</a></li><li><a href=2>{s}</a></li></ul></aside></body>',
    '<body><nav><a href=1>{w}</a><a href=2>{w}</a></nav><article data-main><h2>{s}</h2><ul><li><a href=1>{s}</a></li><li><a href=2>{s}</a></li><li><a href=3>{s}</a></li></ul></article><div class="menu"><ul><li><a href=1>{s}</a></li><li><a href=2>{w}</a></li></ul></div><footer><p>{s}</p></footer></body>',
    '<body><article data-main><p><a href=1>{s}</a></p><p><a href=2>{m}</a></p><p>{l}</p><h3>{w}</h3><ul><li>{s} <a href=1>{s}</a></li><li><a href=2>{w}</a></li></ul></article><nav><ul><li><a href=1>{s}</a></li></ul></nav><form><p>{s}</p></form></body>',
)


def _filled(page: str) -> str:
    """Placeholders become runs of invented words; how long they are is what matters."""
    words, place = "tal oren misk veda lun prast ika domer fen ulis garot nem".split(), [0]

    def fill(m: re.Match) -> str:
        count = {"l": 60, "m": 20, "s": 4, "w": 1}[m.group(1)]
        place[0] += 7
        text = " ".join(words[(place[0] + i * i) % len(words)] + ("." if i % 9 == 8 else "") for i in range(count))
        return text.capitalize() + "." * (count > 4 and not text.endswith("."))

    return re.sub(r"\{(\w)\}", fill, page)


def labels_of(page: str) -> tuple[list[list], list[int]]:
    """Nodes and labels of a labelled page; an element is content if any text in it is."""
    marked = re.sub(r"<(\w+)([^>]*) data-(main|not)\b", r'<\1 id="mark-\3"\2', page)
    nodes = parse(marked)
    label = [0] * len(nodes)
    inside = [False] * len(nodes)
    for i, node in enumerate(nodes):
        if i:
            inside[i] = inside[node[PARENT]]
        if "mark" in node[NAMES]:
            inside[i] = "main" in node[NAMES] and "mark" in node[NAMES] and "not" not in node[NAMES]
        label[i] = int(inside[i] and not node[TAG])
    for i in range(len(nodes) - 1, 0, -1):
        label[nodes[i][PARENT]] |= label[i]
    return parse(page), label


def train(pages: tuple[str, ...] = LABELLED, rounds: int = 400, rate: float = 0.3, shrink: float = 0.003) -> Model:
    """Weights by gradient ascent (steps scaled per weight by the gradients so far), with ridge shrinkage."""
    examples = []
    for page in pages:
        nodes, label = labels_of(_filled(page))
        examples.append((nodes, label, features(nodes, [_text(x) if not x[TAG] and x[PIECES] else "" for x in nodes])))
    model = Model({}, {(k, p, c): 0.0 for k in (False, True) for p in (0, 1) for c in (0, 1)})
    grown: dict = {}
    for _ in range(rounds):
        gradient: dict = {}
        for nodes, label, found in examples:
            chance, pairs = marginals(nodes, model.unary(found), model.edge)
            for i, node in enumerate(nodes):
                for f in found[i]:
                    gradient[f] = gradient.get(f, 0.0) + label[i] - chance[i]
                if i:
                    for k, (p, c) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
                        key = (not node[TAG], p, c)
                        gradient[key] = gradient.get(key, 0.0) + (label[node[PARENT]] == p and label[i] == c) - pairs[i][k]
        for key, g in gradient.items():
            held = model.edge if isinstance(key, tuple) else model.weights
            g -= shrink * held.get(key, 0.0)
            grown[key] = grown.get(key, 0.0) + g * g
            held[key] = held.get(key, 0.0) + rate * g / math.sqrt(grown[key] + 1e-8)
    return model


@lru_cache(maxsize=1)
def trained() -> Model:
    return train()


def extracted(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), model: Model | None = None) -> DataFrame:
    """(*keep, text) for every row of ``pages``; a null or empty html has an empty text."""
    weights = model or trained()

    def run(batches):
        for batch in batches:
            texts = [weights.text(page.as_py()) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays([*[batch.column(f"kept_{i}") for i in range(len(keep))], pa.array(texts, pa.string())], names=[*[f"kept_{i}" for i in range(len(keep))], "text"])

    rows = pages.select(*[pages[k].alias(f"kept_{i}") for i, k in enumerate(keep)], pages["html"].alias("html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, text string").toDF(*keep, "text")
