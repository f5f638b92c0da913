"""Main text of web pages: a tree-structured graphical model over the elements of a page."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import ship, table

MAX_LABELLED = 150  # pages with an article or main element that the model is trained on, each once more in every dress
LONGEST_LABELLED = 60_000  # code points of a page to learn from; it bounds what training holds, and no page is read less for it
EPOCHS, RATE, SHRINK = 12, 0.3, 0.002

# A mark always ends, at the latest with the page, and never gives characters back, so a page is read in linear time. A quote that is
# never closed is a character like others; only the last quote of its kind can be one.
MARK = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(>|\Z)|<[!?][^>]*+(?:>|\Z)", re.S
)
# Character references beyond the last code point, and leading zeros, which int() refuses from some thousand digits on.
ZEROS, BEYOND = re.compile(r"&#([xX]?)0+(?=[0-9a-fA-F])"), re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[a-z]+")
# Fixed values of HTML: elements without content, with raw text, never shown, and those that start a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul
    button select option label""".split()
)
# An element in the first column is closed by a start tag of those in the second.
CLOSED_BY = {
    "p": BLOCK - {"button", "select", "option", "label", "body", "html", "head"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "option": frozenset({"option"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "head": frozenset({"body"}),
}
CLOSES: dict[str, list[str]] = {}
for _open, _starts in CLOSED_BY.items():
    for _start in _starts:
        CLOSES.setdefault(_start, []).append(_open)
SCOPE = frozenset("html body article aside div section main table td th ul ol dl form blockquote header footer nav figure".split())

# What names in class, id and role speak for (above) and against (below) content, before anything is learnt.
FOR_NAMES = "article content post entry story body main text page"
AGAINST_NAMES = """nav menu navbar sidebar side footer header ad ads advert advertisement banner promo sponsor sponsored comment comments reply
discussion disqus cookie consent notice alert popup modal newsletter subscribe share social related recommended widget breadcrumb breadcrumbs
login signup search form pager pagination copyright toolbar complementary contentinfo navigation"""
AGAINST = frozenset(AGAINST_NAMES.split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())
HIDDEN = frozenset("article main nav aside footer header".split())
CONTENT_TAGS = "article main p h1 h2 h3 blockquote pre"
BOILERPLATE_TAGS = "nav aside footer header form button select menu label fieldset dialog head"
PRIOR = (
    {f"tag:{t}": 1.0 for t in CONTENT_TAGS.split()}
    | {f"tag:{t}": -3.0 for t in BOILERPLATE_TAGS.split()}
    | {f"name:{n}": 1.5 for n in FOR_NAMES.split()}
    | {f"name:{n}": -4.0 for n in AGAINST_NAMES.split()}
    | {"tag:article": 3.0, "tag:main": 3.0, "tag:html": -3.0, "tag:body": -2.0, "bias": -0.3}
    | {f"links:2:{kin}": -1.5 for kin in range(3)}
)
NAMES = frozenset(f"{FOR_NAMES} {AGAINST_NAMES}".split())
# Log potentials of (parent, child): an inline child hardly ever differs from its parent, a block's child seldom.
PAIRS = {"inline": [[1.5, -1.5], [-1.5, 1.5]], "block": [[0.8, -0.8], [-1.2, 1.2]]}


@dataclass
class Node:
    tag: str
    parent: int
    names: tuple[str, ...] = ()
    label: int | None = None  # given by the attribute data-main of a labelled page
    own: int = 0  # code points of text directly inside
    total: int = 0
    linked: int = 0
    marks: int = 0


@dataclass
class Page:
    """Elements in the order of their start tags, and pieces of text as (element, block number, text)."""

    nodes: list[Node] = field(default_factory=list)
    texts: list[tuple[int, int, str]] = field(default_factory=list)


def unescaped(piece: str) -> str:
    """``piece`` with its character references decoded; those beyond the last code point are U+FFFD."""
    if "&#" in piece:
        piece = BEYOND.sub("\ufffd", ZEROS.sub(r"&#\1", piece))
    return unescape(piece)


class OpenElements:
    """The elements that are open at a place of a page, and where on the stack the last of each name and the last scope is.

    An element is pushed and popped once, and nothing walks the stack otherwise, however many elements are open.
    """

    def __init__(self):
        self.stack: list[tuple[int, str]] = [(0, "html")]
        self.at: dict[str, list[int]] = {}
        self.scopes = [0]

    @property
    def top(self) -> int:
        return self.stack[-1][0]

    def push(self, node: int, name: str) -> None:
        self.at.setdefault(name, []).append(len(self.stack))
        if name in SCOPE:
            self.scopes.append(len(self.stack))
        self.stack.append((node, name))

    def cut(self, place: int) -> None:
        while len(self.stack) > place:
            _, name = self.stack.pop()
            self.at[name].pop()
            if name in SCOPE:
                self.scopes.pop()

    def end(self, name: str) -> None:
        """An end tag closes the last element of its name; one that is no scope itself does not reach out of a scope."""
        places = self.at.get(name)
        if places and (name in SCOPE or places[-1] > self.scopes[-1]):
            self.cut(places[-1])

    def start(self, name: str) -> None:
        """A start tag closes the last element that it implies the end of, within the scope."""
        place = max((self.at[other][-1] for other in CLOSES.get(name, ()) if self.at.get(other)), default=-1)
        if place >= self.scopes[-1] and place > 0:
            self.cut(place)


def parse(html: str | None) -> Page:
    """A lenient reading of ``html``: unknown end tags are ignored, open elements end with their parent."""
    page = Page([Node("html", -1)])
    html = html or ""
    opened, block, at = OpenElements(), 0, 0
    nodes = page.nodes

    def text(piece: str) -> None:
        if piece and not (piece := unescaped(piece) if "&" in piece else piece).isspace():
            node = nodes[opened.top]
            node.own += len(piece)
            node.marks += piece.count(".") + piece.count(",")
        if piece:
            page.texts.append((opened.top, block, piece))

    while (m := MARK.search(html, at)) is not None:
        text(html[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name or not m[4]:
            continue
        if m[1]:
            opened.end(name)
            block += name in BLOCK
            continue
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(html, at)
            at = len(html) if end is None else end.start()
            end = html.find(">", at)
            at = len(html) if end < 0 else end + 1
            continue
        if name == "br":
            page.texts.append((opened.top, block, " "))
        if name in VOID:
            block += name in BLOCK
            continue
        if name == "html":
            continue
        opened.start(name)
        block += name in BLOCK
        names, label = (), None
        if m[3] and not m[3].isspace():
            for a in ATTRIBUTE.finditer(m[3]):
                key = a[1].lower()
                value = a[2] or a[3] or a[4] or ""
                if key in ("class", "id", "role"):
                    names += tuple(n for n in WORD.findall(value.lower()) if n in NAMES)
                elif key == "data-main":
                    label = int(value == "1")
        nodes.append(Node(name, opened.top, names, label))
        opened.push(len(nodes) - 1, name)
    text(html[at:])
    for k in range(len(nodes) - 1, 0, -1):
        node, parent = nodes[k], nodes[nodes[k].parent]
        node.total += node.own
        if node.tag == "a":
            node.linked = node.total
        parent.total += node.total
        parent.linked += node.linked
        parent.marks += node.marks
    nodes[0].total += nodes[0].own
    return without_empty(page)


def without_empty(page: Page) -> Page:
    """``page`` without elements that hold no text: they say nothing, and a page may consist of them."""
    place, kept = [0] * len(page.nodes), [page.nodes[0]]
    for k, node in enumerate(page.nodes[1:], 1):
        if node.total:
            node.parent = place[node.parent]
            place[k] = len(kept)
            kept.append(node)
        else:
            place[k] = place[node.parent]
    return Page(kept, [(place[k], block, piece) for k, block, piece in page.texts])


def features(page: Page, hide_tags: bool = False) -> list[tuple[str, ...]]:
    """Names of the features of each element. ``hide_tags`` shows telling tags as ``div``.

    Only blocks have a share of links: an inline element goes with its block. ``prose`` counts an element's children that
    are running text, ``kin`` the others of its parent, so a paragraph that is one link stands by its neighbours.
    """
    whole, n, found = max(1, page.nodes[0].total), len(page.nodes), []
    links = [node.linked / node.total if node.total else 0 for node in page.nodes]
    running = [node.tag in PROSE and share < 0.6 and AGAINST.isdisjoint(node.names) for node, share in zip(page.nodes, links)]
    prose = [0] * n
    for k in range(1, n):
        prose[page.nodes[k].parent] += running[k]
    for k, node in enumerate(page.nodes):
        tag = "div" if hide_tags and node.tag in HIDDEN else node.tag
        names = (
            "bias",
            f"tag:{tag}",
            f"length:{min(6, int(math.log2(1 + node.own) / 1.7))}",
            f"share:{min(4, int(5 * node.total / whole))}",
            f"marks:{min(3, int(400 * node.marks / (1 + node.total) / 4))}",
        )
        if node.tag in BLOCK:
            share = 0 if links[k] < 0.2 else 1 if links[k] < 0.6 else 2
            kin = min(2, prose[node.parent] - running[k]) if k and share else 0
            names += (f"links:{share}:{kin}",) if node.tag in PROSE else (f"links:{share}:{kin}", f"{'body' if node.tag == 'body' else 'prose'}:{min(3, prose[k])}")
        found.append(names + tuple(f"name:{name}" for name in node.names) if node.names else names)
    return found


def _sum(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    return (a if a > b else b) + math.log1p(math.exp(-abs(a - b)))


@dataclass
class TreeModel:
    """Weights of an element's features for being content, and potentials between an element and its parent."""

    weights: dict[str, float]
    pairs: dict[str, list[list[float]]]

    def marginals(self, page: Page, found: list[tuple[str, ...]]) -> tuple[list[float], list[list[list[float]]]]:
        """Each element's probability of being content, and of each pair of values with its parent."""
        belief, rests = self.propagated(page, found)
        content = [1 / (1 + math.exp(max(-700, min(700, no - yes)))) for no, yes in belief]
        both = [[[0.0, 0.0], [0.0, 0.0]]]
        for node, (rest, own) in zip(page.nodes[1:], rests[1:]):
            t = self.pairs["block" if node.tag in BLOCK else "inline"]
            joint = [[rest[p] + t[p][c] + own[c] for c in (0, 1)] for p in (0, 1)]
            top = max(map(max, joint))
            joint = [[math.exp(v - top) for v in row] for row in joint]
            total = sum(map(sum, joint))
            both.append([[v / total for v in row] for row in joint])
        return content, both

    def propagated(self, page: Page, found: list[tuple[str, ...]]) -> tuple[list[tuple[float, float]], list]:
        """Sum-product over the tree: messages from the last element up to the root, then from the root down.

        Returns each element's belief in 0 and 1 (logarithms), and what its parent and itself said before they met.
        """
        nodes, score = page.nodes, self.weights.get
        known = {names: sum(score(name, 0.0) for name in names) for names in set(found)}
        no, yes = [0.0] * len(nodes), [known[names] for names in found]
        sent: list[tuple[float, float]] = [(0.0, 0.0)] * len(nodes)
        tables = {kind: (*rows[0], *rows[1]) for kind, rows in self.pairs.items()}
        pair = [tables["block" if node.tag in BLOCK else "inline"] for node in nodes]
        for k in range(len(nodes) - 1, 0, -1):
            t00, t01, t10, t11 = pair[k]
            up = sent[k] = (_sum(t00 + no[k], t01 + yes[k]), _sum(t10 + no[k], t11 + yes[k]))
            parent = nodes[k].parent
            no[parent] += up[0]
            yes[parent] += up[1]
        rests: list = [None] * len(nodes)
        for k in range(1, len(nodes)):
            t00, t01, t10, t11 = pair[k]
            parent = nodes[k].parent
            without = (no[parent] - sent[k][0], yes[parent] - sent[k][1])
            rests[k] = (without, (no[k], yes[k]))
            no[k] += _sum(without[0] + t00, without[1] + t10)
            yes[k] += _sum(without[0] + t01, without[1] + t11)
        return list(zip(no, yes)), rests

    def main_text(self, html: str | None) -> str:
        """Texts of elements that are more likely content than not: one space between words of a block and between blocks."""
        page = parse(html)
        belief, _ = self.propagated(page, features(page))
        blocks: dict[int, list[str]] = {}
        for node, block, piece in page.texts:
            if belief[node][1] > belief[node][0]:
                blocks.setdefault(block, []).append(piece)
        joined = (" ".join("".join(pieces).split()) for pieces in blocks.values())
        return " ".join(piece for piece in joined if piece)


def labels_of(page: Page) -> list[int] | None:
    """An element's label is that of the nearest element around it that has one; the root's is that of the body. A page without any has none."""
    if all(node.label is None for node in page.nodes):
        return None
    labels: list[int] = []
    for k, node in enumerate(page.nodes):
        labels.append(node.label if node.label is not None else labels[node.parent] if k else 0)
    labels[0] = max((y for node, y in zip(page.nodes, labels) if node.tag == "body" and node.parent == 0), default=labels[0])
    return labels


ARTICLE = re.compile(r"<(article|main)\b(.*?)</\1\s*>", re.I | re.S)


def labelled(html: str) -> str | None:
    """``html`` with its only article or main element labelled as content; None without exactly one such element."""
    found = ARTICLE.findall(html)
    return ARTICLE.sub(r'<\1 data-main="1"\2</\1>', html.replace("data-main", "data-was")) if len(found) == 1 else None


PARAGRAPH = re.compile(r"<p\b[^>]*>(.*?)(?=</?p\b|\Z)", re.I | re.S)
DRESSES = ("post", "bare", "open", "plain", "single", "alone")


def dressed(html: str, other: str, dress: str) -> str | None:
    """A labelled page in the dress of another site: its article, between furniture made of another page's texts.

    ``post``: in a named element, with a list and a table. ``bare``: its blocks side by side with the furniture, without an element around them;
    there the body itself counts as content. ``plain``: in an element without a name that holds furniture too; one more
    paragraph is a link. ``open``: as ``bare``, between telling elements. ``single``, ``alone``: one paragraph, in a named or a plain element.
    """
    own, spare = ARTICLE.search(html), parse(other)
    if own is None:
        return None
    words = [piece for _, _, piece in spare.texts if len(piece) > 20][:7] or ["lorem ipsum"]
    line = [words[k % len(words)] for k in range(7)]
    inner = own[2].partition(">")[2]
    links = f'<a href="/a">{line[2][:20]}</a><a href="/b">{line[3][:20]}</a>'
    listed = f'<ul><li><a href="/a">{line[2][:20]}</a></li><li><a href="/b">{line[3][:20]}</a></li></ul>'
    comments = f'<h2>{line[0][:20]}</h2><div class="comment"><p>{line[5]}</p><p>{line[4]}</p></div>'
    if dress == "bare":
        return (
            f'<html><body data-main="1"><div class="menu" data-main="0">{links}</div>'
            f'<div class="ad" data-main="0"><p>{line[6]}</p></div>{inner}<div class="comments" data-main="0"><p>{line[5]}</p></div>'
            f'<div class="share" data-main="0"><a href="/c">{line[1][:20]}</a></div><div class="copyright" data-main="0">{line[0]}</div></body></html>'
        )
    if dress == "open":
        return f'<html><body data-main="1"><nav data-main="0">{listed}</nav><div class="ad" data-main="0">{line[6]}</div>{inner}<aside data-main="0"><p>{line[4]}</p></aside><footer data-main="0">{line[0]}</footer></body></html>'
    if dress == "plain":
        return (
            f'<html><body><nav>{listed}</nav><div class="ad">{line[6]}</div><div data-main="1">{inner}<p><a href="/d">{line[1]}</a></p>'
            f'<div class="comments" data-main="0">{comments}</div>{listed.replace("<ul", """<ul data-main="0" """)}</div>'
            f"<aside><p>{line[4]}</p></aside><footer>{line[0]}</footer></body></html>"
        )
    if dress in ("single", "alone"):
        found = [piece for piece in PARAGRAPH.findall(inner) if len(piece) > 40] or [line[0]]
        name = ' class="post-body"' if dress == "single" else ""
        return (
            f'<html><body><nav>{listed}</nav><div{name} data-main="1"><p>{found[-1]}</p></div><div class="ad">{line[6]}</div>'
            f'<div class="comments">{comments}</div><div class="sidebar"><p>{line[4]}</p></div><footer>{line[0]}</footer></body></html>'
        )
    inner += f"<ul><li>{line[3]}</li><li>{line[4]}</li></ul><table><tr><td>{line[5][:10]}</td><td>{line[6][:10]}</td></tr></table>"
    return (
        f'<html><body><header class="site-header"><div class="logo">{line[0][:40]}</div></header><div class="cookie-notice">{line[1]}</div>'
        f'<div class="menu">{links}</div><div class="wrap"><div class="post" data-main="1">{inner}</div>'
        f'<aside class="sidebar"><h3>{line[3][:30]}</h3><p>{line[4]}</p></aside></div><div class="ad"><p>{line[6]}</p></div>'
        f'<section class="comments">{comments}</section>'
        f'<form class="search"><label>{line[2][:20]}</label><button>OK</button></form><footer><p>{line[6]}</p></footer></body></html>'
    )


def trained(pages: list[str]) -> TreeModel:
    """Gradient ascent on the likelihood of the labels: what is observed less what the marginals expect.

    Weights are drawn to their values of before, not to zero, so names that no training page has keep them.
    """
    model = TreeModel(dict(PRIOR), {kind: [list(row) for row in rows] for kind, rows in PAIRS.items()})
    examples = []
    for k, html in enumerate(pages):
        dresses = [(dressed(html, pages[k - 1], dress), dress == "bare" or dress == "post" and k % 2 == 1) for dress in DRESSES]
        for version, hidden in ((labelled(html), False), *dresses):
            page = parse(version) if version else None
            labels = labels_of(page) if page else None
            if labels:
                examples.append((page, features(page, hidden), labels))
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch)
        for page, found, labels in examples:
            content, both = model.marginals(page, found)
            scale = rate / math.sqrt(len(page.nodes))
            touched = {}
            for names, p, y in zip(found, content, labels):
                for name in names:
                    touched[name] = touched.get(name, 0.0) + (y - p)
            for name, slope in touched.items():
                weight = model.weights.get(name, 0.0)
                model.weights[name] = weight + scale * slope - rate * SHRINK * (weight - PRIOR.get(name, 0.0))
            for k in range(1, len(page.nodes)):
                node, pair = page.nodes[k], both[k]
                table = model.pairs["block" if node.tag in BLOCK else "inline"]
                for p in (0, 1):
                    for c in (0, 1):
                        table[p][c] += 0.2 * scale * ((labels[node.parent] == p and labels[k] == c) - pair[p][c])
    return model


def fit(pages: DataFrame, max_labelled: int = MAX_LABELLED, longest: int = LONGEST_LABELLED) -> TreeModel:
    """Train on at most ``max_labelled`` pages of at most ``longest`` code points that have an article or main element,
    chosen by a hash. Without any such page, as on an empty table, the model keeps what it starts from."""
    telling = pages.where(F.length("html") <= longest).where(F.col("html").rlike("(?i)<(article|main)\\b"))
    hashed = telling.select("html", F.xxhash64("html").alias("order"))
    last = hashed.select("order").distinct().orderBy("order").limit(max_labelled).agg(F.max("order")).first()[0]
    # Hashes were compared first, so only the chosen pages themselves come to the driver, each once.
    chosen = hashed.where(F.col("order") <= F.lit(last)).groupBy("order").agg(F.min("html").alias("html")).orderBy("order")
    return trained([row["html"] for row in chosen.collect()])


def main_texts(pages: DataFrame, model: TreeModel) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``.

    NULL and empty pages have an empty text, an empty table gives no rows. Repeated rows, NULL ids and urls, and other
    columns change nothing. Nothing is shuffled, and a page is read from its first to its last character, in time linear in
    its length whatever its marks are.
    """
    ship(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def extract(htmls: pd.Series) -> pd.Series:
        return htmls.map(lambda html: shared.value.main_text(None if html is None or html is np.nan else html))

    return pages.select("page_id", "url", extract("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_texts(pages, fit(pages))
