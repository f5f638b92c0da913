"""Main texts of pages that the model was not trained on, in other dresses, and of pages made to be slow."""

import html
import re
import time

import pyarrow.parquet as pq
import pytest

from tallymark.llm import html_text

FOLDERS = {name: f"/root/testdata/{name}/pages.parquet" for name in ("sf0.01", "sf0.1")}


@pytest.fixture(scope="module")
def learning():
    return pq.read_table(FOLDERS["sf0.01"]).column("html").to_pylist()[:100]


@pytest.fixture(scope="module")
def model(learning):
    return html_text.trained(learning)


def article_text(page):
    inner = re.search("<article>(.*)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("</?(p|h1|br)>", "\n", inner))).split())


@pytest.mark.parametrize("name", ["article", "div", "section", None])
def test_unseen_pages(model, learning, name):
    """The article's element keeps its name, has another one, or is not there."""
    seen = set(learning)
    pages = [page for page in pq.read_table(FOLDERS["sf0.1"]).column("html").to_pylist()[-400:] if page not in seen][:250]
    tags = (f"<{name}>", f"</{name}>") if name else ("", "")
    dressed = [page.replace("<article>", tags[0]).replace("</article>", tags[1]) for page in pages]
    right = sum(model.main_text(other) == article_text(page) for page, other in zip(pages, dressed))
    assert len(pages) == 250 and right >= 248


def line(k):
    return f"Paragraph {k} of the story, with commas, and some more words to make it long enough. It ends here, after two sentences."


LINES = "".join(f"<p>{line(k)}</p>" for k in range(5))
TEXT = " ".join(map(line, range(5)))
LINK = "A paragraph that is one whole link, alone."
COMMENTS = '<div class="comments"><h3>Comments</h3><div class="comment"><p>I do not agree with this at all, sorry.</p></div></div>'
RELATED = '<ul class="related"><li><a href=/x>Another story to read</a></li><li><a href=/y>Yet another story</a></li></ul>'


@pytest.mark.parametrize(
    "body, want",
    [
        (f'<article><h1>T</h1>{LINES}<p><a href="/z">{LINK}</a></p></article>', f"T {TEXT} {LINK}"),
        (f'<div class="post"><h1>T</h1><p>{line(0)}</p><p><a href="/z">{LINK}</a></p><p>{line(1)}</p></div>', f"T {line(0)} {LINK} {line(1)}"),
        (f"<div><h1>T</h1>{LINES}{COMMENTS}</div>", f"T {TEXT}"),
        (f"<div><h1>T</h1>{LINES}{RELATED}</div>", f"T {TEXT}"),
        (f"<article><h1>T</h1>{LINES}{COMMENTS}{RELATED}</article>", f"T {TEXT}"),
        (f'<div class="post-body"><p>{line(0)}</p></div>', line(0)),
        (f"<div><p>{TEXT}</p></div>", TEXT),
        (f"<article><h1>T</h1>{LINES}<ul><li>first</li><li>second</li></ul><table><tr><td>1</td><td>2</td></tr></table></article>", f"T {TEXT} first second 1 2"),
        (f'<div id="content"><h1>T</h1>{LINES}<div class="share"><a href=/f>Share</a></div></div><aside><p>{line(9)}</p></aside>', f"T {TEXT}"),
    ],
)
def test_shapes(model, body, want):
    menu = "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>World</a></li></ul></nav>"
    assert model.main_text(f"<html><body>{menu}{body}<footer>Copyright 2020 Example, all rights reserved.</footer></body></html>") == want


@pytest.mark.parametrize(
    "make",
    [
        lambda n: "<scr" * (n // 4),
        lambda n: "<!" * (n // 2),
        lambda n: "<b>" * (n // 3),
        lambda n: "<font>x" * (n // 7),
        lambda n: "</zz>x" * (n // 6),
        lambda n: "<b>" * (n // 7) + "</i>" * (n // 7),
        lambda n: "<a '>' " * (n // 7) + '"',
        lambda n: "<head>" * (n // 10) + "<b>x" * (n // 10),
        lambda n: "<p><li>" * (n // 7),
        lambda n: "&#" + "9" * n,
    ],
)
def test_linear(make):
    """Four times the page takes about four times as long: a quadratic reading would take sixteen times."""

    def seconds(n):
        page, started = make(n), time.perf_counter()
        html_text.parse(page)
        return time.perf_counter() - started

    few = min(seconds(100_000) for _ in range(2))
    assert seconds(400_000) <= 10 * few + 0.3


def test_marks_and_references():
    said = lambda page: " ".join("".join(piece for _, _, piece in html_text.parse(page).texts).split())
    assert said("a<!-->b<!-- c --!>d<!-- e") == "abd"
    assert said("a <b title=\"x>y</b> c") == "a y c"  # a quote that is never closed
    assert said("1 < 2 <b>x</b> <") == "1 < 2 x <"
    assert said("&#0065;&#x00041;&#99999999999;&#" + "0" * 6000 + "66;") == "AA\ufffdB"
    assert said("&#" + "9" * 6000 + ";") == "\ufffd"


def test_end_tags_stay_in_their_scope():
    page = html_text.parse("<span><div><p>a</span>b</div>c")
    place = {piece: page.nodes[node].tag for node, _, piece in page.texts}
    assert place == {"a": "p", "b": "p", "c": "span"}
