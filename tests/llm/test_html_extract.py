"""Main text of pages: planted templates and the given pages."""

import html
import re
import time

import pytest

from patronscope.llm import html_extract, queries
from patronscope.llm.html_extract import main_text

BODY = "A first paragraph, long enough to count, with commas, and more words than a menu has."


def test_given_pages(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op10_html_extraction(spark, sf).collect()
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id].html, re.S)
        plain = re.sub(r"<[^>]*>?", " ", article[1])
        want = " ".join(html.unescape(plain).split())
        # inline markup joins without a space
        assert r.text.replace(" ", "") == want.replace(" ", "")
        assert r.n_chars == len(r.text)


def test_boilerplate_goes():
    page = f"""<html><body class="has-sidebar"><header><h1>Site</h1></header>
    <div class="cookie-notice"><p>We use cookies, many of them, on this site, as all do.</p></div>
    <div id="wrap"><div class="sidebar"><p>Latest, greatest, and other things you must read.</p></div>
    <div class="post"><h2>Title</h2><p>{BODY}</p><p>Second &amp; &lt;last&gt;&nbsp;part.</p>
    <form><p>Sign, up, now</p><input></form><script>var a = "<p>no</p>";</script></div>
    <div id="comments"><p>First, I say, this is great, and then, some, more, commas, here.</p></div></div>
    <footer><p>Copyright, all rights reserved, and so on, and so forth.</p></footer></body></html>"""
    assert main_text(page) == f"Title {BODY} Second & <last> part."


def test_siblings_and_plain_divs():
    page = f"<body><div><p>{BODY}</p></div><div><p>{BODY}</p></div><ul><li><a href=x>Home</a></ul></body>"
    assert main_text(page) == f"{BODY} {BODY}"
    assert main_text(f"<div>{BODY}<br>next</div>") == f"{BODY} next"


def test_broken_markup():
    assert main_text(f"<article><p><b>{BODY}<br><p>Next <i>on") == f"{BODY} Next on"
    assert main_text(f"<article><p>{BODY}</p><p cla") == BODY
    assert main_text(f'<article><p title="x>{BODY}</p><p>y</p>') is not None
    assert main_text("just text, without any tag") == "just text, without any tag"
    assert main_text("</div></p><<<>>") is not None
    assert main_text("<p>" * 5000 + BODY) == BODY
    assert main_text("<div>" * 5000 + BODY) == BODY


def test_edge_rows(spark):
    rows = [(1, "u", None, 3), (1, "u", "", 3), (None, None, "<p>a</p>", 3), (4, "u", "<p>&#xD800;x" + "é" * 200_000, 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = html_extract.extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 1), (1, 0), (1, 0), (4, 200_002)]
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract(empty).collect() == []


ARTICLE = "<nav><a>Home</a></nav><article><h1>Title</h1><p>Some long enough text, with commas, here.</p>%s</article>"
BEGIN = "Title Some long enough text, with commas, here."


@pytest.mark.parametrize(
    ("part", "text"),
    [
        ("<div>See <a href=x>the whole of a long linked report</a>.</div>", "See the whole of a long linked report."),
        ("<ul><li><a>Source one</a></li><li><a>Source two</a></li></ul>", "Source one Source two"),
        ("<div class='related-work'><p>Others did this.</p></div>", "Others did this."),
        ("<section id=social-history><p>Towns grew.</p></section>", "Towns grew."),
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> be.</p>", "Let x=2 be."),
        ("<div class='related-work'><a>More of this</a> <a>And of that</a></div>", ""),
        ("<div class='related'><p>Others did this.</p></div>", ""),
        ("<div class='related-posts'><p>Others did this.</p></div>", ""),
        ("<div class='reader-comments'><p>I did this too.</p></div>", ""),
        ("<p>Tie</p><p>Tie</p>", "Tie Tie"),
    ],
)
def test_text_of_an_article_stays(part, text):
    assert main_text(ARTICLE % part) == f"{BEGIN} {text}".strip()


@pytest.mark.parametrize(
    "page",
    [
        "<div>a" * 50_000,
        "<div>a" * 50_000 + "</section>" * 50_000,
        "<b>" + "<div>a</b>" * 50_000,
    ],
)
def test_deep_pages_take_linear_time(page):
    begin = time.process_time()
    assert main_text(page).split() == ["a"] * 50_000
    assert time.process_time() - begin < 5
