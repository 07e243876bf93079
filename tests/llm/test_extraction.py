import html
import re

import numpy as np
import pytest
from samples import SF, bag

from residua.llm import extraction as e

SCHEMA = "page_id bigint, url string, html string, text string, n_chars int"


def article_text(page):
    """Text of the article element by cutting the page."""
    inner = page.split("<article>")[1].split("</article>")[0]
    inner = re.sub(r"</?(?:h1|p|br)>", " ", inner)
    return " ".join(html.unescape(re.sub(r"</?b>", "", inner)).split())


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = [(r["page_id"], r["url"], article_text(r["html"]), len(article_text(r["html"]))) for r in pages.collect()]
    assert bag(e.main_text(pages)) == sorted(want, key=repr)


LONG = "This sentence of the article is long enough to be told from a menu by its ratio of text to tags."

PAGES = [
    (f"<body><nav><a href=/>Home</a><a href=/x>News</a></nav><div id=main><h2>A &amp; B</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
     f"<div class='sidebar'><p>{LONG}</p></div></body>", f"A & B {LONG} Short. {LONG}"),
    (f"<header><h1>Site</h1></header><main><header><h1>Title</h1></header><p>{LONG}<p>x</main><footer>{LONG}</footer>", f"Title {LONG} x"),
    (f"<article><p>{LONG}</p><div class='share-buttons'>Share this</div><form><input><button>Send</button></form><p>{LONG}</p>"
     f"<section id='comments'><p>{LONG} says a reader</p></section></article>", f"{LONG} {LONG}"),
    (f"<p>{LONG}</p><div class='cookie-notice'>{LONG}</div><div class='ad'>{LONG}</div><script>var a = '<p>{LONG}</p>';</script><style>p {{}}</style>", LONG),
    (f"<table><tr><td><a href=a>a</a><td><div><p>{LONG}<br>{LONG}</div></table>", f"{LONG} {LONG}"),
    (f"<article><p>ma<b>rk</b>ed &lt;b&gt; &#233;&nbsp;x\n\t y</p><p>{LONG}</p></article>", f"marked <b> é x y {LONG}"),
    (f"<article><p>{LONG}<p>never closed <i>at all", f"{LONG} never closed at all"),
    ("<p>a</p><p>a</p><p>a</p>", "a a a"),
    ("only text", "only text"),
    ("<nav>only a menu</nav>", ""),
    ("<p> \n </p><img src=x>", ""),
    ("", ""),
]


@pytest.mark.parametrize(("page", "want"), PAGES)
def test_kinds_of_pages(page, want):
    assert e.extract(page) == want


@pytest.mark.parametrize(("page", "want"), [
    (f"<html><head><title>T</title><meta charset=utf-8><body><p>{LONG}</p></body></html>", LONG),
    (f"<html><head><title>T</title><style>p {{}}</style><p>{LONG}</p></html>", LONG),
    (f"<head><script>var a;</script><noscript><link href=x></noscript>{LONG}", LONG),
    (f"<head><noscript><link href=x><body><p>{LONG}</p>", LONG),
    (f"<head><title>T</title></head><template><p>x</p></template><p>{LONG}</p>", LONG),
    (f"<article><svg viewBox='0 0 1 1'/><p>{LONG}</p><math/><p>{LONG}</p></article>", f"{LONG} {LONG}"),
    (f"<article><svg><path d=x /><g/><text>not shown</text></svg><p>{LONG}</p></article>", LONG),
    (f"<article><div/><p>{LONG}</p></article>", LONG),
])
def test_heads_and_drawings_hide_no_more_than_themselves(page, want):
    assert e.extract(page) == want


ARTICLE = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
TEXT = f"Title {LONG} Short. {LONG}"


@pytest.mark.parametrize(("page", "want"), [
    *[(f"<body><nav><a href=/>Home</a></nav><div class='{name}'>{around}</div></body>", TEXT)
      for name in ("content-sidebar-wrap", "site has-sidebar", "no-sidebar") for around in (
          f"<article>{ARTICLE}</article>", f"<main>{ARTICLE}</main>", f"<div>{ARTICLE}</div>",
          f"<div>{ARTICLE}</div><div class='sidebar'><p>{LONG}</p></div>", f"<article>{ARTICLE}</article><div id='comments'><article><p>{LONG}</p></article></div>",
          f"<div class='no-comments'>{ARTICLE}</div>")],
    (f"<h1>Site</h1><div class='has-sidebar'><article>{ARTICLE}{f'<p>{LONG}</p>' * 8}</article></div><p>{LONG}</p>", f"{TEXT}{f' {LONG}' * 8}"),
    (f"<nav>{LONG}<article>{LONG}</article></nav><article>{ARTICLE}</article>", TEXT),
    (f"<div role='complementary'><article>{LONG}</article></div><article>{ARTICLE}</article>", TEXT),
    (f"<article>{ARTICLE}<section id='discussion'><h2>Discussion</h2><p>{LONG}</p></section></article>", f"{TEXT} Discussion {LONG}"),
    (f"<article>{ARTICLE}<h2 id='related-work'>Related work</h2><p>{LONG}</p></article>", f"{TEXT} Related work {LONG}"),
    (f"<article><div class='post share'>{ARTICLE}</div></article>", TEXT),
    (f"<article>{ARTICLE}<p class='notice'>{LONG}</p><div class='share'><a href=a>Mail</a><a href=b>Print</a></div></article>", f"{TEXT} {LONG}"),
    (f"<div>{ARTICLE}</div><div id='comments'>{f'<p>{LONG}</p>' * 9}</div>", TEXT),
    (f"<article>{ARTICLE}</article><div id='comments'>{f'<article><p>{LONG}</p></article>' * 9}</div>", TEXT),
    (f"<article>{ARTICLE}<div id='comments'>{f'<article><p>{LONG}</p></article>' * 9}</div></article>", TEXT),
])
def test_names_of_wrappers_and_parts(page, want):
    assert e.extract(page) == want


def test_edges(spark):
    rows = [(1, None, None, "t", 1), (1, None, None, "t", 1), (None, "u", "<p>x</p>", "t", 1), (2, "u", "<div>" * 3000 + LONG, "t", 1)]
    got = bag(e.main_text(spark.createDataFrame(rows, SCHEMA)))
    assert got == sorted([(1, None, "", 0), (1, None, "", 0), (None, "u", "x", 1), (2, "u", LONG, len(LONG))], key=repr)
    assert e.main_text(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_page_is_read_whole():
    paragraphs = [f"{LONG} {i}" for i in range(5000)]
    page = "<article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>"
    assert e.extract(page) == " ".join(paragraphs)


def test_threshold_lies_between_clusters():
    values = np.array([0, 1, 0, 50, 60, 1, 55.0])
    assert 1 < e.threshold(values) < 50
    assert e.threshold(np.array([3.0, 3.0])) <= 3


def test_smoothing_keeps_the_sum_inside():
    assert e.smoothed(np.array([0, 0, 0, 8.0, 0, 0, 0])).sum() == pytest.approx(8)
