from __future__ import annotations

import html as entities
import re
import time

import numpy as np
import pytest

from ordermill.llm.main_text import extract, main_text, smoothed
from ordermill.llm.registry import op4_main_text

LONG = "A sentence of the article that goes on for quite a while, with nothing but words in it. "


def test_the_given_pages_give_the_blocks_of_their_article(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = op4_main_text(spark, folder).collect()
    assert len(got) == len(pages)
    for row in got:
        article = re.search("<article>(.*)</article>", pages[row.page_id].html, re.S)[1]
        blocks = re.split("</?(?:p|h1)>", article)
        texts = [" ".join(entities.unescape(re.sub("<[^>]*>", "", re.sub("<br[^>]*>", " ", block))).split()) for block in blocks]
        expected = "\n".join(text for text in texts if text)
        assert row.text == expected
        assert (row.url, row.n_chars) == (pages[row.page_id].url, len(row.text))


def test_all_that_is_not_the_article_goes():
    page = f"""<html><head><title>T</title><style>p {{}}</style></head><body class="has-sidebar">
    <header><h1>Site</h1><p>{LONG}</p></header><div id="cookie-notice">{LONG * 3}</div><nav><a href="#">Home</a></nav>
    <main><article><header><h1>Head</h1></header><p>{LONG}&amp; more&nbsp;&lt;b&gt;</p><div class="ad-box">{LONG}</div>
    <p>Short.</p><form>Your name <input></form><script>if (a < b) {{ "</p>" }}</script><ul><li>one<li>two</ul><p>{LONG}<!-- no -->
    <table><tr><td>x<td>y</table></article><section id="comments"><p>{LONG * 9}</p></section></main>
    <aside>{LONG}</aside><div class="footer">{LONG}</div><footer>&copy;</footer></body></html>"""
    line = LONG.strip()
    assert main_text(page).split("\n") == ["Head", f"{line} & more <b>", "Short.", "one", "two", line, "x", "y"]


def test_without_an_article_the_dense_part_counts():
    links = "".join(f'<div><a href="{i}">link {i}</a></div>' for i in range(30))
    page = f"<body><div>{links}</div><div><h2>Title</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div>{links}</div>"
    assert main_text(page).split("\n") == ["Title", LONG.strip(), "Short.", LONG.strip()]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("   ", ""),
        ("no tags\n at  all", "no tags at all"),
        ("<p>a<br>b<p>c", "a b\nc"),
        ("<b>x</p>y</b>", "x\ny"),
        ("<nav>menu</nav>", ""),
        ("<p>a &am b &amp c &#65;</p><", "a &am b & c A\n<"),
        ("<div class='sidebar'><p>all there is</p></div>", "all there is"),
        ("<article class='no-comments'>a<article class='comment'>c</article>d<div class='siteFooter'>f</div></article>", "a\nd"),
        ("<div hidden>h</div><p style='display: none'>n</p>t", "t"),
    ],
)
def test_small_pages(page, text):
    assert main_text(page) == text


def test_smoothing_keeps_constants_and_spreads_peaks():
    assert np.allclose(smoothed(np.ones(7), 1.5), 1)
    assert smoothed(np.array([0, 0, 9.0, 0, 0]), 1).argmax() == 2


def test_odd_rows(spark):
    rows = [(None, None, None, "t"), (1, "u", "", "t"), (1, "u", "", "t"), (2, "u", "<p>" + "word " * 100_000, None), (3, None, "<div>" * 3000 + "deep", "t")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = extract(pages)
    assert got.columns == pages.columns
    assert [len(r.html) for r in got.orderBy("page_id").collect()] == [0, 0, 0, 499_999, 4]
    assert extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<article><h1>T</h1><section>{five}</section><section>{one}</section></article>",
        "<article><h1>T</h1><div class='body'>{five}{one}</div></article>",
        "<body><nav>menu</nav><article><h1>T</h1><div class='lead'>{one}</div><div class='body'>{five}</div></article><footer>f</footer>",
        "<body><div><h1>T</h1><div>{five}</div><div>{one}</div></div>",
    ],
)
def test_all_parts_of_an_article_stay(page):
    line = LONG.strip()
    page = page.format(five=f"<p>{LONG}</p>" * 5, one=f"<p>{LONG}</p>")
    assert main_text(page).split("\n") == ["T", *[line] * 6]


def test_names_that_headings_and_parts_of_an_article_have():
    five = [f"{number} {LONG.strip()}" for number in range(5)]
    page = f"""<body><nav>m</nav><article><h1>T</h1><p>{five[0]}</p><h2 id='social-impact'>Impact</h2><p>{five[1]}</p>
    <section id='discussion'><h2>Talk</h2><p>{five[2]}</p></section><p id='notice-period'>{five[3]}</p><div class='related-work'><p>{five[4]}</p></div>
    <div class='related'><p>{LONG}</p></div><div class='share-links'><a href='x'>on this site</a> <a href='y'>on that one</a></div>
    <div class='alert-banner'>{LONG}</div><section id='comments'><p>{LONG * 4}</p></section><div class='promo-ad'>{LONG}</div></article></body>"""
    assert main_text(page).split("\n") == ["T", five[0], "Impact", five[1], "Talk", five[2], five[3], five[4]]


@pytest.mark.parametrize(
    "unit", ["<div>some words", "<b>x</i>", "<a ", "<i><div><b>x</i>", "<b><p>a</p>", "<li><b>x", "</p>", "<div class='related-x'>some words", "<table><td>x"]
)
def test_time_is_proportional_to_length(unit):
    def seconds(n):
        start = time.process_time()
        main_text(unit * n)
        return time.process_time() - start

    seconds(500)
    small = min(seconds(4000) for _ in range(3))
    assert min(seconds(16_000) for _ in range(2)) < 8 * small + 0.2
