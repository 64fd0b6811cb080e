"""Main text of pages: block rules, inheritance, whole table."""

import html
import re

import pytest

from conftest import SF01
from watchtide.llm import html_text as H

PROSE = "This is the main text of the page and it is long enough to be judged by itself, for it is full of the words that a text has in it."


def test_articles_of_the_whole_table(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    got = {r.page_id: r for r in H.op8_extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


BOXES = ['<nav><a href="/">Home</a> is where it is</nav>', '<div class="ad">Buy the best of it now</div>', '<aside><p>See also this</p></aside>',
         '<form action="/s"><label>Name of the user</label><input name=q></form>', '<script>var x = "<p>no</p>";</script>', "<style>p{margin:0}</style>",
         '<div id="cookie-notice"><p>We use cookies on this site</p></div>', '<section class="comments"><p>' + PROSE + "</p></section>",
         '<footer>&copy; the site</footer>', "<!-- <p>hidden</p> -->", '<div role="dialog">Subscribe to the list</div>', '<p hidden>not shown</p>',
         '<div class="SideBar"><p>More of it</p></div>', '<div style="display: none">no</div>', '<ul><li><a href="a">one</a><li><a href="b">two</a></ul>',
         '<div class="user_comments"><article class="comment"><p>' + PROSE + "</p></article></div>"]


@pytest.mark.parametrize("box", BOXES)
def test_boxes_are_left_out_wherever_they_stand(box):
    article = f"<article><h1>Title &amp; more</h1><p>{PROSE}</p>{{}}<p>Short one.</p></article>"
    want = f"Title & more {PROSE} Short one."
    for page in (box + article.format(""), article.format("") + box, article.format(box), f"<body><header>Site</header>{box}<main>{article.format(box)}</main>{box}"):
        assert H.main_text(page) == want


def test_white_space_references_and_order():
    page = f"<article><p>a&nbsp;&lt;b&gt;\n\t c<br>d<b>e</b>f</p><div>g<p>h</div>i<pre>j  k</pre><p>&#233;&eacute;&notaref;</article>"
    assert H.main_text(page) == "a <b> c def g h i j k éé¬aref;"


def test_without_an_article_the_rules_decide():
    page = f"<div>{PROSE}</div><p>Short heir.</p><p>{PROSE}</p><ul><li><a href=1>Link one</a></li></ul><p>Under links</p><ul><li><a href=2>Link two</a></li></ul>"
    assert H.main_text(page) == f"{PROSE} Short heir. {PROSE}"
    few = "zq xv " * 30  # undecided for want of stop words, so it goes with its neighbours
    assert H.main_text(f"<p>{PROSE}</p><p>{few}</p>") == f"{PROSE} {few.strip()}"
    assert H.main_text(f"<ul><li><a href=1>One link here</a></li></ul><p>{few}</p><ul><li><a href=2>Two</a></li></ul>") == ""


def test_labels_of_both_passes():
    found = H.blocks(f"<p>{PROSE}</p><p>one</p><p>two</p><p>three</p><p><a href=x>all of this is linked</a></p>")
    for b in found:
        b.label = H.label_alone(b)
    assert [b.label for b in found] == ["good", "", "", "", "bad"]
    H.inherit(found)
    assert [b.label for b in found] == ["good", "good", "bad", "bad", "bad"]


@pytest.mark.parametrize("page, want", [(None, ""), ("", ""), ("<p>never <b>closed <!-- end", "never closed"), ("plain", "plain"), ("<", "<"), ("a < b and c", "a < b and c"),
                                        ("</p></div>x", "x"), ('<a href="unclosed>x</a><p>y</p>', None), ("<script>never closed", ""), ("<p>1</p>" * 3, "1 1 1")])
def test_odd_pages(page, want):
    got = H.main_text(page)
    assert want is None or got == want


def test_deep_and_long_pages_take_linear_time():
    assert H.main_text("<b>" * 100_000 + "x" + "</i>" * 100_000) == "x"
    assert len(H.main_text("<article>" + f"<p>{PROSE}</p>" * 20_000)) == 20_000 * (len(PROSE) + 1) - 1


def test_defined_cases(spark):
    rows = [(1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (None, None, None, None)]
    got = H.op8_extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in got) == [(0, None, "", 0), (1, "u", "a", 1), (1, "u", "a", 1)]
    assert H.op8_extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_a_paragraph_ends_whatever_it_holds():
    for depth in (0, 1, 7, 8, 9, 50):
        page = f'<p class="promo">Buy now {"<b>" * depth}very cheap<div>{"The cat sat on the mat and it was the best of all the days. " * 4}</div>'
        assert H.main_text(page).startswith("The cat sat on the mat"), depth
