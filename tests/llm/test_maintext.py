from __future__ import annotations

import html
import re

import numpy as np
import pytest

from textsieve.llm import maintext

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tree():
    return maintext.fit_tree(maintext.labelled_rows())


def test_held_out_pages(spark):
    """The given pages are in no labelled row; their articles are marked, so that a plain cut gives the text."""
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    found = {r["page_id"]: r for r in maintext.main_text(spark.read.parquet(f"{FOLDER}/pages.parquet")).collect()}
    assert len(found) == len(pages) == 250
    for page in pages:
        article = re.search(r"<article>(.*?)</article>", page["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1)>", article))
        expected = "\n".join(block for block in blocks if block)
        assert found[page["page_id"]]["text"] == expected
        assert found[page["page_id"]]["n_chars"] == len(expected)
        assert found[page["page_id"]]["url"] == page["url"]


PAGE = """<html><head><title>no</title><style>p {{}}</style></head><body class="has-sidebar"><header><a href="/">Site name</a>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News of the day</a></ul></nav></header>
<div class="{notice}">We use small files on this site to do all sorts of things. You agree to it.</div>
<{main}><header><h1>The title &amp; more</h1><p class="byline">By Someone Else</p></header>
<p>A first paragraph with <a href="x">a link</a> in it&nbsp;and <b>more</b>w&#111;rds<br>here.<p>Short.
<ul><li>one item<li>two items</ul><blockquote>What was said, and by whom it was said.</blockquote>
<form><label>Name</label><input name="n"><textarea>typed</textarea><button>Send</button></form>
<aside><p>Related matters that one could read as well.</p></aside><div class='advert'>Buy this now, it is very good.</div>
<p title="a > b">The last one, 1 &lt; 2.</p></{end}>
<section id="reader-comments"><h2>Comments</h2><article class="comment"><p>I think that this is a very good text and I like it.</p></article></section>
<footer><p>&copy; 2020 Site name. All rights reserved.</p></footer><script>if (a < b) document.write("<p>no</p>")</script><!-- <p>no</p> --></body></html>"""

TEXT = """The title & more
A first paragraph with a link in it and morewords here.
Short.
one item
two items
What was said, and by whom it was said.
The last one, 1 < 2."""


@pytest.mark.parametrize("main", ["article", "main", 'div class="entry-content"', 'div id="mainContent"', 'section class="post"', "ARTICLE"])
@pytest.mark.parametrize("notice", ["cookie-notice", "ad", "siteNotice top", "newsletter_signup"])
def test_only_the_article(tree, main, notice):
    page = PAGE.format(main=main, end=main.split()[0], notice=notice)
    assert maintext.page_texts([page], tree) == [TEXT]


def test_page_without_telling_elements(tree):
    """Words and links of blocks and their neighbours alone."""
    long = "Many words make up this paragraph, and it goes on for a while so that it looks like prose. " * 3
    links = "".join(f"<div><a href=/{i}>Go to {i}</a></div>" for i in range(6))
    page = f"<html><body>{links}<p>{long}</p><p>Yes.</p><p>{long}</p>{links}</body></html>"
    assert maintext.page_texts([page], tree) == [f"{long.strip()}\nYes.\n{long.strip()}"]


@pytest.mark.parametrize(
    "page,blocks",
    [
        ("a<p>b<b>c</b> d<br>e", ["a", "bc d e"]),
        ("x &amp;lt; &#x41; &nbsp; y\n\tz", ["x &lt; A y z"]),
        ('<p title="a>b">c</p>', ["c"]),
        ("<script>a</p></SCRIPT >b<style>c", ["b"]),
        ("a<!-- <p> -->b<!-->c<!-- d", ["abc"]),
        ("1 < 2 <3 a<b", ["1 < 2 <3 a"]),
        ("<table><tr><td>a<td>b</table>", ["a", "b"]),
        ("<p>&lt;p&gt;", ["<p>"]),
        ("", []),
        ("    ", []),
    ],
)
def test_blocks(page, blocks):
    assert [block.text for block in maintext.Blocks(page).found] == blocks


def test_links_are_counted():
    blocks = maintext.Blocks("<p>one <a href=x>two three</a> four<p><a>five<p>six</a> seven").found
    assert [(block.words, block.linked) for block in blocks] == [(4, 2), (1, 1), (2, 1)]


def test_tree_separates_what_can_be_separated():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 20, (400, 3)).astype(float)
    labels = ((rows[:, 0] > 7) & (rows[:, 2] <= 11)).astype(float)
    tree = maintext.grow(rows, labels)
    assert (tree(rows) == (labels > 0.5)).all()
    assert not maintext.grow(rows, np.zeros(400))(rows).any()


def test_own_table(spark):
    """A table in which only list items are main text."""
    rows = [(0, i, f"html/body/{tag}", 5, 0, False, tag == "li") for i, tag in enumerate(["p", "li", "h1"] * 5)]
    labelled = spark.createDataFrame(rows, maintext.LABELLED_SCHEMA)
    pages = spark.createDataFrame([(1, "u", "<p>a b c d e<ul><li>f g h i j</ul>")], "page_id bigint, url string, html string")
    assert [tuple(r) for r in maintext.main_text(pages, labelled).collect()] == [(1, "u", "f g h i j", 9)]
    with pytest.raises(ValueError):
        maintext.main_text(pages, labelled.limit(0))
