from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from textsieve.config import PrepConfig
from textsieve.functions import html
from textsieve.operators.steps import html_step, run_steps

PAGE = (
    "<html><body><nav>Start Archive</nav><p>The tide <b>turns</b>, slowly</p>"
    '<div class="ad">Cheap boats</div></body></html>'
)
CASES = [
    (PAGE, "The tide turns , slowly", "The tide turns , slowly"),
    ('<div class="padding">one line here</div><p>after the block</p>', "", "after the block"),
    (
        "<ul><li>first item</li><li>second item</li></ul>",
        "• first item\n• second item",
        "• first item\n• second item",
    ),
    (
        "<p>alpha<br>beta</p><p>gamma &amp;amp; delta</p>",
        "alphabeta\ngamma &amp; delta",
        "alphabeta\ngamma &amp; delta",
    ),
    ("<form><input>inside</form><p>tail text</p>", "", ""),
    ("<p>same line</p><p>same line</p><p>ok</p><p>!!</p>", "same line\nok", "same line\nok"),
    ('<script>var x="<p>no</p>";</script><p>yes text</p>', "yes text", "yes text"),
    ('<p>done text</p><a href="x', "done text", "done text"),
    ("<pre>code</pre><h2>Title</h2><td>cell</td>text", "Title\ncelltext", "Title\ncelltext"),
    (
        '<div id="x-SIDEBAR"><div>in</div>in</div><p>out of it</p><br class="ad"><p>and on</p>',
        "",
        "out of it\nand on",
    ),
]


@pytest.mark.parametrize("scope, column", [("document", 1), ("element", 2)])
def test_extraction(apply, scope, column):
    def extract(text):
        return html.line_cleanup(html.raw_page_text(text, scope))

    # The UDF's own result must be a column before it is used twice.
    assert apply(extract, [case[0] for case in CASES]) == [case[column] for case in CASES]


def test_plain_text_is_not_parsed(apply):
    assert apply(html.raw_page_text, ["no tags in it", None, "a < b > c"]) == [None, None, None]


def test_parser_state_does_not_leak(apply):
    unfinished = "<p>first</p><!-- never closed"
    assert apply(html.raw_page_text, [unfinished, "<p>second</p>"] * 3)[1::2] == ["\n\nsecond\n"] * 3


def test_failing_parser_gives_null(monkeypatch):
    monkeypatch.setattr(html._PageText, "feed", lambda self, data: 1 / 0)
    assert html.page_text("<p>x</p>", False) is None


def test_line_cleanup_repeats(apply):
    cases = {
        "a b c\na b c\na b c\na b cd\na b cd": "a b c\na b cd",
        "x  y z\t\tw": "x y z w",
        " ab \n!!\n12\nab\nab": "ab",
        "same\n\nsame\nother\nsame": "same\nother\nsame",
        "\n".join(["abc"] * 6000): "abc",
        "one\u2028two\none": "one\u2028two\none",
        "ab\u00a0\nab": "ab",
        "": "",
    }
    assert apply(html.line_cleanup, list(cases)) == list(cases.values())


def test_step_accepts_by_length(spark, records):
    short, long = "<p>short</p>", "<p>" + "long enough text " * 4 + "</p>"
    rows = run_steps(records([short, long, "no tags"]), [html_step(PrepConfig())])
    found = {r["id"]: (r["cleaned"], r["html_extracted"]) for r in rows.collect()}
    assert found[1] == (short, False)
    assert found[2] == (("long enough text " * 4).strip(), True)
    assert found[3] == ("no tags", False)


def test_step_leaves_dead_rows(records):
    rows = records([PAGE]).withColumn("omit_reason", F.lit("too_short"))
    row = run_steps(rows, [html_step(PrepConfig(min_char_len=1))]).first()
    assert (row["cleaned"], row["html_extracted"]) == (PAGE, False)
