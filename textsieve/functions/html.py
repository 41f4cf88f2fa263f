"""Stage 4: readable text out of HTML.

Finding tags and cleaning lines are Spark expressions. Only the walk over the
tags runs in Python, as an Arrow UDF around the standard library's parser, and
only for live rows that hold a tag.
"""

from __future__ import annotations

import re
import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from textsieve.functions.classes import strip

# Executors need no installed copy of this module for the UDF below.
register_pickle_by_value(sys.modules[__name__])

TAG = "<[a-zA-Z][^>]*>"

# Tags whose text is dropped, in two separately counted groups.
SKIP_TAGS = frozenset(
    "script style noscript iframe object embed svg canvas audio video map area pre code".split()
)
NOISE_TAGS = frozenset(
    "nav header footer aside menu menuitem form button input select textarea label".split()
)
# A class or id that holds one of these marks an element as noise.
NOISE_WORDS = (
    "ad advertisement banner sidebar nav navigation menu footer header cookie popup modal promo "
    "sponsor related comment share social widget subscribe newsletter"
).split()
# Spacing written around tags.
INLINE_TAGS = frozenset("span a strong em b i small mark".split())
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
BREAK_BEFORE = {
    **dict.fromkeys([*HEADINGS, "p", "article", "section"], "\n\n"),
    **dict.fromkeys(["li", "tr", "dd", "blockquote"], "\n"),
}
BREAK_AFTER = {
    **dict.fromkeys(HEADINGS, "\n\n"),
    **dict.fromkeys(["p", "div", "article", "section", "blockquote"], "\n"),
}
# Elements of HTML that have no end tag.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)

_NOISE = re.compile("|".join(NOISE_WORDS), re.IGNORECASE)


class _PageText(HTMLParser):
    """Collects the text of one document; make a new one for each."""

    def __init__(self, element_scope: bool):
        super().__init__()
        self.pieces: list[str] = []
        self.depth = {"skip": 0, "noise": 0}
        self.element_scope = element_scope
        self.region: list = []  # [tag, open count] of the noisy element we are in

    @property
    def dropping(self) -> bool:
        return bool(self.depth["skip"] or self.depth["noise"] or self.region)

    def write(self, piece: str) -> None:
        if piece:
            self.pieces.append(piece)

    def pad(self, blanks: str) -> None:
        if not self.dropping and self.pieces and not self.pieces[-1][-1].isspace():
            self.write(blanks)

    @staticmethod
    def group(tag: str) -> str | None:
        return "skip" if tag in SKIP_TAGS else "noise" if tag in NOISE_TAGS else None

    def handle_starttag(self, tag, attrs):
        group = self.group(tag)
        if group:
            self.depth[group] += 1
            return
        if self.region and tag == self.region[0]:
            self.region[1] += 1
        if any(name in ("class", "id") and value and _NOISE.search(value) for name, value in attrs):
            if not self.element_scope:
                self.depth["noise"] += 1
            elif not self.region and tag not in VOID_TAGS:
                self.region = [tag, 1]
            return
        self.write(BREAK_BEFORE.get(tag, ""))
        if tag == "li" and not self.dropping:
            self.write("• ")
        if tag in INLINE_TAGS:
            self.pad("  ")

    def handle_endtag(self, tag):
        group = self.group(tag)
        if group:
            self.depth[group] = max(0, self.depth[group] - 1)
            return
        if self.region and tag == self.region[0]:
            self.region[1] -= 1
            if not self.region[1]:
                self.region = []
        if tag in INLINE_TAGS:
            self.pad(" ")
        self.write(BREAK_AFTER.get(tag, ""))

    def handle_data(self, data):
        if not self.dropping:
            self.write(" ".join(data.split()))


def page_text(document: str, element_scope: bool) -> str | None:
    """Text of one document, or None when the parser gives up on it."""
    page = _PageText(element_scope)
    try:
        page.feed(document)
    except Exception:
        return None
    return "".join(page.pieces)


@F.pandas_udf(StringType())
def _document_text(documents: pd.Series) -> pd.Series:
    return documents.map(lambda document: page_text(document, False), na_action="ignore")


@F.pandas_udf(StringType())
def _element_text(documents: pd.Series) -> pd.Series:
    return documents.map(lambda document: page_text(document, True), na_action="ignore")


# As in normalize: worked out once, not copied into later expressions.
_document_text = _document_text.asNondeterministic()
_element_text = _element_text.asNondeterministic()


def is_html(text: Column) -> Column:
    return text.rlike(TAG)


def raw_page_text(text: Column, noise_scope: str = "document") -> Column:
    """Text before line cleanup; null where there is no tag or the parser fails."""
    walk = _element_text if noise_scope == "element" else _document_text
    return walk(F.when(is_html(text), text))


def line_cleanup(text: Column) -> Column:
    """Trim lines, drop blank and near-empty ones, drop a line equal to the one before."""
    text = F.regexp_replace(F.regexp_replace(text, " {2,}", " "), r"\t+", " ")
    lines = F.transform(F.split(text, "\n"), strip)
    lines = F.filter(lines, lambda line: (F.length(line) > 2) | line.rlike(r"^\p{L}+\z"))
    # A line and its repeats, each repeat ending where a line ends.
    return F.regexp_replace(F.array_join(lines, "\n"), r"(?md)^(.+)(?:\n\1(?![^\n]))++", "$1")


def accepted(extracted: Column, min_char_len: int) -> Column:
    """The extracted text where it is long enough, else null."""
    return F.when(F.length(extracted) >= F.greatest(F.lit(min_char_len), F.lit(1)), extracted)
