"""Main text of web pages: flat blocks, classified by their words and links and their neighbours'.

A page is cut into blocks, the runs of text between block-level tags, in page
order. A block is described by its number of words and its link density (the
share of its words that stand in links), by those of the blocks before and
after it, by its tag, and by the nearest element around it that says what it
holds: an article, or a menu, form, advert and so on. A decision tree, grown
from a small table of labelled blocks, says which blocks are main text. The
table below is the default; any table of the same columns can take its place,
and at most MOST_LABELLED of its rows are used, in the fit alone.

A page is worked on by itself, so the job is one pass without a shuffle. The
tree is applied to all blocks of a batch of pages at once.

Results, row by row: null or empty html, and html without main text, give an
empty text. An unfinished tag or comment at the end, and the content of scripts
and styles, are no text. Nothing depends on page_id, so null or repeated ids and
repeated rows are treated like any other. An empty table gives an empty result.
Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textsieve.llm.common import slices

#: Elements that end the block before them and begin another.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav noscript ol optgroup option p pre search "
    "section select summary svg table tbody td template tfoot th thead tr ul video audio canvas object".split()
)
#: Elements whose content is raw text up to their own end, and never shown as a part of the page.
RAW_TAGS = "script style textarea title iframe noembed noframes xmp"
SPACE_TAGS = frozenset(["br", "wbr", "img"])
ALONE_TAGS = frozenset(["hr"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
ITEM_TAGS = frozenset(["li", "dd", "dt", "td", "th", "option", "label", "legend", "summary", "caption", "figcaption"])
MAIN_TAGS = frozenset(["article", "main"])
SIDE_TAGS = frozenset(
    "nav footer aside form menu head button select option fieldset dialog noscript template svg video audio canvas object search".split()
)
#: Words in a class or id, cut at every character that is no letter and at every capital after a small letter.
MAIN_WORDS = frozenset("article content entry main post story".split())
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial alert author banner banners breadcrumb breadcrumbs byline comment comments "
    "consent cookie cookies copyright disclaimer discussion disqus dialog footer form gdpr hidden legal login masthead menu meta modal nav "
    "navbar navigation newsletter notice notices notification overlay pager paging pagination paywall popup promo promoted promotion related replies reply "
    "respond rss search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags teaser toolbar topbar "
    "widget widgets".split()
)
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: A class or id on these says nothing of all that is in them.
WHOLE_PAGE = frozenset(["html", "body", "main"])

_RAW = "(?i:" + "|".join(RAW_TAGS.split()) + ")"
TOKEN = re.compile(
    rf"""<(?:!--(?:>|->|.*?(?:--!?>|\Z))
       | {_RAW}\b(?:"[^"]*"|'[^']*'|[^'">])*+>.*?(?:</{_RAW}\b[^>]*>|\Z)
       | (?P<tag>/?[a-zA-Z][^\s/>]*)(?P<rest>(?:"[^"]*"|'[^']*'|[^'">])*+)>
       | (?P<loose>/?[a-zA-Z][^\s/>]*)[^>]*>
       | [!?/][^>]*>
       | [a-zA-Z!?/][^>]*\Z)""",
    re.DOTALL | re.VERBOSE,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_STOP = tuple(".!?…:;\"”»。！？")

NONE, MAIN, SIDE = 0, 1, -1


def role_of(tag: str, attributes: str) -> tuple[int, bool]:
    """Whether an element says that its content is main text, or that it is not; and whether it is a header."""
    found, header = SIDE if tag in SIDE_TAGS else MAIN if tag in MAIN_TAGS else NONE, tag == "header"
    if not attributes or tag in WHOLE_PAGE:
        return found, header
    words: set[str] = set()
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value, name = a or b or c, name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in SIDE_ROLES):
            return SIDE, header
        if name in ("class", "id"):
            words.update(word.lower() for word in _WORD.findall(value))
    if words & SIDE_WORDS:
        return SIDE, header
    return found or (MAIN if words & MAIN_WORDS else NONE), header or "header" in words


@dataclass
class Block:
    words: int
    linked: int
    role: int
    tag: str
    stop: bool
    text: str = ""


class Blocks:
    """The blocks of one page."""

    def __init__(self, html: str):
        self.found: list[Block] = []
        self._open: list[tuple[str, int, bool]] = []  # tag, role so far, whether in a header
        self._times: Counter[str] = Counter()  # of the tags in it
        self._parts: list[tuple[str, bool]] = []
        self._link: int | None = None  # elements open where a link began
        at = 0
        for match in TOKEN.finditer(html):
            if match.start() > at:
                self._parts.append((html[at : match.start()], self._link is not None))
            at = match.end()
            tag = (match["tag"] or match["loose"] or "").lower()
            if tag.startswith("/"):
                self._close(tag[1:])
            elif tag:
                self._begin(tag, match["rest"] or "")
        if at < len(html):
            self._parts.append((html[at:], self._link is not None))
        self._end_block()

    def _begin(self, tag: str, rest: str) -> None:
        if tag == "a":
            self._link = len(self._open)
        elif tag in SPACE_TAGS:
            self._parts.append((" ", False))
        elif tag in BLOCK_TAGS:
            self._end_block()
            if tag in ALONE_TAGS:
                return
            if self._open and self._open[-1][0] == "p":
                self._leave(1)
            _, role, header = self._open[-1] if self._open else ("", NONE, False)
            own, is_header = role_of(tag, rest)
            if role == SIDE and tag not in WHOLE_PAGE:
                own = SIDE  # such as an article among the comments
            if is_header and (own or role) != MAIN:
                own = SIDE
            self._open.append((tag, own or role, header or is_header))
            self._times[tag] += 1

    def _leave(self, elements: int) -> None:
        for _ in range(elements):
            self._times[self._open.pop()[0]] -= 1

    def _close(self, tag: str) -> None:
        if tag == "a":
            self._link = None
        elif tag in BLOCK_TAGS:
            self._end_block()
            if self._times[tag]:
                while self._open[-1][0] != tag:
                    self._leave(1)
                self._leave(1)
            if self._link is not None and self._link > len(self._open):
                self._link = None

    def _end_block(self) -> None:
        if not self._parts:
            return
        parts, self._parts = self._parts, []
        text = " ".join("".join(unescape(part) if "&" in part else part for part, _ in parts).split())
        if not text:
            return
        words = text.count(" ") + 1
        linked = min(words, sum(len(unescape(part).split()) for part, link in parts if link))
        tag, role, header = self._open[-1] if self._open else ("", NONE, False)
        if header and role == MAIN and tag not in HEADINGS:
            role = SIDE  # beside the title of an article
        self.found.append(Block(words, linked, role, tag, text.endswith(_STOP), text))


FEATURES = ("words", "links", "words before", "links before", "words after", "links after", "role", "elsewhere", "heading", "item", "stop")


def describe(page: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block of a page."""
    size = len(page)
    words = np.fromiter((block.words for block in page), float, size)
    links = np.fromiter((block.linked for block in page), float, size) / words
    role = np.fromiter((block.role for block in page), float, size)
    before, after = (lambda x: np.concatenate(([0.0], x[:-1]))), (lambda x: np.concatenate((x[1:], [0.0])))
    elsewhere = (role == NONE) & bool((role == MAIN).any())
    flags = np.array([(block.tag in HEADINGS, block.tag in ITEM_TAGS, block.stop) for block in page], float).reshape(size, 3)
    return np.column_stack((words, links, before(words), before(links), after(words), after(links), role, elsewhere, flags))


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays; a leaf has feature -1 and its class in place of a threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    below: np.ndarray
    above: np.ndarray

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        while True:
            inner = np.flatnonzero(self.feature[node] >= 0)
            if not len(inner):
                return self.threshold[node] > 0.5
            at = node[inner]
            low = rows[inner, self.feature[at]] <= self.threshold[at]
            node[inner] = np.where(low, self.below[at], self.above[at])


def _impurity(ones: np.ndarray, size: np.ndarray) -> np.ndarray:
    share = ones / size
    return size * 2 * share * (1 - share)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 2) -> Tree:
    """The tree by Gini impurity; of equal splits the first feature's lowest threshold."""
    nodes: list[tuple[int, float, int, int]] = []

    def split(take: np.ndarray, deep: int) -> int:
        here = len(nodes)
        nodes.append((-1, float(labels[take].mean()) if len(take) else 0.0, 0, 0))
        size, ones = len(take), float(labels[take].sum())
        best, chosen = float(_impurity(np.array(ones), np.array(max(size, 1)))) - 1e-9, None
        if deep == 0 or size < 2 * least or ones in (0.0, float(size)):
            return here
        for f in range(rows.shape[1]):
            order = take[np.argsort(rows[take, f], kind="stable")]
            values, left = rows[order, f], np.cumsum(labels[order])[:-1]
            n = np.arange(1, size)
            fits = (values[1:] > values[:-1]) & (n >= least) & (size - n >= least)
            if not fits.any():
                continue
            cost = np.where(fits, _impurity(left, n) + _impurity(ones - left, size - n), np.inf)
            i = int(np.argmin(cost))
            if cost[i] < best:
                best, chosen = float(cost[i]), (f, float(values[i] + values[i + 1]) / 2)
        if chosen:
            low = rows[take, chosen[0]] <= chosen[1]
            below, above = split(take[low], deep - 1), split(take[~low], deep - 1)
            nodes[here] = (*chosen, below, above)
        return here

    split(np.arange(len(rows)), depth)
    feature, threshold, below, above = zip(*nodes)
    return Tree(np.array(feature), np.array(threshold), np.array(below), np.array(above))


#: At most so many labelled rows are read for the fit.
MOST_LABELLED = 10_000

#: Pages of labelled blocks: elements around the text, words, words in links, ends like a sentence, is main text.
LABELLED = """
html/body/nav/ul/li 1 1 0 0
html/body/nav/ul/li 1 1 0 0
html/body/nav/ul/li 2 2 0 0
html/body/div.ad 8 0 1 0
html/body/article/h1 9 0 0 1
html/body/article/p 84 0 1 1
html/body/article/p 1 0 1 1
html/body/article/p 2 0 1 1
html/body/article/p 46 3 1 1
html/body/article/p 1 0 0 1
html/body/footer 11 0 1 0

html/body/header/a 2 2 0 0
html/body/header/p 5 0 0 0
html/body/main/h1 6 0 0 1
html/body/main/p 7 0 1 1
html/body/main/ul/li 4 0 0 1
html/body/main/ul/li 3 3 0 1
html/body/main/ul/li 12 1 1 1
html/body/main/h2 3 0 0 1
html/body/main/p 130 2 1 1
html/body/main/form 6 0 0 0
html/body/main/div.comments/h2 2 0 0 0
html/body/main/div.comments/p 38 0 1 0
html/body/main/div.comments/p 64 1 1 0
html/body/aside/h3 2 0 0 0
html/body/aside/ul/li 5 5 0 0
html/body/footer/p 14 4 1 0

html/body/div.cookie/p 25 2 1 0
html/body/div.navbar/a 1 1 0 0
html/body/div.content/h1 8 0 0 1
html/body/div.content/div.byline 4 1 0 0
html/body/div.content/p 41 0 1 1
html/body/div.content/p 3 0 1 1
html/body/div.content/blockquote 22 0 1 1
html/body/div.content/p 66 6 1 1
html/body/div.sidebar/p 19 0 1 0
html/body/div.sidebar/p 6 6 0 0
html/body/div.related/ul/li 7 7 0 0

html/body/div 2 2 0 0
html/body/div 1 1 0 0
html/body/div 3 3 0 0
html/body/h1 7 0 0 1
html/body/p 55 0 1 1
html/body/p 90 2 1 1
html/body/p 5 0 1 1
html/body/p 71 0 1 1
html/body/p 33 1 1 1
html/body/div 4 4 0 0
html/body/div 6 2 0 0

html/body/table/td 1 1 0 0
html/body/table/td 2 2 0 0
html/body/table/td 3 0 0 0
html/body/table/td 120 3 1 1
html/body/table/td 88 0 1 1
html/body/table/td 2 0 0 0
html/body/table/td 9 9 0 0

html/body/div 5 0 0 0
html/body/article/header/h1 5 0 0 1
html/body/article/header/p 6 1 0 0
html/body/article/p 29 0 1 1
html/body/article/figure/figcaption 9 0 1 1
html/body/article/p 17 0 1 1
html/body/article/aside/p 30 0 1 0
html/body/article/section/h2 4 0 0 1
html/body/article/section/p 12 0 0 1
html/body/article/p 18 16 1 1
html/body/div 40 0 1 0
html/body/div 4 4 0 0
html/body/section.comments/article/p 52 0 1 0
html/body/section.comments/article/p 1 0 1 0

html/body/ul/li 2 2 0 0
html/body/ul/li 2 2 0 0
html/body/ul/li 1 1 0 0
html/body/ul/li 3 3 0 0
html/body/h2 6 0 0 1
html/body/p 48 1 1 1
html/body/ul/li 14 0 1 1
html/body/ul/li 17 1 1 1
html/body/p 62 0 1 1
html/body/ul/li 2 2 0 0
html/body/ul/li 4 4 0 0
html/body/p 8 1 0 0

html/body/form 3 0 0 0
html/body/form/label 1 0 0 0
html/body/div 2 0 0 0
html/body/div 75 1 1 1
html/body/div 64 0 1 1
html/body/div 11 0 1 1
html/body/div 58 0 1 1
html/body/div 3 0 0 0
html/body/div 3 3 0 0

html/body/p 140 0 1 1

html/body 36 0 1 1

html/body 13 0 1 1

html/body/ul/li 1 1 0 0
html/body/ul/li 2 2 0 0
html/body/h1 6 0 0 1
html/body/p 43 0 1 1
html/body/p 3 0 1 1
html/body/p 29 1 1 1
html/body/p 9 0 1 1
html/body/p 18 0 1 1
html/body/p 1 0 1 1
html/body/p 35 0 1 1
html/body/div 5 5 0 0

html/body/div 6 6 0 0
html/body/h2 4 0 0 1
html/body/p 58 0 1 1
html/body/p 2 0 1 1
html/body/p 24 0 1 1
html/body/ul/li 15 0 1 1
html/body/ul/li 11 0 1 1
html/body/ul/li 19 1 1 1
html/body/p 61 2 1 1
html/body/ul/li 3 3 0 0
html/body/ul/li 2 2 0 0
html/body/div 7 0 0 0

html/body/p 2 2 0 0
html/body/p 3 3 0 0
html/body/p 2 2 0 0
html/body/p 11 10 0 0
html/body/p 1 1 0 0

html/body/article/h1 2 0 0 1
html/body/article/p 4 0 1 1
html/body/footer/p 60 0 1 0

html/body/div 31 0 1 0
html/body/div 8 0 1 0
html/body/h2 5 0 0 0
html/body/article/h1 7 0 0 1
html/body/article/p 52 0 1 1
html/body/article/p 36 0 1 1
html/body/h3 3 0 0 0
html/body/p 27 0 1 0
html/body/p 12 0 1 0

html/body/div/p 16 0 1 0
html/body/main/p 23 0 1 1
html/body/main/table/td 2 0 0 1
html/body/main/table/td 1 0 0 1
html/body/main/p 9 9 1 1
html/body/main/div.newsletter/p 21 0 1 0
html/body/div/p 44 1 1 0

html/body/div.header/h1 3 3 0 0
html/body/div.header/p 6 0 1 0
html/body/div/h2 8 0 0 1
html/body/div/p 39 0 1 1
html/body/div/p 2 0 1 1
html/body/div/p 77 2 1 1
html/body/div 10 10 0 0
html/body/div 4 0 0 0
"""

LABELLED_SCHEMA = "page int, place int, path string, words int, linked int, stop boolean, main boolean"


def labelled_rows(text: str = LABELLED) -> list[tuple[int, int, str, int, int, bool, bool]]:
    """The rows of LABELLED_SCHEMA written as above, a blank line between two pages."""
    rows = []
    for page, lines in enumerate(text.strip().split("\n\n")):
        for place, line in enumerate(lines.split("\n")):
            path, words, linked, stop, main = line.split()
            rows.append((page, place, path, int(words), int(linked), stop == "1", main == "1"))
    return rows


def _block_of(path: str, words: int, linked: int, stop: bool) -> Block:
    """The block that the parser finds in these elements."""
    opened = "".join("<" + (step if "." not in step else '{} class="{}"'.format(*step.split(".", 1))) + ">" for step in path.split("/"))
    block = Blocks(opened + "x").found[0]
    return Block(max(words, 1), linked, block.role, block.tag, stop)


def fit_tree(rows: list[tuple[int, int, str, int, int, bool, bool]]) -> Tree:
    pages: dict[int, list[tuple[Block, bool]]] = {}
    for page, _, path, words, linked, stop, main in sorted(rows, key=lambda row: row[:2]):
        pages.setdefault(page, []).append((_block_of(path, words, linked, stop), main))
    described = [describe([block for block, _ in page]) for page in pages.values()]
    labels = np.array([main for page in pages.values() for _, main in page], float)
    if not len(labels):
        raise ValueError("there are no labelled blocks")
    return grow(np.concatenate(described), labels)


def page_texts(pages: list[str], tree: Tree) -> list[str]:
    """The main text of each page."""
    found = [Blocks(html).found if html else [] for html in pages]
    rows = [describe(blocks) for blocks in found if blocks]
    keep = iter(tree(np.concatenate(rows)).tolist() if rows else [])
    return ["\n".join([block.text for block in blocks if next(keep)]) for blocks in found]


def main_text(pages: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages; labelled has the columns of LABELLED_SCHEMA."""
    if labelled is None:
        rows = labelled_rows()
    else:
        columns = [part.split()[0] for part in LABELLED_SCHEMA.split(", ")]
        rows = [tuple(row) for row in labelled.dropna(subset=columns).select(columns).orderBy("page", "place").limit(MOST_LABELLED).collect()]
    tree = fit_tree(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = page_texts(batch.column("text").to_pylist(), tree)
            arrays = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    narrow = pages.select("page_id", "url", F.col("html").alias("text"))
    kinds = ", ".join(f"{name} {narrow.schema[name].dataType.simpleString()}" for name in ("page_id", "url"))
    return narrow.mapInArrow(run, f"{kinds}, text string, n_chars bigint")
