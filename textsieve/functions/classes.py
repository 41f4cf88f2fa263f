"""Character classes that give Java regexes the meaning of Unicode text rules.

Java's own \\s, \\w and \\b are ASCII, and its Unicode mode also counts
combining marks as word characters. These spell the sets out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# Inside a bracket expression.
SPACE_SET = r"\p{IsWhite_Space}\x1c-\x1f"
WORD_SET = r"\p{L}\p{N}_"

SPACE = f"[{SPACE_SET}]"
WORD = f"[{WORD_SET}]"
NOT_AFTER_WORD = f"(?<!{WORD})"
NOT_BEFORE_WORD = f"(?!{WORD})"
BREAK_SET = r"\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029"
# Whitespace that does not end a line.
BLANK = f"[{SPACE_SET}&&[^{BREAK_SET}]]"


def holds_any(text: Column, pieces: Iterable[str]) -> Column:
    """Whether the text holds one of the pieces. A search for a fixed piece takes a small part
    of the time of a regex pass over the text."""
    return reduce(or_, (text.contains(piece) for piece in pieces))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Trim Unicode whitespace at both ends."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+\z", "")
