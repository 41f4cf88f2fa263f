"""Stage 1: decode entities, drop control characters, straighten quotes, collapse blanks."""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from textsieve.functions.classes import holds_any, let

# Curly quotes and their straight forms, position by position.
CURLY_QUOTES = "“”‘’"
STRAIGHT_QUOTES = "\"\"''"

# Control characters but tab, LF and CR.
CONTROL_CHARS = "".join(map(chr, [*range(0x09), 0x0B, 0x0C, *range(0x0E, 0x20), 0x7F]))
# Every entity starts with "&#" or "&" and an ASCII letter.
ENTITY_START = "&[#A-Za-z]"


#: A worker holds so many texts as Python objects at a time.
SLICE = 256


@F.arrow_udf(StringType())
def _decode_entities(texts: pa.Array) -> pa.Array:
    def decoded(start: int) -> pa.Array:
        return pa.array([None if t is None else html.unescape(t) for t in texts.slice(start, SLICE).to_pylist()], pa.string())

    return pa.concat_arrays([decoded(start) for start in range(0, max(len(texts), 1), SLICE)])


# Catalyst copies a deterministic UDF's result into every later expression that
# uses it, up to the next UDF. Marked otherwise, it is worked out once.
_decode_entities = _decode_entities.asNondeterministic()


def html_unescape(text: Column) -> Column:
    """Decode HTML entities once. Only rows that hold one carry text to Python."""
    holds_entity = text.contains("&") & text.rlike(ENTITY_START)
    return F.coalesce(_decode_entities(F.when(holds_entity, text)), text)


def strip_control(text: Column) -> Column:
    """Replace control characters by spaces; tab, LF and CR stay."""
    return F.translate(text, CONTROL_CHARS, " " * len(CONTROL_CHARS))


def straight_quotes(text: Column) -> Column:
    return F.translate(text, CURLY_QUOTES, STRAIGHT_QUOTES)


def collapse_whitespace(text: Column) -> Column:
    """Runs of space/tab become one space, runs of LF one LF."""

    def collapse(text: Column) -> Column:
        blanks = F.regexp_replace(text, r"[ \t]{2,}|\t", " ")
        blanks = F.when(holds_any(text, ("  ", "\t")), blanks).otherwise(text)
        return F.when(text.contains("\n\n"), F.regexp_replace(blanks, r"\n{2,}", "\n")).otherwise(blanks)

    return let(text, collapse)


def clean_characters(text: Column) -> Column:
    """The part of normalization that needs no Python, single characters in one pass."""
    found = CONTROL_CHARS + CURLY_QUOTES

    def clean(text: Column) -> Column:
        clean = F.translate(text, found, " " * len(CONTROL_CHARS) + STRAIGHT_QUOTES)
        return F.when(holds_any(text, CURLY_QUOTES) | text.rlike(f"[{CONTROL_CHARS}]"), clean).otherwise(text)

    return collapse_whitespace(let(text, clean))


def normalize(text: Column) -> Column:
    return clean_characters(html_unescape(F.coalesce(text, F.lit(""))))
