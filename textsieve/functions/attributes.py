"""Stage 2: tokens, lengths and character ratios of the normalized text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from textsieve.functions.classes import SPACE_SET

TOKEN = "([a-z']+)"
NON_ASCII = r"[^\x00-\x7f]+"
SYMBOLS = rf"[^\p{{L}}\p{{N}}{SPACE_SET}]+"


def tokenize(text: Column) -> Column:
    """Lowercased runs of ASCII letters and apostrophes."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(1))


def char_count(text: Column) -> Column:
    return F.length(text)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).when(whole == 0, 0.0)


def ascii_ratio(text: Column) -> Column:
    """Share of code points below 128."""
    kept = F.when(F.octet_length(text) == F.length(text), F.length(text)).otherwise(
        F.length(F.regexp_replace(text, NON_ASCII, ""))
    )
    return _share(kept, F.length(text))


def symbol_ratio(text: Column) -> Column:
    """Share of characters that are neither letters, numbers nor whitespace."""
    symbols = F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))
    return _share(symbols, F.length(text))


def attributes(text: Column) -> dict[str, Column]:
    """All measures but token_count, which is the size of tokens."""
    return {
        "tokens": tokenize(text),
        "char_count": char_count(text),
        "ascii_ratio": ascii_ratio(text),
        "symbol_ratio": symbol_ratio(text),
    }
