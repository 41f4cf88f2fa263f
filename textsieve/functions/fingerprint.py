"""Content fingerprint for exact deduplication."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from textsieve.functions.classes import SPACE


def canonical(text: Column) -> Column:
    """Lowercase, whitespace runs to one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), f"{SPACE}+", " "))


def fingerprint(text: Column) -> Column:
    return F.sha1(canonical(text))
