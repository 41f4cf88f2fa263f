"""Stage 3: cheap quality rules. The first that holds names the reason."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from textsieve.config import PrepConfig

LONG_REPEAT = r"([a-zA-Z])\1{9,}"


def too_short(chars: Column, config: PrepConfig) -> Column:
    return chars < config.min_char_len


def too_long(chars: Column, config: PrepConfig) -> Column:
    return chars > config.max_char_len


def non_ascii_heavy(ratio: Column, config: PrepConfig) -> Column:
    return ratio < config.min_ascii_ratio


def symbol_heavy(ratio: Column, config: PrepConfig) -> Column:
    return ratio > config.max_symbol_ratio


def long_repeat(text: Column) -> Column:
    """The same ASCII letter, in the same case, ten or more times in a row."""
    return text.rlike(LONG_REPEAT)


def preliminary_reason(
    text: Column,
    chars: Column,
    ascii_share: Column,
    symbol_share: Column,
    config: PrepConfig = PrepConfig(),
) -> Column:
    return (
        F.when(too_short(chars, config), "too_short")
        .when(too_long(chars, config), "too_long")
        .when(non_ascii_heavy(ascii_share, config), "non_ascii_heavy")
        .when(symbol_heavy(symbol_share, config), "symbol_heavy")
        .when(long_repeat(text), "long_repeat")
    )
