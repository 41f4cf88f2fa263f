"""Stage 9: masks for personal data and gendered pronouns.

The patterns hold no look-around, so that any SQL engine can check them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

from textsieve.functions.classes import NOT_BEFORE_WORD, WORD

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_GROUP = "[0-9A-Fa-f]{1,4}"

# One character class after the first dot: Java matches a repeated group by recursion.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z0-9-]"
IP = (
    rf"\b(?:{_OCTET}\.){{3}}{_OCTET}\b"
    rf"|\b(?:{_GROUP}:){{7}}{_GROUP}\b"
    rf"|\b{_GROUP}(?::{_GROUP}){{1,5}}::(?:{_GROUP}(?::{_GROUP}){{0,4}}\b)?"
)
PHONE = (
    r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}\b"
    r"|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,4}\b"
    r"|\b[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}\b"
)
# Entities in masking order: pattern, and a cheaper one that every match satisfies.
PATTERNS = {
    "EMAIL_ADDRESS": (EMAIL, "@"),
    "IP_ADDRESS": (IP, r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f:]"),
    "PHONE_NUMBER": (PHONE, r"\+[0-9]|[0-9]{3}[).-]"),
}
ENTITIES = ("PERSON", "LOCATION", "EMAIL_ADDRESS", "PHONE_NUMBER", "IP_ADDRESS")

# Pronouns and what replaces them; only all-lower and capitalized forms count.
PRONOUNS = (
    ("<HE/SHE>", ("he", "she")),
    ("<HIS/HER>", ("his", "her", "hers")),
    ("<HIM/HER>", ("him",)),
    ("<HIMSELF/HERSELF>", ("himself", "herself")),
)
PRONOUN_TOKENS = tuple(token for token, _ in PRONOUNS)


def token(entity: str) -> str:
    return f"<{entity}>"


def _pronoun_patterns(words: tuple[str, ...]) -> list[str]:
    """One pattern per initial: the initial in both cases, a word edge before it, the rest.

    A leading character class is what Java finds fastest; a leading look-behind
    would be tried at every character.
    """
    patterns = []
    for initial in sorted({word[0] for word in words}):
        letter = f"[{initial.upper()}{initial}]"
        rests = "|".join(word[1:] for word in words if word[0] == initial)
        patterns.append(f"{letter}(?<!{WORD}{letter})(?:{rests}){NOT_BEFORE_WORD}")
    return patterns


def mask(text: Column, entity: str) -> Column:
    pattern, needed = PATTERNS[entity]
    return F.when(text.rlike(needed), F.regexp_replace(text, pattern, token(entity))).otherwise(text)


def mask_patterns(text: Column) -> Column:
    """E-mail addresses, then IP addresses, then phone numbers."""
    return reduce(mask, PATTERNS, text)


def whole(text: Column) -> Column:
    """One untouched piece. Pieces are array<struct<text, entity>>; their texts joined are the
    original text, and those with an entity are its matches."""
    return F.array(F.struct(text.alias("text"), F.lit(None).cast("string").alias("entity")))


def cut(pieces: Column, pattern: Column, entity: Column, needed: Callable[[Column], Column]) -> Column:
    """Cut the pattern's matches out of the untouched pieces for which needed holds.

    Masks begin with "<" and end with ">", which no entity pattern can take in and
    no word edge tells from the ends of a text. So the matches in the pieces are
    those that would be found in the text with all earlier matches masked.
    """

    def parts(text: Column) -> Column:
        between = F.split(text, pattern, -1)
        found = F.regexp_extract_all(text, F.concat(F.lit("("), pattern, F.lit(")")), F.lit(1))
        none = F.lit(None).cast("string")

        def pair(before: Column, match: Column) -> Column:
            return F.array(
                F.struct(before.alias("text"), none.alias("entity")),
                F.struct(match.alias("text"), entity.alias("entity")),
            )

        return F.filter(F.flatten(F.zip_with(between, found, pair)), lambda piece: piece["text"] != "")

    def step(piece: Column) -> Column:
        open_ = piece["entity"].isNull() & needed(piece["text"])
        return F.when(open_, parts(piece["text"])).otherwise(F.array(piece))

    return F.flatten(F.transform(pieces, step))


def cut_patterns(text: Column) -> Column:
    """Pieces of a text after all pattern entities, in masking order."""
    pieces = whole(text)
    for entity, (pattern, needed) in PATTERNS.items():
        pieces = cut(pieces, F.lit(pattern), F.lit(entity), lambda part, needed=needed: part.rlike(needed))
    return pieces


def masked_pieces(pieces: Column) -> Column:
    """The text with each match replaced by its mask."""
    shown = F.transform(pieces, lambda piece: F.coalesce(F.concat(F.lit("<"), piece["entity"], F.lit(">")), piece["text"]))
    return F.array_join(shown, "")


def changed(masked: Column, text: Column) -> Column:
    """Whether masking replaced anything.

    Masks start with "<" and no match does, so texts differ at the first match.
    """
    return masked != text


def neutralize_pronouns(text: Column) -> Column:
    """The replacements are upper case, so none is matched again."""
    for replacement, words in PRONOUNS:
        for pattern in _pronoun_patterns(words):
            text = F.regexp_replace(text, pattern, replacement)
    return text


def mask_spans(text: Column, spans: Column) -> Column:
    """Mask array<struct<entity, start, end>> spans (0-based, end excluded).

    Spans may come in any order; one that overlaps an earlier masked span is left out.
    """

    def step(done: Column, span: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        masked = F.struct(
            span["end"].cast("int").alias("at"),
            F.concat(done["out"], gap, F.lit("<"), span["entity"], F.lit(">")).alias("out"),
        )
        return F.when(span["start"] >= done["at"], masked).otherwise(done)

    def sortable(span: Column) -> Column:
        return F.struct(
            span["start"].alias("start"),
            (-span["end"]).alias("longest_first"),
            span["end"].alias("end"),
            span["entity"].alias("entity"),
        )

    def rest(done: Column) -> Column:
        return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))

    ordered = F.array_sort(F.transform(spans, sortable))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(spans) > 0, F.aggregate(ordered, start, step, rest)).otherwise(text)
