"""Stage 5: rules that recognize source code. Any rule that holds omits the row."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from textsieve.functions.classes import (
    BLANK,
    BREAK_SET,
    NOT_AFTER_WORD,
    SPACE,
    SPACE_SET,
    WORD,
    WORD_SET,
)

# Starts (after leading blanks) and ends of code-like lines.
LINE_STARTS = (
    "//", "#", "/*", "*/", "--", "<!--",
    "import ", "from ", "const ", "let ", "var ", "def ",
    "function ", "class ", "async ", "export ", "return ",
    "public ", "private ", "protected ",
)
LINE_ENDS = ("{", "}", ";", "=>", ");", "]);", "};", "},")

# English stopwords.
STOPWORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
    he him his himself she she's her hers herself it it's its itself they them their theirs themselves
    what which who whom this that that'll these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of at by for with about
    against between into through during before after above below to from up down in out on off over
    under again further then once here there when where why how all any both each few more most other
    some such no nor not only own same so than too very s t can will just don don't should should've
    now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
    hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
    shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)
# Words of programming languages.
KEYWORDS = tuple(
    """
    def lambda import from try except finally with yield async await self cls None True False
    print range len str int float list dict tuple isinstance enumerate zip __init__ __name__ __main__
    elif pass raise assert global nonlocal
    function var let const console document window onclick typeof instanceof prototype constructor
    getElementById querySelector addEventListener setTimeout undefined require module export
    void bool array public private protected static final class new this
    """.split()
)


FUNCTION_DEF = rf"{NOT_AFTER_WORD}(?:def|function|const|let|var){SPACE}+{WORD}+{SPACE}*\("
METHOD_CALL = rf"\.{WORD}+{SPACE}*\("
ASSIGNMENT = rf"""(?md)^{SPACE}*{WORD}+{SPACE}*={SPACE}*[{WORD_SET}\[{{('"]"""
# From the first character that is not blank to the end of the line. Plain ASCII
# is taken in runs and never given back, which Java matches many times faster.
TRIMMED_LINE = f"[^{SPACE_SET}](?:[ -~]+|[^{BREAK_SET}])*+"
DEEP_BLANKS = rf"{SPACE}{{8}}|\t\t"
INDENTED_LINE = rf"(?<![^{BREAK_SET}])(?:{BLANK}{{8}}|\t\t){BLANK}*[^{SPACE_SET}]"
NOT_CODE_PUNCTUATION = r"[^{}\[\]();=<>]+"


def function_def(text: Column) -> Column:
    return text.contains("(") & text.rlike(FUNCTION_DEF)


def method_calls(text: Column) -> Column:
    return F.when(text.contains("("), F.regexp_count(text, F.lit(METHOD_CALL))).otherwise(0)


def assignments(text: Column) -> Column:
    return F.when(text.contains("="), F.regexp_count(text, F.lit(ASSIGNMENT))).otherwise(0)


def text_lines(low: Column) -> Column:
    """Lines of the lowercased text that are not blank, without their leading blanks."""
    return F.regexp_extract_all(low, F.lit(TRIMMED_LINE), F.lit(0))


def codey_lines(lines: Column) -> Column:
    def codey(line: Column) -> Column:
        starts = (line.startswith(start) for start in LINE_STARTS)
        ends = (line.endswith(end) for end in LINE_ENDS)
        return reduce(or_, [*starts, *ends])

    return F.size(F.filter(lines, codey))


def indented_lines(low: Column) -> Column:
    """Lines with eight leading blanks or two leading tabs. Rare after normalization."""
    count = F.regexp_count(low, F.lit(INDENTED_LINE))
    return F.when(low.rlike(DEEP_BLANKS), count).when(low.isNotNull(), 0)


def code_punctuation(text: Column) -> Column:
    """The punctuation of the text that is typical of code, nothing else."""
    return F.regexp_replace(text, NOT_CODE_PUNCTUATION, "")


def bracket_pairs(punctuation: Column) -> Column:
    def count(char: str) -> Column:
        return F.length(punctuation) - F.length(F.replace(punctuation, F.lit(char), F.lit("")))

    return sum((F.least(count(a), count(b)) for a, b in ("()", "[]", "{}")), F.lit(0))


def words_or_pieces(tokens: Column, low: Column) -> Column:
    """The tokens measured earlier, or blank-separated pieces when there are none."""
    pieces = F.filter(F.split(low, f"{SPACE}+"), lambda piece: piece != "")
    return F.when(F.size(tokens) > 0, tokens).otherwise(pieces)


def hits(words: Column, vocabulary: tuple[str, ...]) -> Column:
    """How many words are in the vocabulary. isin becomes a hash set."""
    return F.size(F.filter(words, lambda word: word.isin(*vocabulary)))


def strong_pattern(text: Column) -> Column:
    return function_def(text) | (method_calls(text) >= 3) | (assignments(text) >= 4)


# In the rules below, a share of nothing is null: Catalyst works out a share that is used twice
# before it looks at the condition that guards it, so texts without lines or words reach them.


def line_rule(lines: Column, codey: Column, indented: Column) -> Column:
    codey_share = F.try_divide(codey, lines)
    return (codey_share > 0.4) | ((F.try_divide(indented, lines) > 0.5) & (codey_share > 0.25))


def word_rule(
    words: Column, stopwords: Column, keywords: Column, punctuation: Column, pairs: Column, chars: Column
) -> Column:
    """Rules over word counts; all arguments are counts."""
    chars = F.greatest(chars, F.lit(1))
    stop_share = F.try_divide(stopwords, words)
    keyword_share = F.try_divide(keywords, words)
    punctuation_share = punctuation / chars
    density = pairs / chars * 100
    return (words > 0) & (
        ((stop_share < 0.05) & (keywords >= 3) & (punctuation_share > 0.15))
        | ((density > 3.0) & (stop_share < 0.08))
        | ((keyword_share > 0.20) & (stop_share < 0.10))
        | ((words < 15) & (keywords >= 2) & (stop_share < 0.05) & (punctuation_share > 0.12))
        | ((words >= 30) & (keywords >= 5) & (keyword_share > 0.15) & (stop_share < 0.10))
    )
