"""Column functions against plain-Python statements of the same rules."""

from __future__ import annotations

import html as stdlib_html
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests import corpus
from textsieve.config import PrepConfig
from textsieve.functions import attributes, code, fingerprint, html, normalize, pii, quality

ALPHABET = "ab Z9\u00e9\u0301\u00a0\u2028\u0085 \t\n\r_'=.([{;}])<>&#\U0001f600\u0130\x0b\x1c"


def random_texts(n=300, seed=5):
    chooser = random.Random(seed)
    return ["".join(chooser.choices(ALPHABET, k=chooser.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    return corpus.TEXTS + random_texts()


@pytest.mark.parametrize(
    "ours, theirs",
    [
        (attributes.tokenize, corpus.token_list),
        (attributes.char_count, len),
        (attributes.ascii_ratio, corpus.ascii_share),
        (attributes.symbol_ratio, corpus.symbol_share),
        (fingerprint.fingerprint, corpus.prints),
        (code.function_def, corpus.function_def),
        (code.method_calls, corpus.method_calls),
        (code.assignments, corpus.assignments),
        (normalize.collapse_whitespace, corpus.squeeze),
        (normalize.html_unescape, stdlib_html.unescape),
        (quality.long_repeat, lambda t: re.search(r"([a-zA-Z])\1{9}", t) is not None),
        (html.is_html, lambda t: re.search("<[a-zA-Z][^>]*>", t) is not None),
    ],
    ids=lambda f: getattr(f, "__name__", str(f)),
)
def test_same_as_plain_python(apply, texts, ours, theirs):
    results = apply(ours, texts)
    wrong = [(t, r, theirs(t)) for t, r in zip(texts, results) if r != theirs(t)]
    assert not wrong, wrong[:3]


def test_lines_and_their_features(apply, texts):
    def lines(text):
        return [line for line in text.lower().splitlines() if line.strip()]

    def codey(text):
        return sum(
            line.lstrip().startswith(code.LINE_STARTS) or line.endswith(code.LINE_ENDS)
            for line in lines(text)
        )

    def indented(text):
        return sum(
            len(line) - len(line.lstrip()) >= 8 or line.startswith("\t\t") for line in lines(text)
        )

    split = lambda text: code.text_lines(F.lower(text))
    assert apply(split, texts) == [[line.lstrip() for line in lines(t)] for t in texts]
    assert apply(lambda text: code.codey_lines(split(text)), texts) == [codey(t) for t in texts]
    assert apply(lambda text: code.indented_lines(F.lower(text)), texts) == [indented(t) for t in texts]


def test_brackets_and_punctuation(apply, texts):
    def pairs(text):
        return sum(min(text.count(a), text.count(b)) for a, b in ("()", "[]", "{}"))

    marks = code.code_punctuation
    assert apply(lambda t: code.bracket_pairs(marks(t)), texts) == [pairs(t) for t in texts]
    assert apply(lambda t: F.length(marks(t)), texts) == [
        sum(c in "{}[]();=<>" for c in t) for t in texts
    ]


def test_normalize_golden(apply):
    raw = "one ‘two’ &lt;\x0c three  \t\n\n“four”"
    assert apply(normalize.normalize, [raw, None]) == ["one 'two' < three \n\"four\"", ""]


def test_unescape_is_one_pass(apply):
    assert apply(normalize.html_unescape, ["&amp;amp; &#65;&#x42; &copy &nosuch; & alone"]) == [
        "&amp; AB © &nosuch; & alone"
    ]


def test_unescape_takes_a_few_texts_at_a_time(monkeypatch):
    """A batch stays in Arrow; only slices of it become Python objects."""
    seen = []
    unescape = normalize.html.unescape
    monkeypatch.setattr(normalize.html, "unescape", lambda t: seen.append(t) or unescape(t))
    texts = ["&amp;amp;", None, "", "&copy é", *(f"&#{i};" for i in range(40, 600))]
    decoded = normalize._decode_entities.func(pa.array(texts))
    assert isinstance(decoded, pa.Array)
    assert decoded.to_pylist() == [t and unescape(t) for t in texts]
    assert seen == [t for t in texts if t is not None]
    assert normalize._decode_entities.func(pa.array([], pa.string())).to_pylist() == []


def test_control_characters_keep_tab_and_line_ends(apply):
    assert apply(normalize.strip_control, ["a\x00b\tc\nd\re\x7ff"]) == ["a b\tc\nd\re f"]


def test_attributes_golden(spark):
    df = spark.createDataFrame([("Go on, é?",)], "t string")
    row = df.select(*(c.alias(n) for n, c in attributes.attributes(F.col("t")).items())).first()
    assert row["tokens"] == ["go", "on"]
    assert row["char_count"] == 9
    assert row["ascii_ratio"] == pytest.approx(8 / 9)
    assert row["symbol_ratio"] == pytest.approx(2 / 9)


@pytest.mark.parametrize(
    "text, chars, ascii_share, symbol_share, reason",
    [
        ("door", 4, 1.0, 0.0, "too_short"),
        ("xy " * 7, 21, 1.0, 0.0, "too_long"),
        ("some words", 10, 0.5, 0.0, "non_ascii_heavy"),
        ("some words", 10, 1.0, 0.3, "symbol_heavy"),
        ("oh zzzzzzzzzz", 13, 1.0, 0.0, "long_repeat"),
        ("a line of words", 15, 1.0, 0.0, None),
        ("zzzzzzzzzz", 4, 0.5, 0.3, "too_short"),
    ],
)
def test_preliminary_reasons(spark, text, chars, ascii_share, symbol_share, reason):
    config = PrepConfig(min_char_len=5, max_char_len=20, min_ascii_ratio=0.8, max_symbol_ratio=0.2)
    df = spark.createDataFrame(
        [(text, chars, ascii_share, symbol_share)], "t string, c int, a double, s double"
    )
    found = quality.preliminary_reason(F.col("t"), F.col("c"), F.col("a"), F.col("s"), config)
    assert df.select(found.alias("r")).first()["r"] == reason


@pytest.mark.parametrize("length, reason", [(49, "too_short"), (50, None), (20000, None), (20001, "too_long")])
def test_length_edges(spark, length, reason):
    df = spark.createDataFrame([("ab " * 10000,)], "t string").select(F.expr(f"left(t, {length})").alias("t"))
    text = F.col("t")
    found = quality.preliminary_reason(text, F.length(text), F.lit(1.0), F.lit(0.0))
    assert df.select(found.alias("r")).first()["r"] == reason


def test_fixed_lists():
    assert len(set(code.STOPWORDS)) == 179
    assert len(set(code.KEYWORDS)) == 68
    assert len(code.LINE_STARTS) == 20
    assert len(html.NOISE_WORDS) == 21


def test_pronouns(apply):
    cases = {
        "She saw him with hers.": "<HE/SHE> saw <HIM/HER> with <HIS/HER>.",
        "HE he's Hé hero she-he": "HE <HE/SHE>'s Hé hero <HE/SHE>-<HE/SHE>",
        "Him himself Herself hers herselfx _he": "<HIM/HER> <HIMSELF/HERSELF> <HIMSELF/HERSELF> <HIS/HER> herselfx _he",
        "éhe hé": "é<HE/SHE> <HE/SHE>́",
        "he he he": "<HE/SHE> <HE/SHE> <HE/SHE>",
    }
    assert apply(pii.neutralize_pronouns, list(cases)) == list(cases.values())


def test_pronouns_same_as_plain_python(apply, texts):
    words = {w: token for token, ws in pii.PRONOUNS for w in ws}
    forms = "|".join([*words, *(w.capitalize() for w in words)])

    def expected(text):
        return re.sub(rf"\b(?:{forms})\b", lambda m: words[m[0].lower()], text)

    assert apply(pii.neutralize_pronouns, texts) == [expected(t) for t in texts]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("write to a.b@c-d.org.", "write to <EMAIL_ADDRESS>."),
        ("x@y no@dot. a@b.c-", "x@y no@dot. <EMAIL_ADDRESS>"),
        ("from 10.0.0.255, not 10.0.0.256", "from <IP_ADDRESS>, not 10.0.0.256"),
        ("at 2001:db8::1 and 1:2:3:4:5:6:7:8", "at <IP_ADDRESS> and <IP_ADDRESS>"),
        ("time 12:30:45, std::string", "time 12:30:45, std::string"),
        ("call +1 (743) 555-3824 now", "call <PHONE_NUMBER> now"),
        ("call (743) 555-3824 or 743-555-3824", "call <PHONE_NUMBER> or <PHONE_NUMBER>"),
        ("call +44 20 7946 0958", "call <PHONE_NUMBER>"),
        ("card 4111111111111111 stays", "card 4111111111111111 stays"),
        ("card 4111 1111 1111 1111 stays", "card 4111 1111 1111 1111 stays"),
        ("nothing here", "nothing here"),
    ],
)
def test_pattern_masks(apply, text, expected):
    assert apply(pii.mask_patterns, [text]) == [expected]


ODD = {
    "labels": "mail a@" + "b." * 10_000 + "c",
    "dots": "a@b" + "." * 20_000,
    "local": "@" + "a" * 20_000,
    "colons": "1:" * 10_000 + ":",
    "numbers": "1.2." * 5_000,
    "phones": "+1 " + "22 " * 7_000,
    "brackets": "(123) " * 4_000,
    "calls": "f.a(" * 5_000 + " = '",
    "blanks": (" " * 9 + "x\n") * 2_000,
    "angles": "<a" * 10_000,
}


@pytest.mark.parametrize("name", ODD)
def test_patterns_survive_odd_texts(apply, name):
    """No pattern may use stack in proportion to the text."""
    text = ODD[name]
    for function in (
        pii.mask_patterns, pii.neutralize_pronouns, normalize.normalize, attributes.symbol_ratio, code.function_def,
        code.method_calls, code.assignments, lambda t: F.size(code.text_lines(F.lower(t))), quality.long_repeat, html.is_html,
    ):
        assert apply(function, [text])[0] is not None


def test_spans(spark):
    text = "John Doe met Ann 😀 in Rome"
    spans = [("LOCATION", 22, 26), ("PERSON", 0, 8), ("PERSON", 5, 8), ("PERSON", 13, 16)]
    df = spark.createDataFrame(
        [(text, spans), (text, []), (text, None)],
        "t string, s array<struct<entity: string, start: int, end: int>>",
    )
    masked = [r["m"] for r in df.select(pii.mask_spans(F.col("t"), F.col("s")).alias("m")).collect()]
    assert masked == ["<PERSON> met <PERSON> 😀 in" + " <LOCATION>", text, text]
