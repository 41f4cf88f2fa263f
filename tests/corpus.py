"""Awkward texts, and the rules over them stated in plain Python."""

from __future__ import annotations

import hashlib
import re

TEXTS = [
    "",
    "plain words here",
    "tabs\t\tand  blanks\n\n\nand lines\n",
    "carriage\r\nreturn\rhere",
    "nbsp\u00a0\u00a0run and\u2009thin\u3000space",
    "line\u2028separator = 1\u2029x = 2\u0085y = 3\nz = 4",
    "combining e\u0301 a\u0308 marks, he\u0301 and \u0301she",
    "İstanbul ΟΔΥΣΣΕΥΣ Straße",
    "emoji 😀😀 and 𝒳 math",
    "one; two;\nfrom here\n  # note\nplain\n}",
    "\x0b\x0ccontrol\x00chars\x1f\x7f here\x1c\x1d",
    "“curly” ‘quotes’ stay",
    "aaaaaaaaa nine",
    "aaaaaaaaaa ten",
    "AAAAAaaaaa mixed",
    "a.b(1) c.d (2) é.ü(3)",
    "x = 1\ny = [2]\n z={3}\nw= 'four'",
    "def f(x): return x",
    "undef f(x) and const  y (z)",
    "½ ² Ⅷ ① 五 numbers",
    "don't can't y'all 'quoted'",
    "١٢٣ arabic ३ digits",
    "\u3000ideographic\u3000space\u3000",
    "He's here. Hé too; she/her (his) HIM him, himself_ herself.",
    "brackets (a [b {c} d] e) ((( ]]] == <>;;",
    "        eight blanks\n\t\ttwo tabs\n short",
]


def token_list(text):
    return re.findall("[a-z']+", text.lower())


def ascii_share(text):
    return len([c for c in text if c < "\x80"]) / len(text) if text else 0.0


def symbol_share(text):
    odd = [c for c in text if not (c.isalnum() or c.isspace())]
    return len(odd) / len(text) if text else 0.0


def prints(text):
    return hashlib.sha1(" ".join(text.lower().split()).encode()).hexdigest()


def method_calls(text):
    return len(re.findall(r"\.\w+\s*\(", text))


def assignments(text):
    return len(re.findall(r"""(?m)^\s*\w+\s*=\s*[\w\[{('"]""", text))


def function_def(text):
    return re.search(r"\b(?:def|function|const|let|var)\s+\w+\s*\(", text) is not None


def squeeze(text):
    return re.sub("\n\n+", "\n", re.sub("[ \t]+", " ", text))
