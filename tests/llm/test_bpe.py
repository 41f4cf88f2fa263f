from __future__ import annotations

import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from textsieve.llm.bpe import Encoder, PrefixTable, Vocabulary, decode, encode, merge_greedily, read_ranks
from textsieve.llm.queries import tokenizer

PATH, PATTERN = tokenizer()
RANKS = read_ranks(open(PATH, "rb").read())
ENCODER = Encoder(RANKS, PATTERN)
PUBLIC = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(text):
    return np.frombuffer(ENCODER.encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_same_as_the_public_library(text):
    assert ids(text) == PUBLIC.encode_ordinary(text)


@pytest.mark.parametrize(
    "text",
    ["", " ", "a  b", " a b ", "a \n b", "x y z", "don't we'll  it's", "a" * 500, "1234567890" * 30, "-" * 300, "<|endoftext|>", "a\x1cb c\x85d e"],
)
def test_blanks_runs_and_marks(text):
    assert ids(text) == PUBLIC.encode_ordinary(text)
    assert ENCODER.vocabulary.decode(ids(text)) == text.encode()


def test_appends_are_exact():
    rng = random.Random(3)
    table = PrefixTable(ENCODER.vocabulary)
    for _ in range(60):
        table.append(bytes(rng.choice(b"theandingor.") for _ in range(rng.randint(1, 4))))
        assert table.ids() == merge_greedily(table.piece, RANKS)


def test_edits_redo_a_part_only():
    rng = random.Random(5)
    piece = bytes(rng.choice(b"theandingor.") for _ in range(1500))
    table = PrefixTable(ENCODER.vocabulary, piece)
    for _ in range(20):
        start = rng.randrange(len(table.piece) - 10)
        stop = start + rng.randint(0, 8)
        done = table.edit(start, stop, bytes(rng.choice(b"xyzthe") for _ in range(rng.randint(0, 6))))
        fresh = PrefixTable(ENCODER.vocabulary, table.piece)
        assert table.last == fresh.last
        assert table.ids() == fresh.ids()
        assert done <= 6 + 3 * ENCODER.vocabulary.longest


def test_round_trip(make_docs):
    docs = make_docs(["some text\n\nmore", "ünïcode 日本 \U0001f600", ""])
    tokens = encode(docs, PATH, PATTERN)
    back = {r["doc_id"]: r["text"] for r in decode(tokens, PATH).collect()}
    assert back == {r["doc_id"]: r["text"] for r in docs.collect()}


def grown(seed):
    """A small vocabulary of tokens put together from earlier ones, some of which the merges never reach."""
    rng = random.Random(seed)
    tokens = [b"a", b"b", b"c"]
    while len(tokens) < 40:
        new = rng.choice(tokens) + rng.choice(tokens)
        if new not in tokens and len(new) < 12:
            tokens.append(new)
    rng.shuffle(single := tokens[:3])
    return {token: rank for rank, token in enumerate(single + tokens[3:])}


@pytest.mark.parametrize("seed", range(25))
def test_prefix_tables_follow_the_merges(seed):
    """Whatever the vocabulary: pieces, pairs of tokens, and tokens that no merge leads to."""
    ranks, rng = grown(seed), random.Random(seed)
    vocabulary = Vocabulary(ranks)
    for token, rank in ranks.items():
        assert (token in vocabulary.usable) == (merge_greedily(token, ranks) == [rank])
    for _ in range(300):
        left, right = rng.choice(list(vocabulary.usable.values())), rng.choice(list(vocabulary.usable.values()))
        both = vocabulary.tokens[left] + vocabulary.tokens[right]
        assert vocabulary.beside(left, right) == (merge_greedily(both, ranks) == [left, right])
        piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 40)))
        assert PrefixTable(vocabulary, piece).ids() == merge_greedily(piece, ranks)
