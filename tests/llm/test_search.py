from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from textsieve.llm import lexical


def brute_force(texts, items, k):
    """Every document scored for every item."""
    found = [re.findall(lexical.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) for text in texts]
    documents, terms = sum(map(bool, found)), sum(map(len, found))
    rows = []
    for item_id, text in items:
        scores = [0] * len(texts)
        for term in sorted(set(re.findall(lexical.TERM, (text or "").lower()))):
            df = sum(term in words for words in found)
            weight = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
            for i, words in enumerate(found):
                tf, m = words.count(term), 10 + (90 * len(words) * documents) // max(terms, 1)
                scores[i] += weight * ((1000000000 * tf) // (1000 * tf + 8 * m))
        best = sorted((-score, i) for i, score in enumerate(scores) if score > 0)[:k]
        rows += [(item_id, rank, i, -score) for rank, (score, i) in enumerate(best, 1)]
    return sorted(rows)


@pytest.fixture(scope="module")
def corpus():
    """Texts over few words of very uneven frequency, with copies, and items out of the same words."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    shares = [1 / (i + 1) for i in range(300)]

    def text(n):
        return " ".join(rng.choices(words, shares, k=n))

    texts = [text(rng.choice([3, 20, 80, 300])) for _ in range(700)]
    texts += [texts[3]] * 40 + [None, "", "...", "w1 " * 70_000, "W7, w8;W9"]
    items = [(i, text(rng.choice([1, 4, 12, 30]))) for i in range(40)]
    return texts, items + [(40, None), (41, "nothing known"), (42, texts[3])]


@pytest.mark.parametrize("shard_bytes", [1 << 10, 20_000, 8 << 20])
def test_search_finds_what_brute_force_finds(spark, make_docs, corpus, shard_bytes):
    texts, items = corpus
    index = lexical.build_index(make_docs(texts), shard_bytes=shard_bytes)
    found = lexical.search(index, spark.createDataFrame(items, "item_id bigint, text string"), k=7).collect()
    assert sorted(tuple(row) for row in found) == brute_force(texts, items, 7)


def test_items_in_several_blocks(spark, make_docs, corpus, monkeypatch):
    texts, items = corpus
    monkeypatch.setattr(lexical, "ITEM_BYTES", 300)
    table = spark.createDataFrame(items, "item_id bigint, text string")
    assert len(list(lexical._blocks(table))) > 3
    found = lexical.search(lexical.build_index(make_docs(texts)), table).collect()
    assert sorted(tuple(row) for row in found) == brute_force(texts, items, 10)


def opened(texts, wanted):
    row = {"doc_ids": list(range(len(texts))), **lexical.invert([text.encode() for text in texts])}
    return lexical.Shard(row, frozenset(wanted), lexical.Statistics(row["n_docs"], row["n_terms"]))


def test_postings_come_back_as_they_were():
    rng = random.Random(1)
    texts = [" ".join(["a"] * rng.choice([0, 1, 255, 256, 70_000]) + ["b"] * (i % 600 == 0) + ["c"]) for i in range(1500)]
    shard = opened(texts, [b"a", b"b", b"c"])
    for term in "abc":
        postings = shard.lists[term.encode()]
        docs, tfs = postings.read(np.arange(len(postings.counts)))
        assert [(d, t) for d, t in zip(docs.tolist(), tfs.tolist())] == [(i, n) for i, x in enumerate(texts) if (n := x.split().count(term))]
        last, _ = postings.read(np.array([len(postings.counts) - 1]))
        assert last.tolist() == docs.tolist()[lexical.BLOCK * (len(postings.counts) - 1) :]


def test_blocks_without_a_chance_are_not_decompressed(monkeypatch):
    """One document holds the rare word; of the list of the common word only its block is read."""
    texts = ["common words here"] * 5000
    texts[3210] = "common rare"
    shard = opened(texts, [b"common", b"rare"])
    read = []
    whole = lexical.Postings.read
    monkeypatch.setattr(lexical.Postings, "read", lambda self, blocks: read.extend(blocks.tolist()) or whole(self, blocks))
    item = [(b"common", 1), (b"rare", 8000)]
    docs, _ = shard.candidates(item, 1, 1)
    assert docs.tolist() == [3210]
    read.clear()
    docs, scores = shard.candidates(item, 1, 8_000_000 // 2)
    assert docs.tolist() == [3210] and scores[0] > 4_000_000
    assert sorted(read) == [0, 3210 // lexical.BLOCK]
