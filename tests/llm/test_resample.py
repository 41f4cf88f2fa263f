from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from textsieve.llm import resample


def grams(text, length):
    words = re.findall(resample.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(words[i : i + n]) for n in range(1, length + 1) for i in range(len(words) - n + 1)], len(words)


def brute_force(texts, target, length, buckets, percent, least):
    made = [grams(text, length) for text in texts]
    held = [[crc32(gram.encode()) % buckets for gram in found] for found, _ in made]
    s = Counter(b for one in held for b in one)
    t = Counter(crc32(gram.encode()) % buckets for text in target for gram in grams(text, length)[0])
    total, wanted = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1.0) * (total + buckets) / ((s[b] + 1.0) * (wanted + buckets))))

    rows = []
    for i, one in enumerate(held):
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, one))
        rows.append([i, len(one), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((row for row in rows if made[row[0]][1] >= least), key=lambda row: (-row[3], row[0]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, rows), key=lambda row: row[0])


@pytest.mark.parametrize("length,buckets,percent", [(1, 10_000, 10), (3, 97, 25), (2, 1 << 17, 100)])
def test_same_as_brute_force(spark, make_docs, length, buckets, percent):
    rng = random.Random(length)
    words = ["alpha", "Beta", "gamma", "délta", "日本", "x", "42"]
    texts = [rng.choice([" ", "\x00", ".\n", "-"]).join(rng.choices(words, k=rng.choice([0, 1, 2, 5, 30]))) for _ in range(300)] + [None, ""]
    target = ["alpha beta alpha 42", None, "unseen words", ""]
    found = resample.resample(
        make_docs(texts), spark.createDataFrame([(t,) for t in target], "text string"), length, buckets, percent, least_words=4
    ).collect()
    rows = sorted((tuple(row) for row in found), key=lambda row: row[0])
    assert rows == brute_force(texts, target, length, buckets, percent, 4)
    assert sorted(row[4] for row in rows if row[4]) == list(range(1, 1 + sum(row[4] is not None for row in rows)))


def test_no_gram_reaches_into_the_next_text():
    words, hashed, sizes = resample.batch_features([b"a b", b"", b"c", b"d e f"], 3, 1 << 16)
    assert words.tolist() == [2, 0, 1, 3] and sizes.tolist() == [3, 0, 1, 6]
    assert hashed.tolist() == [crc32(g) % (1 << 16) for g in (b"a", b"b", b"a b", b"c", b"d", b"e", b"f", b"d e", b"e f", b"d e f")]


def test_the_target_is_preferred(spark, make_docs, prose):
    """Documents out of the target's words are drawn before others."""
    own = prose(1, 400).split()
    target = [" ".join(random.Random(-i).choices(own, k=200)) for i in range(1, 41)]
    texts = [" ".join(random.Random(i).choices(own, k=60)) if i % 10 == 0 else prose(100 + i, 60) for i in range(300)]
    rows = resample.resample(make_docs(texts), spark.createDataFrame([(t,) for t in target], "text string")).collect()
    drawn = [row["doc_id"] for row in rows if row["rank"]]
    assert len(drawn) == 30 and sum(i % 10 == 0 for i in drawn) >= 27


def test_buckets_are_bounded(spark, make_docs):
    with pytest.raises(ValueError):
        resample.resample(make_docs(["a"]), make_docs(["a"]), buckets=0)
