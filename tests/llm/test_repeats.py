from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np

from textsieve.llm import repeats
from textsieve.llm.repeats import remove_repeats, sliding_least

LENGTH = 400


def brute(texts):
    strings = Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    result = []
    for t in texts:
        edges = np.zeros(len(t) + 1, int)
        for i in range(len(t) - LENGTH + 1):
            if strings[t[i : i + LENGTH]] > 1:
                edges[i] += 1
                edges[i + LENGTH] -= 1
        gone = np.cumsum(edges)[: len(t)] > 0
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        result.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return result


def same(make_docs, texts):
    rows = remove_repeats(make_docs(texts)).orderBy("doc_id").collect()
    assert [tuple(r)[1:5] for r in rows] == brute([t.encode() for t in texts])


def test_sliding_least():
    values = np.random.default_rng(0).integers(0, 100, 57).astype(np.uint64)
    for width in (1, 5, 20, 57):
        assert sliding_least(values, width).tolist() == [values[i : i + width].min() for i in range(len(values) - width + 1)]
    assert len(sliding_least(values, 58)) == 0


def test_passages_of_every_length(make_docs, prose):
    passage = prose(1, 300)
    texts = [prose(10, 200), passage, prose(11, 100) + passage[:399] + prose(12, 90), prose(13, 70) + passage[:400] + prose(14, 50)]
    texts += [prose(20 + i, 80) + passage[i * 37 : i * 37 + 380 + i * 9] + prose(40 + i, 60) for i in range(12)]
    same(make_docs, texts)


def test_copies_edits_periods_and_overlaps(make_docs, prose):
    one = prose(2, 400)
    edited = one[:700] + "X" + one[701:1500] + one[1520:]
    texts = [one, one, edited, edited[:900] + "Y" + edited[901:], "ab" * 900, "c" * 401, "c" * 400, "abc " * 99 + "abc", "é" * 700, "", one[:399]]
    same(make_docs, texts)


def test_many_different_neighbours(make_docs, prose):
    """A passage in more documents than one task compares at its borders."""
    passage = prose(3, 120)
    texts = [prose(100 + i, 60) + passage + prose(2000 + i, 60) for i in range(620)]
    same(make_docs, texts)


def test_same_document_only(make_docs, prose):
    passage = prose(4, 100)
    same(make_docs, [passage + prose(5, 40) + passage])


def test_a_run_of_one_character_is_looked_into_once(make_docs, prose, monkeypatch):
    """Each start of a run is a phrase of its own with the same core; one place of each is enough."""
    looked = []

    def border_bytes(docs, length, make=repeats.border_bytes):
        data = make(docs, length)
        looked.append(data.count())
        return data

    monkeypatch.setattr(repeats, "border_bytes", border_bytes)
    same(make_docs, [prose(1, 100) + "z" * 5000 + prose(2, 100), prose(3, 100) + "z" * 700 + prose(4, 100)])
    assert looked[0] < 1000
