from __future__ import annotations

import random

import pytest


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, ids from 0 in steps of `step`."""

    def make(texts, step=1):
        rows = [(i * step, text, "en", f"src{i % 2}", len(text or "")) for i, text in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)

    return make


@pytest.fixture(scope="session")
def prose():
    """A function from a seed and a number of words to text without repeats of length."""
    parts = ["ba", "ce", "di", "fo", "gu", "la", "me", "ni", "po", "ru", "sa", "te", "vi", "zo"]

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))

    return make
