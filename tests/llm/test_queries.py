from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks import compare
from textsieve.llm.oracle import ORACLE
from textsieve.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLE", ORACLE)
    assert compare.compare(spark, FOLDER, name) == ""


def test_pipeline(spark):
    assert len(corpus_pipeline.STAGES) == 5
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert 0 < len(rows) < len(texts)
    for row in rows:
        kept = row["text"].split("\n")
        own = iter(texts[row["doc_id"]].split("\n"))
        assert not row["text"] or all(line in own for line in kept)  # lines of its text, in order
        assert row["n_tokens"] == len(row["ids"])
