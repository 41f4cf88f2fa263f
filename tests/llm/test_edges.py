"""Nulls, empty and long texts, repeated rows, empty tables, clashing columns: every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textsieve.llm import bpe, brown, cotrain, decontaminate, langid, lexical, licenses, lines, maintext, minhash, repeats, resample, rules
from textsieve.llm.queries import tokenizer

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ["id", "n", "h", "words", "lines", "first", "last", "places", "core", "whole", "component_id", "kept", "ids", "of", "runs", "split", "host", "rules", "word"]
BENCHMARK = [(1, "the quick brown fox jumps over the lazy dog and goes home to sleep a little"), (2, None), (3, ""), (None, "tiny")]


def benchmark(spark):
    return spark.createDataFrame(BENCHMARK, "item_id bigint, text string")


def labels(spark):
    return spark.createDataFrame([(1, 1), (1, None), (2, 0), (None, 1)], "doc_id bigint, quality int")


OPERATORS = {
    "repeats": lambda s, d: repeats.remove_repeats(d),
    "lines": lambda s, d: lines.line_dedup(d)[0],
    "rules": lambda s, d: rules.quality_rules(d),
    "licenses": lambda s, d: licenses.license_scan(d),
    "cotrain": lambda s, d: cotrain.score_quality(d, labels(s)),
    "brown": lambda s, d: brown.score(d),
    "minhash": lambda s, d: minhash.near_duplicates(d, 2),
    "langid": lambda s, d: langid.identify(d),
    "resample": lambda s, d: resample.resample(d, benchmark(s)),
    "bpe": lambda s, d: bpe.digests(d, *tokenizer()),
}


@pytest.fixture(scope="module")
def odd(spark, prose):
    long = prose(1, 60_000)
    rows = [
        (None, "a text without id", "en", "src0", 17),
        (1, None, None, None, None),
        (2, "", "de", "src1", 0),
        (3, " \n\t\n ", "en", "src1", 5),
        (4, long, "en", "src0", len(long)),
        (5, "aaaa" * 2000, "en", "src0", 8000),
        (6, "plain short text", "fr", "src0", 16),
        (6, "plain short text", "fr", "src0", 16),
        (7, "naïve 日本語 \U0001f600 text", None, "src0", 20),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASHING}).repartition(2)


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, odd, name):
    result = OPERATORS[name](spark, odd).collect()
    assert len(result) == 9
    assert sorted((r["doc_id"] for r in result), key=str) == [1, 2, 3, 4, 5, 6, 6, 7, None]


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, odd, name):
    assert OPERATORS[name](spark, odd.limit(0)).collect() == []


def test_odd_rows_of_brown(spark, odd):
    """A repeated id has a row each."""
    found = brown.score(odd).collect()
    rows = {r["doc_id"]: r for r in found}
    assert rows[1]["n_tokens"] == rows[2]["n_tokens"] == rows[3]["n_tokens"] == 1
    assert [r["n_tokens"] for r in found if r["doc_id"] == 6] == [4, 4]


def test_odd_rows_of_decontamination(spark, odd):
    assert decontaminate.leaks(odd, benchmark(spark)).collect() == []
    assert decontaminate.leaks(odd, benchmark(spark).limit(0)).collect() == []
    assert decontaminate.decontaminate(odd.limit(0), benchmark(spark)).collect() == []
    assert decontaminate.decontaminate(odd, benchmark(spark)).columns == odd.columns


def test_odd_rows_of_search(spark, odd):
    rows = lexical.search(lexical.build_index(odd), benchmark(spark)).collect()
    assert {r["item_id"] for r in rows} == {1}  # the item of null id has no word of the documents
    assert len({r["rank"] for r in rows}) == len(rows) <= 10
    again = spark.createDataFrame([(None, "plain"), (7, "plain"), (7, "PLAIN short"), (8, "id")], "item_id bigint, text string")
    found = lexical.search(lexical.build_index(odd), again.withColumn("rank", F.lit("x"))).collect()
    assert [(r["doc_id"], r["rank"]) for r in found if r["item_id"] is None] == [(6, 1), (6, 2)]
    assert sorted(r["doc_id"] for r in found if r["item_id"] == 7) == [6] * 4
    assert [r["doc_id"] for r in found if r["item_id"] == 8] == [None]
    assert lexical.search(lexical.build_index(odd.limit(0)), benchmark(spark)).collect() == []
    assert lexical.search(lexical.build_index(odd), benchmark(spark).limit(0)).collect() == []


def test_odd_rows_of_main_text(spark):
    long = "<article>" + "<p>word " * 50_000
    rows = [(None, "u", "<p>a</p>"), (1, None, None), (2, "u", ""), (3, "u", long), (3, "u", long), (4, "u", "<" * 3000 + "&" * 3000), (5, "u", "<div>" * 20_000 + "</p>" * 20_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit("x") for c in ("text", "n_chars", "words")})
    found = maintext.main_text(pages).collect()
    assert sorted(((r["page_id"], r["n_chars"]) for r in found), key=str) == [(1, 0), (2, 0), (3, 249_999), (3, 249_999), (4, 0), (5, 0), (None, 0)]
    assert {r["url"] for r in found} == {None, "u"}
    assert maintext.main_text(pages.limit(0)).collect() == []


def test_values_of_odd_rows(spark, odd):
    repeated = {r["doc_id"]: r for r in repeats.remove_repeats(odd).collect()}
    assert (repeated[5]["n_bytes"], repeated[5]["n_removed"], repeated[5]["n_spans"]) == (8000, 8000, 1)
    assert (repeated[4]["n_removed"], repeated[None]["n_removed"], repeated[1]["n_bytes"]) == (0, 0, 0)
    near = {r["doc_id"]: r for r in minhash.near_duplicates(odd, 2).collect()}
    assert (near[2]["n_shingles"], near[2]["component_id"], near[5]["n_shingles"]) == (0, 2, 1)
    assert near[None]["component_id"] is None
    language = {r["doc_id"]: r for r in langid.identify(odd).collect()}
    assert [language[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    ruled = {r["doc_id"]: r for r in rules.quality_rules(odd).collect()}
    assert (ruled[1]["n_words"], ruled[1]["base_failed"], ruled[1]["kept"]) == (0, True, False)
    drawn = {r["doc_id"]: r for r in resample.resample(odd, benchmark(spark)).collect()}
    assert (drawn[1]["n_features"], drawn[1]["weight"], drawn[1]["rank"], drawn[5]["n_features"]) == (0, 0, None, 1)
    found = {r["doc_id"]: r for r in licenses.license_scan(odd).collect()}
    assert (found[1]["labels"], found[1]["first_word"], found[1]["score"]) == ("", None, 0.0)


def test_pipeline_of_odd_rows(spark, odd, tmp_path):
    benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (odd, odd.limit(0)):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            before = docs
            docs = stage(spark, docs, str(tmp_path))
            if name != "byte_bpe":
                assert docs.columns == before.columns
        docs.collect()
