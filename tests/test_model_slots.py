"""Pretrained models in the slots, with stubs that note what they see."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from textsieve.config import PrepConfig
from textsieve.operators.models import batch_model
from textsieve.operators.steps import as_records, filter_step, language_step, pii_step, run_steps, toxicity_step
from textsieve.plans.prepare import Models, prepare


def noting(folder, answer):
    """A loader that leaves a file per load, and a model that leaves one per call with the texts it saw."""

    def load(path):
        words = open(path, encoding="utf-8").read().split() if path else []
        made = len(os.listdir(f"{folder}/loads"))
        open(f"{folder}/loads/{os.getpid()}-{made}", "w").close()

        def predict(texts):
            with open(f"{folder}/calls/{os.getpid()}", "a", encoding="utf-8") as file:
                file.write("".join(f"{len(texts)}\t{text}\n" for text in texts))
            return [answer(text, words) for text in texts]

        return predict

    return load


@pytest.fixture
def notes(tmp_path):
    for name in ("loads", "calls"):
        (tmp_path / name).mkdir()
    return tmp_path


def seen(notes):
    lines = [line.split("\t", 1) for file in (notes / "calls").iterdir() for line in file.read_text(encoding="utf-8").splitlines()]
    return sorted(text for _, text in lines), max((int(size) for size, _ in lines), default=0)


def test_loaded_once_in_a_worker_and_dead_rows_are_not_sent(spark, notes):
    words = notes / "ugly-words.txt"
    words.write_text("ugly nasty")
    model = batch_model(spark, noting(notes, lambda text, bad: 0.9 if text.split()[0] in bad else 0.1), "double", str(words), batch_size=3)
    texts = ["ugly one", "fine two", "dead three", "nasty four", *(f"plain {i}" for i in range(96))]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(24)
    steps = [filter_step(F.when(F.col("cleaned").startswith("dead"), "dead")), toxicity_step(model, 0.7)]
    for _ in range(2):
        rows = {r["id"]: r["omit_reason"] for r in run_steps(as_records(df), steps).collect()}
        assert [rows[i] for i in range(4)] == ["toxic_content", None, "dead", "toxic_content"]
        assert not any(rows[i] for i in range(4, 100))
    # 48 tasks in two jobs, but each worker process loaded it once.
    workers = [name.split("-")[0] for name in os.listdir(notes / "loads")]
    assert len(workers) == len(set(workers)) <= 8
    found, largest = seen(notes)
    assert found == sorted([text for text in texts if not text.startswith("dead")] * 2)
    assert largest <= 3


def test_language_and_span_models_in_the_plan(spark, notes):
    sentence = "is in the garden of the old house by the sea with all of them"
    texts = [f"hola {sentence}", f"Ann Lee {sentence}", "short", f"Ann Lee {sentence}", f"nobody {sentence}"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    language = batch_model(spark, noting(notes, lambda text, _: "es" if text.startswith("hola") else "en"), "string")
    spans = batch_model(
        spark,
        lambda path: lambda texts: [[("PERSON", 0, 7)] if text.startswith("Ann Lee") else [] for text in texts],
        "array<struct<entity: string, start: int, end: int>>",
    )
    config = PrepConfig()
    rows = {r["id"]: r for r in prepare(as_records(df), config, Models(language=language, entities=spans)).collect()}
    assert [rows[i]["omit_reason"] for i in range(5)] == ["non_english", None, "too_short", "duplicate", None]
    assert rows[1]["cleaned"] == f"<PERSON> {sentence}" and rows[1]["anonymized"] and not rows[4]["anonymized"]
    assert seen(notes)[0] == sorted([texts[0], texts[1], texts[4]])
    steps = [language_step(language), pii_step(spans)]
    again = {r["id"]: r for r in run_steps(as_records(df), steps).collect()}
    assert again[0]["omit_reason"] == "non_english" and again[3]["cleaned"] == f"<PERSON> {sentence}"


def test_no_rows_load_nothing(spark, notes):
    model = batch_model(spark, noting(notes, lambda text, _: 1.0), "double")
    df = spark.createDataFrame([(1, None), (2, None)], "id bigint, text string").repartition(2)
    assert [r[0] for r in df.select(model(F.col("text"))).collect()] == [None, None]
    assert df.limit(0).select(model(F.col("text"))).collect() == []
    assert os.listdir(notes / "loads") == []


def test_answers_must_match_the_texts(spark):
    model = batch_model(spark, lambda path: lambda texts: [0.0], "double")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, text string").coalesce(1)
    with pytest.raises(Exception, match="1 answers to 2 texts"):
        df.select(model(F.col("text"))).collect()
    with pytest.raises(ValueError):
        batch_model(spark, lambda path: list, "double", batch_size=0)
    with pytest.raises(ValueError):
        PrepConfig(model_batch_size=0)
