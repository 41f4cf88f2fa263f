"""The nine steps one after the other, each timed, with its rows counted while it is written.

prepare runs steps 1-5 in one pass, where their times cannot be told apart. Here
each step's result is written before the next one starts: more is written, and
what is measured is the step. The counts are observed in that same write, so
nothing is read again for them. A step reads what the step before it wrote and
nothing older, so that goes as soon as the step is through: no more than two
results are on disk at a time, however many steps there are. In them a text
that is as it came is stored once.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from textsieve.config import ENGLISH, PrepConfig, STAGES
from textsieve.operators.steps import (
    Step,
    alive,
    attributes_step,
    code_step,
    dedup_step,
    html_step,
    language_step,
    normalize_step,
    pii_step,
    preliminary_step,
    toxicity_step,
)
from textsieve.plans.prepare import Models
from textsieve.staging import delete, new_path, write_texts

# The step after which the tokens of stage 2 are not read any more.
LAST_OF_TOKENS = "code"


@dataclass(frozen=True)
class StepMeasure:
    """Live rows that a step received and omitted, and its wall seconds."""

    stage: int
    name: str
    rows_in: int
    omits: int
    seconds: float


def default_steps(
    config: PrepConfig = PrepConfig(),
    models: Models = Models(),
    written: bool = False,
    scratch: list[str] | None = None,
) -> list[Step]:
    """The nine steps in chain order; written and scratch as in dedup_step."""
    return [
        normalize_step(),
        attributes_step(),
        preliminary_step(config),
        html_step(config),
        code_step(),
        dedup_step(written, scratch),
        language_step(models.language if config.require_english else None, ENGLISH, written, scratch),
        toxicity_step(models.toxicity, config.toxicity_threshold, written, scratch),
        pii_step(models.entities, models.gazetteer, written),
    ]


def _counts(number: int) -> list[Column]:
    """Rows that reached this step alive, and those that it omitted."""
    omitted = F.col("omit_stage") == number
    return [
        F.count(F.when(alive() | omitted, 1)).alias("rows_in"),
        F.count(F.when(omitted, 1)).alias("omits"),
    ]


def measured_run(
    records: DataFrame, config: PrepConfig = PrepConfig(), models: Models = Models()
) -> tuple[DataFrame, list[StepMeasure]]:
    """The rows that prepare returns, and the measures of each step."""
    spark = records.sparkSession
    last = new_path(spark, "records")
    rows, measures = write_texts(records, last), []
    scratch: list[str] = []
    steps = default_steps(config, models, True, scratch)
    for number, (name, step) in enumerate(zip(STAGES, steps), 1):
        observed, path = Observation(f"step-{number}"), new_path(spark, f"step-{number}")
        start = time.perf_counter()
        done = step(rows, number)
        if name == LAST_OF_TOKENS:
            done = done.drop("tokens")
        rows = write_texts(done.observe(observed, *_counts(number)), path)
        seconds = time.perf_counter() - start
        found = observed.get
        measures.append(StepMeasure(number, name, found["rows_in"], found["omits"], seconds))
        for done_with in (last, *scratch):
            delete(spark, done_with)
        scratch.clear()
        last = path
    return rows.withColumn("kept", alive()), measures
