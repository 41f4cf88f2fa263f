"""Pretrained models in the slots of stages 7-9: shipped to the workers, loaded once in each.

A model is a function that opens it from a folder or file (the loader), and what
that gives: a function from a list of texts to as many answers. The file is
shipped with the job and lies beside every executor; a worker process loads it
when its first batch comes and keeps it from task to task. Null texts, which is
what the steps hand in for rows that are already omitted, never reach it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, SparkSession, functions as F
from pyspark.sql.types import DataType

from textsieve.config import MODEL_BATCH_SIZE

Predict = Callable[[list[str]], Sequence[object]]
Loader = Callable[[str | None], Predict]

#: Models of this worker process, by slot. A worker serves one job at a time.
_loaded: dict[str, Predict] = {}


def model_in_worker(key: str, load: Callable[[], Predict]) -> Predict:
    """The slot's model, loaded when it is first asked for."""
    if key not in _loaded:
        _loaded[key] = load()
    return _loaded[key]


def batch_model(
    spark: SparkSession,
    load: Loader,
    type_: DataType | str,
    file: str | None = None,
    batch_size: int = MODEL_BATCH_SIZE,
) -> Callable[[Column], Column]:
    """A function for a model slot, from a text Column to the model's answers; null for null.

    load gets the path of the shipped file on its own machine, or None without
    one. A file is a path that the driver can read, or a URI that Spark can
    fetch; a folder is shipped whole. type_ is the answers' type: string for a
    language, double for a toxicity, array<struct<entity, start, end>> for spans.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    key, name = uuid.uuid4().hex, None
    if file is not None:
        spark.sparkContext.addFile(file, recursive=True)
        name = file.rstrip("/").rsplit("/", 1)[-1]

    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch[batch.notna()]
            found = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            if len(texts):
                predict = model_in_worker(key, lambda: load(None if name is None else SparkFiles.get(name)))
                for start in range(0, len(texts), batch_size):
                    part = texts.iloc[start : start + batch_size]
                    given = list(predict(part.tolist()))
                    if len(given) != len(part):
                        raise ValueError(f"{len(given)} answers to {len(part)} texts")
                    for index, answer in zip(part.index, given):
                        found.at[index] = answer
            yield found

    # The types are given by hand because annotations are text in this module.
    answers.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    # Marked so that its answers are worked out once, however many expressions use them.
    return F.pandas_udf(answers, type_).asNondeterministic()
