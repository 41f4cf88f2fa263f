"""Line-delimited JSON out: kept rows, omitted rows, shards and the run's insights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from textsieve.operators.ids import shard_numbers
from textsieve.plans.measure import StepMeasure
from textsieve.plans.prepare import kept_rows, omitted_rows
from textsieve.plans.reports import insights
from textsieve.staging import write_staged


def write_cleaned(rows: DataFrame, path: str) -> None:
    kept_rows(rows).write.json(path)


def write_omitted(rows: DataFrame, path: str) -> None:
    """Keys with null values are written."""
    omitted_rows(rows).write.option("ignoreNullFields", "false").json(path)


def shard_assignment(rows: DataFrame, shard_size: int) -> DataFrame:
    return shard_numbers(kept_rows(rows).select("id"), "id", shard_size)


def write_shards(rows: DataFrame, path: str, shard_size: int) -> None:
    """One folder with one file per shard of kept rows, in id order. No empty shards.

    A row goes to the task of its shard's number, so that a shard is whole in one
    task and each task writes one shard; all but the last have the same size.
    """
    shards = write_staged(shard_assignment(rows, shard_size), "shards")
    n = (shards.agg(F.max("shard")).first()[0] or 0) + 1
    sharded = kept_rows(rows).join(shards, "id")
    placed = sharded.repartitionById(n, F.col("shard").cast("int")).sortWithinPartitions("shard", "id")
    placed.write.partitionBy("shard").json(path)


def write_insights(
    rows: DataFrame,
    path: str,
    seconds: dict[str, float] | None = None,
    measures: Sequence[StepMeasure] | None = None,
) -> None:
    insights(rows, seconds, measures).coalesce(1).write.text(path)


def write_outputs(
    rows: DataFrame,
    folder: str,
    shard_size: int,
    seconds: dict[str, float] | None = None,
    measures: Sequence[StepMeasure] | None = None,
) -> None:
    """All outputs of a run, read from its written rows."""
    write_cleaned(rows, f"{folder}/cleaned")
    write_omitted(rows, f"{folder}/omitted")
    write_shards(rows, f"{folder}/shards", shard_size)
    write_insights(rows, f"{folder}/insights", seconds, measures)
