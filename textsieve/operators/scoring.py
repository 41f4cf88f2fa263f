"""Additive word models: fit by counting, score by a broadcast join.

Weights are whole thousandths of a natural logarithm. Their sums are exact, so a
score does not depend on how rows are split over tasks.

Scoring explodes the words of a row inside its task and sums them per id before
the shuffle: one short row per text moves, the text itself does not.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

MILLI = 1000


def milli_log(ratio: Column) -> Column:
    return F.round(F.log(ratio) * MILLI).cast("bigint")


def sum_weights(
    df: DataFrame,
    id_col: str,
    words: Column,
    model: DataFrame,
    weights: Sequence[str],
    bucket: Callable[[Column], Column] = lambda word: word,
) -> DataFrame:
    """Per id, the sum of each weight column over the buckets of words that the model knows.

    The model is a written table, so its real size decides whether it is broadcast.
    Ids without a known word get sums of zero.
    """
    exploded = df.select(F.col(id_col), F.explode_outer(words).alias("word"))
    exploded = exploded.select(id_col, bucket(F.col("word")).alias("bucket"))
    known = exploded.join(model, "bucket", "left")
    sums = [F.coalesce(F.sum(w), F.lit(0)).alias(w) for w in weights]
    return known.groupBy(id_col).agg(*sums)
