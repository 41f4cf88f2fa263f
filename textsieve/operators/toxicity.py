"""Stage 8: toxicity score, by word log-odds fitted on labels or a model of the caller."""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, Row, functions as F

from textsieve.functions.attributes import tokenize
from textsieve.operators.scoring import MILLI, milli_log, sum_weights
from textsieve.staging import write_staged

# Fixed values of the fit: pseudo-count, and the least chi-square of a word that is kept.
SMOOTHING = 5.0
LEAST_EVIDENCE = 30.0


@dataclass(frozen=True)
class ToxicityModel:
    """Thousandths of a natural logarithm: the prior, and a table (word, w) of the weight of
    each word with enough evidence. The table may have any size; it never leaves the executors."""

    prior: int
    weights: DataFrame


def score_toxicity(df: DataFrame, model: ToxicityModel, id_col: str = "id", text: str = "text") -> DataFrame:
    """(id, toxicity): score in [0, 1], each different word of a text counted once; null for a null text.

    The weights meet the texts' words by equality, so their size decides between
    broadcast and shuffle. No text moves: words are given out inside the task and
    summed per id.
    """
    weights = model.weights.select(F.col("word").alias("bucket"), "w")
    present = df.filter(F.col(text).isNotNull())
    sums = sum_weights(present, id_col, F.array_distinct(tokenize(F.col(text))), weights, ["w"])
    logit = (F.col("w") + model.prior) / F.lit(float(MILLI))
    scored = sums.select(id_col, (1 / (1 + F.exp(-logit))).alias("toxicity"))
    missing = df.filter(F.col(text).isNull()).select(id_col, F.lit(None).cast("double").alias("toxicity"))
    return scored.unionByName(missing)


def _class_sizes(texts: DataFrame, toxic: str) -> Row:
    bad = F.when(F.col(toxic) == 1, 1.0).otherwise(0.0)
    return texts.agg(F.sum(bad).alias("bad"), F.sum(1.0 - bad).alias("good")).first()


def toxicity_weights(
    labelled: DataFrame, text: str = "text", toxic: str = "toxic"
) -> tuple[int, DataFrame]:
    """The prior and a table (word, w): log-odds of a word's presence in toxic against other texts.

    Weights are shrunk to zero for rare words. The words kept are those with
    enough evidence by chi-square, however many they are: texts are long against
    the number of labels, and words with less would mostly add chance.
    """
    texts = labelled.filter(F.col(text).isNotNull() & F.col(toxic).isNotNull())
    sizes = _class_sizes(texts, toxic)
    bad, good = sizes["bad"] or 0.0, sizes["good"] or 0.0
    if not (bad and good):
        raise ValueError("need texts of both classes")
    share = bad / (bad + good)

    counts = (
        texts.select(
            F.when(F.col(toxic) == 1, 1).otherwise(0).alias("bad"),
            F.explode(F.array_distinct(tokenize(F.col(text)))).alias("word"),
        )
        .groupBy("word")
        .agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("all"))
    )
    in_bad = (F.col("bad") + SMOOTHING * share) / bad
    in_good = (F.col("all") - F.col("bad") + SMOOTHING * (1 - share)) / good
    expected = F.col("all") * share
    surprise = (F.col("bad") - expected) * (F.col("bad") - expected) / (expected * (1 - share))
    weights = (
        counts.select(
            "word",
            milli_log(in_bad / in_good).alias("w"),
            F.round(surprise * MILLI).cast("bigint").alias("evidence"),
        )
        .filter(F.col("evidence") >= LEAST_EVIDENCE * MILLI)
        .select("word", "w")
    )
    return round(log(bad / good) * MILLI), weights


def fit_toxicity(labelled: DataFrame, text: str = "text", toxic: str = "toxic") -> ToxicityModel:
    """The weights are written, so that their real size is known wherever they are used."""
    prior, weights = toxicity_weights(labelled, text, toxic)
    return ToxicityModel(prior, write_staged(weights, "toxicity-weights"))


def toxicity_reason(score: Column, threshold: float) -> Column:
    """Strictly above the threshold."""
    return F.when(score > threshold, "toxic_content")
