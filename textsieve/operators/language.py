"""Stage 7: language label, by a word profile fitted on labelled text or a model of the caller."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from textsieve.operators.scoring import milli_log, sum_weights
from textsieve.staging import write_staged

# Words fall into 16 ** BUCKET_DIGITS buckets by their hash; none is dropped, and the
# number of buckets bounds the model.
BUCKET_DIGITS = 4


@dataclass(frozen=True)
class LanguageProfile:
    """Naive Bayes over hash buckets of words.

    weights has at most 16 ** BUCKET_DIGITS rows: bucket, then one bigint column
    per language, in the order of languages.
    """

    languages: tuple[str, ...]
    priors: tuple[int, ...]
    weights: DataFrame

    @property
    def columns(self) -> list[str]:
        return [f"w{i}" for i in range(len(self.languages))]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1))


def bucket(word: Column) -> Column:
    """The bucket of a word: the first digits of its MD5, so that any SQL engine can check it."""
    return F.left(F.md5(word.cast("binary")), F.lit(BUCKET_DIGITS))


def buckets(text: Column) -> Column:
    """The bucket of each word of a text."""
    return F.transform(words(text), bucket)


def fit_language_profile(df: DataFrame, text: str = "text", lang: str = "lang") -> LanguageProfile:
    labelled = df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = labelled.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("texts"))
    exploded = labelled.select(F.col(lang).alias("lang"), F.explode(words(F.col(text))).alias("word"))
    exploded = exploded.select("lang", bucket(F.col("word")).alias("bucket"))
    counts = write_staged(
        exploded.groupBy("lang", "bucket").agg(F.count(F.lit(1)).alias("n")), "word-counts"
    )

    total = F.sum("texts").over(Window.partitionBy())
    rows = (
        sizes.select("lang", milli_log(F.col("texts") / total).alias("prior"))
        .orderBy("lang")
        .collect()
    )
    if not rows:
        raise ValueError("need labelled texts")
    languages = tuple(row["lang"] for row in rows)

    per_word = [
        F.coalesce(F.sum(F.when(F.col("lang") == code, F.col("n"))), F.lit(0)).alias(f"n{i}")
        for i, code in enumerate(languages)
    ]
    table = counts.groupBy("bucket").agg(*per_word)
    table = write_staged(table, "profile-counts")
    totals = table.agg(
        F.count(F.lit(1)).alias("size"), *(F.sum(f"n{i}").alias(f"n{i}") for i in range(len(languages)))
    ).first()
    weights = table.select(
        "bucket",
        *(
            milli_log((F.col(f"n{i}") + 1) / F.lit(float((totals[f"n{i}"] or 0) + totals["size"]))).alias(f"w{i}")
            for i in range(len(languages))
        ),
    )
    return LanguageProfile(languages, tuple(row["prior"] for row in rows), weights)


def detect_language(
    df: DataFrame, profile: LanguageProfile, id_col: str = "id", text: str = "text"
) -> DataFrame:
    """(id, lang): the best scoring language, the lower code on a tie."""
    sums = sum_weights(df, id_col, words(F.col(text)), profile.weights, profile.columns, bucket)
    scored = [
        F.struct((F.col(w) + prior).alias("score"), F.lit(-i).alias("order"), F.lit(code).alias("lang"))
        for i, (w, prior, code) in enumerate(zip(profile.columns, profile.priors, profile.languages))
    ]
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return sums.select(id_col, best["lang"].alias("lang"))


def language_reason(lang: Column, wanted: str = "en") -> Column:
    return F.when(lang != wanted, "non_english")
