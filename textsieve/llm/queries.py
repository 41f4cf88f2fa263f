"""The operators over their whole tables, and the pipeline, as queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textsieve.llm import bpe, brown, cotrain, decontaminate, langid, lexical, licenses, lines, maintext, minhash, repeats, resample, rules
from textsieve.llm.common import documents


def tokenizer() -> tuple[str, str]:
    """Rank file and pattern of the public byte-level tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, folder))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows, counts = lines.line_dedup(documents(spark, folder).select("doc_id", "text"))
    return rows.select("doc_id", f"{counts}.*", "text")


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(documents(spark, folder))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(documents(spark, folder))


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return cotrain.score_quality(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, folder), length=2)


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(documents(spark, folder))


def op9_brown_lm(spark: SparkSession, folder: str) -> DataFrame:
    return brown.score(documents(spark, folder))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(documents(spark, folder), *tokenizer())


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(lexical.build_index(documents(spark, folder)), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resample(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op13_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return maintext.main_text(spark.read.parquet(f"{folder}/pages.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeated_strings": op1_repeated_strings,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_license_scan": op4_license_scan,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_decontamination": op6_decontamination,
    "op7_minhash": op7_minhash,
    "op8_language_id": op8_language_id,
    "op9_brown_lm": op9_brown_lm,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_lexical_search": op11_lexical_search,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_main_text": op13_main_text,
}
