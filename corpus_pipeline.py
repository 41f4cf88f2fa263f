"""Documents to tokens: quality rules, line dedup, near dedup, decontamination, BPE.

Each stage works on all that the one before it left. All but the last return the
columns of documents. SQL cannot express near duplicates, edits or tokens, so the
pipeline as a whole has no SQL; its tests compare each stage with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from textsieve.llm import bpe, decontaminate, lines, minhash, rules
from textsieve.llm.common import documents
from textsieve.llm.queries import tokenizer
from textsieve.staging import write_staged


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the rules keep, without the lines that too many documents of their source hold."""
    rows = rules.keep_good(docs)
    return rows.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without later copies of repeated line runs; one of which nothing is left goes."""
    rows, _ = lines.line_dedup(docs)
    rows = rows.filter(F.col("text").rlike(rules.WORD))
    return rows.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates."""
    return minhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each document, and the text they decode to."""
    return bpe.encode(docs, *tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    for name, stage in STAGES:
        docs = write_staged(stage(spark, docs, folder), name)
    return docs
