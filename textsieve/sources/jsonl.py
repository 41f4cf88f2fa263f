"""Line-delimited JSON in: {"text": ..., "url": ...} per line, other keys ignored."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textsieve.operators.ids import assign_ids, first_rows, number_file_rows
from textsieve.operators.steps import as_records
from textsieve.staging import write_staged

_SCHEMA = "array<struct<text: string, url: string>>"
_OPTIONS = {"allowSingleQuotes": "false"}


def first_files(spark: SparkSession, path: str, lines: int) -> list[str]:
    """The first files by name that hold so many lines, or all. The rest is not opened.

    Lines are counted in groups of 1, 2, 4, ... files, each in one job over all its
    files, so that at most about as many files again as are needed are read, and
    the number of jobs grows with the logarithm of that of the files.
    """
    files = sorted(map(unquote, spark.read.text(path).inputFiles()))
    taken, start, size = 0, 0, 1
    while start < len(files):
        group = files[start : start + size]
        counts = spark.read.text(group).groupBy(F.input_file_name().alias("file")).count().collect()
        held = {unquote(row["file"]): row["count"] for row in counts}
        for end, file in enumerate(group, start + 1):
            taken += held.get(file, 0)
            if taken >= lines:
                return files[:end]
        start, size = start + size, 2 * size
    return files


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines with the position the id functions need: file, block and seq."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Add text and url; lines that are not one JSON object vanish.

    The parser stops after the first value of a line. In brackets, anything that
    follows it makes the line malformed or a list of several values.
    """
    objects = lines.filter(F.col(line).rlike(r"^\s*\{"))
    listed = F.from_json(F.concat(F.lit("["), line, F.lit("]")), _SCHEMA, _OPTIONS)
    parsed = objects.withColumn("parsed", listed).filter(F.size("parsed") == 1)
    only = F.get("parsed", F.lit(0))
    return parsed.withColumns({"text": only["text"], "url": only["url"]}).drop("parsed", line)


def nonblank(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def read_jsonl(spark: SparkSession, path: str, input_limit: int = 0) -> DataFrame:
    """Rows ready for a chain, with ids dense from 1 in file and line order.

    A positive limit takes the first raw lines, bad ones included. Bad and blank
    lines take no id.
    """
    if input_limit > 0:
        lines = text_lines(spark, first_files(spark, path, input_limit))
        numbered = number_file_rows(lines, "line_no").filter(F.col("line_no") <= input_limit)
        taken = write_staged(numbered.select("line_no", "value"), "lines")
        rows = parse_lines(taken).filter(nonblank(F.col("text")))
        return as_records(assign_ids(rows, "line_no"), url="url")
    # Positions of the rows that stay; gaps left by dropped lines close up.
    rows = parse_lines(text_lines(spark, path)).filter(nonblank(F.col("text")))
    rows = rows.withColumn("seq", F.monotonically_increasing_id())
    return as_records(number_file_rows(rows, "id"), url="url")


def read_table(df: DataFrame, key: str, text: str, url: str | None = None, input_limit: int = 0) -> DataFrame:
    """Rows ready for a chain from any table with a unique key, which becomes the id."""
    return as_records(first_rows(df, key, input_limit), key, text, url)


def read_outputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Kept and omitted rows as written by write_outputs."""
    kept = "id bigint, cleaned string, anonymized boolean, html_extracted boolean"
    omitted = "id bigint, reason string, lang string, original string"
    return (
        spark.read.schema(kept).json(f"{folder}/cleaned"),
        spark.read.schema(omitted).json(f"{folder}/omitted"),
    )
