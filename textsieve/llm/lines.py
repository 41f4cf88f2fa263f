"""Line dedup: later copies of repeated line runs are deleted.

The sequence of a text's lines with a word is a sequence of line ids. By prefix
doubling each place gets the rank of the run of 1, 2, 4, ... lines that starts
there, each from two ranks of half the length; a last step with overlap gives
the rank of runs of exactly `min_lines`. Ranks are 128-bit fingerprints, so that
equal runs have equal ranks everywhere without numbering them in one place, and
places of equal rank form the intervals of the suffix array whose longest common
prefix is at least that many lines. A maximal repeated run is the union of such
runs. Of each interval the first place (by doc_id, then by line) keeps its
lines, all later ones lose them. A single line of many words counts as a run by
itself.

Results: null text counts as empty (no lines) and stays null. Lines without a
word are no part of a run and stay. Rows that repeat a doc_id count as one
document, the same lines are deleted from each. A null doc_id comes before all
others. An empty table gives an empty result. Other columns are kept as they
are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textsieve.llm.common import unused
from textsieve.staging import write_staged

MIN_LINES = 3
#: A line of so many words is a run by itself.
LONG_LINE = 20
WORD = r"[^\x20\x09-\x0D]+"


def lines_of(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.split(text, "\n", -1)).otherwise(F.array().cast("array<string>"))


def doubled(ranks: Column, step: int) -> Column:
    """Ranks of runs made of two runs, the second starting so many places later."""
    return F.when(
        F.size(ranks) > step,
        F.transform(
            F.sequence(F.lit(0), F.size(ranks) - 1 - step),
            lambda i: F.struct(
                F.xxhash64(F.get(ranks, i)["a"], F.get(ranks, i + step)["a"]).alias("a"),
                F.xxhash64(F.get(ranks, i + step)["b"], F.get(ranks, i)["b"]).alias("b"),
            ),
        ),
    ).otherwise(F.slice(ranks, 1, 0))


def ranked_runs(docs: DataFrame, id_column: str, text_column: str, min_lines: int, long_line: int) -> DataFrame:
    """id, first and last line, and rank of each run that counts."""
    rows = docs.select(F.col(id_column).alias("id"), lines_of(F.col(text_column)).alias("lines"))
    worded = F.filter(
        F.transform("lines", lambda x, i: F.struct(F.regexp_count(x, F.lit(WORD)).alias("n"), i.alias("i"), x.alias("x"))),
        lambda x: x["n"] > 0,
    )
    rows = rows.select("id", worded.alias("w")).select(
        "id",
        F.transform("w", lambda x: x["i"]).alias("at"),
        F.transform("w", lambda x: x["n"]).alias("n"),
        F.transform("w", lambda x: F.struct(F.xxhash64(x["x"]).alias("a"), F.xxhash64(F.lit(1), x["x"]).alias("b"))).alias("r1"),
    )
    length = 1
    while length < min_lines:
        step = min(length, min_lines - length)
        rows = rows.withColumn(f"r{length + step}", doubled(F.col(f"r{length}"), step))
        length += step

    def run(ranks: str, lines: int) -> Column:
        return F.transform(
            ranks,
            lambda r, k: F.struct(
                F.get("at", k).alias("first"), F.get("at", k + (lines - 1)).alias("last"), F.lit(lines).alias("lines"), r["a"].alias("a"), r["b"].alias("b")
            ),
        )

    singles = F.filter(run("r1", 1), lambda x, k: (F.get("n", k) >= long_line) | F.lit(min_lines == 1))
    runs = singles if min_lines == 1 else F.concat(singles, run(f"r{min_lines}", min_lines))
    return rows.select("id", F.explode(runs).alias("r")).select("id", "r.*")


def deleted_lines(docs: DataFrame, id_column: str, text_column: str, min_lines: int, long_line: int) -> DataFrame:
    """id and the numbers of the lines to delete, repeated where runs overlap."""
    runs = write_staged(ranked_runs(docs, id_column, text_column, min_lines, long_line), "runs")
    place = F.struct("id", "first")
    intervals = runs.groupBy("lines", "a", "b").agg(F.count("*").alias("n"), F.min(place).alias("keeps")).filter("n > 1")
    intervals = write_staged(intervals.drop("n"), "intervals")
    later = runs.join(intervals, ["lines", "a", "b"]).filter(~place.eqNullSafe(F.col("keeps")))
    # The lines of a run, with those without a word between them left out later.
    return later.groupBy("id").agg(F.collect_set(F.struct("first", "last")).alias("runs"))


def line_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_lines: int = MIN_LINES, long_line: int = LONG_LINE
) -> tuple[DataFrame, str]:
    """docs with the remaining text, and a struct of n_lines and n_removed; its name."""
    deleted = deleted_lines(docs, id_column, text_column, min_lines, long_line)
    of, runs, split, covered, counts = (unused(docs, name) for name in ("of", "runs", "split", "covered", "line_counts"))
    deleted = deleted.withColumnsRenamed({"id": of, "runs": runs})
    joined = docs.join(deleted, F.col(id_column).eqNullSafe(F.col(of)), "left").withColumn(split, lines_of(F.col(text_column)))
    gone = F.array_distinct(F.flatten(F.transform(runs, lambda r: F.sequence(r["first"], r["last"]))))
    gone = F.filter(gone, lambda i: F.coalesce(F.get(split, i).rlike(WORD), F.lit(False)))
    joined = joined.withColumn(covered, F.coalesce(gone, F.array().cast("array<int>")))
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(covered))
    text = F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    sizes = F.struct(F.size(split).cast("bigint").alias("n_lines"), F.size(covered).cast("bigint").alias("n_removed"))
    joined = joined.withColumn(text_column, F.when(F.size(covered) > 0, text).otherwise(F.col(text_column))).withColumn(counts, sizes)
    return joined.select(*docs.columns, counts), counts
