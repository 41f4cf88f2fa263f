"""Tables over the rows of a run: what was omitted, where, and what the kept text looks like.

rows is the result of prepare. Every table aggregates before it shuffles and has
at most one row per reason, stage, series or bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textsieve.config import STAGES
from textsieve.functions.pii import ENTITIES, PRONOUN_TOKENS, token
from textsieve.plans.measure import StepMeasure

BIN_WIDTH = 10


def omit_reason_counts(rows: DataFrame) -> DataFrame:
    omitted = rows.filter(F.col("omit_reason").isNotNull())
    return omitted.groupBy("omit_reason").agg(F.count(F.lit(1)).alias("n"))


def omit_reason_share(rows: DataFrame) -> DataFrame:
    """Share of each reason in all omitted rows, in percent, largest first."""
    counts = omit_reason_counts(rows)
    share = F.col("n") / F.sum("n").over(Window.partitionBy()) * 100
    return counts.withColumn("percent", share).orderBy(F.desc("n"), "omit_reason")


def stage_funnel(rows: DataFrame) -> DataFrame:
    """Per stage: rows that reached it, rows it omitted, and their percentage."""
    last = len(STAGES) + 1
    names = list(enumerate([*STAGES, "kept"], 1))
    stages = rows.sparkSession.createDataFrame(names, "stage int, name string")
    counts = rows.groupBy(F.coalesce("omit_stage", F.lit(last)).alias("stage")).agg(
        F.count(F.lit(1)).alias("n")
    )
    omits = F.coalesce(F.col("n"), F.lit(0))
    # Ten rows, so the single-task window is a constant cost.
    onward = Window.orderBy("stage").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    funnel = (
        stages.join(counts, "stage", "left")
        .select("stage", "name", F.sum(omits).over(onward).alias("rows_in"), omits.alias("omits"))
        .filter(F.col("stage") < last)
    )
    percent = F.when(F.col("rows_in") > 0, F.col("omits") * 100.0 / F.col("rows_in")).otherwise(0.0)
    return funnel.withColumn("omit_percent", percent)


def route_counts(rows: DataFrame) -> DataFrame:
    route = F.when(F.col("omit_reason").isNull(), "kept").otherwise("omitted")
    return rows.groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("n"))


def selection_rate(rows: DataFrame) -> DataFrame:
    return rows.agg(F.avg(F.col("omit_reason").isNull().cast("double")).alias("selection_rate"))


def length_series(rows: DataFrame) -> DataFrame:
    """One row per text and series: original of all, cleaned of kept, original of omitted rows."""
    kept = F.col("omit_reason").isNull()
    original = F.length("original")
    series = F.array(
        F.struct(F.lit("original").alias("series"), original.alias("length")),
        F.when(kept, F.struct(F.lit("cleaned").alias("series"), F.length("cleaned").alias("length"))),
        F.when(~kept, F.struct(F.lit("omitted").alias("series"), original.alias("length"))),
    )
    found = rows.select("id", F.explode(series).alias("s")).filter(F.col("s").isNotNull())
    return found.select("id", "s.series", "s.length")


def length_histogram(rows: DataFrame, width: int = BIN_WIDTH) -> DataFrame:
    """Non-empty bins of original and cleaned lengths: start, count and density.

    Bins start at the shortest length; the last one is closed on the right.
    """
    counts = (
        length_series(rows)
        .filter(F.col("series").isin("original", "cleaned"))
        .groupBy("series", "length")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most one row per length and series from here on.
    bounds = counts.groupBy("series").agg(
        F.min("length").alias("low"), F.max("length").alias("high"), F.sum("n").alias("total")
    )
    last = F.greatest(F.ceil((F.col("high") - F.col("low")) / width) - 1, F.lit(0))
    number = F.least(F.floor((F.col("length") - F.col("low")) / width), last)
    bins = counts.join(F.broadcast(bounds), "series").withColumn("bin", number)
    return bins.groupBy("series", "bin").agg(
        (F.first("low") + F.col("bin") * width).alias("start"),
        F.sum("n").alias("n"),
        (F.sum("n") / (F.first("total") * width)).alias("density"),
    )


def kept_flag_shares(rows: DataFrame) -> DataFrame:
    kept = rows.filter(F.col("omit_reason").isNull())
    return kept.agg(
        F.count(F.lit(1)).alias("kept"),
        (F.avg(F.col("html_extracted").cast("double")) * 100).alias("html_extracted_percent"),
        (F.avg(F.col("anonymized").cast("double")) * 100).alias("anonymized_percent"),
    )


def redaction_counts(rows: DataFrame) -> DataFrame:
    """(kind, n): masks per entity, and pronoun masks, in anonymized kept rows."""
    kept = rows.filter(F.col("omit_reason").isNull() & F.col("anonymized"))
    kinds = {entity: token(entity) for entity in ENTITIES} | {"PRONOUN": "|".join(PRONOUN_TOKENS)}
    sums = kept.agg(
        *(
            F.coalesce(F.sum(F.regexp_count("cleaned", F.lit(pattern))), F.lit(0)).alias(kind)
            for kind, pattern in kinds.items()
        )
    )
    return sums.unpivot([], list(kinds), "kind", "n")


def part_timing(rows: DataFrame, seconds: dict[str, float]) -> DataFrame:
    """Wall seconds of each written part of a run, and seconds per row."""
    total = rows.count()
    table = rows.sparkSession.createDataFrame(list(seconds.items()), "part string, seconds double")
    per_row = F.col("seconds") / total if total else F.lit(0.0)
    return table.select("part", "seconds", F.lit(total).alias("rows"), per_row.alias("seconds_per_row"))


def stage_timing(spark: SparkSession, measures: Sequence[StepMeasure]) -> DataFrame:
    """Per step of a measured run: rows in, omits, wall seconds, and seconds per row."""
    schema = "stage int, name string, rows_in bigint, omits bigint, seconds double"
    table = spark.createDataFrame([(m.stage, m.name, m.rows_in, m.omits, m.seconds) for m in measures], schema)
    per_row = F.when(F.col("rows_in") > 0, F.col("seconds") / F.col("rows_in")).otherwise(0.0)
    return table.withColumn("seconds_per_row", per_row)


def insights(
    rows: DataFrame, seconds: dict[str, float] | None = None, measures: Sequence[StepMeasure] | None = None
) -> DataFrame:
    """One row, one JSON document: omit_reasons, steps and, if given, seconds per written part.

    With the measures of a measured run, each step also has its time, in all and per call.
    """
    pairs = F.array_sort(F.collect_list(F.struct("omit_reason", "n")))
    reasons = omit_reason_counts(rows).agg(F.map_from_entries(pairs))
    fields = [
        F.col("rows_in").alias("number_of_calls"),
        F.col("omits").alias("number_of_omits"),
        F.col("omit_percent").alias("omit_percentage"),
    ]
    funnel = stage_funnel(rows)
    if measures:
        timing = stage_timing(rows.sparkSession, measures).select("stage", "seconds", "seconds_per_row")
        funnel = funnel.join(F.broadcast(timing), "stage")  # nine rows
        fields += [
            F.col("seconds").alias("total_time_seconds"),
            F.col("seconds_per_row").alias("average_time_per_call_seconds"),
        ]
    ordered = F.array_sort(F.collect_list(F.struct("stage", "name", F.struct(*fields).alias("step"))))
    entries = F.transform(ordered, lambda e: F.struct(e["name"], e["step"]))
    steps = funnel.agg(F.map_from_entries(entries))
    parts = [reasons.scalar().alias("omit_reasons"), steps.scalar().alias("steps")]
    if seconds:
        timed = [column for part, value in seconds.items() for column in (F.lit(part), F.lit(value))]
        parts.append(F.create_map(*timed).alias("seconds"))
    one_row = rows.sparkSession.range(1)
    return one_row.select(F.to_json(F.struct(*parts)).alias("insights"))
