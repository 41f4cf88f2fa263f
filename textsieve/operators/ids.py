"""Dense numbers in order, without ever sorting the whole input in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from textsieve.staging import write_staged

# monotonically_increasing_id() keeps the partition above these bits, the row below.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def _running_offset(counts: DataFrame, *order: str) -> DataFrame:
    """Rows before each block. One row per block, so a single sorted window is small."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))


# Split offsets of two longs each are broadcast up to this many; beyond, they are shuffled for.
MAX_BROADCAST_SPLITS = 2_000_000


def number_file_rows(df: DataFrame, name: str) -> DataFrame:
    """Number the rows of a file scan 1, 2, 3… in file and line order.

    df must carry file, block and seq columns (see sources.jsonl). It is written
    once, so that splits are fixed from then on, whatever the settings are when
    the result is used. Rows are counted per split of the written table, and each
    gets its split's offset: one short row per split, so no text moves.
    """
    rows = write_staged(df.withColumn("split", F.xxhash64("file", "block")), "file-rows")
    counts = rows.groupBy("file", "block", "split").agg(
        F.count(F.lit(1)).alias("rows"), F.min("seq").alias("first_seq")
    )
    shift = (F.col("before") - F.col("first_seq") + 1).alias("shift")
    splits = write_staged(_running_offset(counts, "file", "block").select("split", shift), "splits")
    n, different = splits.agg(F.count(F.lit(1)), F.count_distinct("split")).first()
    if n != different:
        raise ValueError("two splits have one hash")
    if n <= MAX_BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    return rows.join(splits, "split").withColumn(name, F.col("shift") + F.col("seq")).drop("shift", "split")


def rank_rows(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """All rows with dense ranks from 1 in this order, no two the same.

    Rows are sorted by range over all tasks and written with their position;
    ranks are then the partition's offset plus the position in it.
    """
    ordered = df.orderBy(*order).withColumn("seq", F.monotonically_increasing_id())
    rows = write_staged(ordered, "ordered").withColumn("part", F.shiftright("seq", _ROW_BITS))
    counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    offsets = write_staged(_running_offset(counts, "part").drop("rows"), "offsets")
    position = F.col("seq").bitwiseAND(F.lit(_ROW_MASK))
    return rows.join(offsets, "part").withColumn(name, F.col("before") + position + 1).drop("part", "seq", "before")


def rank_by_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, rank) for a unique key, ranks dense from 1. Only the keys are sorted."""
    return rank_rows(df.select(key), name, key)


def assign_ids(df: DataFrame, key: str, name: str = "id") -> DataFrame:
    """Add dense ids in key order."""
    return df.join(rank_by_key(df, key, name), key)


def first_rows(df: DataFrame, key: str, limit: int) -> DataFrame:
    """The first rows in key order; all of them when the limit is not positive."""
    if limit <= 0:
        return df
    wanted = rank_by_key(df, key, "rank").filter(F.col("rank") <= limit)
    return df.join(wanted.select(key), key, "left_semi")


def shard_numbers(df: DataFrame, key: str, shard_size: int) -> DataFrame:
    """(key, shard): shard i holds rows i*size … (i+1)*size-1 in key order."""
    ranks = rank_by_key(df, key, "rank")
    return ranks.select(key, F.floor((F.col("rank") - 1) / shard_size).alias("shard"))
