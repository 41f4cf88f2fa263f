"""Tables written between steps, to cut lineage and to give Catalyst real sizes.

A written table survives lost executors, is column-pruned on every later read,
and carries its size, so that Catalyst chooses by itself between broadcasting a
narrow table and shuffling for it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

_local_dirs: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Shared folder named by spark.checkpoint.dir; a temporary one only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="textsieve-")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/textsieve/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write df as parquet in the work folder and return a scan of it."""
    return write_table(df, new_path(df.sparkSession, name), partition_by)


def write_scratch(df: DataFrame, name: str, scratch: list[str] | None) -> DataFrame:
    """write_staged; the path is noted in scratch, for a caller that deletes it when nothing reads it any more."""
    path = new_path(df.sparkSession, name)
    if scratch is not None:
        scratch.append(path)
    return write_table(df, path)


def write_texts(df: DataFrame, path: str) -> DataFrame:
    """write_table for rows of a chain: a text that no step has changed is stored once, not as cleaned again."""
    same = F.col("cleaned").eqNullSafe(F.col("original"))
    stored = df.withColumn("_same", same).withColumn("cleaned", F.when(~F.col("_same"), F.col("cleaned")))
    rows = write_table(stored, path)
    return rows.withColumn("cleaned", F.when(F.col("_same"), F.col("original")).otherwise(F.col("cleaned"))).drop("_same")


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """write_staged to a path that the caller knows, and may delete when nothing reads it any more."""
    spark = df.sparkSession
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

