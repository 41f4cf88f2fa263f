"""What the operators of this package share: their columns, and batches of whole texts inside a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A task holds so many rows, and about so many bytes of text, as Python objects at a time.
SLICE = 256
SLICE_BYTES = 2 << 20


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def id_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only doc_id and text, whatever else docs holds."""
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))


def id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def unused(docs: DataFrame, name: str) -> str:
    """name, with as many underscores before it as docs needs to lack it."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without(docs: DataFrame, ids: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Rows of docs whose id is not in ids (doc_id); a null id is like any other."""
    of = unused(docs, "of")
    keys = ids.select(F.col("doc_id").alias(of)).distinct()
    return docs.join(keys, F.col(id_column).eqNullSafe(F.col(of)), "left_anti")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows, a few at a time; a long text comes whole, with few others."""
    for batch in batches:
        if "text" in batch.schema.names:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        else:
            sizes = [0] * batch.num_rows
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and (i - start >= rows or held + size > SLICE_BYTES):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


def by_slice(function: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """For mapInArrow: function is applied to a few rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield function(batch)

    return run


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_crc_remainder(id_column: Column, divisor: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id counts as the text 'null'."""
    text = F.coalesce(id_column.cast("string"), F.lit("null"))
    return F.crc32(text) % divisor == remainder
