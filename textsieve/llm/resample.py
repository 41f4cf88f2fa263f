"""Importance resampling of documents towards a target distribution, with hashed n-grams.

The texts of a batch are joined with a separator that no word can hold. One
regular expression pass finds all words of the batch; a binary search of their
places among the documents' offsets says whose each is, which masks the n-grams
that would reach into the next document. Buckets are counted by bincount per
task and summed. The gain of a bucket is the logarithm of its smoothed share in
the target over that in the corpus; a document's weight is the sum over its
features. Adding noise of a Gumbel distribution, drawn from the id alone, and
taking the highest scores is a sample without replacement by these weights.

The text is read once: each document's buckets are written, two or four bytes a
feature, and used for the counts and for the weights. The table of gains has one
number per bucket, which bounds it. The drawn rows are numbered over a sort by
range of narrow rows; no task holds them all.

Results, row by row: null or empty text has no features and weighs 0. A null id
draws its noise from the text "null". Rows that repeat an id have the same noise
and are scored and drawn each for itself; of equal scores the smaller id comes
first, a null id last. An empty table of documents gives an empty result; with
no target the gains say how rare a bucket is in the corpus. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textsieve.llm.common import id_text, id_type, slices
from textsieve.operators.ids import rank_rows
from textsieve.staging import write_staged

#: Words of a text whose letters A-Z are lower-cased, over UTF-8 bytes.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATOR = b"\x00"  # never part of a word
MOST_BUCKETS = 1 << 22

_matches = re.compile(WORD.encode()).finditer


def batch_features(texts: list[bytes], length: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; and the buckets of all features by text, with the number of them in each.

    Features are all runs of 1 to length consecutive words, joined by one space.
    """
    offsets = np.cumsum([0] + [len(text) + len(SEPARATOR) for text in texts])
    matches = list(_matches(SEPARATOR.join(texts).lower()))
    words = list(map(re.Match.group, matches))
    places = np.fromiter(map(re.Match.start, matches), np.int64, len(matches))
    owner = np.searchsorted(offsets, places, "right") - 1
    owners, hashes = [owner], [np.fromiter(map(crc32, words), np.int64, len(words))]
    for n in range(2, length + 1):
        if len(words) < n:
            break
        inside = owner[n - 1 :] == owner[: len(owner) - n + 1]
        grams = map(b" ".join, zip(*(words[i : len(words) - n + 1 + i] for i in range(n))))
        owners.append(owner[: len(inside)][inside])
        hashes.append(np.fromiter(map(crc32, grams), np.int64, len(inside))[inside])
    whose, hashed = np.concatenate(owners), np.concatenate(hashes) % buckets
    if length > 1:
        by_text = np.argsort(whose, kind="stable")
        whose, hashed = whose[by_text], hashed[by_text]
    return np.bincount(owner, minlength=len(texts)), hashed, np.bincount(whose, minlength=len(texts))


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def features(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """doc_id, n_words, n_features and the packed buckets of every row of doc_id and text."""
    kind = np.dtype(_kind(buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]
            n_words, hashed, sizes = batch_features(texts, length, buckets)
            ends = np.concatenate(([0], np.cumsum(sizes))) * kind.itemsize
            data = hashed.astype(kind).tobytes()
            packed = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(data)])
            arrays = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(sizes, pa.int64()), packed]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_features", "buckets"])

    return docs.mapInArrow(run, f"doc_id {id_type(docs)}, n_words bigint, n_features bigint, buckets binary")


def bucket_counts(made: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all rows are in each bucket."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("buckets").to_pylist()), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    for bucket, n in made.select("buckets").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the corpus."""
    s, t, buckets = corpus.astype(np.float64), target.astype(np.float64), len(corpus)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(made: DataFrame, gain: np.ndarray) -> DataFrame:
    """made with the sum of gains over each row's features in place of its buckets."""
    kind = np.dtype(_kind(len(gain)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("buckets").to_pylist()
            ends = np.cumsum([0] + [len(p) for p in packed]) // kind.itemsize
            sums = np.concatenate(([0], np.cumsum(gain[np.frombuffer(b"".join(packed), kind)])))
            arrays = [batch.column(name) for name in ("doc_id", "n_words", "n_features")]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.diff(sums[ends]), pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in made.drop("buckets").schema)
    return made.mapInArrow(run, f"{schema}, weight bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    length: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """Every document's doc_id, n_features, weight, score, and its rank if it is drawn.

    docs have doc_id and text, target has text. percent of the documents with
    least_words words or more are drawn.
    """
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be 1 to {MOST_BUCKETS}")
    made = write_staged(features(id_text(docs), length, buckets), "features")
    wanted = features(target.select(F.lit(0).alias("doc_id"), "text"), length, buckets)
    weighed = weights(made, gains(bucket_counts(made, buckets), bucket_counts(wanted, buckets)))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)
    chance = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(F.log(-F.log(chance)) * -1000)
    scored = write_staged(weighed.withColumn("score", F.col("weight") + noise), "scored")
    able = F.col("n_words") >= least_words
    drawn = percent * scored.filter(able).count() // 100
    ranked = rank_rows(scored.filter(able), "rank", F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(~able).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
