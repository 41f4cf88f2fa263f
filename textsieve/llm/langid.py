"""Language identification by rank-order profiles of letter n-grams.

A profile is the most frequent n-grams (one to three symbols: letters in lower
case, and one blank for whatever stands between words) in order of frequency. A
text goes to the language whose profile has the least out-of-place distance from
the text's own.

Results, row by row: null text and text without a letter give 'und' and score 0.
Rows of null language are not learned from. If nothing was learned every text
gives 'und'. Nothing but the split of learning and held-out rows depends on
doc_id; a null id counts as the text 'null'. Repeated rows are repeated in the
result. Equal distances go to the first language by name, equal frequencies to
the smaller n-gram code. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from textsieve.llm.common import by_slice, is_crc_remainder, slices

PROFILE = 300
#: Symbols are folded to so many bits; 0 is no symbol, 1 the blank.
BITS = 10
BLOCK = 1 << 20

_letters: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """A code for each letter, one blank for each run of anything else, and at both ends."""
    if not _letters:
        table = np.zeros(0x110000, bool)
        table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        _letters.append(table)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters[0][points]
    codes = np.where(letter, points % ((1 << BITS) - 2) + 2, 1).astype(np.uint16)
    codes = np.concatenate(([1], codes, [1])).astype(np.uint16)
    return codes[np.concatenate(([True], (codes[1:] != 1) | (codes[:-1] != 1)))]


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """n-gram codes of all texts together, with how often each occurs."""
    grams, counts = np.empty(0, np.uint32), np.empty(0, np.int64)
    pending: list[np.ndarray] = []
    size = 0

    def merge() -> tuple[np.ndarray, np.ndarray]:
        new, n = np.unique(np.concatenate(pending), return_counts=True)
        if not len(grams):
            return new, n
        both, at = np.unique(np.concatenate((grams, new)), return_inverse=True)
        return both, np.bincount(at, np.concatenate((counts, n))).astype(np.int64)

    for text in texts:
        codes = symbols(text)
        for start in range(0, len(codes), BLOCK):
            one = codes[start : start + BLOCK + 2].astype(np.uint32)
            two = one[:-1] << BITS | one[1:]
            three = two[:-1] << BITS | one[2:]
            firsts = min(BLOCK, len(one))
            pending += [one[:firsts][one[:firsts] != 1], two[:firsts], three[:firsts]]
            size += firsts
            if size >= BLOCK:
                grams, counts = merge()
                pending, size = [], 0
    if pending:
        grams, counts = merge()
    return grams, counts


def ranked(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams, in order."""
    keys = counts.astype(np.uint64) << np.uint64(32) | (np.uint64(0xFFFFFFFF) - grams.astype(np.uint64))
    if len(keys) > PROFILE:
        keys = np.partition(keys, len(keys) - PROFILE)[-PROFILE:]
    return (np.uint64(0xFFFFFFFF) - (np.sort(keys)[::-1] & np.uint64(0xFFFFFFFF))).astype(np.uint32)


def learn_profiles(docs: DataFrame) -> dict[str, list[int]]:
    """Profile of each language in docs (text, lang); counts cover all of its texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            texts: dict[str, list[str]] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, of_lang in texts.items():
                grams, n = gram_counts(of_lang)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n, pa.int64())], ["lang", "gram", "n"]
                )

    rows = docs.filter("text is not null and lang is not null").select("text", F.col("lang").cast("string"))
    counts = rows.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= PROFILE)
    # At most PROFILE rows for each language.
    profiles: dict[str, list[tuple[int, int]]] = {}
    for row in top.select("lang", "rank", "gram").collect():
        profiles.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
    return {lang: [gram for _, gram in sorted(found)] for lang, found in sorted(profiles.items())}


class Profiles:
    def __init__(self, profiles: dict[str, list[int]]):
        self.names = list(profiles)
        self.sorted = []
        for grams in profiles.values():
            values = np.array(grams, np.uint32)
            order = np.argsort(values)
            self.sorted.append((values[order], order))

    def distances(self, own: np.ndarray) -> list[int]:
        """Out-of-place distance of a ranked text from each profile."""
        found = []
        for values, ranks in self.sorted:
            at = np.minimum(np.searchsorted(values, own), len(values) - 1)
            steps = np.abs(ranks[at] - np.arange(len(own)))
            found.append(int(np.where(values[at] == own, np.minimum(steps, PROFILE), PROFILE).sum()))
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = symbols(text or "")
        if not self.names or (codes == 1).all():
            return "und", 0.0
        own = ranked(*gram_counts([text]))
        distances = self.distances(own)
        best = int(np.argmin(distances))
        return self.names[best], 1 - distances[best] / (PROFILE * len(own))


def predict(docs: DataFrame, profiles: dict[str, list[int]], *carry: str) -> DataFrame:
    """lang_pred and score of docs' text, and the columns to carry."""
    narrow = docs.select(*carry, "text")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = Profiles(profiles)
        found = [model.predict(text) for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                *[batch.column(c) for c in carry],
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ],
            [*carry, "lang_pred", "score"],
        )

    kept = ", ".join(f"{c} {narrow.schema[c].dataType.simpleString()}" for c in carry)
    return narrow.mapInArrow(by_slice(make), f"{kept}, lang_pred string, score double")


def identify(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """Learn from four fifths of the labelled rows and predict all rows."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang"))
    rows = rows.withColumn("held_out", is_crc_remainder(F.col("doc_id"), 5, 0))
    profiles = learn_profiles(rows.filter("not held_out"))
    return predict(rows, profiles, "doc_id", "held_out")
