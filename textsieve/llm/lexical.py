"""Ranked lexical search by Block-Max MaxScore over the shards of an inverted index.

The index. Documents are gathered into shards of some megabytes of text, inside
the task that reads them; nothing is shuffled. A shard is one row: its document
ids and lengths, its terms, and the terms' posting lists in compressed blocks of
64 documents. Each block says its first document, its highest frequency and its
shortest document, which together bound what a document in it can score.

The search. For an item, the lists of a shard are ordered by their bounds over
the whole list. Lists whose bounds together stay below the item's tenth best
score so far are not essential: a document that is in none of the others cannot
enter. Essential lists are decompressed and added up; the documents found are
then looked up in the other lists, highest bound first, and a document is given
up as soon as its score so far, the bound of the one block that could hold it
and the bounds of the lists that remain stay below the tenth best; only blocks
that some document still needs are decompressed. The best of each task's shards
are merged by a window over short rows. All of it is exact.

Results, row by row: null or empty text has no terms and is never found. Every
row of documents counts for itself, also one that repeats an id or has none; of
equal scores the smaller id comes first, a null id last. Every row of items is
searched for itself, also one that repeats an id; one without terms gives no
rows. An empty table on either side gives an empty result. Other columns are not
looked at.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from heapq import nsmallest
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textsieve.llm.common import id_text, id_type
from textsieve.staging import write_staged

#: Terms of a text whose letters A-Z are lower-cased, over UTF-8 bytes.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A shard holds about so many bytes of text, and at most so many documents.
SHARD_BYTES, SHARD_ROWS = 8 << 20, 1 << 16
#: Documents in a block of a posting list.
BLOCK = 64
#: Items are searched in blocks of about so many bytes of text, each sent to all tasks.
ITEM_BYTES = 4 << 20

_find = re.compile(TERM.encode()).findall


def terms_of(text: bytes | None) -> list[bytes]:
    return _find(text.lower()) if text else []


@dataclass(frozen=True)
class Statistics:
    """Documents with a term, and all their terms with repeats."""

    documents: int
    terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))

    def spread(self, lengths: np.ndarray) -> np.ndarray:
        """The part of a score's divisor that grows with a document's length."""
        return 10 + 90 * lengths * self.documents // max(self.terms, 1)


def share(tf: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """What a term's weight is multiplied by; rises with tf and falls with spread."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * spread)


def _sizes(counts: np.ndarray, widths: np.ndarray) -> np.ndarray:
    return counts * ((widths & 15) + (widths >> 4))


def _block_counts(dfs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first block of each list, then the end; and the documents in each block."""
    blocks = -(-dfs // BLOCK)
    first = np.concatenate(([0], np.cumsum(blocks)))
    counts = np.full(first[-1], BLOCK)
    counts[first[1:] - 1] = dfs - (blocks - 1) * BLOCK
    return first, counts


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2… anew for each count."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def invert(texts: list[bytes | None]) -> dict[str, object]:
    """The columns of a shard of these texts, all but the ids."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    found = [terms_of(text) for text in texts]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    total = int(lengths.sum())
    codes = np.fromiter(map(numbers.__getitem__, chain.from_iterable(found)), np.int64, total)
    of = np.repeat(np.arange(len(found)), lengths)
    del found
    keys, tfs = np.unique(codes * len(texts) + of, return_counts=True)
    lists, docs = keys // max(len(texts), 1), keys % max(len(texts), 1)
    dfs = np.bincount(lists, minlength=len(numbers))
    _, counts = _block_counts(dfs)
    starts = np.cumsum(counts) - counts
    gaps = np.diff(docs, prepend=0)
    gaps[starts] = 0
    if len(starts):
        tops, shortest = np.maximum.reduceat(tfs, starts), np.minimum.reduceat(lengths[docs], starts)
        gap_width = np.where(np.maximum.reduceat(gaps, starts) < 256, 1, 2)
        tf_width = np.select([tops < 256, tops < 65536], [1, 2], 4)
    else:
        tops = shortest = gap_width = tf_width = np.zeros(0, np.int64)
    widths = gap_width | tf_width << 4
    offsets = np.cumsum(_sizes(counts, widths)) - _sizes(counts, widths)
    data = np.zeros(int(_sizes(counts, widths).sum()), np.uint8)
    place, block = _within(counts), np.repeat(np.arange(len(counts)), counts)
    for values, width, base in ((gaps, gap_width, offsets), (tfs, tf_width, offsets + counts * gap_width)):
        at = base[block] + place * width[block]
        for byte in range(4):
            wide = width[block] > byte
            data[at[wide] + byte] = values[wide] >> 8 * byte & 255
    return {
        "n_docs": int(np.count_nonzero(lengths)),
        "n_terms": total,
        "lengths": lengths.astype("<i4").tobytes(),
        "terms": b" ".join(numbers),
        "dfs": dfs.astype("<i4").tobytes(),
        "firsts": docs[starts].astype("<u2").tobytes(),
        "tops": tops.astype("<i4").tobytes(),
        "shortest": shortest.astype("<i4").tobytes(),
        "widths": widths.astype("u1").tobytes(),
        "postings": data.tobytes(),
    }


_FIELDS = {
    "n_docs": pa.int64(), "n_terms": pa.int64(), "lengths": pa.binary(), "terms": pa.binary(), "dfs": pa.binary(), "firsts": pa.binary(),
    "tops": pa.binary(), "shortest": pa.binary(), "widths": pa.binary(), "postings": pa.binary(),
}


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """All documents as shards of about shard_bytes of text, written; one row each."""
    narrow = id_text(docs, id_column, text_column).withColumn("text", F.col("text").cast("binary"))
    kind = id_type(narrow)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_kind = pa.int64()
        ids: list[object] = []
        texts: list[bytes | None] = []

        def shard() -> pa.RecordBatch:
            made = invert(texts)
            arrays = [pa.array([ids], pa.list_(id_kind)), *(pa.array([made[name]], field) for name, field in _FIELDS.items())]
            ids.clear()
            texts.clear()
            return pa.RecordBatch.from_arrays(arrays, ["doc_ids", *_FIELDS])

        held = 0
        for batch in batches:
            id_kind = batch.schema.field("doc_id").type
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                for id_, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    if texts and (held + len(text or b"") > shard_bytes or len(texts) >= SHARD_ROWS):
                        yield shard()
                        held = 0
                    ids.append(id_)
                    texts.append(text)
                    held += len(text or b"")
        if texts:
            yield shard()

    fields = ", ".join(f"{name} {'bigint' if field == pa.int64() else 'binary'}" for name, field in _FIELDS.items())
    return write_staged(narrow.mapInArrow(shards, f"doc_ids array<{kind}>, {fields}"), "lexical-index")


def statistics(index: DataFrame) -> Statistics:
    row = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    return Statistics(row[0] or 0, row[1] or 0)


@dataclass
class Postings:
    """One term's list in a shard; bounds are without the term's weight."""

    first: np.ndarray
    counts: np.ndarray
    widths: np.ndarray
    offsets: np.ndarray
    bounds: np.ndarray
    bound: int
    data: np.ndarray

    def read(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents in order, and their frequencies, of these blocks."""
        counts = self.counts[blocks]
        place, gap_width, tf_width = _within(counts), self.widths[blocks] & 15, self.widths[blocks] >> 4
        base = self.offsets[blocks]
        gaps = self._numbers(np.repeat(base, counts) + place * np.repeat(gap_width, counts), np.repeat(gap_width, counts))
        tfs = self._numbers(np.repeat(base + counts * gap_width, counts) + place * np.repeat(tf_width, counts), np.repeat(tf_width, counts))
        run = np.cumsum(gaps)
        return run + np.repeat(self.first[blocks] - run[np.cumsum(counts) - counts], counts), tfs

    def _numbers(self, at: np.ndarray, width: np.ndarray) -> np.ndarray:
        numbers = self.data[at].astype(np.int64)
        for byte in range(1, int(width.max(initial=1))):
            wide = np.flatnonzero(width > byte)
            numbers[wide] += self.data[at[wide] + byte].astype(np.int64) << 8 * byte
        return numbers


class Shard:
    """A shard opened for the terms that some item asks for."""

    def __init__(self, row: dict[str, object], wanted: frozenset[bytes], whole: Statistics):
        def numbers(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(row[name], kind).astype(np.int64)

        self.ids = row["doc_ids"]
        self.spread = whole.spread(numbers("lengths", "<i4"))
        terms = row["terms"].split(b" ") if row["terms"] else []
        first, counts = _block_counts(numbers("dfs", "<i4"))
        widths, firsts = numbers("widths", "u1"), numbers("firsts", "<u2")
        bounds = share(numbers("tops", "<i4"), whole.spread(numbers("shortest", "<i4")))
        offsets, data = np.cumsum(_sizes(counts, widths)) - _sizes(counts, widths), np.frombuffer(row["postings"], np.uint8)
        self.lists: dict[bytes, Postings] = {}
        for i, term in enumerate(terms):
            if term in wanted:
                part = slice(first[i], first[i + 1])
                self.lists[term] = Postings(firsts[part], counts[part], widths[part], offsets[part], bounds[part], int(bounds[part].max()), data)

    def candidates(self, item: list[tuple[bytes, int]], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of all that may score least or more; scores that reach it are whole."""
        lists = sorted(
            ((self.lists[term].bound * weight, weight, self.lists[term]) for term, weight in item if term in self.lists),
            key=lambda entry: entry[0],
        )
        if not lists:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if least <= 1:
            # No score to beat yet: that of the k-th best in the lists of highest bound is one.
            few, size = len(lists), 0
            while few and size < k:
                few -= 1
                size += int(lists[few][2].counts.sum())
            scores = self._search(lists, few, 1)[1]
            if len(scores) >= k:
                least = max(least, int(np.partition(scores, -k)[-k]))
        below = np.cumsum([bound for bound, _, _ in lists])
        return self._search(lists, int(np.searchsorted(below, least, "left")), least)

    def _search(self, lists: list[tuple[int, int, Postings]], essential: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents in lists[essential:], looked up in the others."""
        scores = np.zeros(len(self.ids), np.int64)
        seen = np.zeros(len(self.ids), bool)
        for _, weight, postings in lists[essential:]:
            docs, tfs = postings.read(np.arange(len(postings.counts)))
            scores[docs] += weight * share(tfs, self.spread[docs])
            seen[docs] = True
        docs = np.flatnonzero(seen)
        scores = scores[docs]
        left = sum(bound for bound, _, _ in lists[:essential])
        for bound, weight, postings in reversed(lists[:essential]):
            alive = scores + left >= least
            docs, scores = docs[alive], scores[alive]
            left -= bound
            if not len(docs):
                break
            block = np.searchsorted(postings.first, docs, "right") - 1
            most = np.where(block >= 0, weight * postings.bounds[block], 0)
            alive = scores + most + left >= least
            docs, scores, block = docs[alive], scores[alive], block[alive]
            needed = np.unique(block[block >= 0])
            if len(needed):
                held, tfs = postings.read(needed)
                at = np.minimum(np.searchsorted(held, docs), len(held) - 1)
                hit = held[at] == docs
                scores[hit] += weight * share(tfs[at[hit]], self.spread[docs[hit]])
        alive = scores >= least
        return docs[alive], scores[alive]


class Best:
    """An item's k best documents so far."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple[int, bool, object]] = []

    @property
    def least(self) -> int:
        """The score that a document must reach to come in."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def take(self, shard: Shard, item: list[tuple[bytes, int]]) -> None:
        docs, scores = shard.candidates(item, self.k, self.least)
        if len(docs) > self.k:
            high = scores >= np.partition(scores, -self.k)[-self.k]
            docs, scores = docs[high], scores[high]
        new = ((-score, shard.ids[doc] is None, shard.ids[doc] if shard.ids[doc] is not None else 0) for doc, score in zip(docs.tolist(), scores.tolist()))
        if len(docs):
            self.rows = nsmallest(self.k, chain(self.rows, new))


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items with terms, each with its different terms; ITEM_BYTES of text at a time."""
    block, held = [], 0
    for item_id, text in items.select("item_id", F.col("text").cast("binary")).toLocalIterator():
        terms = sorted(set(terms_of(bytes(text) if text else None)))
        if not terms:
            continue
        if block and held + len(text) > ITEM_BYTES:
            yield block
            block, held = [], 0
        block.append((item_id, terms))
        held += len(text)
    if block:
        yield block


def _document_frequencies(index: DataFrame, wanted: frozenset[bytes]) -> dict[bytes, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: defaultdict[bytes, int] = defaultdict(int)
        for batch in batches:
            for terms, dfs in zip(batch.column("terms"), batch.column("dfs")):
                for term, df in zip(terms.as_py().split(b" "), np.frombuffer(dfs.as_py(), "<i4").tolist()):
                    if term in wanted:
                        total[term] += df
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.binary()), pa.array(total.values(), pa.int64())], ["term", "df"])

    counts = index.select("terms", "dfs").mapInArrow(run, "term binary, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(term): df for term, df in counts.collect()}  # terms of one block of items at most


def search(index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents with a score above 0."""
    whole = statistics(index)
    item_type = items.schema["item_id"].dataType
    doc_kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"item int, item_id {item_type.simpleString()}, doc_id {doc_kind}, score bigint"
    found = [index.sparkSession.createDataFrame([], schema)]
    number = 0
    for block in _blocks(items):
        wanted = frozenset(chain.from_iterable(terms for _, terms in block))
        weights = {term: whole.weight(df) for term, df in _document_frequencies(index, wanted).items()}
        queries = [(number + i, item_id, [(t, weights[t]) for t in terms if weights.get(t)]) for i, (item_id, terms) in enumerate(block)]
        number += len(block)
        found.append(index.drop("n_docs", "n_terms").mapInArrow(_searcher(queries, frozenset(weights), whole, k, to_arrow_type(item_type)), schema))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _searcher(queries: list[tuple[int, object, list[tuple[bytes, int]]]], wanted: frozenset[bytes], whole: Statistics, k: int, item_kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        id_kind = None
        for batch in batches:
            id_kind = batch.schema.field("doc_ids").type.value_type
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], wanted, whole)
                for heap, (_, _, item) in zip(best, queries):
                    heap.take(shard, item)
        if id_kind is None:
            return
        rows = [
            (number, item_id, None if is_null else doc_id, -score)
            for heap, (number, item_id, _) in zip(best, queries)
            for score, is_null, doc_id in heap.rows
        ]
        columns = [list(column) for column in zip(*rows)] or [[], [], [], []]
        arrays = [pa.array(columns[0], pa.int32()), pa.array(columns[1], item_kind), pa.array(columns[2], id_kind), pa.array(columns[3], pa.int64())]
        if rows:
            yield pa.RecordBatch.from_arrays(arrays, ["item", "item_id", "doc_id", "score"])

    return run
