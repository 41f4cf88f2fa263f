"""Benchmark decontamination by q-gram lemma filtering.

A benchmark item of m bytes found with at most k edits shares at least
m - q + 1 - k q of its q-grams with the text, on at most k + 1 neighbouring
diagonals. Shared q-grams are counted in diagonal bands of k + 1 places, each
taken with the next one so that bands overlap; bands that reach the bound are
verified by aligning the item with the text of the band.

q is 12, or less for an item whose bound would be void: the item is then cut into
as many parts as it may have edits, and one more. Items of fewer than 12 bytes have
no edits; they are their own q-gram, and count where they stand as whole words.

The benchmark is searched in blocks of a bounded size, each broadcast; however
large it is, no task holds more than one block of it.

Results: one row for each place found; null or empty text and null, empty or
blank items give none. A word ends between any two characters of scripts that set no
blanks. Letters A-Z are lower-cased and white space counts as a blank; places are byte offsets of the
text as UTF-8. Repeated rows and null ids are searched like any others. Empty
tables give an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from textsieve.llm.common import id_text, id_type, slices, without
from textsieve.llm.hashing import LOWER, SPACE, U

#: Longest q-grams; items shorter than this are searched as whole words.
Q = 12
#: Edits allowed for each hundred bytes of an item.
EDIT_PERCENT = 5
#: Bytes of items searched at a time.
BLOCK_BYTES = 4 << 20
STEP = 1 << 20
_BITS = 22
NORMAL = np.where(SPACE, 32, LOWER).astype(np.uint8)


def normal(text: str) -> bytes:
    return NORMAL[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)].tobytes()


def grams(data: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit fingerprint of the q-gram at each place."""
    if len(data) < q:
        return np.empty(0, U)
    n = len(data) - q + 1
    if q < 8:
        x = np.zeros(n, U)
        for i in range(q):
            x = x << U(8) | data[i : i + n]
        x *= U(0x9E3779B97F4A7C15)
    else:
        eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        x = eight[:n] * U(0x9E3779B97F4A7C15) + (eight[q - 8 : q - 8 + n] ^ U(0x5851F42D4C957F2D)) * U(0xC2B2AE3D27D4EB4F)
    return (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)


class Items:
    """Some benchmark items, and an index for each length of their q-grams."""

    def __init__(self, items: list[tuple[object, bytes]]):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        m = np.array([len(t) for t in self.texts], np.int64)
        self.edits = m * EDIT_PERCENT // 100
        q = np.minimum(Q, m // (self.edits + 1))
        self.indexes = [Index(self.texts, self.edits, np.flatnonzero(q == x), x) for x in np.unique(q).tolist()]

    def candidates(self, data: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Item, and first and last diagonal of the bands that reach its bound."""
        for index in self.indexes:
            yield from index.candidates(data)


class Index:
    """The q-grams of those of the texts that are numbered in which."""

    def __init__(self, texts: list[bytes], edits: np.ndarray, which: np.ndarray, q: int):
        self.q, self.edits = q, edits
        m = np.array([len(t) for t in texts], np.int64)
        self.bound = m - q + 1 - edits * q
        codes = [grams(np.frombuffer(texts[i], np.uint8), q) for i in which.tolist()]
        item = np.repeat(which, [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes])
        codes = np.concatenate(codes)
        order = np.argsort(codes, kind="stable")
        self.codes, start = np.unique(codes[order], return_index=True)
        self.start = np.append(start, len(order))
        self.item, self.place = item[order], place[order]
        self.bits = np.zeros(1 << _BITS, bool)
        self.bits[(self.codes >> U(64 - _BITS)).astype(np.int64)] = True

    def shared(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in data, item and place in the item of each shared q-gram."""
        places, which = [], []
        for start in range(0, max(0, len(data) - self.q + 1), STEP):
            codes = grams(data[start : start + STEP + self.q - 1], self.q)
            maybe = np.flatnonzero(self.bits[(codes >> U(64 - _BITS)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.codes, codes[maybe]), len(self.codes) - 1)
            true = self.codes[at] == codes[maybe]
            places.append(maybe[true] + start)
            which.append(at[true])
        place, which = np.concatenate(places or [np.empty(0, int)]), np.concatenate(which or [np.empty(0, int)])
        counts = self.start[which + 1] - self.start[which]
        posting = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(self.start[which], counts)
        return np.repeat(place, counts), self.item[posting], self.place[posting]

    def candidates(self, data: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Item, and first and last diagonal of the bands that reach its bound."""
        place, item, own = self.shared(data)
        if not len(place):
            return
        width = self.edits + 1
        band = (place - own) // width[item]
        shift = int(band.min())
        keys, counts = np.unique(item << 40 | (band - shift), return_counts=True)
        nexts = np.append(np.where(np.diff(keys) == 1, counts[1:], 0), 0)
        reached = np.flatnonzero(counts + nexts >= self.bound[keys >> 40])
        # A match whose diagonals lie in the second band alone is found from that band.
        for key in keys[reached].tolist():
            i = key >> 40
            low = ((key & ((1 << 40) - 1)) + shift) * int(width[i])
            yield i, low, low + 2 * int(width[i]) - 1


def align(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """Least edits between item and any part of region, and start and stop of that part."""

    def forward(a: np.ndarray, b: np.ndarray, free: bool) -> np.ndarray:
        ramp = np.arange(len(b) + 1)
        row = np.zeros(len(b) + 1, np.int64) if free else ramp.astype(np.int64)
        for c in a.tolist():
            new = row + 1
            np.minimum(new[1:], row[:-1] + (b != c), out=new[1:])
            row = np.minimum.accumulate(new - ramp) + ramp
        return row

    row = forward(item, region, True)
    stop = int(np.argmin(row))
    back = forward(item[::-1], region[:stop][::-1], False)
    return int(row[stop]), stop - int(np.argmin(back)), stop


def _unspaced(char: str) -> bool:
    """Whether char is of a script that sets no blanks between words."""
    x = ord(char)
    return 0x0E00 <= x < 0x0F00 or 0x1000 <= x < 0x10A0 or 0x1780 <= x < 0x1800 or 0x2E80 <= x < 0xA000 or 0xF900 <= x < 0xFB00 or 0x20000 <= x < 0x40000


def within_word(text: bytes, at: int) -> bool:
    """Whether characters of one word stand on both sides of the place."""
    before, after = text[max(0, at - 4) : at].decode("utf-8", "ignore")[-1:], text[at : at + 4].decode("utf-8", "ignore")[:1]
    return all(c and (c == "_" or unicodedata.category(c)[0] in "LMN") and not _unspaced(c) for c in (before, after))


def find(items: Items, text: bytes) -> list[tuple[int, int, int, int]]:
    """Item number, start, stop and edits of each place in a normalised text."""
    found = set()
    data = np.frombuffer(text, np.uint8)
    for i, low, high in items.candidates(data):
        item, k = items.texts[i], int(items.edits[i])
        if len(item) < Q:
            stop = low + len(item)
            if text[low:stop] == item and not within_word(text, low) and not within_word(text, stop):
                found.add((i, low, stop, 0))
            continue
        begin, end = max(0, low - k), min(len(text), high + len(item) + k)
        at = text.find(item, begin, end)
        if at >= 0:
            found.add((i, at, at + len(item), 0))
            continue
        edits, start, stop = align(np.frombuffer(item, np.uint8), data[begin:end])
        if edits <= k:
            found.add((i, begin + start, begin + stop, edits))
    return sorted(found)


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, bytes]]]:
    """Items (item_id, normal text), some at a time."""
    held, size = [], 0
    for row in benchmark.filter("text is not null").toLocalIterator():
        item = normal(row["text"])
        if not item.strip():
            continue
        held.append((row["item_id"], item))
        size += len(item)
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, item_id, start, stop and n_edits of each place of a benchmark item."""
    rows = id_text(docs, id_column, text_column)
    items = benchmark.select("item_id", "text")
    item_type = items.schema["item_id"].dataType
    schema = f"doc_id {id_type(rows)}, item_id {item_type.simpleString()}, start bigint, stop bigint, n_edits bigint"

    def search(block: list[tuple[object, bytes]]) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Items(shared.value)
            for batch in slices(batches):
                out = [
                    (n, index.ids[i], start, stop, edits)
                    for n, text in enumerate(batch.column("text").to_pylist())
                    if text
                    for i, start, stop, edits in find(index, normal(text))
                ]
                n, ids, *numbers = list(zip(*out)) or [()] * 5
                of = batch.column("doc_id").take(pa.array(n, pa.int64()))
                columns = [of, pa.array(ids, to_arrow_type(item_type)), *[pa.array(x, pa.int64()) for x in numbers]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "start", "stop", "n_edits"])

        return rows.mapInArrow(run, schema)

    found = [search(block) for block in blocks(items)]
    return reduce(DataFrame.union, found) if found else rows.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs without those that hold a benchmark item."""
    return without(docs, leaks(docs, benchmark, id_column, text_column), id_column)
