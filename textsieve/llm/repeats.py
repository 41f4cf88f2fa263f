"""Repeated byte strings by prefix-free parsing.

A rolling hash over the bytes sets triggers: each string of `length` bytes is
anchored at the place where the hash of 16 bytes is least within its first part.
The anchor depends on the string alone, so two equal strings have it at the same
offset. The starts that share an anchor form a phrase; it reaches as far as the
strings that start in it. The dictionary is the set of different phrases, sorted
with all that can tell them apart: first by the bytes around the anchor, which
every string of the phrase contains (its core), then as wholes.

That order is the corpus order of the strings, taken no deeper than `length`
bytes and with fingerprints in place of letters, which puts equal strings side
by side just the same:
- a core alone in its class: no string of the phrase occurs elsewhere;
- a phrase that occurs twice: all of its strings do;
- different phrases of one core: their strings are sorted one by one, those of
  a repeated phrase from one of its places only.
So only phrases at the borders of repeated passages are looked into. The bytes
of such phrases meet by core. Where a core has very many different phrases, they
are cut into parts with longer cores of their own, and the strings of the parts
whose core is not alone are dealt out one by one, so that no task gets them all.

Results: null text counts as empty. A row without doc_id is not compared and
keeps all bytes. Rows that repeat a doc_id are occurrences like any others; if
their texts differ, what repeats in one is removed from each, as far as it is
long enough. Texts shorter than the length keep all bytes. An empty table gives
an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textsieve.llm.common import by_slice, id_text, id_type, slices
from textsieve.llm.hashing import U, Spans, mix
from textsieve.staging import write_staged

LENGTH = 400
TRIGGER = 16
#: Triggers are sought in so much of a string; the rest of it stands behind the anchor.
REACH = 320
#: Phrases are cut where the anchor is so far from the start, so that cores are long.
CUT = 160
#: Cores with more different phrases than this are cut into parts of so many starts.
MEETING = 500
PART = 20
#: Bytes of one block of a text.
BLOCK = 1 << 20
_LOW = U((1 << 24) - 1)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of width values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, values.dtype)
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def phrases(data: np.ndarray, spans: Spans, valid: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """first start, last start, anchor, core and whole of each phrase in data.

    valid marks the starts whose string lies within one text.
    """
    at = np.arange(len(data) - TRIGGER + 1)
    hashes = spans.plain(at, at + TRIGGER)
    hashes = (hashes ^ (hashes >> U(32))) * U(0x9E3779B97F4A7C15)
    anchors = (sliding_least((hashes & ~_LOW) | at.astype(U), REACH + 1) & _LOW).astype(np.int64)
    starts = np.flatnonzero(valid[: len(anchors)])
    if not len(starts):
        return (starts,) * 3 + (np.empty(0, U),) * 2
    anchor = anchors[starts]
    far = anchor - starts > CUT
    new = np.concatenate(([True], (np.diff(starts) != 1) | (np.diff(anchor) != 0) | (far[1:] != far[:-1])))
    first = starts[new]
    last = starts[np.concatenate((new[1:], [True]))]
    t, far = anchor[new], far[new]
    # What every string of the phrase contains, whatever the phrase's own extent.
    core = spans(np.where(far, t - CUT, t), np.where(far, t + length - REACH, t + length - CUT))
    core = mix(core + far.astype(U))
    whole = spans(first, last + length)
    whole = mix(whole + ((t - first) << 10 | (last - first)).astype(U))
    return first, last, t, core, whole


def _blocks(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, text numbers and offsets of their starts, and valid starts, some texts
    or a part of one text at a time; parts overlap by one string."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def out():
        data = np.frombuffer(b"".join(part for _, _, part in held), np.uint8)
        edges = np.zeros(len(data) + 1, np.int32)
        begin = np.cumsum([0] + [len(part) for _, _, part in held])[:-1]
        long = [max(0, len(part) - length + 1) for _, _, part in held]
        np.add.at(edges, begin, np.minimum(long, 1))
        np.add.at(edges, begin + long, -np.minimum(long, 1))
        return data, begin, np.array([(i, offset) for i, offset, _ in held], np.int64), np.cumsum(edges)[:-1] > 0

    for i, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), BLOCK):
            part = text[offset : offset + BLOCK + length - 1]
            if len(part) < length:
                continue
            held.append((i, offset, part))
            size += len(part)
            if size >= BLOCK:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def parse(docs: DataFrame, length: int) -> DataFrame:
    """core, whole, doc_id and place of every phrase; place holds first start, extent and anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            for data, begin, origin, valid in _blocks(texts, length):
                first, last, t, core, whole = phrases(data, Spans(data), valid, length)
                part = np.searchsorted(begin, first, "right") - 1
                start = first - begin[part] + origin[part, 1]
                place = start << 20 | (last - first) << 10 | (t - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(core.view(np.int64)),
                        pa.array(whole.view(np.int64)),
                        batch.column("doc_id").take(pa.array(origin[part, 0])),
                        pa.array(place),
                    ],
                    ["core", "whole", "doc_id", "place"],
                )

    return docs.mapInArrow(run, f"core bigint, whole bigint, doc_id {id_type(docs)}, place bigint")


def runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers, given in order."""
    new = np.concatenate(([True], np.diff(starts) != 1))[: len(starts)]
    return starts[new], starts[np.concatenate((new[1:], [True]))[: len(starts)]]


def border_bytes(docs: DataFrame, length: int) -> DataFrame:
    """core, phrases, doc_id, first start, anchor behind it, and bytes of the phrases
    listed for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[tuple] = []
            for i, (text, borders) in enumerate(zip(batch.column("text").to_pylist(), batch.column("borders").to_pylist())):
                text = (text or "").encode("utf-8", "surrogatepass")
                for border in borders:
                    first = border["place"] >> 20
                    extent = border["place"] >> 10 & 1023
                    data = text[first : first + extent + length]
                    rows.append((border["core"], border["phrases"], i, first, border["place"] & 1023, data))
            core, phrases_, at, first, anchor, data = list(zip(*rows)) or ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(core, pa.int64()),
                    pa.array(phrases_, pa.int64()),
                    batch.column("doc_id").take(pa.array(at, pa.int64())),
                    pa.array(first, pa.int64()),
                    pa.array(anchor, pa.int64()),
                    pa.array(data, pa.binary()),
                ],
                ["core", "phrases", "doc_id", "first", "anchor", "data"],
            )

    return docs.mapInArrow(run, f"core bigint, phrases bigint, doc_id {id_type(docs)}, first bigint, anchor bigint, data binary")


def strings_in(data: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the joined data, number of the phrase and offset in it, of all its strings."""
    sizes = np.array([len(x) for x in data], np.int64)
    counts = np.maximum(sizes - length + 1, 0)
    phrase = np.repeat(np.arange(len(data)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(np.cumsum(sizes) - sizes, counts) + offset, phrase, offset


def whole_cores(ends: np.ndarray, most: int = 1000) -> Iterator[tuple[int, int]]:
    """Ranges up to the last end, cut at ends, of about so many rows."""
    start = before = 0
    for end in [*ends.tolist(), None]:
        if end is None or end - start > most:
            if before > start:
                yield start, before
                start = before
        before = end


def repeated_at_borders(phrases_: DataFrame, length: int) -> DataFrame:
    """doc_id, first and last start of repeated strings; the phrases of a core meet in one task."""

    def found(group: pa.Table) -> pa.RecordBatch:
        data = group.column("data").to_pylist()
        at, phrase, offset = strings_in(data, length)
        joined = np.frombuffer(b"".join(data), np.uint8)
        keys = Spans(joined)(at, at + length)
        core = group.column("core").to_numpy().view(U)
        keys = mix(keys ^ mix(core)[phrase])
        _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(counts[which] > 1)
        # Numbered so that runs never go on into the next phrase.
        first, last = runs(phrase[twice] << 32 | offset[twice])
        begin = group.column("first").to_numpy()[first >> 32]
        ids = group.column("doc_id").take(pa.array(first >> 32)).combine_chunks()
        low = (1 << 32) - 1
        return pa.RecordBatch.from_arrays([ids, pa.array(begin + (first & low)), pa.array(begin + (last & low))], ["doc_id", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < 1000:
                continue
            cores = held.column("core").to_numpy()
            ends = np.flatnonzero(cores[1:] != cores[:-1]) + 1
            if len(ends):
                yield from (found(held.slice(x, y - x)) for x, y in whole_cores(ends))
                held = held.slice(int(ends[-1]))
        if held is not None and held.num_rows:
            yield found(held)

    dealt = phrases_.repartition("core").sortWithinPartitions("core")
    return dealt.mapInArrow(run, f"doc_id {id_type(phrases_)}, first bigint, last bigint")


def parts_of(phrases_: DataFrame, length: int) -> DataFrame:
    """core, doc_id, first start and bytes of parts of phrases.

    Parts are cut where the distance to the anchor is a multiple of PART; a part's
    core is what all strings at its distances contain, and stands for the phrase's.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        data = batch.column("data").to_pylist()
        cores = batch.column("core").to_numpy().view(U)
        begin = np.cumsum([0] + [len(x) for x in data])
        rows: list[tuple[int, int, bytes]] = []
        ends: list[tuple[int, int, int, int]] = []
        for i, (text, first, anchor) in enumerate(zip(data, batch.column("first").to_pylist(), batch.column("anchor").to_pylist())):
            starts = len(text) - length + 1
            if starts < 1:
                continue
            for block in range((anchor - starts + 1) // PART, anchor // PART + 1):
                low, high = block * PART, block * PART + PART - 1
                start, last = max(0, anchor - high), min(starts - 1, anchor - low)
                rows.append((i, first + start, text[start : last + length]))
                ends.append((i, block, begin[i] + anchor - low, begin[i] + anchor - high + length))
        of, block, left, right = np.array(ends, np.int64).reshape(-1, 4).T
        core = Spans(np.frombuffer(b"".join(data), np.uint8))(left, right)
        core = mix(core ^ mix(cores[of] + block.astype(U)))
        at, first, pieces = list(zip(*rows)) or ((),) * 3
        ids = batch.column("doc_id").take(pa.array(at, pa.int64()))
        columns = [pa.array(core.view(np.int64)), ids, pa.array(first, pa.int64()), pa.array(pieces, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["core", "doc_id", "first", "data"])

    return phrases_.mapInArrow(by_slice(make), f"core bigint, doc_id {id_type(phrases_)}, first bigint, data binary")


def single_strings(phrases_: DataFrame, length: int) -> DataFrame:
    """128-bit key, doc_id and start of every string of the phrases."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        data = batch.column("data").to_pylist()
        at, phrase, offset = strings_in(data, length)
        joined = np.frombuffer(b"".join(data), np.uint8)
        keys = [Spans(joined, seed)(at, at + length).view(np.int64) for seed in (0, 1)]
        ids = batch.column("doc_id").take(pa.array(phrase))
        start = batch.column("first").to_numpy()[phrase] + offset
        return pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(keys[1]), ids, pa.array(start)], ["k1", "k2", "doc_id", "start"])

    return phrases_.mapInArrow(by_slice(make), f"k1 bigint, k2 bigint, doc_id {id_type(phrases_)}, start bigint")


def remaining(text: bytes, ranges: np.ndarray, length: int) -> tuple[bytes, int, int]:
    """What is left without the strings that start in ranges (first, last); bytes and runs removed."""
    order = np.argsort(ranges[:, 0], kind="stable")
    first, stop = ranges[order, 0], np.maximum.accumulate(ranges[order, 1] + length)
    new = np.concatenate(([True], first[1:] > stop[:-1]))
    begins, ends = first[new], stop[np.concatenate((new[1:], [True]))]
    kept, at = [], 0
    for a, b in zip(begins.tolist(), ends.tolist()):
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return b"".join(kept), int((ends - begins).sum()), len(begins)


def repeated_ranges(rows: DataFrame, length: int) -> DataFrame:
    """doc_id, first and last start of runs of strings that also start elsewhere."""
    parsed = write_staged(parse(rows.filter("doc_id is not null"), length), "phrases")
    cores = parsed.groupBy("core").agg(F.count("*").alias("n"), F.min("whole").alias("a"), F.max("whole").alias("b"))
    cores = write_staged(cores.filter("n > 1").select("core", (F.col("a") == F.col("b")).alias("same")), "cores")
    shared = write_staged(parsed.join(cores, "core"), "shared")
    first = F.shiftright("place", 20)
    last = first + F.shiftright("place", 10).bitwiseAND(1023)

    def ranges(df: DataFrame) -> DataFrame:
        return df.select("doc_id", first.alias("first"), last.alias("last"))

    several = shared.filter("not same")
    dictionary = several.groupBy("core", "whole").agg(F.count("*").alias("times"), F.min(F.struct("doc_id", "place")).alias("one"))
    dictionary = write_staged(dictionary, "dictionary")
    sizes = write_staged(dictionary.groupBy("core").agg(F.count("*").alias("phrases")), "sizes")
    classes = write_staged(dictionary.join(sizes, "core"), "classes")
    found = write_staged(several.drop("same").join(classes, ["core", "whole"]), "found")
    whole = ranges(shared.filter("same")).union(ranges(found.filter("times > 1")))

    # All strings of a repeated phrase are settled, so that one place of it stands for the others.
    at_border = found.filter("times = 1 or (doc_id = one.doc_id and place = one.place)")
    borders = at_border.groupBy("doc_id").agg(F.collect_list(F.struct("core", "phrases", "place")).alias("borders"))
    text = rows.join(borders, "doc_id").select("doc_id", "text", "borders")
    data = write_staged(border_bytes(text, length), "borders")
    met = repeated_at_borders(data.filter(F.col("phrases") <= MEETING), length)
    parts = write_staged(parts_of(data.filter(F.col("phrases") > MEETING), length), "parts")
    shared = write_staged(parts.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core"), "parts")
    strings = write_staged(single_strings(parts.join(shared, "core"), length), "strings")
    twice = write_staged(strings.groupBy("k1", "k2").agg(F.count("*").alias("times")).filter("times > 1"), "twice")
    single = strings.join(twice, ["k1", "k2"]).select("doc_id", F.col("start").alias("first"), F.col("start").alias("last"))
    return whole.union(met).union(single)


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text", with_text: bool = False) -> DataFrame:
    """Per document what is left of its bytes once every repeated string is removed."""
    rows = id_text(docs, id_column, text_column)
    ranges = repeated_ranges(rows, length).groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    joined = rows.join(ranges, "doc_id", "left").select("doc_id", "text", "ranges")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges")):
            text = (text or "").encode("utf-8", "surrogatepass")
            kept, removed, spans = text, 0, 0
            if ranges.is_valid and len(text) >= length:
                pairs = np.stack([ranges.values.field(c).to_numpy() for c in ("first", "last")], axis=1)
                kept, removed, spans = remaining(text, np.minimum(pairs, len(text) - length), length)
            shown = kept.decode("utf-8", "replace") if with_text else None
            found.append((len(text), removed, spans, hashlib.sha256(kept).hexdigest(), shown))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        arrays = [pa.array(c, kind) for c, kind in zip(list(zip(*found)) or [()] * 5, kinds)]
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])

    schema = f"doc_id {id_type(rows)}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, text string"
    result = joined.mapInArrow(by_slice(make), schema)
    return result if with_text else result.drop("text")
