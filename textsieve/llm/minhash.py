"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

Two permutations give all coordinates of a signature: the first scatters a
document's shingles over 2^32 places, the second ranks the places, and is
shifted circularly from one coordinate to the next. Bands of the signature make
buckets; documents in a bucket may be near, and links are confirmed on their
full shingle sets.

Documents with the same set are one class. Within a bucket no pairs are listed:
each class is compared with the smallest and the largest class of its buckets,
best match first. Members of a bucket that are then still in different
components are compared by prefixes of their sets, which is exact. Two sets of Jaccard 0.8 meet in no bucket with probability 2e-5, less above it.

Results: null or empty text and text without words has no shingles, is linked
with nothing and is its own component. Rows of a repeated doc_id with one text
fall into one class. A null doc_id keeps a null component. No rows give no rows.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from textsieve.llm.common import by_slice, id_text, id_type, without
from textsieve.llm.components import apart, components, joined_by, labelled
from textsieve.llm.hashing import U, mix, word_hashes
from textsieve.staging import write_staged

BANDS, ROWS = 36, 6
SHIFT = np.uint32(0x9E3779B1)
_SHIFTS = (np.arange(BANDS * ROWS, dtype=np.uint32) * SHIFT)[:, None]


def shingle_sets(texts: list[str | None], length: int) -> list[np.ndarray]:
    """For each text its distinct shingles of so many words, sorted; one of all
    words if there are fewer."""
    hashes, first = word_hashes([(t or "").encode("utf-8", "surrogatepass") for t in texts])
    sets = []
    for start, stop in zip(first[:-1].tolist(), first[1:].tolist()):
        n = stop - start
        k = min(n, length)
        if not n:
            sets.append(np.empty(0, U))
            continue
        found = np.full(n - k + 1, k, U)
        for i in range(k):
            found = mix(found * U(0x9E3779B97F4A7C15) + hashes[start + i : stop - k + 1 + i])
        sets.append(np.unique(found))
    return sets


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates, from one scatter and one shifted ranking of 2^32 places."""
    places = (mix(shingles) >> U(32)).astype(np.uint32)
    least = np.full(len(_SHIFTS), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(places), 512):
        x = places[start : start + 512] + _SHIFTS
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def band_keys(shingles: np.ndarray) -> np.ndarray:
    rows = signature(shingles).reshape(BANDS, ROWS).astype(U)
    keys = np.arange(1, BANDS + 1, dtype=U)
    for i in range(ROWS):
        keys = mix(keys * U(0xC2B2AE3D27D4EB4F) + rows[:, i])
    return keys.view(np.int64)


def sign(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit fingerprint of the set, and the bands' keys."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text").to_pylist(), length)
        prints = [np.array([mix(s).sum(dtype=U), mix(s + U(1)).sum(dtype=U)], U).view(np.int64) for s in sets]
        h = np.array(prints, np.int64).reshape(-1, 2)
        bands = [band_keys(s) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(h[:, 0]),
                pa.array(h[:, 1]),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "n_shingles", "h1", "h2", "bands"],
        )

    schema = f"doc_id {id_type(docs)}, n_shingles bigint, h1 bigint, h2 bigint, bands array<bigint>"
    return docs.mapInArrow(by_slice(make), schema)


def sets_of(docs: DataFrame, length: int) -> DataFrame:
    """doc_id and its sorted shingles, packed."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text").to_pylist(), length)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "shingles"]
        )

    return docs.mapInArrow(by_slice(make), f"doc_id {id_type(docs)}, shingles binary")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of their full sets, n and m, and of what they share, both."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = ([np.frombuffer(v, U) for v in batch.column(c).to_pylist()] for c in "xy")
        both = [len(np.intersect1d(v, w, assume_unique=True)) for v, w in zip(x, y)]
        sizes = [pa.array(list(map(len, v)), pa.int64()) for v in (x, y)]
        return pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), *sizes, pa.array(both, pa.int64())], ["a", "b", "n", "m", "both"]
        )

    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    kind = joined.schema["a"].dataType.simpleString()
    return joined.mapInArrow(by_slice(make), f"a {kind}, b {kind}, n bigint, m bigint, both bigint")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have at least that Jaccard similarity."""
    return overlaps(pairs, sets).filter(100 * F.col("both") >= percent * (F.col("n") + F.col("m") - F.col("both"))).select("a", "b")


def near_links(classes: DataFrame, docs: DataFrame, length: int, percent: int) -> DataFrame:
    """Components (id, component_id) of classes (doc_id, n_shingles, bands)."""
    spread = classes.select("doc_id", "n_shingles", F.explode("bands").alias("key"))
    buckets = write_staged(
        spread.groupBy("key")
        .agg(F.count("*").alias("size"), F.min(F.struct("doc_id", "n_shingles")).alias("lo"), F.max(F.struct("doc_id", "n_shingles")).alias("hi"))
        .filter("size > 1"),
        "buckets",
    )
    members = write_staged(spread.join(buckets, "key"), "members")
    sets = write_staged(sets_of(docs.join(members.select("doc_id").distinct(), "doc_id", "left_semi"), length), "sets")

    def pair(x: str, y: str, n: str, m: str):
        """a < b; their sizes allow the similarity."""
        return F.when(
            100 * F.least(n, m) >= percent * F.greatest(n, m),
            F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")),
        )

    to_lo = pair("doc_id", "lo.doc_id", "n_shingles", "lo.n_shingles")
    to_hi = pair("doc_id", "hi.doc_id", "n_shingles", "hi.n_shingles")
    pairs = write_staged(
        members.select(F.explode(F.array(to_lo, to_hi)).alias("p")).select("p.*").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("n")),
        "pairs",
    )
    best = pairs.groupBy("b").agg(F.max_by("a", "n").alias("a"))
    found = write_staged(components(confirm(best, sets, percent)), "components")

    more = write_staged(apart(pairs.select("a", "b").exceptAll(best.select("a", "b")), found), "pairs")
    found = write_staged(joined_by(found, confirm(more, sets, percent)), "components")

    held = write_staged(labelled(members.filter("size > 2").select("key", "doc_id", "n_shingles"), "doc_id", found), "held")
    parts = held.groupBy("key", "component_id").agg(F.count("*").alias("n"))
    mains = parts.groupBy("key").agg(F.count("*").alias("parts"), F.max_by("component_id", F.struct("n", "component_id")).alias("main"))
    mixed = held.join(write_staged(mains.filter("parts > 1").select("key", "main"), "mains"), "key")
    mixed = write_staged(mixed.select("doc_id", "component_id", "main").groupBy("doc_id", "component_id", "main").agg(F.count("*").alias("n")), "mixed")
    rest = write_staged(across(mixed, sets, percent).join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    return write_staged(joined_by(found, confirm(rest, sets, percent)), "components")


def described(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """doc_id, component_id, main, n_shingles and apart: the shingles that only one of
    the text and the hub of its main component has."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = ([np.frombuffer(v, U) for v in batch.column(c).to_pylist()] for c in "xy")
        apart_ = [np.setxor1d(v, w, assume_unique=True).view(np.int64) for v, w in zip(x, y)]
        columns = [batch.column(c) for c in ("doc_id", "component_id", "main")]
        sizes = pa.array([len(v) for v in x], pa.int64())
        return pa.RecordBatch.from_arrays(
            [*columns, sizes, pa.array(apart_, pa.list_(pa.int64()))], ["doc_id", "component_id", "main", "n_shingles", "apart"]
        )

    hubs = rows.filter("component_id = main").groupBy("main").agg(F.max_by("doc_id", F.struct("n", "doc_id")).alias("hub"))
    left = sets.select("doc_id", F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("hub"), F.col("shingles").alias("y"))
    hubs = write_staged(hubs.join(right, "hub"), "hubs")
    joined = rows.join(left, "doc_id").join(hubs, "main").select("doc_id", "component_id", "main", "x", "y")
    kind = id_type(rows)
    schema = f"doc_id {kind}, component_id {kind}, main {kind}, n_shingles bigint, apart array<bigint>"
    return joined.mapInArrow(by_slice(make), schema)


def across(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of texts in different components that may be near, among those of
    one main component: exact, and without listing pairs of a bucket.

    rows: doc_id, component_id, the main component of a bucket of the text, and in how
    many buckets. Each text is described by its difference d from one hub, the text of
    the main component that stands in most buckets. Two texts x and y of n and m
    shingles are near if |d(x)| + |d(y)| - 2 |d(x) & d(y)| <= c (n + m), with
    c = (100 - percent) / (100 + percent). With excess(x) = |d(x)| - c n:
    - excess(x) + excess(y) <= 0: near, and so are both to the text of least excess,
      which is all they are compared with;
    - else their differences share at least half that sum. So do prefixes of the
      differences, from rare to frequent shingles, that leave out one less than the
      least number to share with anything; and at the first shingle they share, enough
      must be left of both.
    Shingles in differences of one component alone are left out. What members of a
    family lack or have besides the hub is little, whatever the family's size. Only
    pairs with a text outside the main component are met; the members' prefixes
    reckon with those alone.
    """
    whole, part = 100 + percent, 100 - percent
    around = write_staged(described(rows, sets), "around")
    excess = whole * F.size("apart") - part * F.col("n_shingles")
    texts = around.withColumn("excess", excess.cast("bigint"))
    inside = F.col("component_id") == F.col("main")
    least = texts.groupBy("main").agg(
        F.min("excess").alias("least"),
        F.min(F.when(~inside, F.col("excess"))).alias("least_outside"),
        F.min(F.struct("excess", "doc_id", "component_id")).alias("z"),
    )
    texts = texts.join(write_staged(least, "least"), "main")
    near = texts.filter("excess + least <= 0 and component_id != z.component_id")
    near = near.select(F.least("doc_id", "z.doc_id").alias("a"), F.greatest("doc_id", "z.doc_id").alias("b"))

    shingles = texts.withColumn("least", F.when(inside, F.col("least_outside")).otherwise(F.col("least"))).filter("least is not null")
    shingles = shingles.select("doc_id", "component_id", "main", "n_shingles", "excess", "least", F.explode("apart").alias("s"))
    shingles = write_staged(shingles, "shingles")
    shared = shingles.groupBy("main", "s").agg(F.count("*").alias("n"), F.min("component_id").alias("x"), F.max("component_id").alias("y"))
    shared = write_staged(shared.filter("x != y").select("main", "s", "n"), "shared")
    own = Window.partitionBy("main", "doc_id")
    needed = F.greatest(F.lit(1), F.ceil((F.col("excess") + F.col("least")) / (2 * whole)))
    prefixes = (
        shingles.join(shared, ["main", "s"])
        .withColumn("shares", F.count("*").over(own))
        .filter(F.col("shares") >= needed)
        .withColumn("place", F.row_number().over(own.orderBy("n", "s")))
        .filter(F.col("place") <= F.col("shares") - needed + 1)
        .select("main", "s", "doc_id", "component_id", "n_shingles", "excess", (F.col("shares") - F.col("place") + 1).alias("left"))
    )
    prefixes = write_staged(prefixes, "prefixes")
    renamed = {"doc_id": "other", "component_id": "part", "n_shingles": "m", "excess": "excess_m", "left": "left_m"}
    outside = prefixes.filter(~inside).withColumnsRenamed(renamed)
    both = F.col("excess") + F.col("excess_m")
    enough = (both > 0) & (2 * whole * F.least("left", "left_m") >= both)
    sizes = 100 * F.least("n_shingles", "m") >= percent * F.greatest("n_shingles", "m")
    met = prefixes.join(outside, ["main", "s"]).filter((F.col("component_id") != F.col("part")) & enough & sizes)
    return near.union(met.select(F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b"))).distinct()


def near_duplicates(docs: DataFrame, length: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the smallest id of its component)."""
    rows = id_text(docs, id_column, text_column)
    signed = write_staged(sign(rows, length), "signed")
    classes = write_staged(
        signed.filter("n_shingles > 0 and doc_id is not null")
        .groupBy("h1", "h2", "n_shingles")
        .agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")),
        "classes",
    )
    found = near_links(classes.select("doc_id", "n_shingles", "bands"), rows, length, percent)
    of_class = classes.select("h1", "h2", "n_shingles", F.col("doc_id").alias("class"))
    whole = signed.drop("bands").join(of_class, ["h1", "h2", "n_shingles"], "left")
    whole = whole.withColumn("class", F.coalesce("class", "doc_id"))
    return (
        labelled(whole, "class", found)
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    )


def drop_near_duplicates(docs: DataFrame, length: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs without those of a group but the smallest id; rows without an id stay."""
    found = near_duplicates(docs, length, percent, id_column, text_column)
    return without(docs, found.filter("not kept"), id_column)
