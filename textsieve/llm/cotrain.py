"""Quality classifier by co-training of a text view and a metadata view.

One logistic model sees the text alone (hashed words, character classes, line
and vocabulary measures), the other the metadata alone (source, language,
length as stored). Both start from the labelled rows. In each round every
unlabelled document is scored by both, and what one view is most confident of
is added to the learning rows of the other. At the end each view is calibrated
on labelled rows held out of the fit, and the score of a document is the
probability that the summed calibrated evidence gives.

Bounded by parameters, and only in the fit: about MOST_LABELLED labelled rows,
those of the smallest id hash, and MOST_PSEUDO pseudo-labels per round, class and view.
Features, the search for confident rows, and the scores cover all documents.

Results, row by row: null text counts as empty; null metadata is a value of its
own, a null length is 0. A null id has no label. Labels other than 0 and 1 are
left out; an id with several labels has their mean, rounded up. Without labels of
both kinds every document scores 0.5 and is kept. Repeated rows are repeated in
the result. No rows give no rows. Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textsieve.llm.common import by_slice, id_type, is_crc_remainder
from textsieve.llm.hashing import U, Spans, words
from textsieve.staging import write_staged

MOST_LABELLED = 20_000
MOST_PSEUDO = 1_000
ROUNDS = 3
CONFIDENT = 0.95
KEEP = 0.5
BUCKETS = 64
SOURCES, LANGUAGES = 32, 16
_SYMBOLS = b"#*$%&|<>{}[]=_~^\\/@"

#: Kind of each byte: letter, capital, digit, symbol, other mark, blank, line end, beyond ASCII.
KIND = np.full(256, 4, np.uint8)
KIND[97:123], KIND[65:91], KIND[48:58], KIND[list(_SYMBOLS)] = 0, 1, 2, 3
KIND[[9, 11, 12, 13, 32]], KIND[10], KIND[128:] = 5, 6, 7


def text_features(texts: list[str | None]) -> np.ndarray:
    """A row of numbers for each text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    n = len(raw)
    data, starts, stops, first = words(raw)
    hashes = Spans(data)(starts, stops)
    per_text = np.diff(first)
    of = np.repeat(np.arange(n), per_text)
    sign = np.where(hashes >> U(63), 1.0, -1.0)
    bag = np.bincount(of * BUCKETS + (hashes & U(BUCKETS - 1)).astype(np.int64), sign, n * BUCKETS).reshape(n, BUCKETS)
    sizes = np.array([len(t) for t in raw])
    joined = np.frombuffer(b"".join(raw), np.uint8)
    kinds = np.bincount(np.repeat(np.arange(n) * 8, sizes) + KIND[joined], minlength=n * 8).reshape(n, 8)
    distinct = np.bincount(np.unique(np.stack([of.astype(U), hashes]), axis=1)[0].astype(np.int64), minlength=n)
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in raw]
    line_counts = np.array([len(x) for x in lines])
    line_kinds = np.array([len(set(x)) for x in lines])
    some = np.maximum(per_text, 1)
    return np.column_stack(
        [
            bag / np.sqrt(some)[:, None],
            kinds / np.maximum(sizes, 1)[:, None],
            np.log1p(per_text),
            (stops - starts).sum() and np.bincount(of, stops - starts, n) / some / 10,
            distinct / some,
            line_kinds / np.maximum(line_counts, 1),
            np.log1p(some / np.maximum(line_counts, 1)),
        ]
    ).astype(np.float32)


def meta_features(source: list[int], lang: list[int], length: list[float]) -> np.ndarray:
    """One-hot of the hashed source and language, and of the length's order."""
    n = len(source)
    order = np.clip(np.log2(np.maximum(np.array(length, float), 1)).astype(int), 0, 23)
    table = np.zeros((n, SOURCES + LANGUAGES + 24), np.float32)
    at = np.arange(n)
    table[at, source] = 1
    table[at, SOURCES + np.array(lang, int)] = 1
    table[at, SOURCES + LANGUAGES + order] = 1
    return table


def features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, label and held of each document, with packed features of both views."""
    known = labels.filter("quality in (0, 1)").groupBy("doc_id").agg(F.round(F.avg("quality")).cast("int").alias("label"))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = text_features(batch.column("text").to_pylist())
        meta = meta_features(*(batch.column(c).to_pylist() for c in ("source", "lang", "length")))
        arrays = [pa.array([row.tobytes() for row in view], pa.binary()) for view in (text, meta)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "by_text", "by_meta"])

    def bucket(column: str, n: int):
        return F.pmod(F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(n)).cast("int").alias(column)

    narrow = docs.select(
        "doc_id", "text", bucket("source", SOURCES), bucket("lang", LANGUAGES), F.coalesce(F.col("n_chars").cast("double"), F.lit(0.0)).alias("length")
    )
    found = narrow.mapInArrow(by_slice(make), f"doc_id {id_type(docs)}, by_text binary, by_meta binary")
    return found.join(known, "doc_id", "left").withColumn("held", is_crc_remainder(F.col("doc_id"), 5, 0))


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 12) -> Logistic:
        """Newton's method on standardised features."""
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale[scale < 1e-6] = 1
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        w = np.zeros(z.shape[1])
        ridge = np.full(len(w), penalty)
        ridge[-1] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            slope = z.T @ (p - y) + ridge * w
            curve = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(curve, slope)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        return Logistic(mean, scale, w)

    def evidence(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1], -30, 30)


@dataclass
class Rows:
    """Learning rows of one view."""

    x: np.ndarray
    y: np.ndarray

    def more(self, x: np.ndarray, y: np.ndarray) -> Rows:
        return Rows(np.concatenate([self.x, x]), np.concatenate([self.y, y])) if len(x) else self


def unpack(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.stack([np.frombuffer(r, np.float32) for r in rows]).astype(float) if rows else np.empty((0, 0))


def scored(table: DataFrame, models: tuple[Logistic, Logistic]) -> DataFrame:
    """doc_id, label, and evidence of both views."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [m.evidence(unpack(batch.column(c))) if batch.num_rows else [] for m, c in zip(models, ("by_text", "by_meta"))]
        keep = [batch.column(c) for c in ("doc_id", "label", "by_text", "by_meta")]
        return pa.RecordBatch.from_arrays([*keep, *map(pa.array, found)], ["doc_id", "label", "by_text", "by_meta", "text_evidence", "meta_evidence"])

    narrow = table.select("doc_id", "label", "by_text", "by_meta")
    schema = f"doc_id {id_type(table)}, label int, by_text binary, by_meta binary, text_evidence double, meta_evidence double"
    return narrow.mapInArrow(by_slice(make), schema)


def pseudo_labels(found: DataFrame, evidence: str, features_: str) -> tuple[np.ndarray, np.ndarray]:
    """Features for the other view, and labels, of the rows one view is most confident of."""
    edge = float(np.log(CONFIDENT / (1 - CONFIDENT)))
    xs, ys = [], []
    for label, sure, order in ((1, F.col(evidence) >= edge, F.desc(evidence)), (0, F.col(evidence) <= -edge, F.asc(evidence))):
        sure = found.filter(F.col("label").isNull() & sure)
        # Narrow rows are ordered; the features are fetched for the few that are taken.
        best = sure.select("doc_id", evidence).orderBy(order, F.xxhash64("doc_id")).limit(MOST_PSEUDO)
        x = unpack(sure.join(F.broadcast(best.select("doc_id")), "doc_id", "left_semi").select(features_).toArrow().column(0))
        if len(x):
            xs.append(x)
            ys.append(np.full(len(x), float(label)))
    return (np.concatenate(xs), np.concatenate(ys)) if xs else (np.empty((0, 0)), np.empty(0))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text_score and meta_score (calibrated), score and kept of every document.

    docs has doc_id, text, source, lang and n_chars; labels has doc_id and quality.
    """
    table = write_staged(features(docs, labels), "features")
    labelled = table.filter("label is not null")
    share = min(1.0, MOST_LABELLED / max(1, labelled.count()))
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    sample = sample.select("label", "held", "by_text", "by_meta").toArrow()
    y = np.array(sample.column("label").to_pylist(), float)
    held = np.array(sample.column("held").to_pylist(), bool)
    if len(set(y[~held])) < 2:
        half = F.lit(0.5)
        return table.select("doc_id", half.alias("text_score"), half.alias("meta_score"), half.alias("score"), F.lit(True).alias("kept"))
    views = [unpack(sample.column(c)) for c in ("by_text", "by_meta")]
    rows = [Rows(x[~held], y[~held]) for x in views]
    models = tuple(Logistic.fit(r.x, r.y) for r in rows)
    for _ in range(ROUNDS):
        found = scored(table, models)
        from_text = pseudo_labels(found, "text_evidence", "by_meta")
        from_meta = pseudo_labels(found, "meta_evidence", "by_text")
        rows = [rows[0].more(*from_meta), rows[1].more(*from_text)]
        models = tuple(Logistic.fit(r.x, r.y) for r in rows)

    # One joint calibration weighs both views on rows neither was fitted on.
    evidence = [m.evidence(x) for m, x in zip(models, views)]
    use = held if len(set(y[held])) == 2 else ~held
    single = [Logistic.fit(e[use][:, None], y[use]) for e in evidence]
    both = Logistic.fit(np.column_stack(evidence)[use], y[use])

    def probability(model: Logistic, *columns: str):
        value = F.lit(float(model.weights[-1]))
        for w, mean, scale, c in zip(model.weights, model.mean, model.scale, columns):
            value = value + (F.col(c) - float(mean)) * float(w / scale)
        return 1 / (1 + F.exp(-value))

    return scored(table, models).select(
        "doc_id",
        probability(single[0], "text_evidence").alias("text_score"),
        probability(single[1], "meta_evidence").alias("meta_score"),
        probability(both, "text_evidence", "meta_evidence").alias("score"),
    ).withColumn("kept", F.col("score") >= KEEP)
