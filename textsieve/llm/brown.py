"""Class-based bigrams: exchange clustering of words, smoothed score of texts.

The most frequent words are assigned to classes by the exchange algorithm: each
word in turn moves to the class that raises the likelihood of the class bigrams
most, until no word moves. From there all other words get their class in rounds
over all learning texts: the class neighbours of each word are counted, it joins
the class it gains most from, and the class bigrams are counted again. In these
rounds the OWN most frequent words are placed one by one, all others together with
the words of the same ending. Then each of the others is placed by its own
neighbours; the class of an ending is left to words never learned. The number of
classes grows with the vocabulary. The end of a text is a class of its own. A
text's probability is the product of class transitions and of word emissions
from their classes, both smoothed by adding a half; a class has one place for
words never learned.

Word and bigram counts cover every learning text, and every word has its own class.
Bounded by parameters are only the words of the first exchange (CLUSTERED), whose
bigrams go to the driver, and the words whose counts and classes a task holds
(LOOKUP, the most frequent ones); all other words meet their neighbours, counts and
classes in joins.

Results: null or empty text is one end token. Rows of a repeated doc_id each have
their own result; a null doc_id counts as the text 'null' for the split. If
nothing was learned all counts are 0. No rows give no rows. Equal frequencies are
ordered by the words' bytes. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textsieve.llm.common import id_text, id_type, is_crc_remainder, slices
from textsieve.staging import write_staged

CLUSTERED = 800
#: Least number of classes; it grows with the fourth root of the vocabulary.
CLASSES = 24
SWEEPS = 12
#: Passes that place the words beyond the first ones.
ROUNDS = 2
#: Words placed by themselves in the rounds; all others go with their ending there, and by themselves after them.
OWN = 30_000
LOOKUP = 200_000
#: Counters of a task are handed on when they hold so many entries.
HELD = 300_000
END = b""


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words and the end; bytes.split knows the six ASCII blanks only."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def count_words(docs: DataFrame) -> DataFrame:
    """word and n over all texts."""

    def rows(counter: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())], ["word", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                counter.update(tokens(text))
            if len(counter) > HELD:
                yield rows(counter)
                counter.clear()
        yield rows(counter)

    return docs.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(words: DataFrame, most: int) -> dict[bytes, int]:
    """Counts of the words at least as frequent as the smallest frequency that
    leaves no more than so many words; a histogram of frequencies finds it."""
    histogram = words.filter("n > 1").groupBy("n").agg(F.count("*").alias("words"))
    # As many rows as there are different frequencies above one, the largest first.
    total, least = 0, None
    for row in histogram.orderBy(F.desc("n")).limit(most).collect():
        total += row["words"]
        if total > most:
            break
        least = row["n"]
    if least is None:
        return {}
    found = words.filter(F.col("n") >= least).toArrow()
    return dict(zip(found.column("word").to_pylist(), found.column("n").to_pylist()))


def ending(word: bytes) -> bytes:
    return word[-2:]


@dataclass
class Units:
    """What words are told apart by: 0 is the end, then the held words from frequent to rare,
    then the endings of all other words, and one unit for endings never learned.

    Units beyond the most frequent OWN words share a group with all words of their ending.
    """

    words: list[bytes]
    counts: np.ndarray
    endings: list[bytes]
    #: Tokens and different words of each ending that are not held.
    ending_n: np.ndarray
    ending_words: np.ndarray

    @property
    def group(self) -> np.ndarray:
        own = min(len(self.words), OWN)
        of = {e: own + 1 + i for i, e in enumerate(self.endings)}
        shared = [of[ending(w)] for w in self.words[own:]]
        return np.concatenate((np.arange(own + 1), shared, own + 1 + np.arange(len(self.endings) + 1))).astype(np.int64)


def units(words: DataFrame) -> Units:
    counts = frequent(words, LOOKUP)
    least = min(counts.values(), default=None)
    other = words.filter(F.col("word") != F.lit(END))
    other = other if least is None else other.filter(F.col("n") < least)
    last = F.expr("substring(word, greatest(length(word) - 1, 1), 2)").alias("ending")
    # An ending has two bytes at most, so there are no more than 65,792.
    found = other.groupBy(last).agg(F.sum("n").alias("n"), F.count("*").alias("words")).toArrow().to_pydict()
    tally = dict(zip(found["ending"], zip(found["n"], found["words"])))
    ends = words.filter(F.col("word") == F.lit(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    held = sorted((w for w in counts if w != END), key=lambda w: (-counts[w], w))
    endings = sorted({*tally, *(ending(w) for w in held[OWN:])})
    tallies = np.array([tally.get(e, (0, 0)) for e in endings], np.int64).reshape(-1, 2)
    return Units(held, np.array([ends, *(counts[w] for w in held)], np.int64), endings, tallies[:, 0], tallies[:, 1])


def numbered(docs: DataFrame, of: Units) -> DataFrame:
    """The units of each text, packed, its different words that are not held, and which of these stand there in turn.

    row tells rows of one doc_id apart; the table is written before it is used.
    """
    shared = docs.sparkSession.sparkContext.broadcast((of.words, of.endings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, endings = shared.value
        find = {word: i for i, word in enumerate([END, *words])}.get
        last = {e: len(words) + 1 + i for i, e in enumerate(endings)}
        unknown = len(words) + 1 + len(endings)
        for batch in slices(batches):
            packed, rest, which = [], [], []
            for text in batch.column("text").to_pylist():
                found = tokens(text)
                ids = [find(word, -1) for word in found]
                missing = [w for w, i in zip(found, ids) if i < 0]
                place = {w: i for i, w in enumerate(dict.fromkeys(missing))}
                if missing:
                    ids = [last.get(ending(w), unknown) if i < 0 else i for w, i in zip(found, ids)]
                packed.append(np.array(ids, np.int32).tobytes())
                rest.append(list(place))
                which.append(np.array([place[w] for w in missing], np.int32).tobytes())
            columns = [batch.column(c) for c in ("row", "doc_id", "held_out")]
            columns += [pa.array(packed, pa.binary()), pa.array(rest, pa.list_(pa.binary())), pa.array(which, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "held_out", "units", "rest", "which"])

    schema = f"row bigint, doc_id {id_type(docs)}, held_out boolean, units binary, rest array<binary>, which binary"
    return docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, schema)


def sequences(batches: Iterator[pa.RecordBatch], first: int = 0, most: int = 1 << 21) -> Iterator[np.ndarray]:
    """Units of many texts in a row, with the end before the first."""
    held, size = [], 0
    for batch in batches:
        for packed in batch.column("units").to_pylist():
            held.append(packed)
            size += len(packed)
            if size > most:
                yield np.concatenate(([first], np.frombuffer(b"".join(held), np.int32)))
                held, size = [], 0
    if held:
        yield np.concatenate(([first], np.frombuffer(b"".join(held), np.int32)))


def summed(texts: DataFrame, keys: Callable[[np.ndarray], np.ndarray], size: int, first: int = 0) -> DataFrame:
    """key and n: how often each of the keys below size comes out of the texts' units."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for sequence in sequences(batches, first):
            found, n = np.unique(keys(sequence), return_counts=True)
            total[found] += n
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["key", "n"])

    return texts.select("units").mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def count_bigrams(texts: DataFrame, of: np.ndarray, size: int, first: int = 0) -> np.ndarray:
    """How often symbol j follows symbol i; of gives each unit's symbol, below size."""
    shared = texts.sparkSession.sparkContext.broadcast(of)

    def keys(sequence: np.ndarray) -> np.ndarray:
        symbols = shared.value[sequence]
        return symbols[:-1] * size + symbols[1:]

    counted = summed(texts, keys, size * size, first).toArrow()
    table = np.zeros(size * size, np.int64)
    table[counted.column("key").to_numpy()] = counted.column("n").to_numpy()
    return table.reshape(size, size)


def gains_of(table: np.ndarray, classes: int) -> np.ndarray:
    """What a word gains from each class for a neighbour of each class: after it, then before it."""
    k = len(table)
    smooth = np.log(table + 0.5)
    after = smooth - np.log(table.sum(axis=1) + 0.5 * k)[:, None]
    before = smooth - np.log(table.sum(axis=0) + 0.5 * k)[None, :]
    return np.concatenate((after.T, before))[:, :classes]


def place_rest(texts: DataFrame, of: np.ndarray, held: int, table: np.ndarray, classes: int) -> DataFrame:
    """word, n and class of every word that is not held, by its own neighbours in all texts."""
    k = len(table)
    shared = texts.sparkSession.sparkContext.broadcast(of)
    gains = gains_of(table, classes)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            units_ = np.frombuffer(b"".join(batch.column("units").to_pylist()), np.int32)
            rest = batch.column("rest")
            which = [np.frombuffer(w, np.int32) for w in batch.column("which").to_pylist()]
            words = np.concatenate([w + start for w, start in zip(which, rest.offsets.to_numpy())])
            # The end stands after each text, so also before the next.
            near = shared.value[np.concatenate(([0], units_))].astype(np.int32)
            at = np.flatnonzero(units_ > held)
            yield pa.RecordBatch.from_arrays([rest.values.take(pa.array(words)), pa.array(near[at + 2] * k + near[at])], ["word", "near"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("near")
            if not len(lists):
                continue
            start, near = lists.offsets.to_numpy(), lists.values.to_numpy()
            found = np.empty(len(lists), np.int32)
            # Some words at a time, with about so many neighbours.
            cuts = np.unique(np.append(np.searchsorted(start[:-1], np.arange(start[0], start[-1], 1 << 16)), len(lists)))
            for i, j in zip(cuts[:-1], cuts[1:]):
                here = near[start[i] : start[j]]
                found[i:j] = np.add.reduceat(gains[here // k] + gains[k + here % k], start[i:j] - start[i]).argmax(axis=1)
            columns = [batch.column("word"), pa.array(np.diff(start).astype(np.int64)), pa.array(found)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "class"])

    # No word that is not held is more frequent than those that are, so the lists are short.
    met = texts.select("units", "rest", "which").mapInArrow(neighbours, "word binary, near int")
    return met.groupBy("word").agg(F.collect_list("near").alias("near")).mapInArrow(choose, "word binary, n bigint, class int")


def best_classes(texts: DataFrame, group: np.ndarray, of: np.ndarray, table: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups met in the texts, and for each the class it gains most from.

    With table the class bigrams, moving n tokens of a group to class c raises the
    likelihood by the sum of log n(c, d) over the classes d after them, and of
    log n(d, c) over those before, less n times the logs of both margins of c, as long
    as the group is small against the class.
    """
    k = len(table)
    groups = int(group.max()) + 1
    shared = texts.sparkSession.sparkContext.broadcast((group, of))

    def keys(sequence: np.ndarray) -> np.ndarray:
        group, of = shared.value
        at, near = group[sequence[1:]], of[sequence]
        after = at[:-1] * (2 * k) + near[2:]
        return np.concatenate((at * (2 * k) + k + near[:-1], after))

    gains = gains_of(table, classes)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("near")
            if not len(lists):
                continue
            near, n = (lists.values.field(c).to_numpy() for c in ("key", "n"))
            start = lists.offsets.to_numpy()
            near, n, start = near[start[0] : start[-1]], n[start[0] : start[-1]], start[:-1] - start[0]
            found = np.add.reduceat(n[:, None] * gains[near % (2 * k)], start).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("at"), pa.array(found)], ["at", "class"])

    # A group has 2 k neighbours at most.
    counted = summed(texts, keys, groups * 2 * k)
    lists = counted.groupBy(F.floor(F.col("key") / (2 * k)).alias("at")).agg(F.collect_list(F.struct("key", "n")).alias("near"))
    found = lists.mapInArrow(choose, "at bigint, class bigint").toArrow()
    return found.column("at").to_numpy(), found.column("class").to_numpy()


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each symbol; the last two symbols have the last two classes for themselves.

    Maximises the sum of f(n(c, d)) less f of both margins, f(x) = x log x.
    """
    size = len(bigrams) - 2
    of = np.concatenate((np.arange(size) % classes, [classes, classes + 1]))
    k = classes + 2
    onehot = np.eye(k)[of]
    table = onehot.T @ bigrams @ onehot
    eye = np.eye(k, dtype=bool)
    out, into = bigrams.sum(axis=1), bigrams.sum(axis=0)
    for _ in range(sweeps):
        moved = 0
        for w in range(size):
            old, self_ = of[w], float(bigrams[w, w])
            right = np.bincount(of, bigrams[w], k)
            left = np.bincount(of, bigrams[:, w], k)
            right[old] -= self_
            left[old] -= self_
            table[old, :] -= right
            table[:, old] -= left
            table[old, old] -= self_
            rows, columns = table.sum(axis=1), table.sum(axis=0)
            gain = np.where(eye, 0, _f(table + right[None, :]) - _f(table)).sum(axis=1)
            gain += np.where(eye, 0, _f(table + left[:, None]) - _f(table)).sum(axis=0)
            diagonal = np.diag(table)
            gain += _f(diagonal + right + left + self_) - _f(diagonal)
            gain -= _f(rows + out[w]) - _f(rows) + _f(columns + into[w]) - _f(columns)
            best = int(np.argmax(gain[:classes]))
            if gain[best] <= gain[old] + 1e-9:
                best = old
            of[w] = best
            table[best, :] += right
            table[:, best] += left
            table[best, best] += self_
            moved += best != old
        if not moved:
            break
    return of


@dataclass
class Model:
    """Class of each word and ending, and log10 probabilities."""

    held: Units
    #: Classes of the units: those that are held, and of endings for words never learned.
    of: np.ndarray
    #: word, n and class of all other words.
    rest: DataFrame
    #: Tokens and different words of each class.
    class_n: np.ndarray
    class_words: np.ndarray
    n: int
    distinct: int
    transition: np.ndarray | None = None

    @cached_property
    def _listed(self) -> tuple[list[bytes], list[int], list[int]]:
        found = self.rest.orderBy(F.desc("n"), "word").toArrow()
        return tuple(found.column(c).to_pylist() for c in ("word", "n", "class"))

    @property
    def units(self) -> Units:
        """All words on the driver, to look at; nothing here uses them."""
        words, counts, _ = self._listed
        none = np.zeros_like(self.held.ending_n)
        return Units(self.held.words + words, np.concatenate((self.held.counts, counts)).astype(np.int64), self.held.endings, none, none)

    @property
    def classes(self) -> np.ndarray:
        """Classes of these units."""
        size = len(self.held.counts)
        return np.concatenate((self.of[:size], self._listed[2], self.of[size:])).astype(np.int64)


def fit(texts: DataFrame, found: Units, n: int, distinct: int) -> Model:
    """Model of numbered learning texts of n tokens and so many different ones; transitions are counted later."""
    classes = max(CLASSES, round(distinct**0.25))
    held = len(found.words)
    size = min(held, CLUSTERED)
    total = held + 2 + len(found.endings)
    symbol = np.full(total, size)
    symbol[0] = size + 1
    symbol[1 : size + 1] = np.arange(size)
    head = exchange(count_bigrams(texts, symbol, size + 2), classes)
    group = found.group
    of_group = np.full(int(group.max()) + 1, classes)
    of_group[0] = classes + 1
    of_group[1 : size + 1] = head[:size]
    for _ in range(ROUNDS):
        table = count_bigrams(texts, of_group[group], classes + 2)
        at, best = best_classes(texts, group, of_group[group], table, classes)
        moves = at > size
        of_group[at[moves]] = best[moves]
    tokens_ = np.concatenate((found.counts, found.ending_n, [0]))
    # What was never met goes with most of the words that are not held, or with most words.
    left = of_group == classes
    settled = of_group[group] < classes
    rare = settled & ((np.arange(total) > held) if settled[held + 1 :].any() else True)
    of_group[left] = np.bincount(of_group[group][rare], tokens_[rare], classes).argmax()
    of = of_group[group]
    table = count_bigrams(texts, of, classes + 2)
    rest = write_staged(place_rest(texts, of, held, table, classes), "rest")
    after = max(min(held, OWN), size)
    if held > after:
        # Each of these for itself, all others as one.
        units_ = np.arange(total)
        at, best = best_classes(texts, np.where((units_ > after) & (units_ <= held), units_ - after, 0), of, table, classes)
        of = of.copy()
        of[at[at > 0] + after] = best[at > 0]
    class_n, class_words = (np.bincount(of[: held + 1], x, classes + 2) for x in (found.counts, np.ones(held + 1)))
    for row in rest.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        class_n[row["class"]] += row["n"]
        class_words[row["class"]] += row["words"]
    return Model(found, of, rest, class_n, class_words, n, distinct)


def classed(texts: DataFrame, model: Model) -> DataFrame:
    """The class of each token, packed as units, and all of a text's score but the transitions.

    Words that are not held meet their counts and classes in a join.
    """
    words = texts.select("row", F.posexplode("rest").alias("i", "word")).join(model.rest, "word")
    words = words.groupBy("row").agg(F.collect_list(F.struct("i", "n", "class")).alias("words"))
    counts = model.held.counts
    bottom = model.class_n + 0.5 * (model.class_words + 1)
    whole = model.n + 0.5 * (model.distinct + 1)
    shared = texts.sparkSession.sparkContext.broadcast((counts, model.of))
    held = len(counts) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, of = shared.value
        counts_ = np.concatenate((counts, np.zeros(len(of) - len(counts), np.int64)))
        for batch in slices(batches):
            out, packed = [], []
            lists = batch.column("words")
            first = lists.offsets.to_numpy()
            places, ns, classes = (lists.values.field(c).to_numpy() for c in ("i", "n", "class"))
            for j, (units_, which) in enumerate(zip(batch.column("units").to_pylist(), batch.column("which").to_pylist())):
                at, which = np.frombuffer(units_, np.int32), np.frombuffer(which, np.int32)
                here, count = of[at], counts_[at]
                if len(which) and first[j + 1] > first[j]:
                    met = slice(first[j], first[j + 1])
                    n, class_ = np.zeros((2, which.max() + 1), np.int64)
                    n[places[met]], class_[places[met]] = ns[met], classes[met]
                    rest = np.flatnonzero(at > held)
                    known = n[which] > 0
                    count[rest[known]], here[rest[known]] = n[which[known]], class_[which[known]]
                base = np.log10((count + 0.5) / whole).sum()
                emission = np.log10((count + 0.5) / bottom[here])[at != 0].sum()
                out.append((len(at), int((count > 0).sum()), float(base), float(emission)))
                packed.append(here.astype(np.int32).tobytes())
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            columns = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 4, kinds)]
            ids = [batch.column(c) for c in ("doc_id", "held_out")]
            names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "emission", "units"]
            yield pa.RecordBatch.from_arrays([*ids, *columns, pa.array(packed, pa.binary())], names)

    schema = f"doc_id {id_type(texts)}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, emission double, units binary"
    rows = texts.drop("rest").join(words, "row", "left").select("doc_id", "held_out", "units", "which", "words")
    return rows.mapInArrow(run, schema)


def moved(texts: DataFrame, transition: np.ndarray) -> DataFrame:
    """Classed texts with the log10 probability of their transitions."""
    end = len(transition) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for packed in batch.column("units").to_pylist():
                here = np.frombuffer(packed, np.int32)
                out.append(float(transition[np.concatenate(([end], here[:-1])), here].sum()))
            columns = [*(c for c, name in zip(batch.columns, batch.schema.names) if name != "units"), pa.array(out, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*(name for name in batch.schema.names if name != "units"), "moves"])

    schema = f"doc_id {id_type(texts)}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, emission double, moves double"
    return texts.mapInArrow(run, schema)


def learn(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame, Model]:
    """All texts with the classes of their tokens, the counts of words, and the model of the learning texts."""
    rows = id_text(docs, id_column, text_column).withColumn("held_out", is_crc_remainder(F.col("doc_id"), 5, 1))
    words = write_staged(count_words(rows.filter("not held_out")), "words")
    n, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    found = units(words)
    texts = write_staged(numbered(rows, found), "numbered")
    model = fit(texts.filter("not held_out"), found, int(n), int(distinct))
    texts = write_staged(classed(texts, model), "classed")
    k = len(model.class_n)
    # The packed units of classed texts are classes; a sequence begins after the end.
    table = count_bigrams(texts.filter("not held_out"), np.arange(k), k, first=k - 1)
    transition = np.log10((table + 0.5) / (table.sum(axis=1, keepdims=True) + 0.5 * k))
    return texts, words, replace(model, transition=transition)


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Learn from the texts whose id's crc32 leaves no 1 modulo 5, and score all."""
    texts, _, model = learn(docs, id_column, text_column)
    return (
        moved(texts, model.transition)
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(model.n).cast("bigint").alias("train_tokens"),
            "base_score",
            (F.col("emission") + F.col("moves")).alias("score"),
        )
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
    )
