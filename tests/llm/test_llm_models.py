"""Near duplicates, languages, class bigrams and the quality classifier."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from textsieve.llm import brown, cotrain, langid, minhash
from textsieve.llm import components as components_module
from textsieve.llm.components import components, joined_by

FOLDER = "/root/testdata/sf0.01"


def brute_components(texts, length, percent=80):
    sets = [frozenset(s.tolist()) for s in minhash.shingle_sets(texts, length)]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


def families(prose, seed, count, size):
    """Originals and copies with more and more words changed."""
    rng = random.Random(seed)
    texts = []
    for f in range(count):
        words = prose(seed * 1000 + f, 120).split()
        for k in range(size):
            copy = list(words)
            for at in rng.sample(range(len(copy)), rng.randint(0, 12)):
                copy[at] = f"w{f}x{k}y{at}"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("length", [2, 5])
def test_components_of_near_copies(make_docs, prose, length):
    texts = families(prose, length, 6, 25) + ["", "one", "ONE", "one two", " one  two ", "a b c", None]
    expected, sizes = brute_components(texts, length)
    rows = {r["doc_id"]: r for r in minhash.near_duplicates(make_docs(texts), length).collect()}
    assert [rows[i]["component_id"] for i in range(len(texts))] == expected
    assert [rows[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert all(rows[i]["kept"] == (expected[i] == i) for i in range(len(texts)))


def test_families_at_the_border(spark, make_docs, prose):
    """Texts so far from a family's hub that only what they share besides tells whether they are near."""
    rng = random.Random(5)
    base = prose(77, 120).split()
    texts = []
    for most in [4] * 60 + [14] * 60 + [20] * 30:
        words = list(base)
        for at in rng.sample(range(0, len(base), 2), rng.randint(0, most)):
            words[at] = f"n{at}" if rng.random() < 0.7 else f"o{rng.random()}"
        texts.append(" ".join(words))
    texts += families(prose, 8, 2, 6)
    expected, _ = brute_components(texts, 2)
    rows = {r["doc_id"]: r for r in minhash.near_duplicates(make_docs(texts), 2).collect()}
    assert [rows[i]["component_id"] for i in range(len(texts))] == expected
    assert 10 < len(set(expected)) < len(texts) - 10

    # All texts around one main component, whatever their buckets; the others are still alone.
    sets = minhash.sets_of(make_docs(texts), 2)
    label = [0 if i < 60 and expected[i] == 0 else i for i in range(len(texts))]
    around = spark.createDataFrame([(i, c, 0, 1) for i, c in enumerate(label)], "doc_id bigint, component_id bigint, main bigint, n bigint")
    pairs = minhash.across(around, sets, 80)
    listed = [frozenset(s.tolist()) for s in minhash.shingle_sets(texts, 2)]
    for r in pairs.collect():
        assert r["a"] < r["b"] and label[r["a"]] != label[r["b"]]
    known = spark.createDataFrame([(c, i) for i, c in enumerate(label) if c != i], "a bigint, b bigint")
    links = known.union(minhash.confirm(pairs, sets, 80))
    found = {r["id"]: r["component_id"] for r in components(links).collect()}
    assert [found.get(i, i) for i in range(len(texts))] == expected
    far = sum(label[i] != label[j] for i in range(len(listed)) for j in range(i))
    assert pairs.count() < far / 5


def test_links_added_later_and_rounds(spark, monkeypatch):
    """Later links go through rounds as links of components, and stars go through none."""
    written = []
    write = components_module.write_staged
    monkeypatch.setattr(components_module, "write_staged", lambda df, name: written.append(name) or write(df, name))

    def table(links):
        return spark.createDataFrame(links, "a bigint, b bigint")

    stars = [(10, 11), (10, 12), (20, 21), (20, 22), (30, 31)]
    found = write(components(table(stars)), "found")
    assert written == ["edges"]
    chain = [(12, 22), (21, 31), (5, 31), (50, 51), (11, 12)]
    of = {r["id"]: r["component_id"] for r in joined_by(found, table(chain)).collect()}
    assert of == {r["id"]: r["component_id"] for r in components(table(stars + chain)).collect()}
    assert of == {**dict.fromkeys([5, 10, 11, 12, 20, 21, 22, 30, 31], 5), 50: 50, 51: 50}
    same = joined_by(found, table([(11, 12), (31, 30)])).collect()
    assert sorted(same) == sorted(found.collect())


def test_shingles():
    sets = minhash.shingle_sets(["A b c", "a B", "b c", "a", "", None, "c a b c"], 2)
    assert [len(s) for s in sets] == [2, 1, 1, 1, 0, 0, 3]
    assert set(sets[0].tolist()) == set(sets[1].tolist()) | set(sets[2].tolist())
    assert set(sets[2].tolist()) < set(sets[6].tolist())


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(1, 1 << 63, 1000, dtype=np.uint64)
    for common in (200, 500, 800):
        a, b = pool[:900], pool[900 - common :]
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((minhash.signature(a) == minhash.signature(b)).mean() - exact) < 0.12


def test_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 130)] + [(7, x) for x in range(200, 260)] + [(3, 3), (5, 4), (4, 5), (None, 1)]
    found = {r["id"]: r["component_id"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{i: 100 for i in range(100, 131)}, **{i: 7 for i in [7, *range(200, 260)]}, 4: 4, 5: 4}


def test_language_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in rows) > 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def brute_ranking(texts):
    counts = Counter()
    for text in texts:
        codes = langid.symbols(text).tolist()
        for n in (1, 2, 3):
            for i in range(len(codes) - n + 1):
                gram = codes[i : i + n]
                if gram != [1]:
                    counts[sum(c << 10 * (n - 1 - k) for k, c in enumerate(gram))] += 1
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: langid.PROFILE]]


def test_profiles_and_distances(spark, make_docs, prose, monkeypatch):
    texts = {"en": [prose(i, 50) for i in range(4)], "xx": [prose(i, 40).replace("a", "ö") for i in range(4, 8)]}
    monkeypatch.setattr(langid, "BLOCK", 100)
    rows = [(text, lang) for lang, of in texts.items() for text in of] + [(None, "en"), ("text", None)]
    profiles = langid.learn_profiles(spark.createDataFrame(rows, "text string, lang string"))
    assert profiles == {lang: brute_ranking(of) for lang, of in texts.items()}
    text = prose(9, 20)
    own = brute_ranking([text])
    expected = [
        sum(min(abs(i - p.index(g)), langid.PROFILE) if g in p else langid.PROFILE for i, g in enumerate(own)) for p in profiles.values()
    ]
    model = langid.Profiles(profiles)
    assert model.distances(langid.ranked(*langid.gram_counts([text]))).copy() == expected
    assert model.predict(text)[0] == list(profiles)[int(np.argmin(expected))]


def test_base_score(make_docs, prose, monkeypatch):
    """With few words held in tasks, most meet their counts in the join."""
    monkeypatch.setattr(brown, "LOOKUP", 20)
    monkeypatch.setattr(brown, "CLUSTERED", 10)
    texts = [prose(i, 40).upper() + " end x \x1c y" for i in range(40)] + ["", None]
    counts = Counter()
    for i, text in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(brown.tokens(text))
    n, v = sum(counts.values()), len(counts)
    for row in brown.score(make_docs(texts)).collect():
        words = brown.tokens(texts[row["doc_id"]])
        assert row["n_tokens"] == len(words)
        assert row["n_known"] == sum(counts[w] > 0 for w in words)
        assert row["train_tokens"] == n
        assert row["base_score"] == pytest.approx(sum(log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words), abs=1e-9)
        assert row["score"] < 0


@pytest.mark.parametrize("lookup, own", [(15, 5), (60, 30), (10_000, 10_000)])
def test_score_is_the_sum_of_transitions_and_emissions(make_docs, prose, monkeypatch, lookup, own):
    """Counted anew from the texts, with nothing but the class of each word taken from the model."""
    for name, value in {"LOOKUP": lookup, "OWN": own, "CLUSTERED": 10, "CLASSES": 3}.items():
        monkeypatch.setattr(brown, name, value)
    vocabulary = prose(1, 60).split()
    rng = random.Random(3)
    texts = [" ".join(rng.choice(vocabulary[: 5 + i]) for _ in range(30)) + f" new{i} z" for i in range(40)] + ["", None, "never met"]
    docs = make_docs(texts)
    _, _, model = brown.learn(docs)
    words = model.units.words
    number = {b"": 0, **{w: i + 1 for i, w in enumerate(words)}}
    last = {e: len(words) + 1 + i for i, e in enumerate(model.units.endings)}

    def of(word):
        return model.classes[number.get(word, last.get(word[-2:], len(model.classes) - 1))]

    learned = [brown.tokens(t) for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for t in learned for w in t)
    pairs = Counter((of(a), of(b)) for t in learned for a, b in zip([b"", *t], t))
    before = Counter()
    for (a, _), n in pairs.items():
        before[a] += n
    size, distinct = Counter(), Counter()
    for w, n in counts.items():
        size[of(w)] += n
        distinct[of(w)] += 1
    assert all(of(w) < 3 for w in counts if w)
    for row in brown.score(docs).collect():
        words_ = brown.tokens(texts[row["doc_id"]])
        move = sum(log10((pairs[of(a), of(b)] + 0.5) / (before[of(a)] + 0.5 * 5)) for a, b in zip([b"", *words_], words_))
        emit = sum(log10((counts[w] + 0.5) / (size[of(w)] + 0.5 * (distinct[of(w)] + 1))) for w in words_ if w)
        assert row["score"] == pytest.approx(move + emit, abs=1e-9)


def test_later_words_join_the_class_of_their_neighbours(make_docs, monkeypatch):
    """Words of two kinds that always alternate; the rare ones are placed after the exchange."""
    monkeypatch.setattr(brown, "CLUSTERED", 8)
    monkeypatch.setattr(brown, "CLASSES", 2)
    rng = random.Random(4)
    kinds = [[f"{k}{i}{k}" for i in range(30)] for k in "xy"]
    weights = [1 / (i + 1) for i in range(30)]
    texts = []
    for _ in range(120):
        at = rng.randint(0, 1)
        texts.append(" ".join(rng.choices(kinds[(at + k) % 2], weights)[0] for k in range(40)))
    _, _, model = brown.learn(make_docs(texts))
    found = {kind: {int(model.classes[i + 1]) for i, w in enumerate(model.units.words) if w.decode()[0] == kind} for kind in "xy"}
    assert len(model.units.words) > 40
    assert not found["x"] & found["y"]


def test_words_of_one_ending_have_classes_of_their_own(make_docs, monkeypatch):
    """Two kinds that always alternate, all words with the same ending, most of them beyond those held."""
    for name, value in {"LOOKUP": 8, "OWN": 6, "CLUSTERED": 4, "CLASSES": 2}.items():
        monkeypatch.setattr(brown, name, value)
    rng = random.Random(6)
    kinds = [[f"{k}{i}zz" for i in range(30)] for k in "xy"]
    weights = [3 if i < 4 else 0.2 for i in range(30)]
    texts = []
    for _ in range(150):
        at = rng.randint(0, 1)
        texts.append(" ".join(rng.choices(kinds[(at + k) % 2], weights)[0] for k in range(40)))
    _, _, model = brown.learn(make_docs(texts))
    found = {row["word"].decode()[:1]: set() for row in model.rest.collect()}
    for row in model.rest.collect():
        found[row["word"].decode()[:1]].add(row["class"])
    assert model.rest.count() > 40
    assert len(found["x"]) == len(found["y"]) == 1 and found["x"] != found["y"]
    counts = Counter(w for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1 for w in brown.tokens(t))
    assert all(row["n"] == counts[bytes(row["word"])] for row in model.rest.collect())


def likelihood(bigrams, of, k):
    onehot = np.eye(k)[of]
    table = onehot.T @ bigrams @ onehot
    f = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
    return f(table) - f(table.sum(axis=0)) - f(table.sum(axis=1))


def test_exchange_finds_classes():
    """Words of two kinds that always alternate."""
    rng = np.random.default_rng(2)
    size = 12
    bigrams = np.zeros((size + 2, size + 2), np.int64)
    for _ in range(4000):
        a = rng.integers(size)
        b = rng.integers(size // 2) * 2 + (1 - a % 2)
        bigrams[a, b] += 1
    start = np.concatenate((np.arange(size) % 2, [2, 3]))
    shuffled = np.concatenate((rng.integers(0, 2, size), [2, 3]))
    of = brown.exchange(bigrams, classes=2, sweeps=20)
    assert len({tuple(sorted(set(of[:size][i::2]))) for i in (0, 1)}) == 2
    assert likelihood(bigrams, of, 4) >= likelihood(bigrams, shuffled, 4)
    assert likelihood(bigrams, of, 4) == pytest.approx(likelihood(bigrams, start, 4))


def test_class_model_beats_words_alone(spark):
    rows = brown.score(spark.read.parquet(f"{FOLDER}/documents.parquet")).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = cotrain.score_quality(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum(r["kept"] == (r["quality"] == 1) for r in held) > 0.93 * len(held)
    assert all(0 <= r[c] <= 1 for r in rows for c in ("text_score", "meta_score", "score"))


def test_no_labels(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    rows = cotrain.score_quality(make_docs(["a text", "b text"]), labels).collect()
    assert [(r["score"], r["kept"]) for r in rows] == [(0.5, True)] * 2
