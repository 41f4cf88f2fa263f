"""Rules, licences, lines and leaks against plain Python."""

from __future__ import annotations

import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textsieve.llm import decontaminate, licenses, lines, rules
from textsieve.llm.decontaminate import Items, align, find, normal


def repeated(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)})


def test_measures(make_docs, prose):
    rng = random.Random(1)
    texts = ["", "one", "a b c a b c", "x " * 40, "a\tb\x0bc\x0c\r\nd e # $$ <b>|&%*", "same line\n\n same line\nsame line\n \n"]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    texts += [prose(i, 60) + "\n" + prose(i, 10) for i in range(5)]
    for row in rules.quality_rules(make_docs(texts)).collect():
        text = texts[row["doc_id"]]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        split = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert row["n_words"] == len(words)
        assert row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert row["n_dup_lines"] == len(split) - len(set(split))
        assert row["n_repeat_words"] == repeated(words)
        assert row["base_failed"] == (len(words) < 50 or 100 * repeated(words) > 50 * len(words))


def test_shared_lines_deplete(make_docs, prose):
    shared = prose(7, 55)
    texts = [shared.upper().lower() + "\n" + prose(100 + i, 5) for i in range(30)]  # little of their own
    texts += ["  " + shared.replace(" ", "  ") + "\n" + prose(200 + i, 70) for i in range(10)]  # enough left
    texts += [prose(300, 80)] * 40  # copies of one text are no boilerplate
    rows = {r["doc_id"]: r for r in rules.quality_rules(make_docs(texts)).collect()}
    assert not any(rows[i]["kept"] for i in range(30))
    assert all(rows[i]["kept"] and rows[i]["words_left"] == 70 for i in range(30, 40))
    assert all(rows[i]["kept"] and rows[i]["words_left"] == 80 for i in range(40, 80))


LICENCE_TEXTS = [
    "Released under the MIT License.",
    "under the mit license under the MIT license",
    "Licensed under the Apache License, Version 2.0.",
    "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "All rights reserved.",
    "the license of mit is under the table",
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "nothing here",
    "undér the mit license",
    "cc  by\nnc and apache license version 2 x",
]


def test_license_scan(make_docs):
    phrases = {tuple(p.split()): label for p, label in licenses.PHRASES.items()}
    rows = {r["doc_id"]: r for r in licenses.license_scan(make_docs(LICENCE_TEXTS)).collect()}
    for i, text in enumerate(LICENCE_TEXTS):
        lowered = text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
        words = re.findall(licenses.WORD, lowered)
        places = [(k, label) for k in range(len(words)) for p, label in phrases.items() if tuple(words[k : k + len(p)]) == p]
        at = [k for k, _ in places]
        row = rows[i]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert (row["first_word"], row["last_word"]) == ((min(at), max(at)) if at else (None, None))
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1
    assert [rows[i]["labels"] for i in (4, 5, 6, 7, 8)] == ["gpl-3", "all-rights-reserved", "", "mit", ""]


BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted."


def brute_labels(text, templates):
    words = re.findall(licenses.WORD, text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))
    labels = {label for phrase, label in licenses.PHRASES.items() if f" {phrase} " in f" {' '.join(words)} "}
    for label, template, key in templates:
        parts, own = template.split(), key.split()
        offset = licenses.key_offset(template, key)
        for i in range(len(words)):
            if words[i : i + len(own)] == own:
                there = sum(0 <= i - offset + j < len(words) and words[i - offset + j] == part for j, part in enumerate(parts))
                if there / len(parts) >= licenses.LEAST_SHARE:
                    labels.add(label)
    return ",".join(sorted(labels))


def test_no_template_is_lost(make_docs, prose):
    """Several licences in a file, common words, templates with their beginning cut off, whole templates in prose."""
    texts = ["All rights reserved."] * 30 + [f"{BSD} text. All rights reserved."]
    texts += [template for _, template, _ in licenses.TEMPLATES]
    texts += [f"{prose(i, 30)} {template.title()}, {prose(50 + i, 30)}" for i, (_, template, _) in enumerate(licenses.TEMPLATES)]
    texts += [" ".join(template for _, template, _ in licenses.TEMPLATES), "use in source and binary forms with or without modification are permitted"]
    texts += [template.split(" ", 1)[1] for _, template, _ in licenses.TEMPLATES] + [" ".join(licenses.vocabulary(licenses.TEMPLATES) * 40)]
    rows = {r["doc_id"]: r["labels"] for r in licenses.license_scan(make_docs(texts)).collect()}
    assert rows[30] == "all-rights-reserved,bsd"
    assert rows == {i: brute_labels(text, licenses.TEMPLATES) for i, text in enumerate(texts)}


def test_many_templates(make_docs, prose):
    """A table of its own, of hundreds of templates."""
    templates = []
    for i in range(300):
        words = prose(i, 12).split()
        templates.append((f"own-{i}", " ".join(words), " ".join(words[3:7])))
    texts = [f"{prose(900 + i, 20)} {templates[i][1]} {templates[299 - i][1]}" for i in range(0, 300, 7)] + ["nothing of that"]
    rows = {r["doc_id"]: r["labels"] for r in licenses.license_scan(make_docs(texts), templates=templates).collect()}
    assert rows == {i: brute_labels(text, templates) for i, text in enumerate(texts)}
    assert rows[0] == "own-0,own-299"


def brute_lines(texts, min_lines=3, long_line=20):
    """All runs in order; a run seen before loses its lines."""
    seen, gone = set(), {i: set() for i in range(len(texts))}
    for i, text in enumerate(texts):
        worded = [(k, x) for k, x in enumerate(text.split("\n")) if x.split()] if text else []
        for k, (number, line) in enumerate(worded):
            runs = [worded[k : k + min_lines]] if k + min_lines <= len(worded) else []
            if len(line.split()) >= long_line:
                runs.append(worded[k : k + 1])
            for run in runs:
                key = tuple(x for _, x in run)
                if key in seen:
                    gone[i] |= {n for n, _ in run}
                seen.add(key)
    return ["\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) if gone[i] else t for i, t in enumerate(texts)]


def test_line_dedup(make_docs, prose):
    rng = random.Random(9)
    texts = ["\n".join(rng.choice(["a", "b", "c", "", "d e"]) for _ in range(rng.randint(0, 9))) for _ in range(60)]
    texts += [prose(1, 30), prose(2, 30) + "\n" + prose(1, 30), "x\n\ny\nz", "x\ny\n \nz\nw"]
    rows = lines.line_dedup(make_docs(texts))[0].orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == brute_lines(texts)


@pytest.mark.parametrize("min_lines", [1, 2, 5])
def test_other_run_lengths(make_docs, min_lines):
    rng = random.Random(min_lines)
    texts = ["\n".join(rng.choice("abc") for _ in range(rng.randint(0, 15))) for _ in range(40)]
    rows = lines.line_dedup(make_docs(texts), min_lines=min_lines)[0].orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == brute_lines(texts, min_lines)


def edits(a, b):
    """Least edits between a and any part of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_every_item_within_its_edits_is_found(prose):
    rng = random.Random(4)
    texts = [normal(prose(50 + i, 30)) for i in range(6)]
    items = Items(list(enumerate(texts)))
    for trial in range(120):
        i = rng.randrange(len(texts))
        changed = bytearray(texts[i])
        for _ in range(rng.randint(0, int(items.edits[i]) + 2)):
            at = rng.randrange(len(changed))
            rng.choice([lambda: changed.insert(at, 120), lambda: changed.pop(at), lambda: changed.__setitem__(at, 120)])()
        text = normal(prose(1000 + trial, rng.randint(0, 30))) + bytes(changed) + normal(prose(3000 + trial, rng.randint(0, 30)))
        least = edits(texts[i], text)
        found = [(j, n) for j, _, _, n in find(items, text)]
        assert ((i, least) in found) == (least <= items.edits[i])
        assert all(j == i for j, _ in found)


def test_align_gives_the_place():
    import numpy as np

    item, region = (np.frombuffer(x, np.uint8) for x in (b"abcdef", b"xxabXdefyy"))
    assert align(item, region) == (1, 2, 8)


def test_leaks_and_blocks(spark, make_docs, prose, monkeypatch):
    items = [(i, prose(500 + i, 40)) for i in range(5)]
    texts = [prose(1, 50), prose(2, 20) + " " + items[3][1].upper() + " " + prose(3, 9), items[0][1] + "\n" + items[4][1].replace(" ", "\n")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(make_docs(texts), benchmark).collect()}
    assert found == {(1, 3), (2, 0), (2, 4)}
    assert [r["doc_id"] for r in decontaminate.decontaminate(make_docs(texts), benchmark).collect()] == [0]


def test_lines_above_a_limit_of_documents_in_a_large_host(make_docs, prose):
    """The limit does not rise with the host if it is a number of documents alone."""
    footer = prose(8, 70)
    texts = [prose(1000 + i, 60) + ("\n" + footer if i % 20 == 0 else "") for i in range(480)]  # 24 of 240 in src0
    docs = make_docs(texts)
    left = {r["doc_id"]: r["words_left"] for r in rules.quality_rules(docs).collect()}
    assert set(left.values()) == {60}
    left = {r["doc_id"]: r["words_left"] for r in rules.quality_rules(docs, line_percent=20).collect()}
    assert sorted(set(left.values())) == [60, 130]


def test_limit_in_a_host_of_ten_thousand_documents(spark, prose):
    """A footer of 11 among 10,000 documents goes, one of 10 stays; rows of one id are one document."""
    filler = prose(9, 50)
    rows = spark.range(10_000).selectExpr("id AS doc_id", f"concat('{filler} ', id) AS text", "'host' AS source")
    eleven, ten = prose(10, 130), prose(11, 130)
    rows = rows.withColumn("text", F.when(F.col("doc_id") < 11, F.concat("text", F.lit("\n" + eleven))).otherwise(F.col("text")))
    rows = rows.withColumn("text", F.when((F.col("doc_id") > 100) & (F.col("doc_id") <= 110), F.concat("text", F.lit("\n" + ten))).otherwise(F.col("text")))
    rows = rows.union(rows.filter("doc_id = 101").withColumn("text", F.concat("text", F.lit(" \nmore"))))
    found = {(r["doc_id"], r["words_left"]): r["kept"] for r in rules.quality_rules(rows).filter("doc_id <= 110").collect()}
    assert all(found[i, 51] is False for i in range(11))  # depleted: 51 of 181 words are left
    assert all(found[i, 181] for i in range(101, 111)) and found[101, 182]
    assert all(found[i, 51] for i in range(11, 101))


def test_kept_documents_lose_the_lines_above_the_limit(make_docs, prose):
    shared = prose(7, 55)
    own = [prose(100 + i, 70) for i in range(30)]
    texts = [f"{shared}\n{x}\n\n {shared.upper()} " for x in own[:15]] + [f"{x}\n{shared}\nlast {i}" for i, x in enumerate(own[15:])]
    texts += [prose(300, 80)] * 3 + [shared + "\nlittle of its own"] * 2
    rows = {r["doc_id"]: r["text"] for r in rules.keep_good(make_docs(texts).repartition(2)).collect()}
    assert rows == {
        **{i: own[i] + "\n" for i in range(15)},
        **{15 + i: f"{x}\nlast {i}" for i, x in enumerate(own[15:])},
        **{i: texts[i] for i in range(30, 33)},
    }


def test_pipeline_stage_of_rules_renews_the_length(spark, make_docs, prose):
    import corpus_pipeline

    texts = [prose(100 + i, 70) + "\n" + prose(7, 10) for i in range(30)]
    rows = corpus_pipeline.quality_rules(spark, make_docs(texts), "").collect()
    assert len(rows) == 30
    assert all(r["text"] == prose(100 + r["doc_id"], 70) and r["n_chars"] == len(r["text"]) for r in rows)


def test_short_items_are_found(spark, make_docs, prose):
    items = ["17 * 23 = ?", "is it so", "\u56db\u4e2a\u5b57", "caf\u00e9", "a", "what is a noun?", "name the capital of it", "  "]
    texts = ["So 17 * 23 = ? he asked", "this it so", "\u8fd9\u662f\u56db\u4e2a\u5b57\u5417", "two caf\u00e9s", "Caf\u00e9, caf\u00e9", "IS\tIT SO", "", "name teh capital of i"]
    texts += ["x" * 30 + " name the kapital of it", "x a_a a\u0301 (a)", "217 * 23 = ?"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = {tuple(r) for r in decontaminate.leaks(make_docs(texts), benchmark).collect()}
    assert found == {(0, 0, 3, 14, 0), (2, 2, 6, 15, 0), (4, 3, 0, 5, 0), (4, 3, 7, 12, 0), (5, 1, 0, 8, 0), (8, 6, 31, 53, 1), (9, 4, 11, 12, 0)}


def test_short_items_have_their_whole_budget(prose):
    rng = random.Random(5)
    texts = [normal(prose(700 + m, 20))[:m] for m in (19, 20, 21, 22, 23, 24, 39, 40)]
    items = Items(list(enumerate(texts)))
    assert items.edits.tolist() == [0, 1, 1, 1, 1, 1, 1, 2]
    for trial in range(160):
        i = rng.randrange(len(texts))
        changed = bytearray(texts[i])
        for _ in range(rng.randint(0, int(items.edits[i]) + 1)):
            at = rng.randrange(len(changed))
            rng.choice([lambda: changed.insert(at, 120), lambda: changed.pop(at), lambda: changed.__setitem__(at, 120)])()
        text = b"zzz " + bytes(changed) + b" zzz"
        least = edits(texts[i], text)
        assert ((i, least) in [(j, n) for j, _, _, n in find(items, text)]) == (least <= items.edits[i])
