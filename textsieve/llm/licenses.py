"""License scans by a positional index of rare licence words.

Only column functions run here. The licence words are those of the templates;
their document frequencies are counted over all documents. The index holds, for
each template, the two words of highest IDF of its mandatory key phrase, with
their places in the template. A file looks up all places of these words: a word
at place i of the file and place j of a template says that the template would
start at i - j. Starts on which both words agree are verified: the key phrase
has to stand there, and enough of the template's other words. A template that
stands in a file has its key phrase in place, so that both words always agree
and none is lost; its beginning may even be cut off.

Results, row by row: null text counts as empty and has no labels, an empty
string, score 0 and null places. Null or repeated ids and repeated rows are
scanned like any other. An empty table gives an empty result. Other columns are
not looked at, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from textsieve.llm.common import let
from textsieve.staging import write_staged

#: Lower-case words: runs of digits, small letters and anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that label a document by themselves.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label, template, key phrase that must stand in it. Any table of this form can take its place.
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software",
        "permission is hereby granted free of charge to any person obtaining a copy",
    ),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
        "the above copyright notice and this permission notice appear in all copies",
        "permission to use copy modify and or distribute this software for any purpose",
    ),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    (
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "you may not use this file except in compliance with the license",
    ),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    (
        "gpl-3",
        "it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        "gnu general public license as published by the free software foundation either version 3",
    ),
    (
        "gpl-2",
        "it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
        "gnu general public license as published by the free software foundation either version 2",
    ),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
        "subject to the terms of the mozilla public license v 2",
    ),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software released into the public domain"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright and related or neighboring rights"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
]
Templates = list[tuple[str, str, str]]
#: Words of a key phrase that are looked up, and the least share of a template's words in place.
RARE_WORDS = 2
LEAST_SHARE = 0.6


def vocabulary(templates: Templates) -> list[str]:
    return sorted({word for _, template, _ in templates for word in template.split()})


def key_offset(template: str, key: str) -> int:
    """The place of the key phrase in its template."""
    parts, own = template.split(), key.split()
    for i in range(len(parts) - len(own) + 1):
        if parts[i : i + len(own)] == own:
            return i
    raise ValueError(f"{key!r} is not in its template")


def _anchored(text: Column, templates: Templates) -> Column:
    """Whether a text holds the longest word of some phrase or key phrase; all that have a label do."""
    words = {max(phrase.split(), key=len) for phrase in [*PHRASES, *(key for _, _, key in templates)]}
    # A word within another needs no place of its own in the pattern.
    needed = sorted(word for word in words if not any(other != word and other in word for other in words))
    return text.rlike("|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in needed))


def scan_table(docs: DataFrame, id_column: str, text_column: str, templates: Templates) -> DataFrame:
    """One pass over the texts: words counted, licence words present, and the words
    of texts that hold an anchor."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))
    # Lower-casing beyond A-Z moves no word border: both forms of a letter are word characters.
    rows = rows.select("*", F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)).alias("lowered"))
    plain = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return rows.select(
        "doc_id",
        F.size("lowered").cast("bigint").alias("n_words"),
        F.array_intersect("lowered", F.array(*map(F.lit, vocabulary(templates)))).alias("licence_words"),
        F.when(_anchored(F.col("text"), templates), F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))).alias("words"),
    )


def document_frequencies(scanned: DataFrame) -> dict[str, int]:
    """Documents with each licence word; as many entries as the templates have words."""
    words = scanned.select(F.explode("licence_words").alias("word")).groupBy("word").count()
    return {r["word"]: r["count"] for r in words.collect()}


def phrase_places(words: Column, phrase: str) -> Column:
    """Where the words of phrase stand consecutively, from 0."""
    parts = phrase.split()
    starts = F.transform(words, lambda w, i: F.when(w == parts[0], i))
    return F.filter(
        starts, lambda i: i.isNotNull() & F.coalesce(F.slice(words, i + 1, len(parts)) == F.array(*map(F.lit, parts)), F.lit(False))
    )


def rare_postings(templates: Templates, frequency: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """For each word looked up, the templates it stands for and its places in their key phrases."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, (_, template, key) in enumerate(templates):
        parts, offset = key.split(), key_offset(template, key)
        rarest = sorted(set(parts), key=lambda word: (frequency.get(word, 0), word))[:RARE_WORDS]
        for j, word in enumerate(parts):
            if word in rarest:
                postings.setdefault(word, []).append((t, offset + j))
    return postings


def template_matches(words: Column, templates: Templates, frequency: dict[str, int]) -> Column:
    """label and share of each template verified at a start on which its rare words agree."""
    postings = rare_postings(templates, frequency)
    index = F.create_map(
        *[
            x
            for word, places in sorted(postings.items())
            for x in (F.lit(word), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(j).alias("j")) for t, j in places]))
        ]
    )
    table = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.array(*map(F.lit, template.split())).alias("parts"),
                F.array(*map(F.lit, key.split())).alias("key"),
                F.lit(key_offset(template, key)).alias("offset"),
                F.lit(min(RARE_WORDS, len(set(key.split())))).alias("words"),
            )
            for label, template, key in templates
        ]
    )
    placed = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    found = F.filter(placed, lambda x: x["w"].isin(*postings))
    votes = F.flatten(
        F.transform(
            found,
            lambda x: F.transform(F.element_at(index, x["w"]), lambda p: F.struct(p["t"].alias("t"), (x["i"] - p["j"]).alias("s"), x["w"].alias("w"))),
        )
    )

    def agreed(v: Column) -> Column:
        """Of the different words that vote for one start, sorted, the last needed one."""

        def same(x: Column, k: Column) -> Column:
            before = F.get(v, k)
            return F.coalesce((before["t"] == x["t"]) & (before["s"] == x["s"]), F.lit(False))

        needed = lambda x: F.element_at(table, x["t"] + 1)["words"]
        return F.filter(v, lambda x, k: F.when(needed(x) == 1, F.lit(True)).otherwise(same(x, k - 1) & ~same(x, k - 2)))

    def check(x: Column) -> Column:
        def verified(template: Column) -> Column:
            there = F.transform(template["parts"], lambda part, j: F.coalesce((F.get(words, x["s"] + j) == part).cast("int"), F.lit(0)))
            share = F.aggregate(there, F.lit(0), lambda a, b: a + b) / F.size(template["parts"]).cast("double")
            at = x["s"] + template["offset"]
            holds = (at >= 0) & (F.slice(words, F.greatest(at, F.lit(0)) + 1, F.size(template["key"])) == template["key"])
            return F.when(holds, F.struct(template["label"].alias("label"), share.alias("share")))

        return let(F.element_at(table, x["t"] + 1), verified)

    starts = let(F.array_sort(F.array_distinct(votes)), agreed)
    return F.filter(F.transform(starts, check), lambda x: x["share"] >= LEAST_SHARE)


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: Templates = TEMPLATES) -> DataFrame:
    """Places of the phrases, their labels, and the labels of templates found by the index."""
    scanned = write_staged(scan_table(docs, id_column, text_column, templates), "licence-words")
    frequency = document_frequencies(scanned)
    none = F.array().cast("array<int>")
    rows = scanned.withColumns(
        {
            "places": F.array(
                *[
                    F.struct(F.lit(label).alias("label"), F.coalesce(phrase_places(F.col("words"), phrase), none).alias("at"))
                    for phrase, label in PHRASES.items()
                ]
            ),
            "found": F.coalesce(
                template_matches(F.col("words"), templates, frequency),
                F.array().cast("array<struct<label:string,share:double>>"),
            ),
        }
    )
    starts = F.flatten(F.transform("places", lambda x: x["at"]))
    base = F.transform(F.filter("places", lambda x: F.size(x["at"]) > 0), lambda x: x["label"])
    own = F.transform("found", lambda x: x["label"])

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    share = F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0))
    return rows.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"),
        F.array_max(starts).cast("bigint").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, own)).alias("labels"),
        F.when(F.size(starts) > 0, 1.0).otherwise(share).alias("score"),
    )
