from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from checks import queries
from textsieve.functions import pii
from textsieve.operators import entities
from textsieve.operators.language import BUCKET_DIGITS, buckets, detect_language, fit_language_profile
from textsieve.operators.toxicity import ToxicityModel, fit_toxicity, score_toxicity, toxicity_reason

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").repartition(8, "doc_id")


def halves(df):
    """A split by a hash of the id, for fitting on one part and judging on the other."""
    part = F.xxhash64("doc_id") % 2
    return df.filter(part == 0), df.filter(part != 0)


def test_language_on_held_out_rows(documents):
    fit, held_out = halves(documents)
    found = detect_language(held_out, fit_language_profile(fit), "doc_id")
    right = found.withColumnRenamed("lang", "found").join(held_out, "doc_id")
    share = right.agg(F.avg((F.col("found") == F.col("lang")).cast("double"))).first()[0]
    assert share > 0.97
    assert found.count() == held_out.count()


def test_language_does_not_depend_on_partitions(documents):
    profile = fit_language_profile(documents)
    one = detect_language(documents.coalesce(1), profile, "doc_id")
    many = detect_language(documents.repartition(16), profile, "doc_id")
    assert one.exceptAll(many).count() == 0


def test_text_without_known_words_gets_the_commonest_language(spark, documents):
    df = spark.createDataFrame([(1, ""), (2, "12345"), (3, None)], "id bigint, text string")
    found = detect_language(df, fit_language_profile(documents))
    assert {(r["id"], r["lang"]) for r in found.collect()} == {(1, "en"), (2, "en"), (3, "en")}


def test_ties_go_to_the_lower_code(spark):
    df = spark.createDataFrame([("b", "x y"), ("a", "x y")], "lang string, text string")
    probe = spark.createDataFrame([(1, "x")], "id bigint, text string")
    assert detect_language(probe, fit_language_profile(df)).first()["lang"] == "a"


def test_single_language(spark):
    df = spark.createDataFrame([("a", "x y")], "lang string, text string")
    probe = spark.createDataFrame([(1, "x")], "id bigint, text string")
    assert detect_language(probe, fit_language_profile(df)).first()["lang"] == "a"


def test_no_word_is_dropped_and_the_profile_is_bounded(documents):
    profile = fit_language_profile(documents)
    rows = profile.weights.count()
    assert 0 < rows <= 16**BUCKET_DIGITS
    seen = documents.select(F.explode(buckets(F.col("text"))).alias("bucket")).distinct()
    assert seen.join(profile.weights, "bucket", "left_anti").count() == 0


def test_toxicity_on_held_out_rows(spark, documents):
    labelled = documents.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    fit, held_out = halves(labelled)
    scored = score_toxicity(held_out, fit_toxicity(fit), "doc_id").join(held_out, "doc_id")
    counts = scored.groupBy("toxic").agg(F.avg((F.col("toxicity") > 0.7).cast("double")).alias("share"))
    share = {r["toxic"]: r["share"] for r in counts.collect()}
    assert share[1] > 0.6
    assert share[0] < 0.1


def scores(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    return [r["toxicity"] for r in score_toxicity(df, model).orderBy("id").collect()]


def test_toxicity_sums_each_word_once(spark):
    weights = spark.createDataFrame([("bad", 2000), ("worse", -500)], "word string, w bigint")
    found = scores(spark, ToxicityModel(-1000, weights), ["Bad, bad day", "worse and bad", "fine", "", None])
    assert found == pytest.approx([1 / (1 + math.exp(-x)) for x in (1.0, 0.5, -1.0, -1.0)] + [None])
    assert scores(spark, ToxicityModel(0, weights.limit(0)), ["any"]) == [0.5]


def test_toxicity_with_many_weighted_words(spark):
    """100,000 words with a weight: none is collected, and every one counts."""
    n = 100_000
    letters = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    weights = spark.range(n).select(letters.alias("word"), (F.col("id") % 7 - 3).alias("w"))
    texts = spark.range(0, n, 50).select(
        "id", F.array_join(F.transform(F.sequence("id", F.col("id") + 49), lambda i: F.translate(i.cast("string"), "0123456789", "abcdefghij")), " ").alias("text")
    )
    found = {r["id"]: r["toxicity"] for r in score_toxicity(texts, ToxicityModel(5, weights)).collect()}
    assert len(found) == n // 50
    for start in (0, 50, 77_700, 99_950):
        total = 5 + sum(i % 7 - 3 for i in range(start, start + 50))
        assert found[start] == pytest.approx(1 / (1 + math.exp(-total / 1000)))


def test_fitted_weights_stay_a_table(spark, documents):
    model = fit_toxicity(documents.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id"))
    assert model.weights.count() > 0
    assert any("toxicity-weights" in path for path in score_toxicity(documents, model, "doc_id").inputFiles())


def test_toxicity_needs_both_classes(spark):
    df = spark.createDataFrame([(1, "a b", 0)], "doc_id bigint, text string, toxic int")
    with pytest.raises(ValueError):
        fit_toxicity(df)


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.7,), (0.7000001,), (None,)], "s double")
    reasons = [r[0] for r in df.select(toxicity_reason(F.col("s"), 0.7)).collect()]
    assert reasons == [None, "toxic_content", None]


def test_gazetteer(spark):
    names = spark.createDataFrame(
        [("PERSON", "Ann"), ("PERSON", "Ann Lee"), ("LOCATION", "St. Ives"), ("PERSON", "O'Brien"), ("PERSON", "")],
        "entity string, phrase string",
    )
    texts = {
        1: "Ann Lee and Ann. Annex!",
        2: "O'Brien went to St. Ives, to St Ives",
        3: "no names",
        4: "Ann-Marie",
    }
    df = spark.createDataFrame(list(texts.items()), "id bigint, text string")
    found = {r["id"]: (r["text"], r["named"]) for r in entities.mask_gazetteer(df, names).collect()}
    assert found == {
        1: ("<PERSON> and <PERSON>. Annex!", True),
        2: ("<PERSON> went to <LOCATION>, to St Ives", True),
        3: ("no names", False),
        4: ("<PERSON>-Marie", True),
    }


def test_names_that_look_like_patterns_or_masks(spark):
    names = spark.createDataFrame(
        [("PERSON", "Ann Lee"), ("PERSON", "PERSON"), ("PERSON", r"A\Eb.c"), ("LOCATION", "a.c")], "entity string, phrase string"
    )
    df = spark.createDataFrame([(1, r"PERSON and Ann Lee, A\Eb.c, a.c but abc")], "id bigint, text string")
    row = entities.mask_gazetteer(df, names).first()
    assert row["text"] == "<PERSON> and <PERSON>, <PERSON>, <LOCATION> but abc"


def places(spark, texts, names=None):
    gazetteer = spark.createDataFrame(names, "entity string, phrase string") if names else None
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(3)
    rows = entities.pii_entities(df, gazetteer=gazetteer).collect()
    for row in rows:
        assert texts[row["id"]][row["start"] : row["end"]] == row["value"]
    return sorted((row["id"], row["start"], row["end"], row["entity"]) for row in rows)


def test_entity_table_has_places_in_the_original_text(spark):
    texts = ["a@b.co 10.0.0.1 a@b.co (743) 555-3824", "none", None, "", "é\U0001f600 x 1.2.3.4", "a@b.co,c@d.org"]
    assert places(spark, texts) == [
        (0, 0, 6, "EMAIL_ADDRESS"),
        (0, 7, 15, "IP_ADDRESS"),
        (0, 16, 22, "EMAIL_ADDRESS"),
        (0, 23, 37, "PHONE_NUMBER"),
        (4, 5, 12, "IP_ADDRESS"),
        (5, 0, 6, "EMAIL_ADDRESS"),
        (5, 7, 14, "EMAIL_ADDRESS"),
    ]


def test_a_place_belongs_to_the_first_entity_that_takes_it(spark):
    """An address inside an e-mail address is none of its own, and names overlap neither matches nor longer names."""
    names = [("PERSON", "Ann Lee"), ("PERSON", "Lee Moss"), ("LOCATION", "Lee"), ("PERSON", "bob"), ("PERSON", "1")]
    texts = ["bob@1.2.3.4 bob", "Ann Lee Moss Lee", "LeeLee Lee-Lee", "10.0.0.1 1", "Ann Lee,Ann Lee"]
    assert places(spark, texts, names) == [
        (0, 0, 11, "EMAIL_ADDRESS"),
        (0, 12, 15, "PERSON"),
        (1, 4, 12, "PERSON"),
        (1, 13, 16, "LOCATION"),
        (2, 7, 10, "LOCATION"),
        (2, 11, 14, "LOCATION"),
        (3, 0, 8, "IP_ADDRESS"),
        (3, 9, 10, "PERSON"),
        (4, 0, 7, "PERSON"),
        (4, 8, 15, "PERSON"),
    ]


def test_places_and_masks_agree(spark, documents):
    """Masking the listed places gives the masked text."""
    names = queries._names(spark, SF)
    docs = documents.select("doc_id", "text")
    found = entities.pii_entities(docs, "doc_id", gazetteer=names)
    assert found.filter("entity = 'PERSON'").count() > 0
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in found.orderBy("doc_id", F.desc("start")).collect():
        text = texts[row["doc_id"]]
        assert text[row["start"] : row["end"]] == row["value"]
        texts[row["doc_id"]] = f"{text[:row['start']]}<{row['entity']}>{text[row['end']:]}"
    patterns = docs.withColumn("text", pii.mask_patterns(F.col("text")))
    masked = entities.mask_gazetteer(patterns, names, "doc_id")
    assert {r["doc_id"]: r["text"] for r in masked.collect()} == texts


def test_pieces_make_up_the_text(apply):
    texts = ["a@b.co 10.0.0.1 x", "none", "a@b.co"]
    joined = lambda text: F.array_join(F.transform(pii.cut_patterns(text), lambda piece: piece["text"]), "")
    assert apply(joined, texts) == texts
    assert apply(lambda text: pii.masked_pieces(pii.cut_patterns(text)), texts) == apply(pii.mask_patterns, texts)


def test_names_of_many_words_do_not_multiply_the_rows(spark):
    """A text gives out at most its different words, however long the names are."""
    long = " ".join(f"part{i}" for i in range(12))
    names = spark.createDataFrame([("PERSON", long), ("PERSON", "part0 part1"), ("PERSON", "zz top")], "entity string, phrase string")
    texts = [f"so {long} said", "part0 part1 part0", "part5 only", "nothing here", "zz zz", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    hits = {r["id"]: {n["phrase"] for n in r["names"]} for r in entities.gazetteer_hits(df, names).collect()}
    assert long in hits[0] and "part0 part1" in hits[0] and "part0 part1" in hits[1] and 3 not in hits
    assert 4 not in hits  # no text holds "top", so the name is filed under it
    found = {r["id"]: r["text"] for r in entities.mask_gazetteer(df, names).collect()}
    assert found == {0: "so <PERSON> said", 1: "<PERSON> part0", 2: "part5 only", 3: "nothing here", 4: "zz zz", 5: None}


def test_names_of_frequent_words_are_no_candidates_of_every_text(spark):
    """Texts that hold all words of a name, but not side by side, do not meet it."""
    words = [f"w{i}" for i in range(20)]
    names = spark.createDataFrame([("PERSON", f"{a} {b}") for a in words for b in words if a != b], "entity string, phrase string")
    texts = [" x ".join(words), "w3 w1 x w1 w2, w2", "w1 w2" * 2, None]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    hits = {r["id"]: {n["phrase"] for n in r["names"]} for r in entities.gazetteer_hits(df, names).collect()}
    assert hits == {1: {"w3 w1", "w1 w2"}}


def test_a_name_beside_a_mask(spark):
    assert places(spark, ["x@b.co\u00c9mile Lee"], [("PERSON", "\u00c9mile Lee")]) == [(0, 0, 6, "EMAIL_ADDRESS"), (0, 6, 15, "PERSON")]
