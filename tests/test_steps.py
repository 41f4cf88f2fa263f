"""Steps and the code rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from textsieve.operators.steps import (
    alive,
    attribute_step,
    attributes_step,
    batch_filter_step,
    code_step,
    dedup_step,
    filter_step,
    language_step,
    modify_step,
    normalize_step,
    pii_step,
    preliminary_step,
    run_steps,
    toxicity_step,
)

PROSE = """
    The ferry was late again, so we waited under the tin roof and watched the rain
    come over the bay. My uncle said that in his youth nobody kept a timetable, and that
    a person who was in a hurry could always row. Nobody had rowed for years.
    When the boat came at last it was half empty, and the man who took our fares
    asked us whether the road in the hills was open.
"""
FILLER = " ".join(f"filler{a}{b}" for a in "abcde" for b in "vwxyz")
CODE_CASES = {
    "C1": "def greet(name):\n    return f\"Hello {name}\"",
    "C2": "foo.bar(1) a.b (2) c.d(3) with some long text in between to pass fifty",
    "C3": "x = 1\ny = 2\nz = 3\nw = 4 and more text to be long enough here ok",
    "C5 start": "from here to there it is a long line of ordinary prose about the sea and ships",
    "C5 end": "one; two; three four five six seven eight nine ten eleven twelve thirteen;",
    "C6": "        # alpha river\n        beta stone garden\n        winter copper silver",
    "C10": "lambda yield self <river>; <stone>; {garden] river=stone; copper=silver; x",
    "C11": "alpha (beta) gamma [delta] epsilon (zeta) eta (theta) iota",
    "C12": "lambda yield await global bool array static elif alpha beta gamma delta",
    "C13": "lambda xx=yy=zz qq=ww=rr yield pp=kk=jj hh==gg==ff",
    "C14": "lambda yield await global bool " + FILLER,
}


def code_verdicts(rows):
    steps = [attribute_step({"tokens": F.lit(None).cast("array<string>")})]
    return run_steps(rows, [*steps, code_step()])


@pytest.mark.parametrize("normalized", [False, True])
def test_code_cases(records, normalized):
    first = [normalize_step()] if normalized else []
    rows = run_steps(records(list(CODE_CASES.values())), [*first, attributes_step(), code_step()])
    found = {r["id"]: r["omit_reason"] for r in rows.collect()}
    verdicts = dict(zip(CODE_CASES, (found[i] for i in sorted(found))))
    expected = dict.fromkeys(CODE_CASES, "code_snippet")
    if normalized:
        expected["C6"] = None
    assert verdicts == expected


def test_code_without_tokens(records):
    rows = code_verdicts(records([CODE_CASES["C1"], "__init__ __name__ __main__ cls " * 3]))
    assert [r["omit_reason"] for r in rows.orderBy("id").collect()] == ["code_snippet", "code_snippet"]


def test_blank_texts_pass_the_code_rules(spark, records, tmp_path):
    """A text without lines and words has no shares, but does not end the job."""
    blanks = ["", " ", "\n\n\t", "\u00a0", "\r\x1c", None]
    texts = [*blanks, PROSE, CODE_CASES["C1"], CODE_CASES["C12"], *blanks]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["omit_reason"] for r in QUERIES["code_reason"](spark, str(tmp_path)).collect()}
    assert found == {i: "code_snippet" if t in CODE_CASES.values() else None for i, t in enumerate(texts)}
    rows = code_verdicts(records(["\r" * 60, PROSE, CODE_CASES["C1"]])).orderBy("id")
    assert [r["omit_reason"] for r in rows.collect()] == [None, None, "code_snippet"]


def test_prose_is_kept(records):
    steps = [normalize_step(), attributes_step(), preliminary_step(), code_step()]
    assert run_steps(records([PROSE]), steps).first()["omit_reason"] is None


def test_tokens_stay_those_before_extraction(records):
    """Code rules judge the words measured in stage 2, not those of the changed text."""
    keywords = "lambda yield await global bool array static elif alpha beta gamma delta"
    steps = [attributes_step(), modify_step(F.lit("the quiet of the sea and the ships")), code_step()]
    assert run_steps(records([keywords]), steps).first()["omit_reason"] == "code_snippet"


def test_first_reason_wins_and_dead_rows_stay(records):
    steps = [
        filter_step(F.when(F.length("cleaned") < 4, "short")),
        modify_step(F.upper("cleaned"), "anonymized"),
        filter_step(F.lit("all")),
    ]
    rows = {r["id"]: r for r in run_steps(records(["abc", "abcdef"]), steps).collect()}
    assert (rows[1]["omit_reason"], rows[1]["omit_stage"], rows[1]["cleaned"]) == ("short", 1, "abc")
    assert (rows[2]["omit_reason"], rows[2]["omit_stage"], rows[2]["cleaned"]) == ("all", 3, "ABCDEF")
    assert (rows[1]["anonymized"], rows[2]["anonymized"]) == (False, True)


def test_batch_filter_sees_live_rows_in_order(records):
    def loud(batch):
        assert not batch.str.contains("dead").any()
        return [text.endswith("!") for text in batch]

    steps = [filter_step(F.when(F.col("cleaned").contains("dead"), "dead")), batch_filter_step(loud, "loud")]
    rows = run_steps(records(["a!", "b", "dead!", "c!", "d"]), steps).orderBy("id")
    assert [r["omit_reason"] for r in rows.collect()] == ["loud", None, "dead", "loud", None]


def test_user_function_is_a_step(records):
    def drop_url(rows, number):
        return rows.withColumn("url", F.lit(f"step {number}"))

    assert run_steps(records(["x"]), [drop_url]).first()["url"] == "step 1"


def test_dedup_step_counts_live_rows_only(records):
    steps = [filter_step(F.when(F.col("id") == 1, "early")), dedup_step()]
    rows = run_steps(records(["same", "SAME ", "same", "other"]), steps).orderBy("id")
    assert [r["omit_reason"] for r in rows.collect()] == ["early", None, "duplicate", None]


def test_column_models(records):
    language = lambda text: F.when(text.contains("hola"), "es").when(text.isNotNull(), "en")
    toxicity = lambda text: F.when(text.contains("ugly"), 0.9).when(text.contains("edge"), 0.7).otherwise(0.1)
    texts = ["hola mundo", "hello world", "very ugly", "on the edge", "hola ugly"]
    steps = [language_step(language), toxicity_step(toxicity, 0.7)]
    rows = run_steps(records(texts), steps).orderBy("id").collect()
    assert [r["omit_reason"] for r in rows] == ["non_english", None, "toxic_content", None, "non_english"]
    assert [r["lang"] for r in rows] == ["es", "en", "en", "en", "es"]


def test_language_bypass(records):
    row = run_steps(records(["hola mundo"]), [language_step(None)]).first()
    assert (row["lang"], row["omit_reason"]) == (None, None)


def test_masks_with_a_span_model_and_a_gazetteer(spark, records):
    entity = "array<struct<entity: string, start: int, end: int>>"
    found = F.array(F.struct(F.lit("PERSON").alias("entity"), F.lit(0).alias("start"), F.lit(8).alias("end")))
    model = lambda text: F.when(text.startswith("John Doe"), found).otherwise(F.array().cast(entity))
    texts = ["John Doe email john@example.com", "nothing to see", "she flew to New York"]
    rows = run_steps(records(texts), [pii_step(model)]).orderBy("id").collect()
    assert rows[0]["cleaned"] == "<PERSON> email <EMAIL_ADDRESS>"
    assert [r["anonymized"] for r in rows] == [True, False, True]

    places = spark.createDataFrame(
        [("LOCATION", "New York"), ("LOCATION", "York"), ("PERSON", "John Doe")], "entity string, phrase string"
    )
    rows = run_steps(records(texts), [pii_step(gazetteer=places)]).orderBy("id").collect()
    assert [r["cleaned"] for r in rows] == [
        "<PERSON> email <EMAIL_ADDRESS>",
        "nothing to see",
        "<HE/SHE> flew to <LOCATION>",
    ]
    assert [r["anonymized"] for r in rows] == [True, False, True]


def test_alive_is_a_condition(records):
    assert records(["x"]).filter(alive()).count() == 1
