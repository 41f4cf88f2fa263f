"""Sources, the whole plan, outputs, reports and streams."""

from __future__ import annotations

import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import queries
from textsieve.config import PrepConfig
from textsieve.functions.fingerprint import fingerprint
from textsieve.operators.language import fit_language_profile
from textsieve.operators.steps import as_records, dedup_step, language_step, run_steps, toxicity_step
from textsieve.operators.toxicity import ToxicityModel
from textsieve.plans import reports
from textsieve.plans.measure import measured_run
from textsieve.plans.prepare import Models, Timings, base_rows, kept_rows, omitted_rows, prepare
from textsieve.sources import jsonl, outputs
from textsieve.staging import work_dir
from textsieve.streaming import incremental

SENTENCE = "The quick brown fox is in the garden of the old house by the sea"
LINES = [
    json.dumps({"text": "first", "url": "u1", "other": [1]}),
    '{"text": "cut',
    "",
    "5",
    '["text"]',
    '[{"text": "in a list"}]',
    "{'text': 'single quotes'}",
    '{"text": "and more"} xyz',
    '{"text": "two"} {"text": "values"}',
    '{"text": "two"}, {"text": "values"}',
    json.dumps({"url": "no text"}),
    json.dumps({"text": None}),
    json.dumps({"text": ""}),
    json.dumps({"text": "second é\u2028\n", "url": None}),
    json.dumps({"text": "last without line end"}),
]


@pytest.fixture
def lines_file(tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(LINES), encoding="utf-8")
    return str(path)


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_read_jsonl(spark, lines_file):
    rows = by_id(jsonl.read_jsonl(spark, lines_file))
    assert {i: r["original"] for i, r in rows.items()} == {
        1: "first",
        2: "second é\u2028\n",
        3: "last without line end",
    }
    assert [rows[i]["url"] for i in (1, 2, 3)] == ["u1", None, None]


@pytest.mark.parametrize("limit, texts", [(1, 1), (13, 1), (14, 2), (15, 3), (99, 3)])
def test_limit_counts_raw_lines(spark, lines_file, limit, texts):
    rows = by_id(jsonl.read_jsonl(spark, lines_file, limit))
    assert sorted(rows) == list(range(1, texts + 1))


def test_ids_follow_files_and_lines_over_many_splits(spark, tmp_path):
    expected = []
    for name, count in (("a.jsonl", 400), ("b.jsonl", 3), ("c.jsonl", 900)):
        texts = [f"{name} {i} {'x' * (i % 50)}" for i in range(count)]
        expected += texts
        (tmp_path / name).write_text("".join(json.dumps({"text": t}) + "\n{bad\n" for t in texts))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        scan = jsonl.read_jsonl(spark, str(tmp_path))
        assert scan.rdd.getNumPartitions() > 4
        rows = by_id(scan)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [rows[i]["original"] for i in range(1, len(expected) + 1)] == expected


def test_ids_do_not_depend_on_settings_at_use(spark, tmp_path):
    """Splits that change between call and use lose no row, and no text is shuffled."""
    for name in "abc":
        lines = [json.dumps({"text": f"{name}{i} {'y' * (i % 60)}"}) for i in range(500)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        scan = jsonl.read_jsonl(spark, str(tmp_path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "31000")
        plan = scan._jdf.queryExecution().executedPlan().toString()
        rows = by_id(scan)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert [rows[i]["original"].split()[0] for i in range(1, 1501)] == [f"{n}{i}" for n in "abc" for i in range(500)]


def test_limit_leaves_later_files_closed(spark, tmp_path):
    for name in "abc":
        (tmp_path / f"{name}.jsonl").write_text('{"text": "t"}\n' * 10)
    files = jsonl.first_files(spark, str(tmp_path), 15)
    assert [f[-7:] for f in files] == ["a.jsonl", "b.jsonl"]
    assert jsonl.read_jsonl(spark, str(tmp_path), 15).count() == 15


def test_jobs_grow_with_the_logarithm_of_the_files(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"f {i:02}.jsonl").write_text('{"text": "t"}\n' * (i % 3))
    context = spark.sparkContext
    for lines, files, most in ((1, 2, 2), (30, 30, 5), (39, 39, 6), (1000, 40, 6)):
        context.setJobGroup(f"count {lines}", "")
        found = jsonl.first_files(spark, str(tmp_path), lines)
        assert len(found) == files
        # A count is one job, or two where the result of its shuffle is read by another.
        assert len(context.statusTracker().getJobIdsForGroup(f"count {lines}")) <= 2 * most + 2
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jsonl.read_jsonl(spark, str(tmp_path), 30).count() == 30


@pytest.fixture(scope="module")
def sample(spark):
    texts = [
        SENTENCE + ", he said to his friend a@b.co.",
        "short",
        SENTENCE.upper() + ",  HE SAID TO HIS FRIEND A@B.CO.",
        SENTENCE + ", he said to his friend a@b.co.",
        "hola " + SENTENCE,
        "ugly " + SENTENCE,
        "ugly  " + SENTENCE,
        "short",
        "def f(x): " + SENTENCE,
        f"<p>{SENTENCE}</p><p>{SENTENCE} again</p>",
    ]
    df = spark.createDataFrame(list(enumerate(texts, 1)), "id bigint, text string")
    return as_records(df.repartition(3))


LANGUAGE = lambda text: F.when(text.startswith("hola"), "es").when(text.isNotNull(), "en")
TOXICITY = lambda text: F.when(text.startswith("ugly"), 0.9).otherwise(0.0)
EXPECTED = [None, "too_short", "duplicate", "duplicate", "non_english", "toxic_content", "duplicate", "too_short", "code_snippet", None]


@pytest.fixture(scope="module")
def rows(sample):
    return prepare(sample, models=Models(LANGUAGE, TOXICITY))


def test_whole_plan(rows):
    found = by_id(rows)
    assert [found[i]["omit_reason"] for i in range(1, 11)] == EXPECTED
    assert found[1]["cleaned"] == SENTENCE + ", <HE/SHE> said to <HIS/HER> friend <EMAIL_ADDRESS>."
    assert (found[1]["anonymized"], found[10]["anonymized"]) == (True, False)
    assert (found[1]["html_extracted"], found[10]["html_extracted"]) == (False, True)
    assert found[10]["cleaned"] == f"{SENTENCE}\n{SENTENCE} again"
    assert [found[i]["lang"] for i in (1, 3, 5, 6)] == ["en", None, "es", "en"]
    assert all((r["omit_reason"] is None) == (r["omit_stage"] is None) for r in found.values())


def test_same_as_single_steps(sample, rows):
    from textsieve.operators import steps as s

    chain = [
        s.normalize_step(), s.attributes_step(), s.preliminary_step(), s.html_step(), s.code_step(),
        s.dedup_step(), s.language_step(LANGUAGE), s.toxicity_step(TOXICITY, 0.7), s.pii_step(),
    ]
    names = ["id", "cleaned", "lang", "anonymized", "html_extracted", "omit_reason", "omit_stage"]
    assert run_steps(sample, chain).select(names).exceptAll(rows.select(names)).count() == 0


def test_run_does_not_depend_on_partitions(sample, rows):
    again = prepare(sample.repartition(7), models=Models(LANGUAGE, TOXICITY))
    assert again.exceptAll(rows).count() == 0 and rows.exceptAll(again).count() == 0


def test_bypass_makes_no_language_call(sample):
    def model(text):
        raise AssertionError("called")

    found = by_id(prepare(sample, PrepConfig(require_english=False), Models(language=model)))
    assert found[5]["omit_reason"] is None and found[5]["lang"] is None


def test_fitted_toxicity_in_mixed_slots(spark, sample):
    native = ToxicityModel(-3000, spark.createDataFrame([("ugly", 9000)], "word string, w bigint"))
    for language in (LANGUAGE, None):
        found = by_id(prepare(sample, models=Models(language, native)))
        assert found[6]["omit_reason"] == "toxic_content"
        assert found[5]["omit_reason"] == ("non_english" if language else None)


def test_gazetteer_in_the_plan(spark, sample):
    names = spark.createDataFrame([("LOCATION", "old house")], "entity string, phrase string")
    found = by_id(prepare(sample, models=Models(gazetteer=names)))
    assert "the <LOCATION> by" in found[1]["cleaned"]
    assert "<LOCATION>" not in found[2]["cleaned"]


def test_base_is_one_pass_without_a_shuffle(sample):
    plan = base_rows(sample)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2
    # Only the fixture's own repartition.
    assert plan.count("Exchange") == 1
    # Normalization is worked out once, not copied into later rules.
    assert plan.count("translate(") == 1


def test_outputs(spark, rows, tmp_path):
    folder = str(tmp_path / "out")
    outputs.write_outputs(rows, folder, shard_size=1, seconds={"all": 1.5})
    kept, omitted = jsonl.read_outputs(spark, folder)
    assert kept.exceptAll(kept_rows(rows)).count() == 0 and kept.count() == 2
    assert omitted.exceptAll(omitted_rows(rows)).count() == 0 and omitted.count() == 8

    written = [line for f in Path(folder, "omitted").glob("*.json") for line in f.read_text().splitlines()]
    assert all(set(json.loads(line)) == {"id", "reason", "lang", "original"} for line in written)
    shards = sorted(p.name for p in Path(folder, "shards").glob("shard=*"))
    assert shards == ["shard=0", "shard=1"]
    lines = [f.read_text() for f in Path(folder, "insights").glob("*.txt")]
    insights = json.loads("".join(lines))
    assert insights["omit_reasons"]["duplicate"] == 3
    assert insights["steps"]["dedup"]["number_of_calls"] == 7
    assert insights["seconds"] == {"all": 1.5}


def test_each_shard_is_one_file(spark, tmp_path):
    """Also where the keys' order is uneven and shards are many."""
    n = 1003
    rows = spark.range(0, n * n, n).selectExpr(
        "id", "'t' AS cleaned", "false AS anonymized", "false AS html_extracted", "CAST(NULL AS STRING) AS omit_reason", "true AS kept"
    )
    outputs.write_shards(rows, str(tmp_path / "s"), 50)
    folders = sorted(Path(tmp_path, "s").glob("shard=*"), key=lambda p: int(p.name[6:]))
    assert [p.name for p in folders] == [f"shard={i}" for i in range(21)]
    held = []
    for folder in folders:
        (file,) = folder.glob("*.json")
        held.append([json.loads(line)["id"] for line in file.read_text().splitlines()])
    assert [len(ids) for ids in held] == [50] * 20 + [3]
    assert [i for ids in held for i in ids] == [i * n for i in range(n)]


def test_no_kept_rows(spark, records, tmp_path):
    rows = prepare(records(["x"]))
    outputs.write_outputs(rows, str(tmp_path / "o"), 10)
    assert jsonl.read_outputs(spark, str(tmp_path / "o"))[1].count() == 1
    assert not list(Path(tmp_path, "o", "shards").glob("shard=*"))
    funnel = reports.stage_funnel(rows).orderBy("stage").collect()
    assert funnel[2]["omit_percent"] == 100.0
    assert funnel[3]["rows_in"] == 0 and funnel[3]["omit_percent"] == 0.0


def test_reports(rows):
    counts = {r["omit_reason"]: r["n"] for r in reports.omit_reason_counts(rows).collect()}
    assert counts == {"too_short": 2, "code_snippet": 1, "duplicate": 3, "non_english": 1, "toxic_content": 1}
    share = reports.omit_reason_share(rows).collect()
    assert share[0]["omit_reason"] == "duplicate" and share[0]["percent"] == 37.5
    funnel = reports.stage_funnel(rows).orderBy("stage").collect()
    assert [r["rows_in"] for r in funnel] == [10, 10, 10, 8, 8, 7, 4, 3, 2]
    assert reports.selection_rate(rows).first()[0] == 0.2
    redactions = {r["kind"]: r["n"] for r in reports.redaction_counts(rows).collect()}
    assert redactions == {
        "PERSON": 0, "LOCATION": 0, "EMAIL_ADDRESS": 1, "PHONE_NUMBER": 0, "IP_ADDRESS": 0, "PRONOUN": 2
    }
    shares = reports.kept_flag_shares(rows).first()
    assert tuple(shares) == (2, 50.0, 50.0)


def test_histogram_like_numpy(spark):
    import numpy as np

    lengths = [3, 3, 12, 13, 23, 23, 22, 43]
    df = spark.createDataFrame(
        [(i, "x" * n, "x" * n, None) for i, n in enumerate(lengths)],
        "id bigint, original string, cleaned string, omit_reason string",
    )
    expected, edges = np.histogram(lengths, np.arange(min(lengths), max(lengths) + 10, 10), density=True)
    found = reports.length_histogram(df).filter("series = 'cleaned'").orderBy("bin").collect()
    dense = np.zeros(len(expected))
    for row in found:
        dense[row["bin"]] = row["density"]
        assert row["start"] == edges[row["bin"]]
    assert np.allclose(dense, expected)


def test_timings(rows, sample):
    timings = Timings()
    prepare(sample, timings=timings)
    table = reports.part_timing(rows, timings.seconds).collect()
    assert [r["part"] for r in table] == ["stages 1-5", "dedup", "verdicts", "masks and output"]
    assert all(r["rows"] == 10 and r["seconds"] > 0 for r in table)


def test_measured_run(spark, sample, rows):
    """Nine steps, each with the rows it received and omitted as the funnel has them, and with its time."""
    measured, measures = measured_run(sample, models=Models(LANGUAGE, TOXICITY))
    names = ["id", "cleaned", "lang", "anonymized", "html_extracted", "omit_reason", "omit_stage", "kept"]
    assert measured.select(names).exceptAll(rows.select(names)).count() == 0 and measured.count() == 10
    funnel = reports.stage_funnel(rows).orderBy("stage").collect()
    assert [(m.name, m.rows_in, m.omits) for m in measures] == [(r["name"], r["rows_in"], r["omits"]) for r in funnel]
    table = reports.stage_timing(spark, measures).orderBy("stage").collect()
    assert len(table) == 9 and all(r["seconds"] > 0 for r in table)
    assert all(r["seconds_per_row"] == pytest.approx(r["seconds"] / r["rows_in"]) for r in table)
    document = json.loads(reports.insights(measured, measures=measures).first()[0])
    assert document["omit_reasons"]["duplicate"] == 3
    assert document["steps"]["dedup"]["number_of_omits"] == 3
    assert all(step["total_time_seconds"] > 0 for step in document["steps"].values())
    one = document["steps"]["toxicity"]
    assert one["average_time_per_call_seconds"] == pytest.approx(one["total_time_seconds"] / one["number_of_calls"])


def test_measured_run_leaves_one_result_on_disk(spark, sample):
    """A step's rows are written once, and go when the next step has read them."""
    folder = Path(work_dir(spark)) / "textsieve"
    before = set(folder.glob("*"))
    measured_run(sample, models=Models(LANGUAGE, TOXICITY))
    left = {path.name.rsplit("-", 1)[0] for path in set(folder.glob("*")) - before}
    assert left == {"step-9", "fingerprints"}


def test_unchanged_texts_are_stored_once(spark):
    """Also where no step changes a text; a null that a caller made of a text stays one."""
    folder = Path(work_dir(spark)) / "textsieve"
    before = set(folder.glob("step-9-*"))
    # Digests hardly shrink: half a byte for each of their characters.
    text = F.concat(*(F.concat(F.sha2(F.concat("id", F.lit(f"-{i}")).cast("string"), 256), F.lit(" ")) for i in range(20)))
    rows = as_records(spark.range(2000).withColumn("text", text))
    measured, _ = measured_run(rows.withColumn("cleaned", F.when(F.col("id") != 7, F.col("cleaned"))))
    (path,) = set(folder.glob("step-9-*")) - before
    size = sum(file.stat().st_size for file in path.glob("*.parquet"))
    assert size < 1.5 * 2000 * 20 * 32
    found = by_id(measured)
    assert all(found[i]["cleaned"] == found[i]["original"] for i in range(2000) if i != 7)
    assert found[7]["cleaned"] == ""


def test_plan_stores_unchanged_texts_once(spark):
    """In the table of stages 1-5, also next to texts that these have changed."""
    folder = Path(work_dir(spark)) / "textsieve"
    before = set(folder.glob("base-*"))
    text = F.concat(*(F.concat(F.sha2(F.concat("id", F.lit(f"+{i}")).cast("string"), 256), F.lit(" ")) for i in range(20)))
    changed = F.when(F.col("id") % 500 == 3, F.concat(text, F.lit("\t\x01“so”"))).otherwise(text)
    rows = by_id(prepare(as_records(spark.range(2000).select("id", changed.alias("text")))))
    (path,) = set(folder.glob("base-*")) - before
    assert sum(file.stat().st_size for file in path.glob("*.parquet")) < 1.6 * 2000 * 20 * 32
    for i, row in rows.items():
        expected = row["original"] if i % 500 != 3 else row["original"].replace(" \t\x01“so”", ' "so"')
        assert row["cleaned"] == expected


def test_steps_shuffle_no_text_for_what_they_omit(spark, sample):
    """What rows are joined with has a known small size, so that it is broadcast."""
    profile = fit_language_profile(sample.withColumn("lang", F.lit("en")), "original")
    toxicity = ToxicityModel(0, spark.createDataFrame([("fox", 9000)], "word string, w bigint"))
    for number, step in enumerate((dedup_step(True), language_step(profile, "en", True), toxicity_step(toxicity, 0.7, True)), 6):
        plan = step(sample, number)._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan


def test_measured_run_of_no_rows(sample):
    _, measures = measured_run(sample.limit(0))
    assert [(m.rows_in, m.omits) for m in measures] == [(0, 0)] * 9


def test_stream_and_measured_queries_do_not_run_the_default_plan(spark, sample, rows, tmp_path, monkeypatch):
    """They take its models alone."""
    sample.select(F.col("id").alias("doc_id"), F.col("original").alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "run", lambda spark, folder: pytest.fail("the plan is run"))
    monkeypatch.setattr(queries, "fitted", lambda spark, folder: Models(LANGUAGE, TOXICITY))
    names = ["id", "cleaned", "lang", "omit_reason", "omit_stage"]
    for query in (queries.stream_chain, queries.measured_chain):
        found = query(spark, str(tmp_path)).select(names)
        assert found.exceptAll(rows.select(names)).count() == 0 and found.count() == 10


def write_batch(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"id": i, "text": t}) + "\n" for i, t in rows))


def test_stream_equals_batch_over_two_arrivals(spark, sample, rows, tmp_path):
    texts = sorted((r["id"], r["original"]) for r in sample.collect())
    out = str(tmp_path / "out")
    seen = []

    def arrive(name, part):
        write_batch(tmp_path / "in", name, part)
        stream = spark.readStream.schema("id bigint, text string").json(str(tmp_path / "in"))
        query = incremental.start_stream(
            stream, out, models=Models(LANGUAGE, TOXICITY), on_batch=lambda df, n: seen.append((n, df.count()))
        )
        query.awaitTermination()

    arrive("1.json", texts[:5])
    arrive("2.json", texts[5:])
    assert seen == [(0, 5), (1, 5)]
    names = ["id", "cleaned", "lang", "anonymized", "omit_reason", "omit_stage"]
    result = incremental.read_batches(spark, out, "rows").select(names)
    assert result.count() == 10
    assert result.exceptAll(rows.select(names)).count() == 0


def test_replayed_batch_changes_nothing(spark, tmp_path):
    store = str(tmp_path / "store")
    text = spark.createDataFrame([(1, "a"), (2, "A "), (3, "b")], "id bigint, t string")
    pairs = text.select("id", fingerprint(F.col("t")).alias("fingerprint"))
    for _ in range(2):
        later = incremental.duplicates_with_store(pairs, store, 0)
        assert [r["id"] for r in later.collect()] == [2]
    later = incremental.duplicates_with_store(pairs.withColumn("id", F.col("id") + 10), store, 1)
    assert sorted(r["id"] for r in later.collect()) == [11, 12, 13]


def test_staging_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from textsieve.staging import work_dir

    conf = SimpleNamespace(get=lambda key, default: default)
    context = SimpleNamespace(master="spark://host:7077", applicationId="x")
    with pytest.raises(ValueError):
        work_dir(SimpleNamespace(conf=conf, sparkContext=context))


def test_config_is_checked():
    with pytest.raises(ValueError):
        PrepConfig(noise_scope="page")
    with pytest.raises(ValueError):
        PrepConfig(shard_size=0)


def test_jsonl_stream_numbers_over_arrivals(spark, sample, rows, tmp_path):
    """Bad and blank lines take no id, and ids go on in the second batch."""
    texts = [r["original"] for r in sorted(sample.collect(), key=lambda r: r["id"])]
    out, folder = str(tmp_path / "out"), tmp_path / "in"
    folder.mkdir()
    for name, part in (("1.jsonl", texts[:4]), ("2.jsonl", texts[4:])):
        lines = [json.dumps({"text": t, "url": name}) + "\n" for t in part]
        (folder / name).write_text("{bad\n" + '{"text": ""}\n'.join(lines))
        incremental.start_jsonl_stream(spark, str(folder), out, models=Models(LANGUAGE, TOXICITY)).awaitTermination()
    names = ["id", "cleaned", "lang", "anonymized", "omit_reason", "omit_stage"]
    result = incremental.read_batches(spark, out, "rows").select(names)
    assert result.count() == 10
    assert result.exceptAll(rows.select(names)).count() == 0


def fingerprints(spark, numbers, first_id=0):
    rows = spark.createDataFrame([(first_id + i, n) for i, n in enumerate(numbers)], "id bigint, n bigint")
    return rows.select("id", F.sha1(F.col("n").cast("string").cast("binary")).alias("fingerprint"))


def later_ids(spark, store, batch, numbers, first_id=0):
    later = incremental.duplicates_with_store(fingerprints(spark, numbers, first_id), store, batch)
    return sorted(r["id"] for r in later.collect())


def test_store_over_many_batches(spark, tmp_path):
    """Runs are merged as they come, old ones go, and replays of any batch change nothing."""
    store, seen = str(tmp_path / "store"), set()
    for batch in range(9):
        numbers = [n % 60 for n in range(batch * 11, batch * 11 + 20)] + [1000 + batch] * 2
        expected = [i for i, n in enumerate(numbers) if n in seen or n in numbers[:i]]
        assert later_ids(spark, store, batch, numbers) == expected
        if batch % 3 == 0:
            assert later_ids(spark, store, batch, numbers) == expected
        seen |= set(numbers)
    kept = incremental.FingerprintStore(spark, store)
    runs = kept._runs(9)
    assert sum(rows for _, rows in runs) == len(seen) and len(runs) <= 4
    assert all(a >= 2 * b for (_, a), (_, b) in zip(runs, runs[1:]))
    assert kept._read([name for name, _ in runs]).distinct().count() == len(seen)
    left = {p.name for p in (tmp_path / "store" / "runs").iterdir()}
    assert {name for name, _ in runs} <= left <= {name for name, _ in runs} | {name for name, _ in kept._runs(8)}


def test_a_batch_reads_only_its_parts_of_the_store(spark, tmp_path):
    store = str(tmp_path / "store")
    later_ids(spark, store, 0, range(3000))
    kept = incremental.FingerprintStore(spark, store)
    wanted = fingerprints(spark, [5, 17])
    known = kept.known(1, wanted)
    prefixes = {r[0][: incremental.PREFIX_DIGITS] for r in wanted.select("fingerprint").collect()}
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*prefix", plan)
    files = [r[0] for r in known.select("_metadata.file_path").distinct().collect()]
    folders = {file.split("prefix=")[1][: incremental.PREFIX_DIGITS] for file in files}
    assert folders == prefixes
    assert 2 <= known.count() < 100


def test_rows_without_fingerprint_are_one_group(spark, tmp_path):
    pairs = spark.createDataFrame([(1, None), (2, None), (3, "ab")], "id bigint, fingerprint string")
    for batch, expected in ((0, [2]), (1, [1, 2, 3])):
        later = incremental.duplicates_with_store(pairs, str(tmp_path / "store"), batch)
        assert sorted(r["id"] for r in later.collect()) == expected


def test_ledger(spark, tmp_path):
    """A batch starts from the one before it, whatever later ones wrote; a batch without an entry is looked past."""
    ledger = incremental.Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.before(0) == ledger.before(7) == 0
    ledger.enter(0, 10)
    ledger.enter(1, 25)
    assert [ledger.before(n) for n in range(4)] == [0, 10, 25, 25]
    ledger.enter(1, 20)
    ledger.enter(4, 30)
    assert [ledger.before(n) for n in (1, 2, 4, 5)] == [10, 20, 20, 30]


def test_ids_go_on_from_the_ledger_alone(spark, tmp_path):
    """The rows of earlier batches are not read again: they may even be gone."""
    import shutil

    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    starts = []
    for n in range(3):
        (folder / f"{n}.jsonl").write_text("".join(json.dumps({"text": f"{SENTENCE} {n} {i}"}) + "\n" for i in range(4)))
        incremental.start_jsonl_stream(
            spark, str(folder), str(out), on_batch=lambda df, batch: starts.append(sorted(r["id"] for r in df.collect()))
        ).awaitTermination()
        shutil.rmtree(out / "rows")
    assert starts == [[1, 2, 3, 4], [5, 6, 7, 8], [9, 10, 11, 12]]


def test_store_errors_are_not_taken_for_an_empty_store(spark, tmp_path):
    """Only a missing path means that nothing was stored yet."""
    assert incremental._stored(spark, str(tmp_path / "none"), "batch bigint") is None
    with pytest.raises(Exception, match="(?i)schema|parse"):
        incremental._stored(spark, str(tmp_path), "no such type")
