"""One query per operator: (spark, folder of parquet tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textsieve.config import PrepConfig
from textsieve.functions import attributes as at
from textsieve.functions import code, html, normalize, pii, quality
from textsieve.functions.fingerprint import fingerprint as fingerprint_of
from textsieve.operators import dedup, entities, ids
from textsieve.operators.language import LanguageProfile, detect_language, fit_language_profile, language_reason
from textsieve.operators.steps import (
    as_records,
    attribute_step,
    batch_filter_step,
    code_features,
    code_reason,
    filter_step,
    language_step,
    modify_step,
    run_steps,
)
from textsieve.operators import toxicity as tox
from textsieve.operators.toxicity import ToxicityModel, fit_toxicity, toxicity_reason
from textsieve.plans import reports
from textsieve.plans.measure import StepMeasure, measured_run
from textsieve.plans.prepare import Models, Timings, kept_rows, omitted_rows, prepare
from textsieve.sources import jsonl, outputs
from textsieve.staging import new_path, write_staged
from textsieve.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

CONFIG = PrepConfig()
# Small enough that the test tables fill several shards.
SHARD_SIZE = 100
INPUT_LIMIT = 300

# The fitted models, and results of the default plan, by session and table folder.
_models: dict[tuple[str, str], Models] = {}
_runs: dict[tuple[str, str], tuple[DataFrame, Timings, Models]] = {}
_measured_runs: dict[tuple[str, str], tuple[DataFrame, list[StepMeasure]]] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


# Spark and DuckDB SQL: what documents.text becomes, by doc_id, to meet rules that no given text meets.
MADE_TEXT = """CASE doc_id % 12
    WHEN 0 THEN replace(replace(text, 'e', '“'), 'n', '’')
    WHEN 1 THEN replace(replace(text, 'a', chr(11)), 'r', chr(127))
    WHEN 2 THEN concat(text, repeat('z', CAST(6 + doc_id % 7 AS INT)))
    WHEN 3 THEN translate(text, 'aeioutrnsh', 'жщюяыэфцчш')
    WHEN 4 THEN replace(replace(text, '. ', concat(chr(10), '        ')), ', ', concat(';', chr(10), '        '))
    WHEN 5 THEN concat('function f', CAST(doc_id AS VARCHAR(20)), ' (x) ', text)
    WHEN 6 THEN concat('        ', replace(text, '. ', concat(chr(10), '        ')))
    WHEN 7 THEN replace(text, ' ', ' lambda yield {x} ')
    WHEN 8 THEN replace(text, ' ', ' [q] (r) ')
    WHEN 9 THEN replace(text, ', ', '.go(')
    WHEN 10 THEN replace(text, '. ', concat(chr(10), 'x = ', chr(39)))
    ELSE CASE WHEN doc_id % 24 = 11
        THEN concat('lambda yield ', replace(translate(text, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ',
            '0123456789012345678901234501234567890123456789012345'), ' ', '={;'))
        ELSE replace(text, ' ', 'zz{lambda}=;zz') END END"""
# The same with blank texts among them.
MADE_BLANKS = "CASE doc_id % 24 WHEN 4 THEN '' WHEN 16 THEN NULL ELSE text END"

# What pages.html becomes, by page_id: list items, dropped tags of both groups, a parser failure, other block tags.
SKIPPED = ("noscript", "iframe", "object", "svg", "canvas", "audio", "video", "map", "pre", "code")
NOISY = ("header", "aside", "menu", "menuitem", "form", "button", "select", "textarea", "label")
_DROPPED = {tags: "".join(f"<{tag}>lost in {tag}</{tag}>" for tag in tags) for tags in (SKIPPED, NOISY)}
MADE_HTML = f"""CASE page_id % 6
    WHEN 0 THEN replace(replace(html, '<p>', '<li>'), '</p>', '</li>')
    WHEN 1 THEN replace(html, '</h1>', '</h1>{_DROPPED[SKIPPED]}')
    WHEN 2 THEN replace(replace(html, '</h1>', '</h1>{_DROPPED[NOISY]}'), '<footer>', '<input name="q">lost<footer>')
    WHEN 3 THEN replace(html, '</h1>', '</h1><![broken[x]]>')
    WHEN 4 THEN replace(replace(replace(html, '<p>', '<blockquote>'), '</p>', '</blockquote>'), 'h1>', 'h3>')
    ELSE html END"""


def made_documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.expr(MADE_TEXT).alias("text"))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages")


def _columns(source: Query = documents, **columns: Callable[[Column], Column]) -> Query:
    """A query that adds columns worked out from the text of documents."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        text = F.col("text")
        made = [make(text).alias(name) for name, make in columns.items()]
        return source(spark, folder).select("doc_id", *made)

    return query


def _where(condition: Callable[[Column], Column], source: Query = documents) -> Query:
    """A query for the documents that a rule holds for."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return source(spark, folder).filter(condition(F.col("text"))).select("doc_id")

    return query


# Sources


def scan_documents(spark, folder):
    return jsonl.read_table(table(spark, folder, "documents"), "doc_id", "text").select("id", "original")


def nonblank_text(spark, folder):
    return documents(spark, folder).filter(jsonl.nonblank(F.col("text"))).select("doc_id")


def _written_lines(spark, folder, broken: bool) -> str:
    """documents as line-delimited JSON in id order, each line followed by a cut copy if broken."""
    line = F.to_json(F.struct("doc_id", "text", F.col("source").alias("url")))
    lines = F.array(line, F.expr("left(line, length(line) - 1)")) if broken else F.array(line)
    docs = table(spark, folder, "documents").withColumn("line", line)
    path = new_path(spark, "lines")
    docs.orderBy("doc_id").select(F.explode(lines).alias("value")).write.text(path)
    return path


def read_lines(spark, folder):
    """Ids follow file and line order, and cut lines take none."""
    rows = jsonl.read_jsonl(spark, _written_lines(spark, folder, broken=True))
    return rows.select("id", "original", "url")


def input_limit_lines(spark, folder):
    """The limit counts cut lines."""
    rows = jsonl.read_jsonl(spark, _written_lines(spark, folder, broken=True), INPUT_LIMIT)
    return rows.select("id", "original")


def input_limit(spark, folder):
    return ids.first_rows(table(spark, folder, "documents").select("doc_id", "text"), "doc_id", INPUT_LIMIT)


def assign_ids(spark, folder):
    return ids.assign_ids(table(spark, folder, "documents").select("doc_id"), "doc_id")


# HTML


def html_unescape(spark, folder):
    return pages(spark, folder).select("page_id", normalize.html_unescape(F.col("html")).alias("html"))


def is_html(spark, folder):
    both = pages(spark, folder).select(F.col("page_id").alias("id"), F.lit("page").alias("kind"), F.col("html").alias("text"))
    docs = documents(spark, folder).select(F.col("doc_id").alias("id"), F.lit("document"), "text")
    return both.union(docs).select("id", "kind", html.is_html(F.col("text")).alias("is_html"))


def html_extract(spark, folder, scope="document"):
    raw = pages(spark, folder).select("page_id", html.raw_page_text(F.col("html"), scope).alias("raw"))
    return raw.select("page_id", html.line_cleanup(F.col("raw")).alias("extracted"))


def html_accept(spark, folder):
    extracted = html_extract(spark, folder, "element")
    taken = html.accepted(F.col("extracted"), CONFIG.min_char_len)
    return extracted.select("page_id", taken.isNotNull().alias("html_extracted"), F.length(taken).alias("chars"))


def prepared_pages(spark, folder):
    rows = prepare(as_records(pages(spark, folder), "page_id", "html", "url"))
    return rows.select("id", "omit_reason", "html_extracted", "anonymized", "cleaned")


# Code rules


def _measured(spark, folder, source=documents):
    return code_features(source(spark, folder).withColumn("tokens", at.tokenize(F.col("text"))), "text")


def code_line_features(spark, folder, source=documents):
    return _measured(spark, folder, source).select("doc_id", "lines", "codey_lines", "indented_lines")


def code_char_features(spark, folder, source=documents):
    chars = F.greatest("chars", F.lit(1))
    return _measured(spark, folder, source).select(
        "doc_id",
        (F.col("punctuation") / chars).alias("punctuation_ratio"),
        (F.col("bracket_pairs") / chars * 100).alias("bracket_density"),
    )


def code_token_features(spark, folder, source=documents):
    return _measured(spark, folder, source).select("doc_id", "words", "stopwords", "keywords")


def code_verdict(spark, folder, source=documents):
    return _measured(spark, folder, source).select("doc_id", code_reason().alias("omit_reason"))


# Quality


def preliminary_reason(spark, folder, source=documents):
    text = F.col("text")
    measured = source(spark, folder).withColumns(at.attributes(text))
    reason = quality.preliminary_reason(
        text, F.col("char_count"), F.col("ascii_ratio"), F.col("symbol_ratio"), CONFIG
    )
    return measured.select("doc_id", reason.alias("omit_reason"))


# Deduplication


def _fingerprints(spark, folder):
    """Written, because the operators read it twice: each fingerprint is worked out once."""
    prints = documents(spark, folder).select("doc_id", fingerprint_of(F.col("text")).alias("fingerprint"))
    return write_staged(prints, "fingerprints")


def dedup_keep(spark, folder):
    return dedup.dedup_keep(_fingerprints(spark, folder), "doc_id").select("doc_id")


def dedup_mark(spark, folder):
    return dedup.dedup_mark(_fingerprints(spark, folder), "doc_id").select("doc_id", "duplicate")


def dedup_groups(spark, folder):
    return dedup.dedup_groups(_fingerprints(spark, folder))


ARRIVALS = 3


def _arriving(spark, folder) -> DataFrame:
    """All documents as a stream of several batches, in id order; files keep the partitions they come from."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    path = new_path(spark, "arriving")
    files = 0
    for part in range(ARRIVALS):
        start = low + (high + 1 - low) * part // ARRIVALS
        stop = low + (high + 1 - low) * (part + 1) // ARRIVALS
        rows = (F.col("doc_id") >= start) & (F.col("doc_id") < stop)
        if part == 0:
            rows = rows | F.col("doc_id").isNull()
        docs.filter(rows).write.mode("append").parquet(path)
        files = max(files, len(spark.read.parquet(path).inputFiles()) - files)
    return spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", max(files, 1)).parquet(path)


def stream_dedup(spark, folder):
    """dedup_mark over documents arriving as a stream, in several batches."""
    arriving = _arriving(spark, folder).select("doc_id", fingerprint_of(F.col("text")).alias("fingerprint"))
    out = new_path(spark, "stream")
    incremental.start_dedup_stream(arriving, out, "doc_id").awaitTermination()
    return incremental.read_batches(spark, out, "marks").select(F.col("id").alias("doc_id"), "duplicate")


# Models


def _labelled(spark, folder):
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")


def _profile(spark, folder) -> LanguageProfile:
    return fit_language_profile(table(spark, folder, "documents"))


def _toxicity(spark, folder) -> ToxicityModel:
    return fit_toxicity(_labelled(spark, folder))


def language_profile(spark, folder):
    profile = _profile(spark, folder)
    names = [F.col(w).alias(f"weight_{lang}") for w, lang in zip(profile.columns, profile.languages)]
    return profile.weights.select("bucket", *names)


def language(spark, folder):
    return detect_language(documents(spark, folder), _profile(spark, folder), "doc_id")


def filter_language(spark, folder):
    labels = language(spark, folder)
    return labels.filter(language_reason(F.col("lang")).isNotNull())


def language_bypass(spark, folder):
    rows = as_records(documents(spark, folder), "doc_id")
    return language_step(None)(rows, 7).select("id", "lang", "omit_reason")


def toxicity_weights(spark, folder):
    return tox.toxicity_weights(_labelled(spark, folder))[1]


def toxicity(spark, folder):
    return tox.score_toxicity(documents(spark, folder), _toxicity(spark, folder), "doc_id")


def toxicity_score(spark, folder):
    return toxicity(spark, folder).select("doc_id", F.round("toxicity", 6).alias("toxicity"))


def filter_toxicity(spark, folder):
    reason = toxicity_reason(F.col("toxicity"), CONFIG.toxicity_threshold)
    return toxicity(spark, folder).filter(reason.isNotNull()).select("doc_id")


# Personal data


def anonymized_flag(spark, folder):
    text = F.col("text")
    masked = documents(spark, folder).withColumn("masked", pii.neutralize_pronouns(pii.mask_patterns(text)))
    return masked.select("doc_id", pii.changed(F.col("masked"), text).alias("anonymized"))


def conversation_pronouns(spark, folder):
    talks = table(spark, folder, "conversations")
    return talks.select("conv_id", "turn", pii.neutralize_pronouns(F.col("text")).alias("text"))


def pii_entities(spark, folder):
    return entities.pii_entities(documents(spark, folder), "doc_id")


def pii_entities_names(spark, folder):
    """Names as well: each match with its place in the given text."""
    return entities.pii_entities(documents(spark, folder), "doc_id", gazetteer=_names(spark, folder))


# Stand-ins for names: starts of sentences in conversations, of two and of three words.
NAME_PATTERNS = ("[A-Z][a-z]{2,} [a-z]{3,}", "[A-Z][a-z]+ [a-z]+ [a-z]+")


def _names(spark, folder):
    found = F.concat(*(F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(1)) for pattern in NAME_PATTERNS))
    phrases = table(spark, folder, "conversations").select(F.explode(found).alias("phrase")).distinct()
    return phrases.select(F.lit("PERSON").alias("entity"), "phrase")


def mask_person(spark, folder):
    masked = entities.mask_gazetteer(documents(spark, folder), _names(spark, folder), "doc_id")
    return masked.select("doc_id", "text", "named")


def mask_location(spark, folder):
    """Sentences about customers, with nation and region names as the gazetteer."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    places = nation.select(F.col("n_name").alias("phrase")).union(region.select("r_name"))
    gazetteer = places.select(F.lit("LOCATION").alias("entity"), "phrase")
    homes = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    customers = table(spark, folder, "customer").join(homes, F.col("c_nationkey") == F.col("n_nationkey"))
    sentence = F.format_string("%s of %s, %s.", "c_name", "n_name", "r_name")
    texts = customers.select("c_custkey", sentence.alias("text"))
    return entities.mask_gazetteer(texts, gazetteer, "c_custkey").select("c_custkey", "text", "named")


# The whole plan and its reports


def fitted(spark: SparkSession, folder: str) -> Models:
    """The models of the default plan, fitted once in a session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _models:
        _models[key] = Models(_profile(spark, folder), _toxicity(spark, folder))
    return _models[key]


def run(spark: SparkSession, folder: str) -> tuple[DataFrame, Timings, Models]:
    """The default plan over documents. Its written result serves all reports of a session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _runs:
        models = fitted(spark, folder)
        timings = Timings()
        rows = prepare(as_records(documents(spark, folder), "doc_id"), CONFIG, models, timings)
        _runs[key] = rows, timings, models
    return _runs[key]


def _report(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(run(spark, folder)[0])


def native_chain(spark, folder):
    """Stages 1-6 and the pattern masks, without models."""
    rows = prepare(as_records(documents(spark, folder), "doc_id"), CONFIG)
    return rows.select("id", "omit_reason", "omit_stage", "anonymized", "cleaned")


def whole_chain(spark, folder):
    rows = run(spark, folder)[0]
    return rows.select("id", "lang", "omit_reason", "omit_stage", "anonymized", "cleaned")


def shard_assignment(spark, folder):
    return outputs.shard_assignment(run(spark, folder)[0], SHARD_SIZE)


def written_shards(spark, folder):
    """Shards as read back from what was written."""
    path = new_path(spark, "shards")
    outputs.write_shards(run(spark, folder)[0], path, SHARD_SIZE)
    schema = "id bigint, cleaned string, anonymized boolean, html_extracted boolean, shard bigint"
    return spark.read.schema(schema).json(path)


def reread_outputs(spark, folder):
    """Both outputs as read back from what was written."""
    path = new_path(spark, "outputs")
    rows = run(spark, folder)[0]
    outputs.write_cleaned(rows, f"{path}/cleaned")
    outputs.write_omitted(rows, f"{path}/omitted")
    kept, omitted = jsonl.read_outputs(spark, path)
    nothing = F.lit(None).cast("string")
    return kept.select("id", nothing.alias("reason"), nothing.alias("lang"), F.col("cleaned").alias("text")).union(
        omitted.select("id", "reason", "lang", F.col("original").alias("text"))
    )


def insight_json(spark, folder):
    rows, timings, _ = run(spark, folder)
    return reports.insights(rows, timings.seconds)


def insight_counts(spark, folder):
    """The reproducible part of the insights, parsed back."""
    schema = "omit_reasons map<string, bigint>"
    parsed = reports.insights(run(spark, folder)[0]).select(F.from_json("insights", schema).alias("i"))
    return parsed.select(F.explode("i.omit_reasons").alias("omit_reason", "n"))


def insight_steps(spark, folder):
    """Calls, omits and percentage of each step as the insight document states them."""
    schema = "steps map<string, struct<number_of_calls: bigint, number_of_omits: bigint, omit_percentage: double>>"
    parsed = reports.insights(run(spark, folder)[0]).select(F.from_json("insights", schema).alias("i"))
    steps = parsed.select(F.explode("i.steps").alias("name", "step")).select("name", "step.*")
    return steps.withColumn("omit_percentage", F.round("omit_percentage", 6))


def measured(spark, folder):
    """The nine steps over documents with the models of the plan, each timed. Its result serves a session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _measured_runs:
        models = fitted(spark, folder)
        _measured_runs[key] = measured_run(as_records(documents(spark, folder), "doc_id"), CONFIG, models)
    return _measured_runs[key]


def part_timing(spark, folder):
    rows, timings, _ = run(spark, folder)
    return reports.part_timing(rows, timings.seconds)


def stage_timing(spark, folder):
    return reports.stage_timing(spark, measured(spark, folder)[1])


def step_measures(spark, folder):
    """The observed counts of each step, and whether its time was taken."""
    return stage_timing(spark, folder).select("stage", "name", "rows_in", "omits", (F.col("seconds") > 0).alias("timed"))


def measured_chain(spark, folder):
    rows = measured(spark, folder)[0]
    return rows.select("id", "lang", "omit_reason", "omit_stage", "anonymized", "cleaned")


def insight_document(spark, folder):
    """The whole document but for its times."""
    return reports.insights(run(spark, folder)[0])


def insight_times(spark, folder):
    """Of each step in the document of a measured run: its calls, and whether its times fit them."""
    rows, measures = measured(spark, folder)
    step = "struct<number_of_calls: bigint, total_time_seconds: double, average_time_per_call_seconds: double>"
    parsed = reports.insights(rows, measures=measures).select(F.from_json("insights", f"steps map<string, {step}>").alias("i"))
    steps = parsed.select(F.explode("i.steps").alias("name", "step")).select("name", "step.*")
    total = F.col("average_time_per_call_seconds") * F.col("number_of_calls")
    fits = (F.col("total_time_seconds") > 0) & (F.abs(total - F.col("total_time_seconds")) < 1e-6)
    return steps.select("name", "number_of_calls", fits.alias("timed"))


def stage_funnel(spark, folder):
    funnel = reports.stage_funnel(run(spark, folder)[0])
    return funnel.withColumn("omit_percent", F.round("omit_percent", 6))


def omit_reason_share(spark, folder):
    share = reports.omit_reason_share(run(spark, folder)[0])
    return share.withColumn("percent", F.round("percent", 6))


def length_histogram(spark, folder):
    bins = reports.length_histogram(run(spark, folder)[0])
    return bins.withColumn("density", F.round("density", 9))


def kept_flag_shares(spark, folder):
    shares = reports.kept_flag_shares(run(spark, folder)[0])
    percents = ("html_extracted_percent", "anonymized_percent")
    return shares.withColumns({name: F.round(name, 6) for name in percents})


def selection_rate(spark, folder):
    return reports.selection_rate(run(spark, folder)[0]).select(F.round("selection_rate", 9).alias("selection_rate"))


def custom_steps(spark, folder):
    """A chain of user steps: an attribute, a filter on it, a batch filter and a modifier."""
    vowels = F.regexp_count("cleaned", F.lit("[aeiou]"))
    steps = [
        attribute_step({"vowels": vowels}),
        filter_step(F.when(F.col("vowels") < 100, "few_vowels")),
        batch_filter_step(lambda texts: texts.str.contains("!!", regex=False), "shouting"),
        modify_step(F.concat(F.lit("> "), "cleaned")),
    ]
    rows = run_steps(as_records(documents(spark, folder), "doc_id"), steps)
    return rows.select("id", "vowels", "omit_reason", "omit_stage", "cleaned")


def stream_chain(spark, folder):
    """The whole plan over documents arriving in several batches, with the models of the batch run."""
    models = fitted(spark, folder)
    out = new_path(spark, "stream")
    arriving = _arriving(spark, folder)
    incremental.start_stream(arriving, out, CONFIG, models, "doc_id").awaitTermination()
    rows = incremental.read_batches(spark, out, "rows")
    return rows.select("id", "lang", "omit_reason", "omit_stage", "anonymized", "cleaned")


QUERIES: dict[str, Query] = {
    "scan_documents": scan_documents,
    "read_lines": read_lines,
    "nonblank_text": nonblank_text,
    "input_limit": input_limit,
    "input_limit_lines": input_limit_lines,
    "assign_ids": assign_ids,
    "html_unescape": html_unescape,
    "strip_control": _columns(text=normalize.strip_control),
    "straight_quotes": _columns(text=normalize.straight_quotes),
    "collapse_whitespace": _columns(text=normalize.collapse_whitespace),
    "normalize": _columns(text=normalize.normalize),
    "tokenize": _columns(tokens=lambda text: F.array_join(at.tokenize(text), " ")),
    "text_attributes": _columns(
        char_count=at.char_count,
        token_count=lambda text: F.size(at.tokenize(text)),
        ascii_ratio=at.ascii_ratio,
        symbol_ratio=at.symbol_ratio,
    ),
    "filter_too_short": _where(lambda text: quality.too_short(F.length(text), CONFIG)),
    "filter_too_long": _where(lambda text: quality.too_long(F.length(text), CONFIG)),
    "filter_non_ascii": _where(lambda text: quality.non_ascii_heavy(at.ascii_ratio(text), CONFIG)),
    "filter_symbol_heavy": _where(lambda text: quality.symbol_heavy(at.symbol_ratio(text), CONFIG)),
    "filter_long_repeat": _where(quality.long_repeat),
    "preliminary_reason": preliminary_reason,
    "is_html": is_html,
    "html_extract": html_extract,
    "html_extract_element": partial(html_extract, scope="element"),
    "html_accept": html_accept,
    "line_cleanup": _columns(text=html.line_cleanup),
    "prepared_pages": prepared_pages,
    "code_function_def": _where(code.function_def),
    "code_method_calls": _columns(method_calls=code.method_calls),
    "code_assignments": _columns(assignments=code.assignments),
    "code_line_features": code_line_features,
    "code_char_features": code_char_features,
    "code_token_features": code_token_features,
    "code_reason": code_verdict,
    "fingerprint": _columns(fingerprint=fingerprint_of),
    "dedup_keep": dedup_keep,
    "dedup_mark": dedup_mark,
    "dedup_groups": dedup_groups,
    "stream_dedup": stream_dedup,
    "language_profile": language_profile,
    "detect_language": language,
    "filter_language": filter_language,
    "language_bypass": language_bypass,
    "toxicity_weights": toxicity_weights,
    "toxicity_score": toxicity_score,
    "filter_toxicity": filter_toxicity,
    "mask_email": _columns(text=lambda text: pii.mask(text, "EMAIL_ADDRESS")),
    "mask_ip": _columns(text=lambda text: pii.mask(text, "IP_ADDRESS")),
    "mask_phone": _columns(text=lambda text: pii.mask(text, "PHONE_NUMBER")),
    "mask_patterns": _columns(text=pii.mask_patterns),
    "mask_person": mask_person,
    "mask_location": mask_location,
    "pii_entities": pii_entities,
    "pii_entities_names": pii_entities_names,
    "neutralize_pronouns": _columns(text=pii.neutralize_pronouns),
    "conversation_pronouns": conversation_pronouns,
    "anonymized_flag": anonymized_flag,
    "native_chain": native_chain,
    "whole_chain": whole_chain,
    "stream_chain": stream_chain,
    "custom_steps": custom_steps,
    "cleaned_output": _report(kept_rows),
    "omitted_output": _report(omitted_rows),
    "reread_outputs": reread_outputs,
    "route_counts": _report(reports.route_counts),
    "shard_assignment": shard_assignment,
    "written_shards": written_shards,
    "insight_json": insight_json,
    "insight_counts": insight_counts,
    "insight_steps": insight_steps,
    "omit_reason_counts": _report(reports.omit_reason_counts),
    "omit_reason_share": omit_reason_share,
    "stage_funnel": stage_funnel,
    "stage_timing": stage_timing,
    "part_timing": part_timing,
    "step_measures": step_measures,
    "measured_chain": measured_chain,
    "insight_document": insight_document,
    "insight_times": insight_times,
    "length_series": _report(reports.length_series),
    "length_histogram": length_histogram,
    "kept_flag_shares": kept_flag_shares,
    "redaction_counts": _report(reports.redaction_counts),
    "selection_rate": selection_rate,
}

# The same operators over texts made from all documents so that each rule fires.


def made_nonblank_text(spark, folder):
    """Blank and missing texts vanish."""
    docs = table(spark, folder, "documents").select("doc_id", F.expr(MADE_BLANKS).alias("text"))
    return docs.filter(jsonl.nonblank(F.col("text"))).select("doc_id")


def made_pages(spark, folder):
    """Pages after extraction, as they were where the parser fails or too little is left."""
    made = pages(spark, folder).select("page_id", F.expr(MADE_HTML).alias("html"))
    raw = made.withColumn("raw", html.raw_page_text(F.col("html"), "element"))
    lines = raw.withColumn("lines", html.line_cleanup(F.col("raw")))
    taken = html.accepted(F.col("lines"), CONFIG.min_char_len)
    return lines.select("page_id", F.coalesce(taken, "html").alias("text"), taken.isNotNull().alias("html_extracted"))


def made_code_rules(spark, folder):
    """Which of the rules over words and lines hold, each by itself."""
    share = lambda column, of: F.col(column) / F.greatest(F.col(of), F.lit(1))
    stop, punctuation = share("stopwords", "words"), share("punctuation", "chars")
    codey, indented = share("codey_lines", "lines"), share("indented_lines", "lines")
    return _measured(spark, folder, made_nonblank).select(
        "doc_id",
        ((indented > 0.5) & (codey > 0.25)).alias("c6"),
        ((stop < 0.05) & (F.col("keywords") >= 3) & (punctuation > 0.15)).alias("c10"),
        ((F.col("words") < 15) & (F.col("keywords") >= 2) & (stop < 0.05) & (punctuation > 0.12)).alias("c13"),
    )


def made_nonblank(spark, folder):
    """What no blank text is left of, as every rule below sees it."""
    return made_documents(spark, folder).filter(jsonl.nonblank(F.col("text")))


QUERIES |= {
    "made_nonblank_text": made_nonblank_text,
    "made_pages": made_pages,
    "made_code_rules": made_code_rules,
    "made_strip_control": _columns(made_nonblank, text=normalize.strip_control),
    "made_straight_quotes": _columns(made_nonblank, text=normalize.straight_quotes),
    "made_normalize": _columns(made_nonblank, text=normalize.normalize),
    "made_filter_non_ascii": _where(lambda text: quality.non_ascii_heavy(at.ascii_ratio(text), CONFIG), made_nonblank),
    "made_filter_long_repeat": _where(quality.long_repeat, made_nonblank),
    "made_preliminary_reason": partial(preliminary_reason, source=made_nonblank),
    "made_code_function_def": _where(code.function_def, made_nonblank),
    "made_code_method_calls": _columns(made_nonblank, method_calls=code.method_calls),
    "made_code_assignments": _columns(made_nonblank, assignments=code.assignments),
    "made_code_line_features": partial(code_line_features, source=made_nonblank),
    "made_code_char_features": partial(code_char_features, source=made_nonblank),
    "made_code_token_features": partial(code_token_features, source=made_nonblank),
    "made_code_reason": partial(code_verdict, source=made_nonblank),
}
