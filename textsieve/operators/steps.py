"""Steps of a chain. A step takes the rows and its number, and returns the rows.

Rows carry the columns made by as_records. A filter only fills an empty
omit_reason, and modifiers only touch live rows, so a row gets exactly one
reason and later steps leave it alone. Any function with this signature is a
step; the builders below make one out of Column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType

from textsieve.config import PrepConfig
from textsieve.functions import code
from textsieve.functions.attributes import attributes
from textsieve.functions.fingerprint import fingerprint
from textsieve.functions.html import accepted, line_cleanup, raw_page_text
from textsieve.functions.normalize import normalize
from textsieve.functions.pii import (
    changed,
    mask_patterns,
    mask_spans,
    neutralize_pronouns,
)
from textsieve.functions.quality import preliminary_reason
from textsieve.operators.dedup import later_copies
from textsieve.operators.entities import gazetteer_hits, mask_names
from textsieve.operators.language import LanguageProfile, detect_language, language_reason
from textsieve.operators.toxicity import ToxicityModel, score_toxicity, toxicity_reason
from textsieve.staging import write_scratch, write_staged

Step = Callable[[DataFrame, int], DataFrame]
ColumnModel = Callable[[Column], Column]


def alive() -> Column:
    return F.col("omit_reason").isNull()


def live(column: Column) -> Column:
    """The column on live rows, null on others. Keeps dead rows out of Python models."""
    return F.when(alive(), column)


def as_records(df: DataFrame, id_col: str = "id", text: str = "text", url: str | None = None) -> DataFrame:
    """Rows ready for a chain; blank texts are left out."""
    original = F.col(text)
    kept = df.filter(original.isNotNull() & (original != ""))
    return kept.select(
        F.col(id_col).alias("id"),
        original.alias("original"),
        (F.col(url) if url else F.lit(None).cast("string")).alias("url"),
        original.alias("cleaned"),
        F.lit(None).cast("string").alias("lang"),
        F.lit(False).alias("anonymized"),
        F.lit(False).alias("html_extracted"),
        F.lit(None).cast("string").alias("omit_reason"),
        F.lit(None).cast("int").alias("omit_stage"),
    )


def run_steps(rows: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Apply the steps in order, numbered from 1."""
    for number, step in enumerate(steps, 1):
        rows = step(rows, number)
    return rows


def filter_step(reason: Column) -> Step:
    """Omit live rows for which reason is not null."""

    def step(rows: DataFrame, number: int) -> DataFrame:
        rows = rows.withColumn("_reason", live(reason))
        stage = F.when(F.col("_reason").isNotNull(), number)
        return rows.withColumns(
            {
                "omit_reason": F.coalesce("omit_reason", "_reason"),
                "omit_stage": F.coalesce(F.col("omit_stage"), stage),
            }
        ).drop("_reason")

    return step


def modify_step(text: Column, flag: str | None = None) -> Step:
    """Replace the text of live rows where text is not null, and raise the flag there."""

    def step(rows: DataFrame, number: int) -> DataFrame:
        rows = rows.withColumn("_text", live(text))
        changes = {"cleaned": F.coalesce("_text", "cleaned")}
        if flag:
            changes[flag] = F.col(flag) | F.col("_text").isNotNull()
        return rows.withColumns(changes).drop("_text")

    return step


def attribute_step(columns: dict[str, Column]) -> Step:
    """Add measured columns on live rows."""

    def step(rows: DataFrame, number: int) -> DataFrame:
        return rows.withColumns({name: live(column) for name, column in columns.items()})

    return step


def batch_filter_step(
    omit: Callable[[pd.Series], Iterable[bool]], reason: str, column: str = "cleaned"
) -> Step:
    """Omit rows by a verdict over a batch of values, in their order. Dead rows are not sent."""

    def verdicts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            present = batch[batch.notna()]
            found = pd.Series(list(omit(present)), index=present.index, dtype=bool)
            yield found.reindex(batch.index, fill_value=False)

    # The types are given by hand because annotations are text in this module.
    verdicts.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    verdict = F.pandas_udf(verdicts, BooleanType())
    return filter_step(F.when(verdict(live(F.col(column))), reason))


def normalize_step() -> Step:
    return modify_step(normalize(F.col("cleaned")))


def attributes_step() -> Step:
    """The measures of stage 2; null on dead rows."""

    def step(rows: DataFrame, number: int) -> DataFrame:
        rows = rows.withColumn("_text", live(F.col("cleaned")))
        rows = rows.withColumns(attributes(F.col("_text"))).drop("_text")
        return rows.withColumn("token_count", F.size("tokens"))

    return step


def preliminary_step(config: PrepConfig = PrepConfig()) -> Step:
    return filter_step(
        preliminary_reason(
            F.col("cleaned"), F.col("char_count"), F.col("ascii_ratio"), F.col("symbol_ratio"), config
        )
    )


def html_step(config: PrepConfig = PrepConfig()) -> Step:
    def step(rows: DataFrame, number: int) -> DataFrame:
        page = raw_page_text(live(F.col("cleaned")), config.noise_scope)
        rows = rows.withColumn("_page", page)
        text = accepted(F.col("_lines"), config.min_char_len)
        rows = rows.withColumn("_lines", line_cleanup(F.col("_page"))).drop("_page")
        return modify_step(text, "html_extracted")(rows, number).drop("_lines")

    return step


def code_features(rows: DataFrame, text: str = "cleaned", tokens: str = "tokens") -> DataFrame:
    """Add the counts the code rules compare, each worked out once."""
    low = F.lower(F.col(text))
    words = code.words_or_pieces(F.col(tokens), F.col("_low"))
    return (
        rows.withColumns({"_low": low, "_punctuation": code.code_punctuation(F.col(text))})
        .withColumns({"_lines": code.text_lines(F.col("_low")), "_words": words})
        .withColumns(
            {
                "strong_pattern": code.strong_pattern(F.col(text)),
                "lines": F.size("_lines"),
                "codey_lines": code.codey_lines(F.col("_lines")),
                "indented_lines": code.indented_lines(F.col("_low")),
                "punctuation": F.length("_punctuation"),
                "bracket_pairs": code.bracket_pairs(F.col("_punctuation")),
                "words": F.size("_words"),
                "stopwords": code.hits(F.col("_words"), code.STOPWORDS),
                "keywords": code.hits(F.col("_words"), code.KEYWORDS),
                "chars": F.length(text),
            }
        )
        .drop("_low", "_punctuation", "_lines", "_words")
    )


CODE_FEATURES = (
    "strong_pattern", "lines", "codey_lines", "indented_lines", "punctuation", "bracket_pairs",
    "words", "stopwords", "keywords", "chars",
)


def code_reason() -> Column:
    """Reason from the columns of code_features."""
    by_lines = code.line_rule(F.col("lines"), F.col("codey_lines"), F.col("indented_lines"))
    by_words = code.word_rule(
        F.col("words"),
        F.col("stopwords"),
        F.col("keywords"),
        F.col("punctuation"),
        F.col("bracket_pairs"),
        F.col("chars"),
    )
    found = F.col("strong_pattern") | ((F.col("lines") > 0) & (by_lines | by_words))
    return F.when(found, "code_snippet")


def code_step() -> Step:
    def step(rows: DataFrame, number: int) -> DataFrame:
        # Dead rows are measured on null, which costs nothing.
        rows = rows.withColumns({"_text": live(F.col("cleaned")), "_tokens": live(F.col("tokens"))})
        rows = code_features(rows, "_text", "_tokens").drop("_text", "_tokens")
        return filter_step(code_reason())(rows, number).drop(*CODE_FEATURES)

    return step


def dedup_step(written: bool = False, scratch: list[str] | None = None) -> Step:
    """Only rows alive at this step take part. Writes its input, which it reads twice, unless
    the caller says that it is a written table already.

    Here as in the two steps below, what rows are joined with is a written table of the rows that
    the step omits: its size is known, so texts are only shuffled for one too large to broadcast.
    Its path is noted in scratch.
    """

    def step(rows: DataFrame, number: int) -> DataFrame:
        rows = rows if written else write_staged(rows, "rows")
        prints = rows.filter(alive()).select("id", fingerprint(F.col("cleaned")).alias("fingerprint"))
        later = write_scratch(later_copies(write_staged(prints, "fingerprints")), "later-copies", scratch)
        rows = rows.join(later.withColumn("_later", F.lit(True)), "id", "left")
        return filter_step(F.when(F.col("_later"), "duplicate"))(rows, number).drop("_later")

    return step


def language_step(
    model: LanguageProfile | ColumnModel | None,
    wanted: str = "en",
    written: bool = False,
    scratch: list[str] | None = None,
) -> Step:
    """Label live rows and omit other languages. Without a model rows pass unlabelled."""

    def step(rows: DataFrame, number: int) -> DataFrame:
        if model is None:
            return rows
        if isinstance(model, LanguageProfile):
            rows = rows if written else write_staged(rows, "rows")
            labels = detect_language(rows.filter(alive()), model, text="cleaned")
            others = labels.filter(language_reason(F.col("lang"), wanted).isNotNull())
            others = write_scratch(others, "other-languages", scratch)
            rows = rows.drop("lang").join(others, "id", "left")
            # A null id meets no label; all other live rows without one here are in the wanted language.
            rows = rows.withColumn("lang", F.coalesce(F.col("lang"), live(F.when(F.col("id").isNotNull(), wanted))))
        else:
            rows = rows.withColumn("lang", F.coalesce(model(live(F.col("cleaned"))), F.col("lang")))
        return filter_step(language_reason(F.col("lang"), wanted))(rows, number)

    return step


def toxicity_step(
    model: ToxicityModel | ColumnModel | None,
    threshold: float,
    written: bool = False,
    scratch: list[str] | None = None,
) -> Step:
    """Omit live rows above the threshold. A fitted model is met on a narrow table, as in language_step."""

    def step(rows: DataFrame, number: int) -> DataFrame:
        if model is None:
            return rows
        if isinstance(model, ToxicityModel):
            rows = rows if written else write_staged(rows, "rows")
            scores = score_toxicity(rows.filter(alive()), model, text="cleaned")
            above = scores.filter(toxicity_reason(F.col("toxicity"), threshold).isNotNull())
            rows = rows.join(write_scratch(above, "toxic", scratch), "id", "left")
        else:
            rows = rows.withColumn("toxicity", model(live(F.col("cleaned"))))
        reason = toxicity_reason(F.col("toxicity"), threshold)
        return filter_step(reason)(rows, number).drop("toxicity")

    return step


def pii_step(
    entities: ColumnModel | None = None, gazetteer: DataFrame | None = None, written: bool = False
) -> Step:
    """Mask pattern entities, then names by model and gazetteer, then pronouns."""

    def step(rows: DataFrame, number: int) -> DataFrame:
        if gazetteer is not None:
            rows = rows if written else write_staged(rows, "rows")
            hits = gazetteer_hits(rows.filter(alive()), gazetteer, text="cleaned", masked=True)
            rows = rows.join(hits, "id", "left")
        return mask_live_rows(rows, entities, gazetteer is not None)

    return step


def mask_live_rows(rows: DataFrame, entities: ColumnModel | None, has_names: bool) -> DataFrame:
    """The masks of pii_step; with has_names, rows carry the names found by gazetteer_hits."""
    rows = rows.withColumn("_text", mask_patterns(live(F.col("cleaned"))))
    if entities is not None:
        rows = rows.withColumn("_spans", entities(F.col("_text")))
        rows = rows.withColumn("_text", mask_spans(F.col("_text"), F.col("_spans"))).drop("_spans")
    if has_names:
        rows = rows.withColumn("_text", mask_names(F.col("_text"), F.col("names"))).drop("names")
    rows = rows.withColumn("_text", neutralize_pronouns(F.col("_text")))
    masked = F.coalesce(changed(F.col("_text"), F.col("cleaned")), F.lit(False))
    return rows.withColumns(
        {"anonymized": F.col("anonymized") | masked, "cleaned": F.coalesce("_text", "cleaned")}
    ).drop("_text")
