"""The default nine-stage plan, laid out so that the text moves as little as possible.

1. One pass over the input runs stages 1-5 and is written ("base").
2. Stages 6 and 7 only give verdicts. They are worked out on narrow (id, …)
   tables, matched on the unique id, and the rows they omit are written
   ("verdicts").
3. Base meets the verdicts once. Their written size lets Catalyst choose: a
   broadcast, with no text shuffled, or one shuffle on id. Stages 8 and 9 run in
   the same pass, and the result is written with kept and omitted rows apart.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from textsieve.config import ENGLISH, PrepConfig, STAGES
from textsieve.functions.fingerprint import fingerprint
from textsieve.operators.dedup import later_copies
from textsieve.operators.entities import gazetteer_hits
from textsieve.operators.language import LanguageProfile, detect_language, language_reason
from textsieve.operators.steps import (
    ColumnModel,
    alive,
    attributes_step,
    code_step,
    filter_step,
    html_step,
    language_step,
    live,
    mask_live_rows,
    normalize_step,
    preliminary_step,
    run_steps,
    toxicity_step,
)
from textsieve.operators.toxicity import ToxicityModel, score_toxicity, toxicity_reason
from textsieve.staging import new_path, write_staged, write_texts

STAGE_NUMBER = {name: number for number, name in enumerate(STAGES, 1)}


@dataclass(frozen=True)
class Models:
    """What stages 7-9 use. Language and toxicity are a fitted LanguageProfile and ToxicityModel,
    or functions from a text Column to a label or score Column, such as a batch_model.
    entities maps text to array<struct<entity, start, end>>; gazetteer is a table
    (entity, phrase). An empty slot leaves its part out.
    """

    language: LanguageProfile | ColumnModel | None = None
    toxicity: ToxicityModel | ColumnModel | None = None
    entities: ColumnModel | None = None
    gazetteer: DataFrame | None = None


@dataclass
class Timings:
    """Wall seconds of each written part of a run."""

    seconds: dict[str, float] = field(default_factory=dict)

    @contextmanager
    def part(self, name: str) -> Iterator[None]:
        start = time.perf_counter()
        yield
        self.seconds[name] = self.seconds.get(name, 0.0) + time.perf_counter() - start


def base_rows(records: DataFrame, config: PrepConfig = PrepConfig()) -> DataFrame:
    """Stages 1-5 and the fingerprint of the rows still alive. Not written yet."""
    steps = [
        normalize_step(),
        attributes_step(),
        preliminary_step(config),
        html_step(config),
        code_step(),
    ]
    rows = run_steps(records, steps).drop("tokens")
    return rows.withColumn("fingerprint", live(fingerprint(F.col("cleaned"))))


def _verdicts(base: DataFrame, config: PrepConfig, models: Models, later: DataFrame) -> DataFrame:
    """(id, omit_reason, omit_stage, lang, toxic) of rows omitted as copies or by the language
    profile, and of rows that a fitted toxicity model puts above the threshold."""
    living = base.filter(alive())
    rows = living.select("id", "lang", "omit_reason", "omit_stage")
    rows = rows.join(later.withColumn("_later", F.lit(True)), "id", "left")
    rows = filter_step(F.when(F.col("_later"), "duplicate"))(rows, STAGE_NUMBER["dedup"]).drop("_later")
    if config.require_english and isinstance(models.language, LanguageProfile):
        labels = detect_language(living, models.language, text="cleaned")
        rows = rows.drop("lang").join(labels, "id", "left").withColumn("lang", live(F.col("lang")))
        rows = filter_step(language_reason(F.col("lang"), ENGLISH))(rows, STAGE_NUMBER["language"])
    toxic = F.lit(False)
    if isinstance(models.toxicity, ToxicityModel):
        scores = score_toxicity(living, models.toxicity, text="cleaned")
        above = scores.filter(toxicity_reason(F.col("toxicity"), config.toxicity_threshold).isNotNull())
        rows = rows.join(above.select("id", F.lit(True).alias("_toxic")), "id", "left")
        toxic = F.coalesce("_toxic", F.lit(False))
    found = rows.withColumn("toxic", toxic).filter(~alive() | F.col("toxic"))
    return found.select("id", "omit_reason", "omit_stage", "lang", "toxic")


def prepare(
    records: DataFrame,
    config: PrepConfig = PrepConfig(),
    models: Models = Models(),
    timings: Timings | None = None,
    later: DataFrame | None = None,
    base: DataFrame | None = None,
) -> DataFrame:
    """Run the nine stages over rows made by as_records; returns the written result.

    base and later let a caller that already has the written stages 1-5, or its
    own table of duplicate ids (a stream does), pass them in.
    """
    timings = timings or Timings()
    if base is None:
        with timings.part("stages 1-5"):
            base = write_texts(base_rows(records, config), new_path(records.sparkSession, "base"))
    if later is None:
        with timings.part("dedup"):
            pairs = base.filter(alive()).select("id", "fingerprint")
            later = write_staged(later_copies(pairs), "later-copies")
    with timings.part("verdicts"):
        verdicts = write_staged(_verdicts(base, config, models, later), "verdicts")

    with timings.part("masks and output"):
        found = verdicts.select(
            "id",
            F.col("omit_reason").alias("_reason"),
            F.col("omit_stage").alias("_stage"),
            F.col("lang").alias("_lang"),
            F.col("toxic").alias("_toxic"),
        )
        rows = base.drop("fingerprint").join(found, "id", "left")
        rows = rows.withColumns(
            {
                "omit_reason": F.coalesce("omit_reason", "_reason"),
                "omit_stage": F.coalesce("omit_stage", "_stage"),
                "lang": F.coalesce("lang", "_lang"),
            }
        ).drop("_reason", "_stage", "_lang")
        if config.require_english:
            if isinstance(models.language, LanguageProfile):
                # Survivors of the profile's verdicts are English by definition.
                rows = rows.withColumn("lang", F.coalesce(F.col("lang"), live(F.lit(ENGLISH))))
            else:
                rows = language_step(models.language, ENGLISH)(rows, STAGE_NUMBER["language"])
        if isinstance(models.toxicity, ToxicityModel):
            toxicity = filter_step(F.when(F.col("_toxic"), "toxic_content"))
        else:
            toxicity = toxicity_step(models.toxicity, config.toxicity_threshold)
        rows = toxicity(rows, STAGE_NUMBER["toxicity"]).drop("_toxic")
        if models.gazetteer is not None:
            hits = gazetteer_hits(base.filter(alive()), models.gazetteer, text="cleaned", masked=True)
            rows = rows.join(hits, "id", "left")
        rows = mask_live_rows(rows, models.entities, models.gazetteer is not None)
        return write_staged(rows.withColumn("kept", alive()), "rows", partition_by="kept")


def kept_rows(rows: DataFrame) -> DataFrame:
    return rows.filter("kept").select("id", "cleaned", "anonymized", "html_extracted")


def omitted_rows(rows: DataFrame) -> DataFrame:
    return rows.filter("not kept").select("id", F.col("omit_reason").alias("reason"), "lang", "original")
