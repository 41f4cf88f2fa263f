"""Time the headline queries: one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the number of local cores. Each
query runs once to warm up and is then timed; writes go to the noop sink or the
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from checks import queries as q
from checks.compare import session
from textsieve.config import PrepConfig
from textsieve.functions.attributes import attributes, tokenize
from textsieve.functions.fingerprint import fingerprint
from textsieve.functions.normalize import normalize
from textsieve.functions.quality import preliminary_reason
from textsieve.operators import dedup
from textsieve.operators.language import detect_language
from textsieve.operators.steps import (
    as_records,
    attribute_step,
    code_step,
    html_step,
    mask_live_rows,
    run_steps,
)
from textsieve.operators.toxicity import score_toxicity
from textsieve.plans.prepare import Models, prepare
from textsieve.staging import write_staged

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def sink(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session(CPUS)
    # One small file is one split; a real input has many, and so have these tables.
    documents = write_staged(q.documents(spark, FOLDER).repartition(2 * int(CPUS), "doc_id"), "documents")
    pages = write_staged(q.pages(spark, FOLDER).repartition(2 * int(CPUS), "page_id"), "pages-in")
    models = Models(q._profile(spark, FOLDER), q._toxicity(spark, FOLDER))

    # Each stage gets what the stages before it leave, written beforehand.
    text = F.col("text")
    plain = write_staged(documents.select("doc_id", normalize(text).alias("text")), "plain")
    measured = write_staged(plain.withColumns(attributes(text)), "measured")
    records = write_staged(as_records(plain, "doc_id"), "records")
    tokens = attribute_step({"tokens": tokenize(F.col("cleaned"))})
    measured_records = write_staged(run_steps(records, [tokens]), "records")
    page_records = write_staged(as_records(pages, "page_id", "html", "url"), "pages")

    stages: dict[str, tuple[int, Callable[[], None]]] = {}
    n_documents, n_pages = documents.count(), pages.count()

    def stage(name: str, rows: int, make: Callable[[], DataFrame]) -> None:
        stages[name] = rows, lambda: sink(make())

    stage("normalize", n_documents, lambda: documents.select("doc_id", normalize(text)))
    stage("attributes", n_documents, lambda: plain.select("doc_id", *(c.alias(n) for n, c in attributes(text).items())))
    reason = preliminary_reason(text, F.col("char_count"), F.col("ascii_ratio"), F.col("symbol_ratio"))
    stage("preliminary", n_documents, lambda: measured.select("doc_id", reason.alias("r")))
    stage("html", n_pages, lambda: run_steps(page_records, [html_step()]))
    stage("code", n_documents, lambda: run_steps(measured_records, [code_step()]))
    prints = plain.select("doc_id", fingerprint(text).alias("fingerprint"))
    stage("dedup", n_documents, lambda: dedup.dedup_mark(write_staged(prints, "prints"), "doc_id"))
    stage("language", n_documents, lambda: detect_language(plain, models.language, "doc_id"))
    stage("toxicity", n_documents, lambda: score_toxicity(plain, models.toxicity, "doc_id"))
    stage("pii", n_documents, lambda: mask_live_rows(records, None, False))
    config = PrepConfig(noise_scope="element")
    stages["whole_chain_documents"] = (
        n_documents,
        lambda: prepare(as_records(documents, "doc_id"), models=models) and None,
    )
    stages["whole_chain_pages"] = (
        n_pages,
        lambda: prepare(as_records(pages, "page_id", "html", "url"), config, models) and None,
    )
    for name in ("stage_funnel", "length_histogram", "redaction_counts", "shard_assignment"):
        stages[name] = n_documents, lambda name=name: sink(q.QUERIES[name](spark, FOLDER))

    seconds: dict[str, float] = {}
    for name, (_, run) in stages.items():
        times = []
        for _ in range(3):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 3)

    rates = {name: round(stages[name][0] / max(value, 1e-9), 1) for name, value in seconds.items()}
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rates": rates,
        "rows": {"documents": n_documents, "pages": n_pages},
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
