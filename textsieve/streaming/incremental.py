"""The batch plan over arriving rows. Only deduplication keeps state between batches.

Results are folders with one subfolder per batch. The state of deduplication is
a store of fingerprints, laid out by their first digits. A batch that runs again
overwrites its own and reads only what earlier batches left, so a restart
changes nothing. Duplicates are emitted with their reason, which is why the
state is a table of fingerprints and not dropDuplicates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from textsieve.config import PrepConfig
from textsieve.operators.dedup import first_copies
from textsieve.operators.ids import assign_ids
from textsieve.operators.steps import alive, as_records
from textsieve.plans.prepare import Models, base_rows, prepare
from textsieve.sources.jsonl import nonblank, parse_lines
from textsieve.staging import delete, write_staged

#: A store has 16 ** PREFIX_DIGITS parts; a batch reads those that its fingerprints fall into.
PREFIX_DIGITS = 2
_RUNS_SCHEMA = "run string, rows bigint"
_LEDGER_SCHEMA = "total bigint"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The table under path, or None if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _last_before(spark: SparkSession, folder: str, schema: str, batch: int) -> DataFrame | None:
    """What the last batch before this one left under folder/batch=N.

    Batches follow each other, so that it is the one before. Only if that one left
    nothing are all looked through.
    """
    if batch > 0 and (found := _stored(spark, f"{folder}/batch={batch - 1}", schema)) is not None:
        return found
    every = _stored(spark, folder, f"{schema}, batch bigint")
    if every is None:
        return None
    last = every.filter(F.col("batch") < batch).agg(F.max("batch")).first()[0]
    return None if last is None else every.filter(F.col("batch") == last).drop("batch")


def _prefix(fingerprint: Column) -> Column:
    return F.left(fingerprint, F.lit(PREFIX_DIGITS))


class FingerprintStore:
    """Fingerprints seen so far, in a few runs sorted by size, each laid out by prefix.

    A batch adds one run. A run that is not half as large as the one before it is
    merged into it in the same write, so that there are at most as many runs as
    the store's size has binary digits, and each fingerprint is rewritten that
    often at most. Which runs make up the store after a batch is written last, as
    that batch's list; a batch that runs again starts from the list of the batch
    before it, whose runs stay until the next batch is through.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def _runs(self, batch: int) -> list[tuple[str, int]]:
        """Name and rows of the runs that the batches before this one left, largest first."""
        last = _last_before(self.spark, f"{self.folder}/lists", _RUNS_SCHEMA, batch)
        return [] if last is None else [(row["run"], row["rows"]) for row in last.orderBy(F.desc("rows"), "run").collect()]

    def _read(self, names: list[str]) -> DataFrame:
        """Fingerprints of these runs, with the prefix they are laid out by."""
        paths = [f"{self.folder}/runs/{name}" for name in names]
        parts = [self.spark.read.schema("fingerprint string, prefix string").parquet(path) for path in paths]
        table = parts[0]
        for part in parts[1:]:
            table = table.unionAll(part)
        return table

    def known(self, batch: int, wanted: DataFrame) -> DataFrame:
        """Fingerprints stored before this batch in the parts that those of wanted fall into.

        There are at most 16 ** PREFIX_DIGITS different prefixes; they become a
        filter on folders, so that the other parts are not read.
        """
        runs = self._runs(batch)
        if not runs:
            return self.spark.createDataFrame([], "fingerprint string")
        prefixes = [row[0] for row in wanted.select(_prefix(F.col("fingerprint"))).distinct().collect() if row[0] is not None]
        return self._read([name for name, _ in runs]).filter(F.col("prefix").isin(prefixes)).select("fingerprint")

    def add(self, batch: int, fresh: DataFrame) -> None:
        """Store a batch's new fingerprints: a written table of different ones, none of them stored."""
        before = self._runs(batch)
        runs, size, merged = list(before), fresh.count(), []
        while runs and runs[-1][1] < 2 * size:
            name, rows = runs.pop()
            merged.append(name)
            size += rows
        if size:
            new = fresh.select("fingerprint").withColumn("prefix", _prefix(F.col("fingerprint")))
            if merged:
                new = new.unionByName(self._read(merged))
            laid_out = new.repartition("prefix").sortWithinPartitions("prefix", "fingerprint")
            laid_out.write.mode("overwrite").partitionBy("prefix").parquet(f"{self.folder}/runs/after-{batch}")
            runs.append((f"after-{batch}", size))
        listed = self.spark.createDataFrame(runs, _RUNS_SCHEMA).coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self.folder}/lists/batch={batch}")
        # Runs that the batch before merged: no batch starts from them any more.
        for name in {name for name, _ in self._runs(batch - 1)} - {name for name, _ in before} if batch > 0 else ():
            delete(self.spark, f"{self.folder}/runs/{name}")


def duplicates_with_store(pairs: DataFrame, store: str, batch: int) -> DataFrame:
    """Ids of (fingerprint, id) pairs seen earlier in the batch or in an earlier batch.

    Writes the batch's new fingerprints to the store and returns a written table.
    A fingerprint appears once on each side of the join with the store, however
    many copies a batch holds.
    """
    kept = FingerprintStore(pairs.sparkSession, store)
    firsts = first_copies(pairs).withColumn("fingerprint", F.coalesce("fingerprint", F.lit("none")))
    firsts = write_staged(firsts, "first-copies")
    fresh = write_staged(firsts.join(kept.known(batch, firsts), "fingerprint", "left_anti"), "fresh")
    kept.add(batch, fresh)
    return write_staged(pairs.select("id").join(fresh.select("id"), "id", "left_anti"), "later-copies")


class Ledger:
    """How many rows all batches so far have numbered, one row per batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def before(self, batch: int) -> int:
        """Rows of the batches before this one; read from the last of them alone."""
        last = _last_before(self.spark, self.folder, _LEDGER_SCHEMA, batch)
        return 0 if last is None else last.first()["total"]

    def enter(self, batch: int, total: int) -> None:
        row = self.spark.createDataFrame([(total,)], _LEDGER_SCHEMA).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")


def process_batch(
    records: DataFrame, batch: int, folder: str, config: PrepConfig, models: Models
) -> DataFrame:
    """Run the nine stages over one batch and write its rows under folder/rows."""
    base = write_staged(base_rows(records, config), "base")
    pairs = base.filter(alive()).select("id", "fingerprint")
    later = duplicates_with_store(pairs, f"{folder}/fingerprints", batch)
    rows = prepare(records, config, models, later=later, base=base)
    rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")
    return rows


def start_stream(
    arriving: DataFrame,
    folder: str,
    config: PrepConfig = PrepConfig(),
    models: Models = Models(),
    id_col: str = "id",
    text: str = "text",
    on_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Process all rows that have arrived, then stop. Run again for later arrivals.

    arriving is a streaming DataFrame with a unique id. on_batch gets the written
    rows of each batch, for further outputs.
    """

    def handle(frame: DataFrame, batch: int) -> None:
        rows = process_batch(as_records(frame, id_col, text), batch, folder, config, models)
        if on_batch:
            on_batch(rows, batch)

    return (
        arriving.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def start_jsonl_stream(
    spark: SparkSession,
    path: str,
    folder: str,
    config: PrepConfig = PrepConfig(),
    models: Models = Models(),
    on_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """start_stream over arriving files of line-delimited JSON in the folder path.

    Lines are taken as read_jsonl takes them. Ids go on from batch to batch, dense
    from 1; within a batch they follow the order in which Spark reads its lines. A
    ledger of the rows numbered so far gives a batch its start, so that its cost does
    not rise with what went before; a batch that runs again numbers from the same start.
    """

    def handle(frame: DataFrame, batch: int) -> None:
        rows = parse_lines(frame).filter(nonblank(F.col("text")))
        rows = write_staged(rows.withColumn("line", F.monotonically_increasing_id()), "arrived")
        ledger = Ledger(spark, f"{folder}/ledger")
        before = ledger.before(batch)
        numbered = assign_ids(rows, "line").withColumn("id", F.col("id") + before).drop("line")
        done = process_batch(as_records(numbered, url="url"), batch, folder, config, models)
        ledger.enter(batch, before + rows.count())
        if on_batch:
            on_batch(done, batch)

    return (
        spark.readStream.text(path)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def start_dedup_stream(
    arriving: DataFrame, folder: str, id_col: str = "id", fp_col: str = "fingerprint"
) -> StreamingQuery:
    """First-wins deduplication alone: writes (id, duplicate) per batch under folder/marks."""

    def handle(frame: DataFrame, batch: int) -> None:
        pairs = write_staged(frame.select(F.col(id_col).alias("id"), F.col(fp_col).alias("fingerprint")), "pairs")
        later = duplicates_with_store(pairs, f"{folder}/fingerprints", batch)
        marks = pairs.select("id").join(later.withColumn("duplicate", F.lit(True)), "id", "left")
        marks.fillna(False, ["duplicate"]).write.mode("overwrite").parquet(f"{folder}/marks/batch={batch}")

    return (
        arriving.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def read_batches(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Results of all batches: name is rows or marks."""
    return spark.read.parquet(f"{folder}/{name}")
