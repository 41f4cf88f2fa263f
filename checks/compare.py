"""Run the queries and their SQL side by side: python -m checks.compare [folder] [query ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def plain(value):
        if value is None or value is pd.NA or (isinstance(value, float) and value != value):
            return "null"
        if isinstance(value, float):
            return f"{value:.9g}"
        return str(value)

    return sorted(tuple(plain(v) for v in row) for row in frame.astype(object).itertuples(index=False))


def compare(spark: SparkSession, folder: str, name: str) -> str:
    """Empty if both give the same rows, else what differs."""
    ours = rows_of_spark = QUERIES[name](spark, folder).toPandas()
    if name not in ORACLE:
        return ""
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    theirs = connection.execute(ORACLE[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    left, right = rows_of(rows_of_spark), rows_of(theirs)
    if len(left) != len(right):
        return f"{len(left)} and {len(right)} rows"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(different)} rows differ, first {different[0]}" if different else ""


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "12g")
        # Small test files: let each one be its own task.
        .config("spark.sql.files.openCostInBytes", "65536")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = session()
    failed = 0
    for name in names:
        start = time.perf_counter()
        try:
            problem = compare(spark, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "rows only" if name not in ORACLE else "same"
        print(f"{name:24s} {time.perf_counter() - start:6.2f}s {problem[:900] or kind}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
