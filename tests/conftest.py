from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Apply a Column function to a list of values; results in the same order."""
    from pyspark.sql import functions as F

    def run(function, values, type_="string"):
        rows = list(enumerate(values))
        df = spark.createDataFrame(rows, f"i int, v {type_}").repartition(3)
        result = df.select("i", function(F.col("v")).alias("r")).collect()
        return [row["r"] for row in sorted(result, key=lambda row: row["i"])]

    return run


@pytest.fixture(scope="session")
def records(spark):
    """Rows ready for a chain from a list of texts, ids from 1."""
    from textsieve.operators.steps import as_records

    def make(texts):
        df = spark.createDataFrame(list(enumerate(texts, 1)), "id bigint, text string")
        return as_records(df)

    return make
