from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from textsieve.operators import dedup, ids


@pytest.fixture(scope="module")
def keyed(spark):
    # Sparse, clumped keys in shuffled partitions.
    keys = [3, 5, 7, 1_000_000_007, 2**50] + list(range(100, 900))
    return spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(13)


def test_ranks_are_dense_in_key_order(keyed):
    rows = ids.assign_ids(keyed, "k").orderBy("k").collect()
    assert [r["id"] for r in rows] == list(range(1, len(rows) + 1))


def test_ranks_do_not_depend_on_partitions(keyed):
    first = {r["k"]: r["id"] for r in ids.assign_ids(keyed, "k").collect()}
    again = {r["k"]: r["id"] for r in ids.assign_ids(keyed.repartition(2), "k").collect()}
    assert first == again


@pytest.mark.parametrize("limit, expected", [(0, 805), (-1, 805), (4, 4), (10_000, 805)])
def test_first_rows(keyed, limit, expected):
    rows = ids.first_rows(keyed, "k", limit)
    assert rows.count() == expected
    if limit == 4:
        assert sorted(r["k"] for r in rows.collect()) == [3, 5, 7, 100]


@pytest.mark.parametrize("rows, sizes", [(0, []), (9, [9]), (10, [10]), (11, [10, 1]), (25, [10, 10, 5])])
def test_shards(spark, rows, sizes):
    shards = ids.shard_numbers(spark.range(rows), "id", 10)
    counts = shards.groupBy("shard").count().orderBy("shard").collect()
    assert [r["count"] for r in counts] == sizes
    assert [r["shard"] for r in counts] == list(range(len(sizes)))
    if rows == 25:
        last = shards.filter("shard = 2").agg(F.min("id").alias("first")).first()
        assert last["first"] == 20


@pytest.fixture(scope="module")
def copies(spark):
    """A third of all rows are copies of one text."""
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 1, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 1500)).alias("fingerprint")
    )
    return rows.repartition(7)


def expected_firsts(df):
    firsts = {}
    for row in sorted(df.collect()):
        firsts.setdefault(row["fingerprint"], row["id"])
    return set(firsts.values())


def test_lowest_id_wins(copies):
    firsts = expected_firsts(copies)
    assert {r["id"] for r in dedup.dedup_keep(copies).collect()} == firsts
    marks = dedup.dedup_mark(copies).collect()
    assert len(marks) == 3000
    assert {r["id"] for r in marks if not r["duplicate"]} == firsts
    assert {r["id"] for r in dedup.later_copies(copies).collect()} == set(range(3000)) - firsts


def test_group_sizes(copies):
    sizes = {r["fingerprint"]: r["copies"] for r in dedup.dedup_groups(copies).collect()}
    assert sizes["hot"] == 1000
    assert sum(sizes.values()) == 3000


def test_hot_group_is_aggregated_before_the_shuffle(copies):
    plan = dedup.later_copies(copies)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
