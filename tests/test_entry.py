from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks.compare import compare
from checks.oracle import ORACLE
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_entry(spark):
    funnel = entry.entry(spark).orderBy("stage").collect()
    assert [r["name"] for r in funnel][:3] == ["normalize", "attributes", "preliminary"]
    assert funnel[0]["rows_in"] == 200
    assert all(a["rows_in"] >= b["rows_in"] for a, b in zip(funnel, funnel[1:]))


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLE) == {"insight_json", "stage_timing", "part_timing"}


@pytest.mark.parametrize(
    "name", ["read_lines", "html_extract_element", "prepared_pages", "whole_chain", "written_shards", "mask_person"]
)
def test_same_as_sql(spark, name):
    assert compare(spark, FOLDER, name) == ""
