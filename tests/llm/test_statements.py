"""Registered queries of the subpackage against their DuckDB statements."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent / "tools"))

import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from stockaudit.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_duckdb(spark, name):
    assert compare.compare(spark, compare.duck(SF), SF, name)


def test_registered():
    numbers = {int(n[2:].split("_")[0]) for n in queries.QUERIES}
    assert numbers == set(range(1, len(queries.QUERIES) + 1))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries()) and set(queries.SQL) <= set(entry.oracle_sql())
