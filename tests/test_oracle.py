"""Registered queries against their DuckDB statements on the smallest test data."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from stockaudit.operators.ordered import PARTS_SETTING  # noqa: E402
from stockaudit.plans import registry  # noqa: E402
from stockaudit.streaming.runs import SLICES_SETTING  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = list(registry.queries())


@pytest.fixture(scope="module")
def duck():
    return compare.duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_duckdb(spark, duck, name):
    assert compare.compare(spark, duck, SF, name)


@pytest.mark.parametrize("name", (
    "d2_invalid_transitions e5_running_balance audit_summary running_stock_ledger clamped_adjustments reserve_stock "
    "receive_purchase_orders cold_chain_companions transition_rates repair_history_pipeline").split())
def test_cut_groups_equal_duckdb(spark, duck, name):
    """The same over ranges that cut groups, which small data would not have."""
    spark.conf.set(PARTS_SETTING, "9")
    try:
        assert compare.compare(spark, duck, SF, name)
    finally:
        spark.conf.unset(PARTS_SETTING)


@pytest.mark.parametrize("slices", ["1", "5"])
@pytest.mark.parametrize("name", [n for n in NAMES if n.startswith("stream_") and n != "stream_resume"])
def test_streams_equal_duckdb_however_sliced(spark, duck, name, slices):
    """One micro-batch or several, over rows that lie in files by id."""
    spark.conf.set(SLICES_SETTING, slices)
    try:
        assert compare.compare(spark, duck, SF, name)
    finally:
        spark.conf.unset(SLICES_SETTING)


def test_every_query_has_a_statement():
    assert set(NAMES) - set(entry.oracle_sql()) == set()
    assert len(NAMES) == 108


def test_entry(spark):
    assert entry.entry(spark).columns == ["group_id", "check_id", "label", "violations", "status"]
