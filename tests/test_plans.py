"""The plans stay what a large cluster needs: no products, no single-task windows, filters in the scan."""

from __future__ import annotations

import re

import pytest

from stockaudit.operators.checks import CHECKS
from stockaudit.plans.audit import all_violations, audit_samples, audit_summary
from stockaudit.plans.registry import RULES
from stockaudit.sources.retail_layer import retail_tables

SF = "/root/testdata/sf0.001"
# Their windows run over a few counts: rows per partition, rows per day.
SMALL_WINDOWS = {"assign_surrogate_keys", "upsert_products", "repair_latest_status", "hourly_order_summary"}


@pytest.fixture(scope="module")
def t(spark):
    return retail_tables(spark, SF)


@pytest.fixture(autouse=True)
def whole_paths(spark):
    """Plans cut the text of locations; here they are counted."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def check_plan(name, text):
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in SMALL_WINDOWS:
        # A window without a partition list is planned over a single partition.
        assert "Exchange SinglePartition" not in "".join(
            a for a in re.findall(r"Window \[.*\n(?:.*\n){1,3}", text)), text


@pytest.mark.parametrize("check", CHECKS, ids=lambda k: k.check_id)
def test_check_plans(t, check):
    check_plan(check.query, plan(check.run(t)))


@pytest.mark.parametrize("name", [n for n in RULES if not n.startswith("stream") and n not in (
    "write_audit_outputs", "repair_history_pipeline", "reserve_stock")])
def test_rule_plans(t, name):
    check_plan(name, plan(RULES[name](t)))


def test_filters_and_columns_reach_the_scan(t):
    text = plan(next(k for k in CHECKS if k.check_id == "E2").run(t))
    assert "EqualTo(transaction_type,restock)" in text and "IsNull(po_id)" in text
    text = plan(next(k for k in CHECKS if k.check_id == "C4").run(t))
    assert "ReadSchema: struct<order_id:bigint>" in text


def test_shared_passes(t):
    """The stock checks read the ledger once."""
    from stockaudit.plans.audit import _stock_counts

    text = plan(_stock_counts(t))
    assert text.count("/inventory_transaction]") == 1
    assert plan(audit_summary(t)).count("BroadcastNestedLoopJoin") == 0


def broadcast_files(text):
    """The files below each broadcast of a plan."""
    depth = lambda line: len(re.match(r"[ :|+\-]*", line)[0])
    lines, found = text.splitlines(), set()
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = lines[i + 1:next((j for j in range(i + 1, len(lines)) if depth(lines[j]) <= depth(line)), len(lines))]
            found |= {m.rsplit("/", 1)[-1] for x in below for m in re.findall(r"Location: \w+\(.*?\)\[(.*?)[,\]]", x)}
    return found


@pytest.mark.parametrize("report", [audit_samples, audit_summary, all_violations], ids=lambda f: f.__name__)
def test_growing_tables_are_not_broadcast(t, report, spark):
    """However small the files, the driver holds no table but stores and zones."""
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    try:
        text = plan(report(t))
    finally:
        spark.conf.unset("spark.sql.maxPlanStringLength")
    assert broadcast_files(text) == {"region.parquet", "nation.parquet"}


def test_references_are_settled_in_one_exchange(t):
    """Each table is scanned once, however many references it has."""
    from stockaudit.operators.constraints import foreign_key_violations
    from stockaudit.schemas import FOREIGN_KEYS

    text = plan(foreign_key_violations(t))
    tables = {child for child, *_ in FOREIGN_KEYS} | {parent for *_, parent in FOREIGN_KEYS}
    assert text.count("FileScan") == len(tables) and text.count("Exchange") == 1 and "Join" not in text
