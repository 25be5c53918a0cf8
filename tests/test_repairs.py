from __future__ import annotations

import random
from datetime import timedelta

import pytest
from shop import LazyTables, at

from stockaudit.operators import checks, repairs
from stockaudit.schemas import ALLOWED_TRANSITIONS
from stockaudit.tables import replace


def states(df):
    return sorted((r.order_id, r.changed_at, r.status) for r in df.collect())


def test_latest_status_is_moved_behind_the_others(build, rows):
    # Order 1 is confirmed again after its delivery; order 3 was delivered without any row for it.
    rows["order_history"] += [
        dict(history_id=8, order_id=1, status="delivered", changed_at=at(31)),
        dict(history_id=9, order_id=1, status="confirmed", changed_at=at(40)),
    ]
    rows["orders"][2]["status"] = "delivered"
    t = build(rows)
    fixed = repairs.repair_latest_status(t.orders, t.order_history)
    late = at(40).replace(second=1)
    assert [s for s in states(fixed) if s[0] == 1] == [
        (1, at(0), "pending"), (1, at(4), "confirmed"), (1, at(40), "confirmed"), (1, late, "delivered")]
    assert [s for s in states(fixed) if s[0] == 3] == [(3, at(6), "pending"), (3, at(6).replace(second=1), "delivered")]
    assert {r.history_id for r in fixed.filter("order_id = 3").collect()} == {7, 10}
    assert checks.d1_latest_status_mismatch(replace(t, order_history=fixed)).isEmpty()


def test_repeated_status_is_removed(build, rows):
    rows["order_history"].append(dict(history_id=8, order_id=3, status="pending", changed_at=at(7)))
    t = build(rows)
    fixed = repairs.repair_repeated_status(t.order_history)
    assert [s for s in states(fixed) if s[0] == 3] == [(3, at(6), "pending")]
    assert checks.d3_repeated_status(replace(t, order_history=fixed)).isEmpty()


def test_deletion_is_simultaneous_and_by_id(build, rows):
    # confirmed -> pending -> confirmed: both later rows follow illegal moves and go in the same pass.
    rows["order_history"] += [
        dict(history_id=8, order_id=3, status="confirmed", changed_at=at(7)),
        dict(history_id=9, order_id=3, status="pending", changed_at=at(8)),
        dict(history_id=10, order_id=3, status="delivered", changed_at=at(9)),
    ]
    fixed = repairs.repair_invalid_transitions(build(rows).order_history)
    assert [s[2] for s in states(fixed) if s[0] == 3] == ["pending", "confirmed"]


def test_pipeline_counts_on_repaired_data_and_further_passes_continue(build, rows):
    # Without its confirmation, the delivery of order 1 is an illegal move; deleting it breaks D1 again.
    rows["order_history"] = [r for r in rows["order_history"] if r["history_id"] != 2]
    t = build(rows)
    report, fixed = repairs.repair_history_pipeline(t)
    assert [tuple(r) for r in report.orderBy("step").collect()] == [(1, "D1", 0, 0), (2, "D2", 1, 1), (3, "D3", 0, 0)]
    assert checks.d1_latest_status_mismatch(replace(t, order_history=fixed)).count() == 1
    report, _ = repairs.repair_history_pipeline(t, max_passes=2)
    assert [tuple(r)[1:] for r in report.orderBy("step").collect()][3:] == [("D1", 1, 1), ("D2", 1, 1), ("D3", 0, 0)]


def test_clean_history_is_left_alone(build, rows):
    t = build(rows)
    report, fixed = repairs.repair_history_pipeline(t, max_passes=3)
    assert report.count() == 3
    assert states(fixed) == states(t.order_history)


def test_null_status_is_flagged_and_repairs_delete_what_the_checks_report(spark):
    """Random histories with NULL and repeated statuses: rows gone are exactly the rows reported."""
    r = random.Random(11)
    words = [None, "pending", "confirmed", "delivered", "cancelled"]
    history = [dict(history_id=i, order_id=r.randint(1, 40), status=r.choice(words), changed_at=at(r.randint(0, 50))) for i in range(300)]
    orders = [dict(order_id=i, status=r.choice(words)) for i in range(1, 41)]
    t = LazyTables(spark, {"order_history": history, "orders": orders})
    before = {x["history_id"] for x in history}
    for check, repair in ((checks.d2_invalid_transitions, repairs.repair_invalid_transitions),
                          (checks.d3_repeated_status, repairs.repair_repeated_status)):
        reported = {x.history_id for x in check(t).collect()}
        kept = {x.history_id for x in repair(t.order_history).collect()}
        assert reported and kept == before - reported
    bad = {x.order_id for x in checks.d1_latest_status_mismatch(t).collect()}
    fixed = repairs.repair_latest_status(t.orders, t.order_history)
    wanted = {o["order_id"]: o["status"] for o in orders}
    kept = {x.history_id for x in fixed.collect()}
    gone = [x for x in history if x["history_id"] not in kept]
    assert all(x["order_id"] in bad and x["status"] == wanted[x["order_id"]] for x in gone)
    assert checks.d1_latest_status_mismatch(replace(t, order_history=fixed)).isEmpty()


def test_null_status_after_a_status_is_illegal(build, rows):
    rows["order_history"] += [dict(history_id=8, order_id=3, status=None, changed_at=at(7)),
                              dict(history_id=9, order_id=3, status="confirmed", changed_at=at(8))]
    t = build(rows)
    assert [x.history_id for x in checks.d2_invalid_transitions(t).collect()] == [8]
    assert {x.history_id for x in repairs.repair_invalid_transitions(t.order_history).collect()} == {1, 2, 3, 4, 5, 6, 7, 9}


def in_sequence(rows, wanted, max_passes):
    """Plain fold: the passes over all orders; ids of added rows are None."""
    h = {o: sorted(((x["changed_at"], x["history_id"], x["status"]) for x in rows if x["order_id"] == o), key=lambda x: x[:2])
         for o in {x["order_id"] for x in rows}}
    legal = set(ALLOWED_TRANSITIONS)
    report, p = [], 0
    while max_passes is None or p < max_passes:
        p, begun, counts = p + 1, {o: [(x[0], x[2]) for x in v] for o, v in h.items()}, [[0, 0], [0, 0], [0, 0]]
        for o, v in h.items():
            status = wanted.get(o)
            if v and status is not None and v[-1][2] is not None and v[-1][2] != status:
                own, others = [x for x in v if x[2] == status], [x for x in v if x[2] != status]
                counts[0][0] += 1
                counts[0][1] += max(len(own), 1)
                v = [*others, (others[-1][0] + timedelta(seconds=1), own[-1][1] if own else None, status)]
            for k, bad in ((1, lambda a, b: a is not None and (a, b) not in legal),
                           (2, lambda a, b: a is not None and a == b)):
                kept = [x for i, x in enumerate(v) if not i or not bad(v[i - 1][2], x[2])]
                counts[k] = [n + len(v) - len(kept) for n in counts[k]]
                v = kept
            h[o] = v
        report += [tuple(n) for n in counts]
        if not any(n for n, _ in counts):
            break
        if max_passes is None and begun == {o: [(x[0], x[2]) for x in v] for o, v in h.items()}:
            break
    return report, [(o, x[0], x[2] or "") for o, v in h.items() for x in v]


@pytest.mark.parametrize("max_passes,longest", [(1, 1000), (None, 1000), (3, 4), (None, 4)])
def test_pipeline_equals_the_sequence(spark, max_passes, longest):
    """Histories as arrays, as tables, and both; some orders never converge."""
    r = random.Random(5)
    words = [None, "pending", "confirmed", "out_for_delivery", "delivered", "cancelled"]
    history = [dict(history_id=i, order_id=r.choice([None, *range(1, 60)]) if i % 7 else 5, status=r.choice(words),
                    changed_at=at(r.randint(0, 50))) for i in range(1, 300)]
    orders = [dict(order_id=i, status=r.choice(words)) for i in range(1, 55)]
    t = LazyTables(spark, {"order_history": history, "orders": orders})
    report, fixed = repairs.repair_history_pipeline(t, max_passes, longest)
    want, rows = in_sequence(history, {o["order_id"]: o["status"] for o in orders}, max_passes)
    assert [(x.violations_before, x.rows_changed) for x in report.orderBy("step").collect()] == want
    got = fixed.collect()
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(((x.order_id, x.changed_at, x.status or "") for x in got), key=key) == sorted(rows, key=key)
    ids = [x.history_id for x in got]
    assert None not in ids and len(ids) == len(set(ids))


def test_pipeline_without_rows(spark):
    t = LazyTables(spark, {"order_history": [], "orders": [dict(order_id=1, status="pending")]})
    report, fixed = repairs.repair_history_pipeline(t, None)
    assert [tuple(x)[2:] for x in report.collect()] == [(0, 0)] * 3 and fixed.isEmpty()
