"""Each check passes on the clean shop and finds exactly what one change breaks."""

from __future__ import annotations

from decimal import Decimal as D

import pytest
from shop import at

from stockaudit.operators.checks import CHECKS
from stockaudit.plans.audit import audit_samples, audit_summary

BY_ID = {k.check_id: k for k in CHECKS}


def row(rows, table, **match):
    return next(r for r in rows[table] if all(r.get(k) == v for k, v in match.items()))


def drop(rows, table, **match):
    rows[table] = [r for r in rows[table] if not all(r.get(k) == v for k, v in match.items())]


def change(table, match, **values):
    return lambda rows: row(rows, table, **match).update(values)


def add(table, **values):
    return lambda rows: rows[table].append(values)


def remove(table, **match):
    return lambda rows: drop(rows, table, **match)


def history(i, order, status, minutes):
    return add("order_history", history_id=i, order_id=order, status=status, changed_at=at(minutes))


def moved(i, store, product, kind, delta, after, minutes, order=None, po=None):
    return add("inventory_transaction", transaction_id=i, store_id=store, product_id=product, transaction_type=kind,
               order_id=order, po_id=po, quantity_delta=delta, quantity_after=after, timestamp_occurred=at(minutes))


# check id -> (change to the clean shop, keys of the violations)
PLANTED = [
    ("A1", change("store_inventory", dict(inventory_id=11), quantity_on_hand=-1), {(1, 1)}),
    ("A2", change("store_inventory", dict(inventory_id=22), quantity_on_hand=96), {(2, 2)}),
    ("A2", remove("inventory_transaction", store_id=2, product_id=1), {(2, 1)}),
    ("A3", change("purchase_order_item", dict(po_item_id=11), quantity_received=90), {(1, 1)}),
    ("A4", change("inventory_transaction", dict(transaction_id=4), transaction_type="return"), {(2, 2)}),
    ("B1", change("purchase_order_item", dict(po_item_id=12), quantity_received=101), {(12,)}),
    ("B2", change("purchase_order", dict(po_id=2), total_price=D("1000.01")), {(2,)}),
    ("B2", change("purchase_order", dict(po_id=2), total_price=None), set()),
    ("B2", add("purchase_order", po_id=9, store_id=1, supplier_id=7, status="pending", total_price=D("5.00")), set()),
    ("B3", remove("inventory_transaction", transaction_id=3), {(2,)}),
    ("B3", remove("inventory_transaction", po_id=2), {(2,)}),
    ("B4", change("purchase_order_item", dict(po_item_id=31), quantity_received=1), {(31,)}),
    ("C1", change("orders", dict(order_id=1), total_amount=D("70.01")), set()),
    ("C1", change("orders", dict(order_id=1), total_amount=D("70.02")), {(1,)}),
    ("C1", change("orders", dict(order_id=1), total_amount=None), set()),
    ("C2", change("order_item", dict(order_item_id=4), line_total=D("30.02")), {(4,)}),
    ("C3", change("orders", dict(order_id=3), sub_total=D("30.02")), {(3,)}),
    ("C4", remove("order_item", order_id=3), {(3,)}),
    ("C3", remove("order_item", order_id=3), set()),
    ("C5", remove("order_history", order_id=3), {(3,)}),
    ("D1", change("orders", dict(order_id=3), status="confirmed"), {(3,)}),
    # A tie on the time goes to the higher id.
    ("D1", history(8, 3, "confirmed", 6), {(3,)}),
    ("D2", remove("order_history", history_id=2), {(1, 3)}),
    # The first row is never judged.
    ("D2", remove("order_history", history_id=1), set()),
    ("D2", history(8, 3, "pending", 7), {(3, 8)}),
    ("D3", history(8, 3, "pending", 7), {(3, 8)}),
    ("E1", change("inventory_transaction", dict(transaction_id=8), order_id=None), {(8,)}),
    ("E2", change("inventory_transaction", dict(transaction_id=1), po_id=None), {(1,)}),
    ("E3", change("inventory_transaction", dict(transaction_id=9), po_id=1), {(9,)}),
    ("E4", change("inventory_transaction", dict(transaction_id=7), quantity_delta=1), {(7,)}),
    ("E4", change("inventory_transaction", dict(transaction_id=7), quantity_delta=0), set()),
    ("E5", change("inventory_transaction", dict(transaction_id=9), quantity_after=96), {(9,)}),
    ("E5", change("inventory_transaction", dict(transaction_id=4), quantity_after=90), {(9,)}),
    ("F1", change("orders", dict(order_id=3), store_id=9), {(3,)}),
    ("F1", change("orders", dict(order_id=3), store_id=None), set()),
    ("F2", change("orders", dict(order_id=3), customer_id=9), {(3,)}),
    ("F3", change("order_item", dict(order_item_id=4), product_id=9), {(4,)}),
    ("F4", change("store_inventory", dict(inventory_id=22), store_id=8, product_id=9), {(22,)}),
    ("F4", change("store_inventory", dict(inventory_id=22), product_id=None), set()),
    ("F5", change("inventory_transaction", dict(transaction_id=9), product_id=9), {(9,)}),
    ("F6", change("customer", dict(customer_id=2), zone_id=5), {(2,)}),
    ("G1", change("store_inventory", dict(inventory_id=12), reorder_point=0), {(12,)}),
    ("G1", change("store_inventory", dict(inventory_id=12), reorder_quantity=20), {(12,)}),
    ("G2", remove("store_inventory", inventory_id=12), {(1,)}),
    # A store without any inventory is unseen by G2 and seen by G3.
    ("G2", add("dark_store", store_id=3, name="West"), set()),
    ("G3", add("dark_store", store_id=3, name="West"), {(3,)}),
    ("G4", change("zone", dict(zone_id=1), delivery_fee=D("25.00")), {(1,), (2,), (3,)}),
    ("G5", change("order_history", dict(history_id=7), changed_at=at(5)), {(3, 7)}),
    ("H1", remove("inventory_transaction", transaction_id=8), {(2,)}),
    # Any one return of the order is enough.
    ("H1", moved(10, 1, 1, "return", 1, 99, 21, order=2), set()),
    ("H2", remove("inventory_transaction", transaction_id=6), {(2,)}),
    ("H2", change("inventory_transaction", dict(transaction_id=5), quantity_delta=-3), {(1,)}),
]


def keys(df, check):
    return {tuple(r[k] for k in check.key) for r in df.collect()}


def test_clean_shop_passes(build, rows):
    report = audit_summary(build(rows)).collect()
    assert len(report) == 34
    assert [(r.check_id, r.violations) for r in report if r.status != "PASS"] == []


@pytest.mark.parametrize("check_id,plant,expected", PLANTED, ids=[f"{i}-{p[0]}" for i, p in enumerate(PLANTED)])
def test_planted_violation(build, rows, check_id, plant, expected):
    plant(rows)
    check = BY_ID[check_id]
    assert keys(check.run(build(rows)), check) == expected


def test_every_check_is_planted():
    assert {p[0] for p in PLANTED if p[2]} == set(BY_ID)


def test_summary_agrees_with_the_checks(build, rows):
    """The shared passes of the report count what the single checks find, with everything planted at once."""
    for check_id, plant, expected in PLANTED:
        if expected and check_id not in ("A4", "B3"):
            try:
                plant(rows)
            except StopIteration:  # an earlier plant removed the row
                pass
    t = build(rows)
    report = {r.check_id: r.violations for r in audit_summary(t).collect()}
    assert report == {k.check_id: k.run(t).count() for k in CHECKS}
    assert sum(report.values()) > 30


def test_samples_keep_the_first_three(build, rows):
    for i in range(10):
        rows["orders"].append(dict(rows["orders"][2], order_id=100 - i, store_id=50 + i))
    got = [(r.rn, r.key, r.detail) for r in audit_samples(build(rows)).collect() if r.check_id == "F1"]
    assert sorted(got) == [(1, "91", "store_id=59"), (2, "92", "store_id=58"), (3, "93", "store_id=57")]


def test_shared_passes_count_like_the_checks_when_keys_repeat(build, rows):
    """Repeated customers and purchase orders: a row of the shared pass may hold several violations."""
    rows["customer"].append(dict(rows["customer"][0], zone_id=2))
    rows["customer"].append(dict(rows["customer"][0], customer_id=None))
    rows["zone"].append(dict(zone_id=2, name="East", delivery_fee=D("30.00")))
    rows["purchase_order"].append(dict(rows["purchase_order"][2]))
    rows["purchase_order_item"][4].update(quantity_received=11)
    rows["orders"].append(dict(rows["orders"][0], order_id=9, customer_id=77, store_id=None))
    t = build(rows)
    report = {r.check_id: r.violations for r in audit_summary(t).collect()}
    for check in CHECKS:
        if check.check_id in ("B1", "B4", "F1", "F2", "G4"):
            assert report[check.check_id] == check.run(t).count(), check.check_id
    assert report["G4"] == 2 and report["B4"] == 2


def test_counts_per_parent_are_those_of_the_rows(build, rows):
    """Several bad rows of one pair, product and purchase order, repeated parents and NULL references."""
    rows["product"].append(dict(rows["product"][0]))
    rows["dark_store"].append(dict(rows["dark_store"][0]))
    for i, (store, product) in enumerate([(1, 1), (1, 1), (9, 1), (9, 1), (1, 8), (9, 8), (None, 1), (1, None), (None, None)]):
        rows["inventory_transaction"].append(dict(
            rows["inventory_transaction"][4], transaction_id=100 + i, store_id=store, product_id=product, quantity_delta=2,
            quantity_after=50 * i, order_id=None, timestamp_occurred=at(100 + i)))
    for i, product in enumerate([8, 8, 1, 1, None]):
        rows["order_item"].append(dict(rows["order_item"][0], order_item_id=100 + i, product_id=product, line_total=D("1.00")))
    for i, po in enumerate([3, 3, 1, 77, None]):
        rows["purchase_order_item"].append(dict(
            rows["purchase_order_item"][4], po_item_id=100 + i, po_id=po, quantity_received=11))
    t = build(rows)
    report = {r.check_id: r.violations for r in audit_summary(t).collect()}
    assert report == {k.check_id: k.run(t).count() for k in CHECKS}
    assert [report[k] for k in ("B1", "B4", "C2", "F3", "F5")] == [5, 2, 5, 2, 4]
