"""Stock rules against plain folds."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from shop import at
from pyspark.sql import functions as F

from stockaudit.functions.parameters import PRICE_BANDS
from stockaudit.operators import checks, inventory
from stockaudit.operators.reservations import reserve_stock
from stockaudit.sources import loading
from stockaudit.tables import replace

LEDGER = "transaction_id BIGINT, store_id INT, product_id BIGINT, quantity_delta INT, timestamp_occurred TIMESTAMP_NTZ"


@pytest.mark.parametrize("parts", [10, None])
def test_clamped_adjustments_equal_a_fold(spark, parts):
    rng = random.Random(3)
    rows = [(i, rng.randint(1, 2), rng.choice([1, 1, 1, 2, 3]), rng.randint(-6, 4), at(rng.randint(0, 60)))
            for i in range(600)]
    opening = {(s, p): rng.randint(-3, 12) for s in (1, 2) for p in (1, 2)}
    stock = defaultdict(int, opening)
    expected = []
    for i, s, p, d, ts in sorted(rows, key=lambda r: (r[4], r[0])):
        new = max(0, stock[s, p] + d)
        if new != stock[s, p]:
            expected.append((i, new - stock[s, p], new))
        stock[s, p] = new
    got = inventory.clamped_adjustments(
        spark.createDataFrame(rows, LEDGER),
        spark.createDataFrame([(*k, v) for k, v in opening.items()], "store_id INT, product_id BIGINT, opening INT"),
        parts=parts,
    )
    assert sorted((r.transaction_id, r.effective_delta, r.quantity_after) for r in got.collect()) == sorted(expected)


def _reservation_case(seed):
    rng = random.Random(seed)
    stock = {(s, p): rng.randint(-2, 25) for s in (1, 2, 3) for p in range(6) if rng.random() < 0.9}
    orders = [(i, rng.choice([1, 1, 2, 3]), at(rng.randint(0, 40))) for i in range(120)]
    items = [(i, p, rng.randint(1, 4)) for i, _, _ in orders for p in rng.choices(range(6), k=rng.randint(0, 4))]
    baskets = defaultdict(lambda: defaultdict(int))
    for i, p, q in items:
        baskets[i][p] += q
    left, expected = dict(stock), {}
    for i, s, _ in sorted(orders, key=lambda o: (o[2], o[0])):
        ok = all(left.get((s, p), 0) >= q for p, q in baskets[i].items())
        expected[i] = "ok" if ok else "insufficient_stock"
        if ok:
            for p, q in baskets[i].items():
                left[s, p] -= q
    return stock, orders, items, expected


@pytest.mark.parametrize("seed", [1, 2, 4])
def test_reservations_equal_a_fold(spark, seed):
    """Components decide like one clerk serving all in order."""
    stock, orders, items, expected = _reservation_case(seed)
    got = reserve_stock(
        spark.createDataFrame([(*k, v) for k, v in stock.items()], "store_id INT, product_id BIGINT, quantity_on_hand INT"),
        spark.createDataFrame(orders, "order_id BIGINT, store_id INT, created_at TIMESTAMP_NTZ"),
        spark.createDataFrame(items, "order_id BIGINT, product_id BIGINT, quantity INT"),
    )
    assert {r.order_id: r.result for r in got.collect()} == expected
    assert set(expected.values()) == {"ok", "insufficient_stock"}


def test_a_chain_of_dependent_orders(spark):
    """Each of 10,000 orders wants a product of the one before; every second one fails, in a bounded number of jobs."""
    n = 10_000
    stock = spark.range(n + 1).select(F.lit(1).alias("store_id"), F.col("id").alias("product_id"), F.lit(1).alias("quantity_on_hand"))
    orders = spark.range(n).select(
        F.col("id").alias("order_id"), F.lit(1).alias("store_id"),
        (F.lit(at(0)).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("created_at"))
    items = spark.range(n).select(F.col("id").alias("order_id"), F.explode(F.array("id", F.col("id") + 1)).alias("product_id"),
                                  F.lit(1).alias("quantity"))
    spark.sparkContext.setJobGroup("chain", "chain")
    got = {r.order_id: r.result for r in reserve_stock(stock, orders, items).collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == {i: "insufficient_stock" if i % 2 else "ok" for i in range(n)}
    assert jobs < 400


def test_two_orders_for_the_last_unit(spark):
    got = reserve_stock(
        spark.createDataFrame([(1, 1, 1)], "store_id INT, product_id BIGINT, quantity_on_hand INT"),
        spark.createDataFrame([(2, 1, at(0)), (1, 1, at(0))], "order_id BIGINT, store_id INT, created_at TIMESTAMP_NTZ"),
        spark.createDataFrame([(1, 1, 1), (2, 1, 1)], "order_id BIGINT, product_id BIGINT, quantity INT"),
    )
    assert {r.order_id: r.result for r in got.collect()} == {1: "ok", 2: "insufficient_stock"}


def test_running_ledger_satisfies_the_balance_checks(build, rows):
    t = build(rows)
    run = inventory.running_stock_ledger(t.inventory_transaction, parts=5).withColumnRenamed("quantity_after", "after")
    ledger = t.inventory_transaction.join(run.select("transaction_id", "after"), "transaction_id").withColumn(
        "quantity_after", F.col("after").cast("int")).drop("after")
    assert checks.e5_running_balance(replace(t, inventory_transaction=ledger)).isEmpty()
    stock = {(r.store_id, r.product_id): r.stock for r in inventory.stock_on_hand(ledger).collect()}
    assert stock == {(r["store_id"], r["product_id"]): r["quantity_on_hand"] for r in rows["store_inventory"]}


def test_receipt_keeps_the_purchase_checks(build, rows):
    rows["purchase_order"].append(dict(rows["purchase_order"][2], po_id=4, store_id=2, ordered_at=at(-5)))
    # The store never had product 9, and one product is on both pending orders.
    rows["purchase_order_item"] += [
        dict(rows["purchase_order_item"][4], po_item_id=41, po_id=4, product_id=9),
        dict(rows["purchase_order_item"][4], po_item_id=32, po_id=3, product_id=1, quantity_ordered=5)]
    t = build(rows)
    moves = inventory.receive_purchase_orders(t.purchase_order, t.purchase_order_item, t.store_inventory)
    assert sorted((r.po_item_id, r.quantity_delta, r.quantity_after) for r in moves.collect()) == [
        (31, 10, 108), (32, 5, 113), (41, 10, 10)]
    restocks = moves.select(
        (F.col("po_item_id") + 100).alias("transaction_id"), "store_id", "product_id",
        F.lit("restock").alias("transaction_type"), F.lit(None).cast("bigint").alias("order_id"), "po_id",
        "quantity_delta", F.col("quantity_after").cast("int").alias("quantity_after"),
        F.lit(at(60)).cast("timestamp_ntz").alias("timestamp_occurred"))
    after = replace(
        t, purchase_order=inventory.received_orders(t.purchase_order, at(60)),
        purchase_order_item=inventory.received_items(t.purchase_order, t.purchase_order_item),
        inventory_transaction=t.inventory_transaction.unionByName(restocks))
    for check in (checks.b3_received_po_restock_count, checks.b4_pending_po_received, checks.e2_restock_without_po):
        assert check(after).isEmpty()
    stock = inventory.received_inventory(t.purchase_order, t.purchase_order_item, t.store_inventory)
    assert {(r.store_id, r.product_id): r.stock for r in stock.collect()} == {
        (1, 1): 113, (1, 2): 99, (2, 1): 100, (2, 2): 97, (2, 9): 10}


def test_proposals_price_and_total(build, rows, spark):
    rows["store_inventory"][0]["quantity_on_hand"] = 19
    rows["store_inventory"][1]["quantity_on_hand"] = 20  # not below the reorder point
    t = build(rows)
    got = inventory.propose_purchase_orders(
        t.store_inventory, t.product, t.category, t.supplier, loading.price_bands(spark, PRICE_BANDS)).collect()
    assert [(r.store_id, r.supplier_id, r.product_id, r.quantity_ordered, float(r.unit_price), float(r.total_price))
            for r in got] == [(1, 7, 1, 100, 24.5, 2450.0)]


@pytest.mark.parametrize("parts", [6, None])
def test_cold_companions_equal_brute_force(spark, build, rows, parts):
    rng = random.Random(9)
    rows["product"] = [dict(product_id=p, category_id=1 + p % 2, name=f"p{p}", sku=f"s{p}") for p in range(1, 20)]
    cold = {p for p in range(1, 20) if p % 2 == 0}
    rows["store_inventory"] = [
        dict(inventory_id=s * 100 + p, store_id=s, product_id=p, quantity_on_hand=rng.choice([0, 5, 5]))
        for s in (1, 2) for p in range(1, 20)]
    rows["orders"] = [dict(rows["orders"][0], order_id=i, store_id=rng.choice([1, 2, 3])) for i in range(30)]
    rows["order_item"] = [dict(order_item_id=i * 10 + n, order_id=i, product_id=p, quantity=1)
                          for i in range(30) for n, p in enumerate(rng.choices(range(1, 20), k=rng.randint(1, 8)))]
    shelf = defaultdict(set)
    for r in rows["store_inventory"]:
        if r["quantity_on_hand"] > 0 and r["product_id"] in cold:
            shelf[r["store_id"]].add(r["product_id"])
    rows["category"][0]["requires_cold_chain"], rows["category"][1]["requires_cold_chain"] = True, False
    expected = {}
    for o in rows["orders"]:
        basket = {i["product_id"] for i in rows["order_item"] if i["order_id"] == o["order_id"]}
        if basket & cold:
            free = shelf[o["store_id"]] - basket
            expected[o["order_id"]] = (len(free), min(free, default=None))
    got = inventory.cold_chain_companions(build(rows), parts=parts).collect()
    assert {r.order_id: (r.n_candidates, r.first_candidate) for r in got} == expected
