"""Stock rules: balances, clamped adjustments, reversals, replenishment, receipts, price and cold-chain tests."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockaudit.operators.existence import with_match
from stockaudit.operators.ordered import with_row_number, with_running_total
from stockaudit.session import cut_lineage
from stockaudit.sources.loading import purchase_price, with_price_band

PAIR = ["store_id", "product_id"]


def stock_on_hand(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy(*PAIR).agg(F.sum("quantity_delta").alias("stock"))


def opening_stock(inventory: DataFrame) -> DataFrame:
    """Stock on hand per pair, as the opening of later movements."""
    return inventory.groupBy(*PAIR).agg(F.sum("quantity_on_hand").alias("opening"))


def _with_opening(rows: DataFrame, opening: DataFrame | None) -> DataFrame:
    """Attach the opening stock (store, product, opening); unknown pairs open at 0."""
    if opening is not None:
        rows = rows.join(opening, PAIR, "left")
    known = F.col("opening") if opening is not None else F.lit(None)
    return rows.withColumn("opening", F.coalesce(known, F.lit(0)).cast("bigint"))


def running_stock_ledger(ledger: DataFrame, opening: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """Stock after each ledger row, in (time, id) order, from the opening stock and the deltas."""
    moves = ledger.select("transaction_id", *PAIR, "quantity_delta", "timestamp_occurred")
    run = with_running_total(moves, PAIR, ["timestamp_occurred", "transaction_id"], F.col("quantity_delta"), "_run",
                             parts=parts)
    return _with_opening(run, opening).select(
        "transaction_id", *PAIR, (F.col("opening") + F.col("_run")).alias("quantity_after"))


def clamped_adjustments(adjustments: DataFrame, opening: DataFrame, parts: int | None = None) -> DataFrame:
    """Adjustments applied in order with a floor of 0; movements that change nothing are dropped.

    With X the unclamped balance, the clamped one is X - min(0, lowest X so far): one ordered pass
    instead of a fold.
    """
    moves = adjustments.select("transaction_id", *PAIR, "quantity_delta", "timestamp_occurred")
    run = with_running_total(moves, PAIR, ["timestamp_occurred", "transaction_id"], F.col("quantity_delta"), "_run",
                             low="_low", parts=parts)
    balance = F.col("opening") + F.col("_run")
    lowest_before = F.col("opening") + F.col("_low")
    after = balance - F.least(F.lit(0), lowest_before, balance)
    before = balance - F.col("quantity_delta") - F.when(F.col("_low").isNull(), 0).otherwise(
        F.least(F.lit(0), lowest_before))
    return (
        _with_opening(run, opening)
        .withColumns({"quantity_after": after, "effective_delta": after - before})
        .filter(F.col("effective_delta") != 0)
        .select("transaction_id", *PAIR, "effective_delta", "quantity_after")
    )


def stock_reversals(orders: DataFrame, items: DataFrame, history: DataFrame) -> DataFrame:
    """Return movements for the items of orders cancelled after confirmation, at the cancellation time."""
    facts = (
        history.filter(F.col("status").isin("confirmed", "cancelled"))
        .groupBy("order_id")
        .agg(F.max(F.when(F.col("status") == "cancelled", F.col("changed_at"))).alias("ts"),
             F.count_if(F.col("status") == "confirmed").alias("confirmed"))
        .filter(F.col("confirmed") > 0)
        .select("order_id", "ts")
    )
    cancelled = orders.filter(F.col("status") == "cancelled").select("order_id", "store_id").join(facts, "order_id")
    return items.select("order_id", "order_item_id", "product_id", "quantity").join(cancelled, "order_id").select(
        "order_id", "order_item_id", "product_id", "store_id", F.col("quantity").alias("quantity_delta"), "ts")


def cancellation_ledger(orders: DataFrame, items: DataFrame, history: DataFrame, inventory: DataFrame,
                        parts: int | None = None) -> DataFrame:
    """The return rows of cancelled orders, in (time, order, item) order, with the stock after each."""
    returns = stock_reversals(orders, items, history)
    run = with_running_total(returns, PAIR, ["ts", "order_id", "order_item_id"], F.col("quantity_delta"), "_run", parts=parts)
    return _with_opening(run, opening_stock(inventory)).select(
        "order_id", "order_item_id", *PAIR, F.lit("return").alias("transaction_type"), "quantity_delta",
        (F.col("opening") + F.col("_run")).alias("quantity_after"), "ts")


def cap_order_quantity(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """Requested lines cut to the stock on hand; products out of stock are dropped."""
    stock = inventory.filter(F.col("quantity_on_hand") > 0).select(*PAIR, "quantity_on_hand")
    return requests.join(stock, PAIR).withColumn("quantity", F.least("quantity", "quantity_on_hand")).select(
        *requests.columns)


def low_stock(inventory: DataFrame) -> DataFrame:
    return inventory.filter(F.col("quantity_on_hand") < F.col("reorder_point")).select(
        *PAIR, "quantity_on_hand", "reorder_point", "reorder_quantity")


def propose_purchase_orders(inventory, products, categories, suppliers, bands) -> DataFrame:
    """One order per store that runs low: its lines, with the order's total on each."""
    first_supplier = suppliers.agg(F.min("supplier_id")).scalar()
    lines = with_price_band(low_stock(inventory), products, categories, bands).select(
        "store_id", "product_id", F.col("reorder_quantity").alias("quantity_ordered"),
        purchase_price().alias("unit_price"))
    totals = lines.groupBy("store_id").agg(
        F.round(F.sum(F.col("quantity_ordered") * F.col("unit_price")), 2).cast("decimal(14,2)").alias("total_price"))
    return lines.join(totals, "store_id").select(
        "store_id", first_supplier.alias("supplier_id"), "product_id", "quantity_ordered", "unit_price", "total_price")


def _pending_lines(purchase_orders: DataFrame, po_items: DataFrame) -> DataFrame:
    pending = purchase_orders.filter(F.col("status") == "pending").select("po_id", "store_id", "ordered_at")
    return po_items.select("po_id", "po_item_id", "product_id", "quantity_ordered").join(pending, "po_id")


def receive_purchase_orders(purchase_orders, po_items, inventory, parts: int | None = None) -> DataFrame:
    """Restock movements of all pending orders, oldest first, with the stock after each line."""
    lines = _pending_lines(purchase_orders, po_items)
    run = with_running_total(lines, PAIR, ["ordered_at", "po_id", "po_item_id"], F.col("quantity_ordered"), "_run",
                             parts=parts)
    return _with_opening(run, opening_stock(inventory)).select(
        "po_id", "po_item_id", *PAIR, F.col("quantity_ordered").alias("quantity_delta"),
        (F.col("opening") + F.col("_run")).alias("quantity_after"))


def received_items(purchase_orders: DataFrame, po_items: DataFrame) -> DataFrame:
    """The purchase lines after receipt of all pending orders."""
    pending = purchase_orders.filter(F.col("status") == "pending").select("po_id", F.lit(True).alias("_pending"))
    received = F.when(F.col("_pending"), F.col("quantity_ordered")).otherwise(F.col("quantity_received"))
    return po_items.join(pending, "po_id", "left").withColumn("quantity_received", received).select(*po_items.columns)


def received_orders(purchase_orders: DataFrame, received_at: datetime.datetime) -> DataFrame:
    """The headers after receipt of all pending orders."""
    pending = F.col("status") == "pending"
    return purchase_orders.withColumns({
        "received_at": F.when(pending, F.lit(received_at).cast("timestamp_ntz")).otherwise(F.col("received_at")),
        "status": F.when(pending, "received").otherwise(F.col("status")),
    })


def received_inventory(purchase_orders: DataFrame, po_items: DataFrame, inventory: DataFrame) -> DataFrame:
    """Stock per pair after receipt of all pending orders; pairs without a row appear too."""
    gain = _pending_lines(purchase_orders, po_items).groupBy(*PAIR).agg(F.sum("quantity_ordered").alias("gain"))
    both = inventory.select(*PAIR, "quantity_on_hand").join(gain, PAIR, "full_outer")
    return both.select(*PAIR, (F.coalesce("quantity_on_hand", F.lit(0)) + F.coalesce("gain", F.lit(0))).alias("stock"))


def adjustment_shrinkage(ledger: DataFrame) -> DataFrame:
    """Adjustments per store by sign: losses and finds."""
    kind = F.when(F.col("quantity_delta") < 0, "shrinkage").otherwise("found_extra")
    return ledger.filter(F.col("transaction_type") == "adjustment").groupBy("store_id", kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.abs("quantity_delta")).alias("units"))


def cold_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    cold = categories.filter("requires_cold_chain").select("category_id")
    return products.join(cold, "category_id").select("product_id")


def cold_chain_items(items: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Lines and cold-chain lines per order."""
    cold = cold_products(products, categories).withColumn("_cold", F.lit(True))
    return (
        items.select("order_id", "product_id").join(cold, "product_id", "left")
        .groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("n_items"), F.count("_cold").alias("n_cold"))
        .withColumn("has_cold", F.col("n_cold") > 0)
    )


def price_band_violations(items, products, categories, bands) -> DataFrame:
    return (
        with_price_band(items.select("order_item_id", "product_id", "unit_price"), products, categories, bands)
        .filter(~F.col("unit_price").between(F.col("lo"), F.col("hi")))
        .select("order_item_id", "unit_price", "lo", "hi")
    )


def cold_chain_companions(t, parts: int | None = None) -> DataFrame:
    """For orders with a cold item: how many other cold products their store has in stock, and the lowest id.

    Cold stock is numbered per store by product id. The basket takes some of those numbers; the lowest
    free one follows the unbroken run 1, 2, 3… at its start, so no order is ever paired with a
    store's products.
    """
    cold = cold_products(t.product, t.category)
    in_stock = with_match(t.store_inventory.filter(F.col("quantity_on_hand") > 0).select(*PAIR), cold, ["product_id"])
    numbered = with_row_number(in_stock, ["store_id"], ["product_id"], "number", parts=parts)
    per_store = in_stock.groupBy("store_id").agg(F.count(F.lit(1)).alias("n_stock"))

    basket = with_match(t.order_item.select("order_id", "product_id"), cold, ["product_id"]).distinct()
    basket = cut_lineage(basket.join(t.orders.select("order_id", "store_id"), "order_id"))
    # The numbers that a basket takes, as many as it has products: its k-th one is k as long as the run lasts.
    taken = basket.join(numbered, PAIR).groupBy("order_id").agg(F.array_sort(F.collect_set("number")).alias("numbers"))
    used = taken.select("order_id", F.size("numbers").cast("bigint").alias("n_taken"), F.size(
        F.filter("numbers", lambda number, place: number == place + 1)).cast("bigint").alias("run"))
    orders = basket.select("order_id", "store_id").distinct().join(used, "order_id", "left").join(
        per_store, "store_id", "left")
    free = orders.select(
        "order_id", "store_id",
        (F.coalesce("n_stock", F.lit(0)) - F.coalesce("n_taken", F.lit(0))).alias("n_candidates"),
        (F.coalesce("run", F.lit(0)) + 1).cast("bigint").alias("number"),
    )
    # Most orders ask for the same first numbers, so each store hands out a short list of these: no longer than
    # the longest run that a basket takes from the start, and one.
    asked = free.groupBy("store_id").agg(F.max("number").alias("_most"))
    lists = (
        numbered.join(asked, "store_id").filter(F.col("number") <= F.col("_most"))
        .groupBy("store_id").agg(F.map_from_entries(F.collect_list(F.struct("number", "product_id"))).alias("_list"))
    )
    return free.join(lists, "store_id", "left").select(
        "order_id", "n_candidates", F.try_element_at("_list", F.col("number")).alias("first_candidate"))
