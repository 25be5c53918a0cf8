"""The 34 consistency checks. Each takes the tables and returns the violating rows; none means pass."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockaudit.operators.existence import merged, not_in, with_match, without_match
from stockaudit.operators.ordered import with_previous
from stockaudit.schemas import ALLOWED_TRANSITIONS

PAIR = ["store_id", "product_id"]
CENT = Decimal("0.01")


def zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


# --- shared building blocks -------------------------------------------------------------------

def ledger_by_pair(t) -> DataFrame:
    """Every sum the stock checks need, from one scan of the ledger."""
    kind, delta = F.col("transaction_type"), F.col("quantity_delta")
    return t.inventory_transaction.groupBy(*PAIR).agg(
        F.sum(delta).alias("tx_sum"),
        F.sum(F.when(kind == "sale", F.abs(delta))).alias("sold"),
        F.sum(F.when(kind == "return", delta)).alias("returned"),
        F.sum(F.when(kind == "adjustment", delta)).alias("adjusted"),
        F.count_if(kind == "restock").alias("restocks"),
    )


def received_by_pair(t) -> DataFrame:
    received = t.purchase_order.filter(F.col("status") == "received").select("po_id", "store_id")
    return (
        t.purchase_order_item.select("po_id", "product_id", "quantity_received")
        .join(merged(received), "po_id")
        .groupBy(*PAIR)
        .agg(F.sum("quantity_received").alias("received"))
    )


def reconciled() -> Column:
    return zero("received") + zero("returned") + zero("adjusted") - zero("sold")


def items_by_order(t) -> DataFrame:
    return t.order_item.groupBy("order_id").agg(F.sum("line_total").alias("items_total"))


def lines_by_po(t) -> DataFrame:
    return t.purchase_order_item.groupBy("po_id").agg(
        F.round(F.sum(F.col("quantity_ordered") * F.col("unit_price")), 2).alias("computed"),
        F.count(F.lit(1)).alias("items"),
    )


def restocks_by_po(t) -> DataFrame:
    return (
        t.inventory_transaction.filter((F.col("transaction_type") == "restock") & F.col("po_id").isNotNull())
        .groupBy("po_id")
        .agg(F.count(F.lit(1)).alias("txs"))
    )


def latest_status(history: DataFrame) -> DataFrame:
    """Newest status per order (ties: highest history id), as an aggregate that combines map-side."""
    newest = F.struct("changed_at", "history_id")
    return history.groupBy("order_id").agg(F.max_by("status", newest).alias("hist_status"))


def with_previous_status(history: DataFrame, **options) -> DataFrame:
    return with_previous(history, ["order_id"], ["changed_at", "history_id"], {"prev_status": "status"}, **options)


def illegal_move(before: Column | None = None, after: Column | None = None) -> Column:
    """Whether the move is not allowed; without arguments, the one from ``prev_status`` to ``status``."""
    before = F.col("prev_status") if before is None else before
    after = F.col("status") if after is None else after
    legal = reduce(lambda a, b: a | b, [(before == p) & (after == s) for p, s in ALLOWED_TRANSITIONS])
    # A NULL status follows nothing legally.
    return before.isNotNull() & ~F.coalesce(legal, F.lit(False))


def wrong_sign() -> Column:
    kind, delta = F.col("transaction_type"), F.col("quantity_delta")
    return ((kind == "sale") & (delta > 0)) | (kind.isin("restock", "return") & (delta < 0))


def missing_order() -> Column:
    return F.col("transaction_type").isin("sale", "return") & F.col("order_id").isNull()


def missing_po() -> Column:
    return (F.col("transaction_type") == "restock") & F.col("po_id").isNull()


def needless_reference() -> Column:
    return (F.col("transaction_type") == "adjustment") & (F.col("order_id").isNotNull() | F.col("po_id").isNotNull())


def bad_thresholds() -> Column:
    return (F.col("reorder_point") <= 0) | (F.col("reorder_quantity") <= F.col("reorder_point"))


def order_total_off() -> Column:
    return F.abs(F.col("sub_total") + F.col("delivery_fee") - F.col("total_amount")) > CENT


def line_total_off() -> Column:
    return F.abs(F.col("line_total") - F.col("quantity") * F.col("unit_price")) > CENT


# --- A: stock ---------------------------------------------------------------------------------

def a1_negative_stock(t) -> DataFrame:
    return t.store_inventory.filter(F.col("quantity_on_hand") < 0).select(*PAIR, "quantity_on_hand")


def a2_ledger_sum_mismatch(t) -> DataFrame:
    sums = t.inventory_transaction.groupBy(*PAIR).agg(F.sum("quantity_delta").alias("tx_sum"))
    return (
        t.store_inventory.select(*PAIR, "quantity_on_hand")
        .join(merged(sums), PAIR, "left")
        .withColumn("tx_sum", zero("tx_sum"))
        .filter(F.col("quantity_on_hand") != F.col("tx_sum"))
    )


def a3_stock_reconciliation(t) -> DataFrame:
    return (
        t.store_inventory.select(*PAIR, "quantity_on_hand")
        .join(merged(ledger_by_pair(t)), PAIR, "left")
        .join(merged(received_by_pair(t)), PAIR, "left")
        .select(*PAIR, "quantity_on_hand", reconciled().alias("reconciled"))
        .filter(F.col("quantity_on_hand") != F.col("reconciled"))
    )


def a4_inventory_without_restock(t) -> DataFrame:
    restocks = t.inventory_transaction.filter(F.col("transaction_type") == "restock")
    return without_match(merged(t.store_inventory.select(*PAIR)), restocks, PAIR)


# --- B: purchase orders -----------------------------------------------------------------------

def b1_received_exceeds_ordered(t) -> DataFrame:
    return t.purchase_order_item.filter(F.col("quantity_received") > F.col("quantity_ordered")).select(
        "po_item_id", "quantity_ordered", "quantity_received")


def b2_po_total_mismatch(t) -> DataFrame:
    return (
        t.purchase_order.select("po_id", "total_price")
        .join(merged(lines_by_po(t)), "po_id")
        .filter(F.col("total_price") != F.col("computed"))
        .select("po_id", "total_price", F.col("computed").cast("decimal(18,2)").alias("computed"))
    )


def b3_received_po_restock_count(t) -> DataFrame:
    return (
        t.purchase_order.filter(F.col("status") == "received").select("po_id")
        .join(merged(lines_by_po(t)), "po_id")
        .join(merged(restocks_by_po(t)), "po_id", "left")
        .select("po_id", "items", zero("txs").alias("txs"))
        .filter(F.col("items") != F.col("txs"))
    )


def b4_pending_po_received(t) -> DataFrame:
    pending = t.purchase_order.filter(F.col("status") == "pending").select("po_id")
    return (
        t.purchase_order_item.filter(F.col("quantity_received") > 0)
        .select("po_item_id", "po_id", "quantity_received")
        .join(merged(pending), "po_id")
        .select("po_item_id", "po_id", "quantity_received")
    )


# --- C: orders --------------------------------------------------------------------------------

def c1_order_total_mismatch(t) -> DataFrame:
    return t.orders.filter(order_total_off()).select("order_id", "sub_total", "delivery_fee", "total_amount")


def c2_line_total_mismatch(t) -> DataFrame:
    return t.order_item.filter(line_total_off()).select(
        "order_item_id", "line_total",
        (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)").alias("computed"))


def c3_subtotal_mismatch(t) -> DataFrame:
    return (
        t.orders.select("order_id", "sub_total")
        .join(merged(items_by_order(t)), "order_id")
        .filter(F.abs(F.col("sub_total") - F.col("items_total")) > CENT)
        .select("order_id", "sub_total", F.col("items_total").cast("decimal(18,2)").alias("items_total"))
    )


def c4_order_without_items(t) -> DataFrame:
    return without_match(merged(t.orders.select("order_id")), t.order_item, ["order_id"])


def c5_order_without_history(t) -> DataFrame:
    return without_match(merged(t.orders.select("order_id")), t.order_history, ["order_id"])


# --- D: status history ------------------------------------------------------------------------

def d1_latest_status_mismatch(t) -> DataFrame:
    return (
        t.orders.select("order_id", F.col("status").alias("order_status"))
        .join(merged(latest_status(t.order_history)), "order_id")
        .filter(F.col("order_status") != F.col("hist_status"))
    )


def d2_invalid_transitions(t) -> DataFrame:
    return with_previous_status(t.order_history).filter(illegal_move()).select(
        "order_id", "history_id", "prev_status", "status", "changed_at")


def d3_repeated_status(t) -> DataFrame:
    return with_previous_status(t.order_history).filter(F.col("prev_status") == F.col("status")).select(
        "order_id", "history_id", "status", "changed_at")


# --- E: ledger --------------------------------------------------------------------------------

def _ledger_rows(t, bad: Column) -> DataFrame:
    return t.inventory_transaction.filter(bad).select(
        "transaction_id", "transaction_type", "order_id", "po_id", "quantity_delta")


def e1_sale_without_order(t) -> DataFrame:
    return _ledger_rows(t, missing_order())


def e2_restock_without_po(t) -> DataFrame:
    return _ledger_rows(t, missing_po())


def e3_adjustment_with_reference(t) -> DataFrame:
    return _ledger_rows(t, needless_reference())


def e4_delta_sign(t) -> DataFrame:
    return _ledger_rows(t, wrong_sign())


def e5_running_balance(t) -> DataFrame:
    ledger = t.inventory_transaction.select(
        "transaction_id", *PAIR, "quantity_delta", "quantity_after", "timestamp_occurred")
    return (
        with_previous(ledger, PAIR, ["timestamp_occurred", "transaction_id"], {"prev_qty_after": "quantity_after"})
        .filter(F.col("prev_qty_after") + F.col("quantity_delta") != F.col("quantity_after"))
        .select("transaction_id", "prev_qty_after", "quantity_delta", "quantity_after")
    )


# --- F: references ----------------------------------------------------------------------------

def f1_order_store_fk(t) -> DataFrame:
    return not_in(t.orders.select("order_id", "store_id"), "store_id", t.dark_store, "store_id")


def f2_order_customer_fk(t) -> DataFrame:
    return not_in(merged(t.orders.select("order_id", "customer_id")), "customer_id", t.customer, "customer_id")


def f3_item_product_fk(t) -> DataFrame:
    return not_in(merged(t.order_item.select("order_item_id", "product_id")), "product_id", t.product, "product_id")


def with_parents(t, rows: DataFrame) -> DataFrame:
    """``rows`` with markers of a known store and a known product; see ``unknown_parent``."""
    stores = t.dark_store.select("store_id", F.lit(True).alias("_store")).distinct()
    products = t.product.select("product_id", F.lit(True).alias("_product")).distinct()
    return rows.join(stores, "store_id", "left").join(merged(products), "product_id", "left")


def unknown_parent() -> Column:
    """The row's store or product is unknown; a row counts once, whichever is missing."""
    return (F.col("_store").isNull() & F.col("store_id").isNotNull()) | (
        F.col("_product").isNull() & F.col("product_id").isNotNull())


def f4_inventory_fk(t) -> DataFrame:
    rows = t.store_inventory.select("inventory_id", *PAIR)
    return with_parents(t, rows).filter(unknown_parent()).select("inventory_id", *PAIR)


def f5_ledger_fk(t) -> DataFrame:
    rows = t.inventory_transaction.select("transaction_id", *PAIR)
    return with_parents(t, rows).filter(unknown_parent()).select("transaction_id", *PAIR)


def f6_customer_zone_fk(t) -> DataFrame:
    return not_in(t.customer.select("customer_id", "zone_id"), "zone_id", t.zone, "zone_id")


# --- G: business rules ------------------------------------------------------------------------

def g1_reorder_thresholds(t) -> DataFrame:
    return t.store_inventory.filter(bad_thresholds()).select("inventory_id", "reorder_point", "reorder_quantity")


def g2_incomplete_assortment(t) -> DataFrame:
    expected = t.product.agg(F.count(F.lit(1))).scalar()
    return (
        t.store_inventory.groupBy("store_id").agg(F.count(F.lit(1)).alias("cnt"))
        .withColumn("expected", expected)
        .filter(F.col("cnt") != F.col("expected"))
    )


def g3_store_without_received_po(t) -> DataFrame:
    received = t.purchase_order.filter(F.col("status") == "received")
    return without_match(merged(t.dark_store.select("store_id")), received, ["store_id"])


def g4_delivery_fee_mismatch(t) -> DataFrame:
    return (
        t.orders.select("order_id", "customer_id", F.col("delivery_fee").alias("order_fee"))
        .join(merged(t.customer.select("customer_id", "zone_id")), "customer_id")
        .join(t.zone.select("zone_id", F.col("delivery_fee").alias("zone_fee")), "zone_id")
        .filter(F.col("order_fee") != F.col("zone_fee"))
        .select("order_id", "order_fee", "zone_fee")
    )


def g5_history_before_order(t) -> DataFrame:
    return (
        t.order_history.select("history_id", "order_id", "changed_at")
        .join(merged(t.orders.select("order_id", "created_at")), "order_id")
        .filter(F.col("changed_at") < F.col("created_at"))
        .select("order_id", "history_id", "created_at", "changed_at")
    )


# --- H: cross-table ---------------------------------------------------------------------------

def h1_cancel_without_return(t) -> DataFrame:
    cancelled = t.orders.filter(F.col("status") == "cancelled").select("order_id")
    confirmed = t.order_history.filter(F.col("status") == "confirmed")
    returns = t.inventory_transaction.filter(F.col("transaction_type") == "return")
    return without_match(merged(with_match(merged(cancelled), confirmed, ["order_id"])), returns, ["order_id"])


def h2_missing_sale(t) -> DataFrame:
    sold = t.orders.filter(F.col("status").isin("confirmed", "delivered")).select("order_id")
    sales = t.inventory_transaction.filter(F.col("transaction_type") == "sale").select(
        "order_id", "product_id", F.abs("quantity_delta").alias("quantity"))
    items = t.order_item.select("order_id", "order_item_id", "product_id", "quantity").join(merged(sold), "order_id")
    return without_match(merged(items), sales, ["order_id", "product_id", "quantity"]).select(
        "order_id", "order_item_id", "product_id", "quantity")


@dataclass(frozen=True)
class Check:
    """One check: its group, its number, what a pass means and the columns that identify a violation."""

    group_id: str
    check_id: str
    label: str
    run: Callable[..., DataFrame]
    key: tuple[str, ...]
    evidence: tuple[str, ...] = ()

    @property
    def query(self) -> str:
        return self.run.__name__


CHECKS = (
    Check("A", "A1", "stock on hand is not negative", a1_negative_stock, tuple(PAIR), ("quantity_on_hand",)),
    Check("A", "A2", "stock equals the sum of ledger deltas", a2_ledger_sum_mismatch, tuple(PAIR),
          ("quantity_on_hand", "tx_sum")),
    Check("A", "A3", "stock equals received + returned + adjusted - sold", a3_stock_reconciliation, tuple(PAIR),
          ("quantity_on_hand", "reconciled")),
    Check("A", "A4", "stocked product was restocked once", a4_inventory_without_restock, tuple(PAIR)),
    Check("B", "B1", "received does not exceed ordered", b1_received_exceeds_ordered, ("po_item_id",),
          ("quantity_ordered", "quantity_received")),
    Check("B", "B2", "purchase order total equals its lines", b2_po_total_mismatch, ("po_id",),
          ("total_price", "computed")),
    Check("B", "B3", "received purchase order has a restock per line", b3_received_po_restock_count, ("po_id",),
          ("items", "txs")),
    Check("B", "B4", "pending purchase order received nothing", b4_pending_po_received, ("po_item_id",),
          ("po_id", "quantity_received")),
    Check("C", "C1", "order total equals subtotal plus fee", c1_order_total_mismatch, ("order_id",),
          ("sub_total", "delivery_fee", "total_amount")),
    Check("C", "C2", "line total equals quantity times price", c2_line_total_mismatch, ("order_item_id",),
          ("line_total", "computed")),
    Check("C", "C3", "order subtotal equals its lines", c3_subtotal_mismatch, ("order_id",),
          ("sub_total", "items_total")),
    Check("C", "C4", "order has an item", c4_order_without_items, ("order_id",)),
    Check("C", "C5", "order has a history row", c5_order_without_history, ("order_id",)),
    Check("D", "D1", "newest history status equals order status", d1_latest_status_mismatch, ("order_id",),
          ("order_status", "hist_status")),
    Check("D", "D2", "status moves are legal", d2_invalid_transitions, ("order_id", "history_id"),
          ("prev_status", "status")),
    Check("D", "D3", "status does not repeat", d3_repeated_status, ("order_id", "history_id"), ("status",)),
    Check("E", "E1", "sale or return names an order", e1_sale_without_order, ("transaction_id",),
          ("transaction_type", "quantity_delta")),
    Check("E", "E2", "restock names a purchase order", e2_restock_without_po, ("transaction_id",),
          ("transaction_type", "quantity_delta")),
    Check("E", "E3", "adjustment names neither", e3_adjustment_with_reference, ("transaction_id",),
          ("transaction_type", "quantity_delta")),
    Check("E", "E4", "delta sign fits the movement type", e4_delta_sign, ("transaction_id",),
          ("transaction_type", "quantity_delta")),
    Check("E", "E5", "running balance is continuous", e5_running_balance, ("transaction_id",),
          ("prev_qty_after", "quantity_delta", "quantity_after")),
    Check("F", "F1", "order has a known store", f1_order_store_fk, ("order_id",), ("store_id",)),
    Check("F", "F2", "order has a known customer", f2_order_customer_fk, ("order_id",), ("customer_id",)),
    Check("F", "F3", "order item has a known product", f3_item_product_fk, ("order_item_id",), ("product_id",)),
    Check("F", "F4", "stock row has a known store and product", f4_inventory_fk, ("inventory_id",), tuple(PAIR)),
    Check("F", "F5", "ledger row has a known store and product", f5_ledger_fk, ("transaction_id",), tuple(PAIR)),
    Check("F", "F6", "customer has a known zone", f6_customer_zone_fk, ("customer_id",), ("zone_id",)),
    Check("G", "G1", "reorder thresholds make sense", g1_reorder_thresholds, ("inventory_id",),
          ("reorder_point", "reorder_quantity")),
    Check("G", "G2", "store carries every product", g2_incomplete_assortment, ("store_id",), ("cnt", "expected")),
    Check("G", "G3", "store has a received purchase order", g3_store_without_received_po, ("store_id",)),
    Check("G", "G4", "delivery fee equals the zone fee", g4_delivery_fee_mismatch, ("order_id",),
          ("order_fee", "zone_fee")),
    Check("G", "G5", "history does not precede the order", g5_history_before_order, ("order_id", "history_id"),
          ("created_at", "changed_at")),
    Check("H", "H1", "cancellation after confirmation returned stock", h1_cancel_without_return, ("order_id",)),
    Check("H", "H2", "confirmed item has its sale", h2_missing_sale, ("order_item_id",),
          ("order_id", "product_id", "quantity")),
)
