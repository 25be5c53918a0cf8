"""The audit report: violations per check from shared passes, and the first violations of each check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockaudit.operators import checks as c
from stockaudit.operators.existence import merged
from stockaudit.operators.ordered import with_previous

SAMPLES = 3


def _union(frames: list[DataFrame]) -> DataFrame:
    """Union in pairs, so the plan of each frame is analysed a few times, not once per frame."""
    while len(frames) > 1:
        pairs = [frames[i:i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


def _counts(rows: DataFrame, sums: dict[str, Column] | None = None, **tests: Column) -> DataFrame:
    """One row per check id with the number of rows that meet its test, from one pass over ``rows``.

    ``sums`` has checks of which a row may hold several violations: their number per row.
    """
    found = {check: F.count_if(test) for check, test in tests.items()}
    found |= {check: F.coalesce(F.sum(n), F.lit(0)).cast("bigint") for check, n in (sums or {}).items()}
    one_row = rows.agg(*[n.alias(check) for check, n in found.items()])
    return one_row.select(F.inline(F.array(*[
        F.struct(F.lit(check).alias("check_id"), F.col(check).alias("violations")) for check in found
    ])))


def _count(check_id: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(check_id).alias("check_id"), "violations")


def _stock_counts(t) -> DataFrame:
    """Inventory joined once to the ledger sums, the received quantities and its parents."""
    rows = (
        c.with_parents(t, t.store_inventory)
        .join(merged(c.ledger_by_pair(t)), c.PAIR, "left")
        .join(merged(c.received_by_pair(t)), c.PAIR, "left")
    )
    on_hand = F.col("quantity_on_hand")
    return _counts(
        rows, A1=on_hand < 0, A2=on_hand != c.zero("tx_sum"), A3=on_hand != c.reconciled(),
        A4=c.zero("restocks") == 0, F4=c.unknown_parent(), G1=c.bad_thresholds(),
    )


def _purchase_counts(t) -> DataFrame:
    """Purchase orders joined once to their line sums and restock counts."""
    rows = (
        t.purchase_order.select("po_id", "status", "total_price")
        .join(merged(c.lines_by_po(t)), "po_id")
        .join(merged(c.restocks_by_po(t)), "po_id", "left")
    )
    return _counts(
        rows, B2=F.col("total_price") != F.col("computed"),
        B3=(F.col("status") == "received") & (F.col("items") != c.zero("txs")),
    )


def _order_counts(t) -> DataFrame:
    """Orders joined once to per-order summaries, all on the order id."""
    newest = F.struct("changed_at", "history_id")
    history = t.order_history.groupBy("order_id").agg(
        F.max_by("status", newest).alias("hist_status"),
        F.count_if(F.col("status") == "confirmed").alias("confirmed"),
        F.lit(True).alias("has_history"),
    )
    returns = (
        t.inventory_transaction.filter((F.col("transaction_type") == "return") & F.col("order_id").isNotNull())
        .groupBy("order_id").agg(F.lit(True).alias("has_return"))
    )
    items = c.items_by_order(t).withColumn("has_items", F.lit(True))
    rows = (
        t.orders.select("order_id", "status", "sub_total", "delivery_fee", "total_amount")
        .join(merged(items), "order_id", "left").join(merged(history), "order_id", "left")
        .join(merged(returns), "order_id", "left")
    )
    return _counts(
        rows, C1=c.order_total_off(), C3=F.abs(F.col("sub_total") - F.col("items_total")) > c.CENT,
        C4=F.col("has_items").isNull(), C5=F.col("has_history").isNull(),
        D1=F.col("status") != F.col("hist_status"),
        H1=(F.col("status") == "cancelled") & (F.col("confirmed") > 0) & F.col("has_return").isNull(),
    )


def _ledger_counts(t) -> DataFrame:
    """One ordered pass over the ledger, counted per pair before the two parents are attached."""
    ledger = with_previous(t.inventory_transaction, c.PAIR, ["timestamp_occurred", "transaction_id"],
                           {"prev_qty_after": "quantity_after"})
    tests = {
        "E1": c.missing_order(), "E2": c.missing_po(), "E3": c.needless_reference(), "E4": c.wrong_sign(),
        "E5": F.col("prev_qty_after") + F.col("quantity_delta") != F.col("quantity_after"),
    }
    pairs = ledger.groupBy(*c.PAIR).agg(
        *[F.count_if(test).alias(check) for check, test in tests.items()], F.count(F.lit(1)).alias("moves"))
    return _counts(c.with_parents(t, pairs), {check: F.col(check) for check in tests} | {
        "F5": F.when(c.unknown_parent(), F.col("moves"))})


def _item_counts(t) -> DataFrame:
    """Order items, counted per product before it is attached."""
    products = t.product.select("product_id", F.lit(True).alias("_product")).distinct()
    items = t.order_item.groupBy("product_id").agg(
        F.count_if(c.line_total_off()).alias("C2"), F.count(F.lit(1)).alias("items"))
    unknown = F.col("_product").isNull() & F.col("product_id").isNotNull()
    return _counts(items.join(merged(products), "product_id", "left"), {
        "C2": F.col("C2"), "F3": F.when(unknown, F.col("items"))})


def _order_parent_counts(t) -> DataFrame:
    """Orders with their store and the delivery fees of their customer's zone attached."""
    stores = t.dark_store.select("store_id", F.lit(True).alias("_store")).distinct()
    zones = t.zone.select("zone_id", F.col("delivery_fee").alias("_fee"))
    fees = (
        t.customer.filter(F.col("customer_id").isNotNull()).select("customer_id", "zone_id").join(zones, "zone_id", "left")
        .groupBy("customer_id").agg(F.collect_list("_fee").alias("_fees"))  # one, unless a key is repeated
    )
    rows = t.orders.select("store_id", "customer_id", "delivery_fee").join(stores, "store_id", "left").join(
        merged(fees), "customer_id", "left")
    other = F.size(F.filter("_fees", lambda fee: fee != F.col("delivery_fee")))
    return _counts(rows, {"G4": F.when(F.col("_fees").isNotNull(), other)},
                   F1=F.col("_store").isNull() & F.col("store_id").isNotNull(),
                   F2=F.col("_fees").isNull() & F.col("customer_id").isNotNull())


def _purchase_line_counts(t) -> DataFrame:
    """Purchase lines, counted per order before the number of pending orders of that id is attached."""
    pending = t.purchase_order.groupBy("po_id").agg(F.count_if(F.col("status") == "pending").alias("_pending"))
    lines = t.purchase_order_item.groupBy("po_id").agg(
        F.count_if(F.col("quantity_received") > F.col("quantity_ordered")).alias("B1"),
        F.count_if(F.col("quantity_received") > 0).alias("delivered"))
    return _counts(lines.join(merged(pending), "po_id", "left"), {
        "B1": F.col("B1"), "B4": F.col("delivered") * F.col("_pending")})


def _history_counts(t) -> DataFrame:
    """One ordered pass over the status history."""
    rows = c.with_previous_status(t.order_history)
    return _counts(rows, D2=c.illegal_move(), D3=F.col("prev_status") == F.col("status"))


def labelled(counts: DataFrame) -> DataFrame:
    """The report lines for (check_id, violations)."""
    words = F.create_map(*[F.lit(v) for k in c.CHECKS for v in (k.check_id, k.label)])
    return counts.select(
        F.left("check_id", F.lit(1)).alias("group_id"), "check_id", words[F.col("check_id")].alias("label"),
        F.col("violations").cast("bigint").alias("violations"),
        F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def audit_summary(t) -> DataFrame:
    """One row per check: group, id, label, number of violations, PASS or FAIL.

    Checks over the same table or join share one pass; the others are counted on their own.
    """
    shared = {"A1", "A2", "A3", "A4", "F4", "G1", "B1", "B2", "B3", "C1", "C2", "B4", "C3", "C4", "C5", "D1", "D2", "D3",
              "E1", "E2", "E3", "E4", "E5", "F1", "F2", "F3", "F5", "G4", "H1"}
    return labelled(_union([
        _stock_counts(t), _purchase_counts(t), _order_counts(t), _ledger_counts(t), _history_counts(t),
        _item_counts(t), _order_parent_counts(t), _purchase_line_counts(t),
        *[_count(k.check_id, k.run(t)) for k in c.CHECKS if k.check_id not in shared],
    ]))


def _as_text(names: tuple[str, ...], named: bool) -> str:
    """SQL for the values of some columns as one text."""
    if not names:
        return "''"
    values = [f"coalesce(cast({n} AS string), 'null')" for n in names]
    parts = [f"concat('{n}=', {v})" for n, v in zip(names, values, strict=True)] if named else values
    return f"concat_ws('{' ' if named else ':'}', {', '.join(parts)})"


def violations(t, check: c.Check) -> DataFrame:
    """The violations of one check in the common shape (check id, key, detail), plus the key's parts."""
    return check.run(t).selectExpr(
        f"'{check.check_id}' AS check_id", f"{_as_text(check.key, False)} AS key",
        f"{_as_text(check.evidence, True)} AS detail", *[f"{k} AS _k{i}" for i, k in enumerate(check.key)])


def all_violations(t) -> DataFrame:
    return _union([violations(t, k).select("check_id", "key", "detail") for k in c.CHECKS])


def audit_samples(t, n: int = SAMPLES) -> DataFrame:
    """The first ``n`` violations of each check by key: a top-n per check, merged map-side."""
    tops = []
    for check in c.CHECKS:
        order = [f"_k{i}" for i in range(len(check.key))]
        tops.append(
            violations(t, check).orderBy(*order).limit(n)
            .withColumn("rn", F.row_number().over(Window.partitionBy("check_id").orderBy(*order)))
            .select("check_id", "rn", "key", "detail")
        )
    return _union(tops)
