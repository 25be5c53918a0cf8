"""Order rules: pricing, the event feed, lifecycle questions as of a time, snapshots."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockaudit.functions import columns as c
from stockaudit.functions.parameters import DEFAULT_DELIVERY_FEE, STALE_HOURS

OPEN = ("pending", "confirmed")


def price_orders(items: DataFrame, orders: DataFrame, customers: DataFrame, zones: DataFrame) -> DataFrame:
    """Subtotal from the lines, fee of the customer's zone (a fixed fee if unknown), and their sum."""
    lines = items.groupBy("order_id").agg(F.round(F.sum(F.col("quantity") * F.col("unit_price")), 2).alias("s"))
    fees = customers.select("customer_id", "zone_id").join(zones.select("zone_id", "delivery_fee"), "zone_id").select(
        "customer_id", "delivery_fee")
    money = "decimal(18,2)"
    return (
        orders.select("order_id", "customer_id").join(lines, "order_id", "left").join(fees, "customer_id", "left")
        .select("order_id", F.coalesce("s", F.lit(0)).cast(money).alias("sub_total"),
                F.coalesce("delivery_fee", F.lit(DEFAULT_DELIVERY_FEE).cast("decimal(10,2)")).cast(money)
                .alias("delivery_fee"))
        .withColumn("total_amount", (F.col("sub_total") + F.col("delivery_fee")).cast(money))
    )


def _events(df: DataFrame, ts: str, event: Column | str, entity: str, detail: Column) -> DataFrame:
    return df.select(
        F.col(ts).alias("ts"), (F.lit(event) if isinstance(event, str) else event).alias("event"),
        F.col(entity).cast("bigint").alias("entity_id"), detail.alias("detail"))


def business_events(t) -> DataFrame:
    """All business events of the tables, unordered."""
    text = lambda name: F.col(name).cast("string")
    moves = t.order_history.filter(F.col("status").isin("confirmed", "delivered", "cancelled"))
    adjusted = t.inventory_transaction.filter(F.col("transaction_type") == "adjustment")
    reason = F.when(F.col("quantity_delta") < 0, "shrinkage").otherwise("found_extra")
    parts = [
        _events(t.orders, "created_at", "ORDER_CREATED", "order_id",
                F.concat(F.lit("customer="), text("customer_id"), F.lit(" store="), text("store_id"))),
        _events(moves, "changed_at", F.concat(F.lit("ORDER_"), F.upper("status")), "order_id", F.lit("")),
        _events(t.customer.filter(F.col("registered_time").isNotNull()), "registered_time", "CUSTOMER_REGISTERED",
                "customer_id", F.concat(F.lit("zone="), text("zone_id"))),
        _events(adjusted, "timestamp_occurred", "STOCK_ADJUSTED", "transaction_id",
                F.concat(F.lit("delta="), text("quantity_delta"), F.lit(" reason="), reason)),
        _events(t.purchase_order, "ordered_at", "PO_CREATED", "po_id", F.concat(F.lit("store="), text("store_id"))),
        _events(t.purchase_order.filter(F.col("received_at").isNotNull()), "received_at", "PO_RECEIVED", "po_id",
                F.concat(F.lit("store="), text("store_id"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def business_event_feed(t) -> DataFrame:
    return business_events(t).orderBy("ts", "event", "entity_id")


def status_as_of(history: DataFrame, as_of: datetime.datetime) -> DataFrame:
    """The newest history row of each order up to ``as_of``."""
    newest = F.max(F.struct("changed_at", "history_id", "status"))
    upto = history.filter(F.col("changed_at") <= F.lit(as_of).cast("timestamp_ntz"))
    return upto.groupBy("order_id").agg(newest.alias("h")).select("order_id", "h.status", "h.changed_at")


def open_orders_as_of(orders: DataFrame, history: DataFrame, as_of: datetime.datetime) -> DataFrame:
    current = status_as_of(history, as_of).filter(F.col("status").isin(*OPEN))
    return current.join(orders.select("order_id"), "order_id").select("order_id", "status", "changed_at")


def open_at_day_end(orders: DataFrame, history: DataFrame, will_confirm: Column) -> DataFrame:
    """Orders still open at their first closing time, and how the night closes them.

    Closing time ends every open order, so an order meets it once: on the day of its creation. The history
    is first reduced to the newest row per order and business day; a day lies wholly before or
    after a closing time, so the join sees those rows only.
    """
    created = orders.select("order_id", c.day_end(F.col("created_at")).alias("_end"))
    newest = F.max(F.struct("changed_at", "history_id", "status"))
    daily = history.groupBy("order_id", c.day_end(F.col("changed_at")).alias("_day")).agg(newest.alias("h"))
    at_end = (
        daily.join(created, "order_id")
        .filter(F.col("_day") <= F.col("_end"))
        .groupBy("order_id", "_end").agg(F.max("h").alias("h"))
        .filter(F.col("h.status").isin(*OPEN))
    )
    closing = F.when(F.col("h.status") == "confirmed", "deliver").when(
        will_confirm, "confirm_then_deliver").otherwise("cancel")
    return at_end.select(F.to_date("_end").alias("day"), "order_id", F.col("h.status").alias("status"),
                         closing.alias("closing"))


def order_snapshot_json(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Open orders as JSON texts: for each a header (``order_item_id`` NULL), and one text per item.

    Every order has this shape, so no row grows with an order.
    """
    head = orders.filter(F.col("status").isin(*OPEN)).select(
        "order_id", "status", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
        F.col("store_id").cast("bigint").alias("store_id"), "customer_id")
    lines = items.select("order_id", "order_item_id", "product_id", "quantity", F.col("unit_price").alias("price")).join(
        head.select("order_id"), "order_id", "left_semi")
    return head.select(
        "order_id", F.lit(None).cast("bigint").alias("order_item_id"),
        F.to_json(F.struct("order_id", "status", "created_at", "store_id", "customer_id")).alias("json"),
    ).unionByName(lines.select(
        "order_id", "order_item_id",
        F.to_json(F.struct("order_id", "order_item_id", "product_id", "quantity", "price")).alias("json")))


SNAPSHOT = ("order_id BIGINT, status STRING, created_at STRING, store_id BIGINT, customer_id BIGINT, "
            "order_item_id BIGINT, product_id BIGINT, quantity INT, price DECIMAL(10,2)")


def read_snapshots(snapshots: DataFrame) -> DataFrame:
    """One row per item of the parsable snapshots, one without a product for an open order without items.

    Text that does not parse is skipped, and so are items whose order's header is lost.
    """
    read = snapshots.select(F.from_json("json", SNAPSHOT).alias("o")).filter(F.col("o.order_id").isNotNull()).select("o.*")
    lines = read.filter(F.col("order_item_id").isNotNull()).select("order_id", "product_id", "quantity", "price")
    return read.filter(F.col("status").isNotNull()).select("order_id").join(lines, "order_id", "left")


def discard_stale_state(snapshots: DataFrame, clock: str, now: datetime.datetime, hours: int = STALE_HOURS) -> DataFrame:
    """Snapshot rows whose clock is less than ``hours`` old."""
    oldest = now - datetime.timedelta(hours=hours)
    return snapshots.filter(F.col(clock) > F.lit(oldest).cast("timestamp_ntz"))


def customer_registrations(customers: DataFrame, zones: DataFrame) -> DataFrame:
    """New customers per known zone and day."""
    known = zones.select("zone_id").distinct()
    return (
        customers.filter(F.col("registered_time").isNotNull())
        .groupBy("zone_id", F.to_date("registered_time").alias("day")).agg(F.count(F.lit(1)).alias("n"))
        .join(known, "zone_id", "left_semi")
    )


def phone_format_violations(customers: DataFrame) -> DataFrame:
    return customers.filter(~c.is_phone(F.col("phone_number"))).select(
        "customer_id", F.col("phone_number").alias("phone"))


def dimension_enriched_orders(t) -> DataFrame:
    """Order lines with the attributes of their order, customer, zone, store, product and category."""
    products = t.product.select("product_id", "category_id", F.col("name").alias("product_name")).join(
        t.category.select("category_id", F.col("name").alias("category_name"), "requires_cold_chain"),
        "category_id", "left")
    customers = t.customer.select("customer_id", "zone_id", F.col("first_name").alias("customer_name")).join(
        t.zone.select("zone_id", F.col("name").alias("zone_name"), "delivery_fee"), "zone_id", "left")
    orders = (
        t.orders.select("order_id", "store_id", "customer_id", "status", "created_at")
        .join(customers, "customer_id", "left")
        .join(t.dark_store.select("store_id", F.col("name").alias("store_name")), "store_id", "left")
    )
    return (
        t.order_item.select("order_item_id", "order_id", "product_id", "quantity", "line_total")
        .join(orders, "order_id").join(products, "product_id", "left")
        .select("order_item_id", "order_id", "status", "created_at", "store_name", "customer_name", "zone_name",
                "delivery_fee", "product_name", "category_name", "requires_cold_chain", "quantity", "line_total")
    )


def next_workday_starts(rows: DataFrame, key: str, ts: str) -> DataFrame:
    return rows.select(key, c.next_workday_start(F.col(ts)).alias("next_start"))


def off_hours_activity(history: DataFrame) -> DataFrame:
    return history.filter(c.is_off_hours(F.col("changed_at"))).select("history_id", "changed_at")
