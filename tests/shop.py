"""The small shop that the tests plant violations in, and helpers to build its tables."""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from stockaudit.schemas import TABLE_NAMES, schema_of

D = Decimal
T0 = datetime.datetime(2024, 1, 1, 0, 0)


def at(minutes: float) -> datetime.datetime:
    """Minutes after 10:00 of the test day."""
    return datetime.datetime(2024, 1, 8, 10, 0) + datetime.timedelta(minutes=minutes)


def clean_rows() -> dict[str, list[dict]]:
    """A small shop in which every check passes."""
    def ledger(i, store, product, kind, delta, after, ts, order=None, po=None):
        return dict(transaction_id=i, store_id=store, product_id=product, transaction_type=kind, order_id=order, po_id=po,
                    quantity_delta=delta, quantity_after=after, timestamp_occurred=ts)

    def order(i, store, customer, status, sub, created):
        return dict(order_id=i, store_id=store, customer_id=customer, status=status, payment_method="card",
                    sub_total=D(sub), delivery_fee=D("20.00"), total_amount=D(sub) + 20, created_at=created)

    def item(i, order_id, product, quantity, price):
        return dict(order_item_id=i, order_id=order_id, product_id=product, quantity=quantity, unit_price=D(price),
                    line_total=quantity * D(price))

    def moved(i, order_id, status, ts):
        return dict(history_id=i, order_id=order_id, status=status, changed_at=ts)

    return {
        "category": [dict(category_id=1, name="Dairy", requires_cold_chain=True),
                     dict(category_id=2, name="Snacks", requires_cold_chain=False)],
        "supplier": [dict(supplier_id=7, name="Nile Foods Co.")],
        "product": [dict(product_id=1, category_id=1, name="Milk", sku="D-1", shelf_life_days=7),
                    dict(product_id=2, category_id=2, name="Chips", sku="S-1", shelf_life_days=90)],
        "zone": [dict(zone_id=1, name="Center", delivery_fee=D("20.00"))],
        "dark_store": [dict(store_id=1, name="North"), dict(store_id=2, name="South")],
        "customer": [dict(customer_id=1, zone_id=1, first_name="A", last_name="B", phone_number="010 12345678"),
                     dict(customer_id=2, zone_id=1, first_name="C", last_name="D", phone_number="011 12345678")],
        "store_inventory": [
            dict(inventory_id=11, store_id=1, product_id=1, quantity_on_hand=98, reorder_point=20, reorder_quantity=100),
            dict(inventory_id=12, store_id=1, product_id=2, quantity_on_hand=99, reorder_point=20, reorder_quantity=100),
            dict(inventory_id=21, store_id=2, product_id=1, quantity_on_hand=100, reorder_point=20, reorder_quantity=100),
            dict(inventory_id=22, store_id=2, product_id=2, quantity_on_hand=97, reorder_point=20, reorder_quantity=100)],
        "purchase_order": [
            dict(po_id=s, store_id=s, supplier_id=7, status="received", total_price=D("1000.00"), ordered_at=T0,
                 received_at=T0) for s in (1, 2)]
        + [dict(po_id=3, store_id=1, supplier_id=7, status="pending", total_price=D("50.00"), ordered_at=at(0))],
        "purchase_order_item": [
            dict(po_item_id=s * 10 + p, po_id=s, product_id=p, quantity_ordered=100, quantity_received=100,
                 unit_price=D("5.00")) for s in (1, 2) for p in (1, 2)]
        + [dict(po_item_id=31, po_id=3, product_id=1, quantity_ordered=10, quantity_received=0, unit_price=D("5.00"))],
        "orders": [order(1, 1, 1, "delivered", "50.00", at(0)), order(2, 1, 2, "cancelled", "20.00", at(5)),
                   order(3, 2, 1, "pending", "30.00", at(6))],
        "order_item": [item(1, 1, 1, 2, "20.00"), item(2, 1, 2, 1, "10.00"), item(3, 2, 1, 1, "20.00"),
                       item(4, 3, 2, 3, "10.00")],
        "order_history": [
            moved(1, 1, "pending", at(0)), moved(2, 1, "confirmed", at(4)), moved(3, 1, "delivered", at(30)),
            moved(4, 2, "pending", at(5)), moved(5, 2, "confirmed", at(9)), moved(6, 2, "cancelled", at(20)),
            moved(7, 3, "pending", at(6))],
        "inventory_transaction": [
            ledger(1, 1, 1, "restock", 100, 100, T0, po=1), ledger(2, 1, 2, "restock", 100, 100, T0, po=1),
            ledger(3, 2, 1, "restock", 100, 100, T0, po=2), ledger(4, 2, 2, "restock", 100, 100, T0, po=2),
            ledger(5, 1, 1, "sale", -2, 98, at(4), order=1), ledger(6, 1, 2, "sale", -1, 99, at(4), order=1),
            ledger(7, 1, 1, "sale", -1, 97, at(9), order=2), ledger(8, 1, 1, "return", 1, 98, at(20), order=2),
            ledger(9, 2, 2, "adjustment", -3, 97, at(40))],
    }


def frame(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    schema = schema_of(table)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


class LazyTables:
    """Creates a table's frame when an operator first reads it."""

    def __init__(self, spark: SparkSession, rows: dict[str, list[dict]]):
        self._spark, self._rows = spark, rows

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        made = frame(self._spark, name, self._rows.get(name, []))
        setattr(self, name, made)
        return made
