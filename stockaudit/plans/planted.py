"""Inputs the derived layer lacks, built from its tables by fixed rules (the DuckDB side states the same)."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockaudit.tables import replace

AS_OF = datetime.datetime(1998, 6, 15, 12, 0, 0)
LOAD_TIME = datetime.datetime(2024, 10, 1, 0, 0, 0)

# Price bands of the test categories; STANDARD has none and takes the default.
TEST_BANDS = {"ECONOMY": (10, 60), "LARGE": (5, 40), "MEDIUM": (8, 50), "PROMO": (15, 80), "SMALL": (3, 30)}


def _when(condition: str, then: str, column: str):
    return F.expr(f"CASE WHEN {condition} THEN {then} ELSE {column} END")


def with_contacts(customers: DataFrame) -> DataFrame:
    """Phone and registration time; some phones are malformed and many repeat."""
    phone = ("concat(CASE WHEN customer_id % 97 = 5 THEN '013' WHEN customer_id % 4 = 0 THEN '010' "
             "WHEN customer_id % 4 = 1 THEN '011' WHEN customer_id % 4 = 2 THEN '012' ELSE '015' END, "
             "CASE WHEN customer_id % 89 = 3 THEN '' ELSE ' ' END, CAST(10000000 + (customer_id % 700) * 7919 AS STRING))")
    day = "CAST('2024-10-01 00:00:00' AS TIMESTAMP_NTZ) + INTERVAL '1' DAY * CAST(customer_id % 91 AS INT)"
    return customers.withColumns({"phone_number": F.expr(phone), "registered_time": F.expr(day)})


def registered(t):
    return replace(t, customer=with_contacts(t.customer))


def inventory_with_gaps(t) -> DataFrame:
    return t.store_inventory.select(
        "inventory_id", _when("product_id % 10 = 0", "NULL", "quantity_on_hand").alias("quantity_on_hand"),
        _when("product_id % 7 = 0", "NULL", "reorder_point").alias("reorder_point"))


def with_new_stores(t):
    """Every store has a twin with the same stock and no purchase order yet."""
    twin = lambda df: df.unionByName(df.withColumn("store_id", F.col("store_id") + 1000))
    return replace(t, dark_store=twin(t.dark_store), store_inventory=twin(t.store_inventory))


def product_source(t) -> DataFrame:
    """A catalogue load: some renamed, some new, some of unknown category, some with another shelf life."""
    return t.product.join(t.category.select("category_id", F.col("name").alias("category")), "category_id").select(
        F.col("product_id").alias("seq"),
        F.expr("CASE WHEN product_id % 11 = 0 THEN concat(sku, '-N') ELSE sku END").alias("sku"),
        F.expr("CASE WHEN product_id % 7 = 0 THEN concat(name, ' v2') ELSE name END").alias("name"),
        (F.col("shelf_life_days") + 1).alias("shelf_life_days"),
        F.expr("CASE WHEN product_id % 13 = 0 THEN 'UNKNOWN' ELSE category END").alias("category"),
    )


def with_nulls(t):
    return replace(
        t,
        orders=t.orders.withColumn("status", _when("order_id % 401 = 7", "NULL", "status")),
        product=t.product.withColumn("name", _when("product_id % 301 = 3", "NULL", "name")),
        inventory_transaction=t.inventory_transaction.withColumn(
            "quantity_delta", _when("transaction_id % 1501 = 11", "NULL", "quantity_delta")),
    )


def with_foreign_words(t):
    return replace(
        t,
        orders=t.orders.withColumn("status", _when("order_id % 601 = 5", "'archived'", "status")),
        purchase_order=t.purchase_order.withColumn("status", _when("po_id % 41 = 2", "'lost'", "status")),
        inventory_transaction=t.inventory_transaction.withColumn(
            "transaction_type", _when("transaction_id % 1511 = 13", "'theft'", "transaction_type")),
    )


def with_wide_amounts(t):
    wide = "CAST({c} AS DECIMAL(20,2)) + CASE WHEN {k} THEN CAST(20000000000 AS DECIMAL(20,2)) ELSE CAST(0 AS DECIMAL(20,2)) END"
    return replace(
        t,
        orders=t.orders.withColumn("total_amount", F.expr(wide.format(c="total_amount", k="order_id % 701 = 9"))),
        order_item=t.order_item.withColumn("unit_price", F.expr(wide.format(c="unit_price", k="order_item_id % 1709 = 8"))),
    )


def with_repeats(t):
    """Two tables in which some rows appear twice, one with NULL keys."""
    return replace(
        t,
        order_history=t.order_history.unionByName(t.order_history.filter("history_id % 1201 = 4")),
        customer=t.customer.withColumn("customer_id", _when("customer_id % 509 = 6", "NULL", "customer_id")),
    )
