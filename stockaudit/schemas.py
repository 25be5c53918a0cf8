"""The retail data model: column types, keys, defaults and declared limits of the 13 tables.

Identifiers are 64-bit wherever the row count grows with the business; timestamps carry no zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The declared columns of each table.
COLUMNS = {
    "category": "category_id INT, name STRING, requires_cold_chain BOOLEAN",
    "supplier": "supplier_id BIGINT, name STRING, phone STRING, email STRING",
    "product": "product_id BIGINT, category_id INT, name STRING, sku STRING, shelf_life_days INT, "
               "is_active BOOLEAN, created_at TIMESTAMP_NTZ",
    "zone": "zone_id INT, name STRING, city STRING, delivery_fee DECIMAL(10,2), est_time_arrival INT, "
            "is_active BOOLEAN, created_at TIMESTAMP_NTZ",
    "dark_store": "store_id INT, name STRING, city STRING, street STRING, is_active BOOLEAN, "
                  "created_at TIMESTAMP_NTZ",
    "customer": "customer_id BIGINT, zone_id INT, first_name STRING, last_name STRING, phone_number STRING, "
                "full_address STRING, registered_time TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ",
    "store_inventory": "inventory_id BIGINT, store_id INT, product_id BIGINT, quantity_on_hand INT, "
                       "reorder_point INT, reorder_quantity INT, last_updated TIMESTAMP_NTZ",
    "purchase_order": "po_id BIGINT, store_id INT, supplier_id INT, status STRING, total_price DECIMAL(14,2), "
                      "ordered_at TIMESTAMP_NTZ, received_at TIMESTAMP_NTZ",
    "purchase_order_item": "po_item_id BIGINT, po_id BIGINT, product_id BIGINT, quantity_ordered INT, "
                           "quantity_received INT, unit_price DECIMAL(10,2)",
    "orders": "order_id BIGINT, store_id INT, customer_id BIGINT, status STRING, payment_method STRING, "
              "sub_total DECIMAL(12,2), delivery_fee DECIMAL(8,2), total_amount DECIMAL(12,2), "
              "created_at TIMESTAMP_NTZ",
    "order_item": "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, "
                  "unit_price DECIMAL(10,2), line_total DECIMAL(21,2)",
    "order_history": "history_id BIGINT, order_id BIGINT, status STRING, changed_at TIMESTAMP_NTZ",
    "inventory_transaction": "transaction_id BIGINT, store_id INT, product_id BIGINT, transaction_type STRING, "
                             "order_id BIGINT, po_id BIGINT, quantity_delta INT, quantity_after INT, "
                             "timestamp_occurred TIMESTAMP_NTZ",
}

TABLE_NAMES = tuple(COLUMNS)

# Primary keys.
PRIMARY_KEYS = {
    "category": "category_id",
    "supplier": "supplier_id",
    "product": "product_id",
    "zone": "zone_id",
    "dark_store": "store_id",
    "customer": "customer_id",
    "store_inventory": "inventory_id",
    "purchase_order": "po_id",
    "purchase_order_item": "po_item_id",
    "orders": "order_id",
    "order_item": "order_item_id",
    "order_history": "history_id",
    "inventory_transaction": "transaction_id",
}

# UNIQUE constraints.
UNIQUE_KEYS = (
    ("product", ("sku",)),
    ("store_inventory", ("store_id", "product_id")),
)

# Foreign keys as (child table, column, parent table).
FOREIGN_KEYS = (
    ("product", "category_id", "category"),
    ("customer", "zone_id", "zone"),
    ("store_inventory", "store_id", "dark_store"),
    ("store_inventory", "product_id", "product"),
    ("purchase_order", "store_id", "dark_store"),
    ("purchase_order", "supplier_id", "supplier"),
    ("purchase_order_item", "po_id", "purchase_order"),
    ("purchase_order_item", "product_id", "product"),
    ("orders", "store_id", "dark_store"),
    ("orders", "customer_id", "customer"),
    ("order_item", "order_id", "orders"),
    ("order_item", "product_id", "product"),
    ("order_history", "order_id", "orders"),
    ("inventory_transaction", "store_id", "dark_store"),
    ("inventory_transaction", "product_id", "product"),
    ("inventory_transaction", "order_id", "orders"),
    ("inventory_transaction", "po_id", "purchase_order"),
)

# NOT NULL columns besides the primary keys.
NOT_NULL = {
    "category": ("name", "requires_cold_chain"),
    "supplier": ("name",),
    "product": ("category_id", "name", "sku", "is_active", "created_at"),
    "zone": ("name", "is_active", "created_at"),
    "dark_store": ("name", "is_active", "created_at"),
    "customer": ("zone_id", "first_name", "last_name", "created_at"),
    "store_inventory": ("store_id", "product_id", "quantity_on_hand", "reorder_point", "reorder_quantity",
                        "last_updated"),
    "purchase_order": ("store_id", "supplier_id", "status", "ordered_at"),
    "purchase_order_item": ("po_id", "product_id", "quantity_ordered", "quantity_received", "unit_price"),
    "orders": ("store_id", "customer_id", "status", "created_at"),
    "order_item": ("order_id", "product_id", "quantity", "unit_price"),
    "order_history": ("order_id", "status", "changed_at"),
    "inventory_transaction": ("store_id", "product_id", "transaction_type", "quantity_delta", "quantity_after",
                              "timestamp_occurred"),
}

# Allowed words of the status and type columns.
DOMAINS = (
    ("purchase_order", "status", ("pending", "received", "cancelled")),
    ("orders", "status", ("pending", "confirmed", "delivered", "cancelled")),
    ("inventory_transaction", "transaction_type", ("sale", "restock", "adjustment", "return")),
)

# Declared decimal widths as (table, column, precision, scale).
DECIMALS = (
    ("zone", "delivery_fee", 10, 2),
    ("purchase_order", "total_price", 14, 2),
    ("purchase_order_item", "unit_price", 10, 2),
    ("orders", "sub_total", 12, 2),
    ("orders", "delivery_fee", 8, 2),
    ("orders", "total_amount", 12, 2),
    ("order_item", "unit_price", 10, 2),
)

NOW = "now"

# Column defaults; NOW stands for the load time.
DEFAULTS = {
    "category": {"requires_cold_chain": False},
    "product": {"is_active": True, "created_at": NOW},
    "zone": {"is_active": True, "created_at": NOW},
    "dark_store": {"is_active": True, "created_at": NOW},
    "customer": {"created_at": NOW},
    "store_inventory": {"quantity_on_hand": 0, "reorder_point": 20, "reorder_quantity": 100, "last_updated": NOW},
    "purchase_order": {"status": "pending", "ordered_at": NOW},
    "purchase_order_item": {"quantity_received": 0},
    "orders": {"status": "pending", "created_at": NOW},
    "order_history": {"changed_at": NOW},
    "inventory_transaction": {"timestamp_occurred": NOW},
}

# The legal moves of an order.
ALLOWED_TRANSITIONS = (
    ("pending", "confirmed"),
    ("pending", "cancelled"),
    ("confirmed", "delivered"),
    ("confirmed", "cancelled"),
)


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(COLUMNS[table])
