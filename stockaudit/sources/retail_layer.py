"""The retail tables derived from the star-schema parquet files.

Each definition is SQL that both Spark and DuckDB parse: ``with_clause`` states it for DuckDB, ``RetailTables``
builds it in Spark and stores each fact table once per session in the shared folder, so queries scan
plain parquet with pushed filters and pruned columns. Violations are planted by fixed modulo rules.
"""

from __future__ import annotations

import re
import threading
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockaudit.operators.ordered import with_row_number, with_running_total
from stockaudit.schemas import schema_of
from stockaudit.session import new_folder

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

_ITEM_PRICE = "CAST(l_partkey % 90 + 5 + CAST(0.25 AS DECIMAL(10,2)) AS DECIMAL(10,2))"

# The test-data definitions. {name} is a source or an earlier table, <ntz> the zone-less
# timestamp type, <stores_x_part> every part once per region.
LAYER = {
    "zone": """
        SELECT n_nationkey AS zone_id, n_name AS name, CONCAT('CITY_', CAST(n_regionkey AS STRING)) AS city,
               CAST(15 + 5 * (n_nationkey % 6) AS DECIMAL(10,2)) AS delivery_fee,
               20 + 5 * (n_nationkey % 5) AS est_time_arrival
        FROM {nation}""",
    "dark_store": "SELECT r_regionkey AS store_id, r_name AS name FROM {region}",
    "category": """
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY p_type) AS INT) AS category_id, p_type AS name,
               p_type IN ('ECONOMY', 'LARGE', 'PROMO') AS requires_cold_chain
        FROM (SELECT DISTINCT p_type FROM {part}) t""",
    "product": """
        SELECT p_partkey AS product_id, c.category_id, p_name AS name,
               CONCAT('SKU-', CAST(CASE WHEN p_partkey % 500 = 499 THEN p_partkey - 1 ELSE p_partkey END AS STRING))
                 AS sku,
               p_size AS shelf_life_days
        FROM {part} JOIN {category} c ON c.name = p_type""",
    "supplier_r": "SELECT s_suppkey AS supplier_id, s_name AS name FROM {supplier}",
    "customer_r": """
        SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 311 = 310 THEN 999 ELSE c_nationkey END AS zone_id,
               c_name AS first_name
        FROM {customer}""",
    "line0": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
               ROW_NUMBER() OVER (PARTITION BY l_orderkey
                 ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS line_no
        FROM {lineitem}""",
    "order_item": f"""
        SELECT l_orderkey * 1000 + line_no AS order_item_id, l_orderkey AS order_id,
               CASE WHEN (l_orderkey * 7 + l_linenumber) % 3989 = 0 THEN l_partkey + 2000000000000 ELSE l_partkey END
                 AS product_id,
               CAST(l_quantity AS INT) AS quantity, {_ITEM_PRICE} AS unit_price,
               CAST(CAST(l_quantity AS INT) * {_ITEM_PRICE}
                 + CASE WHEN (l_orderkey * 7 + l_linenumber) % 4001 = 0 THEN CAST(0.05 AS DECIMAL(10,2))
                   ELSE CAST(0 AS DECIMAL(10,2)) END AS DECIMAL(21,2)) AS line_total
        FROM {{line0}}""",
    "orders_r": """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 1009 = 1008 THEN 99 ELSE CAST(o_custkey % 5 AS INT) END AS store_id,
               CASE WHEN o_orderkey % 1013 = 1012 THEN -1 ELSE o_custkey END AS customer_id,
               CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'confirmed'
                 WHEN o_orderkey % 2 = 0 THEN 'pending' ELSE 'cancelled' END AS status,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'card'
                 WHEN o_orderpriority = '3-MEDIUM' THEN 'cash' ELSE 'wallet' END AS payment_method,
               CAST(COALESCE(i.s, 0) + CASE WHEN o_orderkey % 997 = 0 THEN 1 ELSE 0 END AS DECIMAL(12,2))
                 AS sub_total,
               CAST(z.delivery_fee + CASE WHEN o_orderkey % 991 = 0 THEN 5 ELSE 0 END AS DECIMAL(8,2))
                 AS delivery_fee,
               CAST(COALESCE(i.s, 0) + CASE WHEN o_orderkey % 997 = 0 THEN 1 ELSE 0 END + z.delivery_fee
                 + CASE WHEN o_orderkey % 991 = 0 THEN 5 ELSE 0 END
                 + CASE WHEN o_orderkey % 983 = 0 THEN 2 ELSE 0 END AS DECIMAL(12,2)) AS total_amount,
               CAST(o_orderdate AS <ntz>) + INTERVAL '1' MINUTE * CAST(480 + o_orderkey % 840 AS INT) AS created_at
        FROM {orders}
        JOIN {customer} c ON c.c_custkey = o_custkey
        JOIN {zone} z ON z.zone_id = c.c_nationkey
        LEFT JOIN (SELECT order_id, SUM(line_total) AS s FROM {order_item} GROUP BY order_id) i
          ON i.order_id = o_orderkey""",
    "order_history": """
        SELECT order_id * 10 + step AS history_id, order_id, status, changed_at FROM (
          SELECT order_id, 'pending' AS status,
                 CASE WHEN order_id % 307 = 0 THEN created_at - INTERVAL '1' MINUTE * 5 ELSE created_at END
                   AS changed_at, 1 AS step
          FROM {orders_r} WHERE order_id % 499 <> 0
          UNION ALL
          SELECT order_id, 'confirmed', created_at + INTERVAL '1' MINUTE * CAST(2 + order_id % 14 AS INT), 2
          FROM {orders_r} WHERE order_id % 499 <> 0 AND order_id % 211 <> 0
            AND (status IN ('confirmed', 'delivered') OR (status = 'cancelled' AND order_id % 4 = 1))
          UNION ALL
          SELECT order_id, 'confirmed', created_at + INTERVAL '1' MINUTE * CAST(3 + order_id % 14 AS INT), 3
          FROM {orders_r} WHERE order_id % 499 <> 0 AND order_id % 173 = 0 AND status IN ('confirmed', 'delivered')
          UNION ALL
          SELECT order_id, status, created_at + INTERVAL '1' MINUTE * CAST(20 + order_id % 31 AS INT), 4
          FROM {orders_r} WHERE order_id % 499 <> 0 AND order_id % 223 <> 0 AND status IN ('delivered', 'cancelled')
        ) h""",
    "po": """
        SELECT CAST(r_regionkey AS BIGINT) AS po_id, r_regionkey AS store_id, 0 AS supplier_id,
               CASE WHEN r_regionkey = 4 THEN 'pending' ELSE 'received' END AS status,
               CAST('1994-12-25 00:00:00' AS <ntz>) AS ordered_at
        FROM {region}
        UNION ALL
        SELECT CAST(1000 + s_suppkey AS BIGINT), CAST(s_suppkey % 5 AS INT), CAST(s_suppkey AS INT),
               CASE WHEN s_suppkey % 3 = 0 OR s_suppkey % 5 = 4 THEN 'pending' ELSE 'received' END,
               CAST('1998-01-01 00:00:00' AS <ntz>) + INTERVAL '1' DAY * CAST(s_suppkey AS INT)
        FROM {supplier}""",
    # Every part is on the opening order of each store and on the orders of two suppliers, so the
    # line count grows linearly with the parts.
    "poi0": """
        SELECT CAST(r_regionkey AS BIGINT) AS po_id, p_partkey AS product_id, 500 AS quantity_ordered,
               CASE WHEN r_regionkey = 4 AND p_partkey % 100 <> 0 THEN 0 WHEN p_partkey % 1999 = 7 THEN 510
                 ELSE 500 END AS quantity_received
        FROM <stores_x_part>
        UNION ALL
        SELECT CAST(1000 + s_suppkey AS BIGINT), p_partkey, 100,
               CASE WHEN s_suppkey % 3 = 0 OR s_suppkey % 5 = 4 THEN 0 ELSE 100 END
        FROM (SELECT p_partkey, p_partkey % (SELECT COUNT(*) FROM {supplier}) AS k FROM {part}
              UNION ALL
              SELECT p_partkey, (p_partkey + (SELECT CAST(FLOOR(COUNT(*) / 2) AS BIGINT) FROM {supplier}))
                       % (SELECT COUNT(*) FROM {supplier})
              FROM {part}) p
        JOIN {supplier} ON s_suppkey = p.k""",
    "purchase_order_item": """
        SELECT CAST(po_id AS BIGINT) * 100000000 + product_id AS po_item_id, po_id, product_id, quantity_ordered,
               quantity_received,
               CAST(product_id % 60 + 4 + CAST(0.50 AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS unit_price
        FROM {poi0}""",
    "purchase_order": """
        SELECT po.po_id, po.store_id, po.supplier_id, po.status,
               CAST(t.s + CASE WHEN po.po_id % 37 = 1 THEN 1 ELSE 0 END AS DECIMAL(14,2)) AS total_price,
               po.ordered_at,
               CASE WHEN po.status = 'received' THEN po.ordered_at + INTERVAL '1' DAY * 2 END AS received_at
        FROM {po} po
        JOIN (SELECT po_id, SUM(quantity_ordered * unit_price) AS s FROM {purchase_order_item} GROUP BY po_id) t
          ON t.po_id = po.po_id""",
    "tx0": """
        SELECT store_id, product_id, transaction_type, order_id, po_id, quantity_delta, ts,
               rid * 4 + k - 1 AS transaction_id
        FROM (
          SELECT p.store_id, i.product_id, 'restock' AS transaction_type, CAST(NULL AS BIGINT) AS order_id,
                 CASE WHEN i.po_item_id % 701 = 0 THEN NULL ELSE p.po_id END AS po_id,
                 i.quantity_received AS quantity_delta, p.received_at AS ts, 1 AS k, i.po_item_id AS rid
          FROM {purchase_order_item} i JOIN {purchase_order} p ON p.po_id = i.po_id
          WHERE p.status = 'received' AND i.po_item_id % 2003 <> 0
          UNION ALL
          SELECT o.store_id, i.product_id, 'sale', CASE WHEN i.order_item_id % 3001 = 0 THEN NULL ELSE i.order_id END,
                 NULL, CASE WHEN i.order_item_id % 5003 = 0 THEN i.quantity ELSE -i.quantity END, m.changed_at, 2,
                 i.order_item_id
          FROM {order_item} i
          JOIN {orders_r} o ON o.order_id = i.order_id
          JOIN (SELECT order_id, MIN_BY(changed_at, history_id) AS changed_at FROM {order_history}
                WHERE status = 'confirmed' GROUP BY order_id) m ON m.order_id = i.order_id
          UNION ALL
          SELECT o.store_id, i.product_id, 'return', i.order_id, NULL, i.quantity, h.changed_at, 3, i.order_item_id
          FROM {order_item} i
          JOIN {orders_r} o ON o.order_id = i.order_id
          JOIN {order_history} h ON h.order_id = i.order_id AND h.status = 'cancelled'
          WHERE o.status = 'cancelled' AND o.order_id % 4 = 1 AND o.order_id % 41 <> 0
          UNION ALL
          SELECT o.store_id, i.product_id, 'adjustment',
                 CASE WHEN i.order_item_id % 59 = 58 AND i.order_item_id % 7 = 0 THEN i.order_id END, NULL,
                 CASE WHEN i.quantity % 5 = 0 THEN 3 ELSE -2 END, o.created_at + INTERVAL '1' DAY, 4, i.order_item_id
          FROM {order_item} i JOIN {orders_r} o ON o.order_id = i.order_id
          WHERE i.order_item_id % 59 = 58
        ) t""",
    "ledger0": """
        SELECT *, SUM(quantity_delta) OVER (PARTITION BY store_id, product_id ORDER BY ts, transaction_id
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance
        FROM {tx0}""",
    "inventory_transaction": """
        SELECT transaction_id, store_id, product_id, transaction_type, order_id, po_id, quantity_delta,
               CAST(balance + CASE WHEN transaction_id % 5009 = 0 THEN 1 ELSE 0 END AS INT) AS quantity_after,
               ts AS timestamp_occurred
        FROM {ledger0}""",
    "store_inventory": """
        SELECT CAST(r_regionkey AS BIGINT) * 1000000000000 + p_partkey AS inventory_id, r_regionkey AS store_id,
               CASE WHEN p_partkey % 1500 = 1499 THEN p_partkey + 1000000000000 ELSE p_partkey END AS product_id,
               CAST(COALESCE(t.s, 0) + CASE WHEN p_partkey % 401 = 0 THEN 1 ELSE 0 END AS INT) AS quantity_on_hand,
               CASE WHEN p_partkey % 701 = 700 THEN 0 ELSE 20 END AS reorder_point,
               CASE WHEN p_partkey % 703 = 702 THEN 20 ELSE 100 END AS reorder_quantity
        FROM <stores_x_part>
        LEFT JOIN (SELECT store_id, product_id, SUM(quantity_delta) AS s FROM {inventory_transaction}
                   GROUP BY store_id, product_id) t ON t.store_id = r_regionkey AND t.product_id = p_partkey
        WHERE NOT (r_regionkey = 2 AND p_partkey % 997 = 5)""",
}

# Table name -> its name in the layer (the driver already owns some names).
LAYER_NAME = {"customer": "customer_r", "supplier": "supplier_r", "orders": "orders_r"}

_DUCKDB = {"<ntz>": "TIMESTAMP", "<stores_x_part>": "region CROSS JOIN part"}
# In Spark the few stores travel as one array per part row; no join at all.
_SPARK = {
    "<ntz>": "TIMESTAMP_NTZ",
    "<stores_x_part>": "(SELECT p_partkey, r_regionkey FROM (SELECT p_partkey, (SELECT COLLECT_SET(r_regionkey) "
                       "FROM {region}) AS regions FROM {part}) q LATERAL VIEW EXPLODE(regions) e AS r_regionkey) sp",
}


def _dialect(text: str, words: dict[str, str]) -> str:
    for mark, word in words.items():
        text = text.replace(mark, word)
    return text


def with_clause(body: str) -> str:
    """``body`` preceded by the layer tables it names, directly or through others, as DuckDB CTEs."""
    needed, todo = set(), [body]
    while todo:
        text = todo.pop()
        for name in LAYER:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(LAYER[name])
    ctes = ",\n".join(
        f"{name} AS MATERIALIZED ({_dialect(text, _DUCKDB).format_map(_Identity())})"
        for name, text in LAYER.items() if name in needed
    )
    if not ctes:
        return body
    stripped = body.lstrip()
    if stripped.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{stripped[len('WITH RECURSIVE'):]}"
    if stripped.upper().startswith("WITH"):
        return f"WITH {ctes},\n{stripped[len('WITH'):]}"
    return f"WITH {ctes}\n{body}"


class _Identity(dict):
    def __missing__(self, key: str) -> str:
        return key


class RetailTables:
    """The 13 tables by attribute (``t.orders``, ``t.store_inventory``, …), built on first use."""

    _stored = {"product", "category", "order_item", "orders_r", "order_history", "purchase_order",
               "purchase_order_item", "inventory_transaction", "store_inventory", "tx0"}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, str(sf_dir).rstrip("/")
        self._folder: str | None = None
        self._built: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_"):
            raise AttributeError(table)
        return self._table(LAYER_NAME.get(table, table))

    def path_of(self, table: str) -> str:
        """The folder of a stored table."""
        getattr(self, table)
        return f"{self._folder}/{LAYER_NAME.get(table, table)}"

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(str(PurePosixPath(self.sf_dir) / f"{name}.parquet"))

    def _table(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._built:
                df = self._define(name)
                self._built[name] = self._store(name, df) if name in self._stored else df
            return self._built[name]

    def _define(self, name: str) -> DataFrame:
        if name == "line0":
            return with_row_number(
                self.source("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_suppkey",
                                               "l_extendedprice", "l_shipdate"),
                ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"], "line_no",
            )
        if name == "ledger0":
            return with_running_total(self._table("tx0"), ["store_id", "product_id"], ["ts", "transaction_id"],
                                      F.col("quantity_delta"), "balance")
        if name == "tx0":
            return self._movements()
        text = _dialect(LAYER[name], _SPARK)
        names = set(re.findall(r"\{(\w+)\}", text))
        return self.spark.sql(text, **{n: self.source(n) if n in SOURCES else self._table(n) for n in names})

    def _movements(self) -> DataFrame:
        """tx0: sales, returns and adjustments by one join of the items with their orders, which carry the history rows needed."""
        history = self._table("order_history").groupBy("order_id").agg(
            F.expr("min_by(changed_at, history_id) FILTER (WHERE status = 'confirmed')").alias("confirmed_at"),
            F.count_if(F.col("status") == "confirmed").alias("confirmed"),
            F.expr("collect_list(struct(changed_at)) FILTER (WHERE status = 'cancelled')").alias("cancelled"))
        orders = self._table("orders_r").select("order_id", "store_id", "status", "created_at").join(history, "order_id", "left").select(
            "order_id", "store_id", F.expr("""concat(
                CASE WHEN confirmed > 0 THEN array(struct('sale' AS kind, 2 AS k, confirmed_at AS ts)) ELSE array() END,
                CASE WHEN status = 'cancelled' AND order_id % 4 = 1 AND order_id % 41 <> 0 AND cancelled IS NOT NULL
                  THEN transform(cancelled, h -> struct('return' AS kind, 3 AS k, h.changed_at AS ts)) ELSE array() END,
                array(struct('adjustment' AS kind, 4 AS k, created_at + INTERVAL '1' DAY AS ts)))""").alias("events"))
        items = self._table("order_item").select("order_item_id", "order_id", "product_id", "quantity").join(orders, "order_id")
        items = items.select("*", F.inline("events")).where("k <> 4 OR order_item_id % 59 = 58")
        return self.spark.sql("""
            SELECT p.store_id, i.product_id, 'restock' AS transaction_type, CAST(NULL AS BIGINT) AS order_id,
                   CASE WHEN i.po_item_id % 701 = 0 THEN NULL ELSE p.po_id END AS po_id,
                   i.quantity_received AS quantity_delta, p.received_at AS ts, i.po_item_id * 4 AS transaction_id
            FROM {purchase_order_item} i JOIN {purchase_order} p ON p.po_id = i.po_id
            WHERE p.status = 'received' AND i.po_item_id % 2003 <> 0
            UNION ALL
            SELECT store_id, product_id, kind,
                   CASE k WHEN 2 THEN CASE WHEN order_item_id % 3001 = 0 THEN NULL ELSE order_id END
                     WHEN 3 THEN order_id WHEN 4 THEN CASE WHEN order_item_id % 7 = 0 THEN order_id END END, NULL,
                   CASE k WHEN 2 THEN CASE WHEN order_item_id % 5003 = 0 THEN quantity ELSE -quantity END WHEN 3 THEN quantity
                     WHEN 4 THEN CASE WHEN quantity % 5 = 0 THEN 3 ELSE -2 END END,
                   ts, order_item_id * 4 + k - 1
            FROM {items}""", items=items, purchase_order_item=self._table("purchase_order_item"),
            purchase_order=self._table("purchase_order"))

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        self._folder = self._folder or new_folder(self.spark, "retail-layer")
        path = f"{self._folder}/{name}"
        table = {v: k for k, v in LAYER_NAME.items()}.get(name, name)
        if table in ("tx0",):
            schema = df.schema
        else:
            declared = schema_of(table)
            schema = declared.__class__([f for f in declared.fields if f.name in df.columns])
            df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(schema).parquet(path)


_SESSIONS: dict[tuple[str, str], RetailTables] = {}


def retail_tables(spark: SparkSession, sf_dir: str) -> RetailTables:
    """The layer over ``sf_dir``, shared by all queries of one application."""
    key = (spark.sparkContext.applicationId, str(sf_dir))
    if key not in _SESSIONS:
        _SESSIONS[key] = RetailTables(spark, sf_dir)
    return _SESSIONS[key]
