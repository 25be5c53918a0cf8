"""DuckDB statements of the loading, repair, stock, order, constraint and stream queries."""

from __future__ import annotations

from stockaudit.functions.parameters import BASKET_MIX, HOURLY_INTENSITY, PAYMENT_MIX
from stockaudit.plans.planted import AS_OF, LOAD_TIME, TEST_BANDS
from stockaudit.schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLE_NAMES
from stockaudit.sources.retail_layer import LAYER_NAME

T = f"TIMESTAMP '{AS_OF}'"


def _layer(table: str) -> str:
    return LAYER_NAME.get(table, table)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


_BANDS = f"""(SELECT category, CAST(lo AS DECIMAL(10,2)) AS lo, CAST(hi AS DECIMAL(10,2)) AS hi
    FROM (VALUES {_values((n, lo, hi) for n, (lo, hi) in TEST_BANDS.items())}) b(category, lo, hi))"""
_PRODUCT_BAND = f"""(SELECT p.product_id, b.lo, b.hi FROM product p JOIN category c USING (category_id)
    JOIN {_BANDS} b ON b.category = c.name)"""
_LO, _HI = "COALESCE(b.lo, CAST(5 AS DECIMAL(10,2)))", "COALESCE(b.hi, CAST(50 AS DECIMAL(10,2)))"
_PURCHASE_PRICE = f"ROUND(CAST(({_LO} + {_HI}) * 0.35 AS DECIMAL(18,6)), 2)"
_OPENING_LINES = f"""(SELECT si.store_id, (SELECT MIN(supplier_id) FROM supplier_r) AS supplier_id, si.product_id,
      quantity_on_hand AS quantity_ordered, quantity_on_hand AS quantity_received,
      CAST({_PURCHASE_PRICE} AS DECIMAL(10,2)) AS unit_price
    FROM (SELECT store_id, product_id, quantity_on_hand FROM store_inventory
          UNION ALL SELECT store_id + 1000, product_id, quantity_on_hand FROM store_inventory) si
    LEFT JOIN {_PRODUCT_BAND} b USING (product_id)
    WHERE si.store_id IN (SELECT store_id FROM dark_store UNION ALL SELECT store_id + 1000 FROM dark_store)
      AND si.store_id NOT IN (SELECT store_id FROM purchase_order))"""
_CONTACTS = """(SELECT *, CONCAT(CASE WHEN customer_id % 97 = 5 THEN '013' ELSE
      CASE customer_id % 4 WHEN 0 THEN '010' WHEN 1 THEN '011' WHEN 2 THEN '012' ELSE '015' END END,
      CASE WHEN customer_id % 89 = 3 THEN '' ELSE ' ' END, CAST(10000000 + (customer_id % 700) * 7919 AS VARCHAR))
      AS phone_number,
    TIMESTAMP '2024-10-01 00:00:00' + INTERVAL 1 DAY * CAST(customer_id % 91 AS INT) AS registered_time
    FROM customer_r)"""
_PREV = """(SELECT *, LAG(status) OVER (PARTITION BY order_id ORDER BY changed_at, history_id) AS prev_status
    FROM {h})"""
_ILLEGAL = """(prev_status IS NOT NULL AND COALESCE(prev_status || '>' || status, '') NOT IN
    ('pending>confirmed', 'pending>cancelled', 'confirmed>delivered', 'confirmed>cancelled'))"""
_EVENTS = f"""(SELECT created_at AS ts, 'ORDER_CREATED' AS event, order_id AS entity_id,
      'customer=' || customer_id || ' store=' || store_id AS detail FROM orders_r
    UNION ALL SELECT changed_at, 'ORDER_' || UPPER(status), order_id, '' FROM order_history WHERE status <> 'pending'
    UNION ALL SELECT registered_time, 'CUSTOMER_REGISTERED', customer_id, 'zone=' || zone_id FROM {_CONTACTS}
    UNION ALL SELECT timestamp_occurred, 'STOCK_ADJUSTED', transaction_id, 'delta=' || quantity_delta || ' reason=' ||
      CASE WHEN quantity_delta < 0 THEN 'shrinkage' ELSE 'found_extra' END
      FROM inventory_transaction WHERE transaction_type = 'adjustment'
    UNION ALL SELECT ordered_at, 'PO_CREATED', po_id, 'store=' || store_id FROM purchase_order
    UNION ALL SELECT received_at, 'PO_RECEIVED', po_id, 'store=' || store_id FROM purchase_order
      WHERE received_at IS NOT NULL)"""
_HOURS = f"(VALUES {_values(enumerate(HOURLY_INTENSITY))}) t(hour, intensity)"


def _repair_latest(history: str) -> str:
    """The repaired history as a row-by-row restatement with per-order subqueries."""
    return f"""
      SELECT h.history_id, h.order_id, h.status,
             CASE WHEN v.wanted = h.status THEN v.after + INTERVAL 1 SECOND ELSE h.changed_at END AS changed_at
      FROM {history} h LEFT JOIN viol v USING (order_id)
      WHERE v.order_id IS NULL OR h.status IS DISTINCT FROM v.wanted OR h.history_id = v.kept
      UNION ALL
      SELECT (SELECT MAX(history_id) FROM {history}) + ROW_NUMBER() OVER (ORDER BY order_id), order_id, wanted,
             after + INTERVAL 1 SECOND
      FROM viol WHERE kept IS NULL"""


_VIOLATORS = """viol AS MATERIALIZED (
      SELECT o.order_id, o.status AS wanted,
             (SELECT history_id FROM order_history x WHERE x.order_id = o.order_id AND x.status = o.status
              ORDER BY changed_at DESC, history_id DESC LIMIT 1) AS kept,
             (SELECT MAX(changed_at) FROM order_history x WHERE x.order_id = o.order_id AND x.status IS DISTINCT FROM o.status) AS after
      FROM orders_r o JOIN (SELECT order_id, status, ROW_NUMBER() OVER (PARTITION BY order_id
                              ORDER BY changed_at DESC, history_id DESC) AS rn FROM order_history) l
        ON l.order_id = o.order_id AND l.rn = 1
      WHERE l.status <> o.status)"""

RULE_SQL = {
    "table_row_counts": "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows FROM {_layer(n)}" for n in TABLE_NAMES),
    "apply_column_defaults": f"""
        SELECT inventory_id, CASE WHEN product_id % 10 = 0 THEN 0 ELSE quantity_on_hand END AS quantity_on_hand,
               CASE WHEN product_id % 7 = 0 THEN 20 ELSE reorder_point END AS reorder_point, 100 AS reorder_quantity,
               TIMESTAMP '{LOAD_TIME}' AS last_updated
        FROM store_inventory""",
    "order_line_totals": """
        SELECT order_item_id, order_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
               CAST(quantity * unit_price AS DOUBLE) AS line_total FROM order_item""",
    "assign_surrogate_keys": """
        SELECT (SELECT MAX(order_id) FROM orders_r) + ROW_NUMBER() OVER (ORDER BY created_at, order_id) AS new_id,
               created_at, order_id FROM orders_r""",
    "insert_if_absent": """
        SELECT store_id, product_id, 'existing' AS origin FROM store_inventory
        UNION ALL
        SELECT store_id, product_id, 'inserted' FROM (
          SELECT store_id, product_id FROM inventory_transaction
          EXCEPT SELECT store_id, product_id FROM store_inventory) n""",
    "upsert_products": """
        WITH src AS (
          SELECT CASE WHEN product_id % 11 = 0 THEN sku || '-N' ELSE sku END AS sku,
                 CASE WHEN product_id % 7 = 0 THEN p.name || ' v2' ELSE p.name END AS name,
                 shelf_life_days + 1 AS shelf_life_days, c.category_id,
                 ROW_NUMBER() OVER (PARTITION BY CASE WHEN product_id % 11 = 0 THEN sku || '-N' ELSE sku END
                                    ORDER BY product_id DESC) AS rn
          FROM product p JOIN category c USING (category_id) WHERE product_id % 13 <> 0),
        last AS (SELECT * FROM src WHERE rn = 1)
        SELECT p.product_id, p.category_id, p.sku,
               COALESCE(CASE WHEN l.name <> p.name THEN l.name END, p.name) AS name,
               CASE WHEN l.name <> p.name THEN l.shelf_life_days ELSE p.shelf_life_days END AS shelf_life_days,
               CASE WHEN l.name <> p.name THEN 'updated' ELSE 'unchanged' END AS action
        FROM product p LEFT JOIN last l USING (sku)
        UNION ALL
        SELECT (SELECT MAX(product_id) FROM product) + ROW_NUMBER() OVER (ORDER BY sku), category_id, sku, name,
               shelf_life_days, 'inserted'
        FROM last l WHERE NOT EXISTS (SELECT 1 FROM product p WHERE p.sku = l.sku)""",
    "dedupe_customers": f"""
        WITH people AS (SELECT customer_id, phone_number FROM {_CONTACTS} c)
        SELECT customer_id, phone_number, 'existing' AS origin FROM people WHERE customer_id % 3 = 0
        UNION ALL
        SELECT MIN(customer_id), phone_number, 'inserted' FROM people n
        WHERE customer_id % 3 <> 0 AND phone_number NOT IN (SELECT phone_number FROM people WHERE customer_id % 3 = 0)
        GROUP BY phone_number""",
    "build_assortment": """
        SELECT store_id, product_id, 150 AS quantity_on_hand, 20 AS reorder_point, 100 AS reorder_quantity
        FROM dark_store CROSS JOIN product
        WHERE (store_id, product_id) NOT IN (SELECT (store_id, product_id) FROM store_inventory)""",
    "initial_purchase_orders": f"""
        SELECT store_id, supplier_id, product_id, quantity_ordered, quantity_received, CAST(unit_price AS DOUBLE) AS unit_price
        FROM {_OPENING_LINES} l""",
    "initial_purchase_order_headers": f"""
        SELECT store_id, supplier_id, 'received' AS status, CAST(SUM(quantity_ordered * unit_price) AS DOUBLE) AS total_price,
               TIMESTAMP '{LOAD_TIME}' AS ordered_at, TIMESTAMP '{LOAD_TIME}' AS received_at
        FROM {_OPENING_LINES} l GROUP BY store_id, supplier_id""",
    "initial_restocks": f"""
        SELECT store_id, product_id, 'restock' AS transaction_type, quantity_received AS quantity_delta,
               quantity_received AS quantity_after, TIMESTAMP '{LOAD_TIME}' AS timestamp_occurred
        FROM {_OPENING_LINES} l""",
    "supplier_contact_email": """
        SELECT supplier_id, name,
               'info@' || LEFT(REPLACE(REPLACE(LOWER(name), ' ', ''), '.', ''), 20) || '.com.eg' AS email
        FROM supplier_r""",
    "mask_secret_column": """SELECT supplier_id, 'UID=app;PWD=***;DATABASE=' || name AS masked FROM supplier_r""",
    "repair_latest_status": f"WITH {_VIOLATORS} {_repair_latest('order_history')}",
    "repair_invalid_transitions": f"""
        SELECT history_id, order_id, status, changed_at FROM {_PREV.format(h='order_history')} h WHERE NOT {_ILLEGAL}""",
    "repair_repeated_status": f"""
        SELECT history_id, order_id, status, changed_at FROM {_PREV.format(h='order_history')} h
        WHERE NOT COALESCE(prev_status = status, FALSE)""",
    "repair_history_pipeline": f"""
        WITH {_VIOLATORS},
        r1 AS MATERIALIZED ({_repair_latest('order_history')}),
        p1 AS MATERIALIZED (SELECT * FROM {_PREV.format(h='r1')} x),
        r2 AS MATERIALIZED (SELECT history_id, order_id, status, changed_at FROM p1 WHERE NOT {_ILLEGAL}),
        p2 AS MATERIALIZED (SELECT * FROM {_PREV.format(h='r2')} x)
        SELECT 1 AS step, 'D1' AS check_id, (SELECT COUNT(*) FROM viol) AS violations_before,
               (SELECT COUNT(*) FROM order_history h FULL JOIN r1 r USING (history_id)
                WHERE h.changed_at IS DISTINCT FROM r.changed_at) AS rows_changed
        UNION ALL
        SELECT 2, 'D2', n, n FROM (SELECT COUNT(*) AS n FROM p1 WHERE {_ILLEGAL}) a
        UNION ALL
        SELECT 3, 'D3', n, n FROM (SELECT COUNT(*) AS n FROM p2 WHERE prev_status = status) b""",
    "repaired_history": f"""
        WITH {_VIOLATORS},
        r1 AS MATERIALIZED ({_repair_latest('order_history')}),
        r2 AS MATERIALIZED (SELECT history_id, order_id, status, changed_at FROM {_PREV.format(h='r1')} x WHERE NOT {_ILLEGAL})
        SELECT history_id, order_id, status, changed_at FROM {_PREV.format(h='r2')} y
        WHERE NOT COALESCE(prev_status = status, FALSE)""",
    "stock_on_hand": """SELECT store_id, product_id, CAST(SUM(quantity_delta) AS BIGINT) AS stock
        FROM inventory_transaction GROUP BY ALL""",
    "running_stock_ledger": """
        SELECT transaction_id, store_id, product_id, CAST(SUM(quantity_delta) OVER (PARTITION BY store_id, product_id
                 ORDER BY timestamp_occurred, transaction_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS quantity_after
        FROM inventory_transaction""",
    "clamped_adjustments": """
        WITH RECURSIVE moves AS MATERIALIZED (
          SELECT transaction_id, store_id, product_id, quantity_delta, ROW_NUMBER() OVER (
                   PARTITION BY store_id, product_id ORDER BY timestamp_occurred, transaction_id) AS rn
          FROM inventory_transaction WHERE transaction_type = 'adjustment'),
        fold AS (
          SELECT m.*, COALESCE(s.quantity_on_hand, 0) AS before,
                 GREATEST(0, COALESCE(s.quantity_on_hand, 0) + quantity_delta) AS after
          FROM moves m LEFT JOIN store_inventory s USING (store_id, product_id) WHERE rn = 1
          UNION ALL
          SELECT m.*, f.after, GREATEST(0, f.after + m.quantity_delta)
          FROM fold f JOIN moves m ON m.store_id = f.store_id AND m.product_id = f.product_id AND m.rn = f.rn + 1)
        SELECT transaction_id, store_id, product_id, CAST(after - before AS BIGINT) AS effective_delta,
               CAST(after AS BIGINT) AS quantity_after
        FROM fold WHERE after <> before""",
    "reserve_stock": """
        WITH RECURSIVE served AS MATERIALIZED (
          SELECT order_id, store_id, ROW_NUMBER() OVER (PARTITION BY store_id ORDER BY created_at, order_id) AS rn
          FROM orders_r WHERE status = 'pending'),
        wanted AS MATERIALIZED (
          SELECT order_id, store_id, product_id, SUM(quantity) AS q FROM order_item JOIN served USING (order_id) GROUP BY ALL),
        baskets AS MATERIALIZED (
          SELECT s.*, COALESCE(b.items, []) AS items FROM served s
          LEFT JOIN (SELECT order_id, LIST({'p': product_id, 'q': q}) AS items FROM wanted GROUP BY order_id) b
            USING (order_id)),
        shelves AS MATERIALIZED (
          SELECT store_id, MAP(LIST(product_id), LIST(stock)) AS stock FROM (
            SELECT DISTINCT w.store_id, w.product_id, CAST(COALESCE(quantity_on_hand, 0) AS HUGEINT) AS stock
            FROM wanted w LEFT JOIN store_inventory USING (store_id, product_id)) x GROUP BY store_id),
        walk AS (
          SELECT store_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS order_id, TRUE AS ok, stock FROM shelves
          UNION ALL
          SELECT store_id, rn, order_id, ok, CASE WHEN ok AND LEN(items) > 0 THEN
                   MAP_FROM_ENTRIES(LIST_TRANSFORM(MAP_ENTRIES(stock), lambda e: {'k': e.key, 'v': e.value -
                     COALESCE(LIST_SUM(LIST_TRANSFORM(LIST_FILTER(items, lambda i: i.p = e.key), lambda i: i.q)), 0)}))
                 ELSE stock END
          FROM (SELECT b.store_id, b.rn, b.order_id, b.items, w.stock,
                       LEN(LIST_FILTER(b.items, lambda i: w.stock[i.p] < i.q)) = 0 AS ok
                FROM walk w JOIN baskets b ON b.store_id = w.store_id AND b.rn = w.rn + 1) step)
        SELECT order_id, store_id, CASE WHEN ok THEN 'ok' ELSE 'insufficient_stock' END AS result
        FROM walk WHERE rn > 0
        UNION ALL
        SELECT order_id, store_id, 'ok' FROM served WHERE store_id NOT IN (SELECT store_id FROM shelves)""",
    "stock_reversals": """
        SELECT i.order_id, i.order_item_id, i.product_id, o.store_id, i.quantity AS quantity_delta,
               (SELECT MAX(changed_at) FROM order_history h WHERE h.order_id = o.order_id AND h.status = 'cancelled') AS ts
        FROM order_item i JOIN orders_r o USING (order_id)
        WHERE o.status = 'cancelled' AND o.order_id IN (SELECT order_id FROM order_history WHERE status = 'confirmed')""",
    "cancellation_ledger": """
        SELECT order_id, order_item_id, r.store_id, product_id, 'return' AS transaction_type, quantity_delta,
               CAST(COALESCE((SELECT SUM(quantity_on_hand) FROM store_inventory s
                              WHERE s.store_id = r.store_id AND s.product_id = r.product_id), 0)
                 + SUM(quantity_delta) OVER (PARTITION BY r.store_id, product_id ORDER BY ts NULLS FIRST, order_id, order_item_id
                                             ROWS UNBOUNDED PRECEDING) AS BIGINT) AS quantity_after, ts
        FROM (
          SELECT i.order_id, i.order_item_id, i.product_id, o.store_id, i.quantity AS quantity_delta,
                 (SELECT MAX(changed_at) FROM order_history h WHERE h.order_id = o.order_id AND h.status = 'cancelled') AS ts
          FROM order_item i JOIN orders_r o USING (order_id)
          WHERE o.status = 'cancelled' AND o.order_id IN (SELECT order_id FROM order_history WHERE status = 'confirmed')) r""",
    "received_items": """
        SELECT po_item_id, po_id, product_id, quantity_ordered,
               CASE WHEN p.status = 'pending' THEN quantity_ordered ELSE quantity_received END AS quantity_received,
               CAST(unit_price AS DOUBLE) AS unit_price
        FROM purchase_order_item LEFT JOIN purchase_order p USING (po_id)""",
    "received_orders": f"""
        SELECT po_id, store_id, supplier_id, CASE WHEN status = 'pending' THEN 'received' ELSE status END AS status,
               CAST(total_price AS DOUBLE) AS total_price, ordered_at,
               CASE WHEN status = 'pending' THEN TIMESTAMP '{LOAD_TIME}' ELSE received_at END AS received_at
        FROM purchase_order""",
    "received_inventory": """
        SELECT store_id, product_id, CAST(SUM(q) AS BIGINT) AS stock FROM (
          SELECT store_id, product_id, quantity_on_hand AS q FROM store_inventory
          UNION ALL
          SELECT store_id, product_id, quantity_ordered FROM purchase_order_item JOIN purchase_order USING (po_id)
          WHERE status = 'pending') x
        GROUP BY ALL""",
    "cap_order_quantity": """
        SELECT i.order_item_id, i.order_id, i.product_id, o.store_id, LEAST(i.quantity, s.quantity_on_hand) AS quantity
        FROM order_item i JOIN orders_r o USING (order_id)
        JOIN store_inventory s ON s.store_id = o.store_id AND s.product_id = i.product_id WHERE s.quantity_on_hand > 0""",
    "low_stock": """SELECT store_id, product_id, quantity_on_hand, reorder_point, reorder_quantity
        FROM store_inventory WHERE quantity_on_hand < reorder_point""",
    "propose_purchase_orders": f"""
        SELECT store_id, (SELECT MIN(supplier_id) FROM supplier_r) AS supplier_id, product_id, quantity_ordered,
               CAST(unit_price AS DOUBLE) AS unit_price,
               CAST(SUM(quantity_ordered * unit_price) OVER (PARTITION BY store_id) AS DOUBLE) AS total_price
        FROM (SELECT store_id, si.product_id, reorder_quantity AS quantity_ordered,
                     CAST({_PURCHASE_PRICE} AS DECIMAL(10,2)) AS unit_price
              FROM store_inventory si LEFT JOIN {_PRODUCT_BAND} b USING (product_id)
              WHERE quantity_on_hand < reorder_point) l""",
    "receive_purchase_orders": """
        SELECT po_id, po_item_id, p.store_id, i.product_id, quantity_ordered AS quantity_delta,
               CAST(COALESCE(s.quantity_on_hand, 0) + SUM(quantity_ordered) OVER (PARTITION BY p.store_id, i.product_id
                 ORDER BY ordered_at, po_id, po_item_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS quantity_after
        FROM purchase_order_item i JOIN purchase_order p USING (po_id)
        LEFT JOIN store_inventory s ON s.store_id = p.store_id AND s.product_id = i.product_id
        WHERE p.status = 'pending'""",
    "adjustment_shrinkage": """
        SELECT store_id, CASE WHEN quantity_delta < 0 THEN 'shrinkage' ELSE 'found_extra' END AS kind,
               COUNT(*) AS n_rows, CAST(SUM(ABS(quantity_delta)) AS BIGINT) AS units
        FROM inventory_transaction WHERE transaction_type = 'adjustment' GROUP BY ALL""",
    "cold_chain_items": """
        SELECT order_id, COUNT(*) AS n_items, COUNT(*) FILTER (cold) AS n_cold, BOOL_OR(COALESCE(cold, FALSE)) AS has_cold
        FROM order_item LEFT JOIN (SELECT product_id, requires_cold_chain AS cold FROM product JOIN category
                                   USING (category_id)) p USING (product_id)
        GROUP BY order_id""",
    "price_band_violations": f"""
        SELECT order_item_id, CAST(unit_price AS DOUBLE) AS unit_price, CAST({_LO} AS DOUBLE) AS lo,
               CAST({_HI} AS DOUBLE) AS hi
        FROM order_item LEFT JOIN {_PRODUCT_BAND} b USING (product_id)
        WHERE unit_price < {_LO} OR unit_price > {_HI}""",
    "cold_chain_companions": """
        WITH cold AS (SELECT product_id FROM product JOIN category USING (category_id) WHERE requires_cold_chain),
        basket AS MATERIALIZED (SELECT DISTINCT order_id, store_id, product_id FROM order_item
                   JOIN cold USING (product_id) JOIN orders_r USING (order_id)),
        shelf AS MATERIALIZED (SELECT store_id, product_id FROM store_inventory JOIN cold USING (product_id)
                  WHERE quantity_on_hand > 0),
        pairs AS MATERIALIZED (
          SELECT b.order_id, s.product_id FROM (SELECT DISTINCT order_id, store_id FROM basket) b
          JOIN shelf s USING (store_id)
          ANTI JOIN basket x ON x.order_id = b.order_id AND x.product_id = s.product_id)
        SELECT order_id, COUNT(p.product_id) AS n_candidates, MIN(p.product_id) AS first_candidate
        FROM (SELECT DISTINCT order_id FROM basket) o LEFT JOIN pairs p USING (order_id) GROUP BY order_id""",
    "price_orders": """
        SELECT o.order_id, CAST(COALESCE(s, 0) AS DOUBLE) AS sub_total,
               CAST(COALESCE(z.delivery_fee, 20) AS DOUBLE) AS delivery_fee,
               CAST(COALESCE(s, 0) + COALESCE(z.delivery_fee, 20) AS DOUBLE) AS total_amount
        FROM orders_r o
        LEFT JOIN (SELECT order_id, SUM(quantity * unit_price) AS s FROM order_item GROUP BY order_id) i USING (order_id)
        LEFT JOIN customer_r c USING (customer_id) LEFT JOIN zone z USING (zone_id)""",
    "business_event_feed": f"SELECT ts, event, entity_id, detail FROM {_EVENTS} e",
    "fulfilment_minutes": """
        SELECT store_id, COUNT(*) AS n, MIN(m) AS min_minutes, MAX(m) AS max_minutes, ROUND(AVG(m), 4) AS avg_minutes
        FROM (SELECT store_id, CAST(FLOOR(EPOCH(done_at - created_at) / 60) AS BIGINT) AS m FROM orders_r
              JOIN (SELECT order_id, MAX(changed_at) AS done_at FROM order_history WHERE status = 'delivered'
                    GROUP BY order_id) h USING (order_id)) x
        GROUP BY store_id""",
    "fulfilment_minutes_by_order": """
        SELECT order_id, store_id, CAST(FLOOR(EPOCH(done_at - created_at) / 60) AS BIGINT) AS minutes FROM orders_r
        JOIN (SELECT order_id, MAX(changed_at) AS done_at FROM order_history WHERE status = 'delivered'
              GROUP BY order_id) h USING (order_id)""",
    "order_status_kpis": """
        WITH stores AS (SELECT store_id FROM orders_r UNION SELECT store_id FROM purchase_order
                        UNION SELECT store_id FROM inventory_transaction),
        per AS (
          SELECT s.store_id,
            (SELECT COUNT(*) FROM orders_r o WHERE o.store_id = s.store_id) AS orders_created,
            (SELECT COUNT(*) FROM orders_r o WHERE o.store_id = s.store_id AND status = 'delivered') AS orders_delivered,
            (SELECT COUNT(*) FROM orders_r o WHERE o.store_id = s.store_id AND status = 'cancelled') AS orders_cancelled,
            (SELECT COUNT(*) FROM purchase_order p WHERE p.store_id = s.store_id) AS po_created,
            (SELECT COUNT(*) FROM purchase_order p WHERE p.store_id = s.store_id AND status = 'received') AS po_received,
            (SELECT COUNT(*) FROM inventory_transaction x WHERE x.store_id = s.store_id
             AND transaction_type = 'adjustment') AS adjustments,
            (SELECT COUNT(*) FROM inventory_transaction x WHERE x.store_id = s.store_id) AS ledger_rows
          FROM stores s),
        every_scope AS (
          SELECT 'store' AS scope, *, CAST(NULL AS BIGINT) AS customers FROM per
          UNION ALL
          SELECT 'overall', NULL, CAST(SUM(orders_created) AS BIGINT), CAST(SUM(orders_delivered) AS BIGINT),
            CAST(SUM(orders_cancelled) AS BIGINT), CAST(SUM(po_created) AS BIGINT), CAST(SUM(po_received) AS BIGINT),
            CAST(SUM(adjustments) AS BIGINT), CAST(SUM(ledger_rows) AS BIGINT), (SELECT COUNT(*) FROM customer_r)
          FROM per)
        SELECT *, ROUND(orders_delivered * 100 / GREATEST(orders_created, 1), 1) AS delivered_pct,
               ROUND(orders_cancelled * 100 / GREATEST(orders_created, 1), 1) AS cancelled_pct FROM every_scope""",
    "hourly_order_summary": """
        SELECT hour, created, delivered, cancelled, CAST(SUM(created) OVER w AS BIGINT) AS cum_created,
               CAST(SUM(delivered) OVER w AS BIGINT) AS cum_delivered, CAST(SUM(cancelled) OVER w AS BIGINT) AS cum_cancelled
        FROM (SELECT DATE_TRUNC('hour', changed_at) AS hour, COUNT(*) FILTER (status = 'pending') AS created,
                     COUNT(*) FILTER (status = 'delivered') AS delivered, COUNT(*) FILTER (status = 'cancelled') AS cancelled
              FROM order_history GROUP BY ALL) h
        WINDOW w AS (ORDER BY hour ROWS UNBOUNDED PRECEDING)""",
    "transition_rates": f"""
        SELECT from_status, to_status, n, ROUND(n / total, 4) AS rate,
               CASE from_status || to_status WHEN 'pendingconfirmed' THEN CAST(0.85 AS DOUBLE)
                 WHEN 'confirmeddelivered' THEN CAST(0.95 AS DOUBLE) END AS configured
        FROM (SELECT prev_status AS from_status, status AS to_status, COUNT(*) AS n
              FROM {_PREV.format(h='order_history')} h WHERE prev_status IS NOT NULL GROUP BY ALL) p
        JOIN (SELECT status AS from_status, COUNT(*) AS total FROM order_history GROUP BY ALL) t USING (from_status)""",
    "cancel_reason": """
        SELECT CASE WHEN order_id IN (SELECT order_id FROM order_history WHERE status = 'confirmed')
               THEN 'after_confirmation' ELSE 'before_confirmation' END AS reason, COUNT(*) AS n
        FROM orders_r WHERE status = 'cancelled' GROUP BY ALL""",
    "payment_method_mix": f"""
        SELECT payment_method, COUNT(*) AS n, ROUND(COUNT(*) / (SELECT COUNT(*) FROM orders_r), 4) AS share,
               ANY_VALUE(CAST(p AS DOUBLE)) AS expected
        FROM orders_r LEFT JOIN (VALUES {_values(PAYMENT_MIX.items())}) e(payment_method, p) USING (payment_method)
        GROUP BY payment_method""",
    "basket_size_mix": f"""
        SELECT n_items, COUNT(*) AS n, ROUND(COUNT(*) / (SELECT COUNT(DISTINCT order_id) FROM order_item), 4) AS share,
               ANY_VALUE(CAST(p AS DOUBLE)) AS expected
        FROM (SELECT order_id, CAST(COUNT(*) AS INT) AS n_items FROM order_item GROUP BY order_id) b
        LEFT JOIN (VALUES {_values(BASKET_MIX.items())}) e(n_items, p) USING (n_items) GROUP BY n_items""",
    "hourly_traffic_profile": f"""
        SELECT t.hour, COALESCE(n, 0) AS n, ROUND(COALESCE(n, 0) / total, 4) AS observed_share,
               ROUND(intensity / whole, 4) AS expected_share,
               ROUND((COALESCE(n, 0) / total) / (intensity / whole), 4) AS ratio
        FROM (SELECT CAST(hour AS INT) AS hour, CAST(intensity AS DOUBLE) AS intensity,
                     (SELECT CAST(SUM(intensity) AS DOUBLE) FROM {_HOURS}) AS whole,
                     (SELECT COUNT(*) FROM events) AS total FROM {_HOURS}) t
        LEFT JOIN (SELECT CAST(HOUR(ts) AS INT) AS hour, COUNT(*) AS n FROM events GROUP BY ALL) o USING (hour)""",
    "expected_event_mix": f"""
        WITH kinds(event, low, high) AS (VALUES ('order_create', 0.0, 0.6), ('advance_order', 0.6, 0.8),
               ('customer_registration', 0.8, 0.9), ('stock_adjust', 0.9, 0.95), ('restock_check', 0.95, 1.0)),
        expected AS (
          SELECT CAST(hour AS INT) AS hour, event, CAST(ROUND(LEAST(high * intensity, 0.95)
                   - LEAST(low * intensity, 0.95), 4) AS DOUBLE) AS probability
          FROM {_HOURS} CROSS JOIN kinds
          UNION ALL SELECT CAST(hour AS INT), 'idle', CAST(ROUND(1 - LEAST(intensity, 0.95), 4) AS DOUBLE) FROM {_HOURS}),
        seen AS (
          SELECT CAST(HOUR(ts) AS INT) AS hour, CASE event WHEN 'ORDER_CREATED' THEN 'order_create'
                   WHEN 'CUSTOMER_REGISTERED' THEN 'customer_registration' WHEN 'STOCK_ADJUSTED' THEN 'stock_adjust'
                   WHEN 'PO_CREATED' THEN 'restock_check' WHEN 'PO_RECEIVED' THEN 'restock_check'
                   ELSE 'advance_order' END AS event, COUNT(*) AS observed
          FROM {_EVENTS} e GROUP BY ALL)
        SELECT hour, event, probability, COALESCE(observed, 0) AS observed,
               ROUND(COALESCE(observed, 0) / SUM(observed) OVER (PARTITION BY hour), 4) AS observed_share
        FROM expected LEFT JOIN seen USING (hour, event)""",
    "off_hours_activity": """SELECT history_id, changed_at FROM order_history
        WHERE HOUR(changed_at) < 8 OR HOUR(changed_at) > 21""",
    "next_workday_start": """SELECT order_id, DATE_TRUNC('day', created_at) + INTERVAL 32 HOUR AS next_start FROM orders_r""",
    "open_orders_as_of": f"""
        SELECT order_id, status, changed_at FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY changed_at DESC, history_id DESC) AS rn
          FROM order_history WHERE changed_at <= {T}) h
        WHERE rn = 1 AND status IN ('pending', 'confirmed')""",
    "open_at_day_end": """
        WITH ends AS (SELECT order_id, CASE WHEN created_at <= DATE_TRUNC('day', created_at) + INTERVAL 22 HOUR
                        THEN DATE_TRUNC('day', created_at) + INTERVAL 22 HOUR
                        ELSE DATE_TRUNC('day', created_at) + INTERVAL 46 HOUR END AS day_end FROM orders_r),
        last AS (SELECT h.*, day_end, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY changed_at DESC, history_id DESC)
                   AS rn FROM order_history h JOIN ends USING (order_id) WHERE changed_at <= day_end)
        SELECT CAST(day_end AS DATE) AS day, order_id, status, CASE WHEN status = 'confirmed' THEN 'deliver'
                 WHEN order_id % 20 < 17 THEN 'confirm_then_deliver' ELSE 'cancel' END AS closing
        FROM last WHERE rn = 1 AND status IN ('pending', 'confirmed')""",
    "order_snapshot_json": """
        SELECT order_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS price
        FROM orders_r o LEFT JOIN order_item USING (order_id) WHERE o.status IN ('pending', 'confirmed')""",
    "discard_stale_state": f"""
        SELECT order_id, status, changed_at FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY changed_at DESC, history_id DESC) AS rn
          FROM order_history WHERE changed_at <= {T}) h
        WHERE rn = 1 AND EPOCH({T} - changed_at) / 3600 < 48""",
    "customer_registrations": f"""
        SELECT zone_id, CAST(registered_time AS DATE) AS day, COUNT(*) AS n FROM {_CONTACTS} c
        WHERE zone_id IN (SELECT zone_id FROM zone) GROUP BY ALL""",
    "phone_format_violations": f"""
        SELECT customer_id, phone_number AS phone FROM {_CONTACTS} c
        WHERE NOT REGEXP_FULL_MATCH(phone_number, '01[0125] [1-9][0-9]{{7}}')""",
    "dimension_enriched_orders": """
        SELECT order_item_id, order_id, o.status, o.created_at, d.name AS store_name, c.first_name AS customer_name,
               z.name AS zone_name, CAST(z.delivery_fee AS DOUBLE) AS delivery_fee, p.name AS product_name,
               g.name AS category_name, g.requires_cold_chain, quantity, CAST(line_total AS DOUBLE) AS line_total
        FROM order_item JOIN orders_r o USING (order_id)
        LEFT JOIN customer_r c USING (customer_id) LEFT JOIN zone z ON z.zone_id = c.zone_id
        LEFT JOIN dark_store d ON d.store_id = o.store_id LEFT JOIN product p USING (product_id)
        LEFT JOIN category g ON g.category_id = p.category_id""",
    "unique_violations": """
        SELECT 'product' AS table_name, sku AS key, COUNT(*) AS n FROM product GROUP BY sku HAVING COUNT(*) > 1
        UNION ALL SELECT 'store_inventory', store_id || ':' || product_id, COUNT(*) FROM store_inventory
          GROUP BY store_id, product_id HAVING COUNT(*) > 1""",
    "foreign_key_violations": "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS child, '{col}' AS column_name, CAST({col} AS BIGINT) AS value, COUNT(*) AS n
        FROM {_layer(c)} WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {PRIMARY_KEYS[p]} FROM {_layer(p)}) GROUP BY {col}"""
        for c, col, p in FOREIGN_KEYS),
    "domain_violations": """
        SELECT 'orders' AS table_name, 'status' AS column_name, 'archived' AS value, COUNT(*) AS n
        FROM orders_r WHERE order_id % 601 = 5 HAVING COUNT(*) > 0
        UNION ALL SELECT 'purchase_order', 'status', 'lost', COUNT(*) FROM purchase_order WHERE po_id % 41 = 2
          HAVING COUNT(*) > 0
        UNION ALL SELECT 'inventory_transaction', 'transaction_type', 'theft', COUNT(*) FROM inventory_transaction
          WHERE transaction_id % 1511 = 13 HAVING COUNT(*) > 0""",
    "decimal_overflow": """
        SELECT 'orders' AS table_name, 'total_amount' AS column_name, order_id AS key,
               CAST(total_amount + 20000000000 AS DOUBLE) AS value FROM orders_r WHERE order_id % 701 = 9
        UNION ALL SELECT 'order_item', 'unit_price', order_item_id, CAST(unit_price + 20000000000 AS DOUBLE)
          FROM order_item WHERE order_item_id % 1709 = 8""",
    "stream_hourly_counts": """
        SELECT DATE_TRUNC('hour', ts) AS window_start, event_type, COUNT(*) AS n FROM events
        GROUP BY ALL HAVING DATE_TRUNC('hour', ANY_VALUE(ts)) + INTERVAL 1 HOUR
          <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE""",
    "stream_dedup_events": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "stream_order_lifecycle": """
        WITH RECURSIVE steps AS MATERIALIZED (
          SELECT order_id, history_id, status, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY changed_at, history_id) AS rn
          FROM order_history),
        walk AS (
          SELECT order_id, history_id, rn, CAST(NULL AS VARCHAR) AS prev_status, status, TRUE AS accepted, status AS state
          FROM steps WHERE rn = 1
          UNION ALL
          SELECT s.order_id, s.history_id, s.rn, w.state, s.status, ok.ok, CASE WHEN ok.ok THEN s.status ELSE w.state END
          FROM walk w JOIN steps s ON s.order_id = w.order_id AND s.rn = w.rn + 1
          JOIN (SELECT a.x AS x, b.y AS y, a.x || '>' || b.y IN ('pending>confirmed', 'pending>cancelled',
                  'confirmed>delivered', 'confirmed>cancelled') AS ok
                FROM (VALUES ('pending'), ('confirmed'), ('delivered'), ('cancelled')) a(x),
                     (VALUES ('pending'), ('confirmed'), ('delivered'), ('cancelled')) b(y)) ok
            ON ok.x = w.state AND ok.y = s.status)
        SELECT order_id AS entity_id, history_id AS event_id, prev_status, status, accepted FROM walk""",
    "stream_sla_timeouts": """
        WITH born AS (SELECT order_id, MIN(changed_at) AS born FROM order_history WHERE status = 'pending' GROUP BY order_id),
        due AS (SELECT order_id, phase, born + INTERVAL 1 MINUTE * minutes AS due FROM born,
                  (VALUES ('pending', 19), ('confirmed', 58)) p(phase, minutes)),
        judged AS (
          SELECT d.*, (SELECT ARG_MAX(status, (changed_at, history_id)) FROM order_history h
                       WHERE h.order_id = d.order_id AND h.changed_at <= d.due) AS status,
                 (SELECT MAX(changed_at) FROM order_history h WHERE h.order_id = d.order_id) AS newest
          FROM due d)
        SELECT order_id AS entity_id, phase, due AS alert_ts FROM judged
        WHERE status = phase AND (newest > due OR due < (SELECT MAX(changed_at) FROM order_history) - INTERVAL 10 MINUTE)""",
    "stream_stock_ledger": """
        WITH RECURSIVE moves AS MATERIALIZED (
          SELECT x.store_id, x.product_id, transaction_id, transaction_type AS kind, quantity_delta AS delta,
                 COALESCE(reorder_point, 20) AS point,
                 ROW_NUMBER() OVER (PARTITION BY x.store_id, x.product_id ORDER BY timestamp_occurred, transaction_id) AS rn
          FROM inventory_transaction x LEFT JOIN store_inventory USING (store_id, product_id)),
        fold AS (
          SELECT *, CAST(0 AS BIGINT) AS before, CAST(CASE WHEN delta >= 0 OR kind IN ('return', 'restock') THEN delta ELSE 0
                   END AS BIGINT) AS after FROM moves WHERE rn = 1
          UNION ALL
          SELECT m.*, f.after, CAST(CASE WHEN f.after + m.delta >= 0 OR m.kind IN ('return', 'restock') THEN f.after + m.delta
                   WHEN m.kind = 'sale' THEN f.after ELSE 0 END AS BIGINT)
          FROM fold f JOIN moves m ON m.store_id = f.store_id AND m.product_id = f.product_id AND m.rn = f.rn + 1)
        SELECT store_id, product_id, transaction_id AS id, after AS quantity_after,
               CASE WHEN before + delta >= 0 OR kind IN ('return', 'restock') THEN 'ok'
                 WHEN kind = 'sale' THEN 'insufficient_stock' ELSE 'clamped' END AS result,
               after < point AND before >= point AS low_stock
        FROM fold""",
    "stream_open_sessions": """
        SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 10 HOUR AS session_end, COUNT(*) AS n FROM (
          SELECT user_id, ts, SUM(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island
          FROM (SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 10 HOUR
                        THEN 0 ELSE 1 END AS new FROM events) e) s
        GROUP BY user_id, island
        HAVING MAX(ts) + INTERVAL 10 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE""",
}
RULE_SQL["stream_resume"] = RULE_SQL["stream_hourly_counts"]
RULE_SQL["stream_upsert_inventory"] = RULE_SQL["stock_on_hand"]


def _repeats(table: str) -> str:
    source, key = _layer(table), PRIMARY_KEYS[table]
    if table == "order_history":
        source = "(SELECT * FROM order_history UNION ALL SELECT * FROM order_history WHERE history_id % 1201 = 4) d"
    if table == "customer":
        source = "(SELECT CASE WHEN customer_id % 509 = 6 THEN NULL ELSE customer_id END AS customer_id FROM customer_r) d"
    return f"""SELECT '{table}' AS table_name, COALESCE(CAST({key} AS VARCHAR), 'null') AS key, COUNT(*) AS n
        FROM {source} GROUP BY {key} HAVING COUNT(*) > 1 OR {key} IS NULL"""


RULE_SQL["pk_duplicates"] = "\nUNION ALL\n".join(_repeats(n) for n in TABLE_NAMES)

# The layer's own columns have no NULLs but the planted ones.
RULE_SQL["not_null_violations"] = """
    SELECT 'orders' AS table_name, 'status' AS column_name, COUNT(*) AS n_nulls FROM orders_r WHERE order_id % 401 = 7
    UNION ALL SELECT 'product', 'name', COUNT(*) FROM product WHERE product_id % 301 = 3
    UNION ALL SELECT 'inventory_transaction', 'quantity_delta', COUNT(*) FROM inventory_transaction
      WHERE transaction_id % 1501 = 11"""
RULE_SQL["not_null_violations"] = f"SELECT * FROM ({RULE_SQL['not_null_violations']}) x WHERE n_nulls > 0"

RULE_SQL["reservation_ledger"] = f"""
    SELECT i.order_id, i.order_item_id, v.store_id, i.product_id, 'sale' AS transaction_type, -i.quantity AS quantity_delta,
           CAST(COALESCE((SELECT SUM(quantity_on_hand) FROM store_inventory s
                          WHERE s.store_id = v.store_id AND s.product_id = i.product_id), 0)
             - SUM(i.quantity) OVER (PARTITION BY v.store_id, i.product_id ORDER BY o.created_at, i.order_id, i.order_item_id
                                     ROWS UNBOUNDED PRECEDING) AS BIGINT) AS quantity_after,
           o.created_at AS timestamp_occurred
    FROM order_item i JOIN ({RULE_SQL["reserve_stock"]}) v USING (order_id) JOIN orders_r o USING (order_id)
    WHERE v.result = 'ok'"""
