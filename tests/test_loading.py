from __future__ import annotations

import datetime
import json
from decimal import Decimal as D

import pytest
from shop import at
from pyspark.sql import functions as F

from stockaudit.functions import columns as c
from stockaudit.operators import orders
from stockaudit.operators.constraints import decimal_overflow, pk_duplicates
from stockaudit.schemas import PRIMARY_KEYS
from stockaudit.session import new_folder
from stockaudit.sources import loading, sinks
from stockaudit.tables import Tables, replace


def test_surrogate_keys_are_dense_and_ordered(spark):
    names = [f"n{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "name STRING")
    got = loading.assign_surrogate_keys(df, ["name"], "id", max_id=40, partitions=7).orderBy("id").collect()
    assert [(r.id, r.name) for r in got] == [(41 + i, n) for i, n in enumerate(names)]


def test_insert_twice_is_insert_once(spark):
    target = spark.createDataFrame([("a", 1)], "name STRING, v INT")
    source = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2), ("c", 4)], "name STRING, v INT")
    once = loading.insert_if_absent(target, source, ["name"], ["v"])
    assert sorted(tuple(r) for r in once.collect()) == [
        ("a", 1, "existing"), ("b", 2, "inserted"), ("c", 4, "inserted")]
    twice = loading.insert_if_absent(once.drop("origin"), source, ["name"], ["v"])
    assert twice.filter("origin = 'inserted'").isEmpty() and twice.count() == 3


def test_upsert_follows_the_name(build, rows, spark):
    t = build(rows)
    source = spark.createDataFrame(
        [(1, "D-1", "Milk", 99, "Dairy"), (2, "S-1", "Crisps", 80, "Snacks"), (3, "N-1", "Nuts", 30, "Snacks"),
         (4, "X-1", "Fish", 3, "Sea")], "seq INT, sku STRING, name STRING, shelf_life_days INT, category STRING")
    got = {r.sku: (r.product_id, r.category_id, r.name, r.shelf_life_days, r.action)
           for r in loading.upsert_products(t.product, source, t.category, 2).collect()}
    assert got == {"D-1": (1, 1, "Milk", 7, "unchanged"), "S-1": (2, 2, "Crisps", 80, "updated"),
                   "N-1": (3, 2, "Nuts", 30, "inserted")}


def test_customers_by_phone_until_the_table_is_full(spark):
    old = spark.createDataFrame([(1, "a")], "customer_id BIGINT, phone_number STRING")
    new = spark.createDataFrame([(2, "a"), (4, "b"), (3, "b"), (5, "c")], "customer_id BIGINT, phone_number STRING")
    ids = lambda *target: sorted(r.customer_id for r in loading.dedupe_customers(old, new, *target).collect())
    assert ids() == [1, 3, 5] and ids(50) == [1, 3, 5]
    assert ids(1) == [1]


def test_assortment_yields_absent_pairs_only(build, rows):
    rows["store_inventory"] = rows["store_inventory"][:1]
    rows["dark_store"].append(dict(store_id=3, name="West"))
    t = build(rows)
    got = loading.build_assortment(t.dark_store, t.product, t.store_inventory, 150)
    assert sorted((r.store_id, r.product_id) for r in got.collect()) == [(1, 2), (2, 1), (2, 2), (3, 1), (3, 2)]
    assert "Cartesian" not in plan(got)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_opening_orders_of_new_stores(build, rows, spark):
    rows["purchase_order"] = rows["purchase_order"][1:2]
    t = build(rows)
    lines = loading.initial_purchase_order_lines(t, loading.price_bands(spark), t.purchase_order)
    assert sorted((r.store_id, r.supplier_id, r.product_id, r.quantity_received, r.unit_price) for r in lines.collect()
                  ) == [(1, 7, 1, 98, D("24.50")), (1, 7, 2, 99, D("14.00"))]
    head = loading.initial_purchase_orders(lines, at(0)).collect()
    assert [(r.store_id, r.status, r.total_price) for r in head] == [(1, "received", D("3787.00"))]
    assert loading.initial_restocks(lines, at(0)).filter("quantity_after = quantity_delta").count() == 2


def test_defaults(build, rows, spark):
    df = spark.createDataFrame([(1, None, 5), (2, 7, None)], "inventory_id INT, quantity_on_hand INT, reorder_point INT")
    got = loading.apply_column_defaults(df, "store_inventory", datetime.datetime(2024, 1, 1))
    assert sorted((r.quantity_on_hand, r.reorder_point, r.reorder_quantity, r.last_updated.year) for r in got.collect()
                  ) == [(0, 5, 100, 2024), (7, 20, 100, 2024)]


def test_outputs_are_read_back(spark):
    found = spark.createDataFrame([("A1", "1:1", "x"), ("A1", "1:2", "y"), ("F1", "9", "")],
                                  "check_id STRING, key STRING, detail STRING")
    folder = new_folder(spark, "audit")
    assert {r.check_id: r.n for r in sinks.write_audit_outputs(found, folder).collect()} == {"A1": 2, "F1": 1}
    assert spark.read.parquet(f"{folder}/violations").filter("check_id = 'F1'").first().key == "9"


def test_a_run_is_published_whole(spark, monkeypatch):
    """A second run that stops before its end changes no read; the next one takes its place."""
    rows = lambda *ids: spark.createDataFrame([(i, "1", "x") for i in ids], "check_id STRING, key STRING, detail STRING")
    folder = new_folder(spark, "audit")
    sinks.write_audit_outputs(rows("A1", "A1"), folder)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "mark", stop)
        with pytest.raises(RuntimeError):
            sinks.write_audit_outputs(rows("B1"), folder)
    report, violations = sinks.read_audit_outputs(spark, folder)
    assert {tuple(r) for r in report.collect()} == {("A1", 2)} and violations.count() == 2
    assert {tuple(r) for r in sinks.write_audit_outputs(rows("C1"), folder).collect()} == {("C1", 1)}
    report, violations = sinks.read_audit_outputs(spark, folder)
    assert [r.check_id for r in violations.collect()] == ["C1"] == [r.check_id for r in report.collect()]
    assert sinks.read_audit_outputs(spark, folder, 0)[1].count() == 2
    with pytest.raises(ValueError):
        sinks.read_audit_outputs(spark, folder, 7)


def test_text_functions(spark):
    row = spark.range(1).select(
        c.contact_email(F.lit("Al-Ahram Trading & Supply Co.")).alias("email"),
        c.mask_secret(F.lit("UID=a;PWD=s3cret;X=1")).alias("masked"),
        c.is_phone(F.lit("015 12345678")).alias("good"), c.is_phone(F.lit("015 02345678")).alias("zero"),
        c.is_phone(F.lit("013 12345678")).alias("prefix"),
    ).first()
    assert row.email == "info@al-ahramtrading&supp.com.eg" and row.masked == "UID=a;PWD=***;X=1"
    assert (row.good, row.zero, row.prefix) == (True, False, False)


@pytest.mark.parametrize("when,start,end", [
    ((2024, 2, 28, 7, 59), (2024, 2, 29, 8), (2024, 2, 28, 22)),
    ((2024, 12, 31, 22, 0), (2025, 1, 1, 8), (2024, 12, 31, 22)),
    ((2024, 12, 31, 22, 1), (2025, 1, 1, 8), (2025, 1, 1, 22)),
])
def test_workday(spark, when, start, end):
    ts = F.lit(datetime.datetime(*when)).cast("timestamp_ntz")
    row = spark.range(1).select(c.next_workday_start(ts).alias("s"), c.day_end(ts).alias("e")).first()
    assert row.s == datetime.datetime(*start) and row.e == datetime.datetime(*end)


def test_snapshot_text_round_trip(build, rows):
    """One header and one text per item, whether an order has none, one or thousands."""
    t = build(rows)
    head, item = orders.order_snapshot_json(t.orders, t.order_item).orderBy(F.col("order_item_id").asc_nulls_first()).collect()
    assert json.loads(head.json) == dict(
        order_id=3, status="pending", created_at="2024-01-08T10:06:00", store_id=2, customer_id=1)
    assert json.loads(item.json) == dict(order_id=3, order_item_id=4, product_id=2, quantity=3, price=10.0)
    rows["order_item"] += [dict(rows["order_item"][3], order_item_id=100 + i) for i in range(2000)]
    rows["orders"].append(dict(rows["orders"][2], order_id=4))
    t = build(rows)
    texts = orders.order_snapshot_json(t.orders, t.order_item)
    assert texts.count() == 2 + 2001
    broken = texts.unionByName(texts.limit(1).withColumn("json", F.lit("{not json")))
    read = orders.read_snapshots(broken)
    assert read.filter("order_id = 3").count() == 2001
    assert [tuple(r) for r in read.filter("order_id = 4").collect()] == [(4, None, None, None)]


def test_keys_and_widths(build, rows):
    rows["category"].append(dict(rows["category"][0]))
    rows["supplier"].append(dict(supplier_id=None, name="x"))
    t = build(rows)
    got = sorted(tuple(r) for r in pk_duplicates(t).collect())
    assert got == [("category", "1", 2), ("supplier", "null", 1)]
    wide = replace(t, orders=t.orders.withColumn("delivery_fee", F.lit(D("1234567.00"))))
    assert decimal_overflow(wide).filter("column_name = 'delivery_fee'").count() == 3


def test_tables_reject_unknown_names(spark):
    with pytest.raises(ValueError):
        Tables(order=spark.range(1))
    with pytest.raises(AttributeError):
        Tables(orders=spark.range(1)).customer
    assert len(PRIMARY_KEYS) == 13
