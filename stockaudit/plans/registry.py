"""Every registered query and its DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockaudit.operators import constraints, inventory, kpis, orders, repairs
from stockaudit.operators.checks import CHECKS
from stockaudit.operators.reservations import reservation_ledger, reserve_stock
from stockaudit.plans import audit, oracle_checks, planted
from stockaudit.plans.oracle_rules import RULE_SQL
from stockaudit.plans.planted import AS_OF, LOAD_TIME, TEST_BANDS
from stockaudit.session import new_folder
from stockaudit.sources import loading, sinks
from stockaudit.sources.retail_layer import retail_tables, with_clause
from stockaudit.streaming import events as event_streams
from stockaudit.streaming import intake
from stockaudit.streaming import ledger as ledger_streams
from stockaudit.streaming import lifecycle
from stockaudit.streaming.runs import replay, replay_to_table

Query = Callable[[SparkSession, str], DataFrame]


def _comparable(df: DataFrame) -> DataFrame:
    """Money as doubles, so both engines hand over the same value type."""
    money = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(money) if money else df


def _utc(run: Query) -> Query:
    """Watermarks need zoned time; UTC makes it equal to the zone-less time of the tables."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return run(spark, sf_dir)
    return query


def _on_tables(run: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: _comparable(run(retail_tables(spark, sf_dir)))


# --- sources and sinks ------------------------------------------------------------------------

def _write_audit_outputs(t) -> DataFrame:
    folder = new_folder(t.spark, "audit")
    return sinks.write_audit_outputs(audit.all_violations(t), folder)


def _assign_surrogate_keys(t) -> DataFrame:
    rows = t.orders.select("created_at", "order_id")
    last = t.orders.agg(F.max("order_id")).first()[0] or 0
    return loading.assign_surrogate_keys(rows, ["created_at", "order_id"], "new_id", last)


def _insert_if_absent(t) -> DataFrame:
    target = t.store_inventory.select("store_id", "product_id")
    source = t.inventory_transaction.select("store_id", "product_id")
    return loading.insert_if_absent(target, source, ["store_id", "product_id"])


def _upsert_products(t) -> DataFrame:
    last = t.product.agg(F.max("product_id")).first()[0] or 0
    return loading.upsert_products(t.product, planted.product_source(t), t.category, last)


def _dedupe_customers(t) -> DataFrame:
    people = planted.with_contacts(t.customer).select("customer_id", "phone_number")
    return loading.dedupe_customers(people.filter("customer_id % 3 = 0"), people.filter("customer_id % 3 <> 0"))


def _build_assortment(t) -> DataFrame:
    return loading.build_assortment(t.dark_store, t.product, t.store_inventory, on_hand=150)


def _initial_purchase_orders(t) -> DataFrame:
    bands = loading.price_bands(t.spark, TEST_BANDS)
    return loading.initial_purchase_order_lines(planted.with_new_stores(t), bands, t.purchase_order)


def _mask_secret_column(t) -> DataFrame:
    text = F.concat(F.lit("UID=app;PWD=pw"), F.col("supplier_id").cast("string"), F.lit(";DATABASE="), F.col("name"))
    return loading.mask_secret_column(t.supplier.select("supplier_id", text.alias("text")), "supplier_id", "text")


# --- stock ------------------------------------------------------------------------------------

def _clamped_adjustments(t) -> DataFrame:
    adjustments = t.inventory_transaction.filter(F.col("transaction_type") == "adjustment")
    return inventory.clamped_adjustments(adjustments, inventory.opening_stock(t.store_inventory))


def _reserve_stock(t) -> DataFrame:
    return reserve_stock(t.store_inventory, t.orders.filter(F.col("status") == "pending"), t.order_item)


def _reservation_ledger(t) -> DataFrame:
    return reservation_ledger(t.store_inventory, t.orders, t.order_item, _reserve_stock(t))


def _cap_order_quantity(t) -> DataFrame:
    requests = t.order_item.select("order_item_id", "order_id", "product_id", "quantity").join(
        t.orders.select("order_id", "store_id"), "order_id")
    return inventory.cap_order_quantity(requests, t.store_inventory)


def _open_at_day_end(t) -> DataFrame:
    return orders.open_at_day_end(t.orders, t.order_history, F.pmod("order_id", F.lit(20)) < 17)


def _order_snapshots(t) -> DataFrame:
    return orders.read_snapshots(orders.order_snapshot_json(t.orders, t.order_item))


def _discard_stale_state(t) -> DataFrame:
    state = orders.status_as_of(t.order_history, AS_OF)
    return orders.discard_stale_state(state, "changed_at", AS_OF)


# --- streams ----------------------------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(event_streams.EVENTS).parquet(f"{sf_dir}/events.parquet")


def _statuses(t) -> DataFrame:
    return t.order_history.select(
        F.col("order_id").alias("entity_id"), F.col("history_id").alias("event_id"), "status",
        F.col("changed_at").alias("ts"))


def _movements(t) -> DataFrame:
    return t.inventory_transaction.select(
        "store_id", "product_id", F.col("transaction_id").alias("id"), F.col("transaction_type").alias("kind"),
        F.col("quantity_delta").alias("delta"), F.col("timestamp_occurred").alias("ts"))


def _stream_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every odd event arrives twice, and every third one again after 30 days."""
    events = _events(spark, sf_dir)
    twice = F.explode(F.sequence(F.lit(0), F.col("event_id") % 2)).alias("_copy")
    later = events.where(F.col("event_id") % 3 == 0).withColumn("ts", F.col("ts") + F.expr("INTERVAL 30 DAYS"))
    arrived = events.select("*", twice).drop("_copy").unionByName(later)
    return replay(arrived, "ts", intake.take_once, slices=3)


def _stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly counts, with a stop after the first half of the time and a second run from the checkpoint."""
    return replay_to_table(_events(spark, sf_dir), "ts", event_streams.hourly_counts, slices=2)


def _stream_upsert_inventory(t) -> DataFrame:
    return replay(_movements(t), "ts", ledger_streams.upsert_inventory)


def _stream(run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: replay_to_table(_events(spark, sf_dir), "ts", run)


RULES: dict[str, Callable[..., DataFrame]] = {
    # S: sources, loading, sinks
    "table_row_counts": loading.table_row_counts,
    "apply_column_defaults": lambda t: loading.apply_column_defaults(
        planted.inventory_with_gaps(t), "store_inventory", LOAD_TIME),
    "order_line_totals": lambda t: loading.order_line_totals(t.order_item),
    "assign_surrogate_keys": _assign_surrogate_keys,
    "insert_if_absent": _insert_if_absent,
    "upsert_products": _upsert_products,
    "dedupe_customers": _dedupe_customers,
    "build_assortment": _build_assortment,
    "initial_purchase_orders": _initial_purchase_orders,
    "initial_purchase_order_headers": lambda t: loading.initial_purchase_orders(_initial_purchase_orders(t), LOAD_TIME),
    "initial_restocks": lambda t: loading.initial_restocks(_initial_purchase_orders(t), LOAD_TIME),
    "write_audit_outputs": _write_audit_outputs,
    "supplier_contact_email": lambda t: loading.supplier_contact_email(t.supplier),
    "mask_secret_column": _mask_secret_column,
    # R: repairs
    "repair_latest_status": lambda t: repairs.repair_latest_status(t.orders, t.order_history),
    "repair_invalid_transitions": lambda t: repairs.repair_invalid_transitions(t.order_history),
    "repair_repeated_status": lambda t: repairs.repair_repeated_status(t.order_history),
    "repair_history_pipeline": lambda t: repairs.repair_history_pipeline(t)[0],
    "repaired_history": lambda t: repairs.repair_history_pipeline(t)[1],
    # K: stock
    "stock_on_hand": lambda t: inventory.stock_on_hand(t.inventory_transaction),
    "running_stock_ledger": lambda t: inventory.running_stock_ledger(t.inventory_transaction),
    "clamped_adjustments": _clamped_adjustments,
    "reserve_stock": _reserve_stock,
    "stock_reversals": lambda t: inventory.stock_reversals(t.orders, t.order_item, t.order_history),
    "reservation_ledger": _reservation_ledger,
    "cancellation_ledger": lambda t: inventory.cancellation_ledger(
        t.orders, t.order_item, t.order_history, t.store_inventory),
    "cap_order_quantity": _cap_order_quantity,
    "low_stock": lambda t: inventory.low_stock(t.store_inventory),
    "propose_purchase_orders": lambda t: inventory.propose_purchase_orders(
        t.store_inventory, t.product, t.category, t.supplier, loading.price_bands(t.spark, TEST_BANDS)),
    "receive_purchase_orders": lambda t: inventory.receive_purchase_orders(
        t.purchase_order, t.purchase_order_item, t.store_inventory),
    "received_items": lambda t: inventory.received_items(t.purchase_order, t.purchase_order_item),
    "received_orders": lambda t: inventory.received_orders(t.purchase_order, LOAD_TIME),
    "received_inventory": lambda t: inventory.received_inventory(
        t.purchase_order, t.purchase_order_item, t.store_inventory),
    "adjustment_shrinkage": lambda t: inventory.adjustment_shrinkage(t.inventory_transaction),
    "cold_chain_items": lambda t: inventory.cold_chain_items(t.order_item, t.product, t.category),
    "price_band_violations": lambda t: inventory.price_band_violations(
        t.order_item, t.product, t.category, loading.price_bands(t.spark, TEST_BANDS)),
    "cold_chain_companions": inventory.cold_chain_companions,
    # K: orders and summaries
    "price_orders": lambda t: orders.price_orders(t.order_item, t.orders, t.customer, t.zone),
    "business_event_feed": lambda t: orders.business_event_feed(planted.registered(t)),
    "fulfilment_minutes": lambda t: kpis.fulfilment_minutes(t.orders, t.order_history),
    "fulfilment_minutes_by_order": lambda t: kpis.fulfilment_minutes_by_order(t.orders, t.order_history),
    "order_status_kpis": kpis.order_status_kpis,
    "hourly_order_summary": lambda t: kpis.hourly_order_summary(t.order_history),
    "transition_rates": lambda t: kpis.transition_rates(t.order_history),
    "cancel_reason": lambda t: kpis.cancel_reason(t.orders, t.order_history),
    "payment_method_mix": lambda t: kpis.payment_method_mix(t.orders),
    "basket_size_mix": lambda t: kpis.basket_size_mix(t.order_item),
    "hourly_traffic_profile": lambda t: kpis.hourly_traffic_profile(t.source("events").select("ts"), "ts"),
    "expected_event_mix": lambda t: kpis.expected_event_mix(planted.registered(t)),
    "off_hours_activity": lambda t: orders.off_hours_activity(t.order_history),
    "next_workday_start": lambda t: orders.next_workday_starts(t.orders, "order_id", "created_at"),
    "open_orders_as_of": lambda t: orders.open_orders_as_of(t.orders, t.order_history, AS_OF),
    "open_at_day_end": _open_at_day_end,
    "order_snapshot_json": _order_snapshots,
    "discard_stale_state": _discard_stale_state,
    "customer_registrations": lambda t: orders.customer_registrations(planted.with_contacts(t.customer), t.zone),
    "phone_format_violations": lambda t: orders.phone_format_violations(planted.with_contacts(t.customer)),
    "dimension_enriched_orders": orders.dimension_enriched_orders,
    # U: declared constraints
    "pk_duplicates": lambda t: constraints.pk_duplicates(planted.with_repeats(t)),
    "unique_violations": constraints.unique_violations,
    "not_null_violations": lambda t: constraints.not_null_violations(planted.with_nulls(t)),
    "foreign_key_violations": constraints.foreign_key_violations,
    "domain_violations": lambda t: constraints.domain_violations(planted.with_foreign_words(t)),
    "decimal_overflow": lambda t: constraints.decimal_overflow(planted.with_wide_amounts(t)),
    # ST: streams over the layer
    "stream_order_lifecycle": lambda t: replay_to_table(_statuses(t), "ts", lifecycle.order_lifecycle),
    "stream_sla_timeouts": lambda t: replay_to_table(_statuses(t), "ts", lifecycle.sla_timeouts),
    "stream_stock_ledger": lambda t: replay_to_table(
        _movements(t), "ts", lambda moves: ledger_streams.stock_ledger(moves, t.store_inventory)),
    "stream_upsert_inventory": _stream_upsert_inventory,
}


def queries() -> dict[str, Query]:
    out = {k.query: _on_tables(k.run) for k in CHECKS}
    out["audit_summary"] = _on_tables(audit.audit_summary)
    out["audit_samples"] = _on_tables(audit.audit_samples)
    out |= {name: _on_tables(run) for name, run in RULES.items()}
    out["stream_hourly_counts"] = _stream(event_streams.hourly_counts)
    out["stream_dedup_events"] = _stream_dedup_events
    out["stream_resume"] = _stream_resume
    out["stream_open_sessions"] = _stream(event_streams.open_sessions)
    return {name: _utc(run) for name, run in out.items()}


def oracle_sql() -> dict[str, str]:
    texts = {k.query: oracle_checks.CHECK_SQL[k.check_id] for k in CHECKS}
    texts["audit_summary"] = oracle_checks.summary_sql()
    texts["audit_samples"] = oracle_checks.samples_sql()
    texts["write_audit_outputs"] = oracle_checks.written_sql()
    return {name: with_clause(text) for name, text in (texts | RULE_SQL).items()}
