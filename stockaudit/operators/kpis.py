"""Lifecycle, mix and traffic summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockaudit.functions import columns as c
from stockaudit.functions.parameters import (
    BASKET_MIX,
    CONFIRM_RATE,
    DELIVER_RATE,
    EVENT_MIX,
    HOURLY_INTENSITY,
    MAX_EVENT_PROBABILITY,
    PAYMENT_MIX,
)
from stockaudit.operators.checks import with_previous_status
from stockaudit.operators.orders import business_events


def _rows() -> Column:
    return F.count(F.lit(1))


def _ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.round(part.cast("double") / whole.cast("double"), digits)


def _share(counts: DataFrame) -> DataFrame:
    """Add each count's share of the total; ``counts`` is already one row per category."""
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("_total", total).withColumn("share", _ratio(F.col("n"), F.col("_total"))).drop("_total")


def _expected(words: dict, key: str) -> Column:
    table = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    return table[F.col(key)]


def fulfilment_minutes_by_order(orders: DataFrame, history: DataFrame) -> DataFrame:
    """Whole minutes from creation to delivery of every delivered order."""
    delivered = history.filter(F.col("status") == "delivered").groupBy("order_id").agg(F.max("changed_at").alias("at"))
    return orders.select("order_id", "store_id", "created_at").join(delivered, "order_id").select(
        "order_id", "store_id", c.minutes_between(F.col("created_at"), F.col("at")).alias("minutes"))


def fulfilment_minutes(orders: DataFrame, history: DataFrame) -> DataFrame:
    """Whole minutes from creation to delivery per store."""
    return fulfilment_minutes_by_order(orders, history).groupBy("store_id").agg(
        _rows().alias("n"), F.min("minutes").alias("min_minutes"), F.max("minutes").alias("max_minutes"),
        _ratio(F.sum("minutes"), _rows()).alias("avg_minutes"))


def order_status_kpis(t) -> DataFrame:
    """Counters and rates per store and overall; customers belong to no store and count overall only."""
    status = F.col("status")
    by_store = [
        t.orders.groupBy("store_id").agg(
            _rows().alias("orders_created"), F.count_if(status == "delivered").alias("orders_delivered"),
            F.count_if(status == "cancelled").alias("orders_cancelled")),
        t.purchase_order.groupBy("store_id").agg(
            _rows().alias("po_created"), F.count_if(status == "received").alias("po_received")),
        t.inventory_transaction.groupBy("store_id").agg(
            F.count_if(F.col("transaction_type") == "adjustment").alias("adjustments"), _rows().alias("ledger_rows")),
    ]
    stacked = by_store[0].unionByName(by_store[1], True).unionByName(by_store[2], True)
    counters = [n for n in stacked.columns if n != "store_id"]
    totals = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counters]
    customers = t.customer.agg(_rows()).scalar()
    stores = stacked.groupBy("store_id").agg(*totals).select(
        F.lit("store").alias("scope"), "store_id", *counters, F.lit(None).cast("bigint").alias("customers"))
    overall = stacked.agg(*totals).select(
        F.lit("overall").alias("scope"), F.lit(None).cast("int").alias("store_id"), *counters,
        customers.alias("customers"))
    base = F.greatest(F.col("orders_created"), F.lit(1))
    return stores.unionByName(overall).withColumns({
        "delivered_pct": _ratio(F.col("orders_delivered") * 100, base, 1),
        "cancelled_pct": _ratio(F.col("orders_cancelled") * 100, base, 1),
    })


def hourly_order_summary(history: DataFrame) -> DataFrame:
    """Created, delivered and cancelled per hour and in total so far.

    The running totals go over one row per calendar hour, within days and then over days.
    """
    names = {"created": "pending", "delivered": "delivered", "cancelled": "cancelled"}
    hourly = history.groupBy(c.hour_start(F.col("changed_at")).alias("hour")).agg(
        *[F.count_if(F.col("status") == s).alias(n) for n, s in names.items()])
    hourly = hourly.withColumn("_day", F.to_date("hour"))
    so_far = Window.partitionBy("_day").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = hourly.groupBy("_day").agg(*[F.sum(n).alias(n) for n in names]).select(
        "_day", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}") for n in names])
    return hourly.join(days, "_day").select(
        "hour", *names, *[(F.sum(n).over(so_far) + F.col(f"_{n}")).alias(f"cum_{n}") for n in names])


def transition_rates(history: DataFrame) -> DataFrame:
    """How often each status is followed by each other one, next to the configured rates."""
    successors = with_previous_status(history).filter(F.col("prev_status").isNotNull()).groupBy(
        F.col("prev_status").alias("from_status"), F.col("status").alias("to_status")).agg(_rows().alias("n"))
    totals = history.groupBy(F.col("status").alias("from_status")).agg(_rows().alias("_total"))
    configured = F.when(
        (F.col("from_status") == "pending") & (F.col("to_status") == "confirmed"), F.lit(CONFIRM_RATE)).when(
        (F.col("from_status") == "confirmed") & (F.col("to_status") == "delivered"), F.lit(DELIVER_RATE))
    return successors.join(totals, "from_status").select(
        "from_status", "to_status", "n", _ratio(F.col("n"), F.col("_total")).alias("rate"),
        configured.alias("configured"))


def cancel_reason(orders: DataFrame, history: DataFrame) -> DataFrame:
    confirmed = history.filter(F.col("status") == "confirmed").select("order_id").distinct().withColumn(
        "_confirmed", F.lit(True))
    reason = F.when(F.col("_confirmed"), "after_confirmation").otherwise("before_confirmation")
    return (
        orders.filter(F.col("status") == "cancelled").select("order_id").join(confirmed, "order_id", "left")
        .groupBy(reason.alias("reason")).agg(_rows().alias("n"))
    )


def payment_method_mix(orders: DataFrame, expected: dict[str, float] = PAYMENT_MIX) -> DataFrame:
    counts = orders.groupBy("payment_method").agg(_rows().alias("n"))
    return _share(counts).withColumn("expected", _expected(expected, "payment_method"))


def basket_size_mix(items: DataFrame, expected: dict[int, float] = BASKET_MIX) -> DataFrame:
    sizes = items.groupBy("order_id").agg(_rows().cast("int").alias("n_items"))
    return _share(sizes.groupBy("n_items").agg(_rows().alias("n"))).withColumn(
        "expected", _expected(expected, "n_items"))


def _hours(spark) -> DataFrame:
    values = ", ".join(f"({h}, CAST({f} AS DOUBLE))" for h, f in enumerate(HOURLY_INTENSITY))
    return spark.sql(f"SELECT * FROM VALUES {values} AS h(hour, intensity)")


def hourly_traffic_profile(rows: DataFrame, ts: str) -> DataFrame:
    """Observed share of each hour of day against the share its intensity stands for."""
    spark = rows.sparkSession
    counts = rows.groupBy(F.hour(ts).alias("hour")).agg(_rows().alias("n"))
    whole = sum(HOURLY_INTENSITY)
    both = _hours(spark).join(counts, "hour", "left").withColumn("_total", counts.agg(F.sum("n")).scalar())
    observed = F.coalesce("n", F.lit(0)).cast("double") / F.col("_total")
    expected = F.col("intensity") / F.lit(whole)
    return both.select(
        "hour", F.coalesce("n", F.lit(0)).alias("n"), F.round(observed, 4).alias("observed_share"),
        F.round(expected, 4).alias("expected_share"), F.round(observed / expected, 4).alias("ratio"))


# Which kind of event each business event is.
EVENT_KINDS = {
    "ORDER_CREATED": "order_create",
    "ORDER_CONFIRMED": "advance_order",
    "ORDER_DELIVERED": "advance_order",
    "ORDER_CANCELLED": "advance_order",
    "CUSTOMER_REGISTERED": "customer_registration",
    "STOCK_ADJUSTED": "stock_adjust",
    "PO_CREATED": "restock_check",
    "PO_RECEIVED": "restock_check",
}


def expected_event_mix(t) -> DataFrame:
    """Per hour of day and kind of event: the probability the traffic model gives it and what was observed.

    The cumulative probabilities of the kinds are scaled by the hour's intensity and capped; a kind
    gets what its cumulative value adds. The rest of the hour is idle.
    """
    events = business_events(t)
    spark = events.sparkSession
    observed = (
        events.groupBy(F.hour("ts").alias("hour"), _expected(EVENT_KINDS, "event").alias("event"))
        .agg(_rows().alias("observed"))
    )
    reached, bands = 0.0, []
    for name, p in EVENT_MIX:
        low, reached = reached, round(reached + p, 4)
        cap = lambda x: F.least(F.lit(x) * F.col("intensity"), F.lit(MAX_EVENT_PROBABILITY))
        bands.append(F.struct(F.lit(name).alias("event"), F.round(cap(reached) - cap(low), 4).alias("probability")))
    idle = F.round(1 - F.least(F.lit(reached) * F.col("intensity"), F.lit(MAX_EVENT_PROBABILITY)), 4)
    bands.append(F.struct(F.lit("idle").alias("event"), idle.alias("probability")))
    expected = _hours(spark).select("hour", F.inline(F.array(*bands)))
    whole = observed.groupBy("hour").agg(F.sum("observed").alias("_all"))
    return (
        expected.join(observed, ["hour", "event"], "left").join(whole, "hour", "left")
        .select("hour", "event", "probability", F.coalesce("observed", F.lit(0)).alias("observed"),
                _ratio(F.coalesce("observed", F.lit(0)), F.col("_all")).alias("observed_share"))
    )
