"""All-or-nothing stock reservation, first come first served, narrowed by bounds and then one contended component at a time."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockaudit.operators.components import components
from stockaudit.operators.ordered import with_running_total, with_running_totals
from stockaudit.session import cut_lineage

PAIR = ["store_id", "product_id"]
#: Rounds of narrowing at most; a round that decides less than a hundredth of what is open is the last.
ROUNDS = 12


def _refused(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contended lines sorted by (component, time, order) in, refused order ids out.

    ``room`` is the stock that orders decided before leave to a line. Rows pass one batch at a time; what is kept is the
    stock that open orders have taken of the products of one component.
    """
    component = order = None
    taken: dict[int, int] = {}
    basket: list[tuple[int, int, int]] = []

    def settle(out: list[int]) -> None:
        if all(wanted + taken.get(pair, 0) <= room for pair, wanted, room in basket):
            for pair, wanted, _ in basket:
                taken[pair] = taken.get(pair, 0) + wanted
        elif basket:
            out.append(order)
        basket.clear()

    for batch in batches:
        out: list[int] = []
        for now, order_id, pair, wanted, room in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if order_id != order or now != component:
                settle(out)
                if now != component:
                    taken.clear()
                component, order = now, order_id
            basket.append((pair, wanted, room))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["order_id"])
    rest: list[int] = []
    settle(rest)
    yield pa.RecordBatch.from_arrays([pa.array(rest, pa.int64())], names=["order_id"])


def scarce_lines(inventory: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """What orders want (order_id, created_at, pair, quantity, opening) of products whose whole demand exceeds the stock."""
    demand = cut_lineage(
        items.groupBy("order_id", "product_id").agg(F.coalesce(F.sum("quantity"), F.lit(0)).alias("quantity"))
        .join(orders.select("order_id", "store_id", "created_at"), "order_id"))
    stock = inventory.groupBy(*PAIR).agg(F.sum("quantity_on_hand").alias("opening"))
    opening = F.coalesce(F.col("opening"), F.lit(0))
    scarce = (
        demand.groupBy(*PAIR).agg(F.sum("quantity").alias("wanted"))
        .join(stock, PAIR, "left")
        .filter(F.col("wanted") > opening)
        .select(*PAIR, opening.cast("bigint").alias("opening"))
    )
    return demand.join(scarce, PAIR).select("order_id", "created_at", F.xxhash64(*PAIR).alias("pair"), "quantity", "opening")


def narrowed(lines: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """The lines of orders still open (order_id, created_at, pair, quantity, room), and the ids of refused orders.

    An order that suffices even if all open orders before it are accepted is accepted; one that fails even if none of them
    is, is refused. Each round's decisions sharpen the next one's bounds: accepted lines take from the ``room`` of the open
    ones behind them and are gone then, so that rounds shrink with what is open.
    """
    own = Window.partitionBy("order_id")
    lines = cut_lineage(lines.withColumnRenamed("opening", "room").withColumn("accepted", F.lit(False)))
    largest = lines.groupBy("pair").count().agg(F.max("count")).first()[0] or 0  # rounds only take lines away
    refused, left = None, None
    for _ in range(rounds):
        run = _folded(lines, largest)
        # A basket is small, so its lines may meet in one task.
        fits, fails = F.min(F.col("most") <= F.col("room")).over(own), F.max(F.col("quantity") > F.col("room")).over(own)
        run = cut_lineage(run.withColumns({"accepted": fits, "failed": fails}).drop("most"))
        gone = run.filter("failed").select("order_id").distinct()
        refused = gone if refused is None else refused.union(gone)
        lines = run.filter("not failed").drop("failed")
        now = lines.filter("not accepted").count()
        if not now or (left is not None and left - now < left / 100):
            break
        left = now
    return _folded(lines, largest), refused


def _folded(lines: DataFrame, largest: int) -> DataFrame:
    """The open ones of ``lines``: accepted lines before have taken from ``room``; ``most`` is what open ones want up to each."""
    taken = F.when(F.col("accepted"), F.col("quantity")).otherwise(0)
    run = with_running_totals(lines, ["pair"], ["created_at", "order_id"], {"taken": taken, "most": F.col("quantity")},
                              largest=largest)
    return run.filter("not accepted").select(
        "order_id", "created_at", "pair", "quantity", (F.col("room") - F.col("taken")).alias("room"),
        (F.col("most") - F.col("taken")).alias("most"))


def open_components(lines: DataFrame) -> DataFrame:
    """The lines of open orders that bear on each other, with ``room`` and the component that each belongs to.

    A line matters if it may fail, or if another line of its product may: products that have enough for all who are
    open link nothing.
    """
    run = cut_lineage(lines.withColumn("tight", F.col("most") > F.col("room")))
    tight = run.filter("tight").select("pair").distinct()
    run = run.join(tight, "pair", "left_semi")
    # Products of one order are linked to its first one: a graph of products, however many orders there are.
    hubs = run.groupBy("order_id").agg(F.min("pair").alias("hub"))
    links = run.join(hubs, "order_id").filter("pair <> hub").select(F.col("pair").alias("a"), F.col("hub").alias("b")).distinct()
    return run.join(components(links).select(F.col("node").alias("pair"), "root"), "pair", "left").select(
        F.coalesce("root", "pair").alias("component"), "created_at", "order_id", "pair", "quantity", "room")


def reserve_stock(inventory: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Which orders can be confirmed when served in (time, id) order per store.

    An order is confirmed, and takes its stock, only if every product suffices. Products whose whole
    demand fits the stock can never fail and drop out first. Bounds decide most other orders in a few rounds of running
    sums over the cluster. What stays open falls into components of products that open orders ask for together; no order
    concerns two components, so each is served on its own, as a stream of its lines in order: the sequence the rule asks for.
    """
    base = orders.select("order_id", "store_id")
    lines, refused = narrowed(scarce_lines(inventory, orders, items))
    if not lines.isEmpty():
        served = (
            open_components(lines).repartition("component").sortWithinPartitions("component", "created_at", "order_id")
            .select("component", "order_id", "pair", "quantity", "room")
        )
        refused = refused.union(served.mapInArrow(_refused, "order_id bigint"))
    return base.join(refused.withColumn("_failed", F.lit(True)), "order_id", "left").select(
        "order_id", "store_id", F.when(F.col("_failed"), "insufficient_stock").otherwise("ok").alias("result"))


def reservation_ledger(
    inventory: DataFrame, orders: DataFrame, items: DataFrame, verdicts: DataFrame, parts: int | None = None
) -> DataFrame:
    """The sale rows of the confirmed orders (result ``ok`` in ``verdicts``), with the stock after each."""
    served = orders.select("order_id", "store_id", "created_at").join(
        verdicts.filter(F.col("result") == "ok").select("order_id"), "order_id", "left_semi")
    sales = items.select("order_id", "order_item_id", "product_id", (-F.col("quantity")).alias("quantity_delta")).join(
        served, "order_id")
    run = with_running_total(
        sales, PAIR, ["created_at", "order_id", "order_item_id"], F.col("quantity_delta"), "_run", parts=parts)
    stock = inventory.groupBy(*PAIR).agg(F.sum("quantity_on_hand").alias("opening"))
    after = (F.coalesce("opening", F.lit(0)) + F.col("_run")).cast("bigint")
    return run.join(stock, PAIR, "left").select(
        "order_id", "order_item_id", *PAIR, F.lit("sale").alias("transaction_type"), "quantity_delta",
        after.alias("quantity_after"), F.col("created_at").alias("timestamp_occurred"))
