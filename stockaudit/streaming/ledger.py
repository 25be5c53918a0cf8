"""The stock ledger as a stream: guarded running stock, an upserted stock table, resumable runs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stockaudit.operators.ordered import _position
from stockaudit.sources.marks import mark, newest_mark
from stockaudit.streaming.lifecycle import bucket_of, default_buckets
from stockaudit.streaming.runs import keyed_state, run_each_batch

PAIR = ["store_id", "product_id"]
LOW_STOCK = 20
COMPACT_AFTER = 50
STOCK = "store_id INT, product_id BIGINT, stock BIGINT"
_NULLABLE = {"store": "store_id", "product": "product_id", "id": "id", "ts": "ts", "delta": "delta"}


class BucketStock(StatefulProcessor):
    """The stock of the (store, product) pairs of a bucket: a log of the pairs that each micro-batch moved, the last entry counts.

    A log with more than twice as many entries as there are pairs is written anew, so that reading it stays in proportion.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stock = handle.getListState("stock", "store_id ARRAY<INT>, product_id ARRAY<BIGINT>, stock ARRAY<BIGINT>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known, entries = {}, 0
        for stores, products, stocks in self.stock.get():
            known.update(zip(zip(stores, products), stocks))
            entries += len(stocks)
        # The movements of a bucket in one micro-batch; the size of a slice bounds them.
        moves = pd.concat(list(rows)).sort_values(["no_ts", "ts", "no_id", "id"], ascending=[False, True, False, True], kind="stable")
        if moves["no_delta"].any():
            raise ValueError("a movement without a delta")
        moved, after, results, low = {}, [], [], []
        for store, product, no_store, no_product, kind, delta, point in zip(*(moves[c].tolist() for c in (
                "store_id", "product_id", "no_store", "no_product", "kind", "delta", "reorder_point"))):
            pair = (None if no_store else store, None if no_product else product)
            stock = moved[pair] if pair in moved else known.get(pair, 0)
            new, result = stock + delta, "ok"
            if new < 0 and kind == "sale":
                new, result = stock, "insufficient_stock"
            elif new < 0 and kind == "adjustment":
                new, result = 0, "clamped"
            after.append(new)
            results.append(result)
            low.append(new < point <= stock)
            moved[pair] = new
        moved = {p: stock for p, stock in moved.items() if p not in known or known[p] != stock}
        if entries > 2 * len(known) + 64:
            self.stock.put([_columns(known | moved)])
        elif moved:
            self.stock.appendValue(_columns(moved))
        yield moves[[*PAIR, "no_store", "no_product", "id", "no_id"]].assign(quantity_after=after, result=results, low_stock=low)

    def close(self) -> None:
        pass


def _columns(stock: dict) -> tuple[list, list, list]:
    return [store for store, _ in stock], [product for _, product in stock], list(stock.values())


def stock_ledger(
    movements: DataFrame, reorder_points: DataFrame | None = None, low_stock: int = LOW_STOCK, buckets: int | None = None,
) -> DataFrame:
    """Running stock per (store, product) over movements (…, id, kind, delta, ts).

    A sale that exceeds the stock is rejected, an adjustment stops at 0, anything else applies.
    ``low_stock`` marks the row on which stock falls below the reorder point. State lies in hash buckets of pairs, so that one
    Python call serves all pairs of a bucket; a micro-batch reads the buckets that it meets and writes the pairs that it moves.
    """
    if reorder_points is not None:
        movements = movements.join(reorder_points.select(*PAIR, "reorder_point"), PAIR, "left")
    point = F.col("reorder_point") if reorder_points is not None else F.lit(None)
    filled = lambda c: F.coalesce(c, F.lit(0))
    ts = _position("ts", movements.schema["ts"].dataType)
    keyed_state(movements.sparkSession)
    rows = movements.select(  # numbers without NULLs, which pandas would turn into floats
        bucket_of(*PAIR, buckets=buckets or default_buckets(movements)), *[filled(F.col(c)).alias(c) for c in (*PAIR, "id", "delta")],
        filled(ts).alias("ts"), "kind", F.coalesce(point, F.lit(low_stock)).cast("int").alias("reorder_point"),
        *[F.col(c).isNull().alias(f"no_{name}") for name, c in _NULLABLE.items()])
    found = rows.groupBy("bucket").transformWithStateInPandas(
        BucketStock(), "store_id INT, product_id BIGINT, no_store BOOLEAN, no_product BOOLEAN, id BIGINT, no_id BOOLEAN, "
        "quantity_after BIGINT, result STRING, low_stock BOOLEAN", "append", "none")
    own = [F.when(~F.col(f"no_{name}"), F.col(c)).alias(c) for name, c in _NULLABLE.items() if c in (*PAIR, "id")]
    return found.select(*own, "quantity_after", "result", "low_stock")


def upsert_inventory(movements: DataFrame, folder: str, compact_after: int = COMPACT_AFTER) -> DataFrame:
    """Fold movements into a stock table, one summed delta per pair and micro-batch.

    A micro-batch costs what it brings, not the size of the table. Every ``compact_after`` batches the deltas so far become a
    version of the whole table, named by its last batch, so that a read takes one version and few deltas. A batch
    counts once its mark is set, after everything it writes: readers never see half a batch or version, a batch that
    stopped before its mark is written again, and one that comes again after it changes nothing.
    """
    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = newest_mark(spark, f"{folder}/marks")
        if last is not None and last.number >= batch_id:
            return
        (batch.groupBy(*PAIR).agg(F.sum("delta").alias("delta"))
         .write.mode("overwrite").parquet(f"{folder}/stock/batch_id={batch_id}"))
        version = last.version if last else -1
        if (batch_id + 1) % compact_after == 0:
            _stock(spark, folder, version, batch_id).write.mode("overwrite").parquet(f"{folder}/version/upto={batch_id}")
            version = batch_id
        mark(spark, f"{folder}/marks", batch_id, version)

    run_each_batch(movements, fold, folder)
    return stock_table(movements.sparkSession, folder)


def stock_table(spark: SparkSession, folder: str, upto: int | None = None) -> DataFrame:
    """Stock per pair after the newest finished batch, or after batch ``upto``; it may be read while batches are written."""
    last = newest_mark(spark, f"{folder}/marks")
    if last is None:
        return spark.createDataFrame([], STOCK)
    if upto is None or upto > last.number:
        return _stock(spark, folder, last.version, last.number)
    before = newest_mark(spark, f"{folder}/marks", upto - 1)
    return _stock(spark, folder, before.version if before else -1, upto)


def _stock(spark: SparkSession, folder: str, version: int, upto: int) -> DataFrame:
    """Stock per pair: a version (none: -1) and the deltas of the batches behind it."""
    deltas = spark.read.schema("store_id INT, product_id BIGINT, delta BIGINT, batch_id BIGINT").parquet(f"{folder}/stock")
    deltas = deltas.filter((F.col("batch_id") > version) & (F.col("batch_id") <= upto)).select(*PAIR, "delta")
    if version >= 0:
        known = spark.read.schema(STOCK).parquet(f"{folder}/version/upto={version}")
        deltas = deltas.unionByName(known.withColumnRenamed("stock", "delta"))
    return deltas.groupBy(*PAIR).agg(F.sum("delta").alias("stock"))
