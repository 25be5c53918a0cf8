"""Exactly-once intake over any distance in time: rows are taken once by id, against an index of all ids taken before.

The index is the stored rows themselves plus small filters. Ids fall into hash buckets; each micro-batch leaves a Bloom
filter per bucket of the ids it took, and every so many batches their filters are merged into one per bucket. A batch probes the
filters of its buckets, and only the ids that some filter may hold are looked up among the rows of the batches that
the filter stands for; a filter that errs costs a look-up, not a row.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockaudit.sources.marks import mark, newest_mark, read_if_there
from stockaudit.streaming.runs import run_each_batch

#: A bucket's filters (BITS_PER_ID bits an id) and one batch's or merge's ids of a bucket must fit a task: 4,096 buckets do for 10^11 ids.
BUCKETS = 256
BITS_PER_ID = 16
HASHES = 8
COMPACT_AFTER = 50
FILTER = "bucket INT, first BIGINT, last BIGINT, bits BINARY"


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of each 64-bit hash in a filter of ``size`` bits, a row per hash."""
    x = hashes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    step = (x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(17) | np.uint64(1)
    return (x[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) % np.uint64(size)


def bloom(hashes: np.ndarray, bits_per_id: int = BITS_PER_ID) -> bytes:
    size = max(64, -(-len(hashes) * bits_per_id // 8) * 8)
    bits = np.zeros(size, bool)
    bits[_places(hashes, size).ravel()] = True
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    held = np.frombuffer(bits, np.uint8)
    at = _places(hashes, len(held) * 8)
    return ((held[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1).all(axis=1)


def take_once(stream: DataFrame, folder: str, key: str = "event_id", order: str = "ts", buckets: int = BUCKETS,
              compact_after: int = COMPACT_AFTER, bits_per_id: int = BITS_PER_ID) -> DataFrame:
    """Take every id of ``stream`` once, however late it comes again; returns the rows taken.

    Of the rows of one micro-batch with the same id, the one with the least ``order`` stays, ties going to the least row. Rows
    without an id can't be told apart and are all taken. A batch counts once its mark is set, so a batch
    that comes again after a stop is taken once too.
    """
    schema = stream.schema

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = newest_mark(spark, f"{folder}/marks")
        if last is not None and last.number >= batch_id:
            return
        fresh = first_of_each(batch, key, order)
        if last is not None:
            fresh = _unseen(fresh, folder, key, buckets, last)
        fresh.write.mode("overwrite").parquet(f"{folder}/rows/batch_id={batch_id}")
        version = last.version if last else -1
        _write_filters(spark, folder, schema, key, buckets, bits_per_id, batch_id, batch_id, "recent")
        if (batch_id + 1) % compact_after == 0:
            _write_filters(spark, folder, schema, key, buckets, bits_per_id, version + 1, batch_id, "merged")
            version = batch_id
        mark(spark, f"{folder}/marks", batch_id, version)

    run_each_batch(stream, fold, folder)
    return taken(stream.sparkSession, folder, schema)


def first_of_each(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per id, combined map-side, and every row without an id."""
    others = [c for c in rows.columns if c not in (key, order)]
    first = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(order, *others)).alias("_first"))
    return first.select(key, "_first.*").select(*rows.columns).unionByName(rows.where(F.col(key).isNull()))


def taken(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows of all finished batches; it may be read while others are written."""
    last = newest_mark(spark, f"{folder}/marks")
    if last is None:
        return spark.createDataFrame([], schema)
    return _rows(spark, folder, schema, 0, last.number)


def _rows(spark: SparkSession, folder: str, schema: T.StructType, first: int, last: int) -> DataFrame:
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(f"{folder}/rows")
    return stored.where(F.col("batch_id").between(first, last)).drop("batch_id")


def _hashed(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    h = F.xxhash64(key)
    return rows.where(F.col(key).isNotNull()).select(key, h.alias("_hash"), F.pmod(h, F.lit(buckets)).cast("int").alias("bucket"))


def _write_filters(spark, folder, schema, key, buckets, bits_per_id, first, last, kind) -> None:
    """The filters of the rows that the batches from ``first`` to ``last`` took."""
    def build(ids: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": ids["bucket"].iloc[:1], "first": [first], "last": [last],
                             "bits": [bloom(ids["_hash"].to_numpy(), bits_per_id)]})

    ids = _hashed(_rows(spark, folder, schema, first, last), key, buckets).select("bucket", "_hash")
    made = ids.groupBy("bucket").applyInPandas(build, FILTER)
    made.write.mode("overwrite").parquet(f"{folder}/filters/{kind}/upto={last}")


def candidates(fresh: DataFrame, folder: str, key: str, buckets: int, last: Row) -> DataFrame:
    """(id, first, last) for each id of ``fresh`` and each filter that may hold it."""
    spark = fresh.sparkSession
    ids = _hashed(fresh, key, buckets)
    schema = T.StructType([ids.schema[key], T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])

    def probe(new: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        found = [new.loc[:, [key]].head(0).assign(first=0, last=0)]
        hashes = new["_hash"].to_numpy()
        for first, upto, bits in zip(filters["first"], filters["last"], filters["bits"]) if len(hashes) else ():
            some = may_hold(bits, hashes)
            found.append(new.loc[some, [key]].assign(first=first, last=upto))
        return pd.concat(found)

    parts = [("merged", F.col("upto") <= last.version), ("recent", (F.col("upto") > last.version) & (F.col("upto") <= last.number))]
    there = [stored.where(chosen).drop("upto") for kind, chosen in parts
             if (stored := read_if_there(spark, f"{folder}/filters/{kind}", f"{FILTER}, upto BIGINT")) is not None]
    filters = reduce(DataFrame.unionByName, there)
    return ids.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(probe, schema)


def _unseen(fresh: DataFrame, folder: str, key: str, buckets: int, last: Row) -> DataFrame:
    spark, schema = fresh.sparkSession, fresh.schema
    # The candidates are needed twice: for the ranges of batches to read, a few per merge, and for the look-up.
    path = f"{folder}/candidates/batch_id={last.number + 1}"
    candidates(fresh, folder, key, buckets, last).write.mode("overwrite").parquet(path)
    found = spark.read.parquet(path)
    ranges = [(r["first"], r["last"]) for r in found.select("first", "last").distinct().collect()]
    if not ranges:
        return fresh
    wanted = reduce(lambda a, b: a | b, (F.col("batch_id").between(*r) for r in ranges))
    stored = spark.read.schema(T.StructType([schema[key], T.StructField("batch_id", T.LongType())])).parquet(f"{folder}/rows")
    seen = stored.where(wanted).select(key).join(found.select(key).distinct(), key, "left_semi")
    return fresh.join(seen, key, "left_anti")
