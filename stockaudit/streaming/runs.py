"""Reading table folders as streams, replaying stored tables in event-time order, running queries to the end of what is there."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockaudit.session import cut_lineage, new_folder

WATERMARK = "10 minutes"
#: Rows of one replayed slice, which is one micro-batch. It bounds what a Python state function sorts at a time.
SLICE_ROWS = 50_000_000
SLICES_SETTING = "spark.stockaudit.slices"


class LateRows(RuntimeError):
    """Rows that came after the watermark had passed them."""


def read_stream(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    """The parquet files under ``path`` as a stream; all files that are there are one micro-batch unless options say otherwise."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def keyed_state(spark: SparkSession) -> None:
    """State per key in RocksDB, of which a micro-batch's checkpoint holds the changes only; for queries started from here on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def zoned(df: DataFrame, ts: str) -> DataFrame:
    """Event time for watermarks, which need a zoned timestamp."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def zoneless(df: DataFrame) -> DataFrame:
    stamps = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields
              if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(stamps) if stamps else df


def run_to_table(stream: DataFrame, folder: str | None = None, refuse_late: bool = False) -> DataFrame:
    """Run an append query over everything available and return its stored output.

    ``folder`` holds output and checkpoint; running again with the same one resumes where the last run stopped.
    With ``refuse_late`` rows that come too late for the watermark are an error that counts them, not a silent loss.
    """
    spark = stream.sparkSession
    folder = folder or new_folder(spark, "stream")
    query = (
        stream.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    late = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    if late and refuse_late:
        raise LateRows(f"{late} rows came after the watermark; replay the input in event-time order")
    return zoneless(spark.read.schema(stream.schema).parquet(f"{folder}/out"))


def time_slices(df: DataFrame, ts: str, slices: int | None = None) -> list[DataFrame]:
    """``df`` cut by event time into slices that follow each other; rows of one time stay together, NULLs come first.

    The rows are stored in ranges of event time first, so that a slice reads its own files only.
    """
    spark = df.sparkSession
    staged = cut_lineage(df.repartitionByRange(ts).sortWithinPartitions(ts))
    n = slices or int(spark.conf.get(SLICES_SETTING, "0")) or max(1, math.ceil(staged.count() / SLICE_ROWS))
    if n == 1:
        return [staged]
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    shares = [i / n for i in range(1, n)]
    cuts = staged.agg(F.percentile_approx(F.timestamp_micros(micros), shares).alias("c")).first()["c"] or []
    cuts = sorted({c for c in cuts if c is not None})
    value = F.col(ts).cast("timestamp")
    edges = [None, *cuts, None]
    return [
        staged.filter((value.isNull() if lo is None else F.lit(False)) | (
            (F.lit(True) if lo is None else value > F.lit(lo)) & (F.lit(True) if hi is None else value <= F.lit(hi))))
        for lo, hi in zip(edges[:-1], edges[1:])
    ]


def replay(
    df: DataFrame, ts: str, run: Callable[[DataFrame, str], DataFrame], folder: str | None = None, slices: int | None = None
) -> DataFrame:
    """Feed a stored table to a stream slice by slice in event-time order.

    ``run`` gets the stream of the slices so far and the run's folder; its checkpoint there makes it go on where the
    slice before ended. However the table's files are laid out, no row comes after its watermark.
    """
    spark = df.sparkSession
    folder, out = folder or new_folder(spark, "replay"), None
    for part in time_slices(df, ts, slices):
        part.write.mode("append").option("compression", "zstd").parquet(f"{folder}/in")
        out = run(read_stream(spark, f"{folder}/in", df.schema), f"{folder}/run")
    return out


def replay_to_table(df: DataFrame, ts: str, build: Callable[[DataFrame], DataFrame], slices: int | None = None) -> DataFrame:
    """The stored output of an append query over a replayed table."""
    return replay(df, ts, lambda stream, folder: run_to_table(build(stream), folder, refuse_late=True), slices=slices)


def stored_state(spark: SparkSession, folder: str, variable: str | None = None) -> DataFrame:
    """What a stopped query keeps in the state store below ``folder``: a row per key, or per entry of one state variable.

    A variable that holds the entries of a bucket as columns gives a row for each, with the entry as ``key`` and ``value``.
    """
    reader = spark.read.format("statestore").option("path", f"{folder}/checkpoint")
    if not variable:
        return reader.load()
    held = reader.option("stateVarName", variable).load()
    value = "list_element" if "list_element" in held.columns else "value"
    names = held.schema[value].dataType.names
    if not all(isinstance(f.dataType, T.ArrayType) for f in held.schema[value].dataType.fields):
        return held
    entries = held.select(F.inline(F.arrays_zip(*[F.col(value)[n].alias(n) for n in names])).alias(*names))
    return entries.select(F.struct(*names).alias("key"), F.struct(*names).alias("value"))


def run_each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], folder: str) -> None:
    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
