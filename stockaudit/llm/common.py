"""What the operators of this subpackage share: tables, stored intermediate results, rows passed through Arrow."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockaudit.session import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder that all executors share, and read again: a lost executor costs a re-read."""
    folder = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def numbered(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a number for each row, written once: the number of a row that is read again depends on the cores at that time."""
    return stored(df.withColumn(column, F.monotonically_increasing_id()), "numbered")


def file_place() -> Column:
    """The file and the place in it that a row of a stored table comes from: the same for every reader, without a copy.

    For rows straight from the scan of a table; a row that an operator has made or repeated has no place of its own.
    """
    return F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def through_arrow(df: DataFrame, fields: str, work: Callable[[pa.RecordBatch], dict[str, pa.Array]],
                  most: int = 4 << 20) -> DataFrame:
    """``df``'s columns as they are, and those that ``work`` returns for each batch; a mask named ``keep`` drops rows.

    Batches have about ``most`` bytes, or one row.
    """
    extra = T.StructType.fromDDL(fields) if fields else T.StructType()
    schema = T.StructType([*df.schema.fields, *extra.fields])
    added = [f.name for f in extra.fields]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, most):
            made = work(batch)
            names = [*batch.schema.names, *added]
            out = pa.RecordBatch.from_arrays([*batch.columns, *(made[n] for n in added)], names=names)
            yield out.filter(made["keep"]) if "keep" in made else out

    return df.mapInArrow(each, schema)


def small(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes; a longer row is a slice of its own."""
    for batch in batches:
        rows = max(1, batch.num_rows * most // max(1, batch.nbytes))
        if rows >= batch.num_rows:
            yield batch
            continue
        start = 0
        while start < batch.num_rows:
            n = rows
            while n > 1 and batch.slice(start, n).nbytes > 2 * most:
                n //= 2
            yield batch.slice(start, n)
            start += n


def worker_state() -> dict:
    """What a worker process keeps from task to task. Functions travel by value, so their own globals live for one task."""
    return sys.modules.setdefault("stockaudit_worker_state", types.ModuleType("stockaudit_worker_state")).__dict__


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[str | None]:
    """The texts one by one, so that only one of them is a Python object at a time."""
    at = batch.column(batch.schema.names.index(column))
    return (x.as_py() for x in at)


def lower_ascii(column) -> Column:
    """A-Z lower-cased, every other character kept."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
