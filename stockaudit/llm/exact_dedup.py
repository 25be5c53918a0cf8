"""Exact duplicates by a persistent digest index (operator 12), in DataFrame and SQL functions only.

The index is a table of (digest, keep_id, keep_row, load), bucketed and sorted by the SHA-256 digest of the normalised text
(A-Z lower-cased). A load of new rows is reduced to one row per digest map-side, dealt out by the index's own buckets, and
compared with the index by a sort-merge anti-join that doesn't shuffle the index; what is new is appended as sorted files, one
per bucket, and ``compacted`` merges the files of many loads.
A text that the index knows keeps the row that entered first; of equal texts in one load the row with the largest id enters.

Rows learn their digest's fate by joins of narrow rows. Digests that hold more than a thousandth of all rows, a thousand
at most, are joined by broadcast; each of the others has too few rows to weigh on a task.

Defined results: a null text counts as empty, and empty texts are equal to each other. Null ids are smaller than all others.
Of rows with equal texts and the largest id more than once, one stays. Very long texts leave 32 bytes. Empty tables give
no rows and an empty index. Extra columns are not returned. An index outlives its session: ``open_index`` finds it by its folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockaudit.llm.common import lower_ascii, stored, table
from stockaudit.session import new_folder

ROWS_PER_BUCKET = 1_000_000
#: Loads of the registered query: the documents with the larger ids come first, so that the first to enter has the largest id.
LOADS = 2
#: Share of all rows from which a digest is hot; there are at most as many hot digests.
HOT = 1000


@dataclass(frozen=True)
class Index:
    """A digest index: its table in the session's catalog, its folder, its number of buckets."""

    spark: SparkSession
    name: str
    folder: str
    buckets: int

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)


def open_index(spark: SparkSession, folder: str | None = None, buckets: int = 16) -> Index:
    """The index in ``folder`` (a new one in the shared folder if none is named). ``buckets`` must be as at its creation."""
    folder = folder or new_folder(spark, "digest_index")
    name = f"digest_index_{uuid.uuid4().hex[:12]}"
    spark.sql(
        f"CREATE TABLE {name} (digest BINARY, keep_id BIGINT, keep_row BIGINT, load STRING) USING parquet "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{folder}'")
    return Index(spark, name, folder, buckets)


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(lower_ascii(F.coalesce(text, F.lit(""))), 256))


def digested(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, digest) of every row, stored, so that ``row`` names the same row to every reader."""
    return stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                              digest(F.col(text)).alias("digest")), "digests")


def reduced(rows: DataFrame, *by: str) -> DataFrame:
    """One row per digest (and ``by``): the row with the largest id and the number of rows, combined map-side."""
    first = F.struct(F.col("doc_id"), F.col("row"))
    return rows.groupBy(*by, "digest").agg(F.max(first).alias("first"), F.count(F.lit(1)).alias("n"))


def unknown(index: Index, new: DataFrame) -> DataFrame:
    """The rows of ``new`` that the index doesn't hold, by a sort-merge anti-join bucket by bucket.

    ``new`` has one row per digest and is a stored table: Spark moves an anti-join below a grouping, to rows not yet combined.
    """
    return new.repartition(index.buckets, "digest").join(index.entries().select("digest").hint("merge"), "digest", "left_anti")


def append(index: Index, new: DataFrame, load: str) -> None:
    """Adds the digests of ``new`` (digest, first) that the index doesn't hold yet. A load that is repeated adds nothing."""
    fresh = unknown(index, new).select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"),
                                       F.lit(load).alias("load"))
    fresh.write.insertInto(index.name)


def compacted(index: Index, folder: str | None = None, buckets: int | None = None) -> Index:
    """A new index with the same entries and one sorted file per bucket."""
    made = open_index(index.spark, folder, buckets or index.buckets)
    index.entries().repartition(made.buckets, "digest").write.insertInto(made.name)
    return made


def deduplicate(index: Index, docs: DataFrame, load: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Enters the documents into the index; (doc_id, keep_id, kept) of each: the row that stays, and whether it is this one."""
    rows = digested(docs, doc_id, text)
    new = stored(reduced(rows), "reduced")
    append(index, new, load)
    found = judged(index, rows.withColumn("load", F.lit(load)), new.select("digest", "n"))
    return found.select("doc_id", "keep_id", "kept")


def judged(index: Index, rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` (doc_id, row, digest, load) with keep_id, kept and group_size, by the index's entries and ``sizes`` (digest, n)."""
    total = rows.count()
    known = sizes.repartition(index.buckets, "digest").join(index.entries().hint("merge"), "digest")
    known = stored(known.select("digest", "keep_id", "keep_row", F.col("load").alias("keep_load"), "n"), "judged")
    is_hot = F.col("n") > max(1, total // HOT)
    hot = known.where(is_hot)  # fewer than ``HOT`` rows
    names = hot.select("digest", F.lit(True).alias("hot"))
    marked = rows.join(F.broadcast(names), "digest", "left")
    both = marked.where("hot").join(F.broadcast(hot), "digest").unionByName(
        marked.where("hot is null").join(known.where(~is_hot).hint("merge"), "digest"))
    kept = (F.col("load") == F.col("keep_load")) & (F.col("row") == F.col("keep_row"))
    return both.select("doc_id", "row", "digest", "load", "keep_id", F.col("n").alias("group_size"), kept.alias("kept"))


def exact_duplicates(docs: DataFrame, loads: int = LOADS, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Every document with the one that stays, entered into a new index in ``loads`` loads by descending id."""
    rows = digested(docs)
    span = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    low, high = span["low"] or 0, span["high"] or 0
    step = max(1, -(-(high - low + 1) // loads))
    number = F.coalesce(F.least(F.floor((F.lit(high) - F.col("doc_id")) / step), F.lit(loads - 1)), F.lit(loads - 1))
    rows = rows.withColumn("load", number.cast("string"))
    new = stored(reduced(rows, "load"), "reduced")  # at most one row per digest and load
    index = open_index(docs.sparkSession, buckets=max(1, -(-span["n"] // rows_per_bucket)))
    for load in range(loads):
        append(index, new.where(F.col("load") == str(load)), str(load))
    return judged(index, rows, new.groupBy("digest").agg(F.sum("n").alias("n")))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL = r"""
WITH rows AS (
  SELECT doc_id, row_number() OVER () AS row,
    sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST, row DESC) = 1 AS kept, text_sha256
FROM rows
"""
