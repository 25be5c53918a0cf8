"""Document fingerprints by threshold-scaled sketches (operator 10), in DataFrame functions only.

A fingerprint holds every shingle hash (five words, XXH64) below a fixed fraction of the hash range, so its size follows the
text's and fingerprints of very unequal texts stay comparable: the shares of common hashes estimate likeness and containment, and
the fingerprint of several texts is the union of theirs. A text with words but no hash below the fraction keeps its least
hash, so that short texts aren't all alike.

Defined results: null and empty texts and texts without words have an empty fingerprint; two empty ones are alike (1.0), an
empty and another one aren't (0.0). Fewer than five words are one shingle. In the edited texts' order null ids come last and equal
ids are ordered by the hash of their text, then by the place where they lie; a repeated row is a document of its own. A single
document is its own neighbour. Extra columns are not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockaudit.llm.common import file_place, lower_ascii, numbered, stored, table

SHINGLE = 5
FRACTION = 1 / 16


def with_fingerprint(docs: DataFrame, text: str, column: str, shingle: int = SHINGLE, fraction: float = FRACTION) -> DataFrame:
    """``docs`` and an array column: the kept shingle hashes of ``text``, ascending."""
    limit = -(1 << 63) + int((1 << 64) * fraction)
    words = F.filter(F.split(lower_ascii(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    out = docs.withColumn(column, words)
    count = F.size(column)
    hashes = F.transform(F.sequence(F.lit(1), F.greatest(count - (shingle - 1), F.lit(1))),
                         lambda i: F.xxhash64(F.slice(F.col(column), i, shingle)))
    out = out.withColumn(column, F.when(count > 0, hashes).otherwise(F.array().cast("array<bigint>")))
    few = F.array_sort(F.array_distinct(F.filter(column, lambda h: h < limit)))
    out = out.withColumn(column, F.struct(few.alias("few"), F.array_min(column).alias("least")))
    least = F.col(f"{column}.least")
    return out.withColumn(column, F.when((F.size(f"{column}.few") > 0) | least.isNull(), F.col(f"{column}.few")).otherwise(F.array(least)))


def likeness(a: Column, b: Column) -> Column:
    """Share of the hashes of either fingerprint that both have."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(both, F.lit(1)))


def containment(a: Column, b: Column) -> Column:
    """Share of the first fingerprint's hashes that the second has."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.lit(1)))


def merged(a: Column, b: Column) -> Column:
    """The fingerprint of both texts together."""
    return F.array_sort(F.array_union(a, b))


def written(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda h: F.lower(F.hex(h))), ",")


def neighbours(docs: DataFrame) -> DataFrame:
    """(uid, next_uid, doc_id, n_chars): each document and the next one by descending doc_id; the first follows the last.

    Ids are sorted over the cluster. Each sorted partition finds the next rows inside it; its last row's next is the first
    row of the partition behind it, found over one row per partition.
    """
    keys = docs.select("uid", "doc_id", F.xxhash64("text").alias("mark"), F.length("text").alias("n_chars"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("mark"), F.col("uid")]
    placed = stored(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "neighbours")
    inside = Window.partitionBy("part").orderBy(*order)
    rows = placed.select("uid", "doc_id", "n_chars", "part", F.lead("uid").over(inside).alias("after"),
                         F.row_number().over(inside).alias("place"))
    firsts = rows.where("place = 1").select("part", F.col("uid").alias("first"))
    over = Window.orderBy("part")  # one row per partition
    following = firsts.select("part", F.coalesce(
        F.lead("first").over(over), F.first("first").over(over.rowsBetween(Window.unboundedPreceding, 0))).alias("following"))
    return rows.join(following, "part").select("uid", F.coalesce("after", "following").alias("next_uid"), "doc_id", "n_chars")


def edited_likeness(docs: DataFrame, place: Column | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next document's.

    ``place`` tells each row from all others whenever it is read; without it a numbered copy of the documents is stored.
    """
    texts = ["doc_id", F.coalesce("text", F.lit("")).alias("text")]
    rows = numbered(docs.select(*texts), "uid") if place is None else docs.select(place.alias("uid"), *texts)
    to = neighbours(rows)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    texts = rows.select("uid", "text")
    given = texts.join(to.select(F.col("uid").alias("taker"), "next_uid", "doc_id", half.alias("half")), F.col("uid") == F.col("next_uid"))
    given = with_fingerprint(given, "text", "next_fp").select(
        "taker", "doc_id", "half", "next_fp", F.substring("text", F.lit(1), F.col("half")).alias("tail"))
    whole = texts.join(given, F.col("uid") == F.col("taker"))
    whole = whole.select("doc_id", "text", "next_fp", F.length("text").cast("long").alias("n_chars"), F.concat(
        F.substring("text", F.lit(1), F.length("text") - F.col("half")), F.col("tail")).alias("edited"))
    whole = with_fingerprint(with_fingerprint(whole, "text", "fp"), "edited", "edited_fp")
    return whole.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), written(F.col("fp")).alias("fingerprint"),
        written(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


def op10_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents"), file_place())
