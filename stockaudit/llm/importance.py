"""Importance resampling towards a target distribution over hashed word n-grams (operator 11).

Features are the runs of up to ``n_gram`` words of a text; a feature's bucket is its CRC-32 modulo ``buckets``, taken from a
position table for all features of a block of texts at once (see ``position_crc``). Every map task counts its features per
bucket, so that only ``buckets`` numbers leave it. A bucket's gain is the scaled log ratio of its smoothed shares in
the target and in the corpus; a document's weight is the sum over its features. Adding Gumbel noise that depends on the
document's id alone and keeping the highest scores draws without replacement in proportion to the exponential weights.

Ranks come from a sort over the cluster: rows are dealt out in ranges of the order, each range is numbered where it lies, and
the ranges' sizes (one row each) give the number of rows before them.

Defined results: a null or empty text, and one without words, has no features and weight 0. Null ids draw the noise of the
empty string and come after all others at equal scores. Rows of equal score and id are told apart by the place where
they were read, so a repeated row is drawn as often as it is there. Empty tables give no rows; with an empty target all
buckets are judged by smoothing alone. Other columns are kept by ``with_weights`` and ``resample``; where ``docs`` has
columns of the new names, the new ones are lengthened by ``_``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockaudit.llm.common import free_name, small, stored, table, worker_state
from stockaudit.llm.position_crc import PositionCrc

BUCKETS = 10_000
N_GRAM = 1
PERCENT = 10
MIN_WORDS = 20
SEED = 2024

_B = np.arange(256)
_LOWER = np.where((_B >= 65) & (_B <= 90), _B + 32, _B).astype(np.uint8)
# Of lower-cased UTF-8 bytes: digits, letters and all of a character beyond ASCII.
_IN_WORD = ((_B >= 48) & (_B <= 57)) | ((_B >= 97) & (_B <= 122)) | (_B >= 128)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins (and the last ends); a null is empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, start and size of every word, and the number of words before each text (and in all)."""
    low = _LOWER[data]
    inside = _IN_WORD[low]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    real = at[:-1][at[:-1] < at[1:]]  # a word ends with its text
    begins[real] |= inside[real]
    before = real[real > 0] - 1
    ends[before] |= inside[before]
    starts = np.flatnonzero(begins)
    return low, starts, np.flatnonzero(ends) + 1 - starts, np.searchsorted(starts, at)


def buckets_of(column: pa.Array, n_gram: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features text by text, the number of features before each text (and in all), and of words."""
    known = worker_state()
    if "position_crc" not in known:
        known["position_crc"] = PositionCrc()
    crc = known["position_crc"]
    low, starts, sizes, upto = words_of(*bytes_of(column))
    if n_gram == 1:
        return (crc.of(low, starts, sizes) % np.uint32(buckets)).astype(np.int64), upto, upto
    # Words with a space behind each: a run of words is then a stretch of bytes.
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1
    place = np.arange(ends[-1] if len(ends) else 0)
    source = np.minimum(np.repeat(starts - begins, sizes + 1) + place, max(0, len(low) - 1))
    spaced = low[source] if len(low) else low
    spaced[ends - 1] = 32
    text = np.repeat(np.arange(len(upto) - 1), np.diff(upto))
    found, owner = [], []
    for n in range(1, n_gram + 1):
        first = np.flatnonzero(text[:len(text) - n + 1] == text[n - 1:]) if len(text) >= n else np.zeros(0, np.int64)
        found.append(crc.of(spaced, begins[first], ends[first + n - 1] - 1 - begins[first]))
        owner.append(text[first])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    made = (np.concatenate(found)[order] % np.uint32(buckets)).astype(np.int64)
    return made, np.searchsorted(owner[order], np.arange(len(upto))), upto


def bucket_counts(docs: DataFrame, text: str = "text", n_gram: int = N_GRAM, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): occurrences of features per bucket over all rows; each task hands on one row per bucket at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in small(batches):
            total += np.bincount(buckets_of(batch.column(0), n_gram, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return docs.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Scaled log ratio of every bucket from the counts (bucket, n) of both sides: ``buckets`` rows reach the driver."""
    def array(counts: DataFrame) -> list[float]:
        out = [0.0] * buckets
        for r in counts.collect():
            out[r["bucket"]] = float(r["n"])
        return out

    s, t = array(corpus), array(target)
    in_all, in_target = sum(s) + buckets, sum(t) + buckets
    return np.array([math.floor(1000 * math.log((y + 1) * in_all / ((x + 1) * in_target))) for x, y in zip(s, t)], np.int64)


def with_weights(docs: DataFrame, gain: np.ndarray, text: str = "text", n_gram: int = N_GRAM, keep_text: bool = True,
                 names: tuple[str, str, str] = ("n_words", "n_features", "weight")) -> DataFrame:
    """``docs`` (without its text, if asked) and three columns: words, features, and the sum of the features' gains."""
    columns = [c for c in docs.columns if keep_text or c != text]
    names = tuple(free_name(docs, n) for n in names)
    schema = T.StructType([*docs.select(*columns).schema.fields, *(T.StructField(n, T.LongType()) for n in names)])
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # a number per bucket

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            gain = sent.value
            made, upto, words = buckets_of(batch.column(batch.schema.names.index(text)), n_gram, len(gain))
            total = np.concatenate([[0], np.cumsum(gain[made])])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.names.index(c)) for c in columns),
                 *(pa.array(x) for x in (np.diff(words), np.diff(upto), total[upto[1:]] - total[upto[:-1]]))],
                names=[*columns, *names])

    return docs.mapInArrow(weigh, schema)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Scaled Gumbel noise of an id, always the same."""
    marked = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(marked, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """``rows`` (a stored table) and each one's place, from 1, in the order over all of them; no task sees more than one range."""
    place, before = free_name(rows, "place"), free_name(rows, "before")
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id of a row is its range's number, shifted by 33 bits, and its place in the range.
    placed = stored(ranged.withColumn(place, F.monotonically_increasing_id()), "ranges")
    part = F.shiftright(place, 33)
    sizes = [(r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()]
    starts, total = {}, 0  # one number per range
    for p, n in sorted(sizes):
        starts[p], total = total, total + n
    offsets = rows.sparkSession.createDataFrame(list(starts.items()), f"`{before}_part` long, `{before}` long")
    return placed.join(F.broadcast(offsets), part == F.col(f"{before}_part")).withColumn(
        rank, F.col(before) + F.col(place).bitwiseAND((1 << 33) - 1) + 1).drop(place, before, f"{before}_part")


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` (doc_id, n_words, score and others, a stored table) with ``rank``: 1, 2, 3… for the drawn rows, else null."""
    uid = free_name(scored, "uid")
    enough = F.col("n_words") >= min_words
    n = scored.where(enough).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col(uid)]
    # The row's place only tells rows apart that are equal in score and id.
    run = ranked(scored.where(enough).withColumn(uid, F.monotonically_increasing_id()), order, "rank").drop(uid)
    run = run.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    return run.unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))


def scored(docs: DataFrame, target: DataFrame, n_gram: int = N_GRAM, buckets: int = BUCKETS, seed: int = SEED,
           keep_text: bool = True) -> DataFrame:
    """``docs`` with n_words, n_features, weight and score, stored: texts are read twice, to count and to weigh."""
    gain = gains(bucket_counts(docs, "text", n_gram, buckets), bucket_counts(target, "text", n_gram, buckets), buckets)
    rows = with_weights(docs, gain, "text", n_gram, keep_text)
    return stored(rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, n_gram: int = N_GRAM,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """The drawn rows of ``docs`` with their own columns, ``percent`` of those with ``min_words`` words."""
    kept = {c: f"own_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(F.col("doc_id"), F.col("text"), F.struct("*").alias("own"))
    return draw(scored(inner, target, n_gram, buckets, seed), percent, min_words).where("rank is not null").select(
        *(F.col("own")[c].alias(c) for c in kept))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scored(docs, table(spark, sf_dir, "benchmark").select("text"), keep_text=False)
    return draw(rows).select("doc_id", "n_features", "weight", "score", "rank")


SQL = r"""
WITH crc_steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(
    list_prepend(CAST(b AS BIGINT), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps
), corpus AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), uses AS (
  SELECT row, unnest(w) AS word FROM corpus
), aims AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), spelt AS (
  SELECT word, list_transform(range(1, CAST(octet_length(encode(word)) AS BIGINT) + 1),
    lambda i: CAST('0x' || substring(hex(encode(word)), 2 * i - 1, 2) AS BIGINT)) AS bytes
  FROM (SELECT word FROM uses UNION SELECT word FROM aims) x
), placed AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
    lambda c, b: xor(steps[CAST(xor(c, b) % 256 AS BIGINT) + 1], c // 256)), 4294967295) % 10000 AS bucket
  FROM spelt CROSS JOIN crc_steps
), counts AS (
  SELECT bucket, CAST(sum(s) AS DOUBLE) AS s, CAST(sum(t) AS DOUBLE) AS t
  FROM (SELECT word, 1 AS s, 0 AS t FROM uses UNION ALL SELECT word, 0, 1 FROM aims) x JOIN placed USING (word)
  GROUP BY bucket
), gained AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
  FROM counts
), weighed AS (
  SELECT row, count(*) AS n_features, sum(gain) AS weight
  FROM uses JOIN placed USING (word) JOIN gained USING (bucket) GROUP BY row
), scores AS (
  SELECT doc_id, row, coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substring(
      sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM corpus LEFT JOIN weighed USING (row)
), drawn AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, row) AS rank, count(*) OVER () AS n
  FROM scores WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (10 * n) // 100 THEN rank END AS rank
FROM scores LEFT JOIN drawn USING (row)
"""
