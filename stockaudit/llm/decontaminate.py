"""Benchmark decontamination by suffix arrays over the training text (operator 1).

The documents of a task are cut into shards of about ``SHARD_BYTES``; a longer document is a shard in several overlapping parts.
Each shard gets a suffix array of its words. Every suffix of every benchmark item is looked up in it by binary search,
which gives its longest verbatim match and where that lies. Where the match covers a window (``window`` words, or a whole
shorter item), the window's interval of the array lists all its occurrences, and their words are hit.

The benchmark is a query set: it is read in blocks of about ``BLOCK_BYTES``, each broadcast on its own, and a block's hits are
merged with those of the blocks before. Its size is counted first. Words that no item of the block has get number 0,
which matches nothing, so suffixes start at the other words only.

Defined results: null and empty texts have no words and no hits. An item without words has no window. Items that share an
id count once; a null id is written as the empty string. Repeated documents are judged one by one. An empty benchmark
hits nothing. Columns of the documents stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockaudit.llm.common import free_name, small, table, texts_of, through_arrow

WINDOW = 10
SHARD_BYTES = 12 << 20
SHARD_WORDS = 2 << 20
BLOCK_BYTES = 4 << 20

#: Lower-cases ASCII letters, keeps digits and all bytes from 0x80 on, makes the rest spaces.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class Items:
    """A block of benchmark items: their words as numbers from 1 on, one after the other with a 0 behind each."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.names = [i for i, _ in items]
        rows = [[number(w) for w in words_of(t)] for _, t in items]
        self.words = np.array([x for r in rows for x in [*r, 0]] + [0] * 64, np.int64)
        sizes = np.array([len(r) for r in rows], np.int64)
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        self.at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, sizes)] or [np.zeros(0)]).astype(np.int64)
        self.item = np.repeat(np.arange(len(rows)), sizes)
        self.offset = self.at - starts[self.item] if len(self.at) else self.at
        self.left = sizes[self.item] - self.offset if len(self.at) else self.at  # words to the item's end
        self.need = np.where(sizes < window, sizes, window)[self.item] if len(self.at) else self.at
        self.is_window = (self.left >= self.need) & ((self.offset == 0) | (self.need == window)) if len(self.at) else self.at > 0
        self.longest = int(sizes.max()) if len(sizes) else 0
        self.bits = max(1, len(self.vocabulary).bit_length())


class SuffixArray:
    """The suffixes of a shard's words (0 ends one), sorted up to ``depth`` words; those at a 0 are left out."""

    def __init__(self, words: np.ndarray, bits: int, depth: int):
        per = max(1, 62 // bits)
        n = len(words)
        self.words = np.concatenate([words, np.zeros(depth + per + 1, np.int64)])
        stops = np.flatnonzero(self.words == 0)
        run = stops[np.searchsorted(stops, np.arange(n))] - np.arange(n)  # words before the next 0
        key = np.zeros(n, np.int64)
        for j in range(per):
            key = (key << bits) | np.where(run > j, self.words[j:n + j], 0)
        at = np.flatnonzero(words)
        order = np.argsort(key[at], kind="stable")
        self.at, self.per, self.bits = at[order], per, bits
        self.keys = key[self.at]
        first = np.concatenate([[True], self.keys[1:] != self.keys[:-1]]) if len(at) else np.zeros(0, bool)
        start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0)) if len(at) else at
        rank = np.zeros(n + depth + per + 1, np.int64)
        rank[self.at] = start + 1
        h = per
        while h < depth:
            tied = np.zeros(len(self.at), bool)
            same = start[1:] == start[:-1]
            tied[1:] |= same
            tied[:-1] |= same
            place = np.flatnonzero(tied & (run[self.at] >= h))
            if not len(place):
                break
            these = self.at[place]
            base, after = start[place], rank[these + h]
            order = np.lexsort((after, base))
            these, base, after = these[order], base[order], after[order]
            self.at[place] = these
            new = np.concatenate([[True], (base[1:] != base[:-1]) | (after[1:] != after[:-1])])
            start[place] = np.maximum.accumulate(np.where(new, place, 0))
            rank[these] = start[place] + 1
            h *= 2

    def search(self, query: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query[at:at + size], the first suffix not below it, and the first above all that start with it."""
        low, high = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for j in range(self.per):
            word = np.where(j < size, query[np.minimum(at + j, len(query) - 1)], 0)
            low, high = (low << self.bits) | word, (high << self.bits) | np.where(j < size, word, (1 << self.bits) - 1)
        lower = np.searchsorted(self.keys, low)
        upper = np.searchsorted(self.keys, high, side="right")
        more = np.flatnonzero((upper > lower) & (size > self.per))
        if len(more):
            a, z = at[more], size[more]
            edges = []
            for above in (False, True):
                lo, hi = lower[more].copy(), upper[more].copy()
                while (open_ := lo < hi).any():
                    mid = (lo + hi) // 2
                    k = np.flatnonzero(open_)
                    order, _ = self.compare(self.at[mid[k]], query, a[k], z[k])
                    right = order < 0 if not above else order <= 0
                    lo[k] = np.where(right, mid[k] + 1, lo[k])
                    hi[k] = np.where(right, hi[k], mid[k])
                edges.append(lo)
            lower[more], upper[more] = edges
        return lower, upper

    def compare(self, text: np.ndarray, query: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order (-1, 0, 1) of each suffix, cut at the query's size, against the query; and the words they share."""
        order, shared = np.zeros(len(at), np.int8), np.zeros(len(at), np.int64)
        going, j = np.flatnonzero(size > 0), 0
        while len(going):
            a, b = self.words[text[going] + j], query[at[going] + j]
            same = a == b
            order[going[~same]] = np.where(a < b, -1, 1)[~same]
            going, j = going[same], j + 1
            shared[going] = j
            going = going[size[going] > j]
        return order, shared

    def longest(self, query: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of the longest match of each query suffix, and a position of it (-1 without one)."""
        words, place = np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64)
        if not len(self.at):
            return words, place
        near, _ = self.search(query, at, size)
        for k in (near, near - 1):  # the longest match is next to the suffix's own place
            k = np.clip(k, 0, len(self.at) - 1)
            _, shared = self.compare(self.at[k], query, at, size)
            better = shared > words
            words[better], place[better] = shared[better], self.at[k[better]]
        return words, place


def _parts(numbers: np.ndarray, overlap: int) -> Iterator[tuple[int, np.ndarray]]:
    """A document's words in parts of at most SHARD_WORDS that share ``overlap`` words."""
    step = max(1, SHARD_WORDS - overlap)
    for start in range(0, max(1, len(numbers) - overlap), step):
        yield start, numbers[start:start + SHARD_WORDS]


def _shards(items: Items, texts: Iterator[str | None]):
    """(n_words by row, shards of (row, first word, numbers)) of a batch."""
    known = items.vocabulary.get
    counts, shards, size = [], [[]], 0
    for row, text in enumerate(texts):
        words = words_of(text)
        counts.append(len(words))
        numbers = np.fromiter((known(w, 0) for w in words), np.int64, len(words))
        for first, part in _parts(numbers, max(0, items.longest - 1)):
            if size and size + len(part) > SHARD_WORDS:
                shards.append([])
                size = 0
            shards[-1].append((row, first, part))
            size += len(part) + 1
    return counts, shards


def _joined(shard) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) + 1 for *_, p in shard], np.int64)
    whole = np.zeros(sizes.sum(), np.int64)
    starts = np.cumsum(sizes) - sizes
    for s, (*_, p) in zip(starts, shard):
        whole[s:s + len(p)] = p
    return whole, starts


def _hits(items: Items, shard) -> tuple[np.ndarray, np.ndarray, set[tuple[int, int]]]:
    """Of one shard: where its parts start, whether each word is hit, and the pairs (part, item)."""
    whole, starts = _joined(shard)
    hit = np.zeros(len(whole) + 1, np.int64)
    array = SuffixArray(whole, items.bits, items.longest)
    longest, _ = array.longest(items.words, items.at, items.left)
    found = np.flatnonzero(items.is_window & (longest >= items.need))
    pairs: set[tuple[int, int]] = set()
    if len(found):
        need = items.need[found]
        low, high = array.search(items.words, items.at[found], need)
        seen: dict[tuple[int, int], np.ndarray] = {}
        for q, n, a, z in zip(found.tolist(), need.tolist(), low.tolist(), high.tolist()):
            if (a, z) not in seen:  # items may share a window
                at = array.at[a:z]
                np.add.at(hit, at, 1)
                np.add.at(hit, at + n, -1)
                seen[a, z] = np.unique(np.searchsorted(starts, at, side="right") - 1)
            pairs.update((p, int(items.item[q])) for p in seen[a, z].tolist())
    return starts, np.cumsum(hit)[:-1] > 0, pairs


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t")).where("t is not null")
    items = items.distinct()  # repeated rows would share a block, however many they are
    size = items.agg(F.sum(F.octet_length("t") + F.octet_length("i"))).first()[0] or 0
    if size <= block_bytes:
        yield [tuple(r) for r in items.collect()]
        return
    n = math.ceil(2 * size / block_bytes)
    for b in range(n):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b).collect()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
                       block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` and, per row, the count of words, of hit words, a bitmap of hit words, and the sorted ids of the items.

    Also returns the names that these columns got: n_words, n_hit, hits, items, each lengthened where the documents
    have such a column.
    """
    spark = docs.sparkSession
    names = {n: free_name(docs, n) for n in ("n_words", "n_hit", "hits", "items")}
    out, earlier = docs, None
    for block in _blocks(benchmark, "item_id", "text", block_bytes):
        out, now = _one_block(spark, out, block, window, text, earlier)
        earlier = now
    return out.select(*docs.columns, *(F.col(earlier[n]).alias(names[n]) for n in names)), names


def _one_block(spark, docs, block, window, text, earlier):
    sent = spark.sparkContext.broadcast(block)  # about BLOCK_BYTES
    now = {n: free_name(docs, f"{n}_") for n in ("n_words", "n_hit", "hits", "items")}
    before = earlier and {n: earlier[n] for n in ("hits", "items")}

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        items = Items(sent.value, window)
        counts, shards = _shards(items, texts_of(batch, text))
        hit: list[np.ndarray | None] = [None] * len(counts)
        named: list[set[str]] = [set() for _ in counts]
        if before:
            column = lambda n: batch.column(batch.schema.names.index(before[n]))
            for row, (bits, ids) in enumerate(zip(column("hits").to_pylist(), column("items").to_pylist())):
                if ids:
                    hit[row] = np.unpackbits(np.frombuffer(bits, np.uint8), count=counts[row]).astype(bool)
                    named[row].update(ids)
        for shard in shards:
            if not shard or not items.longest:
                continue
            starts, covered, pairs = _hits(items, shard)
            for part in {p for p, _ in pairs}:
                row, first, numbers = shard[part]
                if hit[row] is None:
                    hit[row] = np.zeros(counts[row], bool)
                hit[row][first:first + len(numbers)] |= covered[starts[part]:starts[part] + len(numbers)]
            for part, item in pairs:
                named[shard[part][0]].add(items.names[item])
        return {
            now["n_words"]: pa.array(counts, pa.int64()),
            now["n_hit"]: pa.array([0 if h is None else int(h.sum()) for h in hit], pa.int64()),
            now["hits"]: pa.array([b"" if h is None else np.packbits(h).tobytes() for h in hit], pa.binary()),
            now["items"]: pa.array([sorted(n) for n in named], pa.list_(pa.string())),
        }

    fields = f"`{now['n_words']}` long, `{now['n_hit']}` long, `{now['hits']}` binary, `{now['items']}` array<string>"
    made = through_arrow(docs, fields, work, SHARD_BYTES)
    return (made.drop(*earlier.values()) if earlier else made), now


def longest_matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, offset, words, doc_id, word: of every benchmark suffix with a match, the longest and one place of it."""
    spark, found = docs.sparkSession, None
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    for block in _blocks(benchmark, "item_id", "text", block_bytes):
        sent = spark.sparkContext.broadcast(block)

        def each(batches, sent=sent):
            items = Items(sent.value, WINDOW)
            for batch in small(batches, SHARD_BYTES):
                ids = batch.column(0).to_pylist()
                for shard in _shards(items, texts_of(batch, "text"))[1]:
                    whole, starts = _joined(shard)
                    words, place = SuffixArray(whole, items.bits, items.longest).longest(items.words, items.at, items.left)
                    k = np.flatnonzero(words)
                    part = np.searchsorted(starts, place[k], side="right") - 1
                    yield pa.RecordBatch.from_arrays([
                        pa.array([items.names[i] for i in items.item[k]], pa.string()), pa.array(items.offset[k]),
                        pa.array(words[k]), pa.array([ids[shard[p][0]] for p in part], pa.string()),
                        pa.array(np.array([shard[p][1] for p in part], np.int64) + place[k] - starts[part]),
                    ], names=["item_id", "offset", "words", "doc_id", "word"])

        made = rows.mapInArrow(each, "item_id string, offset long, words long, doc_id string, word long")
        found = made if found is None else found.union(made)
    best = F.max_by(F.struct("words", "doc_id", "word"), F.struct("words", "doc_id", "word")).alias("best")
    return found.groupBy("item_id", "offset").agg(best).select("item_id", "offset", "best.*")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pipeline stage: the documents without any hit word, with their own columns."""
    found, names = find_contamination(docs, benchmark, window)
    return found.where(F.col(names["n_hit"]) == 0).select(*docs.columns)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, _ = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH parted AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM items WHERE len(w) > 0) x
), windows AS (
  SELECT row, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM parted CROSS JOIN (SELECT DISTINCT n FROM item_windows) s) x
), hits AS (
  SELECT row, i, n, item_id FROM windows JOIN item_windows USING (n, words)
), found AS (
  SELECT row, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS names
  FROM hits GROUP BY row
), covered AS (
  SELECT row, count(DISTINCT word) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS word FROM hits) x GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM parted LEFT JOIN found USING (row) LEFT JOIN covered USING (row)
"""
