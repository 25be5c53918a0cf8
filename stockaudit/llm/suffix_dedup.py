"""Removal of repeated byte strings with a run-length index (operator 2).

Every byte covered by a string of ``LENGTH`` bytes that also starts somewhere else goes. The work is brought together by content:

1. Each window of ``LENGTH`` bytes owns an anchor, the place of the least hash of ``GRAM`` bytes among its first ``SAMPLE``
   starts. Equal windows have their anchor at the same place, and the ``LENGTH - SAMPLE + 1`` bytes from the anchor on
   lie in all of them: their hash is the anchor's key. Anchors whose key occurs once have no repeated window.
2. An anchor's reach is the text of all windows that own it. Equal reaches are copies: they count as one text with a
   multiplicity, as a run does in the index, and all their windows are repeated. Both hashes have 64 bits.
3. Of anchors that share a key and differ in reach, one of each reach goes to the index: bytes in front of the anchor, one symbol
   for the shared bytes, bytes behind them. Blocks of such strings, whole keys together, become a run-compressed
   Burrows-Wheeler transform with sampled run ends (``rlbwt``). Its matching statistics say for each window whether a
   match of its whole length starts elsewhere.
4. A key with more than ``GROUP`` reaches is split before: windows that start in the outer half of the places before the anchor share
   the bytes of the inner half, the others share bytes behind. Each half is keyed by these bytes, halves that
   meet no other are done, and larger ones are split again. No group is gathered beyond ``GROUP``, none is dropped.
5. The intervals of window starts come back to their documents, which are cut and digested.

Nothing but counts reaches the driver. Documents are numbered as they are read, so they should be a stored table.

Defined results: null and empty texts have no bytes. Repeated rows are documents of their own, so a text of ``LENGTH`` bytes
or more that occurs in two rows goes entirely. Extra columns are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockaudit.llm.common import numbered, small, stored, table, texts_of
from stockaudit.llm.pieces import powers
from stockaudit.llm.rlbwt import RunLengthIndex

LENGTH = 400
SAMPLE = 192
GRAM = 16
GROUP = 2048
INDEX_SYMBOLS = 1 << 19
_BLOCK = 1 << 20

_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


class Hasher:
    """64-bit hashes of stretches of a block of bytes, from running sums."""

    values = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)

    def __init__(self):
        self.up, self.down = powers(1 << 16, _BASE), powers(1 << 16, _INVERSE)

    def sums(self, b: np.ndarray) -> np.ndarray:
        if len(self.up) < len(b) + 1:
            n = len(b) + (len(b) >> 3) + 1
            self.up, self.down = powers(n, _BASE), powers(n, _INVERSE)
        out = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.values[b] * self.up[:len(b)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        h = (sums[stop] - sums[start]) * self.down[start]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


class Settings:
    """Lengths of one run: of the strings, of the sample, and of the bytes that anchors share."""

    def __init__(self, length: int = LENGTH, sample: int = SAMPLE, group: int = GROUP):
        if not 1 <= sample <= length - GRAM + 1:
            raise ValueError(f"sample {sample} doesn't fit strings of {length} bytes")
        self.length, self.sample, self.group = length, sample, group
        self.shared = length - sample + 1


def _owners(b: np.ndarray, valid: np.ndarray, sums: np.ndarray, hasher: Hasher, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a block and the first and last window start that own each. ``valid``: whether a window starts there."""
    n = len(b) - s.length + 1
    grams = len(b) - GRAM + 1
    at = np.arange(grams, dtype=np.uint64)
    h = (sums[GRAM:] - sums[:grams]) * hasher.down[:grams]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    h = h >> np.uint64(24) << np.uint64(24) | at  # ties go to the first; a block has fewer than 2 ** 24 bytes
    w = s.sample
    rows = -(-(n + w) // w)
    padded = np.full(rows * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    take = min(grams, rows * w)
    padded[:take] = h[:take]
    grid = padded.reshape(rows, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[w - 1:n + w - 1])
    x = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    p = np.flatnonzero(valid[:n])
    x = x[p]
    new = np.concatenate([[True], (x[1:] != x[:-1]) | (p[1:] != p[:-1] + 1)]) if len(p) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(p)) - 1 if len(starts) else starts
    return x[starts], p[starts], p[ends]


def anchors(texts: list[bytes], s: Settings, hasher: Hasher) -> Iterator[tuple[int, np.ndarray]]:
    """For each text that has a window, its number and rows (anchor, first start, last start, key, reach, times).

    Equal neighbours (a periodic text) are one row whose ``times`` says how many there are; its starts span them all.
    """
    at = 0
    while at < len(texts):
        if len(texts[at]) > _BLOCK:
            yield at, _folded(_long(texts[at], s, hasher), s)
            at += 1
            continue
        upto, size = at, 0
        while upto < len(texts) and size + len(texts[upto]) <= _BLOCK:
            size += len(texts[upto])
            upto += 1
        b = np.frombuffer(b"".join(texts[at:upto]), np.uint8)
        sizes = np.array([len(t) for t in texts[at:upto]], np.int64)
        firsts = np.cumsum(sizes) - sizes
        if len(b) >= s.length:
            valid = np.zeros(len(b) + 1, np.int64)
            has = sizes >= s.length
            np.add.at(valid, firsts[has], 1)
            np.add.at(valid, (firsts + sizes - s.length + 1)[has], -1)
            sums = hasher.sums(b)
            x, lo, hi = _owners(b, np.cumsum(valid)[:-1] > 0, sums, hasher, s)
            key = hasher.of(sums, x, x + s.shared)
            reach = hasher.of(sums, lo, hi + s.length) + ((x - lo) * 1_000_003 + hi - lo).astype(np.uint64)
            owner = np.searchsorted(firsts, lo, side="right") - 1
            for k in np.unique(owner).tolist():
                a, z = np.searchsorted(owner, [k, k + 1])
                rows = np.stack([x[a:z] - firsts[k], lo[a:z] - firsts[k], hi[a:z] - firsts[k],
                                 key[a:z].view(np.int64), reach[a:z].view(np.int64)])
                yield at + k, _folded(rows, s)
        at = upto


def _long(text: bytes, s: Settings, hasher: Hasher) -> np.ndarray:
    """The rows of one long text, found part by part."""
    whole, parts = np.frombuffer(text, np.uint8), []
    n = len(whole) - s.length + 1
    for start in range(0, n, _BLOCK):
        b = whole[start:min(len(whole), start + _BLOCK + s.length - 1)]
        x, lo, hi = _owners(b, np.ones(len(b), bool), hasher.sums(b), hasher, s)
        parts.append(np.stack([x, lo, hi]) + start)
    x, lo, hi = np.concatenate(parts, axis=1)
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))  # an anchor may go on in the next part
    x, lo, hi = x[first], lo[first], hi[np.append(first[1:], len(x)) - 1]
    key, reach = np.zeros(len(x), np.uint64), np.zeros(len(x), np.uint64)
    at = 0
    while at < len(x):
        upto = max(at + 1, int(np.searchsorted(hi, lo[at] + _BLOCK)))
        base = lo[at]
        sums = hasher.sums(whole[base:hi[upto - 1] + s.length])
        a, b, c = x[at:upto] - base, lo[at:upto] - base, hi[at:upto] - base
        key[at:upto] = hasher.of(sums, a, a + s.shared)
        reach[at:upto] = hasher.of(sums, b, c + s.length) + ((a - b) * 1_000_003 + c - b).astype(np.uint64)
        at = upto
    return np.stack([x, lo, hi, key.view(np.int64), reach.view(np.int64)])


def _folded(rows: np.ndarray, s: Settings) -> np.ndarray:
    x, lo, hi, key, reach = rows
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (reach[1:] != reach[:-1])]))
    last = np.append(first[1:], len(x)) - 1
    return np.stack([x[first], lo[first], hi[last], key[first], reach[first], last - first + 1])


def _bytes_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


# --- the steps --------------------------------------------------------------------------------

def _anchor_rows(s: Settings):
    names = ["uid", "place", "key", "reach", "times"]

    def each(batches):
        hasher = Hasher()
        for batch in small(batches, 2 << 20):
            uids = batch.column(0).to_numpy()
            parts = [(np.full(rows.shape[1], uids[k]), np.arange(rows.shape[1]), rows[3], rows[4], rows[5])
                     for k, rows in anchors([_bytes_of(x) for x in texts_of(batch)], s, hasher)]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=names)
    return each


def _marked(rows: DataFrame, s: Settings) -> DataFrame:
    """(uid, place, state) of the anchors whose key occurs again; of several rows for one place the highest state holds.

    State 1: the reach occurs again. 2: so it does, reaches of the key differ, and this one stands for its copies in the index.
    3: the reach is the only one of its kind and goes to the index. States 2 and 3 come from the group of a reach, which
    names one of its places, so that no copy has to be looked up.
    """
    found = rows.mapInArrow(_anchor_rows(s), "uid long, place long, key long, reach long, times long")
    keys = found.groupBy("key").agg(F.sum("times").alias("n"), (F.min("reach") != F.max("reach")).alias("differ"))
    # Stored apart, so that both sides of the join are plain shuffles, which Spark splits where a key is hot.
    repeated = stored(keys.where("n > 1").drop("n"), "keys")
    again = stored(found.join(repeated, "key"), "anchors")
    reaches = again.where("differ").groupBy("key", "reach").agg(
        F.sum("times").alias("n"), F.min(F.struct("uid", "place")).alias("one"))
    named = reaches.select("one.uid", "one.place", F.when(F.col("n") == 1, 3).otherwise(2).alias("state"))
    return again.select("uid", "place", F.lit(1).alias("state")).union(named)


DONE, WAITING, STRING = 0, 1, 2
_PIECES = ("kind int, uid long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string, "
           "starts binary, place long, key long, left binary, right binary, low int, high int, asked boolean")


def _pieces(s: Settings):
    """Documents with their marks in; finished documents, waiting ones and strings for the index out."""
    names = [f.split()[0] for f in _PIECES.split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in _PIECES.split(", ")])

    def each(batches):
        hasher = Hasher()
        for batch in small(batches, 2 << 20):
            uids, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            marks, texts = batch.column(3), [_bytes_of(x) for x in texts_of(batch)]
            out = {n: [] for n in names}

            def add(**row):
                for n in names:
                    out[n].append(row.get(n))

            at = [k for k in range(len(texts)) if marks[k].is_valid]
            rows = {at[j]: r for j, r in anchors([texts[k] for k in at], s, hasher)}
            for k, text in enumerate(texts):
                if k not in rows:
                    add(kind=DONE, uid=uids[k], **_cut(ids[k], text, np.zeros((0, 2), np.int64), s))
                    continue
                x, lo, hi, key, _, _ = rows[k]
                marked = marks[k].values.flatten()
                places, states = (c.to_numpy(zero_copy_only=False) for c in marked)
                by = np.lexsort((states, places))
                by = by[np.append(places[by][1:] != places[by][:-1], True)]
                places, states = places[by], states[by]
                whole = places[states != 3]
                starts = np.stack([lo[whole], hi[whole]], axis=1)
                if not (states == 3).any():
                    add(kind=DONE, uid=uids[k], **_cut(ids[k], text, starts, s))
                else:
                    add(kind=WAITING, uid=uids[k], doc_id=ids[k], text=text.decode("utf-8", "surrogatepass"),
                        starts=starts.astype("<i8").tobytes())
                for i, state in zip(places.tolist(), states.tolist()):
                    if state > 1:
                        # Of a folded row the first anchor stands for all.
                        low, high = int(max(0, x[i] - hi[i])), int(x[i] - lo[i])
                        add(kind=STRING, uid=uids[k], place=i, key=int(key[i]), left=text[lo[i]:x[i]], low=low, high=high,
                            right=text[x[i] + s.shared:x[i] - low + s.length], asked=state == 3)
                if len(out["uid"]) > 20_000:
                    yield pa.RecordBatch.from_pydict(out, schema=schema)
                    out = {n: [] for n in names}
            yield pa.RecordBatch.from_pydict(out, schema=schema)
    return each


def _cut(doc_id, text: bytes, starts: np.ndarray, s: Settings) -> dict:
    """The document's row: window starts in intervals become removed bytes."""
    if len(starts):
        starts = starts[np.argsort(starts[:, 0], kind="stable")]
        begin, end = starts[:, 0], np.maximum.accumulate(starts[:, 1] + s.length)
        new = np.concatenate([[True], begin[1:] > end[:-1]])
        first = np.flatnonzero(new)
        spans = list(zip(begin[first].tolist(), end[np.append(first[1:], len(end)) - 1].tolist()))
    else:
        spans = []
    kept, at = hashlib.sha256(), 0
    for a, z in spans:
        kept.update(memoryview(text)[at:a])
        at = z
    kept.update(memoryview(text)[at:])
    removed = sum(z - a for a, z in spans)
    return dict(doc_id=doc_id, n_bytes=len(text), n_removed=removed, n_spans=len(spans), kept_sha256=kept.hexdigest())


def _split(strings: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame | None]:
    """Strings in groups of at most ``s.group`` that share a key, and starts decided by counting alone (uid, place, at).

    ``from`` and ``to`` are the places before the anchor that a group is about.
    """
    now = strings.withColumns({"from": F.lit(0), "to": F.lit(s.sample - 1)})
    ready, decided = None, None
    while True:
        sizes = now.groupBy("key").agg(F.count("*").alias("n"), F.max("asked").alias("asks")).where("n > 1 and asks").drop("asks")
        now = stored(now.join(stored(sizes, "sizes"), "key"), "strings")
        fits = now.where(F.col("n") <= s.group)
        ready = fits if ready is None else ready.union(fits)
        large = now.where(F.col("n") > s.group).drop("n")
        if large.isEmpty():
            return ready, decided
        one = large.where("`from` = `to` and asked").select("uid", "place", F.col("from").alias("at"))
        decided = one if decided is None else decided.union(one)
        large = large.where("`from` < `to`").withColumn("mid", F.expr("(`from` + `to`) div 2").cast("int"))
        inner = large.where("low <= mid").select(
            "uid", "place", F.xxhash64("key", F.lit(1), "mid", F.expr(f"substring(right, 1, {s.sample - 1} - mid)")).alias("key"),
            F.expr("substring(left, length(left) - least(high, mid) + 1, least(high, mid))").alias("left"), "right", "low", F.least("high", "mid").alias("high"), "asked",
            "from", F.col("mid").alias("to"))
        outer = large.where("high > mid").select(
            "uid", "place", F.xxhash64("key", F.lit(2), "mid", F.expr("substring(left, length(left) - mid, mid + 1)")).alias("key"),
            "left", F.expr(f"substring(right, 1, {s.sample - 1} - greatest(low, mid + 1))").alias("right"),
            F.greatest("low", F.col("mid") + 1).alias("low"), "high", "asked", (F.col("mid") + 1).alias("from"), "to")
        now = inner.union(outer)


def _indexed(s: Settings):
    """Strings sorted by key in; (uid, place, first, last) out: runs of places before the anchor where a repeated window starts."""
    def answer(groups: list[list[tuple]]):
        """groups: strings (uid, place, left, right, low, high, asked) by key."""
        strings = [(g, r) for g, rows in enumerate(groups) for r in rows]
        parts, anchors_at, at = [], [], 0
        ends = 257 + len(groups)
        for i, (g, (_, _, left, right, *_)) in enumerate(strings):
            parts += [np.frombuffer(left, np.uint8).astype(np.int64) + 1, np.array([257 + g]),
                      np.frombuffer(right, np.uint8).astype(np.int64) + 1, np.array([ends + i])]
            anchors_at.append(at + len(left))
            at += len(left) + len(right) + 2
        longest = RunLengthIndex(np.concatenate(parts)).matching_statistics(s.sample)
        out = ([], [], [], [])
        for (_, (uid, place, _, _, low, high, asked)), mid in zip(strings, anchors_at):
            if not asked:
                continue
            again = longest[mid - high:mid - low + 1][::-1] >= s.sample  # from low to high
            edges = np.flatnonzero(np.diff(np.concatenate([[0], again.view(np.int8), [0]])))
            for a, z in zip(edges[::2].tolist(), edges[1::2].tolist()):
                for c, v in zip(out, (uid, place, low + a, low + z - 1)):
                    c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["uid", "place", "first", "last"])

    def each(batches):
        groups, symbols, key = [], 0, None
        for batch in batches:
            columns = [batch.column(i) for i in range(8)]
            for k, *row in zip(*(c.to_pylist() for c in columns)):
                if k != key:
                    if symbols >= INDEX_SYMBOLS:
                        yield answer(groups)
                        groups, symbols = [], 0
                    groups.append([])
                    key = k
                groups[-1].append(tuple(row))
                symbols += len(row[2]) + len(row[3]) + 2
        if groups:
            yield answer(groups)
    return each


def _finish(s: Settings):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string())])

    def each(batches):
        hasher = Hasher()
        for batch in small(batches, 2 << 20):
            ids, texts = batch.column(0).to_pylist(), [_bytes_of(x) for x in texts_of(batch)]
            found = {k: r for k, r in anchors(texts, s, hasher)}
            out = []
            for k, (doc_id, text) in enumerate(zip(ids, texts)):
                starts = [np.frombuffer(batch.column(2)[k].as_py(), "<i8").reshape(-1, 2)]
                if batch.column(3)[k].is_valid:
                    place, first, last = (c.to_numpy(zero_copy_only=False) for c in batch.column(3)[k].values.flatten())
                    x = found[k][0][place]
                    starts.append(np.stack([x - last, x - first], axis=1))
                out.append(_cut(doc_id, text, np.concatenate(starts), s))
            yield pa.RecordBatch.from_pylist(out, schema=schema) if out else pa.RecordBatch.from_arrays(
                [pa.array([], f.type) for f in schema], names=names)
    return each


def remove_repeats(docs: DataFrame, length: int = LENGTH, sample: int = SAMPLE, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    s = Settings(length, sample, group)
    rows = numbered(docs.select("doc_id", "text"), "uid")
    marks = _marked(rows.select("uid", "text"), s).groupBy("uid").agg(F.collect_list(F.struct("place", "state")).alias("marks"))
    pieces = stored(rows.join(marks, "uid", "left").mapInArrow(_pieces(s), _PIECES), "pieces")
    strings = pieces.where(F.col("kind") == STRING).select("key", "uid", "place", "left", "right", "low", "high", "asked")
    ready, decided = _split(strings, s)
    sorted_ = ready.select("key", "uid", "place", "left", "right", "low", "high", "asked").repartition("key").sortWithinPartitions("key")
    starts = sorted_.mapInArrow(_indexed(s), "uid long, place long, first long, last long")
    if decided is not None:
        starts = starts.union(decided.select("uid", "place", F.col("at").cast("long"), F.col("at").cast("long")))
    starts = starts.groupBy("uid").agg(F.collect_list(F.struct("place", "first", "last")).alias("more"))
    waiting = pieces.where(F.col("kind") == WAITING).select("uid", "doc_id", "text", "starts").join(starts, "uid", "left")
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    done = pieces.where(F.col("kind") == DONE).select(*[f.split()[0] for f in result.split(", ")])
    return done.union(waiting.select("doc_id", "text", "starts", "more").mapInArrow(_finish(s), result))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


#: Every 400-byte window by its MD5, over the text as hexadecimal digits; all windows at once, so for small tables only.
SQL = r"""
WITH bytes AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), starts AS (
  SELECT row, p, md5(substr(x, 2 * p + 1, 800)) AS mark
  FROM (SELECT row, x, unnest(range(0, greatest(0, length(x) // 2 - 399))) AS p FROM bytes) w
), repeated AS (
  SELECT row, p FROM starts WHERE mark IN (SELECT mark FROM starts GROUP BY mark HAVING count(*) > 1)
), runs AS (
  SELECT row, min(p) AS a, max(p) + 400 AS z FROM (
    SELECT row, p, sum(CAST(coalesce(p > before + 400, TRUE) AS INT)) OVER (PARTITION BY row ORDER BY p) AS run
    FROM (SELECT row, p, lag(p) OVER (PARTITION BY row ORDER BY p) AS before FROM repeated) x) y
  GROUP BY row, run
), kept AS (
  SELECT row, count(*) AS n_spans, sum(z - a) AS n_removed,
         string_agg(substr(x, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) || substr(any_value(x), 2 * max(z) + 1) AS rest
  FROM (SELECT row, a, z, lag(z, 1, 0) OVER (PARTITION BY row ORDER BY a) AS since FROM runs) r JOIN bytes USING (row)
  GROUP BY row
)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, x))) AS kept_sha256
FROM bytes LEFT JOIN kept USING (row)
"""
