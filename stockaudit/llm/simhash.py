"""SimHash near-duplicates by deletion-variant signatures (operator 4).

A document's fingerprint has a bit where more than half of its shingle hashes have it. Fingerprints link at ``distance``
or fewer differing bits. They are cut into ``distance // 2 + 1`` segments, so that two linked ones have a segment in which
they differ by one bit at most. Each distinct fingerprint is indexed under every segment as it is and under every
segment with one bit left out; equal signatures meet, and the whole distance is verified.

Copies share one fingerprint and are one member of the index. A signature's members are compared in one task while there
are up to ``MOST_MEMBERS``: a few pairwise, more by equal masked fingerprints, which costs a fixed number of keys a
member. A larger group is never gathered: its members are dealt out by masked fingerprints and meet there by equality. Only a
spanning set of links leaves each task, so that a group of n members gives n - 1 rows.

Defined results: a document without words (null and empty texts too) has fingerprint zero and links like any other.
Repeated rows are documents of their own with the same id. Extra columns are not returned by ``near_duplicates`` and are
kept by ``keep_one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockaudit.llm.common import free_name, numbered, stored, table, texts_of
from stockaudit.llm.components import components

SHINGLE = 3
DISTANCE = 2
MOST_MEMBERS = 1 << 15
PAIRWISE = 512


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, as a signed number."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    total = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 15):
        stop = min(n, start + (1 << 15))
        rows = zip(*(words[start + i:stop + i] for i in range(shingle))) if len(words) >= shingle else [words]
        h = np.array([xxh64_intdigest(b" ".join(r), 42) for r in rows], np.uint64)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", column: str = "fp") -> DataFrame:
    """``docs`` without the text and with its fingerprint."""
    rest = [f for f in docs.schema.fields if f.name != text]
    names = [f.name for f in rest]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([fingerprint(x, shingle) for x in texts_of(batch, text)], pa.int64())
            kept = [batch.column(batch.schema.names.index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, made], names=[*names, column])

    schema = docs.select(*names).schema.add(column, "long")
    return docs.mapInArrow(each, schema)


def _segments(distance: int) -> list[list[int]]:
    n = distance // 2 + 1
    return [list(range(64 * i // n, 64 * (i + 1) // n)) for i in range(n)]


def _mask(bits) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def signatures(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, kind, signature): each segment as it is, and with each of its bits left out. ``kind`` says which."""
    made = []
    for i, bits in enumerate(_segments(distance)):
        for j, left_out in enumerate([None, *bits]):
            mask = _mask(b for b in bits if b != left_out)
            made.append(F.struct(F.lit(100 * i + j).alias("kind"), F.col("fp").bitwiseAND(F.lit(mask)).alias("signature")))
    return prints.select("fp", F.explode(F.array(*made)).alias("s")).select("fp", "s.kind", "s.signature")


def _free_bits(kind: int, distance: int) -> tuple[list[int], int, int | None]:
    """Bits outside a signature's segment, the differences left for them, and the bit left out inside."""
    bits = _segments(distance)[kind // 100]
    left_out = bits[kind % 100 - 1] if kind % 100 else None
    return [b for b in range(64) if b not in bits], distance - (left_out is not None), left_out


def _masks(kind: int, distance: int) -> np.ndarray:
    """Masks of whole fingerprints of which two linked members of a group share at least one result."""
    bits, left, left_out = _free_bits(kind, distance)
    fixed = set() if left_out is None else {left_out}
    full = (1 << 64) - 1
    return np.array([full ^ sum(1 << b for b in fixed.union(c)) for c in combinations(bits, min(left, len(bits)))], np.uint64)


class Forest:
    """Union-find over the rows of one group."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def link(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def spanning(fps: np.ndarray, kind: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, least member) that span the components of one signature's members, which ascend."""
    n = len(fps)
    forest = Forest(n)
    if n <= PAIRWISE:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
        for i, j in np.argwhere(np.triu(near, 1)).tolist():
            forest.link(i, j)
    else:
        for mask in _masks(kind, distance):
            masked = fps & mask
            order = np.argsort(masked, kind="stable")
            same = np.flatnonzero(masked[order][1:] == masked[order][:-1])
            for i, j in zip(order[same].tolist(), order[same + 1].tolist()):
                forest.link(i, j)
    roots = np.array([forest.root(i) for i in range(n)])
    own = np.flatnonzero(roots != np.arange(n))
    return fps[own], fps[roots[own]]


def _compare(distance: int, most: int):
    """Sorted (kind, signature, fp) rows in; links out, and the members of groups above ``most`` with their kind."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("kind", pa.int32())])

    def out(a, b, kind=None) -> pa.RecordBatch:
        kinds = pa.nulls(len(a), pa.int32()) if kind is None else pa.array(np.full(len(a), kind, np.int32))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), kinds], schema=schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held, over = [], 0, False  # the group that may go on in the next batch
        last = None

        def close():
            if over or held < 2:
                return
            fps = np.concatenate(kept)
            left_out = _free_bits(last[0], distance)[2]
            if left_out is not None:
                bit = (fps >> np.uint64(left_out)) & np.uint64(1)
                if bit.all() or not bit.any():
                    return  # the same segments: they meet under the segment as it is
            a, b = spanning(fps, last[0], distance)
            if len(a):
                yield out(a, b)

        for batch in batches:
            kind = batch.column(0).to_numpy()
            sig = batch.column(1).to_numpy()
            fps = batch.column(2).to_numpy().view(np.uint64)
            if not len(fps):
                continue
            cuts = np.flatnonzero((kind[1:] != kind[:-1]) | (sig[1:] != sig[:-1])) + 1
            starts, ends = np.concatenate([[0], cuts]), np.append(cuts, len(fps))
            many = np.flatnonzero(ends - starts > 1)
            wanted = sorted({0, len(starts) - 1, *many.tolist()})  # single members inside a batch meet nobody
            for g in wanted:
                s, e = starts[g], ends[g]
                key = (int(kind[s]), int(sig[s]))
                if key != last:
                    yield from close()
                    kept, held, over, last = [], 0, False, key
                part = fps[s:e]
                if not over and held + len(part) > most:
                    over = True
                    for p in kept:
                        yield out(p, p, key[0])
                    kept = []
                if over:
                    yield out(part, part, key[0])
                else:
                    kept.append(part)
                held += len(part)
        yield from close()

    return each


def links(prints: DataFrame, distance: int = DISTANCE, most: int = MOST_MEMBERS) -> DataFrame:
    """Links (a, b) that span the components of the distinct fingerprints ``fp``."""
    dealt = signatures(prints, distance).select("kind", "signature", "fp").repartition("kind", "signature")
    found = stored(dealt.sortWithinPartitions("kind", "signature", "fp").mapInArrow(
        _compare(distance, most), "a long, b long, kind int"), "links")
    small = found.where("kind is null").select("a", "b")
    large = found.where("kind is not null")
    kinds = [r["kind"] for r in large.select("kind").distinct().collect()]  # at most 66 for two segments
    for kind in kinds:
        masks = [int(m) - (1 << 64) if m >= 1 << 63 else int(m) for m in _masks(kind, distance)]
        masked = large.where(F.col("kind") == kind).select(
            "a", F.posexplode(F.transform(F.array(*map(F.lit, masks)), lambda m: F.col("a").bitwiseAND(m))).alias("n", "masked"))
        stars = masked.groupBy("n", "masked").agg(F.min("a").alias("b"), F.count("*").alias("members")).where("members > 1")
        small = small.union(masked.join(stars.drop("members"), ["n", "masked"]).select("a", "b").where("a != b"))
    return small


def classes(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, component): the least fingerprint reachable from each distinct fingerprint that has a link."""
    return components(links(prints, distance)).toDF("fp", "component")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (the least id reachable) of every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = stored(fingerprints(rows, shingle), "fingerprints")
    firsts = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    named = firsts.join(classes(firsts, distance), "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = named.join(least, "component").select("fp", "component_id")
    return prints.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Pipeline stage: of each component the row of the least id (the first read of equal ones), with its own columns."""
    row = free_name(docs, "row")
    rows = numbered(docs, row)
    prints = stored(fingerprints(rows.select(F.col(row).alias("row"), "doc_id", "text"), shingle), "fingerprints")
    first = F.min(F.struct("doc_id", "row"))
    firsts = stored(prints.groupBy("fp").agg(first.alias("first")), "distinct")
    named = firsts.join(classes(firsts, distance), "fp", "left").select("first", F.coalesce("component", "fp").alias("component"))
    kept = named.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def op4_simhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
