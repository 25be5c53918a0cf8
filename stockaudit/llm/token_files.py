"""Token ids in binary files, a wavelet matrix per shard (operator 6).

Documents are sorted by id over the whole cluster, encoded where they land, and packed into shards of about ``SHARD_TOKENS``
ids. A shard is one binary value that holds everything about it; Spark writes it as a row of a compressed Parquet file, so any
store that Spark reaches will do. Its bytes are, little-endian:

    magic "WMX1", planes (uint32), documents (uint64), ids (uint64)
    doc_id of each document (int64), a bitmap of null doc_ids (a byte each), end of each document (uint64)
    for each plane from the highest bit down: number of zeros (uint64), ones before every 512th bit (uint32), the bits

Each plane holds one bit of every id, in the order left by sorting stably on the planes above. ``access``, ``rank``,
``count`` and ``select`` answer from the planes; ``all`` undoes the sorting plane by plane.

Defined results: null and empty texts are documents of only the end id. Documents of one id are ordered by text;
null ids come first. Repeated rows are kept. An empty table makes no shard. Extra columns are not stored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockaudit.llm.bpe import default_vocabulary
from stockaudit.llm.common import small, table, texts_of
from stockaudit.llm.pieces import PieceEncoder
from stockaudit.session import new_folder

END = 2
SHARD_TOKENS = 1 << 18  # half a megabyte of planes: building and reading them stays in a core's cache
SHARDS_A_FILE = 64
BLOCK = 512  # bits between two entries of a rank directory
MAGIC = b"WMX1"
FIELDS = "part int, seq int, start long, documents long, ids long, shard binary"


class WaveletMatrix:
    """Bit planes of a list of numbers, with rank and select."""

    def __init__(self, n: int, planes: list[tuple[int, np.ndarray, np.ndarray]]):
        self.n, self.planes = n, planes  # of each plane: zeros, ones before each block, packed bits

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        top = int(ids.max()) if len(ids) else 0
        x = ids.astype(np.uint16 if top < 1 << 16 else np.uint32)
        planes = []
        for k in reversed(range(max(1, top.bit_length()))):
            bit = (x & x.dtype.type(1 << k)) != 0
            packed = np.packbits(bit, bitorder="little")
            zero = np.compress(~bit, x)
            planes.append((len(zero), cls._directory(packed), packed))
            x = np.concatenate([zero, np.compress(bit, x)])
        return cls(len(ids), planes)

    @staticmethod
    def _directory(packed: np.ndarray) -> np.ndarray:
        blocks = -(-len(packed) * 8 // BLOCK) or 1
        whole = np.zeros(blocks * BLOCK // 64, np.uint64)
        whole.view(np.uint8)[:len(packed)] = packed
        ones = np.bitwise_count(whole).reshape(blocks, -1).sum(axis=1, dtype=np.int64)
        return (np.cumsum(ones) - ones).astype(np.uint32)

    def all(self) -> np.ndarray:
        """The numbers in their order."""
        x = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for k, (zeros, _, packed) in enumerate(reversed(self.planes)):
            bit = np.unpackbits(packed, count=self.n, bitorder="little").view(bool)
            up = np.empty_like(x)
            up[np.flatnonzero(~bit)] = x[:zeros]
            up[np.flatnonzero(bit)] = x[zeros:] | x.dtype.type(1 << k)
            x = up
        return x

    def _ones(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        _, ahead, packed = self.planes[plane]
        if i >= self.n:
            return self.n - self.planes[plane][0]
        block = i // BLOCK
        first, last = block * BLOCK // 8, i // 8
        rest = int(np.bitwise_count(packed[first:last]).sum())
        if i % 8:
            rest += int(packed[last] & ((1 << i % 8) - 1)).bit_count()
        return int(ahead[block]) + rest

    def access(self, i: int) -> int:
        """The i-th number."""
        value = 0
        for plane, (zeros, _, packed) in enumerate(self.planes):
            bit, ones = packed[i // 8] >> (i % 8) & 1, self._ones(plane, i)
            value = value << 1 | int(bit)
            i = zeros + ones if bit else i - ones
        return value

    def _range(self, value: int, i: int) -> tuple[int, int]:
        """Where occurrences of ``value`` among the first i numbers lie in the last order."""
        a, z = 0, i
        if value >> len(self.planes):
            return 0, 0
        for plane, (zeros, *_) in enumerate(self.planes):
            ones_a, ones_z = self._ones(plane, a), self._ones(plane, z)
            if value >> (len(self.planes) - 1 - plane) & 1:
                a, z = zeros + ones_a, zeros + ones_z
            else:
                a, z = a - ones_a, z - ones_z
        return a, z

    def rank(self, value: int, i: int) -> int:
        """How often ``value`` occurs among the first i numbers."""
        a, z = self._range(value, min(i, self.n))
        return z - a

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, k: int) -> int:
        """The place of the k-th occurrence (from 0), or -1."""
        a, z = self._range(value, self.n)
        if not 0 <= k < z - a:
            return -1
        i = a + k
        for plane in reversed(range(len(self.planes))):
            zeros = self.planes[plane][0]
            i = self._find(plane, i - zeros, True) if i >= zeros else self._find(plane, i, False)
        return i

    def _find(self, plane: int, k: int, one: bool) -> int:
        """The place of the k-th bit of that kind in a plane."""
        _, ahead, packed = self.planes[plane]
        before = ahead.astype(np.int64) if one else np.arange(len(ahead), dtype=np.int64) * BLOCK - ahead
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(packed[block * BLOCK // 8:(block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == one)[k - before[block]])

    def to_bytes(self) -> bytes:
        return b"".join(x for zeros, ahead, packed in self.planes
                        for x in (np.uint64(zeros).tobytes(), ahead.astype("<u4").tobytes(), packed.tobytes()))

    @classmethod
    def from_bytes(cls, data: memoryview, n: int, planes: int) -> WaveletMatrix:
        size = -(-n // 8)
        blocks = -(-size * 8 // BLOCK) or 1
        out, at = [], 0
        for _ in range(planes):
            zeros = int(np.frombuffer(data, "<u8", 1, at)[0])
            ahead = np.frombuffer(data, "<u4", blocks, at + 8)
            out.append((zeros, ahead, np.frombuffer(data, np.uint8, size, at + 8 + 4 * blocks)))
            at += 8 + 4 * blocks + size
        return cls(n, out)


class Shard:
    """Documents and the wavelet matrix of all their ids."""

    def __init__(self, doc_ids: list[int | None], ends: np.ndarray, matrix: WaveletMatrix):
        self.doc_ids, self.ends, self.matrix = doc_ids, ends, matrix

    def to_bytes(self) -> bytes:
        known = np.array([0 if d is None else d for d in self.doc_ids], "<i8")
        null = np.array([d is None for d in self.doc_ids], np.uint8)
        head = MAGIC + np.uint32(len(self.matrix.planes)).tobytes() + np.array([len(known), self.matrix.n], "<u8").tobytes()
        return b"".join([head, known.tobytes(), null.tobytes(), self.ends.astype("<u8").tobytes(), self.matrix.to_bytes()])

    @classmethod
    def from_bytes(cls, data: bytes | memoryview) -> Shard:
        data = memoryview(data)
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a shard of token ids")
        planes = int(np.frombuffer(data, "<u4", 1, 4)[0])
        documents, n = (int(x) for x in np.frombuffer(data, "<u8", 2, 8))
        ids = np.frombuffer(data, "<i8", documents, 24).tolist()
        null = np.frombuffer(data, np.uint8, documents, 24 + 8 * documents)
        ends = np.frombuffer(data, "<u8", documents, 24 + 9 * documents).astype(np.int64)
        matrix = WaveletMatrix.from_bytes(data[24 + 17 * documents:], n, planes)
        return cls([None if x else d for d, x in zip(ids, null.tolist())], ends, matrix)


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end: int = END, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encodes (doc_id, text) and writes the shards, in ascending doc_id order, to ``folder``."""
    path = path or default_vocabulary()

    def pack(batches):
        encoder, part = PieceEncoder.of(path), TaskContext.get().partitionId()
        ids, made, held, seq, start = [], [], 0, 0, 0

        def row():
            whole = np.concatenate(made)
            ends = np.cumsum([len(m) for m in made])
            shard = Shard(list(ids), ends, WaveletMatrix.build(whole)).to_bytes()
            return pa.RecordBatch.from_pylist(
                [dict(part=part, seq=seq, start=start, documents=len(ids), ids=len(whole), shard=shard)],
                schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("start", pa.int64()), ("documents", pa.int64()),
                                  ("ids", pa.int64()), ("shard", pa.binary())]))

        last = np.array([end], np.int32)
        for batch in small(batches, 2 << 20):
            coded = encoder.encode([x or "" for x in texts_of(batch)])
            for doc_id, x in zip(batch.column(0).to_pylist(), coded):
                if made and held + len(x) + 1 > shard_tokens:
                    yield row()
                    seq, start = seq + 1, start + held
                    ids, made, held = [], [], 0
                ids.append(doc_id)
                made.append(np.concatenate([x, last]))
                held += len(x) + 1
        if made:
            yield row()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    shards = ordered.mapInArrow(pack, FIELDS)
    shards.write.option("compression", "zstd").option("maxRecordsPerFile", SHARDS_A_FILE).parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards with ``first``: how many ids all shards before hold."""
    shards = spark.read.schema(FIELDS).parquet(folder)
    totals = sorted(tuple(r) for r in shards.groupBy("part").agg(F.sum("ids")).collect())  # a row per written partition
    before, rows = 0, []
    for part, n in totals:
        rows.append((part, before))
        before += n
    bases = spark.createDataFrame(rows, "part int, base long")
    return shards.join(F.broadcast(bases), "part").withColumn("first", F.col("base") + F.col("start")).drop("base")


def read_tokens(spark: SparkSession, folder: str, as_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, the ids of every document in a folder of shards."""
    fields = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if as_ids else "")

    def unpack(batches):
        for batch in batches:
            for first, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard.from_bytes(data.as_buffer())
                whole = shard.matrix.all().astype("<u4")
                starts = np.concatenate([[0], shard.ends[:-1]])
                columns = [pa.array(shard.doc_ids, pa.int64()), pa.array(first + starts), pa.array(shard.ends - starts),
                           pa.array([zlib.crc32(whole[a:z]) for a, z in zip(starts.tolist(), shard.ends.tolist())], pa.int64())]
                if as_ids:
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(np.concatenate([starts, shard.ends[-1:]]).astype(np.int32)), pa.array(whole.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in fields.split(", ")])

    return read_shards(spark, folder).select("first", "shard").mapInArrow(unpack, fields)


def find_token(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """doc_id and place (from the first id of all) of every occurrence of a token, by select on each shard's planes."""
    def find(batches):
        for batch in batches:
            for first, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard.from_bytes(data.as_buffer())
                at = [shard.matrix.select(token, k) for k in range(shard.matrix.count(token))]
                docs = np.searchsorted(shard.ends, at, side="right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.doc_ids[d] for d in docs], pa.int64()), pa.array([first + a for a in at], pa.int64())],
                    names=["doc_id", "place"])

    return read_shards(spark, folder).select("first", "shard").mapInArrow(find, "doc_id long, place long")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder)
    return read_tokens(spark, folder, as_ids=False)
