"""Alignment of two tokenizers' tokens by merge paths (operator 13).

Both tokenizers spell the same bytes, so their tokens are two ascending lists of byte ends. Merging the lists visits every pair of
overlapping tokens once. Diagonals of the merge, ``PIECE`` steps apart, are searched by bisection, all at once; each
diagonal starts a piece of equal work that needs nothing from the others, and all pieces of a block of texts advance
in lockstep. A piece emits its overlaps and marks those at which both lists end; running sums over the pieces' marks stitch the
groups that lie across pieces. Texts follow each other in one merge, since each ends in both lists.

Corpus-wide counts of linked id pairs: each document hands on its distinct pairs; they are counted map-side first. The most
frequent pairs (``FREQUENT``, a bound on what is broadcast) are looked up where the documents lie; the links of
all others, each of which is then a small share of all, meet their counts in a join by pair and go back by row.

Defined results: a null or empty text has no tokens, nor has one whose tokens spell other bytes in either tokenizer (U+2581 in
a text reads as a space); counts are then 0 and the digest is empty. Repeated rows and ids are documents of their own and
count as such. A very long text is cut at its spaces for one tokenizer, and by ``pieces`` for the other. Empty tables
give no rows. ``align`` keeps all columns and lengthens its new names by ``_`` where they are taken; the query returns its own only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockaudit.llm.bpe import Spelling, default_vocabulary
from stockaudit.llm.common import free_name, small, stored, table, texts_of, worker_state
from stockaudit.llm.pieces import PieceEncoder

PIECE = 256
FREQUENT = 1 << 17
PIECES = "piece_bpe_32k.model"
_MOST_KNOWN = 400_000  # chunks whose ids a worker keeps
_LONGEST_KNOWN = 64
_SPACE = "▁"  # how the piece vocabulary writes a space


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECES)


# --- tokens -----------------------------------------------------------------------------------

class PieceVocabulary:
    """Encodes with a SentencePiece model chunk by chunk, and knows the bytes of its ids.

    No piece of the vocabulary has a space behind another character, so nothing is ever merged over the start of a run of
    spaces: the text is cut there, and chunks that occur again are looked up. The space that the library puts before a
    chunk stands for the one at the cut.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        self.cut = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        self.spelt = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(_SPACE, " ").encode()
                      for i, p in enumerate(pieces)]
        self.size = np.array([len(x) for x in self.spelt], np.int64)
        self.known: dict[str, tuple[int, ...] | None] = {"": (self.library.piece_to_id(_SPACE),)}

    @classmethod
    def of(cls, path: str) -> PieceVocabulary:
        known = worker_state().setdefault("piece_vocabularies", {})
        if path not in known:
            known[path] = cls(path)
        return known[path]

    def chunks(self, text: str) -> list[str]:
        if not self.cut:
            return [text]
        parts = text.split(" ")
        if "" not in parts:
            return parts
        out, now = [], parts[0]
        for part in parts[1:]:
            if now.strip(" "):
                out.append(now)
                now = part
            else:  # spaces so far: they belong to the chunk behind them
                now = f"{now} {part}"
        return [*out, now]

    def encode(self, text: str) -> np.ndarray | None:
        """Ids of a text that isn't empty; None if they don't spell a space and the text."""
        chunks = self.chunks(text)
        found = [self.known.get(c, 0) for c in chunks]
        if 0 in found:
            missing = list({c for c, f in zip(chunks, found) if f == 0})
            fresh = {}
            for c, ids in zip(missing, self.library.encode(missing, num_threads=1)):
                fits = b"".join(map(self.spelt.__getitem__, ids)) == b" " + c.encode()
                fresh[c] = tuple(ids) if fits else None
            found = [fresh[c] if f == 0 else f for c, f in zip(chunks, found)]
            if len(self.known) + len(fresh) > _MOST_KNOWN:
                self.known = {"": self.known[""]}
            self.known.update((c, ids) for c, ids in fresh.items() if len(c) <= _LONGEST_KNOWN)
        if None in found:
            return None
        return np.fromiter(chain.from_iterable(found), np.int32)


def byte_tokens(path: str) -> PieceEncoder:
    """The byte-level encoder that reads special tokens' strings as plain text."""
    known = worker_state().setdefault("plain_encoders", {})
    if path not in known:
        known[path] = PieceEncoder(path, plain=True)
    return known[path]


# --- merge paths ------------------------------------------------------------------------------

def crossings(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two ascending lists (equal values: ``a`` first) crosses every ``step``-th diagonal."""
    d = np.arange(0, len(a) + len(b), step)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low, d - low
        mid = (low[open_] + high[open_]) // 2
        taken = a[mid] <= b[d[open_] - mid - 1]
        low[open_[taken]] = mid[taken] + 1
        high[open_[~taken]] = mid[~taken]


def overlaps(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs (i, j) of tokens that overlap, in order, and the group of each; ``a`` and ``b`` are the tokens' ends.

    Both lists end at the same place. A group lies between two places where tokens of both end.
    """
    i, j = crossings(a, b, step)
    pieces = len(i)
    beyond = np.full(step + 1, np.iinfo(np.int64).max)
    ends_a, ends_b = np.concatenate([a, beyond]), np.concatenate([b, beyond])
    left, right = np.empty((pieces, step), np.int32), np.empty((pieces, step), np.int32)
    linked, closes = np.empty((pieces, step), bool), np.empty((pieces, step), bool)
    before = np.where(i > 0, ends_a[i - 1], -1)  # the end of the last token taken from a
    for k in range(step):
        x, y = ends_a[i], ends_b[j]
        from_a = x <= y
        left[:, k], right[:, k] = i, j
        linked[:, k] = from_a | (y != before)  # a token of b that ended with the last of a has its link
        closes[:, k] = x == y
        before = np.where(from_a, x, before)
        i = i + from_a
        j = j + ~from_a
    # Groups that end before each piece, and inside it before each link.
    inside = np.cumsum(closes, axis=1, dtype=np.int32)
    group = inside - closes + (np.cumsum(inside[:, -1:], axis=0) - inside[:, -1:])
    keep = linked.ravel()
    keep[len(a) + len(b):] = False
    return left.ravel()[keep], right.ravel()[keep], group.ravel()[keep]


class Aligned:
    """The tokens of a block of texts, their overlaps and groups."""

    def __init__(self, texts: list[str | None], path_a: str, path_b: str):
        first, second = byte_tokens(path_a), PieceVocabulary.of(path_b)
        spelling = Spelling.of(path_a)
        b = [second.encode(t) if t and _SPACE not in t else None for t in texts]
        spaced = [f" {t}" if ids is not None else "" for t, ids in zip(texts, b)]
        a = first.encode(spaced)
        for n, (ids, text) in enumerate(zip(a, spaced)):
            if b[n] is not None and spelling._bytes(ids) != text.encode():
                a[n], b[n] = ids[:0], None
        b = [np.zeros(0, np.int32) if ids is None else ids for ids in b]
        self.n_a, self.n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a, b))
        self.a, self.b = (np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int64) for ids in (a, b))
        self.left, self.right, group = overlaps(np.cumsum(spelling.size[self.a]), np.cumsum(second.size[self.b]))
        self.group_a, self.group_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        self.group_a[self.left], self.group_b[self.right] = group, group
        self.upto_a, self.upto_b = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))
        self.doc = np.repeat(np.arange(len(texts)), self.n_a)
        # Groups and links before each text (and in all).
        n_groups = int(group[-1]) + 1 if len(group) else 0
        self.groups = np.append(self.group_a, n_groups)[self.upto_a]
        self.links = np.searchsorted(self.left, self.upto_a)

    def pairs(self, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of each text as a_id * size_b + b_id, how often each is linked, and the pairs before each text."""
        pair = self.a[self.left] * size_b + self.b[self.right]
        doc = self.doc[self.left]
        width = int(pair.max()) + 1 if len(pair) else 1
        keys, times = np.unique(doc * width + pair, return_counts=True)
        return keys % width, times, np.searchsorted(keys // width, np.arange(len(self.n_a) + 1))

    def digests(self, path_a: str, path_b: str) -> list[str]:
        """SHA-256 of the groups of each text, written as ``a1,a2|b1;a3|b2,b3``."""
        spelt, size_a = _written(path_a, path_b)
        last_a = np.append(self.group_a[1:] != self.group_a[:-1], True)[:len(self.a)]
        last_b = np.append(self.group_b[1:] != self.group_b[:-1], True)[:len(self.b)].astype(np.int64)
        last_b[self.upto_b[1:][self.n_b > 0] - 1] = 2  # nothing follows a text's last token
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + np.searchsorted(self.group_b, self.group_a, "left")] = 2 * self.a + last_a
        codes[np.arange(len(self.b)) + np.searchsorted(self.group_a, self.group_b, "right")] = 2 * size_a + 3 * self.b + last_b
        at = (self.upto_a + self.upto_b).tolist()
        return [hashlib.sha256(b"".join(map(spelt.__getitem__, codes[s:e].tolist()))).hexdigest() if s < e else ""
                for s, e in zip(at[:-1], at[1:])]


def _written(path_a: str, path_b: str) -> tuple[list[bytes], int]:
    """Every id in decimals with each sign that can follow it, and the size of the first vocabulary."""
    known = worker_state().setdefault("written_ids", {})
    if (path_a, path_b) not in known:
        size_a, size_b = len(Spelling.of(path_a).size), len(PieceVocabulary.of(path_b).size)
        known[path_a, path_b] = ([b"%d%s" % (i, s) for i in range(size_a) for s in (b",", b"|")]
                                 + [b"%d%s" % (i, s) for i in range(size_b) for s in (b",", b";", b"")], size_a)
    return known[path_a, path_b]


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(np.int32)))


# --- the operator -----------------------------------------------------------------------------

def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` and four array columns: both tokenizers' ids, and per group the number of ids of each up to its end."""
    path_a, path_b = path_a or default_vocabulary(), path_b or default_pieces()
    names = [free_name(docs, n) for n in ("a_ids", "b_ids", "a_upto", "b_upto")]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.ArrayType(T.IntegerType())) for n in names)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 1 << 20):
            x = Aligned(list(texts_of(batch, text)), path_a, path_b)
            ends = np.arange(x.groups[-1])
            upto = [np.searchsorted(g, ends, "right") - np.repeat(u[:-1], np.diff(x.groups))
                    for g, u in ((x.group_a, x.upto_a), (x.group_b, x.upto_b))]
            made = [_lists(x.a, x.upto_a), _lists(x.b, x.upto_b), *(_lists(u, x.groups) for u in upto)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *names])

    return docs.mapInArrow(work, schema)


def linked_pairs(docs: DataFrame, path_a: str, path_b: str, size_b: int) -> DataFrame:
    """Per row of ``docs`` (row, doc_id, text): token, group and link counts, the digest, and its distinct pairs with their times."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 1 << 20):
            x = Aligned(list(texts_of(batch)), path_a, path_b)
            pairs, times, at = x.pairs(size_b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(x.n_a), pa.array(x.n_b), pa.array(np.diff(x.groups)),
                 pa.array(np.diff(x.links)), pa.array(x.digests(path_a, path_b), pa.string()), _lists(pairs, at), _lists(times, at)],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return docs.select("row", "doc_id", "text").mapInArrow(
        work, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pairs array<int>, times array<int>")


def pair_counts(linked: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): how many rows hold the pair, and whether that is the most of any pair with its first id."""
    counts = stored(linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    first = F.floor(F.col("pair") / size_b).alias("a")
    most = counts.groupBy(first).agg(F.max("n").alias("most"))
    return counts.join(most, first == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(linked: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``linked`` (a stored table) with n_best and count_sum instead of its arrays."""
    top = counts.orderBy(F.desc("n"), "pair").limit(frequent).toPandas().sort_values("pair")
    sent = linked.sparkSession.sparkContext.broadcast(
        (top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            pair, n, best = sent.value
            lists = [batch.column(batch.schema.names.index(c)) for c in ("pairs", "times")]
            at = lists[0].offsets.to_numpy().astype(np.int64)
            mine, times = (x.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]].astype(np.int64) for x in lists)
            at = at - at[0]
            place = np.minimum(np.searchsorted(pair, mine), max(0, len(pair) - 1))
            hit = pair[place] == mine if len(pair) else np.zeros(len(mine), bool)
            sums = []
            for value in (times * (hit & best[place]), times * hit * n[place]) if len(pair) else (times * 0,) * 2:
                total = np.concatenate([[0], np.cumsum(value)])
                sums.append(pa.array(total[at[1:]] - total[at[:-1]]))
            left = np.concatenate([[0], np.cumsum(~hit)])[at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.names.index(c)) for c in keep), *sums, _lists(mine[~hit], left), _lists(times[~hit], left)],
                names=[*keep, "n_best", "count_sum", "pairs", "times"])

    keep = [c for c in linked.columns if c not in ("pairs", "times")]
    kept = T.StructType([linked.schema[c] for c in keep])
    done = stored(linked.mapInArrow(work, T.StructType(
        [*kept.fields, *T.StructType.fromDDL("n_best long, count_sum long, pairs array<int>, times array<int>").fields])), "frequent")
    rare = done.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    rare = rare.join(counts, F.col("pairs") == F.col("pair")).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best"), F.sum(F.col("times") * F.col("n")).alias("rare_sum"))
    return done.join(rare, "row", "left").select(
        *keep, (F.col("n_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"))


def alignment_scores(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """Counts, digest and corpus-wide link scores of every row of ``docs`` (doc_id, text)."""
    path_a, path_b = path_a or default_vocabulary(), path_b or default_pieces()
    size_a, size_b = len(Spelling.of(path_a).size), len(PieceVocabulary.of(path_b).size)
    if size_a * size_b >= 1 << 31:
        raise ValueError("pairs of ids of these vocabularies don't fit 31 bits")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    linked = stored(linked_pairs(rows, path_a, path_b, size_b), "linked")  # rows keep their numbers from here on
    counts = stored(pair_counts(linked, size_b), "pair_counts")
    return scored(linked, counts, frequent)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_scores(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
