"""BPE encoding and decoding with tree concatenation of long unsplit text (operator 7).

Ordinary texts are encoded where they lie (see ``pieces``). A text that holds an unsplit run of ``LONG`` characters or
more (letters without a space, a line of dashes, a run of spaces) is cut into segments that other tasks encode in
parallel: added tokens (``<s>`` and the like) are cut out first, the vocabulary's pre-tokenizer gives the units that merges
never cross, and a unit longer than ``LEAF`` is halved until its parts fit. Neighbouring parts are then joined pairwise, level by level. At each join a
window of tokens around the cut is encoded again; it grows until its first and last token equal those of the parts.
Then every pair of neighbouring tokens is one that the merges leave alone, so that the whole is what the library
gives for the unit as one string.

Defined results: a null or empty text has no tokens and decodes to the empty text. Rows pass one by one, so repeated
rows and ties change nothing; other columns stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockaudit.llm.common import free_name, small, table, texts_of, through_arrow, worker_state
from stockaudit.llm.pieces import PieceEncoder

LONG = 8192
LEAF = 4096
#: Only a run this long can hold a unit of more than LEAF bytes.
RUN = re.compile(rf"\S{{{LEAF // 4}}}|\s{{{LEAF // 4}}}")
VOCABULARY = "byte_bpe_50k.json"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _lists(ids: list[np.ndarray]) -> pa.Array:
    sizes = np.fromiter((len(x) for x in ids), np.int32, len(ids))
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                                    pa.array(flat.astype(np.int32, copy=False)))


# --- tree concatenation -----------------------------------------------------------------------

def halves(unit: str, leaf: int = LEAF) -> list[str]:
    """The unit halved until no part is longer than ``leaf``, in order."""
    if len(unit) <= leaf:
        return [unit]
    mid = len(unit) // 2
    return halves(unit[:mid], leaf) + halves(unit[mid:], leaf)


def join(left: np.ndarray, right: np.ndarray, spell, encode) -> np.ndarray:
    """The tokens of both parts as one string: the window around the cut grows until both its ends agree."""
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    k = 1
    while True:
        a, z = max(0, len(left) - k), min(len(right), k)
        window = np.concatenate([left[a:], right[:z]])
        again = np.array(encode("".join(spell(i) for i in window.tolist())), left.dtype)
        if (a == 0 or again[0] == left[a]) and (z == len(right) or again[-1] == right[z - 1]):
            return np.concatenate([left[:a], again, right[z:]])
        k *= 2


def concatenate(parts: list[np.ndarray], spell, encode) -> np.ndarray:
    """The parts of one unit joined pairwise, level by level."""
    while len(parts) > 1:
        parts = [join(parts[i], parts[i + 1], spell, encode) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


AS_IT_IS, UNITS, LEAVES = range(3)


def _between_added(text: str, library) -> Iterator[tuple[bool, str]]:
    """The text cut at its added tokens where a long run lies between them: (whether the library takes it as it is, part).

    The library cuts there too, before anything else. Stretches of added tokens and ordinary text stay together.
    """
    added = library.get_added_tokens_decoder().values()
    held = sorted((t.content for t in added if t.content in text), key=len, reverse=True)
    if not held:
        yield False, text
        return
    if library.normalizer is not None or any(t.lstrip or t.rstrip or t.single_word for t in added):
        yield True, text  # tokens that are matched, or take in their surroundings, by rules of their own
        return
    whole, size = [], 0
    for part in re.split(f"({'|'.join(map(re.escape, held))})", text):
        run = RUN.search(part)
        if whole and (run or size > 1 << 20):
            yield True, "".join(whole)
            whole, size = [], 0
        if run:
            yield False, part
        elif part:
            whole.append(part)
            size += len(part)
    if whole:
        yield True, "".join(whole)


def _segments(text: str, library) -> Iterator[tuple[int, int, str]]:
    """(kind, number of the unit, text as it is or characters in the vocabulary's alphabet)."""
    unit = 0
    for whole, part in _between_added(text, library):
        if whole:
            yield AS_IT_IS, unit, part
            unit += 1
            continue
        plain, size = [], 0
        for piece, _ in library.pre_tokenizer.pre_tokenize_str(part):
            long = len(piece) > LEAF
            if plain and (long or size >= 1 << 20):
                yield UNITS, unit, "\n".join(plain)
                unit += 1
                plain, size = [], 0
            if long:
                for leaf in halves(piece):
                    yield LEAVES, unit, leaf
                unit += 1
            else:
                plain.append(piece)
                size += len(piece)
        if plain:
            yield UNITS, unit, "\n".join(plain)
            unit += 1


def _split_long(path: str, keep: str, text: str):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = PieceEncoder.of(path).library
        for batch in small(batches):
            rows = batch.column(batch.schema.names.index(keep)).to_pylist()
            for row, x in zip(rows, texts_of(batch, text)):
                for n, (kind, unit, part) in enumerate(_segments(x, library)):
                    yield pa.RecordBatch.from_pylist(
                        [dict(row=row, place=n, unit=unit, kind=kind, part=part)], schema=pa.schema(
                            [("row", pa.int64()), ("place", pa.int32()), ("unit", pa.int32()), ("kind", pa.int32()),
                             ("part", pa.string())]))
    return split


def _encode_parts(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = PieceEncoder.of(path).library
        tokens = library.model.tokenize
        for batch in small(batches):
            kinds, made = batch.column(3).to_pylist(), []
            for kind, part in zip(kinds, texts_of(batch, "part")):
                if kind == AS_IT_IS:
                    ids = library.encode(part, add_special_tokens=False).ids
                else:  # units in the vocabulary's alphabet, which has no line feed
                    ids = [t.id for unit in part.split("\n") for t in tokens(unit)]
                made.append(np.array(ids, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], _lists(made)], names=["row", "place", "unit", "kind", "ids"])
    return encode


def _join_parts(path: str):
    def joined(key, parts: pd.DataFrame) -> pd.DataFrame:
        library = PieceEncoder.of(path).library
        encode = lambda s: [t.id for t in library.model.tokenize(s)]
        parts = parts.sort_values("place")
        out = []
        for _, same in parts.groupby("unit", sort=True):
            ids = [np.asarray(x, np.int32) for x in same["ids"]]
            out.append(concatenate(ids, library.id_to_token, encode) if same["kind"].iloc[0] == LEAVES else ids[0])
        return pd.DataFrame({"row": [key[0]], "ids": [np.concatenate(out)]})
    return joined


# --- the operator -----------------------------------------------------------------------------

def encode(docs: DataFrame, path: str | None = None, text: str = "text", tokens: str = "tokens",
           decoded: str | None = None) -> DataFrame:
    """``docs`` and an array column ``tokens``: the ids the library gives without special tokens added.

    With ``decoded``, also a column of that name with the text that the ids spell, made in the same pass. Where ``docs``
    has such columns, the new ones' names are lengthened by ``_``.
    """
    path = path or default_vocabulary()
    tokens, decoded = free_name(docs, tokens), decoded and free_name(docs, decoded)
    long_run = F.coalesce(F.col(text).rlike(rf"\S{{{LONG}}}|\s{{{LONG}}}"), F.lit(False))

    def ordinary(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        ids = PieceEncoder.of(path).encode([x or "" for x in texts_of(batch, text)])
        made = {tokens: _lists(ids)}
        if decoded:
            made[decoded] = pa.array([Spelling.of(path).decode(x) for x in ids], pa.string())
        return made

    fields = f"`{tokens}` array<int>" + (f", `{decoded}` string" if decoded else "")
    short = through_arrow(docs.where(~long_run), fields, ordinary, 2 << 20)
    row = free_name(docs, "row")
    numbered = docs.where(long_run).withColumn(row, F.monotonically_increasing_id())
    parts = numbered.select(row, text).mapInArrow(
        _split_long(path, row, text), "row long, place int, unit int, kind int, part string")
    made = parts.repartition("row", "place").mapInArrow(
        _encode_parts(path), "row long, place int, unit int, kind int, ids array<int>")
    long = made.groupBy("row").applyInPandas(_join_parts(path), "row long, ids array<int>")
    long = long.select(F.col("row").alias(row), F.col("ids").alias(tokens))
    long = numbered.join(long, row).select(*docs.columns, tokens)
    return short.unionByName(decode(long, path, tokens, decoded) if decoded else long)


class Spelling:
    """The bytes of every token of a vocabulary, for decoding."""

    def __init__(self, path: str):
        library = PieceEncoder.of(path).library
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        alphabet = {chr(b): b for b in shown}
        alphabet |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(shown))}
        words = [library.id_to_token(i) or "" for i in range(library.get_vocab_size())]
        spelt = [bytes(alphabet[c] for c in w) if all(c in alphabet for c in w) else w.encode() for w in words]
        self.size = np.array([len(x) for x in spelt], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(spelt), np.uint8)

    @classmethod
    def of(cls, path: str) -> Spelling:
        known = worker_state().setdefault("spellings", {})
        if path not in known:
            known[path] = cls(path)
        return known[path]

    def decode(self, ids: np.ndarray) -> str:
        """As the library's ``decode(ids, skip_special_tokens=False)``; ids beyond the vocabulary are skipped."""
        if len(ids) > 1 << 20:
            return b"".join(self._bytes(ids[i:i + (1 << 20)]) for i in range(0, len(ids), 1 << 20)).decode("utf-8", "replace")
        return self._bytes(ids).decode("utf-8", "replace")

    def _bytes(self, ids: np.ndarray) -> bytes:
        ids = ids[(ids >= 0) & (ids < len(self.size))]
        size = self.size[ids]
        upto = np.cumsum(size)
        if not len(ids):
            return b""
        return self.pool[np.repeat(self.at[ids] - (upto - size), size) + np.arange(upto[-1])].tobytes()


def decode(rows: DataFrame, path: str | None = None, tokens: str = "tokens", text: str = "decoded") -> DataFrame:
    """``rows`` and the text that the ids in ``tokens`` spell; null ids give the empty text."""
    path, text = path or default_vocabulary(), free_name(rows, text)

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        at = batch.column(batch.schema.names.index(tokens))
        offsets, ids = at.offsets.to_numpy(), at.values.to_numpy(zero_copy_only=False)
        spelling = Spelling.of(path)
        return {text: pa.array([spelling.decode(ids[a:z]) for a, z in zip(offsets[:-1], offsets[1:])], pa.string())}

    return through_arrow(rows, f"`{text}` string", work)


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))


def round_trip(docs: DataFrame) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    coded = encode(docs.select("doc_id", "text"), decoded="decoded").drop("text")
    return coded.select(
        "doc_id", F.size("tokens").cast(T.LongType()).alias("n_tokens"),
        F.sha2(F.array_join("tokens", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
