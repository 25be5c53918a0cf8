"""Toxicity by class-conditional Kneser-Ney models (operator 8).

Characters of words are predicted from the word so far. A shared Kneser-Ney model of order ``ORDER`` (absolute discounting,
continuation counts below the highest order) is built from toxic and ordinary training texts together. Each
class has its own discounted counts of the highest order and gives the mass it takes off to the shared model, so that
a rare expression that one class hasn't seen is as likely there as in all texts. Most words of a toxic text are ordinary
ones, so its likelihood mixes both models word by word. A text's score compares its log-likelihoods a word as a toxic
and as an ordinary text; a logistic curve makes it a probability.

Counts come from every training text but those kept for the curve (a tenth by hash of id and text, of which at most
about ``CURVE_ROWS`` are used). They are joins and groupings over the table of distinct n-grams. What workers get is the log ratio
of each n-gram and of each context's backoff weight, hashed into a fixed number of slots (``SLOTS``), so the broadcast has
at most 49 MB whatever the corpus. Only taken slots travel, with a bit for each slot that tells which they are. A slot holds its most frequent n-gram, known by 31 more bits of its hash, and tells whether there
are others. A word with an n-gram that may be one of these others is left open; open words get their ratio by joins with the
table of all n-grams and add it to their texts. So every n-gram has its own value.

Only the difference of the two log-likelihoods is kept, since what the models share cancels out.

Defined results: null, empty and one-character texts are scored by the curve at a ratio of 0. If no training text has one of
the labels, every score is 0. Several labels for one id: toxic if any is. Repeated documents are scored one by one and counted
as often as they occur. Extra columns stay.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockaudit.llm.common import free_name, stored, table, texts_of, through_arrow

ORDER = 6
DISCOUNT = 0.75
STRENGTH = 20.0  # occurrences of the shared model added to each context of a class
CURVE_ROWS = 20_000
THRESHOLD = 0.7
TOXIC_SHARE = 0.02  # of a toxic text's words are drawn from the toxic model, the others from the ordinary one
PRIOR_WORDS = 4  # added to a text's length, so that a few words don't decide
#: Slots, as powers of two, of the log ratios of n-grams and of contexts.
SLOTS = {"gram": 22, "context": 21}
_SLOT = np.dtype([("value", np.float32), ("mark", np.uint32)])
_PIECE = 1 << 16
_CHUNK = 1 << 20
_WORD = re.compile(r"[^\W\d_]+")
_GAP = " " * (ORDER - 1)


def held_out(doc_id, folds: int = 3, fold: int = 1):
    return F.crc32(doc_id.cast("string")) % folds == fold


def characters(text: str | None) -> np.ndarray:
    """Code points of a text's words, lower-cased, with so many spaces between that no n-gram spans two words."""
    words = _WORD.findall((text or "").lower())
    return np.frombuffer(_GAP.join(["", *words, ""]).encode("utf-32-le"), np.uint32) if words else np.zeros(0, np.uint32)


def ends(c: np.ndarray) -> np.ndarray:
    """Where the n-grams of the highest order start that end in a letter or right behind a word."""
    last = c[ORDER - 1:]
    return np.flatnonzero((last != 32) | (c[ORDER - 2:-1] != 32)) if len(c) >= ORDER else np.zeros(0, np.int64)


def hashes(c: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all n-grams of a code point array."""
    h = np.zeros(max(0, len(c) - n + 1), np.uint64)
    for j in range(n):
        h = (h + c[j:len(h) + j] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def slots(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def marks(h: np.ndarray, bits: int) -> np.ndarray:
    """31 bits of the hashes behind those of the slots."""
    return ((h >> np.uint64(33 - bits)) & np.uint64((1 << 31) - 1)).astype(np.int64)


def count_grams(labelled: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary): how often each n-gram of the highest order occurs in texts of either class."""
    def count(batches):
        known = {}  # class -> (hashes, counts, code points)
        for batch in batches:
            labels = batch.column(1).to_pylist()
            per = {0: [], 1: []}
            for x, label in zip(texts_of(batch, "text"), labels):
                per[label].append(characters(x))
            for label, parts in per.items():
                while parts:
                    some, size = [], 0
                    while parts and size < _CHUNK:
                        some.append(parts.pop())
                        size += len(some[-1])
                    known[label] = merge(known.get(label), some)
                    if len(known[label][0]) > 1 << 20:  # bounded memory: what was counted so far goes out
                        yield rows(label, known.pop(label))
        for label, value in known.items():
            yield rows(label, value)

    def merge(old, parts):
        c = np.concatenate(parts)  # each begins and ends with a gap
        h = hashes(c, ORDER)
        at = ends(c)
        new, first, counts = np.unique(h[at], return_index=True, return_counts=True)
        grams = c[at[first][:, None] + np.arange(ORDER)] if len(new) else np.zeros((0, ORDER), np.uint32)
        if old is None:
            return new, counts, grams
        keys, first, inverse = np.unique(np.concatenate([old[0], new]), return_index=True, return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([old[1], counts])).astype(np.int64), np.concatenate([old[2], grams])[first]

    def rows(label, value):
        _, counts, grams = value
        zero = np.zeros(len(counts), np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(_strings(grams), pa.string()), pa.array(counts if label else zero), pa.array(zero if label else counts)],
            names=["gram", "toxic", "ordinary"])

    found = labelled.select("text", "toxic").mapInArrow(count, "gram string, toxic long, ordinary long")
    return found.groupBy("gram").agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o"))


def _strings(grams: np.ndarray) -> list[str]:
    whole = grams.astype("<u4").tobytes().decode("utf-32-le", "replace")
    return [whole[i:i + ORDER] for i in range(0, len(whole), ORDER)]


def shared_model(counts: DataFrame) -> DataFrame:
    """(gram, shared): the probability of each n-gram's last character by interpolated Kneser-Ney over both classes."""
    by_order = {ORDER: counts.select("gram", (F.col("t") + F.col("o")).alias("n"))}
    for n in range(ORDER - 1, 0, -1):  # how many characters precede each shorter n-gram
        longer = by_order[n + 1]
        by_order[n] = stored(longer.groupBy(F.substring("gram", 2, n).alias("gram")).agg(F.count("*").alias("n")), f"grams{n}")
    total = by_order[1].agg(F.sum("n").alias("total")).first()[0] or 1
    lower = by_order[1].select("gram", (F.col("n") / F.lit(total)).alias("shared"))
    for n in range(2, ORDER + 1):
        grams = by_order[n].withColumn("context", F.substring("gram", 1, n - 1)).withColumn("rest", F.substring("gram", 2, n - 1))
        contexts = grams.groupBy("context").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
        below = lower.select(F.col("gram").alias("rest"), F.col("shared").alias("below"))
        lower = grams.join(contexts, "context").join(below, "rest").select(
            "gram", ((F.col("n") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("below")) / F.col("all")).alias("shared"))
        lower = stored(lower, f"order{n}")
    return lower


def exact_ratios(counts: DataFrame) -> dict[str, DataFrame]:
    """(gram, n, value) by kind: log ratios, toxic to ordinary, of the n-grams and of the contexts' weight of the shared model."""
    seen = lambda c: F.sum((F.col(c) > 0).cast("long"))
    grams = counts.withColumn("context", F.substring("gram", 1, ORDER - 1))
    contexts = grams.groupBy("context").agg(
        F.sum("t").alias("all_t"), F.sum("o").alias("all_o"), seen("t").alias("kinds_t"), seen("o").alias("kinds_o"))
    weight = lambda c: (STRENGTH + DISCOUNT * F.col(f"kinds_{c}")) / (STRENGTH + F.col(f"all_{c}"))
    contexts = stored(contexts.select("*", weight("t").alias("weight_t"), weight("o").alias("weight_o")), "contexts")
    own = lambda c: F.when(F.col(c) > 0, (F.col(c) - DISCOUNT) / (STRENGTH + F.col(f"all_{c}"))).otherwise(0.0)
    chance = lambda c: own(c) + F.col(f"weight_{c}") * F.col("shared")
    grams = grams.join(contexts, "context").join(shared_model(counts), "gram").select(
        "gram", (F.col("t") + F.col("o")).alias("n"), F.log(chance("t") / chance("o")).alias("value"))
    contexts = contexts.select("context", F.col("all_t") + F.col("all_o"), F.log(F.col("weight_t") / F.col("weight_o")))
    found = {"gram": grams, "context": contexts}
    return {kind: stored(rows.toDF("gram", "n", "value").withColumn("value", F.col("value").cast("float")), kind)
            for kind, rows in found.items()}


def ratios(counts: DataFrame, exact: dict[str, DataFrame] | None = None) -> DataFrame:
    """(kind, slot, value, mark): the most frequent member of each slot; the lowest bit of its mark is set if there are others."""
    exact = exact or exact_ratios(counts)
    return _slotted(exact["gram"], "gram", ORDER).union(_slotted(exact["context"], "context", ORDER - 1))


def _slotted(rows: DataFrame, kind: str, length: int) -> DataFrame:
    """(n-gram, frequency, value) rows by slot: at most one row each, the value of the most frequent member."""
    bits = SLOTS[kind]

    def place(batches):
        for batch in batches:
            grams = batch.column(0).to_pylist()
            c = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32)
            h = hashes(c, length)[::length] if grams else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(slots(h, bits)), pa.array(marks(h, bits))],
                names=["gram", "n", "value", "slot", "mark"])

    placed = rows.mapInArrow(place, "gram string, n long, value float, slot long, mark long")
    best = placed.groupBy("slot").agg(
        F.max(F.struct("n", "gram", "value", "mark")).alias("best"), (F.count("*") > 1).cast("long").alias("more"))
    return best.select(F.lit(kind).alias("kind"), "slot", "best.value", (F.col("best.mark") * 2 + F.col("more")).alias("mark"))


def tables_of(rows: DataFrame) -> dict[str, dict]:
    """The slots of each kind: a bit for each that is taken, the place of the first row of each 64, and the rows of the taken ones.

    Pieces of the slots are put together before they are collected; neither they nor the tables have room for empty slots.
    """
    piece = F.floor(F.col("slot") / _PIECE).cast("int").alias("piece")

    def fill(batches):
        made = {}
        for batch in batches:
            kinds, pieces = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            at, values, mark = batch.column(2).to_numpy() % _PIECE, batch.column(3).to_numpy(), batch.column(4).to_numpy()
            for key in set(zip(kinds, pieces.tolist())):
                own = np.array([k == key[0] for k in kinds]) & (pieces == key[1])
                taken, part = made.setdefault(key, (np.zeros(_PIECE, bool), np.zeros(_PIECE, _SLOT)))
                taken[at[own]] = True
                part["value"][at[own]], part["mark"][at[own]] = values[own], mark[own]
        for (kind, number), (taken, part) in made.items():
            yield pa.RecordBatch.from_pylist(
                [dict(kind=kind, piece=number, taken=np.packbits(taken, bitorder="little").tobytes(), data=part[taken].tobytes())],
                schema=pa.schema([("kind", pa.string()), ("piece", pa.int32()), ("taken", pa.binary()), ("data", pa.binary())]))

    words = {kind: np.zeros(max(1, (1 << bits) // 64), np.uint64) for kind, bits in SLOTS.items()}
    before = {kind: np.zeros(len(w), np.int32) for kind, w in words.items()}
    data = {kind: bytearray() for kind in SLOTS}
    pieces = rows.select("kind", piece, "slot", "value", "mark").repartition("kind", "piece").mapInArrow(
        fill, "kind string, piece int, taken binary, data binary")
    for r in pieces.toLocalIterator():  # 96 pieces of half a megabyte at most, in any order
        kind, first = r["kind"], r["piece"] * _PIECE // 64
        own = words[kind][first:first + _PIECE // 64]
        own[:] = np.frombuffer(r["taken"], "<u8")[:len(own)]
        counts = np.bitwise_count(own).astype(np.int32)
        before[kind][first:first + len(own)] = len(data[kind]) // _SLOT.itemsize + np.cumsum(counts) - counts
        data[kind] += r["data"]
    return {kind: {"bits": bits, "words": words[kind], "before": before[kind], "rows": np.frombuffer(data[kind], _SLOT)}
            for kind, bits in SLOTS.items()}


class Model:
    """Tables of log ratios by kind, the curve's slope and intercept, and the frames of all n-grams for what the tables leave open."""

    def __init__(self, tables: dict[str, dict], curve: tuple[float, float] | None = None,
                 exact: dict[str, DataFrame] | None = None):
        self.tables, self.curve, self.exact = tables, curve, exact
        self._sent: Broadcast | None = None

    def sent(self, spark: SparkSession) -> Broadcast:
        """The tables as workers get them: 8 bytes for each taken slot and 1.2 MB, at most 49 MB (see ``SLOTS``).

        One broadcast for all uses of a model: the driver and each executor keep its tables as a file as long as it lives.
        """
        if self._sent is None:
            self._sent = spark.sparkContext.broadcast(self.tables)
        return self._sent

    def ratio(self, text: str | None) -> float:
        """Log-likelihood ratio a word, toxic to ordinary, on a scale that is logarithmic far from 0, from the tables alone.

        A toxic text is one that mixes both classes' words. An n-gram that the tables leave open counts as unseen.
        """
        total, words, rest = self.parts(text, False)
        return float(np.arcsinh(total / (words + PRIOR_WORDS) / TOXIC_SHARE * 4))

    def parts(self, text: str | None, leave_open: bool = True) -> tuple[float, int, Counter]:
        """The sum over the decided words, the number of all words, and how often each open word occurs."""
        c = characters(text)
        total, words, rest = 0.0, 0, Counter()
        for start, stop in _spans(c):
            ratio, still, begins, after = self._words(c[start:stop])
            if leave_open:
                for i in np.flatnonzero(still):
                    rest[c[start + begins[i]:start + after[i]].astype("<u4").tobytes().decode("utf-32-le", "replace")] += 1
                ratio = ratio[~still]
            total += np.log1p(TOXIC_SHARE * np.expm1(ratio)).sum()
            words += len(still)
        return total, words, rest

    def _look_up(self, kind: str, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, NaN for what no training text has, and which of them are open."""
        table = self.tables[kind]
        at = slots(h, table["bits"])
        word, bit = table["words"][at >> 6], np.uint64(1) << (at & 63).astype(np.uint64)
        value, still = np.full(len(h), np.nan, np.float32), np.zeros(len(h), bool)
        taken = np.flatnonzero(word & bit)
        found = table["rows"][table["before"][at[taken] >> 6] + np.bitwise_count((word & (bit - np.uint64(1)))[taken])]
        same = found["mark"] >> 1 == marks(h[taken], table["bits"])
        value[taken[same]] = found["value"][same]
        still[taken] = ~same & (found["mark"] & 1 == 1)
        return value, still

    def _words(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ratio of each word of a stretch that begins and ends with a gap, whether it is open, and where it begins and ends."""
        starts = ends(c)
        value, still = self._look_up("gram", hashes(c, ORDER)[starts])
        unseen = np.flatnonzero(np.isnan(value))  # no training text has the n-gram: only the shared model's weight differs
        contexts = c[starts[unseen][:, None] + np.arange(ORDER - 1)]
        value[unseen], also = self._look_up("context", hashes(contexts.ravel(), ORDER - 1)[::ORDER - 1])
        still[unseen] |= also
        np.nan_to_num(value, copy=False)
        first = np.flatnonzero(c[starts + ORDER - 2] == 32)  # n-grams that end in a word's first letter
        if not len(first):
            return np.zeros(0), np.zeros(0, bool), first, first
        last = np.append(first[1:], len(starts)) - 1  # and right behind it
        return (np.add.reduceat(value.astype(np.float64), first), np.logical_or.reduceat(still, first),
                starts[first] + ORDER - 1, starts[last] + ORDER - 1)


def _spans(c: np.ndarray):
    """Stretches of about ``_CHUNK`` characters that begin and end with a whole gap."""
    start = 0
    while start < len(c) - ORDER:
        stop = min(len(c), start + _CHUNK)
        while stop < len(c) and not (c[stop - ORDER + 1:stop] == 32).all():
            stop += 1
        yield start, stop
        start = stop - ORDER + 1


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton's method with a small penalty on the scaled slope."""
    mean, scale = x.mean(), max(x.std(), 1e-9)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, ridge = np.zeros(2), np.diag([penalty, 1e-6]) * len(x)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1] - w[0] * mean / scale)


def _with_ratio(docs: DataFrame, model: Model, keep_text: bool = True) -> tuple[DataFrame, str]:
    """``docs`` with each text's ratio, and that column's name: open words are joined with all n-grams."""
    number, total, words, rest = (free_name(docs, n) for n in ("row", "total", "words", "rest"))
    sent = model.sent(docs.sparkSession)

    def work(batch):
        known = Model(sent.value)
        found = [known.parts(x) for x in texts_of(batch)]
        return {total: pa.array([float(t) for t, _, _ in found], pa.float64()), words: pa.array([n for _, n, _ in found], pa.int64()),
                rest: pa.array([[{"word": w, "n": n} for w, n in r.items()] for _, _, r in found],
                               pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))}

    part = through_arrow(docs.withColumn(number, F.monotonically_increasing_id()),
                         f"`{total}` double, `{words}` long, `{rest}` array<struct<word:string,n:long>>", work)
    part = stored(part if keep_text else part.drop("text"), "parts")  # the numbers stay
    left = part.where(F.size(rest) > 0).select(F.col(number).alias("row"), F.inline(rest))
    if not left.isEmpty():
        value = F.log1p(TOXIC_SHARE * F.expm1("ratio"))
        sums = left.join(_word_ratios(left.select("word").distinct(), model.exact), "word").groupBy("row").agg(
            F.sum(F.col("n") * value).alias("_more"))
        part = part.join(sums, part[number] == sums["row"], "left").drop(sums["row"])
        part = part.withColumn(total, F.col(total) + F.coalesce("_more", F.lit(0.0))).drop("_more")
    ratio = free_name(part, "ratio")
    return part.withColumn(ratio, F.asinh(F.col(total) / (F.col(words) + PRIOR_WORDS) / TOXIC_SHARE * 4)).drop(
        number, total, words, rest), ratio


def _word_ratios(words: DataFrame, exact: dict[str, DataFrame]) -> DataFrame:
    """(word, ratio) from the frames of all n-grams, by their letters; a word's n-grams go by its number, however long it is."""
    def cut(batches):
        for batch in batches:
            for key, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                c = np.frombuffer((_GAP + word + _GAP).encode("utf-32-le", "surrogatepass"), np.uint32)
                starts = ends(c)
                for i in range(0, len(starts), _PIECE):
                    grams = _strings(c[starts[i:i + _PIECE][:, None] + np.arange(ORDER)])
                    yield pa.RecordBatch.from_pydict({"key": [key] * len(grams), "gram": grams, "context": [g[:-1] for g in grams]})

    words = stored(words.select(F.monotonically_increasing_id().alias("key"), "word"), "words")  # the numbers stay
    grams = words.mapInArrow(cut, "key long, gram string, context string")
    gram = exact["gram"].select("gram", F.col("value").alias("own"))
    context = exact["context"].select(F.col("gram").alias("context"), F.col("value").alias("weight"))
    sums = grams.join(gram, "gram", "left").join(context, "context", "left").groupBy("key").agg(
        F.sum(F.coalesce("own", "weight", F.lit(0.0)).cast("double")).alias("ratio"))
    return words.join(sums, "key").select("word", "ratio")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from documents (doc_id, text) and labels (doc_id, toxic); rows without label 0 or 1 are left out."""
    marks = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    labelled = docs.where("text is not null").select("doc_id", "text").join(marks, "doc_id")
    for_curve = F.pmod(F.xxhash64("doc_id", "text"), F.lit(10)) == 0
    labelled = stored(labelled.withColumn("curve", for_curve), "labelled")
    sizes = {(r["curve"], r["toxic"]): r["count"] for r in labelled.groupBy("curve", "toxic").count().collect()}
    if not all(sizes.get((False, k)) for k in (0, 1)):
        return Model({})
    counts = stored(count_grams(labelled.where("not curve")), "grams")
    exact = exact_ratios(counts)
    model = Model(tables_of(ratios(counts, exact)), exact=exact)
    kept = sum(n for (curve, _), n in sizes.items() if curve)
    chance = min(1.0, CURVE_ROWS / max(1, kept))
    sample = labelled.where("curve").where(F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 30)) / float(1 << 30) < chance)
    seen, ratio = _with_ratio(sample.select("text", "toxic"), model, keep_text=False)
    seen = seen.select(ratio, "toxic").toPandas()
    if seen["toxic"].nunique() < 2:  # too few for a curve: even odds at equal likelihoods
        model.curve = (4.0, -2.0)
    else:
        model.curve = logistic(seen[ratio].to_numpy(), seen["toxic"].to_numpy(np.float64))
    return model


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep_text: bool = True) -> DataFrame:
    """``docs``, with or without the texts, and ``score`` and ``predicted``, lengthened by ``_`` where such columns exist."""
    score, predicted = free_name(docs, "score"), free_name(docs, "predicted")
    if model.curve is None:
        scored = (docs if keep_text else docs.drop("text")).withColumn(score, F.lit(0.0))
    else:
        slope, intercept = model.curve
        scored, ratio = _with_ratio(docs, model, keep_text)
        odds = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), slope * F.col(ratio) + intercept))
        scored = scored.withColumn(score, 1 / (1 + F.exp(-odds))).drop(ratio)
    return scored.withColumn(predicted, (F.col(score) >= threshold).cast("int"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = train(docs.where(~held_out(F.col("doc_id"))), labels.where(~held_out(F.col("doc_id"))))
    return score_toxicity(docs, model, keep_text=False).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
