"""Language identification (operator 5): sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of 1 to ``MAX_N`` characters, lower-cased, are hashed into ``2 ** BITS`` features. Document frequencies come from every
training document. The weights are learned by follow-the-regularised-leader with elastic-net penalties
(the L1 part keeps them sparse) from a sample of the training documents, and a temperature fitted on a part of the sample that
the weights have not seen calibrates the probabilities.

The sample is the one bounded thing: about ``sample`` labelled documents (a documented parameter, default 8,000), chosen by a
hash of id and text so that each language has up to its equal share. It is fitted in one task. Predictions read whole texts.

Defined results: a null text or one without a letter is ``und`` with score 0. Rows pass one by one, so
repeated rows and ties change nothing. Without any labelled training document every text is ``und``. Extra columns
stay as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockaudit.llm.common import free_name, table, texts_of, through_arrow

BITS = 15
MAX_N = 3
SAMPLE = 8_000
UNKNOWN = "und"
MIN_SCORE = 0.3

_CHUNK = 1 << 20


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    return F.crc32(doc_id.cast("string")) % folds == fold


def grams(text: str) -> np.ndarray:
    """The features of every n-gram of a text, repeats included. N-grams across chunk borders are kept."""
    out = []
    text = text.lower()
    for start in range(0, len(text), _CHUNK):
        c = np.frombuffer(text[max(0, start - MAX_N + 1):start + _CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        old = start - max(0, start - MAX_N + 1)
        h = np.zeros(len(c), np.uint32)
        for n in range(1, MAX_N + 1):
            if len(c) < n:
                break
            h = (h[:len(c) - n + 1] + c[n - 1:]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            out.append((h * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS))[max(0, old - n + 1):])
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(feature, number of documents that have it), over all of ``docs``."""
    def count(batches):
        total = np.zeros(1 << BITS, np.int64)
        seen = np.zeros(1 << BITS, bool)
        for batch in batches:
            for x in texts_of(batch, text):
                seen[grams(x or "")] = True
                total += seen
                seen[:] = False
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["feature", "n"])

    return docs.select(text).mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


class Model:
    """Languages, a weight per feature and language (the IDF is part of it), a bias per language, and the temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.languages, self.weights, self.bias, self.temperature = languages, weights, bias, temperature

    def parts(self) -> tuple:
        """What a broadcast carries: plain values, since workers need not have this class."""
        return self.languages, self.weights, self.bias, self.temperature

    def logits(self, text: str) -> np.ndarray:
        g = grams(text)
        counts = np.bincount(g, minlength=1 << BITS) if len(g) > 4096 else None
        if counts is not None:
            return counts.astype(np.float32) @ self.weights / len(g) * SCALE + self.bias
        return self.weights[g].sum(axis=0) / max(1, len(g)) * SCALE + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


#: Term frequencies are shares of a text's n-grams; this brings them to about 1.
SCALE = 32.0


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 3, alpha: float = 0.3,
         beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> np.ndarray:
    """FTRL-proximal with per-coordinate rates. Examples: features, values, class. The last row of weights is the bias."""
    size = (1 << BITS) + 1
    z, n = np.zeros((size, classes)), np.zeros((size, classes))

    def weights(at):
        za, na = z[at], n[at]
        w = -(za - np.sign(za) * l1) / ((beta + np.sqrt(na)) / alpha + l2)
        return np.where(np.abs(za) <= l1, 0.0, w)

    order = np.random.Generator(np.random.PCG64(5))
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            at, value, label = examples[i]
            w = weights(at)
            score = value @ w
            p = np.exp(score - score.max())
            p /= p.sum()
            p[label] -= 1.0
            g = value[:, None] * p
            g2 = g * g
            z[at] += g - (np.sqrt(n[at] + g2) - np.sqrt(n[at])) / alpha * w
            n[at] += g2
    return weights(slice(None))


def temperature_of(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least log loss."""
    def loss(t):
        s = logits / t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), labels]).mean())

    tried = np.geomspace(0.05, 20, 120)
    return float(min(tried, key=loss)) if len(logits) else 1.0


def fit(rows: list[tuple[str, str]], idf: np.ndarray) -> Model:
    """A model from (text, language) pairs; every fifth is kept for the temperature."""
    languages = sorted({r[1] for r in rows})
    if not languages:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0, np.float32), 1.0)
    examples = []
    for text, language in rows:
        g = grams(text)
        at, counts = np.unique(g, return_counts=True)
        value = counts / max(1, len(g)) * SCALE * idf[at]
        examples.append((np.append(at, 1 << BITS), np.append(value, 1.0), languages.index(language)))
    train = [e for i, e in enumerate(examples) if i % 5] or examples
    w = ftrl(train, len(languages))
    rest = [e for i, e in enumerate(examples) if not i % 5]
    t = temperature_of(np.array([v @ w[a] for a, v, _ in rest]), np.array([y for *_, y in rest]))
    return Model(languages, (w[:-1] * idf[:, None]).astype(np.float32), w[-1].astype(np.float32), t)


def train(docs: DataFrame, sample: int = SAMPLE, text: str = "text", language: str = "lang", doc_id: str = "doc_id") -> Model:
    """Learns from the rows with a language. Frequencies are taken over all of them, the weights from a bounded sample."""
    labelled = docs.where(F.col(language).isNotNull() & F.col(text).isNotNull())
    labelled = labelled.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(language).alias("lang"))
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().orderBy("lang").limit(sample).collect()}
    if not sizes:
        return fit([], np.ones(1 << BITS))
    share = sample / len(sizes)
    chance = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, share / n))))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.where(draw < chance[F.col("lang")])

    df = np.zeros(1 << BITS)
    total = sum(sizes.values())
    frequencies = document_frequencies(labelled).toPandas()  # at most 2 ** BITS rows
    df[frequencies["feature"].to_numpy(np.int64)] = frequencies["n"].to_numpy()
    idf = np.log((1 + total) / (1 + df)) + 0.1

    def learn(batches):
        rows = [(t, y) for b in batches for t, y in zip(texts_of(b, "text"), b.column(1).to_pylist())]
        m = fit(rows, idf)
        yield pd_batch(m)

    def pd_batch(m: Model) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([m.languages], pa.list_(pa.string())), pa.array([m.weights.tobytes()], pa.binary()),
            pa.array([m.bias.tobytes()], pa.binary()), pa.array([m.temperature])], names=["languages", "w", "b", "t"])

    r = (chosen.select("text", "lang", "doc_id").repartition(1).sortWithinPartitions("doc_id", "text").select("text", "lang")
         .mapInArrow(learn, "languages array<string>, w binary, b binary, t double").first())
    languages = list(r["languages"])
    return Model(languages, np.frombuffer(r["w"], np.float32).reshape(-1, len(languages)), np.frombuffer(r["b"], np.float32), r["t"])


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, lengthened by ``_`` where such columns exist."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model.parts())  # 2 ** BITS weights per language
    pred, score = free_name(docs, "lang_pred"), free_name(docs, "score")

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        model = Model(*sent.value)
        made = [model.predict(x) for x in texts_of(batch, text)]
        return {pred: pa.array([m[0] for m in made], pa.string()), score: pa.array([m[1] for m in made], pa.float64())}

    return through_arrow(docs, f"`{pred}` string, `{score}` double", work)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = MIN_SCORE) -> DataFrame:
    """Pipeline stage: the rows whose language is known with a score of ``least`` or more, with their own columns."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    sent = docs.sparkSession.sparkContext.broadcast(model.parts())

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        model = Model(*sent.value)
        return {"keep": pa.array([model.predict(x)[1] >= least for x in texts_of(batch)])}

    return through_arrow(docs, "", work)
