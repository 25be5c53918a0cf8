"""Operator 11 against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stockaudit.llm import importance
from stockaudit.llm.position_crc import BLOCK, PositionCrc

SCHEMA = "doc_id long, text string, score string, uid int, place int, `Rank` string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def features(text, n_gram):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) for n in range(1, n_gram + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, n_gram=1, buckets=10_000, percent=10, least=20):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(f % buckets for f in features(x, n_gram))
    for x in target:
        t.update(f % buckets for f in features(x, n_gram))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
            for b in range(buckets)]
    rows = []
    for i, (d, x) in enumerate(docs):
        f = features(x, n_gram)
        weight = sum(gain[v % buckets] for v in f)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(x)), i])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[6]))
    for n, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = n
    return sorted((tuple(r[:5]) for r in rows), key=str)


def texts(n, seed=3):
    rng = random.Random(seed)
    vocabulary = [*"alpha beta gamma DELTA éclair Straße 12 naïve x1y 日本語".split(), *(f"w{i}" for i in range(60))]
    out = []
    for i in range(n):
        out.append(rng.choice([" ", "-", "\n", ", "]).join(rng.choices(vocabulary, k=rng.choice([0, 3, 25, 40, 80]))))
    return [*out, None, "", " .,;", "a" * 70_000, "b" * 3000 + " " + "b" * 3000, *[out[-1]] * 40]


def run(spark, docs, target, parts=3, n_gram=1, **options):
    frame = spark.createDataFrame([(*d, "x", 1, 2, "y") for d in docs], SCHEMA).repartition(parts)
    goal = spark.createDataFrame([(x,) for x in target], "text string")
    rows = importance.scored(frame.select("doc_id", "text"), goal, n_gram=n_gram, keep_text=False)
    made = importance.draw(rows, **options).select("doc_id", "n_features", "weight", "score", "rank")
    return sorted((tuple(r) for r in made.collect()), key=str)


@pytest.mark.parametrize("n_gram", [1, 3])
def test_equal_to_plain_python(spark, n_gram):
    docs = list(enumerate(texts(150)))
    target = ["alpha beta gamma delta w1 w2 w3", None, "éclair w5 W6"]
    assert run(spark, docs, target, n_gram=n_gram) == plain(docs, target, n_gram)


def test_repeated_and_null_ids(spark):
    docs = [(rng, x) for rng, x in zip([5, 5, None, 7, None] * 40, texts(100))]
    assert run(spark, docs, ["w1 w2"], percent=50) == plain(docs, ["w1 w2"], percent=50)


def test_empty_tables(spark):
    assert run(spark, [], ["a"]) == []
    docs = list(enumerate(texts(30)))
    assert run(spark, docs, []) == plain(docs, [])


def test_resample_keeps_columns(spark):
    docs = list(enumerate(texts(60)))
    frame = spark.createDataFrame([(*d, "x", 1, 2, "y") for d in docs], SCHEMA).repartition(4)
    goal = spark.createDataFrame([("w1 w2",)], "text string")
    kept = importance.resample(frame, goal, percent=30)
    assert kept.columns == frame.columns
    want = {r[0] for r in plain(docs, ["w1 w2"], percent=30) if r[4]}
    assert {r["doc_id"] for r in kept.collect()} == want
    assert all(r["text"] == docs[r["doc_id"]][1] and r["score"] == "x" for r in kept.collect())


def test_ranks_over_many_ranges(spark):
    """A change of cores between the reads of the stored rows changes nothing."""
    rows = spark.range(5000).selectExpr("id as doc_id", "30L as n_words", "id % 7 as score")
    folder = importance.stored(rows, "rows")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        got = {r["doc_id"]: r["rank"] for r in importance.draw(folder, percent=50).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    order = sorted(range(5000), key=lambda i: (-(i % 7), i))
    assert got == {d: (n if n <= 2500 else None) for n, d in enumerate(order, 1)}


def test_checksums_of_any_length():
    rng = random.Random(1)
    data = rng.randbytes(1 << 18)
    spans = [(rng.randrange(1000), n) for n in [0, 1, 2, BLOCK - 1, BLOCK, BLOCK + 1, 2 * BLOCK, 2 * BLOCK + 1, 100_000, 260_000]]
    spans += [(rng.randrange(200_000), rng.randrange(2000)) for _ in range(3000)]
    at, size = (np.array(x) for x in zip(*spans))
    got = PositionCrc().of(np.frombuffer(data, np.uint8), at, size)
    assert got.tolist() == [zlib.crc32(data[a:a + n]) for a, n in spans]
