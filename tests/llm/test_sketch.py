"""Operator 10 against plain Python."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from stockaudit.llm import sketch


def hashes_of(spark, lists):
    """XXH64 of lists of words as Spark chains it."""
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(lists)], "i int, w array<string>")
    return {r["i"]: r["h"] for r in rows.select("i", F.xxhash64("w").alias("h")).collect()}


def fingerprints(spark, texts):
    lists, owner = [], []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        own = [w[i:i + 5] for i in range(max(1, len(w) - 4))] if w else []
        owner.append(range(len(lists), len(lists) + len(own)))
        lists += own
    h = hashes_of(spark, lists) if lists else {}
    limit = -(1 << 63) + (1 << 60)
    out = []
    for o in owner:
        own = {h[i] for i in o}
        out.append(sorted(x for x in own if x < limit) or ([min(own)] if own else []))
    return out


def near(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain(spark, docs):
    order = sorted(docs, key=lambda d: -d[0])
    texts = [t or "" for _, t in order]
    edited = []
    for i, t in enumerate(texts):
        half = len(t) // 2
        edited.append(t[:len(t) - half] + texts[(i + 1) % len(texts)][:half])
    a, b = fingerprints(spark, texts), fingerprints(spark, edited)
    word = lambda f: ",".join(f"{x % (1 << 64):x}" for x in f)
    return sorted((d, len(t), hashlib.sha256(e.encode()).hexdigest(), word(a[i]), word(b[i]), near(a[i], b[i]),
                   near(a[i], a[(i + 1) % len(texts)])) for i, ((d, _), t, e) in enumerate(zip(order, texts, edited)))


def run(spark, docs, parts=3):
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, fp string").repartition(parts).cache()
    found = sketch.edited_likeness(frame)
    return sorted(tuple(r) for r in found.collect())


def rows_equal(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:])


def test_fixture(spark):
    r = random.Random(1)
    words = ["Ab", "é", "中文", "😀", "x1", "q\tq", "\n"]
    docs = [(i, " ".join(r.choices(words, k=r.randint(0, 120)))) for i in range(80)]
    docs += [(100, None), (101, ""), (102, "  "), (103, "one two"), (104, "One two"), (105, "long " * 30_000), (106, docs[5][1])]
    rows_equal(run(spark, docs), plain(spark, docs))


def test_order_over_partitions(spark):
    docs = [(i * 3, f"text {i} of some words and {i % 7} more") for i in range(2000)]
    rows_equal(run(spark, docs, 7), plain(spark, docs))


def test_ties_nulls_and_repeats(spark):
    docs = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other text"), (None, "no id"), (2, "b")]
    got = sorted(map(str, (r[:2] for r in run_any(spark, docs))))
    assert got == sorted(map(str, ((d, len(t)) for d, t in docs)))
    assert run_any(spark, [(4, "only one here")])[0][5:] == (pytest.approx(near_self(spark)), 1.0)
    assert run_any(spark, []) == []


def near_self(spark):
    return plain(spark, [(4, "only one here")])[0][5]


def run_any(spark, docs):
    return [tuple(r) for r in sketch.edited_likeness(spark.createDataFrame(docs, "doc_id long, text string")).collect()]


def test_containment_of_unequal_texts(spark):
    r = random.Random(3)
    long = [str(r.randint(0, 10**9)) for _ in range(40_000)]
    part = long[1000:9000]
    rows = spark.createDataFrame([(" ".join(part), " ".join(long), " ".join(long[:1004]))], "a string, b string, c string")
    for c in "abc":
        rows = sketch.with_fingerprint(rows, c, f"f{c}")
    got = rows.select(
        sketch.containment(F.col("fa"), F.col("fb")).alias("x"), sketch.likeness(F.col("fa"), F.col("fb")).alias("y"),
        (sketch.merged(F.col("fa"), F.col("fc")) == F.array_sort(F.array_union("fa", "fc"))).alias("z")).first()
    assert got["x"] == 1.0 and abs(got["y"] - 0.2) < 0.05 and got["z"]


def test_native(spark):
    plan = sketch.op10_sketch(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    rows_equal(sorted(tuple(r) for r in sketch.op10_sketch(spark, sf).collect()), plain(spark, docs))
