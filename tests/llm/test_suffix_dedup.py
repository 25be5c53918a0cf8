"""Operator 2 against a table of all windows; the index against plain comparison."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stockaudit.llm import suffix_dedup as d
from stockaudit.llm.rlbwt import RunLengthIndex, suffix_array


def plain(docs, length):
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(t[p:p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for doc_id, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = True
        gone = gone[:len(t)]
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, docs, **more):
    frame = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, n_bytes int")
    return sorted((tuple(r) for r in d.remove_repeats(frame, **more).collect()), key=str)


def fixture(seed, n=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdeé", k=r.randint(1, 7)))
    text = lambda k: " ".join(word() for _ in range(k))
    passages = [text(r.randint(6, 40)) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = [text(r.randint(0, 20))]
        for _ in range(r.randint(0, 2)):
            parts += [r.choice(passages), text(r.randint(0, 12))]
        docs.append((i, " ".join(parts)))
    for i in range(n, n + 20):  # near copies
        t = list(docs[i % 7][1])
        for _ in range(r.randint(0, 3)):
            t[r.randrange(len(t))] = "Z"
        docs.append((i, "".join(t)))
    docs += [(200, None), (201, ""), (202, "short"), (3, docs[3][1]), (None, docs[4][1]), (203, "a" * 500), (204, "for " * 200),
             (205, "ab" * 30 + "c" + "ab" * 40), (206, passages[0]), (207, passages[0] + "x")]
    return docs


@pytest.mark.parametrize("seed, length, sample, group", [
    (1, 40, 20, 2048), (2, 40, 25, 3), (3, 60, 30, 2), (4, 100, 10, 5), (5, 40, 1, 4)])
def test_equals_all_windows(spark, seed, length, sample, group):
    docs = fixture(seed)
    assert run(spark, docs, length=length, sample=sample, group=group) == plain(docs, length)


def test_hot_passage_is_split(spark):
    """One passage in every document, each time between other texts: one key holds them all."""
    r = random.Random(8)
    noise = lambda: "".join(r.choices("xyzuvw", k=80))
    passage = "".join(r.choices("abcdef", k=90))
    docs = [(i, noise() + passage + noise()) for i in range(150)]
    assert run(spark, docs, length=40, sample=20, group=8) == plain(docs, 40)


def test_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(d, "_BLOCK", 100)
    docs = fixture(6, 30) + [(300, "q" * 1000), (301, "xyz" * 400 + "end" + "xyz" * 100)]
    assert run(spark, docs, length=40, sample=20, group=50) == plain(docs, 40)


def test_default_lengths(spark):
    r = random.Random(9)
    base = "".join(r.choices("abcdefgh ", k=3000))
    docs = [(0, base), (1, base[:1500] + "#" + base[1500:]), (2, "x" * 399), (3, "x" * 399), (4, base[500:900] + "y"),
            (5, base[700:1099]), (6, "w" * 401), (7, "z" * 400)]
    assert run(spark, docs) == plain(docs, d.LENGTH)


def test_empty_table(spark):
    assert run(spark, []) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_index(values):
    s = np.array(values, np.int64)
    assert suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: values[i:])
    index = RunLengthIndex(s)
    assert index.lengths.sum() == len(s)
    got = index.matching_statistics(20)
    for i in range(len(s)):
        best = 0
        for j in range(len(s)):
            n = 0
            while i != j and max(i, j) + n < len(s) and s[i + n] == s[j + n]:
                n += 1
            best = max(best, n)
        assert got[i] == min(best, 20)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in d.op2_suffix_dedup(spark, sf).collect()), key=str)
    assert got == plain(docs, d.LENGTH) and any(r[2] for r in got)
