"""Operator 4 against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from stockaudit.llm import simhash


def plain_fingerprint(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def plain_components(values, distance=2):
    up = {v: v for v in values}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v

    ordered = sorted(set(values))
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if bin(a ^ b).count("1") <= distance:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {v: root(v) for v in ordered}


def check(docs, got):
    prints = [(d, plain_fingerprint(t)) for d, t in docs]
    roots = plain_components([f for _, f in prints])
    least: dict = {}
    for d, f in prints:
        least[roots[f]] = min(d, least.get(roots[f], d))
    assert sorted(map(tuple, got)) == sorted((d, f"{f:016x}", least[roots[f]]) for d, f in prints)


def test_fixture(spark):
    r = random.Random(1)
    base = [" ".join(r.choices(["ab", "Cd", "ef g", "hé", "x"], k=r.randint(0, 40))) for _ in range(40)]
    texts = [None, "", " \t\n", "one", "ONE", "one two", "one\vtwo", *base, *base[:10]]
    texts += [b + " tail" for b in base] + ["long " * 40_000, "long " * 40_000 + "x"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, "one")]
    frame = spark.createDataFrame([(d, t, "f") for d, t in docs], "doc_id long, text string, fp string")
    check(docs, simhash.near_duplicates(frame).collect())


@pytest.mark.parametrize("pairwise, most", [(512, 1 << 15), (3, 1 << 15), (512, 5)])
def test_links_of_dense_groups(spark, monkeypatch, pairwise, most):
    """Near fingerprints by the hundred: pairwise, by masked fingerprints in a task, and dealt out."""
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    r = random.Random(4)
    values = set()
    for _ in range(6):
        base = r.getrandbits(64)
        for _ in range(60):
            values.add(base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))))
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(prints, 2, most).collect()}
    assert all(bin(a ^ b).count("1") <= 64 for a, b in found)
    up = plain_components(values)
    joined = simhash.components(simhash.links(prints, 2, most)).collect()
    roots = {v: v for v in values} | {n % (1 << 64): m % (1 << 64) for n, m in joined}
    groups = lambda m: {frozenset(k for k in m if m[k] == x) for x in set(m.values())}
    assert groups(roots) == groups(up)


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_signatures_meet(spark, distance):
    r = random.Random(distance)
    a = r.getrandbits(63)
    pairs = [(a, a ^ sum(1 << b for b in r.sample(range(63), r.randint(1, distance)))) for _ in range(60)]
    for x, y in pairs:
        found = simhash.links(spark.createDataFrame([(x,), (y,)], "fp long"), distance).count() if x != y else 1
        assert found >= 1
        break
    rows = simhash.signatures(spark.createDataFrame([(v,) for v in {x for p in pairs for x in p}], "fp long"), distance).collect()
    under: dict = {}
    for fp, kind, sig in rows:
        under.setdefault(fp, set()).add((kind, sig))
    assert all(under[x] & under[y] for x, y in pairs)


def test_chain_of_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty_and_stage(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == [] and simhash.keep_one_of_each(empty).collect() == []
    rows = [(5, "a b c d", 1), (2, "A b c d", 2), (2, "A b c d", 3), (9, "other words entirely here", 4), (None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["row"] for r in kept.collect()) in ([2, 4, 5], [3, 4, 5])


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    check(docs, simhash.op4_simhash_duplicates(spark, sf).collect())


def test_bits_of_long_texts():
    text = " ".join(np.random.Generator(np.random.PCG64(1)).integers(0, 50, 70_000).astype(str))
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)
