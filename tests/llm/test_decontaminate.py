"""Operator 1 against a scan of all windows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from stockaudit.llm import decontaminate as d


def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        words = plain_words(text)
        hit, named = set(), set()
        for name, t in items:
            w = plain_words(t)
            size = min(len(w), window)
            wanted = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set()
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) in wanted:
                    hit.update(range(i, i + size))
                    named.add("" if name is None else str(name))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(named), digest, bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, hits int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found, names = d.find_contamination(frame, bench, **more)
    assert found.columns[:3] == ["doc_id", "text", "hits"] and names["hits"] == "hits_"
    rows = found.collect()
    for r in rows:
        if r["items"]:
            assert np.unpackbits(np.frombuffer(r["hits_"], np.uint8)).sum() == r["n_hit"]
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]),
                    hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["n_hit"] > 0) for r in rows), key=str)


def fixture(seed, alphabet=4):
    r = random.Random(seed)
    words = ["é", "Ab", "c1", "ZZ", "x", "中文", "q", "w"][:alphabet]
    text = lambda n: r.choice([" ", ", ", "\n"]).join(r.choices(words, k=n))
    items = [(i, text(r.randint(1, 30))) for i in range(12)] + [(3, text(12)), (None, text(4)), (50, ""), (51, None), (52, "!!")]
    docs = [(i, text(r.randint(0, 60))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "... !!"), (None, items[0][1]), (5, docs[5][1])]
    docs += [(200 + i, f"{text(5)} {t} {text(3)}") for i, (_, t) in enumerate(items) if t]
    return docs, items


@pytest.mark.parametrize("seed, alphabet", [(1, 2), (2, 4), (3, 8)])
def test_equals_plain_scan(spark, seed, alphabet):
    docs, items = fixture(seed, alphabet)
    assert run(spark, docs, items) == plain(docs, items)


def test_blocks_of_the_benchmark_give_the_same(spark):
    docs, items = fixture(6)
    assert run(spark, docs, items, block_bytes=300) == plain(docs, items)


def test_long_documents_in_parts(spark, monkeypatch):
    monkeypatch.setattr(d, "SHARD_WORDS", 50)
    docs, items = fixture(7)
    r = random.Random(1)
    docs += [(900, " ".join(r.choices(["é", "Ab", "c1", "ZZ", "other"], k=3000))), (901, "x " * 70)]
    assert run(spark, docs, items) == plain(docs, items)


def test_empty_tables(spark):
    docs, items = fixture(8)
    assert run(spark, [], items) == []
    assert all(r[2] == 0 for r in run(spark, docs, []))


def test_longest_matches(spark):
    docs, items = fixture(9, 4)
    items = [(i, t) for i, t in items if i is not None and i < 12]
    items = list({i: (i, t) for i, t in items}.values())
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["item_id"], r["offset"]): r for r in d.longest_matches(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    texts = [(i, plain_words(t)) for i, t in docs]
    for i, t in items:
        w = plain_words(t)
        for o in range(len(w)):
            best = 0
            for _, x in texts:
                for s in range(len(x)):
                    n = 0
                    while o + n < len(w) and s + n < len(x) and x[s + n] == w[o + n]:
                        n += 1
                    best = max(best, n)
            r = got.get((str(i), o))
            assert (r["words"] if r else 0) == best
            if r:
                assert any(str(i2) == r["doc_id"] and x[r["word"]:r["word"] + best] == w[o:o + best] for i2, x in texts) or r["doc_id"] is None


def test_suffix_array_order():
    r = np.random.Generator(np.random.PCG64(2))
    words = r.integers(0, 3, 400)
    array = d.SuffixArray(words, 2, 1000)
    cut = lambda i: words[i:i + int(np.argmax(np.append(words[i:], 0) == 0))].tolist()
    assert [cut(i) for i in array.at] == sorted(cut(i) for i in np.flatnonzero(words))


def test_stage(spark):
    docs, items = fixture(10)
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, items string")
    kept = d.remove_contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == frame.columns
    want = sorted((str(i), str(t)) for (i, t), h in zip(docs, [plain([x], items)[0][5] for x in docs]) if not h)
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == want


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(sf + "/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted((tuple(r) for r in d.op1_decontamination(spark, sf).collect()), key=str)
    assert got == plain(docs, items) and any(r[5] for r in got)


def test_repeated_items_do_not_fill_a_block(spark):
    docs, items = fixture(9)
    assert run(spark, docs, items * 30) == run(spark, docs, items)
    benchmark = spark.createDataFrame(items * 30, "item_id string, text string")
    blocks = list(d._blocks(benchmark, "item_id", "text", 300))
    assert sum(map(len, blocks)) == len({(i or "", t) for i, t in items if t is not None}) and len(blocks) > 1
