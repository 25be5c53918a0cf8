"""Operator 6: planes against plain lists, files against the library."""

from __future__ import annotations

import random
import tempfile
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stockaudit.llm import token_files as t

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 70_000)), max_size=1500), st.integers(0, 1 << 20))
def test_matrix(values, seed):
    built = t.WaveletMatrix.build(np.array(values, np.int64))
    m = t.WaveletMatrix.from_bytes(memoryview(built.to_bytes()), built.n, len(built.planes))
    assert m.all().tolist() == values
    r = random.Random(seed)
    for _ in range(5):
        i = r.randint(0, len(values))
        v = r.choice(values) if values else 3
        assert m.rank(v, i) == values[:i].count(v) and m.count(v) == values.count(v)
        places = [k for k, x in enumerate(values) if x == v]
        k = r.randint(0, len(places))
        assert m.select(v, k) == (places[k] if k < len(places) else -1)
        if values:
            i = r.randrange(len(values))
            assert m.access(i) == values[i]
    assert m.count(1 << 21) == 0


def plain(docs):
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, (d[1] or "").encode())):
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_files(spark):
    r = random.Random(5)
    docs = [(i, " ".join(r.choices(["alpha", "Beta", "é", "12"], k=r.randint(0, 200)))) for i in range(300)]
    docs += [(None, "none"), (7, None), (7, ""), (7, docs[7][1]), (900, "long " * 30_000), (-5, "first")]
    r.shuffle(docs)
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, ids string").repartition(5)
    folder = tempfile.mkdtemp() + "/tokens"
    t.write_tokens(frame, folder, shard_tokens=2000)
    got = sorted((tuple(x) for x in t.read_tokens(spark, folder).collect()), key=lambda x: x[1])
    assert got == plain(docs)
    shards = t.read_shards(spark, folder).count()
    assert shards > 5
    whole = [x for row in got for x in row[4]]
    token = whole[5]
    found = sorted((x["place"], x["doc_id"]) for x in t.find_token(spark, folder, token).collect())
    assert [p for p, _ in found] == [i for i, x in enumerate(whole) if x == token]


def test_empty_table(spark):
    folder = tempfile.mkdtemp() + "/tokens"
    t.write_tokens(spark.createDataFrame([], "doc_id long, text string"), folder)
    assert t.read_tokens(spark, folder).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in t.op6_token_files(spark, sf).collect()), key=lambda x: x[1])
    assert got == [x[:4] for x in plain(docs)]
