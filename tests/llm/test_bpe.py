"""Operator 7 against the library on whole texts."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stockaudit.llm import bpe
from stockaudit.llm.pieces import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = ["a", "B", " ", "  ", "\n", "\t", "'s", "'", "é", "ß", " ", "　", "中", "1", "23", ".", "!?", "\x00", "\x85",
         " ", "😀", "ab", " the", "ll", "\r\n", "<|endoftext|>"]


def want(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=16).map("".join), max_size=6))
def test_pieces_equal_the_library(texts):
    assert [x.tolist() for x in PieceEncoder.of(PATH).encode(texts)] == [want(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "the", "ing", "éé", "abab", "zz", "tion"]), min_size=2, max_size=60).map("".join),
       st.integers(1, 9))
def test_tree_concatenation_equals_the_whole(word, leaf):
    unit = LIBRARY.pre_tokenizer.pre_tokenize_str(word)[0][0]
    encode = lambda s: [t.id for t in LIBRARY.model.tokenize(s)]
    parts = [np.array(encode(x), np.int32) for x in bpe.halves(unit, leaf)]
    assert bpe.concatenate(parts, LIBRARY.id_to_token, encode).tolist() == encode(unit)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=30))
def test_decode_equals_the_library(ids):
    assert bpe.Spelling.of(PATH).decode(np.array(ids, np.int64)) == LIBRARY.decode(ids, skip_special_tokens=False)


def long_texts():
    r = random.Random(3)
    return ["x" * 30_000, "ab" * 9_000 + " end " + "-" * 20_000 + "\n" + " " * 9_500 + "y",
            "".join(r.choices("abcdefgh", k=50_000)), "é中" * 9_000 + "1" * 9_000 + " a b c", "q" * 9_000 + "<|endoftext|>" + "r" * 9_000]


def test_operator(spark):
    texts = [None, "", "One two.", "One two.", *long_texts(), "plain words " * 4000]
    rows = [(i // 2, t, i, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, tokens string")
    coded = bpe.encode(docs, decoded="place")
    got = {r["row"]: r for r in coded.collect()}
    assert len(got) == len(texts) and coded.columns == ["doc_id", "text", "row", "tokens", "tokens_", "place"]
    for i, t in enumerate(texts):
        assert got[i]["tokens_"] == want(t) and got[i]["place"] == LIBRARY.decode(want(t), skip_special_tokens=False), i
    digests = sorted(tuple(r) for r in bpe.round_trip(docs).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert digests == sorted(
        (i // 2, len(want(t)), sha(",".join(map(str, want(t)))), sha(LIBRARY.decode(want(t), skip_special_tokens=False)))
        for i, t in enumerate(texts))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "x" * 1500, "-" * 5000, "é" * 1100, " " * 1300, "a b", "<|endoftext", " the", "\n"]),
                max_size=12).map("".join))
def test_runs_between_added_tokens(text):
    """The segments' ids, joined, are the library's, and no long run reaches the library in one piece."""
    out, units = [], {}
    for kind, unit, part in bpe._segments(text, LIBRARY):
        assert kind != bpe.AS_IT_IS or not bpe.RUN.search(part)
        units.setdefault(unit, []).append((kind, part))
    encode = lambda s: [t.id for t in LIBRARY.model.tokenize(s)]
    for _, parts in sorted(units.items()):
        kind = parts[0][0]
        if kind == bpe.AS_IT_IS:
            out += want(parts[0][1])
        elif kind == bpe.UNITS:
            out += [i for u in parts[0][1].split("\n") for i in encode(u)]
        else:
            out += bpe.concatenate([np.array(encode(p), np.int32) for _, p in parts], LIBRARY.id_to_token, encode).tolist()
    assert out == want(text)


def test_empty_table(spark):
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    rows = {r["doc_id"]: r for r in bpe.op7_bpe_round_trip(spark, f"/root/testdata/{sf}").collect()}
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d in docs:
        r = rows[d["doc_id"]]
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, want(d["text"]))).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()
        assert r["n_tokens"] == len(want(d["text"]))
