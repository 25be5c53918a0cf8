"""Operator 13 against a plain merge of the libraries' own tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stockaudit.llm import alignment

A = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
ALPHABET = {chr(b): b for b in SHOWN} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(SHOWN))}


def tokens(text):
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    spell_a = [bytes(ALPHABET[c] for c in A.id_to_token(i)) for i in a]
    spell_b = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not text or b"".join(spell_a) != (" " + text).encode() or b"".join(spell_b) != (" " + text).encode():
        return [], [], [], []
    return a, b, spell_a, spell_b


def spans(spelt):
    out, at = [], 0
    for x in spelt:
        out.append((at, at + len(x)))
        at += len(x)
    return out


def plain(docs):
    made = []
    for d, text in docs:
        a, b, sa, sb = tokens(text or "")
        sa, sb = spans(sa), spans(sb)
        both = {e for _, e in sa} & {e for _, e in sb}
        groups, x, y = [([], [])], iter(zip(a, sa)), iter(zip(b, sb))
        for _ in both:
            for side, tokens_left in zip(groups[-1], (x, y)):
                for i, (_, e) in tokens_left:
                    side.append(str(i))
                    if e in both:
                        break
            groups.append(([], []))
        groups = [(",".join(p), ",".join(q)) for p, q in groups[:-1]]
        links, k = [], 0
        for i, (s, e) in zip(a, sa):
            while k and sb[k - 1][1] > s:
                k -= 1
            while k < len(sb) and sb[k][1] <= s:
                k += 1
            n = k
            while n < len(sb) and sb[n][0] < e:
                links.append((i, b[n]))
                n += 1
        made.append((d, len(a), len(b), groups, links))
    count = Counter(p for *_, links in made for p in set(links))
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    return sorted(((d, na, nb, len(g), len(k), sum(count[p] == best[p[0]] for p in k), sum(count[p] for p in k),
                    hashlib.sha256(";".join(f"{x}|{y}" for x, y in g).encode()).hexdigest() if g else "")
                   for d, na, nb, g, k in made), key=str)


ODD = [None, "", " ", "  ", "a", " a", "a ", "a  ", "  a   b ", "\n\n", "a\n b\t c", "x▁y", "<|endoftext|> <s> </s> <0x41>", "a\x00b",
       "½ﬁ Ⅷ 日本語 🎉👨‍👩‍👧", "don't I'll 1234567 3.14", "é ́x", " nbsp　wide", "ab" * 3000, "-" * 5000, "é" * 2000,
       " " * 700 + "x", "\r\n  indented()\n\tcode;", "<unk> ⁇ "]


def texts(n, seed=7):
    rng = random.Random(seed)
    words = "the of Straße naïve über tokenization 2024 e.g. 日本 internationalisation don't ( ) x=1; \n \t".split(" ")
    return [*ODD, *(rng.choice([" ", "  ", " \n"]).join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(n))]


def run(spark, docs, **options):
    frame = spark.createDataFrame([(*d, 1, "x", 3) for d in docs], "doc_id long, text string, row int, pairs string, n_best int")
    found = alignment.alignment_scores(frame.repartition(3), **options).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("frequent", [1 << 17, 40, 0])
def test_equal_to_a_plain_merge(spark, frequent):
    docs = list(enumerate(texts(120)))
    assert run(spark, docs, frequent=frequent) == plain(docs)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs = [(None, "the same text"), (1, "the same text"), (1, "the same text"), (1, "another"), (None, None)] * 3
    assert run(spark, docs) == plain(docs)
    assert run(spark, []) == []


def test_a_very_long_text(spark):
    docs = [(1, " ".join(texts(300)[len(ODD):]) * 8), (2, "the")]
    assert run(spark, docs) == plain(docs)


def test_align_returns_the_groups(spark):
    docs = [(i, t) for i, t in enumerate(texts(20)) if len(t or '') < 2000]
    frame = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, A_ids int").repartition(2)
    got = alignment.align(frame)
    assert got.columns == ["doc_id", "text", "A_ids", "a_ids_", "b_ids", "a_upto", "b_upto"]
    for r in got.collect():
        a, b, sa, sb = tokens(r["text"] or "")
        assert (r["a_ids_"], r["b_ids"]) == (a, b)
        cuts = sorted({e for _, e in spans(sa)} & {e for _, e in spans(sb)})
        assert r["a_upto"] == [sum(e <= c for _, e in spans(sa)) for c in cuts]
        assert r["b_upto"] == [sum(e <= c for _, e in spans(sb)) for c in cuts]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Z9.'\n\t▁é日 🎉<s>")), max_size=60))
def test_chunks_encode_like_the_whole(text):
    vocabulary = alignment.PieceVocabulary.of(alignment.default_pieces())
    if not text:
        return
    got = vocabulary.encode(text) if "▁" not in text else None
    want = tokens(text)[1]
    assert (got.tolist() if got is not None else []) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.integers(1, 4), min_size=1, max_size=60), st.integers(1, 9))
def test_pieces_of_any_size(x, y, step):
    a, b = np.cumsum(x), np.cumsum(y)
    a, b = np.append(a[a < b[-1]], b[-1]), b
    left, right, group = alignment.overlaps(a, b, step)
    ends = np.intersect1d(a, b)
    want = [(i, j, int(np.searchsorted(ends, a[i]))) for i in range(len(a)) for j in range(len(b))
            if max(a[i - 1] if i else 0, b[j - 1] if j else 0) < min(a[i], b[j])]
    assert list(zip(left.tolist(), right.tolist(), group.tolist())) == want
